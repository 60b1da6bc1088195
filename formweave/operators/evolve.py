"""Columns of form tables: discover them, compare them with the registry, and project rows onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_columns(rows: DataFrame, table: str = "route") -> DataFrame:
    """Distinct (formName, table, column) of the rows. Names that differ only in case are one column, spelled as
    the first in sort order. Only names are shuffled, each at most once per task: they are made distinct by hashing
    first, as the least of several texts is found by sorting. Dealing them keeps the optimizer from joining the steps."""
    names = rows.select("formName", F.col(table).alias("table"), F.explode(F.map_keys("columns")).alias("column"))
    spelled = names.distinct().withColumn("column_key", F.lower("column")).repartition("formName", "table", "column_key")
    return spelled.groupBy("formName", "table", "column_key").agg(F.min("column").alias("column"))


def new_columns(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Columns of the batch that the registry does not hold."""
    known = registry.select("table", F.lower("column").alias("column_key"))
    return found.join(known, ["table", "column_key"], "left_anti")


def forms_to_create(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Forms of the batch that have no table."""
    return (found.select("formName", "table").distinct()
            .join(registry.select("table").distinct(), "table", "left_anti").select("formName", "table"))


def column_counts(registry: DataFrame) -> DataFrame:
    return registry.groupBy("table").agg(F.count("*").cast("int").alias("known"))


def widened(added: DataFrame, registry: DataFrame, batch_id: int) -> DataFrame:
    """Registry rows for the new columns: behind the existing ones, in sort order."""
    order = Window.partitionBy("table").orderBy("column")
    return (added.join(column_counts(registry), "table", "left")
            .select("formName", "table", "column",
                    (F.coalesce("known", F.lit(0)) + F.row_number().over(order) - 1).cast("int").alias("position"),
                    F.lit(batch_id).cast("bigint").alias("batch_id")))


def schema_union(existing: list[str], new: list[str]) -> tuple[bool, list[str]]:
    """Existing columns in their order, then the ones they lack; and whether there were any."""
    have = {c.lower() for c in existing}
    extra = []
    for name in new:
        if name.lower() not in have:
            have.add(name.lower())
            extra.append(name)
    return bool(extra), [*existing, *extra]


def wide_rows(rows: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows as the columns of their table, NULL where a row lacks one. The map is lowered once, then read per
    column; `keep` names columns of the rows to put in front."""
    lowered = rows.select(*keep, F.transform_keys("columns", lambda k, _: F.lower(k)).alias("columns"))
    return lowered.select(*keep, *[F.col("columns")[name.lower()].alias(name) for name in columns])


def table_schemas(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Append-only union per table: existing columns in their order, then the added ones; `changed` says
    whether there are any. A table's list is bounded by its number of columns."""
    rows = (existing.select("table", "column", "position", F.lit(False).alias("is_new"))
            .unionByName(added.select("table", "column", "position", F.lit(True).alias("is_new"))))
    return rows.groupBy("table").agg(
        F.bool_or("is_new").alias("changed"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", "column"))), lambda c: c["column"])
        .alias("columns"))
