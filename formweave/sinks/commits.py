"""The log of committed batches.

A batch's rows are written first, to a folder of its own; then one file in the log, which Spark's committer moves into
place as a whole, makes all its tables and new columns visible at once. Readers list the log, never the data folders, so
half a batch, a failed attempt and a replaced one are never seen.

What holds does not depend on batch numbers but on the log: of a batch that was committed twice the later commit holds,
and a column's place in its table is where it first appeared. Commits do not build on one another, so two writers may
commit at the same time; equal numbers are told apart by their tokens. A snapshot repeats what holds up to a commit,
so that readers need not go further back; rows it has moved keep the version of their batch, and a batch that was
replaced meanwhile is newer than what the snapshot says of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formweave.schemas import COMMIT, REGISTRY, start_table


def _named(rows: DataFrame, **values) -> DataFrame:
    """The rows with all columns of the log; those not named are NULL."""
    have = rows.withColumns(values) if values else rows
    return have.select(*[(F.col(f"`{f.name}`") if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in COMMIT.fields])


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        start_table(spark, f"{path}/commit=0-start", COMMIT)

    # -- reading ---------------------------------------------------------------------------------------

    def _all(self) -> DataFrame:
        return self.spark.read.schema(COMMIT).parquet(self.path).select(*COMMIT.names)

    def last(self) -> int:
        return self._all().agg(F.max("seq")).first()[0] or 0

    def entries(self) -> DataFrame:
        """Rows of the newest snapshot and of the commits that it does not cover."""
        rows = self._all()
        newest = self._newest_snapshot(rows)
        if newest is None:
            return rows
        own = (F.col("seq") == newest.seq) & (F.col("as_of") == newest.as_of)
        return rows.where(own | (F.col("as_of").isNull() & (F.col("seq") > newest.as_of)))

    @staticmethod
    def _newest_snapshot(rows: DataFrame):
        return rows.where("as_of IS NOT NULL").agg(F.max(F.struct("as_of", "seq")).alias("s")).first().s

    def has_snapshot(self, entries: DataFrame) -> bool:
        return self._newest_snapshot(entries) is not None

    def batches(self, entries: DataFrame | None = None) -> DataFrame:
        """batch_id, version, messages, rejected of every committed batch."""
        rows = (entries if entries is not None else self.entries()).where("kind = 'batch'")
        return rows.groupBy("batch_id").agg(F.max(F.struct("version", "messages", "rejected")).alias("b")).select(
            "batch_id", "b.*")

    def tables(self, entries: DataFrame | None = None) -> DataFrame:
        """batch_id, version, table, attempt, rows: where the rows of a batch and table are."""
        entries = entries if entries is not None else self.entries()
        held = self.batches(entries).select("batch_id", "version")
        rows = entries.where("kind = 'table'").join(held, ["batch_id", "version"], "left_semi")
        return rows.groupBy("batch_id", "version", "table").agg(F.max(F.struct("seq", "attempt", "rows")).alias("t")).select(
            "batch_id", "version", "table", "t.attempt", "t.rows")

    def registry(self, before: int | None = None, entries: DataFrame | None = None) -> DataFrame:
        """formName, table, column, position, batch_id of every column, in the order in which commits brought them; with
        `before`, of those that batches with a lower number brought."""
        rows = (entries if entries is not None else self.entries()).where("kind = 'column'")
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        first = rows.groupBy("table", F.lower("column").alias("key")).agg(
            F.min(F.struct("version", "attempt", "place", "column", "formName", "batch_id")).alias("c"))
        order = Window.partitionBy("table").orderBy("c.version", "c.attempt", "c.place")
        return first.select("c.formName", "table", "c.column", (F.row_number().over(order) - 1).cast("int").alias("position"),
                            "c.batch_id").select(*REGISTRY.names)

    # -- writing ---------------------------------------------------------------------------------------

    def commit(self, batch_id: int, counts: dict[str, int], tables: DataFrame | None = None,
               columns: DataFrame | None = None) -> int:
        """Make a batch visible: ``tables`` are (table, attempt, rows), ``columns`` are (formName, table, column). A batch
        of the same number is replaced; the columns it brought stay."""
        seq, token = self.last() + 1, uuid.uuid4().hex
        one = self.spark.range(1).select(F.lit(counts["messages"]).alias("messages"), F.lit(counts["rejected"]).alias("rejected"))
        rows = _named(one, kind=F.lit("batch"))
        if tables is not None:
            rows = rows.unionByName(_named(tables, kind=F.lit("table")))
        if columns is not None:
            place = F.row_number().over(Window.partitionBy("table").orderBy("column"))
            rows = rows.unionByName(_named(columns, kind=F.lit("column"), place=place, attempt=F.lit(token)))
        stamped = rows.withColumns({"seq": F.lit(seq), "version": F.lit(seq), "batch_id": F.lit(batch_id)})
        self._write(stamped, seq, token)
        return seq

    def snapshot(self, as_of: int, entries: DataFrame, moved: DataFrame) -> int:
        """Repeat what `entries`, the log up to commit `as_of`, say, with the tables in ``moved`` (batch_id, version,
        table, attempt, rows) in their new places."""
        seq, token = self.last() + 1, uuid.uuid4().hex
        stay = self.tables(entries).join(moved, ["batch_id", "version", "table"], "left_anti")
        place = ["batch_id", "version", "table", "attempt", "rows"]
        columns = entries.where("kind = 'column'").groupBy("table", F.lower("column").alias("key")).agg(
            F.min(F.struct("version", "attempt", "place", "column", "formName", "batch_id")).alias("c")).select("table", "c.*")
        rows = (_named(self.batches(entries), kind=F.lit("batch"))
                .unionByName(_named(stay.select(*place).unionByName(moved.select(*place)), kind=F.lit("table")))
                .unionByName(_named(columns, kind=F.lit("column"))))
        self._write(rows.withColumns({"seq": F.lit(seq), "as_of": F.lit(as_of)}), seq, token)
        return seq

    def _write(self, rows: DataFrame, seq: int, token: str) -> None:
        # One task writes one file: it is there as a whole or not at all.
        rows.select(*[F.col(f.name).cast(f.dataType) for f in COMMIT.fields]).coalesce(1).write.mode(
            "errorifexists").parquet(f"{self.path}/commit={seq:012d}-{token}")
