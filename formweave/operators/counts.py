"""Counts that the jobs report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(rows: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Count rows and rejected rows while they are written; no extra pass."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("messages"),
                        F.count_if(F.col("error").isNotNull()).alias("rejected")), seen


def counts_by_form(rows: DataFrame) -> DataFrame:
    return rows.groupBy("formName").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("error").isNotNull()).alias("rejected"),
        F.sum(F.when(F.col("columns").isNotNull(), F.size("columns")).otherwise(0)).cast("bigint").alias("fields"))
