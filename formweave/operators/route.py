"""Split judged rows into accepted and rejected ones.

A filter on `error` would be pushed below the projections that compute it, which then run twice: once for the
filter and once for the result. An inlined one-element array keeps the test where it is written. Rows read back
from staging need none of this; there a plain filter prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only(rows: DataFrame, keep: Column, *columns: str) -> DataFrame:
    """The named columns (all, if none is named) of the rows where `keep` holds, tested in this place."""
    return rows.select(F.inline(F.when(keep, F.array(F.struct(*(columns or rows.columns))))))


def accepted(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows without an error."""
    return only(rows, F.col("error").isNull(), *columns)


def rejected(rows: DataFrame, *columns: str) -> DataFrame:
    return only(rows, F.col("error").isNotNull(), *columns)
