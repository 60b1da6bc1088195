"""Fixed schemas of the tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


REQUEST = _strings("organization", "team", "formName", "version", "body")

MESSAGE = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()),
])

RULES = _strings("formName", "fieldName", "dlpTechnique", "addnl_info")

ERRORS = _strings("formName", "errorFormData", "timeStamp", "description")

# One row per column of a form table, in table order.
REGISTRY = T.StructType([
    T.StructField("formName", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("batch_id", T.LongType()),
])

# The commit log: what a committed batch is made of. Of its kinds of rows, "batch" has the counts of a batch, "table"
# the folder of one of its tables, "column" a column it brought. `version` is the commit that a batch's rows come from;
# a snapshot, which has `as_of`, stands for all commits up to that one.
COMMIT = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("as_of", T.LongType()),
    T.StructField("version", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("attempt", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("formName", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("place", T.IntegerType()),
    T.StructField("rows", T.LongType()),
    T.StructField("messages", T.LongType()),
    T.StructField("rejected", T.LongType()),
])

# Rows of all form tables: the names of `columns` in lower case. `attempt` and `route`, the table, are partition columns.
LANDED = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
    T.StructField("attempt", T.StringType()),
    T.StructField("route", T.StringType()),
])

# A processed micro-batch: every message once, accepted or rejected.
STAGED = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("key_name", T.StringType()),
    T.StructField("formName", T.StringType()),
    T.StructField("file_url", T.StringType()),
    T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
    T.StructField("error", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("route", T.StringType()),
])
REJECTED_ROUTE = "_rejected"
# Codec of files with sealed values, whose Base64 text and repeated headers it takes a third off.
PACKED = "zstd"

DEAD_LETTER = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("formName", T.StringType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("key_name", T.StringType()),
])


# Runs: each checkpoint of a stream and each named backlog has its own.
RUNS = T.StructType([T.StructField("run", T.LongType()), T.StructField("name", T.StringType())])


def start_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table at `path`, unless one is there already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
