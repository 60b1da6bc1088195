"""The rule table and its CSV change files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.schemas import RULES, start_table

# Rules lie in this many buckets by form and field; a change of rules writes the buckets it touches.
BUCKETS = 64
_BUCKETED = T.StructType([*RULES.fields, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())])
_WRITTEN = T.StructType([T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType()),
                         T.StructField("rows", T.LongType())])


def rule_bucket() -> Column:
    return F.pmod(F.xxhash64("formName", "fieldName"), F.lit(BUCKETS)).cast("int").alias("bucket")


def versions_path(path: str) -> str:
    """The log of the table's versions, in a folder that table readers pass over."""
    return f"{path}/_versions"


def rule_versions(spark: SparkSession, path: str) -> DataFrame:
    """version, bucket, rows: what each complete version has written. Version 0, which is empty, is always there."""
    start_table(spark, f"{versions_path(path)}/commit=0", _WRITTEN)
    return spark.read.schema(_WRITTEN).parquet(versions_path(path))


def newest_version(spark: SparkSession, path: str) -> int:
    return rule_versions(spark, path).agg(F.max("version")).first()[0] or 0


def rules_at(spark: SparkSession, path: str, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rule table, or some of its buckets, as of a version, the newest unless given. Each bucket is as the last
    version up to that one wrote it; only the folders of these are read."""
    written = rule_versions(spark, path).where("bucket IS NOT NULL")
    if version is not None:
        written = written.where(F.col("version") <= version)
    if buckets is not None:
        written = written.where(F.col("bucket").isin(*buckets))
    last = written.groupBy("bucket").agg(F.max(F.struct("version", "rows")).alias("w")).where("w.rows > 0")
    folders = [f"{path}/version={r.w.version}/bucket={r.bucket}" for r in last.collect()]
    if not folders:
        return spark.createDataFrame([], RULES)
    return spark.read.schema(_BUCKETED).option("basePath", path).parquet(*folders).select(*RULES.names)


def current_rules(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the rule table."""
    return rules_at(spark, path)


def rule_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Rows of a rule CSV (a file or a folder of files, each with one header line).

    `_corrupt` holds lines that have not exactly four cells; to tell, the parser must not prune columns. `pos`
    orders the rows as in the file: by file, then by the start of the split, then by the row's place in it.
    """
    schema = T.StructType([*RULES.fields, T.StructField("_corrupt", T.StringType())])
    rows = (spark.read.schema(schema).option("header", "true").option("quote", '"').option("escape", '"')
            .option("multiLine", str(multi_line).lower()).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").option("columnPruning", "false").csv(path))
    pos = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row"))
    return rows.select(pos.alias("pos"), *RULES.names, "_corrupt")
