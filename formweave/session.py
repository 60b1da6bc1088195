"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast up to so many bytes, measured as JSON text.
SMALL_SIDE = 32 << 20
# Settings the jobs rely on. Everything else is left to the cluster.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "formweave", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is only ever chosen in local mode, where it is shared by construction.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not configured:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="formweave-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Shuffle rows evenly, whatever their keys, over that many partitions, or one per core the session began with.

    For inputs of few, large files, whose rows are heavy work each, such as opening and sealing messages.
    """
    return rows.repartition(partitions or rows.sparkSession.sparkContext.defaultParallelism)


def small_side(rows: DataFrame, label: str) -> DataFrame:
    """A table for the inner side of a join with many, wide rows: written, measured, and broadcast if it is small. Spark
    goes by the files that a table is made from, however few rows an aggregation leaves of them, and would shuffle the
    other side. Larger tables join as Spark chooses, and so do all where broadcasts are switched off."""
    spark, path = rows.sparkSession, fresh_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path)
    size = kept.agg(F.sum(F.octet_length(F.to_json(F.struct(*kept.columns))))).first()[0] or 0
    off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return kept if off or size > SMALL_SIDE else F.broadcast(kept)


def remove_older(spark: SparkSession, parent: str, keep: set[str], seconds: float) -> int:
    """Delete the folders directly below `parent` that are not in `keep` and did not change for so long."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(parent)
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(path):
        return 0
    limit, removed = (time.time() - seconds) * 1000, 0
    for status in system.listStatus(path):
        if status.isDirectory() and status.getPath().getName() not in keep and status.getModificationTime() <= limit:
            removed += bool(system.delete(status.getPath(), True))
    return removed


def spread_partitions(spark: SparkSession) -> int:
    """Partitions to deal heavy rows over: as many as shuffles have, or one per core if that is more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
