"""Micro-batch ingestion.

Per batch: one pass opens, parses, seals and stages every message, without a shuffle where the input has partitions
enough and these have many messages; all sinks then read the staged columns they need. Staging is a written table below the pipeline's root, so losing
an executor costs no more than the task that ran there. Two staging folders per run are used in turn. One commit makes
the batch visible in all its tables, after everything else is written.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from urllib.parse import quote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formweave.config import IngestConfig, kafka_options
from formweave.functions.crypto import EnvelopeCipher
from formweave.operators import evolve
from formweave.operators.counts import observed
from formweave.plans.ingest import stage
from formweave.schemas import PACKED, REJECTED_ROUTE, RUNS, STAGED, start_table
from formweave.session import shared_dir, spread
from formweave.sinks import files
from formweave.sinks.tables import FormStore
from formweave.sources.messages import deliver_once, message_stream
from formweave.sources.rules import current_rules
from formweave.streaming.retry import with_retries

log = logging.getLogger(__name__)

# The description of rows whose append kept failing.
APPEND_FAILED = "Exceeded rate limits: too many table update operations for this table"
# Batch keys of a stream are its run times this, plus the number of the batch.
RUN_BATCHES = 1_000_000_000
# A task writes one file to each folder it has rows for; beyond so many folders, rows are first brought together.
FOLDERS = 64
# Tasks with fewer messages than this would leave fragments of each form: their staged rows are first dealt by form.
FULL_TASK = 10_000


def _gathered(rows: DataFrame, *folder: str) -> DataFrame:
    """Rows for more than FOLDERS folders, those of a folder together: adaptive execution merges the partitions of small
    folders and splits those of a folder with many rows. Fewer folders get a file of each task that has rows for them,
    which saves the shuffle of whole rows."""
    many = rows.select(*folder).distinct().count() > FOLDERS
    return rows.hint("rebalance", *folder) if many else rows


class IngestPipeline:
    def __init__(self, spark: SparkSession, config: IngestConfig, cipher: EnvelopeCipher,
                 sleep: Callable[[float], None] = time.sleep):
        self.spark, self.config, self.cipher, self.sleep = spark, config, cipher, sleep
        self.store = FormStore(spark, config.root, config.dataSet)
        shared_dir(spark)

    @property
    def counts(self) -> dict[int, dict[str, int]]:
        """Messages and rejected messages of every committed batch, also of earlier runs."""
        return {r.batch_id: {"messages": r.messages, "rejected": r.rejected} for r in self.store.batches().collect()}

    # -- running ---------------------------------------------------------------------------------------

    def start(self, available_now: bool = False) -> StreamingQuery:
        """Run continuously, or over what is there now."""
        config = self.config
        source = message_stream(self.spark, config.inputSubscription, config.maxFilesPerTrigger, **config.extra)
        if config.redeliverySeconds:
            source = deliver_once(source, config.redeliverySeconds)
        first = self._run(config.checkpoint) * RUN_BATCHES
        writer = source.writeStream.foreachBatch(lambda rows, n: self.process(rows, first + n)).option("checkpointLocation", config.checkpoint)
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=f"{config.triggerSeconds} seconds").start()

    def backlog(self, messages: DataFrame, name: str) -> None:
        """A whole backlog as one batch, before, beside or after a stream. A backlog of the same name replaces it."""
        self.process(messages, self._run(f"{self.config.root}/backlogs/{quote(name, safe='')}", name) * RUN_BATCHES)

    def _run(self, place: str, name: str | None = None) -> int:
        """Number of the run that is kept at `place`: a stream's checkpoint or a backlog's folder. A restart goes on with
        it, and a stream whose checkpoint is new or lost takes the next number, so that its batches never replace
        earlier ones."""
        marker = f"{place}/run"
        start_table(self.spark, marker, RUNS)
        start_table(self.spark, self.config.runs, RUNS)
        known = self.spark.read.schema(RUNS).parquet(marker).first()
        if known:
            return known.run
        last = self.spark.read.schema(RUNS).parquet(self.config.runs).agg(F.max("run").alias("run")).first().run
        row = self.spark.createDataFrame([((last or 0) + 1, name)], RUNS)
        row.write.mode("append").parquet(self.config.runs)
        row.write.mode("overwrite").parquet(marker)
        return (last or 0) + 1

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """One batch under a number of its own. Safe to repeat: the later commit of a number holds. The number of jobs
        does not depend on the number of forms."""
        dealt = messages.groupBy(F.spark_partition_id().alias("task")).count().agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("messages"), F.count("*").alias("tasks")).first()
        if not dealt.messages:
            self.store.commit(batch_id, {"messages": 0, "rejected": 0})
            return
        self.cipher.rotate()
        staged, seen = self._stage(messages, dealt.messages, dealt.tasks, batch_id)
        accepted = staged.where(F.col("route") != REJECTED_ROUTE)
        found = evolve.batch_columns(accepted).checkpoint()
        with ThreadPool(2) as pool:
            # A message without a time or an id has no URL; accepted, it is archived all the same.
            kept = _gathered(staged.where(F.col("file_url").isNotNull() | (F.col("route") != REJECTED_ROUTE)), "month", "day")
            archived = pool.apply_async(inheritable_thread_target(self.spark)(files.archive), (kept, self.config.archive, batch_id))
            places, failed = self._append(accepted, found, batch_id)
            archived.get()
        self._write_errors(staged, failed, batch_id)
        counted = accepted.groupBy(F.col("route").alias("table")).agg(F.count("*").alias("rows"))
        changed = self._changed(found)
        self.store.commit(batch_id, seen, counted.join(places, "table"), found)
        log.info("batch %s: %s", batch_id, seen)
        self._sync_catalog(changed)

    # -- steps -----------------------------------------------------------------------------------------

    def staged_path(self, batch_id: int) -> str:
        """Two folders per run are used in turn."""
        return f"{self.config.staging}/run={batch_id // RUN_BATCHES}/slot={batch_id % 2}"

    def _stage(self, messages: DataFrame, total: int, tasks: int, batch_id: int) -> tuple[DataFrame, dict[str, int]]:
        config = self.config
        if config.inputPartitions and tasks < config.inputPartitions:
            messages, tasks = spread(messages, config.inputPartitions), config.inputPartitions
        rows = stage(messages, current_rules(self.spark, config.rules), self.cipher, config.baseUrl,
                     config.bucketName, config.onDeidError, config.collision, config.cryptohashing)
        rows, seen = observed(rows, f"ingest-{batch_id}")
        if total < FULL_TASK * tasks:
            # Adaptive execution merges the partitions of small tables and splits those of a table with many rows. Days
            # are kept together too, so that the archive, which is laid out by day, gets few files.
            writer = rows.hint("rebalance", "route", "month", "day").write.partitionBy("route")
        else:
            writer = rows.write
        path = self.staged_path(batch_id)
        writer.mode("overwrite").option("compression", PACKED).parquet(path)
        return self.spark.read.schema(STAGED).parquet(path), seen.get

    def _append(self, accepted: DataFrame, found: DataFrame, batch_id: int) -> tuple[DataFrame, list[str]]:
        """Write the rows of all tables in one job: (table, attempt) of what is stored, and the tables given up. Where
        the job keeps failing, each table is tried on its own, so that one that cannot be written loses no other."""
        tables = found.select("table").distinct()
        accepted = _gathered(accepted, "route")
        attempt = self.store.new_attempt()
        if with_retries(lambda: self.store.append(accepted, batch_id, attempt), self.config.retry.waits, self.sleep):
            return tables.withColumn("attempt", F.lit(attempt)), []
        stored, failed = [], []

        def alone(table: str) -> None:
            own = self.store.new_attempt()
            rows = accepted.where(F.col("route") == table)
            done = with_retries(lambda: self.store.append(rows, batch_id, own), (0.0,), self.sleep)
            stored.append((table, own)) if done else failed.append(table)

        with ThreadPool(self.config.parallelForms) as pool:
            pool.map(inheritable_thread_target(self.spark)(alone), [r.table for r in tables.collect()])
        return self.spark.createDataFrame(stored, "table string, attempt string"), sorted(failed)

    def _changed(self, found: DataFrame) -> list[str]:
        """Tables whose view the catalog must learn anew."""
        if not self.config.dataSet:
            return []
        added = evolve.new_columns(found, self.store.registry()).select("table").distinct()
        return sorted({r.table for r in added.collect()} | self.store.lagging)

    def _sync_catalog(self, changed: list[str]) -> None:
        """The rows are committed: a catalog that fails must not send them to the errors as well."""
        if with_retries(lambda: self.store.sync_catalog(changed), self.config.retry.waits, self.sleep):
            self.store.lagging.difference_update(changed)
        else:
            log.error("the catalog lags behind tables %s", changed)
            self.store.lagging.update(changed)

    def _write_errors(self, staged: DataFrame, failed: list[str], batch_id: int) -> None:
        """One error append per batch: rejected messages, and rows whose append was given up, which also go to the dead
        letters. A folder of dead letters is written in any case: a repeat that succeeds replaces those of the first
        try."""
        errors = staged.where(F.col("route") == REJECTED_ROUTE)
        if failed:
            log.error("appends of %s given up, their rows of batch %s go to the dead letters", failed, batch_id)
        lost = staged.where(F.col("route").isin(*failed)) if failed else staged.where(F.lit(False))
        if failed or not self.config.dead_letter.startswith("kafka:"):
            files.dead_letter(lost, self.config.dead_letter, batch_id, **kafka_options(self.config.extra))
        if failed:
            errors = errors.unionByName(lost.withColumn("error", F.lit(APPEND_FAILED)))
        files.write_errors(errors, self.config.errors, batch_id)
