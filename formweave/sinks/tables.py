"""Form tables that widen as new columns arrive.

The rows of all form tables lie in one landing table, each with its columns as a map: ``landing/attempt=<a>/route=<table>/``.
A batch writes them in one job, however many forms it has, and the commit log says which folders hold. A form's table is
a projection of its landing rows onto the columns in the registry, so older rows need no rewrite when a table widens: a
column they lack reads as NULL. With a catalog database the tables are views there.

Small folders of many batches are packed into files of a target size; the log then names the new folder in their place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from formweave.operators import evolve
from formweave.schemas import COMMIT, LANDED, PACKED
from formweave.session import remove_older, shared_dir
from formweave.sinks.commits import CommitLog

BATCH = "batch_id"
# Catalog names of the landing table and the log; no form's table begins with an underscore.
LANDING_TABLE, LOG_TABLE = "_landing", "_commits"
# So many folders are packed bin by bin, that many tables at a time; more of them by one shuffle.
FEW_FOLDERS, PACKING = 64, 8

# SQL text of the rows of the log that hold, as in `commits`.
LIVE = """WITH held AS (SELECT * FROM {log}
    WHERE struct(as_of, seq) = (SELECT max(struct(as_of, seq)) FROM {log} WHERE as_of IS NOT NULL)
    OR (as_of IS NULL AND seq > coalesce((SELECT max(as_of) FROM {log}), -1))),
  b AS (SELECT batch_id, max(version) AS version FROM held WHERE kind = 'batch' GROUP BY batch_id)
SELECT t.batch_id, t.`table`, max_by(t.attempt, t.seq) AS attempt FROM held t JOIN b USING (batch_id, version)
WHERE t.kind = 'table' GROUP BY t.batch_id, t.`table`"""


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class FormStore:
    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark, self.root, self.database = spark, root, database
        self.log = CommitLog(spark, f"{root}/commits")
        self.lagging: set[str] = set()
        shared_dir(spark)

    # -- metadata --------------------------------------------------------------------------------------

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    def registry(self, before: int | None = None) -> DataFrame:
        """Columns of all tables; only those that batches with a lower number brought, when one is named."""
        return self.log.registry(before)

    def batches(self) -> DataFrame:
        """batch_id, messages, rejected of every committed batch."""
        return self.log.batches().select("batch_id", "messages", "rejected")

    def table_counts(self) -> DataFrame:
        """table, batches, rows, from the log alone."""
        return self.log.tables().groupBy("table").agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"))

    def table_columns(self, entries: DataFrame | None = None) -> DataFrame:
        """(table, columns in table order) of all tables."""
        ordered = F.array_sort(F.collect_list(F.struct("position", "column")))
        return self.log.registry(entries=entries).groupBy("table").agg(ordered["column"].alias("columns"))

    def columns(self, table: str, entries: DataFrame | None = None) -> list[str]:
        """Column names of one table, in table order."""
        rows = self.log.registry(entries=entries).where(F.col("table") == table).select("column", "position")
        return [r.column for r in sorted(rows.collect(), key=lambda r: r.position)]

    # -- writing ---------------------------------------------------------------------------------------

    @staticmethod
    def new_attempt() -> str:
        return f"a-{uuid.uuid4().hex}"

    def append(self, rows: DataFrame, batch_id: int, attempt: str) -> None:
        """Write a batch's rows of all its tables, `route` being the table. They are not visible before the commit."""
        lowered = F.transform_keys("columns", lambda k, _: F.lower(k))
        (rows.select("message_id", F.lit(batch_id).cast("bigint").alias(BATCH), lowered.alias("columns"), "route")
         .write.mode("overwrite").option("compression", PACKED).partitionBy("route").parquet(f"{self.landing}/attempt={attempt}"))

    def commit(self, batch_id: int, counts: dict[str, int], tables: DataFrame | None = None,
               found: DataFrame | None = None) -> int:
        """Make a batch visible, with the columns that no table had before. ``tables``: (table, attempt, rows)."""
        added = None
        if found is not None:
            added = evolve.new_columns(found, self.registry()).select("formName", "table", "column")
        return self.log.commit(batch_id, counts, tables, added)

    # -- reading ---------------------------------------------------------------------------------------

    def landed(self, table: str | None = None, entries: DataFrame | None = None) -> DataFrame:
        """Visible landing rows, of one table or of all, as of ``entries`` of the log, the newest unless given."""
        entries = entries if entries is not None else self.log.entries()
        return self._visible(self._stored(entries, table), entries, table)

    def _stored(self, entries: DataFrame, table: str | None = None) -> DataFrame:
        """All rows of the folders that the log names."""
        live = self.log.tables(entries)
        folder = F.concat(F.lit(f"{self.landing}/attempt="), "attempt")
        if table is not None:
            live = live.where(F.col("table") == table)
            folder = F.concat(folder, F.lit(f"/route={table}"))
        folders = [r.folder for r in live.select(folder.alias("folder")).distinct().toLocalIterator()]
        if not folders:
            return self.spark.createDataFrame([], LANDED)
        return self._folders(folders)

    def _folders(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(LANDED).option("basePath", self.landing).parquet(*folders)

    def _visible(self, rows: DataFrame, entries: DataFrame, table: str | None = None) -> DataFrame:
        """Without rows of batches that were replaced after their folder was packed; there are rarely any."""
        if not self.log.has_snapshot(entries):
            return rows
        live = self.log.tables(entries)
        if table is not None:
            live = live.where(F.col("table") == table)
            entries = entries.where(F.col("table") == table)
        place = ["attempt", "table", BATCH]
        named = entries.where("kind = 'table'").select(*place).distinct()
        stale = named.join(live, place, "left_anti").join(live.select("attempt").distinct(), "attempt", "left_semi")
        if stale.isEmpty():
            return rows
        return rows.join(stale.withColumnRenamed("table", "route"), ["attempt", "route", BATCH], "left_anti").select(
            *LANDED.names)

    def read(self, table: str, with_batch: bool = False) -> DataFrame:
        """A form's table: its registered columns, NULL where a row lacks one."""
        entries = self.log.entries()
        return self.wide(self.landed(table, entries), self.columns(table, entries), (BATCH,) if with_batch else ())

    def tables(self) -> Iterator[tuple[str, DataFrame]]:
        """Every form table as of now; the log is read once."""
        entries = self.log.entries().checkpoint()
        for row in self.table_columns(entries).toLocalIterator():
            yield row.table, self.wide(self.landed(row.table, entries), row.columns)

    @staticmethod
    def wide(landed: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
        return landed.select(*[F.col("columns")[c.lower()].alias(c) for c in columns], *keep)

    def register_views(self) -> None:
        """A temporary view for every form table, for use in SQL."""
        for table, rows in self.tables():
            rows.createOrReplaceTempView(_quoted(table))

    # -- packing ---------------------------------------------------------------------------------------

    def compact(self, target_bytes: int = 128 << 20) -> int:
        """Pack folders that are smaller than ``target_bytes`` into files of about that size, table by table, and drop
        rows that are no longer visible; returns the number of folders packed. Readers keep what they see: the folders
        replaced stay until `vacuum`. Batches committed meanwhile, replays too, are not affected."""
        entries = self.log.entries().checkpoint()
        as_of = entries.agg(F.max("seq")).first()[0] or 0
        live = self.log.tables(entries).checkpoint()
        stored = self._stored(entries)
        sizes = stored.select("route", "attempt", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias(
            "size")).distinct().groupBy("route", "attempt").agg(F.sum("size").alias("size")) if not live.isEmpty() else None
        if sizes is None:
            return 0
        small = sizes.where(F.col("size") < target_bytes)
        order = Window.partitionBy("route").orderBy("size", "attempt")
        bins = small.withColumn("bin", F.floor((F.sum("size").over(order) - F.col("size")) / target_bytes))
        shared = F.count("*").over(Window.partitionBy("route", "bin"))
        plan = bins.withColumn("folders", shared).where("folders > 1").select("route", "attempt", "bin").checkpoint()
        packed = plan.count()
        if not packed:
            return 0
        new = f"c-{uuid.uuid4().hex}"
        moved = live.join(plan.withColumnRenamed("route", "table"), ["table", "attempt"])
        bins = plan.groupBy("route", "bin").agg(F.collect_list("attempt").alias("attempts"))
        if packed <= FEW_FOLDERS:
            self._pack_each(bins.collect(), entries, new)
        else:
            self._pack_all(self._visible(stored, entries).join(plan, ["route", "attempt"]), bins.count(), new)
        self.log.snapshot(as_of, entries, moved.select("batch_id", "version", "table", F.lit(new).alias("attempt"), "rows"))
        return packed

    def _pack_each(self, bins: list[Row], entries: DataFrame, new: str) -> None:
        """A task reads the folders of one bin, which have about a file's size together, and no row is shuffled; the bins
        of a table are one job."""
        tables: dict[str, list[DataFrame]] = {}
        for row in bins:
            rows = self._visible(self._folders([f"{self.landing}/attempt={a}/route={row.route}" for a in row.attempts]), entries, row.route)
            tables.setdefault(row.route, []).append(rows.select("message_id", BATCH, "columns").coalesce(1))

        def pack(table: str) -> None:
            self._write_packed(reduce(DataFrame.unionByName, tables[table]), f"{self.landing}/attempt={new}/route={table}")

        with ThreadPool(PACKING) as pool:
            pool.map(inheritable_thread_target(self.spark)(pack), tables)

    def _pack_all(self, rows: DataFrame, n_bins: int, new: str) -> None:
        """One job for many folders, the rows of a bin brought together."""
        rows = rows.repartition(n_bins, "route", "bin").select("message_id", BATCH, "columns", "route")
        self._write_packed(rows, f"{self.landing}/attempt={new}", "route")

    @staticmethod
    def _write_packed(rows: DataFrame, path: str, *by: str) -> None:
        rows.write.mode("overwrite").option("compression", PACKED).partitionBy(*by).parquet(path)

    def vacuum(self, older_than_seconds: float = 86_400.0) -> int:
        """Delete landing folders that the log does not name, if nothing changed in them for so long: attempts that
        failed, replaced batches, packed folders. Returns their number. A batch or reader must not take that long."""
        live = {f"attempt={r.attempt}" for r in self.log.tables().select("attempt").distinct().toLocalIterator()}
        return remove_older(self.spark, self.landing, live, older_than_seconds)

    # -- catalog ---------------------------------------------------------------------------------------

    def sync_catalog(self, changed: list[str]) -> None:
        """Make a batch known to the catalog, where there is one: its folders, in one statement for all tables, and the
        views of tables that got columns."""
        if not self.database:
            return
        landing, log = (f"{_quoted(self.database)}.{_quoted(t)}" for t in (LANDING_TABLE, LOG_TABLE))
        for name, schema, by, path in ((landing, LANDED, "attempt, route", self.landing), (log, COMMIT, "commit", self.log.path)):
            if not self.spark.catalog.tableExists(name):
                fields = [f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
                self.spark.sql(f"CREATE TABLE {name} ({', '.join(fields)}{', commit STRING' if by == 'commit' else ''}) USING parquet "
                               f"PARTITIONED BY ({by}) LOCATION {_text(path)}")
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            self.spark.catalog.refreshTable(name)
        for table in changed:
            columns = ", ".join(f"l.columns[{_text(c.lower())}] AS {_quoted(c)}" for c in self.columns(table))
            self.spark.sql(f"CREATE OR REPLACE VIEW {_quoted(self.database)}.{_quoted(table)} AS SELECT {columns}, l.{BATCH} "
                           f"FROM {landing} l JOIN ({LIVE.format(log=log)}) c ON l.attempt = c.attempt AND l.route = c.`table` "
                           f"AND l.{BATCH} = c.{BATCH} WHERE l.route = {_text(table)} AND c.`table` = {_text(table)}")
