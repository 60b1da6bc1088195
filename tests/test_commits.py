"""What readers see: whole batches in any order, packed folders, and the number of jobs of a batch."""

import pytest
from pyspark.sql import functions as F

from formweave.config import IngestConfig, RetryConfig
from formweave.operators import evolve
from formweave.sinks import files, tables
from formweave.sinks.tables import FormStore
from formweave.streaming.pipeline import IngestPipeline

from test_pipeline import body


@pytest.fixture
def job(spark, cipher, tmp_path):
    def make(name="root", **options):
        config = IngestConfig(inputSubscription=str(tmp_path / "topic"), root=str(tmp_path / name), baseUrl="u/",
                              retry=RetryConfig((0.0, 0.0)), **options)
        return IngestPipeline(spark, config, cipher)
    return make


def seen(store, table="f"):
    return sorted(repr({k: v for k, v in r.asDict().items() if v is not None}) for r in store.read(table).collect())


def test_stream_backlogs_and_replays_in_any_order(job, message_of):
    """The same batches in two orders, one with replays: equal tables, and columns registered once."""
    old = message_of(("1", body({"old": 1, "a": 0})), ("b", "bad"))
    older = message_of(("0", body({"oldest": 1}, "g")), ("9", body({"a": 9})))
    tables = []
    for name, first in (("x", True), ("y", False)):
        run = job(name)
        if first:
            files.publish(message_of(("2", body({"a": 2, "new": 3}))), run.config.inputSubscription)
            run.start(available_now=True).awaitTermination()
        run.backlog(old, "2023/old")
        run.backlog(older, "2022")
        if not first:
            run.start(available_now=True).awaitTermination()
            run.backlog(old, "2023/old")
        run.process(message_of(("7", body({"late": 1}))), 0)
        run.process(message_of(("7", body({"late": 1}))), 0)
        registry = run.store.registry()
        assert registry.count() == registry.select("table", F.lower("column")).distinct().count()
        positions = registry.where("table = 'f'").select("position").collect()
        assert sorted(r.position for r in positions) == list(range(len(positions)))
        assert sum(c["messages"] for c in run.counts.values()) == 6
        tables.append((seen(run.store), seen(run.store, "g")))
    assert [t for f, _ in tables for t in (len(f),)] == [4, 4]
    assert tables[0] == tables[1]


def test_what_is_not_committed_is_not_seen(job, message_of, spark):
    run = job()
    run.process(message_of(("1", body({"a": 1}))), 0)
    before = seen(run.store)
    commit = run.store.commit

    def crash(*_, **__):
        raise KeyboardInterrupt

    run.store.commit = crash
    with pytest.raises(KeyboardInterrupt):
        run.process(message_of(("2", body({"a": 2, "b": 2}))), 1)
    assert seen(run.store) == before and "b" not in run.store.columns("f")
    run.store.commit = commit
    reader = run.store.read("f")
    run.process(message_of(("2", body({"a": 2, "b": 2}))), 1)
    assert len(seen(run.store)) == 2 and reader.count() == 1
    assert run.store.vacuum(0.0) == 1 and len(seen(run.store)) == 2


def small_batches(run, message_of, first, last):
    for n in range(first, last):
        run.process(message_of((str(n), body({"a": n, f"c{n % 3}": 1})), (f"g{n}", body({"x": n}, "g"))), n)


def test_packing_keeps_rows_and_bounds_files(job, message_of, spark):
    run = job()
    small_batches(run, message_of, 0, 5)
    before, reader = (seen(run.store), seen(run.store, "g")), run.store.read("f")
    columns, counts = run.store.columns("f"), run.counts
    assert run.store.compact() == 10
    assert (seen(run.store), seen(run.store, "g")) == before
    assert run.store.landed().select(F.col("_metadata.file_path")).distinct().count() == 2
    assert run.store.columns("f") == columns and run.counts == counts
    assert {(r.table, r.batches, r.rows) for r in run.store.table_counts().collect()} == {("f", 5, 5), ("g", 5, 5)}
    # A reader of before is undisturbed until old folders are removed.
    assert reader.count() == 5
    assert run.store.compact() == 0
    # A batch that was packed is replaced, with a new column; another one comes.
    run.process(message_of(("3", body({"a": "new", "z": 1}))), 3)
    small_batches(run, message_of, 5, 6)
    now = seen(run.store)
    assert len(now) == 6 and sum("'new'" in r for r in now) == 1 and len(seen(run.store, "g")) == 5
    assert run.store.columns("f")[-1] == "z"
    assert run.store.compact() and seen(run.store) == now and len(seen(run.store, "g")) == 5
    assert run.store.vacuum(0.0) > 0
    assert seen(run.store) == now and FormStore(spark, run.config.root).read("f", with_batch=True).count() == 6


def test_small_targets_give_several_files(job, message_of):
    run = job()
    small_batches(run, message_of, 0, 5)
    rows = run.store.landed().select("_metadata.file_path", "_metadata.file_size").distinct().collect()
    run.store.compact(target_bytes=3 * max(r.file_size for r in rows))
    assert 3 <= run.store.landed().select(F.col("_metadata.file_path")).distinct().count() <= 5
    assert len(seen(run.store)) == 5


@pytest.mark.parametrize("few", [64, 0])
def test_few_folders_are_packed_without_a_shuffle(job, message_of, monkeypatch, few):
    """Bin by bin, or by one shuffle beyond so many folders: the same rows."""
    run = job()
    small_batches(run, message_of, 0, 3)
    before = seen(run.store), seen(run.store, "g")
    monkeypatch.setattr(tables, "FEW_FOLDERS", few, raising=False)
    dealt, kind = [], type(run.store.landed())
    repartition = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda self, *by: dealt.append(by) or repartition(self, *by))
    assert run.store.compact() == 6
    assert bool(dealt) == (few == 0)
    assert (seen(run.store), seen(run.store, "g")) == before


def test_topics_are_packed(message_of, tmp_path):
    files.publish(message_of(("1", body({"a": 1}))), str(tmp_path / "topic"))
    assert [f for f in (tmp_path / "topic").glob("*.parquet")] == [f for f in (tmp_path / "topic").glob("*.zstd.parquet")]


def test_table_rows_are_opened_without_a_shuffle(job, message_of):
    from checks.catalog import _table_rows

    run = job()
    small_batches(run, message_of, 0, 2)
    rows = _table_rows(run)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.table for r in rows.collect()) == ["f", "f", "g", "g"]


def test_a_commit_during_packing_is_kept(job, message_of):
    """A replay and a new batch that commit between the reading of the log and the snapshot."""
    run = job()
    small_batches(run, message_of, 0, 3)
    snapshot = run.store.log.snapshot

    def late(*args):
        run.process(message_of(("1", body({"a": "again"}))), 1)
        small_batches(run, message_of, 3, 4)
        return snapshot(*args)

    run.store.log.snapshot = late
    run.store.compact()
    got = seen(run.store)
    assert len(got) == 4 and sum("'again'" in r for r in got) == 1
    assert len(seen(run.store, "g")) == 3 and len(run.counts) == 4


def test_catalog_views_follow_packing(job, spark, message_of):
    spark.sql("CREATE DATABASE IF NOT EXISTS packed_db")
    run = job(dataSet="packed_db")
    small_batches(run, message_of, 0, 3)
    run.process(message_of(("1", body({"a": "it's"}))), 1)
    run.store.compact()
    run.store.sync_catalog([])
    got = spark.sql("SELECT a, batch_id FROM packed_db.f ORDER BY batch_id").collect()
    assert [tuple(r) for r in got] == [("0", 0), ("it's", 1), ("2", 2)]
    spark.sql("DROP DATABASE packed_db CASCADE")


def jobs_of(spark, group, run, batch):
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", group)
    run.process(batch, 0)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_depend_on_forms(job, spark, message_of):
    """As many jobs for 200 forms as for 2, but that the listing of many folders is a job, too."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        few = jobs_of(spark, "few", job("few"), message_of(*((str(i), body({"a": i}, f"f{i % 2}")) for i in range(200))))
        many = jobs_of(spark, "many", job("many"), message_of(*((str(i), body({"a": i}, f"f{i}")) for i in range(200))))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert many - few in (0, 1)


def test_repeated_deliveries_give_single_rows(job, spark, message_of):
    """A topic that delivers messages twice, in one file and across a restart."""
    run = job(redeliverySeconds=3600)
    twice = message_of(("1", body({"a": 1})), ("1", body({"a": 1})), ("2", body({"a": 2})))
    files.publish(twice, run.config.inputSubscription)
    run.start(available_now=True).awaitTermination()
    files.publish(message_of(("2", body({"a": 2})), ("3", body({"a": 3}))), run.config.inputSubscription)
    files.publish(message_of((None, body({"a": 0})), (None, body({"a": 0}))), run.config.inputSubscription)
    job(redeliverySeconds=3600).start(available_now=True).awaitTermination()
    assert sorted(r.a for r in run.store.read("f").collect()) == ["0", "0", "1", "2", "3"]


def test_columns_of_a_batch_are_made_distinct_by_hashing(spark):
    """Spellings of all rows are not sorted: the least of them is sought among the distinct ones only."""
    rows = spark.createDataFrame([("F", "f", {"B": "1", "a": "2"}), ("F", "f", {"b": "3"}), ("G", "g", {"A": "4"}), ("F", "f", None)],
                                 "formName string, route string, columns map<string,string>")
    found = evolve.batch_columns(rows)
    assert sorted(tuple(r) for r in found.collect()) == [("F", "f", "a", "a"), ("F", "f", "b", "B"), ("G", "g", "a", "A")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and plan.index("min(") < plan.index("RepartitionByExpression")
