import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import catalog
from formweave.config import IngestConfig, RetryConfig, ingest_config
from formweave.functions.crypto import EnvelopeCipher
from formweave.operators import evolve
from formweave.plans import publish as plan
from formweave.schemas import RULES
from formweave.session import shared_dir
from formweave.sinks import files
from formweave.sinks.tables import FormStore
from formweave.sources.messages import from_kafka, message_attributes, messages
from formweave.streaming import pipeline
from formweave.streaming.pipeline import APPEND_FAILED, IngestPipeline
from formweave.streaming.retry import with_retries

from conftest import KEK


def body(form, name="f"):
    meta = {"organization": "o", "team": "t", "version": "v", "formName": name}
    return json.dumps({"formData": form, "formMetaData": meta})


@pytest.fixture
def job(spark, cipher, tmp_path):
    def make(**options):
        config = IngestConfig(inputSubscription=str(tmp_path / "topic"), root=str(tmp_path / "root"), baseUrl="u/",
                              retry=RetryConfig((0.0, 0.0)), **options)
        return IngestPipeline(spark, config, cipher)
    return make


def test_batches_widen_tables_and_old_rows_read_null(job, message_of):
    run = job()
    run.process(message_of(("1", body({"b": 1, "a": 2})), ("2", body({"x": 1}, "My-Form"))), 0)
    run.process(message_of(("3", body({"a": 3, "A-c": None, "z z": "q"}))), 1)
    table = run.store.read("f")
    meta = ["formMetaData_formName", "formMetaData_organization", "formMetaData_team", "formMetaData_version"]
    assert table.columns == ["a", "b", *meta, "A_c", "zz"]
    assert sorted((r.a, r.b, r.A_c, r.zz) for r in table.collect()) == [("2", "1", None, None), ("3", None, "null", "q")]
    other = [r.table for r in run.store.registry().where("formName = 'My-Form'").select("table").distinct().collect()]
    assert len(other) == 1 and run.store.read(other[0]).first().x == "1"


def test_a_replayed_batch_leaves_no_duplicates(job, spark, message_of):
    run = job()
    batch = message_of(("1", body({"a": 1})), ("2", "bad"), ("3", body({"b": 1}, "g")))
    for _ in range(2):
        run.process(batch, 0)
    run.process(message_of(("4", body({"a": 1, "n": 2}))), 1)
    run.process(message_of(("4", body({"a": 1, "n": 2}))), 1)
    assert run.store.read("f").count() == 2 and run.store.read("g").count() == 1
    assert run.store.registry().count() == run.store.registry().select("table", "column").distinct().count() == 11
    assert spark.read.parquet(run.config.errors).count() == 1
    assert spark.read.parquet(run.config.archive).count() == 3
    assert run.counts[0] == {"messages": 3, "rejected": 1}


def test_spellings_that_differ_in_case_share_a_column(job, message_of):
    run = job()
    run.process(message_of(("1", body({"Name": 1})), ("2", body({"name": 2}))), 0)
    run.process(message_of(("3", body({"NAME": 3}))), 1)
    assert [c for c in run.store.read("f").columns if c.lower() == "name"] == ["Name"]
    assert sorted(r.Name for r in run.store.read("f").collect()) == ["1", "2", "3"]


def test_odd_column_names(job, message_of):
    run = job()
    run.process(message_of(("1", body({"a$b": 1, "x,y": 2, "é": 3, "p(q)": 4, "w;=": 5, "`t`": 6, "u/v": 7}))), 0)
    row = run.store.read("f").first()
    assert [row[c] for c in ("a$b", "x,y", "é", "p(q)", "w;=", "`t`", "u/v")] == list("1234567")


def test_a_table_takes_any_number_of_columns(job, message_of):
    run, width = job(), 400
    run.process(message_of(("1", body({f"c{i}": i for i in range(width)}))), 0)
    run.process(message_of(("2", body({f"d{i}": i for i in range(width)}))), 1)
    rows = run.store.read("f").where("c7 = '7' OR d399 = '399'").count()
    assert rows == 2 and len(run.store.columns("f")) >= 2 * width


def test_backlog_then_stream_then_a_lost_checkpoint(job, message_of, tmp_path):
    """Batches of a backlog, of a stream and of a stream that starts over do not replace one another."""
    run = job()
    run.process(message_of(("1", body({"old": 1})), ("b", "bad")), 0)
    files.publish(message_of(("2", body({"a": 2}))), run.config.inputSubscription)
    for _ in range(2):
        run.start(available_now=True).awaitTermination()
    assert {"old", "a"} <= set(run.store.columns("f"))
    assert sorted((r.old, r.a) for r in run.store.read("f").fillna("").collect()) == [("", "2"), ("1", "")]
    keys = [r.batch_id for r in run.store.read("f", with_batch=True).collect()]
    other = IngestPipeline(run.spark, ElsewhereConfig(run.config.inputSubscription, run.config.root), run.cipher)
    other.start(available_now=True).awaitTermination()
    assert sorted(r.a for r in run.store.read("f").fillna("").collect()) == ["", "2", "2"]
    assert len({*keys, *(r.batch_id for r in run.store.read("f", with_batch=True).collect())}) == 3


class ElsewhereConfig(IngestConfig):
    """The same job with a checkpoint that has been lost."""

    @property
    def checkpoint(self):
        return f"{self.root}/_new_checkpoint"


def test_a_repeat_that_succeeds_leaves_no_dead_letters(job, spark, message_of):
    run = job()
    append, batch = run.store.append, message_of(("1", body({"a": 1})))

    def failing(*_):
        raise RuntimeError("quota")

    run.store.append = failing
    run.process(batch, 0)
    assert run.store.read("f").count() == 0 and spark.read.parquet(run.config.dead_letter).count() == 1
    run.store.register_views()
    run.store.append = append
    run.process(batch, 0)
    assert run.store.read("f").count() == 1
    assert spark.read.parquet(run.config.dead_letter).count() == spark.read.parquet(run.config.errors).count() == 0


def test_failed_appends_end_as_errors_and_dead_letters(job, spark, cipher, message_of):
    run, tries = job(), []
    append = run.store.append

    def failing(rows, batch_id, attempt):
        if rows.where("route = 'f'").count():
            tries.append(attempt)
            raise RuntimeError("quota")
        append(rows, batch_id, attempt)

    run.store.append = failing
    run.process(message_of(("1", body({"a": 1})), ("2", body({"b": 1}, "g"))), 0)
    # Two tries for all tables, one for the table alone.
    assert len(tries) == 3 and run.store.read("g").count() == 1
    letter = spark.read.parquet(run.config.dead_letter).select("message_id", cipher.open("payload").cast("string"))
    assert [tuple(r) for r in letter.collect()] == [("1", body({"a": 1}))]
    error = spark.read.parquet(run.config.errors).where(F.col("description") == APPEND_FAILED).first()
    assert error.formName == "f" and error.errorFormData.startswith("u/forms/f/")


def test_hostile_form_names_stop_nothing(job, spark, message_of):
    run = job()
    names = ["f" * 300, "é" * 150, "a/b=c", "..", "f" * 5000]
    run.process(message_of(*((str(i), body({"a": i}, n)) for i, n in enumerate(names))), 0)
    assert run.counts[0] == {"messages": 5, "rejected": 0}
    assert sorted(r.formName for r in spark.read.parquet(run.config.archive).collect()) == sorted(names)
    tables = {r.formName: r.table for r in run.store.registry().select("formName", "table").distinct().collect()}
    assert [run.store.read(tables[n]).first().a for n in names] == ["0", "1", "2", "3", "4"]


def test_a_failing_catalog_loses_and_doubles_nothing(job, spark, message_of):
    def failing(changed):
        raise RuntimeError("catalog")

    spark.sql("CREATE DATABASE IF NOT EXISTS failing_db")
    run = job(dataSet="failing_db")
    run.store.sync_catalog = failing
    run.process(message_of(("1", body({"a": 1}))), 0)
    assert run.store.read("f").count() == 1 and run.store.lagging == {"f"}
    assert spark.read.parquet(run.config.errors).count() == 0


def test_a_form_with_most_rows_is_split_when_staged(job, spark, cipher):
    run = job()
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("message_id"),
        F.concat(F.lit('{"formData":{"a":"'), F.sha2(F.col("id").cast("string"), 512),
                 F.lit('"},"formMetaData":{"organization":"o","team":"t","version":"v","formName":"'),
                 F.when(F.col("id") % 10 == 0, F.concat(F.lit("f"), F.col("id") % 7)).otherwise("hot"),
                 F.lit('"}}')).alias("body")).repartition(8)
    keyed = cipher.with_data_key(rows, "message_id").select(
        "message_id", F.lit("2024-03-05").cast("timestamp").alias("publish_time"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        cipher.seal(F.encode("body", "UTF-8")).alias("payload"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        run.process(keyed, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    staged = spark.read.parquet(run.staged_path(0))
    files_of = {r.route: r.n for r in staged.groupBy("route").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("n")).collect()}
    # A small form may share its hash partition with the large one; all others stay whole.
    assert files_of.pop("hot") >= 4 and list(files_of.values()).count(1) >= 4
    assert run.store.read("hot").count() == 3600
    run.store.register_views()
    assert spark.sql("SELECT count(DISTINCT a) AS n FROM hot").first().n == 3600


def test_catalog_tables(job, spark, message_of):
    spark.sql("CREATE DATABASE IF NOT EXISTS forms_db")
    run = job(dataSet="forms_db")
    run.process(message_of(("1", body({"a": 1}))), 0)
    run.process(message_of(("2", body({"a": 2, "n-w": 3}))), 1)
    got = spark.sql("SELECT a, n_w, batch_id FROM forms_db.f ORDER BY a").collect()
    assert [tuple(r) for r in got] == [("1", None, 0), ("2", "3", 1)]
    spark.sql("DROP DATABASE forms_db CASCADE")


def test_stream_equals_batch_and_a_restart_adds_nothing(job, spark, message_of, tmp_path):
    run = job(maxFilesPerTrigger=1)
    for i in range(3):
        files.publish(message_of((f"{i}", body({"a": i, f"c{i}": 1})), (f"x{i}", "bad")), run.config.inputSubscription)
    for _ in range(2):
        run.start(available_now=True).awaitTermination()
    batch = IngestPipeline(spark, IngestConfig(run.config.inputSubscription, str(tmp_path / "batch")), run.cipher)
    batch.process(messages(spark, run.config.inputSubscription), 0)
    columns = sorted(batch.store.columns("f"))
    assert sorted(run.store.columns("f")) == columns
    rows = [sorted(map(repr, j.store.read("f").select(*columns).collect())) for j in (run, batch)]
    assert rows[0] == rows[1] and len(rows[0]) == 3
    assert spark.read.parquet(run.config.errors).count() == 3
    assert sum(c["messages"] for c in run.counts.values()) == 6


def test_rules_apply_within_the_job(job, spark, cipher, message_of):
    run = job()
    files.write_rules(spark.createDataFrame([("F", "a", "masking", "")], RULES), run.config.rules, 1)
    run.process(message_of(("1", body({"a": 1, "b": 2}))), 0)
    row = run.store.read("f").select(cipher.open_text("a").alias("a"), "b").first()
    assert (row.a, row.b) == ("1", "2")


def test_schema_union():
    assert evolve.schema_union(["a", "B"], ["b", "c", "C", "a"]) == (True, ["a", "B", "c"])
    assert evolve.schema_union(["a"], ["A"]) == (False, ["a"])


def test_store_reads_in_table_order(spark, tmp_path):
    store = FormStore(spark, str(tmp_path))
    found = spark.createDataFrame([("F", "f", "z", "z"), ("F", "f", "b", "b")],
                                  "formName string, table string, column string, column_key string")
    none = {"messages": 0, "rejected": 0}
    store.commit(0, none, found=found)
    store.commit(1, none, found=found.union(spark.createDataFrame([("F", "f", "A", "a")], found.schema)))
    assert store.columns("f") == ["b", "z", "A"]


def test_retry_waits():
    slept, tries = [], []

    def attempt():
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError

    assert with_retries(attempt, (20, 40, 60, 0), slept.append) and slept == [20, 40]

    def never():
        raise RuntimeError

    slept.clear()
    assert not with_retries(never, (20, 40, 60, 0), slept.append) and slept == [20, 40, 60, 0]


def test_publish(spark, cipher, tmp_path):
    requests = spark.createDataFrame(
        [("o", "t", "f", "v", '{"_sysA":1,"b":{"c":[1,null]},"_SYS":2}'), ("o", None, "f", "v", '{"b":"x"}'),
         ("o", "t", "f", "v", "{}"), ("o", "t", "f", "v", "[1]"), ("o", "t", "f", "v", "nope")],
        "organization string, team string, formName string, version string, body string")
    files.publish(plan.publishable(requests, cipher, ["_sys"]), str(tmp_path / "topic"))
    sent = messages(spark, str(tmp_path / "topic"))
    assert sent.select("message_id").distinct().count() == 3
    assert message_attributes(sent).count() == 0
    texts = sorted(r[0] for r in sent.select(cipher.open("payload").cast("string")).collect())
    meta = '"formMetaData":{"organization":"o","team":"t","version":"v","formName":"f"}'
    assert texts == sorted(["{}", '{"formData":{"b":{"c":[1,null]}},' + meta + "}",
                            '{"formData":{"b":"x"},"formMetaData":{"organization":"o","version":"v","formName":"f"}}'])
    assert plan.unreadable(requests).count() == 2


def test_kafka_records_as_messages(spark):
    rows = spark.sql("""SELECT cast('k' AS binary) AS key, cast('v' AS binary) AS value, 't' AS topic, 3 AS partition,
        7L AS offset, timestamp'2024-01-01 00:00:00' AS timestamp, 0 AS timestampType,
        array(named_struct('key', 'a', 'value', cast('b' AS binary))) AS headers
        UNION ALL SELECT null, cast('w' AS binary), 't', 3, 8L, timestamp'2024-01-01 00:00:00', 0, null""")
    got = from_kafka(rows).orderBy("message_id").collect()
    assert [(r.message_id, r.attributes, bytes(r.payload)) for r in got] == [
        ("t-3-7", {"a": "b"}, b"v"), ("t-3-8", {}, b"w")]


def test_shared_folder_is_the_sessions_or_a_local_one():
    class Context:
        master, made = "spark://host", None

        def getCheckpointDir(self):
            return self.made

        def setCheckpointDir(self, path):
            self.made = path

    class Session:
        def __init__(self, configured):
            self.sparkContext, self.conf = Context(), self
            self.configured = configured

        def get(self, _, default):
            return self.configured or default

    assert shared_dir(Session("/shared")) == "/shared"
    with pytest.raises(RuntimeError):
        shared_dir(Session(None))
    local = Session(None)
    local.sparkContext.master = "local[2]"
    assert shared_dir(local) == shared_dir(local) == local.sparkContext.made


def test_options():
    config = ingest_config(["--inputSubscription=topic", "--root=/x", "--keyId=k2", "--waits=1,2", "--parallelForms=5",
                            "--startingOffsets=earliest"])
    assert config.keys.keyId == "k2" and config.retry.waits == (1.0, 2.0) and config.parallelForms == 5
    assert config.extra == {"startingOffsets": "earliest"}
    with pytest.raises(ValueError):
        ingest_config(["--root=/x"])


def test_each_batch_rotates_its_data_keys(spark, job, message_of):
    run = job()
    files.write_rules(spark.createDataFrame([("f", "a", "REDACTION", "")], RULES), run.config.rules, 1)
    run.cipher = EnvelopeCipher(spark, {KEK: bytes(range(32))}, KEK, 1)
    for batch in range(2):
        run.process(message_of((str(batch), body({"a": 1}))), batch)
    assert len({r.a[:80] for r in run.store.read("f").collect()}) == 2


def test_whole_rows_are_shuffled_only_where_that_saves_files(job, message_of, monkeypatch):
    """Input of partitions enough is staged as it is dealt; rows of more folders than FOLDERS come together."""
    run = job(inputPartitions=2)
    batch = message_of(*((str(n), body({"a": n}, f"f{n % 3}")) for n in range(40)))

    def counted(path):
        return len({f.name for f in path.rglob("*.parquet")}), len(list(path.rglob("*.parquet")))

    def written(batch_id):
        (attempt,) = run.store.log.tables().where(f"batch_id = {batch_id}").select("attempt").distinct().collect()
        return Path(f"{run.store.landing}/attempt={attempt.attempt}")

    monkeypatch.setattr(pipeline, "FULL_TASK", 10)
    run.process(batch.repartition(4), 0)
    assert counted(Path(run.staged_path(0)))[1] == 4
    assert run.store.table_counts().agg(F.sum("rows")).first()[0] == 40
    few = counted(written(0))[1]
    monkeypatch.setattr(pipeline, "FOLDERS", 2)
    run.process(batch.repartition(4), 1)
    assert counted(written(1))[1] == 3 <= few
    assert run.store.read("f0").count() == 28


def test_parts_of_a_topic_are_files_of_bounded_tasks(spark):
    path = catalog._topic(spark, "/root/testdata/sf0.001", 2)
    times = [r.t for r in messages(spark, path).groupBy(F.input_file_name()).agg(F.max("publish_time").alias("t")).collect()]
    assert len(times) > catalog.PART_FILES
