"""The registered queries. Each reads whole tables of `sf_dir`; its SQL twin, where SQL can say the same, is
in `checks.oracle` under the same name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from formweave import jobs
from formweave.config import IngestConfig, PublishConfig, RetryConfig
from formweave.functions import declared, jsonvals, text
from formweave.functions.crypto import EnvelopeCipher
from formweave.operators import counts, deid, evolve, flatten, parse, records, rules
from formweave.operators.route import accepted, only, rejected
from formweave.plans import publish as publish_plan
from formweave.plans.ingest import stage
from formweave.plans.rule_load import load_rules
from formweave.session import fresh_dir, spread
from formweave.sinks import files
from formweave.sources import archive as archive_source
from formweave.sources import messages as message_source
from formweave.sources import rules as rule_source
from formweave.streaming.pipeline import IngestPipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DRIFT = "2024-01-15 00:00:00"
# Files of one part of a topic in order of time: no task has all of a part.
PART_FILES = 8


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# ---- shared steps ------------------------------------------------------------------------------------------


def _read(spark: SparkSession, sf: str, sql: str = fx.MESSAGES) -> DataFrame:
    """Messages in the clear, parsed and judged."""
    return parse.read_forms(fx.bodies(spark, sf, sql))


def _parsed(spark: SparkSession, sf: str, sql: str = fx.MESSAGES) -> DataFrame:
    rows = parse.parse_bodies(fx.bodies(spark, sf, sql))
    return parse.with_metadata(rows).where("is_json")


def _columns(spark: SparkSession, sf: str, sql: str = fx.MESSAGES) -> DataFrame:
    """Accepted messages with their columns, nothing sealed."""
    rows = accepted(flatten.with_columns_map(_read(spark, sf, sql)),
                    "message_id", "publish_time", "formName", "columns")
    return rows.withColumn("route", text.table_name("formName"))


def _sealed_forms(spark: SparkSession, sf: str, only: tuple[str, ...] = rules.TECHNIQUES):
    """Messages with sealed values, and the cipher that opens them. `only` keeps the rules of some techniques."""
    cipher = fx.cipher(spark)
    chosen = fx.rules(spark, sf).where(F.upper("dlpTechnique").isin(*only))
    forms = accepted(_read(spark, sf), "message_id", "formName", "values", "error").withColumn("plain", F.col("values"))
    return deid.deidentify(forms, rules.rules_by_form(chosen), cipher), cipher


def _pairs(rows: DataFrame, column: str, *keep: str) -> DataFrame:
    return rows.select(*keep, F.explode(column).alias("key", "value"))


def _joined(names: Column) -> Column:
    return F.array_join(F.array_sort(names), "|")


def _topic(spark: SparkSession, sf: str, parts: int | None = None) -> str:
    """The messages as a topic folder; with `parts`, as that many times PART_FILES files in order of time."""
    path = fresh_dir(spark, "topic")
    files.publish(fx.sealed(spark, sf, fx.cipher(spark), parts=parts and parts * PART_FILES), path)
    return path


def _split_topic(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The messages as two topics: before and from the day a new column appears."""
    early, late = fresh_dir(spark, "topic"), fresh_dir(spark, "topic")
    sealed = fx.sealed(spark, sf, fx.cipher(spark))
    is_late = F.col("publish_time") >= F.lit(DRIFT).cast("timestamp")
    files.publish(sealed.where(~is_late), early)
    files.publish(sealed.where(is_late), late)
    return early, late


def _pipeline(spark: SparkSession, sf: str, topic: str, with_rules: bool = True, **options) -> IngestPipeline:
    config = IngestConfig(inputSubscription=topic, root=fresh_dir(spark, "ingest"), baseUrl=fx.BASE_URL,
                          bucketName=fx.BUCKET, retry=RetryConfig((0.0, 0.0, 0.0, 0.0)),
                          inputPartitions=spark.sparkContext.defaultParallelism, **options)
    if with_rules:
        files.write_rules(fx.rules(spark, sf), config.rules, 1)
    return IngestPipeline(spark, config, fx.cipher(spark))


def _ingested(spark: SparkSession, sf: str, **options) -> IngestPipeline:
    """Everything ingested as two batches: before and from the day a new column appears."""
    topic = _topic(spark, sf)
    job = _pipeline(spark, sf, topic, **options)
    messages = message_source.messages(spark, topic)
    late = F.col("publish_time") >= F.lit(DRIFT).cast("timestamp")
    job.process(messages.where(~late), 0)
    job.process(messages.where(late), 1)
    return job


def _digest(rows: DataFrame, names: list[str], cells: Column) -> DataFrame:
    """Per row the names of its cells and a digest of names and values, in order of name; NULL cells left out."""
    sorted_cells = F.sort_array(F.filter(cells, lambda c: c["value"].isNotNull()))
    texts = F.transform("cells", lambda c: F.concat(c["name"], F.lit("="), c["value"]))
    return rows.select(*names, sorted_cells.alias("cells")).select(
        *names, F.array_join(F.col("cells")["name"], "|").alias("names"),
        F.md5(F.encode(F.array_join(texts, "\n"), "UTF-8")).alias("row_md5"))


def _cells(columns: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("value")) for c in columns])


def _opened(cipher: EnvelopeCipher, rows: DataFrame) -> DataFrame:
    """`cells` with every value opened as often as it was sealed, in its place."""
    opened = cipher.with_opened(rows, F.col("cells")["value"], "opened", len(rules.TECHNIQUES))
    cells = F.zip_with("cells", "opened", lambda c, o: F.struct(c["name"].alias("name"), o["value"].alias("value")))
    return opened.withColumn("cells", cells).drop("opened")


def _table_rows(job: IngestPipeline) -> DataFrame:
    """Rows of every form table, with the columns the job found, every value opened as often as it was sealed."""
    parts = []
    for table, wide in job.store.tables():
        cells = F.filter(_cells(wide.columns), lambda c: c["value"].isNotNull())
        opened = _opened(job.cipher, wide.select(F.lit(table).alias("table"), cells.alias("cells")))
        parts.append(_digest(opened, ["table"], F.col("cells")))
    return reduce(DataFrame.unionByName, parts)


# ---- sources -----------------------------------------------------------------------------------------------


@query
def src_messages(spark, sf):
    rows = message_source.messages(spark, _topic(spark, sf))
    opened = parse.open_messages(rows, fx.cipher(spark))
    return opened.select("message_id", F.unix_micros("publish_time").alias("publish_us"),
                         F.col("attributes")["origin"].alias("origin"), "body")


@query
def src_rules_csv(spark, sf):
    path = fresh_dir(spark, "rule-csv")
    fx.write_rule_csv(spark, sf, path)
    rows = rule_source.rule_csv(spark, path)
    fits = F.col("_corrupt").isNull()
    cells = [F.when(fits, F.coalesce(c, F.lit(""))).alias(c) for c in (*rules.RULE, "addnl_info")]
    return rows.select(*cells, F.col("_corrupt").alias("bad_line"))


@query
def src_rules(spark, sf):
    path = fresh_dir(spark, "rules")
    files.write_rules(fx.rules(spark, sf), path, 1)
    return rule_source.current_rules(spark, path)


@query
def src_form_schema(spark, sf):
    job = _ingested(spark, sf)
    return job.store.registry().select("formName", "table", "column", F.col("batch_id").alias("since"))


@query
def build_form_records(spark, sf):
    return records.form_records(fx.run(spark, sf, fx.REQUESTS)).select("message_id", "record")


# ---- sinks -------------------------------------------------------------------------------------------------


@query
def publish_messages(spark, sf):
    cipher, topic = fx.cipher(spark), fresh_dir(spark, "topic")
    requests = spread(fx.run(spark, sf, fx.REQUESTS))
    files.publish(publish_plan.publishable(requests, cipher, text.prefix_list(fx.PREFIXES)), topic)
    return parse.open_messages(message_source.messages(spark, topic), cipher).select("message_id", "body")


@query
def topic_replay(spark, sf):
    """A topic of numbered files, written in two parts, the first of them twice under its key, and streamed with a
    restart between the parts: each message has one place in the topic and comes once."""
    cipher, topic, out = fx.cipher(spark), f"log:{fresh_dir(spark, 'topic')}", fresh_dir(spark, "streamed")
    sealed = publish_plan.publishable(spread(fx.run(spark, sf, fx.REQUESTS)), cipher, text.prefix_list(fx.PREFIXES)).checkpoint()
    late = F.crc32(F.col("message_id").cast("binary")) % 3 == 0
    place = fresh_dir(spark, "progress")
    for part, key in ((~late, "early"), (~late, "early"), (late, "late")):
        files.publish(sealed.where(part), topic, writeId=key, partitions="3")
        stream = message_source.message_stream(spark, topic).writeStream.format("parquet").option("checkpointLocation", place)
        stream.trigger(availableNow=True).start(out).awaitTermination()
    places = spark.read.format("topic_log").load(topic[len("log:"):])
    held = places.groupBy("message_id").agg(F.count_distinct("partition", "offset").alias("places"))
    opened = parse.open_messages(message_source.messages(spark, out), cipher)
    return opened.groupBy("message_id", "body").agg(F.count("*").alias("deliveries")).join(held, "message_id")


@query
def publish_retry(spark, sf):
    """Publishing that fails three times, then succeeds: each message once, after the waits of the topic client."""
    cipher, topic, waits = fx.cipher(spark), fresh_dir(spark, "topic"), []
    requests = fx.run(spark, sf, fx.REQUESTS)
    sealed = publish_plan.publishable(requests, cipher, text.prefix_list(fx.PREFIXES)).checkpoint()

    def attempt():
        if len(waits) < 3:
            raise RuntimeError("no broker")
        files.publish(sealed, topic)

    tries = jobs.send(attempt, PublishConfig(topic), sleep=waits.append, clock=lambda: sum(waits))
    opened = parse.open_messages(message_source.messages(spark, topic), cipher)
    return opened.select("message_id", "body", F.lit(tries).alias("tries"), F.lit(round(sum(waits), 3)).alias("waited"))


@query
def publish_rejects(spark, sf):
    return publish_plan.unreadable(fx.run(spark, sf, fx.REQUESTS)).select("message_id", "error")


@query
def archive_paths(spark, sf):
    rows = accepted(_read(spark, sf), "message_id", "formName", "publish_time")
    url = text.archive_url(fx.BASE_URL, fx.BUCKET, "formName", "publish_time", "message_id")
    return rows.select("message_id", url.alias("file_url"))


@query
def archive_objects(spark, sf):
    job = _ingested(spark, sf)
    stored = spark.read.parquet(job.config.archive)
    return parse.open_messages(stored, job.cipher).select(
        "message_id", F.col("formName").cast("string").alias("formName"), F.col("month").cast("string").alias("month"),
        F.col("day").cast("int").alias("day"), "file_url", "body")


@query
def archive_lookup(spark, sf):
    """The payloads that the URLs of all error rows lead to, opened: those of a form whose appends always fail."""
    job = _failing_purchases(spark, sf)
    found = archive_source.payloads_of(spark.read.parquet(job.config.errors), archive_source.archived(spark, job.config.archive))
    return parse.open_messages(found, job.cipher).select("message_id", "file_url", "body")


@query
def hostile_names(spark, sf):
    """Forms named by whole document texts: every message is archived, in a folder any file system takes."""
    cipher, path = fx.cipher(spark), fresh_dir(spark, "archive")
    messages = fx.sealed(spark, sf, cipher, fx.HOSTILE)
    staged = stage(messages, fx.rules(spark, sf), cipher, fx.BASE_URL, fx.BUCKET)
    kept = accepted(staged, "message_id", "file_url", "payload", "key_name", "formName", "month", "day")
    files.archive(kept, path, 0)
    stored = spark.read.parquet(path)
    return stored.select("message_id", F.md5(F.encode("formName", "UTF-8")).alias("form_md5"),
                         (F.octet_length("form") <= 255).alias("short_folder"))


@query
def form_table_create(spark, sf):
    job = _ingested(spark, sf)
    return job.store.registry(before=1).select("formName", "table", "column", "position")


@query
def form_table_evolve(spark, sf):
    job = _ingested(spark, sf)
    return job.store.registry().select("table", "column", "position")


@query
def form_table_append(spark, sf):
    return _table_rows(_ingested(spark, sf))


@query
def backlog_then_stream(spark, sf):
    """A backlog handed over as one batch, then a stream into the same tables: all rows stay."""
    backlog, topic = _split_topic(spark, sf)
    job = _pipeline(spark, sf, topic)
    job.process(message_source.messages(spark, backlog), 0)
    job.start(available_now=True).awaitTermination()
    return _table_rows(job)


@query
def stream_then_backlog(spark, sf):
    """A stream first, then an older backlog under batch number 0 into the same tables."""
    early, late = _split_topic(spark, sf)
    job = _pipeline(spark, sf, late)
    job.start(available_now=True).awaitTermination()
    job.process(message_source.messages(spark, early), 0)
    return _table_rows(job)


@query
def replayed_batches(spark, sf):
    """Two backlogs around a stream, packed folders, then a late replay of the first backlog."""
    early, late = _split_topic(spark, sf)
    job = _pipeline(spark, sf, late)
    backlog = message_source.messages(spark, early)
    even = F.pmod(F.xxhash64("message_id"), F.lit(2)) == 0
    job.backlog(backlog.where(even), "even")
    job.start(available_now=True).awaitTermination()
    job.backlog(backlog.where(~even), "odd")
    job.store.compact()
    job.backlog(backlog.where(even), "even")
    return _table_rows(job)


@query
def committed_reads(spark, sf):
    """A later batch has written all its rows but is not committed: readers see the first batch, its columns alone."""
    early, late = _split_topic(spark, sf)
    job = _pipeline(spark, sf, late)
    job.process(message_source.messages(spark, early), 0)
    commit, job.store.commit = job.store.commit, lambda *_, **__: None
    job.process(message_source.messages(spark, late), 1)
    job.store.commit = commit
    return _table_rows(job)


@query
def compacted_tables(spark, sf):
    """A stream of many small batches, packed: the same rows, from one folder."""
    job = _pipeline(spark, sf, _topic(spark, sf, 6), maxFilesPerTrigger=PART_FILES)
    job.start(available_now=True).awaitTermination()
    job.store.compact()
    return _table_rows(job)


@query
def table_counts(spark, sf):
    """Rows of every table as the log of commits has them, after packing."""
    job = _ingested(spark, sf)
    job.store.compact()
    return job.store.table_counts()


@query
def repeated_deliveries(spark, sf):
    """A topic that delivers every message twice, the second time in another file: single rows, across a restart."""
    first, second = fresh_dir(spark, "topic"), _topic(spark, sf, 3)
    files.publish(message_source.messages(spark, second), first)
    job = _pipeline(spark, sf, first, redeliverySeconds=86_400 * 366)
    job.start(available_now=True).awaitTermination()
    files.publish(message_source.messages(spark, second), first)
    IngestPipeline(spark, job.config, job.cipher).start(available_now=True).awaitTermination()
    return _table_rows(job)


@query
def error_rows(spark, sf):
    bad = rejected(_read(spark, sf), "formName", "error").withColumn("file_url", F.lit(None).cast("string"))
    rows = files.error_rows(bad)
    return rows.select("formName", "errorFormData", "description",
                       F.col("timeStamp").isNotNull().alias("has_time"))


def _failing_purchases(spark: SparkSession, sf: str) -> IngestPipeline:
    """All messages ingested while appends to one form's table always fail."""
    job = _pipeline(spark, sf, _topic(spark, sf))
    append = job.store.append

    def failing(rows, batch_id, attempt):
        if not rows.where("route = 'purchase'").isEmpty():
            raise RuntimeError("no quota")
        append(rows, batch_id, attempt)

    job.store.append = failing
    job.process(message_source.messages(spark, job.config.inputSubscription), 0)
    return job


@query
def dead_letter(spark, sf):
    """Appends to one form's table always fail; its messages must all end as error rows and dead letters."""
    job = _failing_purchases(spark, sf)
    letters = parse.open_messages(spark.read.parquet(job.config.dead_letter), job.cipher)
    letters = letters.select("message_id", F.lit("").alias("errorFormData"), "body")
    errors = spark.read.parquet(job.config.errors).where(F.col("formName") == "purchase").where(
        F.col("errorFormData") != "")
    return letters.unionByName(errors.select(
        F.lit("").alias("message_id"), "errorFormData", F.col("description").alias("body")))


@query
def error_table(spark, sf):
    job = _ingested(spark, sf)
    return (spark.read.parquet(job.config.errors).groupBy("formName", "errorFormData", "description")
            .agg(F.count(F.lit(1)).alias("n")))


# ---- projections, filters and routing ----------------------------------------------------------------------


@query
def drop_prefixed_fields(spark, sf):
    rows = records.form_records(fx.run(spark, sf, fx.REQUESTS), text.prefix_list(fx.PREFIXES))
    return rows.where(F.col("record").isNotNull()).select("message_id", "record")


@query
def publish_empty_guard(spark, sf):
    rows = records.form_records(fx.run(spark, sf, fx.REQUESTS))
    return rows.where(F.col("record") == records.EMPTY_RECORD).select("message_id", "record")


@query
def extract_metadata(spark, sf):
    return _parsed(spark, sf, fx.RESERVED).select("message_id", "formName", "organization", "team", "version")


@query
def validate_headers(spark, sf):
    return _parsed(spark, sf).select("message_id", parse.header_error().alias("problem"))


@query
def validate_body(spark, sf):
    return _parsed(spark, sf).select("message_id", parse.body_error().alias("problem"))


@query
def merge_metadata(spark, sf):
    """The metadata replaces a form field of the reserved name; nested metadata flattens too."""
    return _pairs(_columns(spark, sf, fx.RESERVED), "columns", "message_id")


@query
def drop_reserved(spark, sf):
    rows = accepted(_read(spark, sf, fx.RESERVED), "message_id", "values")
    return rows.select("message_id", _joined(F.map_keys("values")).alias("names"))


@query
def stringify_values(spark, sf):
    return _pairs(accepted(_read(spark, sf), "message_id", "values"), "values", "message_id")


@query
def exact_numbers(spark, sf):
    """Numbers of 41 digits, with trailing zeros, beyond a double, minus zero, and nested: as they were written."""
    return _pairs(accepted(_read(spark, sf, fx.NUMBERS), "message_id", "values"), "values", "message_id")


@query
def exact_number_records(spark, sf):
    """The same numbers in the records that are published."""
    names = ("long", "cents", "tiny", "huge", "minus")
    return records.form_records(fx.run(spark, sf, fx.NUMBER_REQUESTS)).select(
        "message_id", *[F.regexp_extract("record", f'"{n}":([^,}}]*)', 1).alias(n) for n in names],
        F.regexp_extract("record", r'"deep":([^\]]*)', 1).alias("deep"))


@query
def flatten_live(spark, sf):
    return _pairs(_columns(spark, sf), "columns", "message_id", "formName")


@query
def flatten_deep(spark, sf):
    return _pairs(flatten.flatten_json(fx.run(spark, sf, fx.DEEP), "doc"), "flat", "id")


@query
def flatten_spread(spark, sf):
    """The same documents, every object and array of more than 64 bytes exploded over the tasks, level by level."""
    rows = flatten.flatten_rows(fx.run(spark, sf, fx.DEEP), "doc", "id", spread_bytes=64)
    return rows.select("id", F.col("path").alias("key"), "value")


@query
def normalise_names(spark, sf):
    rows = fx.table(spark, sf, "documents")
    return rows.select("doc_id", F.md5(F.encode(text.column_name("text"), "UTF-8")).alias("name_md5"))


@query
def pivot_form_columns(spark, sf):
    """Every form's messages as rows of the columns that the form's messages have."""
    path = fresh_dir(spark, "staged")
    rows = _columns(spark, sf)
    # Parsed and written once, by form; each form's branch reads its own folder.
    rows.select("message_id", "formName", "columns", "route").write.partitionBy("route").parquet(path)
    rows = spark.read.schema(rows.select("message_id", "formName", "columns", "route").schema).parquet(path)
    found = evolve.batch_columns(rows).groupBy("table").agg(F.array_sort(F.collect_list("column")).alias("columns"))
    parts = []
    for form in found.collect():
        wide = evolve.wide_rows(rows.where(F.col("route") == form.table), form.columns, keep=("message_id",))
        parts.append(_digest(wide.withColumn("table", F.lit(form.table)), ["table", "message_id"], _cells(form.columns)))
    return reduce(DataFrame.unionByName, parts)


@query
def rules_csv_valid(spark, sf):
    path = fresh_dir(spark, "rule-csv")
    fx.write_rule_csv(spark, sf, path)
    rows = rule_source.rule_csv(spark, path).where(rules.is_valid_row())
    return rows.groupBy(*rules.RULE, F.coalesce("addnl_info", F.lit("")).alias("addnl_info")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def rules_csv_action(spark, sf):
    path = fresh_dir(spark, "rule-csv")
    fx.write_rule_csv(spark, sf, path)
    changes = rules.csv_changes(rule_source.rule_csv(spark, path))
    return changes.groupBy(*rules.RULE, "action").agg(F.count(F.lit(1)).alias("n"))


@query
def active_rules(spark, sf):
    return rules.active_rules(fx.rules(spark, sf)).groupBy(*rules.RULE, "addnl_info").agg(F.count(F.lit(1)).alias("n"))


@query
def rules_active_lookup(spark, sf):
    """Per form and field, the rules the loader takes for active."""
    return fx.rules(spark, sf).groupBy(*rules.KEY).agg(
        F.count_if(rules.is_active_for_loader()).alias("active"), F.count(F.lit(1)).alias("rows"))


@query
def rules_by_technique(spark, sf):
    marks = [F.count_if(rules.is_technique(t)).alias(t.lower()) for t in rules.TECHNIQUES]
    return rules.active_rules(fx.rules(spark, sf)).groupBy("formName").agg(*marks)


@query
def route_good_bad(spark, sf):
    return _read(spark, sf).groupBy("formName", "error").agg(F.count(F.lit(1)).alias("n"))


@query
def stage_messages(spark, sf):
    """The whole staging plan over sealed messages: every message once, with its route."""
    cipher = fx.cipher(spark)
    rows = stage(fx.sealed(spark, sf, cipher), fx.rules(spark, sf), cipher, fx.BASE_URL, fx.BUCKET)
    return rows.select("message_id", "route", "error", "file_url",
                       _joined(F.map_keys("columns")).alias("names"))


@query
def message_attributes(spark, sf):
    return message_source.message_attributes(fx.sealed(spark, sf, fx.cipher(spark)))


@query
def apply_declared_schema(spark, sf):
    """Orders as an all-text form table, read through a declared schema."""
    orders = fx.table(spark, sf, "orders")
    as_text = orders.select(
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_totalprice").cast("decimal(20,2)").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.when(F.col("o_orderkey") % 3 == 0, "true").when(F.col("o_orderkey") % 3 == 1, "no value")
        .otherwise("false").alias("flag"),
        F.base64(F.encode("o_orderpriority", "UTF-8")).alias("raw"),
        F.to_json(F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"))).alias("who"),
        F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit(",1]")).alias("many"))
    schema = declared.to_schema([
        declared.FieldDeclaration("key", "INT64", "REQUIRED", "order key"),
        declared.FieldDeclaration("price", "FLOAT64"), declared.FieldDeclaration("amount", "NUMERIC"),
        declared.FieldDeclaration("day", "DATE"), declared.FieldDeclaration("moment", "DATETIME"),
        declared.FieldDeclaration("flag", "BOOL", "NULLABLE"), declared.FieldDeclaration("raw", "BYTES"),
        declared.FieldDeclaration("who", "STRUCT", None, None, (
            declared.FieldDeclaration("cust", "INT64"), declared.FieldDeclaration("status", "STRING"))),
        declared.FieldDeclaration("many", "INT64", "REPEATED"), declared.FieldDeclaration("absent", "STRING")])
    typed = declared.apply_schema(as_text, schema)
    return typed.select(
        "key", "price", F.col("amount").cast("double").alias("amount"), F.col("day").cast("string").alias("day"),
        F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"), "flag",
        F.decode("raw", "UTF-8").alias("raw"), F.col("who.cust").alias("cust"), F.col("who.status").alias("status"),
        (F.col("many")[0] + F.col("many")[1]).alias("many_sum"), "absent",
        F.size(declared.missing_required(schema)).alias("missing"))


# ---- joins -------------------------------------------------------------------------------------------------


@query
def join_rules(spark, sf):
    forms = accepted(_read(spark, sf), "message_id", "formName", "values")
    joined = deid.with_rules(forms, rules.rules_by_form(fx.rules(spark, sf)))
    return joined.select("message_id", *[F.array_join(c, "|").alias(c) for c in deid.FIELD_LISTS])


@query
def fields_to_deidentify(spark, sf):
    forms = accepted(_read(spark, sf), "message_id", "formName", "values")
    joined = deid.with_rules(forms, rules.rules_by_form(fx.rules(spark, sf)))

    def hits_of(fields: str, technique: str) -> Column:
        return F.transform(F.array_intersect(F.map_keys("values"), fields),
                           lambda f: F.struct(f.alias("field"), F.lit(technique).alias("technique")))

    hits = [hits_of(c, t) for c, t in zip(deid.FIELD_LISTS, rules.TECHNIQUES)]
    return joined.select("message_id", F.inline(F.concat(*hits)))


def _found_and_known(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Columns of all messages, and the registry of those before the new column appeared, without one form."""
    rows = _columns(spark, sf)
    early = (F.col("publish_time") < F.lit(DRIFT).cast("timestamp")) & (F.col("formName") != "signup")
    nothing = spark.createDataFrame([], "table string, column string")
    first = evolve.batch_columns(rows.where(early))
    known = evolve.widened(first.select("formName", "table", "column"), nothing, 0)
    return evolve.batch_columns(rows), known


@query
def new_columns(spark, sf):
    found, known = _found_and_known(spark, sf)
    return evolve.new_columns(found, known).select("formName", "column")


@query
def forms_to_create(spark, sf):
    found, known = _found_and_known(spark, sf)
    return evolve.forms_to_create(found, known)


@query
def schema_union(spark, sf):
    found, known = _found_and_known(spark, sf)
    added = evolve.widened(evolve.new_columns(found, known).select("formName", "table", "column"), known, 1)
    return evolve.table_schemas(known, added).select("table", "changed", F.array_join("columns", "|").alias("columns"))


# ---- aggregations ------------------------------------------------------------------------------------------


@query
def rules_by_form(spark, sf):
    grouped = rules.rules_by_form(fx.rules(spark, sf))
    return grouped.select("form_key", *[F.array_join(c, "|").alias(c) for c in deid.FIELD_LISTS])


@query
def ingest_counts(spark, sf):
    return counts.counts_by_form(flatten.with_columns_map(_read(spark, sf)))


@query
def batch_columns(spark, sf):
    return evolve.batch_columns(_columns(spark, sf)).select("formName", "table", "column")


@query
def rules_upsert(spark, sf):
    """A rule CSV applied in line order to a rule table."""
    csv, table = fresh_dir(spark, "rule-csv"), fresh_dir(spark, "rules")
    fx.write_rule_csv(spark, sf, csv)
    files.write_rules(fx.rules(spark, sf), table, 1)
    load_rules(spark, csv, table)
    return rule_source.current_rules(spark, table).groupBy(*rules.RULE, "addnl_info").agg(F.count(F.lit(1)).alias("n"))


@query
def rules_before_change(spark, sf):
    """The rule table as it was before a change file, which rewrote the buckets it touched."""
    csv, table = fresh_dir(spark, "rule-csv"), fresh_dir(spark, "rules")
    fx.write_rule_csv(spark, sf, csv)
    files.write_rules(fx.rules(spark, sf), table, 1)
    load_rules(spark, csv, table)
    return rule_source.rules_at(spark, table, version=1)


# ---- scalar functions --------------------------------------------------------------------------------------


@query
def fn_json_parse(spark, sf):
    return fx.bodies(spark, sf).select("message_id", jsonvals.parse("body").isNotNull().alias("is_json"))


@query
def fn_to_json(spark, sf):
    rows = fx.table(spark, sf, "customer")
    return rows.select("c_custkey", F.to_json(F.struct(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"))).alias("json"))


@query
def fn_json_size(spark, sf):
    rows = _parsed(spark, sf)
    return rows.select("message_id", jsonvals.size("form").alias("members"),
                       _joined(jsonvals.names("form")).alias("names"))


@query
def fn_ci_equals(spark, sf):
    rows = fx.rules(spark, sf)
    return rows.groupBy("formName", text.ci_equals("formName", F.lit("Purchase")).alias("same")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def fn_base64(spark, sf):
    rows = fx.table(spark, sf, "documents")
    return rows.select("doc_id", F.md5(F.encode(text.base64_text(text.utf8_bytes("text")), "UTF-8")).alias("b64_md5"))


@query
def fn_utf8(spark, sf):
    raw = fx.table(spark, sf, "documents").select("doc_id", text.utf8_bytes("text").alias("raw"))
    return raw.select("doc_id", F.length("raw").alias("bytes"), F.length(text.utf8_text("raw")).alias("chars"),
                      F.md5("raw").alias("raw_md5"))


@query
def fn_key_name(spark, sf):
    rows = fx.table(spark, sf, "customer")
    name = text.key_resource(F.lit("p"), F.lit("global"), F.col("c_mktsegment"), F.col("c_name"))
    return rows.select("c_custkey", name.alias("key_name"))


@query
def fn_table_name(spark, sf):
    """Table names of forms named after page addresses."""
    return fx.table(spark, sf, "pages").select("page_id", text.table_name("url").alias("table"))


@query
def envelope_encrypt(spark, sf):
    """Whole document texts sealed and opened again; sealed size as the layout says, text unlike its seal."""
    cipher = fx.cipher(spark)
    keyed = cipher.with_data_key(spread(fx.table(spark, sf, "documents")), "doc_id")
    sealed = keyed.select("doc_id", "text", cipher.seal(text.utf8_bytes("text")).alias("sealed"))
    return sealed.select("doc_id", (F.length("sealed") - F.length(text.utf8_bytes("text"))).alias("overhead"),
                         F.md5(cipher.open("sealed")).alias("text_md5"))


@query
def keyring_messages(spark, sf):
    """One topic sealed under three keys, which the messages name, and a fourth that the key map does not hold: what is
    opened, and what becomes of the rest."""
    ring = {f"{fx.KEK_ID}{i}": bytes([i]) * 32 for i in range(3)}
    parts = fx.bodies(spark, sf).withColumn("part", F.col("message_id").cast("bigint") % 4)
    sealed = []
    for i in range(4):
        cipher = EnvelopeCipher(spark, ring | {f"{fx.KEK_ID}3": bytes(32)}, f"{fx.KEK_ID}{i}", 8)
        mine = publish_plan.seal_messages(parts.where(F.col("part") == i).withColumn("record", F.col("body")), cipher, name_key=True)
        sealed.append(mine)
    topic = fresh_dir(spark, "topic")
    files.publish(reduce(DataFrame.unionByName, sealed), topic)
    opener = EnvelopeCipher(spark, ring, f"{fx.KEK_ID}0", 8)
    rows = stage(message_source.messages(spark, topic), fx.rules(spark, sf), opener, fx.BASE_URL, fx.BUCKET)
    return rows.select("message_id", "route", "error")


@query
def envelope_decrypt(spark, sf):
    """Payloads as they came, with one byte changed, and cut short."""
    cipher = fx.cipher(spark)
    key = F.col("message_id").cast("bigint")
    flipped = F.concat(F.expr("substring(payload, 1, length(payload) - 1)"),
                       F.unhex(F.when(F.expr("hex(substring(payload, -1, 1)) = '00'"), "01").otherwise("00")))
    harmed = F.when(key % 5 == 1, flipped).when(key % 5 == 2, F.substring("payload", 1, 40)).otherwise(F.col("payload"))
    rows = fx.sealed(spark, sf, cipher).withColumn("payload", harmed)
    return parse.open_messages(rows, cipher).select("message_id", "body")


# ---- de-identification -------------------------------------------------------------------------------------


def _by_technique(spark: SparkSession, sf: str, technique: str) -> DataFrame:
    """Fields of one technique's rules: their value after opening, and whether it was hidden."""
    forms, cipher = _sealed_forms(spark, sf, (technique,))
    pairs = F.transform(F.map_entries("values"), lambda e: F.struct(
        e["key"].alias("field"), e["value"].alias("stored"), F.col("plain")[e["key"]].alias("plain")))
    hidden = F.filter(pairs, lambda p: p["stored"] != p["plain"])
    rows = forms.select("message_id", F.inline(hidden))
    return rows.select("message_id", "field", cipher.open_text("stored").alias("value"))


@query
def deid_cryptohash(spark, sf):
    return _by_technique(spark, sf, "CRYPTOHASHING")


@query
def deid_redact(spark, sf):
    return _by_technique(spark, sf, "REDACTION")


@query
def deid_mask(spark, sf):
    return _by_technique(spark, sf, "MASKING")


@query
def deid_chain(spark, sf):
    """A field in several lists is sealed once per list: how often it opens, and what it then reads."""
    forms, cipher = _sealed_forms(spark, sf)
    opened = cipher.with_opened(forms, F.map_values("values"), "opened", 3)
    layers = F.zip_with(F.map_keys("values"), "opened", lambda k, o: F.struct(
        k.alias("field"), o["value"].alias("value"), o["times"].alias("times")))
    return opened.select("message_id", F.inline(F.filter(layers, lambda c: c["times"] > 0)))


@query
def deid_none(spark, sf):
    """Forms without rules pass unchanged."""
    forms, _ = _sealed_forms(spark, sf)
    return _pairs(forms.where("formName = 'view'"), "values", "message_id")


@query
def deid_invariants(spark, sf):
    """The set of names never changes; values no rule names stay as they are."""
    forms, _ = _sealed_forms(spark, sf)
    same = F.map_filter("values", lambda k, v: v == F.col("plain")[k])
    return forms.select(
        "message_id", _joined(F.map_keys("values")).alias("names"), _joined(F.map_keys(same)).alias("untouched"))


@query
def deid_documents(spark, sf):
    """Whole document texts through the whole plan: recorded, sealed as messages, staged with their text sealed
    by rule, and opened again."""
    cipher = fx.cipher(spark)
    docs = spread(fx.table(spark, sf, "documents"))
    form = F.struct("doc_id", "lang", "text")
    meta = F.struct(F.lit("org1").alias("organization"), F.lit("t").alias("team"), F.lit("v1").alias("version"),
                    F.col("source").alias("formName"))
    body = F.to_json(F.struct(form.alias("formData"), meta.alias("formMetaData")))
    keyed = cipher.with_data_key(docs.select(F.col("doc_id").cast("string").alias("message_id"), body.alias("body")),
                                 "message_id")
    messages = keyed.select("message_id", F.lit(DRIFT).cast("timestamp").alias("publish_time"),
                            cipher.seal(text.utf8_bytes("body")).alias("payload"))
    rows = stage(messages, fx.run(spark, sf, fx.DOCUMENT_RULES), cipher, fx.BASE_URL, fx.BUCKET)
    stored = F.col("columns")["text"]
    return rows.select("message_id", "formName", F.col("columns")["lang"].alias("lang"),
                       F.md5(F.encode(cipher.open_text(stored), "UTF-8")).alias("text_md5"),
                       (F.md5(F.encode(stored, "UTF-8")) == F.md5(F.encode(cipher.open_text(stored), "UTF-8")))
                       .alias("in_clear"))


@query
def deid_pseudonyms(spark, sf):
    """Fields of the hashing rules as keyed hashes, by which equal values of all forms and messages meet."""
    cipher = fx.cipher(spark)
    chosen = fx.rules(spark, sf).where(F.upper("dlpTechnique") == "CRYPTOHASHING")
    forms = accepted(_read(spark, sf), "message_id", "formName", "values", "error").withColumn("plain", F.col("values"))
    hidden = deid.deidentify(forms, rules.rules_by_form(chosen), cipher, cryptohashing="hmac")
    pairs = _pairs(hidden, "values", "message_id", "plain").where(F.col("value") != F.col("plain")[F.col("key")])
    return pairs.select("message_id", F.col("key").alias("field"), F.col("value").alias("pseudonym"))


# ---- streaming ---------------------------------------------------------------------------------------------


@query
def stream_ingest(spark, sf):
    """The messages as a stream of several files: all rows of all tables, sealed columns opened."""
    job = _pipeline(spark, sf, _topic(spark, sf, 4), maxFilesPerTrigger=2 * PART_FILES)
    job.start(available_now=True).awaitTermination()
    return _table_rows(job)


@query
def stream_schema_drift(spark, sf):
    """Columns of every table after streaming day by day, in table order."""
    job = _pipeline(spark, sf, _topic(spark, sf, 3), maxFilesPerTrigger=PART_FILES)
    job.start(available_now=True).awaitTermination()
    return job.store.registry().select("formName", "column")


@query
def stream_counts(spark, sf):
    """What the job reports per batch, summed."""
    job = _pipeline(spark, sf, _topic(spark, sf, 4), maxFilesPerTrigger=2 * PART_FILES)
    job.start(available_now=True).awaitTermination()
    return job.store.batches().agg(F.sum("messages").alias("messages"), F.sum("rejected").alias("rejected"))
