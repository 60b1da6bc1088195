"""Payloads by URL."""

import duckdb
from pyspark.sql import functions as F

from formweave.sinks import files
from formweave.sources import archive


def staged(spark, n=4000, days=4):
    day = F.col("id") % days + 1
    return spark.range(n).select(
        F.col("id").cast("string").alias("message_id"),
        F.concat(F.lit("u/b/My Form/2024-03/"), day, F.lit("/My Form1_2_3_"), F.col("id"), F.lit(".json")).alias("file_url"),
        F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("payload"), F.lit("My Form").alias("formName"),
        F.lit("2024-03").alias("month"), day.cast("int").alias("day"), F.lit(None).cast("string").alias("key_name"))


def rows_scanned(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_skips_folders_and_row_groups(spark, tmp_path):
    path = str(tmp_path / "archive")
    for batch in range(3):
        files.archive(staged(spark).where(F.col("message_id") % 3 == batch).coalesce(1), path, batch)
    stored = archive.archived(spark, path)
    url = "u/b/My Form/2024-03/2/My Form1_2_3_2001.json"
    found = archive.payload_at(stored, "My Form", url)
    assert [r.message_id for r in found.collect()] == ["2001"]
    # One day of one batch: the other batches' files of that day are skipped by their filters.
    assert rows_scanned(archive.payload_at(stored, "My Form", url)) <= 4000 // 12 + 1
    assert archive.payload_at(stored, "My Form", "nothing").count() == 0
    assert archive.payload_at(stored, "Other", url).count() == 0
    offsets = duckdb.sql(f"SELECT bloom_filter_offset FROM parquet_metadata('{path}/**/*.parquet') WHERE path_in_schema = 'file_url'")
    assert all(r[0] for r in offsets.fetchall())


def test_payloads_of_error_rows(spark, tmp_path):
    path = str(tmp_path / "archive")
    files.archive(staged(spark, 40), path, 0)
    urls = ["u/b/My Form/2024-03/2/My Form1_2_3_1.json", "u/b/My Form/2024-03/4/My Form1_2_3_3.json"]
    rows = [("My Form", u, "", "") for u in [*urls, urls[0], "", "gone/2024-03/1/x.json"]] + [("Other", urls[0], "", ""), (None, None, "", "")]
    errors = spark.createDataFrame(rows, "formName string, errorFormData string, timeStamp string, description string")
    found = archive.payloads_of(errors, archive.archived(spark, path))
    assert sorted(r.message_id for r in found.collect()) == ["1", "3"]
    assert archive.payloads_of(errors.limit(0), archive.archived(spark, path)).count() == 0


def test_payloads_of_forms_without_errors_are_not_shuffled(spark, tmp_path):
    """More URLs than Spark broadcasts: only the payloads of the form and the days with errors are shuffled to them."""
    path = str(tmp_path / "archive")
    files.archive(staged(spark, 40), path, 0)
    files.archive(staged(spark, 40).withColumns({"formName": F.lit("Other"), "file_url": F.replace("file_url", F.lit("My Form"), F.lit("Other"))}), path, 1)
    stored = archive.archived(spark, path)
    errors = stored.where("formName = 'My Form' AND day IN (2, 3)").select("formName", F.col("file_url").alias("errorFormData"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        found = archive.payloads_of(errors, stored)
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(rows) == 20 and {(r.formName, r.day) for r in rows} == {("My Form", 2), ("My Form", 3)}
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in final and final.index("SortMergeJoin") < final.index("BroadcastHashJoin")


def test_many_forms_take_few_small_files(spark, tmp_path):
    path = str(tmp_path / "archive")
    forms = staged(spark, 200, 2).withColumn("formName", F.concat(F.lit("Form "), F.col("message_id")))
    files.archive(forms.coalesce(1), path, 0)
    stored = list((tmp_path / "archive").rglob("*.parquet"))
    assert len(stored) == 2 and sum(f.stat().st_size for f in stored) < 200_000
    kept = archive.archived(spark, path)
    assert kept.select("form").distinct().count() == 200
    url = "u/b/My Form/2024-03/2/My Form1_2_3_7.json"
    assert [r.message_id for r in archive.payload_at(kept, "Form 7", url).collect()] == ["7"]
    assert archive.payload_at(kept, "Form 8", url).count() == 0
