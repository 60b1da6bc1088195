"""Every registered query against its SQL twin, and what its plan must look like."""

import re
from pathlib import Path

import pytest

from checks import catalog, fixtures
from checks.catalog import QUERIES
from checks.compare import difference, duck
from checks.headline import HEADLINE
from checks.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SMALL, name) == ""


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES) and set(HEADLINE) <= set(QUERIES)


@pytest.mark.parametrize("name", ["stage_messages", "flatten_live", "join_rules", "deid_chain", "batch_columns",
                                  "rules_by_form", "ingest_counts"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_each_message_is_parsed_once(spark):
    plan = QUERIES["flatten_live"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


@pytest.mark.parametrize("name", ["deid_chain", "form_table_append"])
def test_code_is_small_enough_to_be_compiled(spark, name):
    """The JVM interprets methods of more than 8,000 bytes, however often they run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) <= 8000


def test_messages_are_sealed_after_they_are_put_in_order(spark):
    """Sealed once, not once more for the sample that finds the ranges, and not shuffled with their seal."""
    plan = fixtures.sealed(spark, SMALL, fixtures.cipher(spark), parts=3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("aesEncrypt") < plan.index("RepartitionByExpression") and plan.count("Repartition") == 1


def test_files_of_a_topic_follow_one_another_in_time(spark):
    topic = spark.read.parquet(catalog._topic(spark, SMALL, 2)).select("publish_time", "_metadata.file_name", "message_id")
    spans = topic.groupBy("file_name").agg({"publish_time": "min", "message_id": "count"}).collect()
    ends = {r.file_name: r[1] for r in topic.groupBy("file_name").agg({"publish_time": "max"}).collect()}
    spans = sorted((r["min(publish_time)"], ends[r.file_name]) for r in spans)
    assert len(spans) == 2 * catalog.PART_FILES and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert topic.count() == topic.select("message_id").distinct().count() == spark.read.parquet(f"{SMALL}/events.parquet").count()
