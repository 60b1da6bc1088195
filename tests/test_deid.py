import pytest
from pyspark.sql import functions as F

from formweave.functions.crypto import EnvelopeCipher
from formweave.operators import deid, rules
from formweave.schemas import RULES

from conftest import KEK
from test_rules import BASE


@pytest.fixture
def forms(spark):
    rows = [("1", "Purchase", {"full name": "n", "props": "{}", "user_id": "7", "home.city": "c", "tags": "t"}, None),
            ("2", "view", {"user_id": "8"}, None), ("3", "signup", {"tags": "[1]", "full name": "m"}, None),
            ("4", "purchase", None, "bad")]
    return spark.createDataFrame(rows, "message_id string, formName string, values map<string,string>, error string")


def by_form(spark):
    return rules.rules_by_form(spark.createDataFrame(BASE, RULES))


def test_named_fields_are_sealed_once_per_list(spark, cipher, forms):
    rows = deid.deidentify(forms, by_form(spark), cipher).withColumn("plain", F.lit(None))
    got = {r.message_id: r for r in rows.collect()}
    first = spark.createDataFrame([got["1"].values], "map<string,string>").toDF("v").select(
        cipher.open_text(F.col("v")["full name"]).alias("name"), cipher.open_text(F.col("v")["user_id"]).alias("id"),
        cipher.open_text(F.col("v")["props"]).alias("once"),
        cipher.open_text(cipher.open_text(F.col("v")["props"])).alias("twice")).first()
    assert (first.name, first.id, first.twice) == ("n", "7", "{}") and first.once != "{}"
    assert got["1"].values["home.city"] == "c" and got["1"].values["tags"] == "t"
    assert got["2"].values == {"user_id": "8"} and got["3"].values["full name"] == "m"
    assert got["4"].error == "bad" and got["4"].values is None
    assert "_data_key" not in rows.columns and not set(deid.FIELD_LISTS) & set(rows.columns)


def test_unsealable_value_rejects_the_row(spark, forms):
    keyless = EnvelopeCipher(spark, {}, KEK, 1)
    got = {r.message_id: r for r in deid.deidentify(forms, by_form(spark), keyless).collect()}
    assert got["1"].error == deid.NOT_SEALED and got["2"].error is None
    passed = {r.message_id: r for r in deid.deidentify(forms, by_form(spark), keyless, "pass").collect()}
    assert passed["1"].error is None and passed["1"].values["full name"] == "n"


def test_large_rule_tables_are_not_broadcast(spark, cipher, forms):
    small = deid.with_rules(forms, by_form(spark)).select("message_id", *deid.FIELD_LISTS)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = sorted(map(repr, small.collect()))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = deid.with_rules(forms, by_form(spark)).select("message_id", *deid.FIELD_LISTS)
        assert "Broadcast" not in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, large.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_small_lists_of_large_rule_tables_are_broadcast(spark, cipher, forms):
    """The rules are over Spark's threshold, their lists by form are not: no message is shuffled."""
    expected = sorted(map(repr, deid.with_rules(forms, by_form(spark)).select("message_id", *deid.FIELD_LISTS).collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        joined = deid.with_rules(forms, by_form(spark)).select("message_id", *deid.FIELD_LISTS)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert sorted(map(repr, joined.collect())) == expected
        assert deid.with_rules(forms, by_form(spark).limit(0)).where("size(masking_fields) = 0").count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_pseudonyms_join_tables(spark, cipher, forms):
    """Equal values of two forms have equal pseudonyms in two runs; without the key the row is rejected."""
    rules_of = by_form(spark)
    runs = [deid.deidentify(forms, rules_of, c, cryptohashing="hmac").where("message_id = '1'").first().values["full name"]
            for c in (cipher, EnvelopeCipher(spark, {KEK: bytes(range(32))}, KEK, 1))]
    assert runs[0] == runs[1] and len(runs[0]) == 64
    keyless = EnvelopeCipher(spark, {}, KEK, 1)
    got = {r.message_id: r for r in deid.deidentify(forms, rules_of, keyless, cryptohashing="hmac").collect()}
    assert got["1"].error == deid.NOT_SEALED and got["2"].error is None
