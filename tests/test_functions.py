import base64

import pytest
from pyspark.sql import functions as F

from formweave.functions import declared, jsonvals, text


def values(spark, column, *rows):
    frame = spark.createDataFrame([(r,) for r in rows], "c string")
    return [r[0] for r in frame.select(column).collect()]


def test_prefix_list_drops_trailing_empty_entries_only():
    assert text.prefix_list("a,,B,,") == ["a", "", "B"]
    assert text.prefix_list("") == [""]
    assert text.prefix_list(",") == []


def test_has_prefix_ignores_case_and_empty_prefix_matches_all(spark):
    assert values(spark, text.has_prefix(F.col("c"), ["_Sys"]), "_SYS1", "x_sys") == [True, False]
    assert values(spark, text.has_prefix(F.col("c"), [""]), "anything") == [True]


def test_column_name(spark):
    assert values(spark, text.column_name("c"), 'a[0].b-c {"d"}', "home.city", "full name") == [
        "a0_b_cd", "home_city", "fullname"]


def test_table_name_is_unique_per_form(spark):
    names = values(spark, text.table_name("c"), "purchase", "Purchase", "my-form", "my_form", "_rejected", "é")
    assert names[0] == "purchase" and names[3] == "my_form"
    assert len(set(names)) == 6 and all(n.replace("_", "").isalnum() and n.isascii() for n in names)


def test_trim_cell_takes_all_low_characters(spark):
    assert values(spark, text.trim_cell("c"), "\t a b \r\n", " x") == ["a b", " x"]


def test_long_form_names_fit_a_folder(spark):
    names = ["x" * 120, "x" * 121, "x" * 5000, "é" * 150, "a/b", "", "_a", "X" * 121]
    frame = spark.createDataFrame([(n,) for n in names], "form string")
    made = [r[0] for r in frame.select(text.table_name("form")).collect()]
    assert made[0] == names[0] and len(set(made)) == len(made)
    assert all(len(m.encode()) <= 160 and set(m) <= set("abcdefghijklmnopqrstuvwxyz0123456789_") for m in made)


def test_archive_names(spark):
    frame = spark.sql("SELECT 'f' AS form, timestamp'2024-03-05 07:08:09' AS t, 'm1' AS id")
    url = frame.select(text.archive_url("http://x/", "b", "form", "t", "id")).first()[0]
    assert url.startswith("http://x/b/f/2024-03/5/f7_8_9_") and url.endswith(".json")
    assert url == frame.select(text.archive_url("http://x/", "b", "form", "t", "id")).first()[0]


def test_base64_stays_on_one_line(spark):
    long = "x" * 5000
    assert values(spark, text.base64_text(text.utf8_bytes("c")), long) == [base64.b64encode(long.encode()).decode()]


def test_malformed_bytes_become_replacement_characters(spark):
    frame = spark.sql("SELECT x'41ff42' AS raw")
    assert frame.select(text.utf8_text("raw")).first()[0] == "A�B"


@pytest.mark.parametrize("doc", ['{"a":1,"a":2}', '{"a":', "", "nope"])
def test_parse_rejects(spark, doc):
    assert values(spark, jsonvals.parse("c").isNull(), doc) == [True]


def test_object_texts(spark):
    doc = '{"n":1.50,"i":7,"s":"x\\"y","b":true,"z":null,"o":{"k": [1, {"y":2}]},"e":{}}'
    got = values(spark, jsonvals.object_texts(jsonvals.parse("c")), doc)[0]
    assert got == {"n": "1.5", "i": "7", "s": 'x"y', "b": "true", "z": None, "o": '{"k":[1,{"y":2}]}', "e": "{}"}
    assert values(spark, jsonvals.object_texts(jsonvals.parse("c")), "[1]", "3") == [None, None]


def test_member_text_tells_null_from_absent(spark):
    member = jsonvals.member_text(jsonvals.object_texts(jsonvals.parse("c")), "a")
    assert values(spark, member, '{"a":null}', "{}", '{"a":{"b":1}}') == ["null", None, '{"b":1}']


@pytest.mark.parametrize("doc,depth", [
    ("{}", 1), ("[]", 1), ("3", 0), ('{"a":[[1]]}', 3), ('{"a":"[[{","b":"\\"]["}', 1), ('{"a":"\\\\","b":[1]}', 2)])
def test_nesting_depth(spark, doc, depth):
    assert values(spark, jsonvals.nesting_depth("c"), doc) == [depth]


def test_declared_schema(spark):
    fields = [declared.FieldDeclaration("id", "INT64", "REQUIRED", "the key"),
              declared.FieldDeclaration("tags", "STRING", "REPEATED"),
              declared.FieldDeclaration("at", "TIMESTAMP"), declared.FieldDeclaration("t", "TIME"),
              declared.FieldDeclaration("place", "GEOGRAPHY"), declared.FieldDeclaration("raw", "BYTES"),
              declared.FieldDeclaration("in", "STRUCT", None, None, (declared.FieldDeclaration("n", "NUMERIC"),))]
    schema = declared.to_schema(fields)
    assert [f.nullable for f in schema.fields][:2] == [False, True]
    assert schema["id"].metadata == {"comment": "the key"}
    table = spark.createDataFrame([("x", '["a"]', "2024-01-01 00:00:00", "01:02:03", "POINT(1 2)", "AQI=", '{"n":"1.5"}')],
                                  "ID string, tags string, at string, t string, place string, raw string, `in` string")
    row = declared.apply_schema(table, schema).select("*", declared.missing_required(schema).alias("missing")).first()
    assert row.id is None and row.missing == ["id"] and row.tags == ["a"] and bytes(row.raw) == b"\x01\x02"
    assert str(row["in"].n) == "1.500000000" and row.t == "01:02:03" and row.place == "POINT(1 2)"


def test_native_times(spark):
    schema = declared.to_schema([declared.FieldDeclaration("t", "TIME")], native_time=True)
    spark.conf.set("spark.sql.timeType.enabled", "true")
    try:
        rows = spark.createDataFrame([("01:02:03",), ("x",)], "t string")
        assert [str(r.t) for r in declared.apply_schema(rows, schema).collect()] == ["01:02:03", "None"]
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


@pytest.mark.parametrize("bad", [("INTERVAL", None), ("INT64", "MANY")])
def test_unknown_declarations_are_refused(bad):
    with pytest.raises(ValueError):
        declared.to_field(declared.FieldDeclaration("x", *bad))
