import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from formweave.operators import flatten, parse
from formweave.operators.route import accepted, rejected
from formweave.plans.ingest import stage
from formweave.schemas import RULES

META = {"organization": "o", "team": "t", "version": "v", "formName": "f"}


def record(form=None, **meta):
    return json.dumps({"formData": {"a": 1} if form is None else form, "formMetaData": {**META, **meta}})


def judged(spark, *bodies):
    rows = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "message_id string, body string")
    return flatten.with_columns_map(parse.read_forms(rows)).orderBy("message_id").collect()


@pytest.mark.parametrize("body,error,form", [
    (None, parse.NOT_OPENED, None),
    ('{"formData":', parse.NOT_JSON, None),
    ('{"formData":{"a":1,"a":2},"formMetaData":{}}', parse.NOT_JSON, None),
    ("[1]", parse.NO_META, None),
    ("{}", parse.NO_META, None),
    ('{"formData":{"a":1},"formMetaData":"x"}', parse.NO_META, None),
    ('{"formData":{"a":1},"formMetaData":{"formName":"f"}}', parse.NO_HEADER + "organization", "f"),
    ('{"formData":{"a":1},"formMetaData":{"organization":"o"}}', parse.NO_HEADER + "formName", None),
    (record(team="", organization=""), parse.BLANK_HEADER + "organization", "f"),
    (record(team="", version=""), parse.BLANK_HEADER + "team", "f"),
    (record(formName="", version=""), parse.BLANK_HEADER + "formName", ""),
    (record(version=""), parse.BLANK_HEADER + "version", "f"),
    (record(form={}), parse.EMPTY_BODY, "f"),
    (record(form=[1]), parse.NO_BODY, "f"),
    (record(form={"a.b": 1, "a-b": 2}), flatten.COLLISION, "f"),
    (record(form={"a": 1, "A": 2}), flatten.COLLISION, "f"),
    (record(form={"formMetaData.team": 1}), flatten.COLLISION, "f"),
    (record(form={" ": 1}), flatten.EMPTY_NAME, "f"),
    (record(extra=json.loads("[" * 40 + "1" + "]" * 40)), None, "f"),
    (record(), None, "f"),
])
def test_verdicts(spark, body, error, form):
    row = judged(spark, body)[0]
    assert (row.error, row.formName) == (error, form)
    assert (row.columns is None) == (error is not None)


def test_null_header_reads_as_text_and_passes(spark):
    row = judged(spark, record(organization=None))[0]
    assert row.error is None and row.columns["formMetaData_organization"] == "null"


def test_last_of_colliding_keys(spark):
    body = record(form={"a.b": 1, "c": 0, "a-b": 2, "A b": 3, "Ab": 4, "formMetaData.team": 5})
    rows = parse.read_forms(spark.createDataFrame([("1", body), ("2", record(form={" ": 1}))], "message_id string, body string"))
    got = {r.message_id: r for r in flatten.with_columns_map(rows, "last").collect()}
    columns = got["1"].columns
    assert got["1"].error is None and columns["formMetaData_team"] == "t" and columns["c"] == "0"
    assert len(columns) == len({c.lower() for c in columns}) == 7 and got["2"].error == flatten.EMPTY_NAME


def test_columns_of_an_accepted_form(spark):
    body = record(form={"full name": "x", "k.z": None, "o": {"p": [1, 2]}, "FormMetadata": 3}, geo={"la.t": [1, {}]})
    assert judged(spark, body)[0].columns == {
        "fullname": "x", "k_z": "null", "o": '{"p":[1,2]}', "formMetaData_organization": "o",
        "formMetaData_team": "t", "formMetaData_version": "v", "formMetaData_formName": "f",
        "formMetaData_geola_t0": "1", "formMetaData_geola_t1": "{}"}


def test_deep_flatten_any_depth(spark):
    docs = ['{"a":{"b":1,"x":[1,{"y":2}]},"d":null,"k.z":"q","emp":{},"ea":[]}',
            '{"a":' + "[" * 40 + "1" + "]" * 40 + "}", "broken", "5", "[]"]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    flat = [r.flat for r in flatten.flatten_json(rows, "d").orderBy("i").collect()]
    assert flat[0] == {"a.b": "1", "a.x[0]": "1", "a.x[1].y": "2", "d": "null", '["k.z"]': "q", "emp": "{}", "ea": "[]"}
    assert flat[1] == {"a" + "[0]" * 40: "1"}
    assert flat[2] is None and flat[3] == {"": "5"} and flat[4] == {"": "[]"}


def test_deep_flatten_equals_a_recursive_walk(spark):
    rnd = random.Random(5)

    def value(depth):
        kind = rnd.random()
        if depth and kind < 0.35:
            return {rnd.choice(["a", "b c", "k.z", "x[", "q\"", "é", ""]) + str(i): value(depth - 1)
                    for i in range(rnd.randrange(4))}
        if depth and kind < 0.6:
            return [value(depth - 1) for _ in range(rnd.randrange(4))]
        return rnd.choice([None, True, 7, -3, "s", "{[", "\\", 'say "]"', "", "line\nbreak"])

    def walk(path, node, out):
        if isinstance(node, dict) and node:
            for k, v in node.items():
                odd = any(c in k for c in ".[]")
                walk(f'{path}["{k}"]' if odd else f"{path}.{k}" if path else k, v, out)
        elif isinstance(node, list) and node:
            for i, v in enumerate(node):
                walk(f"{path}[{i}]", v, out)
        else:
            text = {None: "null", True: "true"}.get(node) if not isinstance(node, (dict, list, str, int)) or node is True else None
            out[path] = text or ("{}" if node == {} else "[]" if node == [] else str(node))
        return out

    docs = [value(rnd.randrange(1, 16)) for _ in range(300)]
    docs = [d for d in docs if isinstance(d, (dict, list))]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, d string")
    for row in flatten.flatten_json(rows, "d").collect():
        assert row.flat == walk("", docs[row.i], {})


def test_split_by_verdict(spark):
    rows = spark.createDataFrame([("1", record()), ("2", "x")], "message_id string, body string")
    forms = parse.read_forms(rows)
    assert [r.message_id for r in accepted(forms, "message_id").collect()] == ["1"]
    assert [(r.message_id, r.error) for r in rejected(forms, "message_id", "error").collect()] == [("2", parse.NOT_JSON)]


def test_staging_keeps_every_message_once(spark, cipher, message_of):
    messages = message_of(("1", record()), ("2", "x"), ("3", record(formName="My Form")), ("4", record(team="")))
    messages = messages.withColumn("payload", F.when(F.col("message_id") == "4", F.lit(b"short")).otherwise(F.col("payload")))
    rows = {r.message_id: r for r in stage(messages, spark.createDataFrame([], RULES), cipher, "u/", "b").collect()}
    assert sorted(rows) == ["1", "2", "3", "4"]
    assert rows["1"].route == "f" and rows["1"].file_url.startswith("u/b/f/2024-03/5/f7_8_9_")
    assert rows["2"].route == rows["4"].route == "_rejected" and rows["4"].error == parse.NOT_OPENED
    assert rows["3"].route.startswith("form_my_form_") and rows["2"].file_url is None


def test_a_huge_document_is_flattened_over_the_tasks(spark):
    """An array of many members beside small parts: the same leaves as within the row, from many partitions."""
    n = 5_000
    huge = '{"a":{"k.z":[' + ",".join(f'{{"x":{i}.50}}' for i in range(n)) + '],"e":[]},"b":null,"c":[[],[1,[2]]]}'
    docs = [(1, huge), (2, '{"a":1}'), (3, "bad"), (4, None), (5, "[]")]
    rows = spark.createDataFrame(docs, "id int, doc string")
    spread = flatten.flatten_rows(rows, "doc", "id", spread_bytes=2_000).withColumn("part", F.spark_partition_id())
    inside = flatten.flatten_json(rows, "doc").select("id", F.explode("flat").alias("path", "value"))
    got = spread.collect()
    assert sorted((r.id, r.path, r.value) for r in got) == sorted(map(tuple, inside.collect()))
    assert len(got) == n + 7 and [r.path for r in got if r.value == "7.50"] == ['a["k.z"][7].x']
    sizes = Counter(r.part for r in got)
    assert len(sizes) >= 4 and max(sizes.values()) < n // 2
