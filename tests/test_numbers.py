"""Numbers keep the text they were written with."""

import json
import random

import pytest
from pyspark.sql import functions as F

from formweave.functions import jsonvals
from formweave.operators import flatten, records

LITERALS = ["0", "-0", "1.50", "1e400", "-1E-7", "1e+2", "0.0", "12345678901234567890123456789012345678901", "9" * 60,
            "123456789012345678", "-1234567890123456789", "0." + "1" * 43, "10", "1" * 1500]
TEXTS = ["1.50", "-0", "a\"1.5", "\\1.5", "\u00017", "\u0001", "{\"a\":1.50}", "\\u0001 2.0", "[1.0]", "é1.0,2.0", "", "\n1.0"]


def texts(spark, *docs):
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    rows = rows.withColumn("mark", jsonvals.number_mark("doc")).withColumn("v", jsonvals.parse(jsonvals.marked("doc", "mark")))
    got = rows.select("i", F.col("v").isNotNull().alias("ok"), jsonvals.parse("doc").isNotNull().alias("valid"),
                      jsonvals.plain_texts(jsonvals.object_texts("v"), "mark").alias("m"))
    return sorted(got.collect())


def test_literals_alone_and_nested(spark):
    docs = [f'{{"a":{n}, "b" : [ {n} ,{{"c":{n}}}],"d":"{n}","-0":{n}}}' for n in LITERALS]
    for n, row in zip(LITERALS, texts(spark, *docs)):
        assert row.m == {"a": n, "b": f'[{n},{{"c":{n}}}]', "d": n, "-0": n}


def test_strings_are_never_taken_for_numbers(spark):
    docs = [json.dumps({"n": 0, "t": t, "u": [t], t: "1.0"}).replace('"n": 0', '"n": 2.50') for t in TEXTS]
    for t, row in zip(TEXTS, texts(spark, *docs)):
        assert row.m["n"] == "2.50" and row.m["t"] == t and row.m[t] == "1.0" and json.loads(row.m["u"]) == [t]


@pytest.mark.parametrize("doc", [
    '{"a":1.2.3}', '{"a":01.5}', '{"a":--1.5}', '{"a":+1.5}', '{"a":1.}', '{"a":.5}', '{"a":1.5x}', '{1.5:2}', '{1.5 : 2}',
    '{"a":1.5 2.5}', '{"a":"1.5}', '{"a":1.5', '{"a":NaN,"b":1.5}', '{"a":1.5,}', '{"a":1e}', '{"a":1.5e+}', '{"a":0x1.5}',
    '{"a":\x011.5}', '{"a":\x01\x021.5}', '{"a":"\x01\x021.5"}', '{"a":1.5,"a":2}', '{"a":-}', '[1.5}', '{"a":tru1.0e}'])
def test_malformed_stays_malformed(spark, doc):
    row = texts(spark, doc)[0]
    assert not row.valid and not row.ok


def test_random_documents_are_valid_as_before(spark):
    r, docs = random.Random(6), []
    base = '{"a":1.50,"b":[-0,{"c":"x\\"1.5","d":1e400}],"e":{"f":"\\u0001 2.0"},"g":"9.9"}'
    for _ in range(300):
        at = r.randrange(len(base))
        docs.append(base[:at] + r.choice(['"', "1", ".", "e", "-", ",", ":", "{", "}", "\\", "", " ", "\x01", "0.5"]) + base[at + r.randint(0, 2):])
    for row in texts(spark, *docs):
        assert row.ok == row.valid, docs[row.i]


def test_all_marks_in_use_leave_numbers_to_the_parser(spark):
    doc = '{"a":1.50,"b":"' + "".join(f"\\u000{i}" for i in range(1, 9)) + '"}'
    assert texts(spark, doc)[0].m == {"a": "1.5", "b": "".join(map(chr, range(1, 9)))}


def test_deep_documents_and_records(spark):
    rows = spark.createDataFrame([('{"a":{"b":[1.50,{"c":-0}]}}',)], "doc string")
    assert flatten.flatten_json(rows, "doc").first().flat == {"a.b[0]": "1.50", "a.b[1].c": "-0"}
    made = spark.createDataFrame([("o\u0001", "t", "v", "f", '{"x":1e400,"y":{"z":0.10},"t":"1.0"}')],
                                 "organization string, team string, version string, formName string, body string")
    record = records.form_records(made).first().record
    assert record.startswith('{"formData":{"t":"1.0","x":1e400,"y":{"z":0.10}},') or '"x":1e400' in record and '"z":0.10' in record
    assert json.loads(record)["formMetaData"]["organization"] == "o\u0001"
