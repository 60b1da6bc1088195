"""Topics of numbered files: offsets, replays, competing and repeated writes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from formweave import jobs
from formweave.config import KeyConfig
from formweave.functions.crypto import EnvelopeCipher
from formweave.sinks.files import dead_letter, publish
from formweave.sinks.tables import FormStore
from formweave.sources import topic_log
from formweave.sources.messages import message_stream, messages


def made(spark, ids, parts=3):
    rows = spark.createDataFrame([(str(i), f"p{i}") for i in ids], "message_id string, body string")
    return rows.select("message_id", F.lit("2024-03-05 07:08:09").cast("timestamp").alias("publish_time"),
                       F.create_map(F.lit("a"), F.col("message_id")).alias("attributes"),
                       F.encode("body", "UTF-8").alias("payload")).repartition(parts)


def placed(spark, path):
    topic_log.register(spark)
    return spark.read.format(topic_log.FORMAT).load(path)


def test_messages_come_back_whole(spark, tmp_path):
    topic = f"{tmp_path}/topic"
    publish(made(spark, range(5000, 5000)), f"log:{topic}")
    assert messages(spark, f"log:{topic}").count() == 0
    publish(made(spark, range(9000), 2), f"log:{topic}", partitions="3")  # a topic keeps its first number of partitions
    publish(made(spark, range(9000, 9100)), f"log:{topic}")
    got = placed(spark, topic)
    assert got.select("partition", "offset").distinct().count() == 9100
    assert sorted(int(r.message_id) for r in got.collect()) == list(range(9100))
    row = messages(spark, f"log:{topic}").where("message_id = '17'").first()
    assert (row.attributes, bytes(row.payload), str(row.publish_time)) == ({"a": "17"}, b"p17", "2024-03-05 07:08:09")
    for p, end in topic_log.ends(topic).items():
        assert got.where(f"partition = {p}").agg(F.max("offset")).first()[0] == (end - 1 if end else None)


def test_nulls_and_empty_payloads(spark, tmp_path):
    rows = spark.createDataFrame([(None, None, None, None), ("x", None, {}, b"")],
                                 "message_id string, publish_time timestamp, attributes map<string,string>, payload binary")
    publish(rows, f"log:{tmp_path}/topic")
    got = messages(spark, f"log:{tmp_path}/topic").collect()
    assert {(r.message_id, r.publish_time, str(r.attributes), r.payload if r.payload is None else bytes(r.payload)) for r in got} == {
        (None, None, "None", None), ("x", None, "{}", b"")}


def test_any_two_places_give_the_messages_between(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topic_log, "BATCH_ROWS", 7)  # files of several batches
    topic = f"{tmp_path}/topic"
    for part in range(3):
        publish(made(spark, range(part * 50, part * 50 + 50), 1), f"log:{topic}", partitions="1", writeId=str(part))
    reader = topic_log.StreamReader(topic)
    whole = [r.message_id for r in placed(spark, topic).orderBy("offset").collect()]
    assert reader.latestOffset() == {"0": 150} and reader.initialOffset() == {}
    for start, end in ((0, 150), (0, 1), (49, 51), (50, 50), (10, 140), (149, 150)):
        found = [b.to_pydict() for s in reader.partitions({"0": start}, {"0": end}) for b in reader.read(s)]
        assert [m for b in found for m in b["message_id"]] == whole[start:end]
        assert [o for b in found for o in b["offset"]] == list(range(start, end))


def test_a_write_that_is_repeated_is_there_once(spark, tmp_path):
    topic = f"{tmp_path}/topic"
    publish(made(spark, range(40), 4), f"log:{topic}", partitions="2", writeId="w")
    # The state a crash leaves in the middle of a commit: the list is kept, one file is not linked yet.
    lost = topic_log.files_of(topic, 1)[-1][1]
    os.remove(lost)
    assert placed(spark, topic).count() < 40
    publish(made(spark, range(40), 3), f"log:{topic}", writeId="w")
    assert sorted(int(r.message_id) for r in placed(spark, topic).collect()) == list(range(40))
    with open(f"{topic}/commits/w.json") as told:
        assert sorted(os.listdir(f"{topic}/staged")) == sorted(name for name, _ in json.load(told)["files"])


def test_a_place_that_another_writer_took_is_passed(spark, tmp_path, monkeypatch):
    topic = f"{tmp_path}/topic"
    publish(made(spark, range(10), 1), f"log:{topic}", partitions="1")
    publish(made(spark, range(10, 20), 1), f"log:{topic}", writeId="w")
    staged = f"{topic}/staged/{json.load(open(f'{topic}/commits/w.json'))['files'][0][0]}"
    os.remove(topic_log.files_of(topic, 0)[-1][1])
    publish(made(spark, range(20, 30), 1), f"log:{topic}")  # takes offset 10
    seen, real = iter([10]), topic_log.end_of
    monkeypatch.setattr(topic_log, "end_of", lambda path, p: next(seen, None) or real(path, p))
    topic_log.link_at_end(staged, topic, 0)
    assert sorted((r.offset, int(r.message_id)) for r in placed(spark, topic).collect())[::10] == [(0, 0), (10, 20), (20, 10)]


def test_a_stream_goes_on_where_it_stopped_and_writes_once(spark, tmp_path):
    source, target, place = f"{tmp_path}/source", f"{tmp_path}/target", f"{tmp_path}/progress"

    def run():
        stream = message_stream(spark, f"log:{source}").writeStream.format(topic_log.FORMAT).option("path", target)
        stream.option("writeId", "copy").option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()

    publish(made(spark, range(100)), f"log:{source}")
    run()
    run()
    publish(made(spark, range(100, 150)), f"log:{source}")
    run()
    assert sorted(int(r.message_id) for r in placed(spark, target).collect()) == list(range(150))
    # A stream that dies after its write but before its own note of it writes the batch again.
    last = max(int(n) for n in os.listdir(f"{place}/commits") if n.isdigit())
    os.remove(f"{place}/commits/{last}")
    crc = f"{place}/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run()
    assert sorted(int(r.message_id) for r in placed(spark, target).collect()) == list(range(150))


def test_jobs_take_such_topics(spark, tmp_path):
    keys = tmp_path / "keys"
    keys.write_text(f"{KeyConfig().name}={bytes(32).hex()}\n")
    rows = [("o", "t", "form1", "v", f'{{"i":{i}}}') for i in range(5)]
    spark.createDataFrame(rows, "organization string, team string, formName string, version string, body string"
                          ).write.parquet(str(tmp_path / "requests"))
    asked = [f"--requests={tmp_path}/requests", f"--topic=log:{tmp_path}/topic", f"--keyFile={keys}"]
    with pytest.raises(ValueError):
        jobs.run_publish(asked)
    jobs.run_publish([*asked, f"--rejects={tmp_path}/rejects"])
    for _ in range(2):
        jobs.run_ingest([f"--inputSubscription=log:{tmp_path}/topic", f"--root={tmp_path}/root", f"--keyFile={keys}",
                         "--once=true"])
    assert sorted(r.i for r in FormStore(spark, f"{tmp_path}/root").read("form1").collect()) == list("01234")
    cipher = EnvelopeCipher(spark, {KeyConfig().name: bytes(32)}, KeyConfig().name)
    assert cipher.key_name == KeyConfig().name


def test_dead_letters_go_to_such_topics_once(spark, tmp_path):
    lost = made(spark, range(3)).select("message_id", "publish_time", "payload", F.lit("f").alias("formName"),
                                        F.lit(None).cast("string").alias("key_name"))
    for _ in range(2):
        dead_letter(lost, f"log:{tmp_path}/dead", 7)
    assert {(r.message_id, str(r.attributes)) for r in messages(spark, f"log:{tmp_path}/dead").collect()} == {
        (str(i), "{'formName': 'f'}") for i in range(3)}
    assert messages(spark, f"log:{tmp_path}/dead").count() == 3
