"""The command line, end to end: publish, load rules, ingest."""

import pytest

from formweave import jobs
from formweave.config import KeyConfig, PublishConfig
from formweave.functions.crypto import EnvelopeCipher
from formweave.sinks.tables import FormStore


def test_publish_load_and_ingest(spark, tmp_path):
    keys = tmp_path / "keys"
    keys.write_text(f"{KeyConfig().name}={bytes(32).hex()}\n")
    (tmp_path / "rules.csv").write_text("formName,fieldName,dlpTechnique,addnl_info\nForm1,name,REDACTION,\n")
    rows = [("o", "t", "form1", "v", f'{{"name":"n{i}","sys_x":1,"i":{i}}}') for i in range(3)]
    spark.createDataFrame(rows, "organization string, team string, formName string, version string, body string"
                          ).write.parquet(str(tmp_path / "requests"))

    jobs.run_publish([f"--requests={tmp_path}/requests", f"--topic={tmp_path}/topic", "--fields=SYS_",
                      f"--keyFile={keys}"])
    jobs.run_load_rules(["only", "four", "arguments", "here"])
    jobs.run_load_rules(["set", "form_dlp_config", f"{tmp_path}/rules.csv", str(tmp_path), "none"])
    jobs.run_ingest([f"--inputSubscription={tmp_path}/topic", f"--root={tmp_path}/root", f"--keyFile={keys}",
                     f"--rulesPath={tmp_path}/set/form_dlp_config", "--once=true"])

    table = FormStore(spark, f"{tmp_path}/root").read("form1")
    cipher = EnvelopeCipher(spark, {KeyConfig().name: bytes(32)}, KeyConfig().name)
    got = table.select("i", cipher.open_text("name").alias("name")).orderBy("i").collect()
    assert [tuple(r) for r in got] == [("0", "n0"), ("1", "n1"), ("2", "n2")]
    assert "sys_x" not in table.columns


def test_publish_waits_and_gives_up():
    waits = []
    config = PublishConfig("t", initialRetryDelay=100, maxRetryDelay=400, totalTimeout=2_000)

    def fails():
        raise RuntimeError("no broker")

    with pytest.raises(RuntimeError):
        jobs.send(fails, config, sleep=waits.append, clock=lambda: sum(waits))
    assert [round(w, 3) for w in waits] == [0.1, 0.2, 0.4, 0.4, 0.4, 0.4]
    assert jobs.send(lambda: None, config) == 1


def test_refused_requests_are_kept_beside_the_topic(spark, tmp_path):
    keys = tmp_path / "keys"
    keys.write_text(f"{KeyConfig().name}={bytes(32).hex()}\n")
    rows = [("o", "t", "f", "v", '{"a":1}'), ("o", "t", "f", "v", "bad")]
    spark.createDataFrame(rows, "organization string, team string, formName string, version string, body string"
                          ).write.parquet(str(tmp_path / "requests"))
    jobs.run_publish([f"--requests={tmp_path}/requests", f"--topic={tmp_path}/topic", f"--keyFile={keys}"])
    assert spark.read.parquet(f"{tmp_path}/topic").count() == 1
    assert spark.read.parquet(f"{tmp_path}/topic_rejects").first().body == "bad"
    with pytest.raises(ValueError):
        jobs.run_publish([f"--requests={tmp_path}/requests", "--topic=kafka:t", f"--keyFile={keys}"])
