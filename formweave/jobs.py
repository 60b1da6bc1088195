"""Command line: ``python -m formweave.jobs <publish|ingest|load-rules> ...``.

Requests the publisher refuses go to the folder named by ``--rejects``, or one beside the topic's; a topic named
``kafka:…`` or ``log:…`` needs the option. The key map is read from the file named by ``--keyFile``, one ``resource-name=hex`` per line.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

from formweave.config import KeyConfig, PublishConfig, ingest_config, kafka_options, parse_args
from formweave.functions.crypto import EnvelopeCipher
from formweave.functions.text import prefix_list
from formweave.plans.publish import publishable, unreadable
from formweave.plans.rule_load import load_rules
from formweave.session import build_session, shared_dir
from formweave.sinks.files import publish
from formweave.sources.messages import LOG, requests
from formweave.streaming.pipeline import IngestPipeline
from formweave.streaming.retry import with_backoff


def read_key_map(path: str) -> dict[str, bytes]:
    with open(path, encoding="utf-8") as lines:
        pairs = (line.strip().partition("=") for line in lines if "=" in line)
        return {name: bytes.fromhex(value) for name, _, value in pairs}


def run_publish(argv: list[str]) -> None:
    given = parse_args(argv)
    spark = build_session("formweave-publish")
    shared_dir(spark)
    keys = KeyConfig(**{n: given[n] for n in ("projectId", "locationId", "keyRing", "keyId") if n in given})
    config = PublishConfig(topic=given["topic"], prefixes=given.get("fields", ""), keys=keys)
    cipher = EnvelopeCipher(spark, read_key_map(given["keyFile"]), keys.name)
    prefixes = prefix_list(config.prefixes) if "fields" in given else []
    asked = requests(spark, given["requests"])
    to_kafka = config.topic.startswith("kafka:")
    if config.topic.startswith(("kafka:", LOG)) and "rejects" not in given:
        raise ValueError("missing required option: rejects")
    options = config.kafka_options() | kafka_options(given) if to_kafka else {}
    if config.topic.startswith(LOG):
        options = {"writeId": uuid.uuid4().hex}  # one key for all tries
    # Ids and times are made once, so that a repeated try publishes the same messages.
    sealed = publishable(asked, cipher, prefixes, given.get("nameKey") == "true").checkpoint()
    send(lambda: publish(sealed, config.topic, **options), config)
    unreadable(asked).write.mode("append").parquet(given.get("rejects", f"{config.topic.rstrip('/')}_rejects"))


def send(attempt: Callable[[], None], config: PublishConfig, **clock) -> int:
    """Publish with the retry settings of the topic client."""
    return with_backoff(attempt, config.initialRetryDelay / 1000, config.maxRetryDelay / 1000, config.totalTimeout / 1000, **clock)


def run_ingest(argv: list[str]) -> None:
    given = parse_args(argv)
    config = ingest_config([a for a in argv if not a.startswith(("--keyFile=", "--once="))])
    spark = build_session("formweave-ingest")
    cipher = EnvelopeCipher(spark, read_key_map(given["keyFile"]), config.keys.name)
    IngestPipeline(spark, config, cipher).start(available_now=given.get("once") == "true").awaitTermination()


def run_load_rules(argv: list[str]) -> None:
    """``dataset table sourceUri root credentials``: exactly five arguments, or nothing happens."""
    if len(argv) != 5:
        return
    data_set, table, source, root, _credentials = argv
    load_rules(build_session("formweave-rules"), source, f"{root}/{data_set}/{table}")


JOBS = {"publish": run_publish, "ingest": run_ingest, "load-rules": run_load_rules}

if __name__ == "__main__":
    JOBS[sys.argv[1]](sys.argv[2:])
