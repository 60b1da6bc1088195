"""Requests to sealed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.functions.crypto import DATA_KEY, KEY_NAME, EnvelopeCipher
from formweave.functions.text import utf8_bytes
from formweave.operators.records import form_records

UNREADABLE = "PARSE: body is not a JSON object"


def records(requests: DataFrame, prefixes: list[str]) -> DataFrame:
    """Requests with their record; message id and publish time are made here unless given."""
    made = form_records(requests, prefixes)
    if "message_id" not in made.columns:
        made = made.withColumn("message_id", F.uuid())
    if "publish_time" not in made.columns:
        made = made.withColumn("publish_time", F.current_timestamp())
    return made


def seal_messages(made: DataFrame, cipher: EnvelopeCipher, name_key: bool = False) -> DataFrame:
    """Messages of all readable requests. With ``name_key`` each names its key in an attribute, so that a topic may hold
    messages under several keys."""
    named = F.create_map(F.lit(KEY_NAME), F.lit(cipher.key_name)) if name_key else F.create_map().cast("map<string,string>")
    keyed = cipher.with_data_key(made.where(F.col("record").isNotNull()), "message_id")
    return keyed.select(
        "message_id", "publish_time", named.alias("attributes"),
        cipher.seal(utf8_bytes("record")).alias("payload")).drop(DATA_KEY)


def publishable(requests: DataFrame, cipher: EnvelopeCipher, prefixes: list[str], name_key: bool = False) -> DataFrame:
    return seal_messages(records(requests, prefixes), cipher, name_key)


def unreadable(requests: DataFrame) -> DataFrame:
    """Requests the publisher refuses: their body is not a JSON object."""
    return form_records(requests).where(F.col("record").isNull()).drop("record").withColumn(
        "error", F.lit(UNREADABLE))
