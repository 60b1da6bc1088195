"""Message sources. A message is (message_id, publish_time, attributes, payload)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.schemas import MESSAGE, REQUEST
from formweave.sources import topic_log

LOG = "log:"


def messages(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a file topic, as a batch; ``log:<folder>`` is a topic of numbered files."""
    if path.startswith(LOG):
        topic_log.register(spark)
        return spark.read.format(topic_log.FORMAT).load(path[len(LOG):]).select(*MESSAGE.names)
    return spark.read.schema(MESSAGE).parquet(path)


def message_stream(spark: SparkSession, subscription: str, max_files: int | None = None,
                   **options: str) -> DataFrame:
    """Unbounded messages. ``kafka:<topic>`` reads a Kafka topic, where that connector is installed;
    ``log:<folder>`` a topic of numbered files; anything else is the folder of a file topic."""
    if subscription.startswith("kafka:"):
        reader = (spark.readStream.format("kafka").option("subscribe", subscription[len("kafka:"):])
                  .option("includeHeaders", "true"))
        return from_kafka(reader.options(**options).load())
    if subscription.startswith(LOG):
        topic_log.register(spark)
        return spark.readStream.format(topic_log.FORMAT).load(subscription[len(LOG):]).select(*MESSAGE.names)
    reader = spark.readStream.schema(MESSAGE).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(subscription)


def deliver_once(stream: DataFrame, seconds: int) -> DataFrame:
    """Each message id once, if its deliveries carry times within so many seconds of each other. The ids of that span are
    the state, kept by id over the shuffle partitions and with the checkpoint, so a restart knows them. Messages without
    an id or a time pass as they are; a message older than the span behind the newest one is late and dropped."""
    told = F.col("message_id").isNotNull() & F.col("publish_time").isNotNull()
    known = stream.where(told).withWatermark("publish_time", f"{seconds} seconds").dropDuplicatesWithinWatermark(["message_id"])
    return known.unionByName(stream.where(~told))


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records as messages; topic, partition and offset identify one, its headers are the attributes."""
    attributes = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return records.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("timestamp").alias("publish_time"),
        F.coalesce(attributes, F.create_map().cast("map<string,string>")).alias("attributes"),
        F.col("value").alias("payload"))


def message_attributes(rows: DataFrame) -> DataFrame:
    """One row per attribute of a message."""
    return rows.select("message_id", F.explode("attributes").alias("key", "value"))


def requests(spark: SparkSession, path: str) -> DataFrame:
    """Form requests: four headers and a JSON body."""
    return spark.read.schema(REQUEST).parquet(path)
