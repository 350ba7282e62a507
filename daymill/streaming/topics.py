"""Message topics: options for Spark's Kafka connector and the text payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: str, topic: str, offsets: str = "latest", max_per_trigger: int | None = None) -> dict[str, str]:
    """Read options; new topic partitions are looked for every 10 seconds.

    ``offsets`` is ``earliest``, ``latest`` or a JSON text of offsets, and
    counts only for the first start; later the checkpoint does.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets,
        "kafka.metadata.max.age.ms": "10000",
        "failOnDataLoss": "true",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    """Write options: all replicas confirm, retried writes are not doubled by the producer."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.retries": str(2**31 - 1),
    }


def text_payload(messages: DataFrame) -> DataFrame:
    """Message value as text; a null payload stays null."""
    return messages.withColumn("value", F.col("value").cast("string"))


def kafka_json_source(spark: SparkSession, servers: str, topic: str, offsets: str = "latest") -> DataFrame:
    return text_payload(spark.readStream.format("kafka").options(**source_options(servers, topic, offsets)).load())


def as_messages(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key and value columns of the sink; readers drop repeats by key, the sink may send a row twice."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("value"))


def kafka_sink(df: DataFrame, servers: str, topic: str, key: str, text: str):
    return as_messages(df, key, text).writeStream.format("kafka").options(**sink_options(servers, topic))
