"""Event streams in and out. A stream frame has one column ``value`` of payload bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tripmill.contract import EVENT_SCHEMA
from tripmill.functions.text import rfc3339_text
from tripmill.session import configure


def kafka_events(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Payloads of a Kafka topic. Needs the Kafka package of the Spark distribution.

    Set ``maxOffsetsPerTrigger`` to bound a micro-batch.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).options(**options).load().select("value")


def file_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Payloads that land as Parquet files with a binary column ``value``."""
    reader = spark.readStream.schema("value binary")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def text_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Payloads that land as text files, one per line."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def encode_events(events: DataFrame) -> DataFrame:
    """Typed events as messages: ``key``, compact UTF-8 JSON ``value`` and ``headers``.

    NULL fields stay in the JSON, so a key that is required remains present.
    """
    configure(events.sparkSession)
    fields = [
        (rfc3339_text(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name))
        .alias(f.name)
        for f in EVENT_SCHEMA.fields
    ]
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    def header(name: str):
        return F.struct(F.lit(name).alias("key"), F.encode(F.col(name), "UTF-8").alias("value"))

    return events.select(
        F.col("event_id").alias("key"),
        F.encode(payload, "UTF-8").alias("value"),
        F.array(header("event_id"), header("source_type")).alias("headers"),
    )


def publish_batch(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send encoded events to a Kafka topic, headers included."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).option("includeHeaders", "true").options(**options).save()


def publish_stream(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, **options: str
) -> DataStreamWriter:
    """A ready-to-start writer that sends encoded events to a Kafka topic."""
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    writer = writer.option("topic", topic).option("includeHeaders", "true")
    return writer.option("checkpointLocation", checkpoint).options(**options)
