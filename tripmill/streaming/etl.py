"""Streaming validation: one pass over the payloads, two tables out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill.contract import DEAD_LETTER_SCHEMA, VALID_SCHEMA, EventSpec
from tripmill.operators.validate import split_valid, validate_events
from tripmill.sources.tables import append_batch, compact, read_loads
from tripmill.streaming.ledger import BatchLedger

STREAM_PARTITION = ("pickup_date",)
STREAM_CLUSTER = ("pickup_location_id", "payment_type")


@dataclass(frozen=True)
class StreamTables:
    """Where the accepted and the rejected events are kept."""

    valid: str
    dead_letter: str

    def read_valid(self, spark: SparkSession) -> DataFrame:
        return read_loads(spark, self.valid, VALID_SCHEMA)

    def read_dead_letter(self, spark: SparkSession) -> DataFrame:
        return read_loads(spark, self.dead_letter, DEAD_LETTER_SCHEMA)

    def compact(self, spark: SparkSession) -> None:
        """Merge the finished micro-batches of both tables; safe while the stream runs."""
        compact(spark, self.valid, VALID_SCHEMA, STREAM_PARTITION, STREAM_CLUSTER)
        compact(spark, self.dead_letter, DEAD_LETTER_SCHEMA)


def stream_etl(
    events: DataFrame,
    tables: StreamTables,
    checkpoint: str,
    spec: EventSpec | None = None,
    as_of: datetime | None = None,
    trigger: Mapping[str, object] | None = None,
    ledger: BatchLedger | None = None,
) -> StreamingQuery:
    """Start validating ``events`` into the two tables.

    Every micro-batch is a narrow stage up to the writes: no state, no
    watermark, so late events are taken whenever they come and only the event
    period bounds them. Spark may replay a micro-batch after a failure. Both
    writes go to a directory named by query and batch, so a replay replaces
    rows instead of doubling them, and the clock is the batch's logged start,
    so a replay also decides alike.

    ``trigger`` is passed to ``DataStreamWriter.trigger``; the default works
    off what is there and stops. ``{"processingTime": "1 minute"}`` runs on. ``ledger``
    gets the counts of every batch.
    """
    validated = validate_events(events, spec, as_of, payload=events.columns[0])
    # Only the dead letter table has payloads: those of valid events need no place in the cache.
    validated = validated.withColumn("raw_payload", F.expr("if(error_code IS NULL, NULL, raw_payload)"))
    query_id: list[str] = []

    def route(batch: DataFrame, batch_id: int) -> None:
        if not query_id:  # known once the query has started
            query_id.append(_query_id(batch.sparkSession, checkpoint))
        load_id = f"{query_id[0]}-{batch_id}"
        # Rows are read twice and dropped: dictionaries of their columns cost more than they save.
        # The session is the stream's own, so other caches keep the setting they have.
        batch.sparkSession.conf.set("spark.sql.inMemoryColumnarStorage.compressed", "false")
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, rejected = split_valid(rows)
            append_batch(valid, tables.valid, load_id, STREAM_PARTITION, STREAM_CLUSTER)
            append_batch(rejected, tables.dead_letter, load_id)
        finally:
            rows.unpersist()

    writer = validated.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if ledger is None:
        return writer.start()
    events.sparkSession.streams.addListener(ledger)
    query = writer.start()
    ledger.follow(query)
    return query


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns the checkpoint; batch numbers are unique only within it."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
