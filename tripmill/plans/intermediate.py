"""Unified, deduplicated trips from both sources."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmill.contract import PipelineConfig
from tripmill.operators.conform import conform_batch, conform_stream
from tripmill.operators.dedup import dedup_latest
from tripmill.sources.layout import interleaved

INT_PARTITION = ("pickup_date",)
#: Within a source no column comes first, so that a filter on any of the three skips row groups.
INT_CLUSTER = (
    "source_type",
    interleaved(
        ("pickup_location_id", 1, 265),
        ("payment_type", 1, 6),
        ("hour(pickup_datetime) * 60 + minute(pickup_datetime)", 0, 1439),
    ),
)


def unify(batch: DataFrame, stream: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Both sources in the trip columns, duplicates still in."""
    return conform_batch(batch, cfg).unionByName(conform_stream(stream, cfg))


def build_intermediate(batch: DataFrame, stream: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """One row per trip, the one ingested last.

    One shuffle, on the trip id.
    """
    return dedup_latest(unify(batch, stream, cfg), ["trip_id"], ["ingestion_time"])
