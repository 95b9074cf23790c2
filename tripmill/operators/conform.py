"""Filters and projections that bring both sources to the trip columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.contract import (
    DEFAULT_PASSENGERS,
    FINGERPRINT_COLUMNS,
    TRIP_SCHEMA,
    EventSpec,
    PipelineConfig,
)
from tripmill.functions.numeric import to_integer
from tripmill.functions.text import fingerprint_sql
from tripmill.session import clock, configure

# Trip column -> batch column or SQL expression.
BATCH_MAPPING = {
    "trip_id": fingerprint_sql(FINGERPRINT_COLUMNS),
    "pickup_datetime": "lpep_pickup_datetime",
    "dropoff_datetime": "lpep_dropoff_datetime",
    "pickup_date": "to_date(lpep_pickup_datetime)",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "passenger_count": f"coalesce(passenger_count, {DEFAULT_PASSENGERS})",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "total_amount": "total_amount",
    "payment_type": "payment_type",
}

# The validated stream has the trip columns already, under one other name.
STREAM_MAPPING = {
    **{name: name for name in TRIP_SCHEMA.names if name != "source_type"},
    "trip_id": "event_id",
}


def conform(
    df: DataFrame,
    mapping: Mapping[str, str],
    source_label: str,
    as_of: datetime | None = None,
) -> DataFrame:
    """Rename and cast ``df`` to the trip columns and label its source.

    A mapping without ``ingestion_time`` gets the run's clock there. Columns
    with a fraction are rounded, not truncated, where the trip has an integer.
    """
    configure(df.sparkSession)

    def source(name: str) -> Column:
        if name == "source_type":
            return F.lit(source_label)
        if name == "ingestion_time" and name not in mapping:
            return clock(as_of)
        return F.expr(mapping[name])

    found = df.select(*[source(name).alias(name) for name in TRIP_SCHEMA.names])
    return found.select(
        *[_cast(found.schema[f.name].dataType, f).alias(f.name) for f in TRIP_SCHEMA.fields]
    )


def _cast(found: T.DataType, wanted: T.StructField) -> Column:
    column = F.col(wanted.name)
    fractional = isinstance(found, (T.DoubleType, T.FloatType, T.DecimalType))
    if fractional and isinstance(wanted.dataType, T.LongType):
        return to_integer(column)
    return column.cast(wanted.dataType)


def apply_rules(df: DataFrame, rules: Sequence[Column | str]) -> DataFrame:
    """Keep the rows for which every rule is true; false and NULL both drop the row.

    A rule is a condition as a Column or as SQL text.
    """
    conditions = [F.expr(rule) if isinstance(rule, str) else rule for rule in rules]
    return df.filter(reduce(lambda a, b: a & b, conditions))


def batch_period(cfg: PipelineConfig) -> list[Column]:
    """Pickup day inside the inclusive batch period; reaches Parquet as a timestamp range."""
    return [F.to_date("lpep_pickup_datetime").between(cfg.batch_start, cfg.batch_end)]


def batch_time_order() -> list[Column]:
    return [F.col("lpep_dropoff_datetime") > F.col("lpep_pickup_datetime")]


def batch_zones(spec: EventSpec | None = None) -> list[Column]:
    """Both zones inside the limits of the zone table."""
    spec = spec or EventSpec()
    limits = (
        ("PULocationID", spec["pickup_location_id"]),
        ("DOLocationID", spec["dropoff_location_id"]),
    )
    return [F.col(name).between(f.minimum, f.maximum) for name, f in limits]


def batch_amounts() -> list[Column]:
    """Positive distance and total, no negative fare; NaN, which Spark ranks highest, is none."""
    return [
        F.col("trip_distance") > 0,
        F.col("fare_amount") >= 0,
        F.col("total_amount") > 0,
        *[~F.isnan(name) for name in ("trip_distance", "fare_amount", "total_amount")],
    ]


def batch_rules(cfg: PipelineConfig) -> list[Column]:
    """All batch business rules. Deliberately fewer than the event rules."""
    return [
        *batch_period(cfg),
        *batch_time_order(),
        *batch_zones(cfg.event),
        *batch_amounts(),
    ]


def stream_period(cfg: PipelineConfig) -> list[Column]:
    """Business date of a stream row inside the period; prunes date partitions."""
    return [F.col("pickup_date").between(cfg.stream_start, cfg.stream_end)]


def conform_batch(staging: DataFrame, cfg: PipelineConfig) -> DataFrame:
    kept = apply_rules(staging, batch_rules(cfg))
    return conform(kept, BATCH_MAPPING, "batch", cfg.as_of)


def conform_stream(staging: DataFrame, cfg: PipelineConfig) -> DataFrame:
    kept = apply_rules(staging, stream_period(cfg))
    return conform(kept, STREAM_MAPPING, "stream", cfg.as_of)
