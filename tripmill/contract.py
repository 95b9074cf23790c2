"""The data contract: field table, schemas, domain constants and run configuration.

Validator rules, typed columns, gates and schemas are all generated from the
definitions in this module, so a limit is stated once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import types as T

SPARK_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "integer": T.LongType(),
    "number": T.DoubleType(),
}


@dataclass(frozen=True)
class Field:
    """One contract column: its kind and, where the contract has them, its limits."""

    name: str
    kind: str
    minimum: float | None = None
    maximum: float | None = None
    above: float | None = None
    allowed: tuple = ()


def schema_of(*fields: Field | tuple[str, str]) -> T.StructType:
    pairs = [(f.name, f.kind) if isinstance(f, Field) else f for f in fields]
    return T.StructType([T.StructField(name, SPARK_TYPES[kind], True) for name, kind in pairs])


# Fixed values of the event contract: names, kinds and limits.
EVENT_FIELDS = (
    Field("event_id", "string"),
    Field("event_time", "timestamp"),
    Field("ingestion_time", "timestamp"),
    Field("pickup_datetime", "timestamp"),
    Field("dropoff_datetime", "timestamp"),
    Field("pickup_location_id", "integer", minimum=1, maximum=265),
    Field("dropoff_location_id", "integer", minimum=1, maximum=265),
    Field("passenger_count", "integer", minimum=1, maximum=6),
    Field("trip_distance", "number", above=0),
    Field("fare_amount", "number", minimum=0),
    Field("tip_amount", "number", minimum=0),
    Field("tolls_amount", "number", minimum=0),
    Field("total_amount", "number", above=0),
    Field("payment_type", "integer", allowed=(1, 2, 3, 4)),
    Field("source_type", "string", allowed=("stream",)),
)

EVENT_SCHEMA = schema_of(*EVENT_FIELDS)

VALID_SCHEMA = schema_of(
    *EVENT_FIELDS,
    ("pickup_date", "date"),
    ("trip_duration_minutes", "number"),
    ("fare_per_mile", "number"),
    ("processing_time", "timestamp"),
)

DEAD_LETTER_SCHEMA = schema_of(
    ("raw_payload", "string"),
    ("error_code", "string"),
    ("error_reason", "string"),
    ("processing_time", "timestamp"),
)

# Columns used from the monthly batch files. Counts and codes arrive as doubles
# in some months, so the loader reads them as numbers and conform() rounds them.
BATCH_SCHEMA = schema_of(
    ("lpep_pickup_datetime", "timestamp"),
    ("lpep_dropoff_datetime", "timestamp"),
    ("PULocationID", "integer"),
    ("DOLocationID", "integer"),
    ("passenger_count", "number"),
    ("trip_distance", "number"),
    ("fare_amount", "number"),
    ("tip_amount", "number"),
    ("tolls_amount", "number"),
    ("total_amount", "number"),
    ("payment_type", "number"),
)

TRIP_SCHEMA = schema_of(
    ("trip_id", "string"),
    ("pickup_datetime", "timestamp"),
    ("dropoff_datetime", "timestamp"),
    ("pickup_date", "date"),
    ("pickup_location_id", "integer"),
    ("dropoff_location_id", "integer"),
    ("passenger_count", "integer"),
    ("trip_distance", "number"),
    ("fare_amount", "number"),
    ("tip_amount", "number"),
    ("tolls_amount", "number"),
    ("total_amount", "number"),
    ("payment_type", "integer"),
    ("source_type", "string"),
    ("ingestion_time", "timestamp"),
)

DAILY_MART_SCHEMA = schema_of(
    ("pickup_date", "date"),
    ("source_type", "string"),
    ("trip_count", "integer"),
    ("total_revenue", "number"),
    ("average_total_amount", "number"),
    ("average_trip_distance", "number"),
    ("average_duration_minutes", "number"),
)

MONTHLY_MART_SCHEMA = schema_of(
    ("pickup_month", "date"),
    ("source_type", "string"),
    ("trip_count", "integer"),
    ("total_revenue", "number"),
    ("average_total_amount", "number"),
    ("average_trip_distance", "number"),
)

# Source labels, the default for an unknown passenger count, and
# the columns a trip is identified by.
SOURCE_TYPES = ("batch", "stream")
DEFAULT_PASSENGERS = 1

# A batch trip has no id of its own: these columns identify it.
FINGERPRINT_COLUMNS = (
    "lpep_pickup_datetime",
    "lpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "total_amount",
)


def utc(year: int, month: int, day: int) -> datetime:
    return datetime(year, month, day, tzinfo=timezone.utc)


# Fixed values in the two classes below: the default periods.
@dataclass(frozen=True)
class EventSpec:
    """What a valid event looks like: the field table and the half-open event period."""

    start: datetime = utc(2025, 6, 1)
    end: datetime = utc(2025, 8, 1)
    fields: tuple[Field, ...] = EVENT_FIELDS

    def __getitem__(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def of_kind(self, *kinds: str) -> list[Field]:
        return [f for f in self.fields if f.kind in kinds]


@dataclass(frozen=True)
class PipelineConfig:
    """Periods and clock of one pipeline run.

    ``as_of`` is the run's clock. ``None`` means the time Spark starts the
    query; a fixed value makes a rerun reproduce its output exactly.
    """

    batch_start: date = date(2025, 4, 1)
    batch_end: date = date(2025, 5, 31)
    event: EventSpec = field(default_factory=EventSpec)
    as_of: datetime | None = None

    @property
    def stream_start(self) -> date:
        return self.event.start.date()

    @property
    def stream_end(self) -> date:
        """Last whole day inside the half-open event period."""
        return (self.event.end - timedelta(microseconds=1)).date()
