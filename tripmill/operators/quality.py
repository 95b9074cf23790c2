"""Data-quality gates: declared checks, evaluated one pass per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.contract import SOURCE_TYPES, TRIP_SCHEMA, EventSpec, PipelineConfig
from tripmill.session import clock, configure
from tripmill.sources.footers import columns_everywhere


@dataclass(frozen=True)
class Gate:
    """A check on a whole table.

    ``observed`` is an SQL aggregate giving a count. The gate passes if that
    count is zero (``expect="zero"``) or above zero (``expect="positive"``).
    """

    name: str
    observed: str
    expect: str = "zero"


class GateFailure(RuntimeError):
    """A gate did not pass, so the next layer must not be built."""


def not_empty(name: str) -> Gate:
    return Gate(name, "count(*)", "positive")


BATCH_NOT_EMPTY = not_empty("batch_not_empty")
DAILY_MART_NOT_EMPTY = not_empty("daily_mart_not_empty")

BATCH_REQUIRED_NULLS = Gate(
    "batch_required_nulls",
    "count_if(lpep_pickup_datetime IS NULL OR lpep_dropoff_datetime IS NULL"
    " OR PULocationID IS NULL OR DOLocationID IS NULL)",
)

UNIQUE_TRIPS = Gate("unique_trips", "count(*) - count(DISTINCT trip_id)")


def invalid_trip(spec: EventSpec | None = None) -> str:
    """SQL condition of a trip that breaks a rule both sources share.

    A NULL operand makes a comparison NULL, which does not count as a breach.
    """
    spec = spec or EventSpec()
    zone = "{0} NOT BETWEEN {1.minimum} AND {1.maximum}".format
    return " OR ".join(
        [
            "pickup_datetime >= dropoff_datetime",
            "trip_distance <= 0",
            "fare_amount < 0",
            "total_amount <= 0",
            *[f"isnan({name})" for name in ("trip_distance", "fare_amount", "total_amount")],
            zone("pickup_location_id", spec["pickup_location_id"]),
            zone("dropoff_location_id", spec["dropoff_location_id"]),
            "source_type NOT IN ({})".format(", ".join(f"'{s}'" for s in SOURCE_TYPES)),
        ]
    )


def valid_values(spec: EventSpec | None = None) -> Gate:
    return Gate("valid_values", f"count_if({invalid_trip(spec)})")


def stream_present(cfg: PipelineConfig) -> Gate:
    """Stream rows exist inside the period."""
    condition = (
        f"pickup_date BETWEEN DATE'{cfg.stream_start}' AND DATE'{cfg.stream_end}'"
        " AND source_type = 'stream'"
    )
    return Gate("stream_present", f"count_if({condition})", "positive")


STAGING_GATES = (BATCH_NOT_EMPTY, BATCH_REQUIRED_NULLS)
MART_GATES = (DAILY_MART_NOT_EMPTY,)


def intermediate_gates(spec: EventSpec | None = None) -> tuple[Gate, ...]:
    return (valid_values(spec), UNIQUE_TRIPS)


def run_gates(df: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """Evaluate all gates of one table in one aggregation: ``gate, passed, observed``."""
    observed = df.agg(
        *[F.expr(g.observed).cast("bigint").alias(f"gate_{i}") for i, g in enumerate(gates)]
    )
    results = [
        F.struct(
            F.lit(g.name).alias("gate"),
            (F.col(f"gate_{i}") > 0 if g.expect == "positive" else F.col(f"gate_{i}") == 0).alias(
                "passed"
            ),
            F.col(f"gate_{i}").alias("observed"),
        )
        for i, g in enumerate(gates)
    ]
    return observed.select(F.inline(F.array(*results)))


def column_metadata(df: DataFrame) -> DataFrame:
    """The columns of ``df`` as rows ``column_name, data_type, ordinal_position``."""
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, ordinal_position int"
    )


def schema_gate(df: DataFrame, required: Sequence[str] = tuple(TRIP_SCHEMA.names)) -> DataFrame:
    """All required columns exist; further columns are allowed. Reads no rows."""
    present = F.count_if(F.col("column_name").isin(*required))
    return column_metadata(df).agg(present.alias("observed")).select(
        F.lit("required_columns").alias("gate"),
        (F.col("observed") == len(set(required))).alias("passed"),
        "observed",
    )


def stored_schema_gate(
    spark: SparkSession, path: str, required: Sequence[str] = tuple(TRIP_SCHEMA.names)
) -> DataFrame:
    """As ``schema_gate``, on the columns that every written file has; no files have no columns.

    The footers of all files are read, by tasks: one file that lacks a column fails the gate.
    """
    observed = columns_everywhere(spark, path, required)[1]
    row = [("required_columns", observed == len(set(required)), observed)]
    return spark.createDataFrame(row, "gate string, passed boolean, observed bigint")


def freshness_gate(df: DataFrame, as_of: datetime | None, within: timedelta) -> DataFrame:
    """Something arrived lately: the count of rows whose ingestion is recent enough."""
    configure(df.sparkSession)
    cutoff = clock(as_of) - F.make_dt_interval(secs=F.lit(within.total_seconds()))
    recent = F.count_if(F.col("ingestion_time") >= cutoff)
    return df.agg(recent.alias("observed")).select(
        F.lit("stream_fresh").alias("gate"), (F.col("observed") > 0).alias("passed"), "observed"
    )


def reconciliation_gate(reconciled: DataFrame) -> DataFrame:
    """Every source has as many trips in the mart as in the intermediate table.

    Takes the rows of ``reconcile(..., how="full")``; no rows at all must not pass.
    """
    return reconciled.agg(
        F.coalesce(F.every("reconciled"), F.lit(False)).alias("passed"),
        F.count_if(~F.col("reconciled")).alias("observed"),
    ).select(F.lit("mart_reconciles").alias("gate"), "passed", "observed")


def content_gate(compared: DataFrame) -> DataFrame:
    """Every date and source has the content in the mart that was kept for its trips.

    Takes the rows of ``reconcile_content``; the gate names the first date and source that differs.
    """
    off = ~F.col("reconciled")
    first = F.min(F.when(off, F.concat_ws(" ", "pickup_date", "source_type")))
    return compared.agg(
        F.concat(F.lit("content_reconciles"), F.coalesce(F.concat(F.lit(" at "), first), F.lit(""))).alias("gate"),
        F.coalesce(F.every("reconciled"), F.lit(False)).alias("passed"),
        F.count_if(off).alias("observed"),
    )


def require(*results: DataFrame) -> list:
    """Raise ``GateFailure`` unless all gates passed; give back the gate rows.

    Only gate rows, a handful per table, reach the driver.
    """
    rows = reduce(DataFrame.unionByName, results).collect()
    failed = [f"{r.gate} (observed {r.observed})" for r in rows if not r.passed]
    if failed:
        raise GateFailure("gates failed: " + ", ".join(failed))
    return rows
