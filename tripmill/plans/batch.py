"""The batch run: load, gate, unify, gate, aggregate, gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripmill.contract import VALID_SCHEMA, PipelineConfig
from tripmill.operators.audit import content_sums, reconcile, reconcile_content
from tripmill.operators.quality import (
    MART_GATES,
    STAGING_GATES,
    content_gate,
    intermediate_gates,
    reconciliation_gate,
    require,
    run_gates,
    stored_schema_gate,
    stream_present,
)
from tripmill.plans.intermediate import INT_CLUSTER, INT_PARTITION, build_intermediate
from tripmill.plans.marts import DAILY_CLUSTER, DAILY_PARTITION, daily_mart, monthly_mart
from tripmill.session import configure
from tripmill.sources.loads import arrived_since
from tripmill.sources.tables import (
    load_trips,
    publish_together,
    read_loads,
    replace_table,
    run_path,
    write_candidate,
)

BATCH_CLUSTER = ("PULocationID", "payment_type")


@dataclass(frozen=True)
class BatchTables:
    """The tables a run wrote and the gate rows it passed."""

    staging: DataFrame
    trips: DataFrame
    daily: DataFrame
    monthly: DataFrame
    gates: list[Row]


def replace_staging(loaded: DataFrame, root: str, run_id: str) -> DataFrame:
    """Replace the batch staging table, partitioned by pickup day (column ``pickup_date``)."""
    return replace_table(dated(loaded), "stg_batch", root, run_id, ["pickup_date"], BATCH_CLUSTER)


def dated(loaded: DataFrame) -> DataFrame:
    return loaded.withColumn("pickup_date", F.to_date("lpep_pickup_datetime"))


def in_period(staging: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The day folders of the batch period; the others are not even listed by the scan."""
    return staging.filter(F.col("pickup_date").between(cfg.batch_start, cfg.batch_end))


def run_batch(
    spark: SparkSession,
    batch: Sequence[str] | DataFrame,
    stream: str | DataFrame,
    root: str,
    run_id: str,
    cfg: PipelineConfig,
    keep: int | None = None,
) -> BatchTables:
    """Build all tables below ``root``; a failed gate stops before the next layer.

    ``batch`` is the monthly file paths or a loaded frame; ``stream`` the path
    of the valid-event table or a frame of it. Every layer is written before
    the next one reads it, so nothing is computed twice and a lost executor
    costs only the layer in progress. When all gates have passed, one release names
    all of its tables; until then readers see the tables of the last one. Events that arrive
    later are taken by ``plans.changes.refresh``, without a rebuild.
    """
    configure(spark)
    loaded = batch if isinstance(batch, DataFrame) else load_trips(spark, batch)
    # Noted before the table is read: what arrives in between is applied again by a refresh, which is harmless.
    seen = {} if isinstance(stream, DataFrame) else arrived_since(spark, stream, {})[1]
    events = stream if isinstance(stream, DataFrame) else read_loads(spark, stream, VALID_SCHEMA)

    def write(df: DataFrame, name: str, by: Sequence[str] = (), cluster: Sequence[str] = ()):
        return write_candidate(df, name, root, run_id, by, cluster)

    staging = write(dated(loaded), "stg_batch", ["pickup_date"], BATCH_CLUSTER)
    gates = require(run_gates(staging, STAGING_GATES))

    built = build_intermediate(in_period(staging, cfg), events, cfg)
    trips = write(built, "int_trips", INT_PARTITION, INT_CLUSTER)
    gates += require(
        stored_schema_gate(spark, run_path(root, "int_trips", run_id)),
        run_gates(trips, [*intermediate_gates(cfg.event), stream_present(cfg)]),
    )
    sums = write(content_sums(trips), "trip_sums")

    daily = write(daily_mart(trips), "mart_daily", DAILY_PARTITION, DAILY_CLUSTER)
    monthly = write(monthly_mart(trips), "mart_monthly")
    gates += require(
        run_gates(daily, MART_GATES),
        reconciliation_gate(reconcile(trips, daily, how="full")),
        content_gate(reconcile_content(sums, trips, daily)),
    )
    tables = {"stg_batch": staging, "int_trips": trips, "trip_sums": sums}
    tables |= {"mart_daily": daily, "mart_monthly": monthly}
    publish_together(tables, root, run_id, keep, seen)
    return BatchTables(staging, trips, daily, monthly, gates)
