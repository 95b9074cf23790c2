"""Late events without a rebuild: only the dates that they change are written again.

The events of the loads that no release includes yet are compared with the trips of the same ids.
That gives a change set: trips to add and trips to remove. Its dates are written anew, from their
trips of before; all other dates stay where they are and the next release names them there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tripmill.contract import TRIP_SCHEMA, VALID_SCHEMA, PipelineConfig
from tripmill.operators.audit import content_sums, reconcile, reconcile_content
from tripmill.operators.conform import conform_stream
from tripmill.operators.dedup import dedup_latest, rank_latest
from tripmill.operators.quality import (
    MART_GATES,
    content_gate,
    intermediate_gates,
    reconciliation_gate,
    require,
    run_gates,
    stored_schema_gate,
)
from tripmill.plans.intermediate import INT_CLUSTER, INT_PARTITION
from tripmill.plans.marts import DAILY_CLUSTER, DAILY_PARTITION, daily_mart, monthly_mart
from tripmill.session import configure
from tripmill.sources.loads import arrived_since
from tripmill.sources.releases import Release, Run, drop_old, last_release, make_release
from tripmill.sources.tables import parts_of, read_run, read_some_loads, run_path, write_candidate

#: Trip ids are broadcast up to so many bytes of text, more of them are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Refreshed:
    """The release that a refresh made or found, the date folders it wrote and the gate rows it passed."""

    release: Release
    dates: tuple[str, ...]
    gates: list[Row]


def change_set(trips: DataFrame, arrived: DataFrame) -> DataFrame:
    """What arriving rows change in ``trips``: rows to 'add' and to 'remove', as column ``change``.

    ``trips`` has one row per trip id. Applying the changes gives what ``dedup_latest`` gives on
    the rows of both, and a row that arrives again changes nothing. Of ``trips`` only those
    with an arriving id are shuffled, if the ids are few enough to be broadcast.
    """
    latest = dedup_latest(arrived.select(*trips.columns), ["trip_id"], ["ingestion_time"])
    ids = small(arrived.select("trip_id").distinct())
    known = trips.join(ids, "trip_id", "left_semi").select(*trips.columns)
    both = known.withColumn("arrived", F.lit(False)).unionByName(latest.withColumn("arrived", F.lit(True)))
    ranked = rank_latest(both, ["trip_id"], ["ingestion_time"])  # of equal rows the one that is there
    changed = ranked.where((F.col("row_number") == 1) == F.col("arrived"))
    change = F.when(F.col("arrived"), "add").otherwise("remove").alias("change")
    return changed.select(*trips.columns, change)


def apply_changes(trips: DataFrame, changes: DataFrame) -> DataFrame:
    """``trips`` without the removed and with the added rows."""
    gone = small(changes.where("change = 'remove'").select("trip_id"))
    added = changes.where("change = 'add'").select(*trips.columns)
    return trips.join(gone, "trip_id", "left_anti").select(*trips.columns).unionByName(added)


def small(ids: DataFrame) -> DataFrame:
    """Ids marked for broadcast if they are few; counts them."""
    found = ids.agg(F.coalesce(F.sum(F.octet_length("trip_id") + 16), F.lit(0))).first()[0]
    return F.broadcast(ids) if found <= BROADCAST_BYTES else ids


def refresh(
    spark: SparkSession, stream: str, root: str, run_id: str, cfg: PipelineConfig, keep: int | None = None
) -> Refreshed:
    """Take the stream's new loads into the tables that ``run_batch`` released below ``root``.

    ``stream`` is the valid-event table that a ``run_batch`` before read by its path (else all loads count
    as new, which gives the same rows for more work). Trips, daily mart and sums are rewritten for the
    dates of the change set, the monthly mart for its months; staging stays. The written dates pass the gates of the full
    run, then one release names all tables. If another run has released meanwhile, this one ends
    in a ``ReleaseConflict`` and changes nothing; it can be started again. The driver gets
    the dates only.
    """
    configure(spark)
    base = last_release(spark, root)
    if base is None or "int_trips" not in base.tables:
        raise LookupError(f"no trips have been released below {root}")
    loads, seen = arrived_since(spark, stream, base.seen)
    if not loads:
        return Refreshed(base, (), [])

    def write(df: DataFrame, name: str, by=(), cluster=()) -> DataFrame:
        return write_candidate(df, name, root, run_id, by, cluster)

    def whole(df: DataFrame) -> Run:
        return Run(run_id, df.schema.json())

    def released(name: str) -> DataFrame:
        return read_run(spark, root, name, base.tables[name])

    events = conform_stream(read_some_loads(spark, stream, loads, VALID_SCHEMA), cfg)
    arrived = write(events.select(*TRIP_SCHEMA.names), "trip_arrivals")
    changes = write(change_set(released("int_trips"), arrived), "trip_changes", ["change"])
    touched = changes.select("pickup_date").distinct()
    dates = tuple(sorted(f"pickup_date={r.pickup_date}" for r in touched.collect()))
    runs = {"trip_arrivals": whole(arrived), "trip_changes": whole(changes)}
    if not dates:
        return Refreshed(make_release(spark, root, runs, seen, base.number), (), [])

    old = base.tables["int_trips"]
    parts = parts_of(spark, root, "int_trips", old)
    before = Run(old.run_id, old.columns, {d: parts[d] for d in dates if d in parts})
    rebuilt = apply_changes(read_run(spark, root, "int_trips", before), changes)
    trips = write(rebuilt, "int_trips", INT_PARTITION, INT_CLUSTER)
    gates = require(
        stored_schema_gate(spark, run_path(root, "int_trips", run_id)),
        run_gates(trips, intermediate_gates(cfg.event)),
    )
    runs["int_trips"] = carried(spark, root, "int_trips", base, trips, run_id, dates)

    sums = content_sums(trips)
    kept = released("trip_sums").join(F.broadcast(touched), "pickup_date", "left_anti")
    all_sums = write(kept.unionByName(sums), "trip_sums")
    runs["trip_sums"] = whole(all_sums)

    daily = write(daily_mart(trips), "mart_daily", DAILY_PARTITION, DAILY_CLUSTER)
    runs["mart_daily"] = carried(spark, root, "mart_daily", base, daily, run_id, dates)

    month = F.trunc("pickup_date", "MM").alias("pickup_month")
    months = F.broadcast(touched.select(month).distinct())
    named = {d[: len("pickup_date=YYYY-MM")] for d in dates}
    now = runs["int_trips"]
    of_months = {d: r for d, r in now.parts.items() if d[: len("pickup_date=YYYY-MM")] in named}
    rows = read_run(spark, root, "int_trips", Run(now.run_id, now.columns, of_months))
    stay = released("mart_monthly").join(months, "pickup_month", "left_anti")
    monthly = write(stay.unionByName(monthly_mart(rows)), "mart_monthly")
    runs["mart_monthly"] = whole(monthly)

    written_sums = all_sums.join(F.broadcast(touched), "pickup_date", "left_semi")
    gates += require(
        run_gates(daily, MART_GATES),
        reconciliation_gate(reconcile(trips, daily, how="full")),
        content_gate(reconcile_content(written_sums, trips, daily)),
    )
    made = make_release(spark, root, runs, seen, base.number)
    if keep is not None:
        drop_old(spark, root, keep)
    return Refreshed(made, dates, gates)


def carried(
    spark: SparkSession, root: str, name: str, base: Release, written: DataFrame, run_id: str, dates: tuple[str, ...]
) -> Run:
    """A table whose ``dates`` are those of this run, if they have rows, and whose others stay in their runs."""
    run = Run(run_id, written.schema.json())
    stay = {d: r for d, r in parts_of(spark, root, name, base.tables[name]).items() if d not in dates}
    return Run(run_id, run.columns, stay | parts_of(spark, root, name, run))
