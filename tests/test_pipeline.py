from datetime import date, datetime

import pytest
from conftest import AS_OF, event
from pyspark.sql import functions as F
from test_conform_dedup import staged

from tripmill.contract import (
    DAILY_MART_SCHEMA,
    MONTHLY_MART_SCHEMA,
    TRIP_SCHEMA,
    PipelineConfig,
)
from tripmill.operators.audit import content_sums, reconcile_content
from tripmill.operators.quality import GateFailure, content_gate, require, stored_schema_gate
from tripmill.operators.validate import split_valid, validate_events
from tripmill.plans.batch import run_batch
from tripmill.plans.reports import batch_monthly_report, batch_vs_stream_report
from tripmill.sources.tables import current_table

CFG = PipelineConfig(as_of=AS_OF)


def stream(spark, *payloads):
    frame = spark.createDataFrame([(p.encode(),) for p in payloads], "value binary")
    return split_valid(validate_events(frame, as_of=AS_OF))[0]


def batch(spark):
    may = {"lpep_pickup_datetime": datetime(2025, 5, 2, 8),
           "lpep_dropoff_datetime": datetime(2025, 5, 2, 8, 10, 30)}
    return staged(
        spark,
        {}, {},                                    # the same trip delivered twice
        {"DOLocationID": 21, "total_amount": 17.01},
        {**may, "trip_distance": 1.25, "total_amount": 9.99},
        {"fare_amount": -3.0},
    )


def test_whole_run(spark, tmp_path):
    again = event(tip_amount=9.0, total_amount=29.35, ingestion_time="2025-08-21T00:00:00Z")
    events = stream(spark, event(), again, event(event_id="other"))
    built = run_batch(spark, batch(spark), events, str(tmp_path), "r1", CFG)
    assert {g.gate for g in built.gates} == {
        "batch_not_empty", "batch_required_nulls", "required_columns", "valid_values",
        "unique_trips", "stream_present", "daily_mart_not_empty", "mart_reconciles",
        "content_reconciles",
    }
    assert built.staging.count() == 5 and built.trips.count() == 5
    for frame, schema in ((built.trips, TRIP_SCHEMA), (built.daily, DAILY_MART_SCHEMA),
                          (built.monthly, MONTHLY_MART_SCHEMA)):
        assert [(f.name, f.dataType) for f in frame.schema] == [
            (f.name, f.dataType) for f in schema
        ]
    assert [tuple(r) for r in built.daily.orderBy("pickup_date", "source_type").collect()] == [
        # 17.00 and 17.01: the mean 17.005 lies between two cents and is rounded up.
        (date(2025, 4, 10), "batch", 2, 34.01, 17.01, 3.0, 20.0),
        (date(2025, 5, 2), "batch", 1, 9.99, 9.99, 1.25, 10.5),
        (date(2025, 6, 15), "stream", 2, 53.2, 26.6, 4.2, 17.5),
    ]
    assert [tuple(r) for r in batch_monthly_report(built.monthly).collect()] == [
        (date(2025, 4, 1), 2, 34.01, 17.01, 3.0),
        (date(2025, 5, 1), 1, 9.99, 9.99, 1.25),
    ]
    assert [tuple(r) for r in batch_vs_stream_report(built.daily).collect()] == [
        ("batch", 3, 44.0, 14.67, 2.42),
        ("stream", 2, 53.2, 26.6, 4.2),
    ]
    # A rerun replaces every table instead of adding to it.
    rerun = run_batch(spark, batch(spark), events, str(tmp_path), "r2", CFG)
    assert rerun.trips.count() == 5
    assert current_table(spark, "int_trips", str(tmp_path)).count() == 5
    assert current_table(spark, "mart_daily", str(tmp_path)).count() == 3


def test_one_changed_amount_is_found(spark, tmp_path):
    built = run_batch(spark, batch(spark), stream(spark, event()), str(tmp_path), "r1", CFG)
    kept = content_sums(built.trips)
    assert content_gate(reconcile_content(kept, built.trips.repartition(3), built.daily)).first().passed
    may = F.col("pickup_date") == F.lit(date(2025, 5, 2))
    more = F.when(may, F.col("tip_amount") + 0.01).otherwise(F.col("tip_amount"))
    changed = built.trips.withColumn("tip_amount", more)
    gate = content_gate(reconcile_content(kept, changed, built.daily)).first()
    assert tuple(gate) == ("content_reconciles at 2025-05-02 batch", False, 1)
    cents = F.when(may, F.col("total_revenue") + 0.01).otherwise(F.col("total_revenue"))
    marts = [built.daily.withColumn("total_revenue", cents), built.daily.where(~may)]
    for mart in marts:
        with pytest.raises(GateFailure, match="2025-05-02 batch"):
            require(content_gate(reconcile_content(kept, built.trips, mart)))
    twice = built.trips.unionByName(built.trips).unionByName(built.trips)
    assert content_gate(reconcile_content(kept, twice, built.daily)).first().observed == 3
    assert not content_gate(reconcile_content(kept.limit(0), built.trips.limit(0), built.daily.limit(0))).first().passed


def test_failed_gate_stops_the_run(spark, tmp_path):
    root = tmp_path / "blocked"
    with pytest.raises(GateFailure, match="batch_required_nulls"):
        run_batch(spark, staged(spark, {}, {"PULocationID": None}), stream(spark, event()),
                  str(root), "r1", CFG)
    assert not (root / "int_trips").exists()
    with pytest.raises(GateFailure, match="stream_present"):
        run_batch(spark, batch(spark), stream(spark, "[]"), str(root), "r2", CFG)
    assert not (root / "mart_daily").exists()
    with pytest.raises(GateFailure, match="batch_not_empty"):
        run_batch(spark, batch(spark).limit(0), stream(spark, event()), str(root), "r3", CFG)


def test_readers_see_the_last_good_version(spark, tmp_path):
    root = str(tmp_path)
    run_batch(spark, batch(spark), stream(spark, event()), root, "r1", CFG)
    with pytest.raises(GateFailure, match="stream_present"):
        run_batch(spark, batch(spark).limit(2), stream(spark, "[]"), root, "r2", CFG)
    assert current_table(spark, "int_trips", root).count() == 4


def test_stored_columns_are_checked(spark, tmp_path):
    full = spark.createDataFrame([], TRIP_SCHEMA)
    rows = full.unionByName(spark.range(1).selectExpr("'x' AS trip_id"), allowMissingColumns=True)
    rows.write.parquet(str(tmp_path / "whole"))
    rows.drop("tolls_amount").write.parquet(str(tmp_path / "lacking"))
    found = [stored_schema_gate(spark, str(tmp_path / n)).first() for n in ("whole", "lacking", "none")]
    assert [(r.passed, r.observed) for r in found] == [(True, 15), (False, 14), (False, 0)]


def test_run_from_paths(spark, tmp_path):
    batch(spark).write.parquet(str(tmp_path / "month"))
    events = stream(spark, event())
    events.write.partitionBy("pickup_date").parquet(str(tmp_path / "events"))
    built = run_batch(spark, [str(tmp_path / "month")], str(tmp_path / "events"),
                      str(tmp_path / "out"), "r1", CFG)
    assert built.trips.count() == 4
