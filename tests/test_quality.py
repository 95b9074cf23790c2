from datetime import date, datetime, timedelta

import pytest

from tripmill.contract import TRIP_SCHEMA, PipelineConfig, utc
from tripmill.operators import audit, quality

GOOD = {
    "trip_id": "a", "pickup_datetime": datetime(2025, 6, 3, 1),
    "dropoff_datetime": datetime(2025, 6, 3, 2), "pickup_date": date(2025, 6, 3),
    "pickup_location_id": 1, "dropoff_location_id": 265, "passenger_count": 1,
    "trip_distance": 1.0, "fare_amount": 0.0, "tip_amount": 0.0, "tolls_amount": 0.0,
    "total_amount": 6.0, "payment_type": 1, "source_type": "stream",
    "ingestion_time": datetime(2025, 8, 1),
}


def trips(spark, *changes):
    rows = [tuple({**GOOD, **c}[n] for n in TRIP_SCHEMA.names) for c in changes]
    return spark.createDataFrame(rows, TRIP_SCHEMA)


def outcome(df):
    return {r.gate: (r.passed, r.observed) for r in df.collect()}


def test_intermediate_gates(spark):
    gates = quality.intermediate_gates()
    fine = trips(spark, {}, {"trip_id": "b"})
    assert outcome(quality.run_gates(fine, gates)) == {
        "valid_values": (True, 0), "unique_trips": (True, 0)
    }
    broken = trips(
        spark, {}, {}, {"trip_id": None}, {"trip_distance": 0.0}, {"fare_amount": -1.0},
        {"total_amount": 0.0}, {"pickup_location_id": 0}, {"dropoff_location_id": 266},
        {"source_type": "other"}, {"dropoff_datetime": GOOD["pickup_datetime"]},
        {"trip_distance": None},
    )
    assert outcome(quality.run_gates(broken, gates)) == {
        "valid_values": (False, 7), "unique_trips": (False, 10)
    }
    assert audit.duplicate_rows(broken).first()[0] == 10
    assert audit.invalid_rows(broken).first()[0] == 7


def test_gates_on_empty_tables(spark):
    empty = trips(spark)
    assert outcome(quality.run_gates(empty, quality.intermediate_gates())) == {
        "valid_values": (True, 0), "unique_trips": (True, 0)
    }
    assert outcome(quality.run_gates(empty, quality.MART_GATES)) == {
        "daily_mart_not_empty": (False, 0)
    }
    assert outcome(quality.freshness_gate(empty, utc(2025, 9, 1), timedelta(days=1))) == {
        "stream_fresh": (False, 0)
    }


def test_require_blocks(spark):
    with pytest.raises(quality.GateFailure, match="unique_trips.*observed 1"):
        quality.require(
            quality.run_gates(trips(spark, {}, {}), quality.intermediate_gates())
        )
    passed = quality.require(quality.run_gates(trips(spark, {}), quality.intermediate_gates()))
    assert len(passed) == 2


def test_schema_gate_asks_for_a_subset(spark):
    frame = trips(spark, {}).selectExpr("*", "1 AS more")
    assert outcome(quality.schema_gate(frame)) == {"required_columns": (True, 15)}
    assert outcome(quality.schema_gate(frame.drop("trip_id"))) == {"required_columns": (False, 14)}


def test_stream_gates(spark):
    cfg = PipelineConfig()
    present = [quality.stream_present(cfg)]
    assert outcome(quality.run_gates(trips(spark, {}), present))["stream_present"] == (True, 1)
    outside = trips(spark, {"pickup_date": date(2025, 8, 1)}, {"source_type": "batch"})
    assert outcome(quality.run_gates(outside, present))["stream_present"] == (False, 0)
    arrived = trips(spark, {"ingestion_time": datetime(2025, 8, 31, 23)}, {})
    fresh = quality.freshness_gate(arrived, utc(2025, 9, 1), timedelta(hours=2))
    assert outcome(fresh) == {"stream_fresh": (True, 1)}
    stale = quality.freshness_gate(arrived, utc(2025, 9, 3), timedelta(hours=2))
    assert outcome(stale) == {"stream_fresh": (False, 0)}


def test_reconciliation(spark):
    frame = trips(spark, {}, {"trip_id": "b"}, {"source_type": "batch"})
    daily = spark.createDataFrame(
        [("stream", 2), ("batch", 1)], "source_type string, trip_count long"
    )
    rows = audit.reconcile(frame, daily).collect()
    assert [(r.source_type, r.intermediate_rows, r.mart_rows, r.reconciled) for r in rows] == [
        ("batch", 1, 1, True), ("stream", 2, 2, True)
    ]
    off = daily.withColumn("trip_count", daily.trip_count + 1)
    gate = quality.reconciliation_gate(audit.reconcile(frame, off, how="full"))
    assert outcome(gate) == {"mart_reconciles": (False, 2)}
    # A source that one side lacks must not pass unseen.
    lost = daily.filter("source_type = 'batch'")
    assert audit.reconcile(frame, lost).count() == 1
    gate = quality.reconciliation_gate(audit.reconcile(frame, lost, how="full"))
    assert outcome(gate) == {"mart_reconciles": (False, 1)}
    none = quality.reconciliation_gate(
        audit.reconcile(frame.limit(0), daily.limit(0), how="full")
    )
    assert outcome(none) == {"mart_reconciles": (False, 0)}


def test_audits(spark):
    frame = trips(
        spark, {}, {"trip_id": "b", "pickup_date": date(2025, 7, 1)}, {"trip_id": "b"},
        {"source_type": "batch", "pickup_date": date(2025, 4, 2)},
    )
    assert [tuple(r) for r in audit.coverage(frame).collect()] == [
        ("batch", date(2025, 4, 2), date(2025, 4, 2), 1),
        ("stream", date(2025, 6, 3), date(2025, 7, 1), 3),
    ]
    assert [tuple(r) for r in audit.lineage_counts(frame).collect()] == [
        ("batch", 1, 1), ("stream", 3, 2)
    ]


def test_inventory(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "b"))
    spark.range(5).write.parquet(str(tmp_path / "c"))
    tables = {"c": str(tmp_path / "c"), "b": str(tmp_path / "b")}
    rows = audit.table_inventory(spark, tables).collect()
    assert [(r.table_id, r.row_count) for r in rows] == [("b", 10), ("c", 5)]
    size = sum(f.stat().st_size for f in (tmp_path / "b").glob("*.parquet"))
    assert rows[0].size_bytes == size and rows[0].last_modified is not None
