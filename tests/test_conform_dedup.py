import random
from datetime import date, datetime

from pyspark.sql import functions as F

from tripmill.contract import BATCH_SCHEMA, TRIP_SCHEMA, PipelineConfig, utc
from tripmill.operators.conform import batch_rules, conform_batch, conform_stream
from tripmill.operators.dedup import dedup_latest, rank_latest
from tripmill.plans.intermediate import build_intermediate, unify

CFG = PipelineConfig(as_of=utc(2025, 9, 1))

GOOD = {
    "lpep_pickup_datetime": datetime(2025, 4, 10, 12, 0),
    "lpep_dropoff_datetime": datetime(2025, 4, 10, 12, 20),
    "PULocationID": 10,
    "DOLocationID": 20,
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "fare_amount": 14.0,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "total_amount": 17.0,
    "payment_type": 1.0,
}


def staged(spark, *changes):
    rows = [tuple({**GOOD, **c}[n] for n in BATCH_SCHEMA.names) for c in changes]
    return spark.createDataFrame(rows, BATCH_SCHEMA)


def test_batch_rules_drop_false_and_null(spark):
    dropped = [
        {"lpep_pickup_datetime": datetime(2025, 3, 31, 23, 59, 59)},
        {"lpep_pickup_datetime": datetime(2025, 6, 1),
         "lpep_dropoff_datetime": datetime(2025, 6, 2)},
        {"lpep_dropoff_datetime": GOOD["lpep_pickup_datetime"]},
        {"lpep_dropoff_datetime": None},
        {"PULocationID": 0}, {"PULocationID": 266}, {"DOLocationID": 0}, {"DOLocationID": None},
        {"trip_distance": 0.0}, {"fare_amount": -0.01}, {"total_amount": 0.0},
        *[{n: float("nan")} for n in ("trip_distance", "fare_amount", "total_amount")],
    ]
    kept = [
        {}, {"fare_amount": 0.0}, {"passenger_count": 9.0}, {"payment_type": 5.0},
        {"tip_amount": -1.0}, {"tolls_amount": None},
        {"lpep_pickup_datetime": datetime(2025, 5, 31, 23, 0),
         "lpep_dropoff_datetime": datetime(2025, 6, 1)},
    ]
    assert len(batch_rules(CFG)) == 10
    assert conform_batch(staged(spark, *dropped), CFG).count() == 0
    assert conform_batch(staged(spark, *kept), CFG).count() == len(kept)


def test_batch_conform_casts_and_defaults(spark):
    frame = conform_batch(
        staged(spark, {"passenger_count": None}, {"passenger_count": 2.5, "payment_type": None}),
        CFG,
    )
    assert frame.schema.names == TRIP_SCHEMA.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in TRIP_SCHEMA]
    first, second = sorted(frame.collect(), key=lambda r: r.passenger_count)
    assert (first.passenger_count, second.passenger_count) == (1, 3)
    assert second.payment_type is None
    assert first.trip_id == second.trip_id  # neither column is part of the identity
    assert first.pickup_date == date(2025, 4, 10)
    assert first.ingestion_time == datetime(2025, 9, 1) and first.source_type == "batch"


def stream_rows(spark, *changes):
    base = {
        "event_id": "e1", "pickup_datetime": datetime(2025, 6, 3, 1), "source_type": "stream",
        "dropoff_datetime": datetime(2025, 6, 3, 2), "pickup_date": date(2025, 6, 3),
        "pickup_location_id": 1, "dropoff_location_id": 2, "passenger_count": 1,
        "trip_distance": 1.0, "fare_amount": 5.0, "tip_amount": 0.0, "tolls_amount": 0.0,
        "total_amount": 6.0, "payment_type": 1, "ingestion_time": datetime(2025, 8, 1),
    }
    names = list(base)
    types = {n: TRIP_SCHEMA[n].dataType.simpleString() for n in names if n != "event_id"}
    ddl = ", ".join(f"{n} {types.get(n, 'string')}" for n in names)
    return spark.createDataFrame([tuple({**base, **c}[n] for n in names) for c in changes], ddl)


def test_stream_refilter_and_union(spark):
    stream = stream_rows(
        spark, {}, {"event_id": "late", "pickup_date": date(2025, 8, 1)},
        {"event_id": "early", "pickup_date": date(2025, 5, 31)},
    )
    assert [r.trip_id for r in conform_stream(stream, CFG).collect()] == ["e1"]
    both = unify(staged(spark, {}, {}), stream, CFG)
    assert {(r.source_type, r["count"]) for r in both.groupBy("source_type").count().collect()} == {
        ("batch", 2), ("stream", 1)
    }


def test_latest_delivery_wins_and_ties_are_settled(spark):
    stream = stream_rows(
        spark,
        {"tip_amount": 1.0, "ingestion_time": datetime(2025, 8, 1)},
        {"tip_amount": 9.0, "ingestion_time": datetime(2025, 8, 3)},
        {"tip_amount": 5.0, "ingestion_time": datetime(2025, 8, 2)},
        {"tip_amount": 7.0, "ingestion_time": None},
    )
    batch = staged(spark, {"tip_amount": 4.0}, {"tip_amount": 3.0})
    for parts in (1, 2, 5):
        rows = build_intermediate(batch.repartition(parts), stream.repartition(parts), CFG)
        assert sorted((r.source_type, r.tip_amount) for r in rows.collect()) == [
            ("batch", 3.0), ("stream", 9.0)
        ]


def test_dedup_against_brute_force_with_a_hot_key(spark):
    draw = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{draw.randrange(400)}", draw.randrange(50),
             draw.randrange(1000)) for i in range(6000)]
    best = {}
    for key, seen, value in rows:
        best[key] = max(best.get(key, (-1, 0)), (seen, -value))
    want = sorted((k, s, -v) for k, (s, v) in best.items())
    frame = spark.createDataFrame(rows, "k string, seen int, v int")
    for parts in (1, 7):
        got = dedup_latest(frame.repartition(parts), ["k"], ["seen"]).collect()
        assert sorted((r.k, r.seen, r.v) for r in got) == want
    ranked = rank_latest(frame, ["k"], ["seen"])
    assert ranked.filter("k = 'hot'").agg(F.max("row_number")).first()[0] == 2000
