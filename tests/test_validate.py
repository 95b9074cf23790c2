import json
from dataclasses import replace
from datetime import date, datetime

import pytest
from conftest import AS_OF, GOOD, event

from tripmill.contract import DEAD_LETTER_SCHEMA, EVENT_FIELDS, VALID_SCHEMA, EventSpec, Field
from tripmill.operators.validate import split_valid, validate_events


def without(*names) -> str:
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


def at(pickup: str, **more) -> str:
    return event(pickup_datetime=pickup, event_time=pickup, **more)


# (payload, expected code); None means valid.
CASES = [
    (event(), None),
    ("not-json", "INVALID_JSON"),
    ("", "INVALID_JSON"),
    (event() + " x", "INVALID_JSON"),
    (event() + event(), "INVALID_JSON"),
    (event() + "," + event(), "INVALID_JSON"),
    (event() + "}", "INVALID_JSON"),
    (event() + "],[1", "INVALID_JSON"),
    (event() + ',"q":2', "INVALID_JSON"),
    (event()[:-1], "INVALID_JSON"),
    (event().replace("4.2", "NaN"), "INVALID_JSON"),
    (event().replace('"', "'"), "INVALID_JSON"),
    ("  " + event() + "\n", None),
    ("[]", "NOT_AN_OBJECT"),
    ("[" + event() + "]", "NOT_AN_OBJECT"),
    ("null", "NOT_AN_OBJECT"),
    ("3", "NOT_AN_OBJECT"),
    ('"text"', "NOT_AN_OBJECT"),
    ("{}", "MISSING_FIELDS"),
    (without("tip_amount"), "MISSING_FIELDS"),
    (event(pickup_datetime=None), "BAD_PICKUP_DATETIME"),
    (event(pickup_datetime="2025-06-15T08:30:00"), "BAD_PICKUP_DATETIME"),
    (event(pickup_datetime="08:30:00Z"), "BAD_PICKUP_DATETIME"),
    (event(pickup_datetime="2025-6-15T08:30:00Z"), "BAD_PICKUP_DATETIME"),
    (event(pickup_datetime="2025-02-30T08:30:00Z"), "BAD_PICKUP_DATETIME"),
    (event(pickup_datetime=20250615), "BAD_PICKUP_DATETIME"),
    (event(dropoff_datetime="2025-06-15"), "BAD_DROPOFF_DATETIME"),
    (event(event_time=["2025-06-15T08:30:00Z"]), "BAD_EVENT_TIME"),
    (event(ingestion_time={}), "BAD_INGESTION_TIME"),
    (event(event_time="2025-06-15T08:30:01Z"), "EVENT_TIME_MISMATCH"),
    (event(event_time="2025-06-15T15:30:00+07:00"), None),
    (event(ingestion_time="2025-09-01T00:00:00.000001Z"), "INGESTION_IN_FUTURE"),
    (event(ingestion_time="2025-09-01T00:00:00Z"), None),
    (at("2025-05-31T23:59:59.999999Z"), "OUTSIDE_EVENT_PERIOD"),
    (at("2025-06-01T00:00:00Z"), None),
    (at("2025-08-01T00:00:00Z"), "OUTSIDE_EVENT_PERIOD"),
    (event(dropoff_datetime="2025-06-15T08:30:00Z"), "BAD_DROPOFF_ORDER"),
    (event(dropoff_datetime="2025-08-01T00:00:00Z"), "BAD_DROPOFF_ORDER"),
    (event(dropoff_datetime="2025-07-31T23:59:59Z"), None),
    (event(pickup_location_id="abc"), "BAD_TYPE:pickup_location_id"),
    (event(dropoff_location_id=[1]), "BAD_TYPE:dropoff_location_id"),
    (event(passenger_count="3.7"), "BAD_TYPE:passenger_count"),
    (event(passenger_count=None), "BAD_TYPE:passenger_count"),
    (event().replace('"passenger_count": 2', '"passenger_count": 1e400'),
     "BAD_TYPE:passenger_count"),
    (event(payment_type={}), "BAD_TYPE:payment_type"),
    (event(trip_distance="NaN"), "BAD_TYPE:trip_distance"),
    (event(trip_distance="1e999"), "BAD_TYPE:trip_distance"),
    (event(trip_distance="true"), "BAD_TYPE:trip_distance"),
    (event(total_amount="Infinity"), "BAD_TYPE:total_amount"),
    (event(fare_amount="1.5d"), "BAD_TYPE:fare_amount"),
    (event(fare_amount="0x1p3"), "BAD_TYPE:fare_amount"),
    (event(tip_amount=""), "BAD_TYPE:tip_amount"),
    (event(tolls_amount=None), "BAD_TYPE:tolls_amount"),
    (event(pickup_location_id=0), "BAD_PICKUP_LOCATION"),
    (event(pickup_location_id=1), None),
    (event(pickup_location_id=265), None),
    (event(pickup_location_id=266), "BAD_PICKUP_LOCATION"),
    (event(dropoff_location_id=0), "BAD_DROPOFF_LOCATION"),
    (event(passenger_count=0), "BAD_PASSENGER_COUNT"),
    (event(passenger_count=6), None),
    (event(passenger_count=7), "BAD_PASSENGER_COUNT"),
    (event(payment_type=0), "BAD_PAYMENT_TYPE"),
    (event(payment_type=4), None),
    (event(payment_type=5), "BAD_PAYMENT_TYPE"),
    (event(trip_distance=0), "NON_POSITIVE_DISTANCE"),
    (event(trip_distance=-0.1), "NON_POSITIVE_DISTANCE"),
    (event(tip_amount=-0.01), "NEGATIVE_COMPONENT"),
    (event(fare_amount=-1), "NEGATIVE_COMPONENT"),
    (event(tolls_amount="-1"), "NEGATIVE_COMPONENT"),
    (event(total_amount=0), "NON_POSITIVE_TOTAL"),
    (event(source_type="batch"), "BAD_SOURCE_TYPE"),
    (event(source_type=None), "BAD_SOURCE_TYPE"),
    (event(event_id=None), "BAD_EVENT_ID"),
    # Unusual but convertible values.
    (event(passenger_count="3"), None),
    (event(passenger_count=3.7), None),
    (event(passenger_count=True), None),
    (event(passenger_count=1e0), None),
    (event(trip_distance=" 4.2 "), None),
    (event(trip_distance=True), None),
    (event(vendor="x"), None),
    (event(event_id=17), None),
    # Two rules broken: the earlier one is reported.
    (event(payment_type=9, source_type="batch"), "BAD_PAYMENT_TYPE"),
    (event(pickup_location_id=0, payment_type="abc"), "BAD_TYPE:payment_type"),
    (event(fare_amount="x", total_amount="x"), "BAD_TYPE:total_amount"),
    (event(event_time="bad", dropoff_datetime="bad"), "BAD_DROPOFF_DATETIME"),
    (at("2025-08-01T00:00:00Z", pickup_location_id="x"), "OUTSIDE_EVENT_PERIOD"),
    (event(tip_amount=-1, total_amount=0), "NEGATIVE_COMPONENT"),
    (event(ingestion_time="2030-01-01T00:00:00Z", event_time="2025-06-15T09:00:00Z"),
     "EVENT_TIME_MISMATCH"),
]


def test_first_broken_rule_is_reported(judge):
    rows = judge([payload for payload, _ in CASES])
    wrong = [
        (payload, want, row.error_code)
        for (payload, want), row in zip(CASES, rows, strict=True)
        if row.error_code != want
    ]
    assert not wrong
    assert all((r.error_code is None) == (r.error_reason is None) for r in rows)


def test_every_code_has_a_case():
    codes = {code for _, code in CASES}
    assert {f"BAD_TYPE:{f.name}" for f in EVENT_FIELDS if f.kind in ("integer", "number")} <= codes


def test_reasons_and_payload_are_kept(judge):
    rows = judge([b"not-json", "[]", without("total_amount", "event_id", "fare_amount"),
                  at("2025-08-01T00:00:00Z"), b'\xff{"a"', None])
    assert rows[0].raw_payload == "not-json"
    assert "must be an object" in rows[1].error_reason
    assert rows[2].error_reason == "missing fields: event_id, fare_amount, total_amount"
    assert "outside the period from 2025-06-01T00:00:00Z" in rows[3].error_reason
    assert rows[4].raw_payload == '�{"a"' and rows[4].error_code == "INVALID_JSON"
    assert rows[5].raw_payload == "" and rows[5].error_code == "INVALID_JSON"


def test_present_null_is_not_missing(judge):
    assert judge([event(tip_amount=None)])[0].error_code == "BAD_TYPE:tip_amount"


def test_repeated_key_takes_the_last_value(judge):
    text = event()[:-1] + ', "passenger_count": 5}'
    row = judge([text])[0]
    assert row.error_code is None and row.passenger_count == 5


def test_conversions(judge):
    payloads = [
        event(passenger_count="3"), event(passenger_count=3.7), event(passenger_count=True),
        event(trip_distance="  1.5e1 "), event(trip_distance=True), event(event_id=17),
    ]
    rows = judge(payloads)
    assert [r.passenger_count for r in rows[:3]] == [3, 3, 1]
    assert [r.trip_distance for r in rows[3:5]] == [15.0, 1.0]
    assert rows[5].event_id == "17"


@pytest.mark.parametrize(
    "text",
    [
        "2025-06-15T15:30:00+07:00", "2025-06-15T15:30:00+0700", "2025-06-15T15:30:00+07",
        "2025-06-15 08:30:00Z", "2025-06-15T08:30Z", "20250615T083000Z", "20250615T0830Z",
        "2025-06-15T08:30:00.000Z", "2025-06-15T08:30:00,0Z", "2025-06-15t08:30:00Z",
    ],
)
def test_spellings_of_one_instant(judge, text):
    row = judge([event(pickup_datetime=text)])[0]
    assert row.error_code is None and row.pickup_datetime == datetime(2025, 6, 15, 8, 30)


def test_valid_event_is_enriched(spark):
    frame = spark.createDataFrame([(event().encode(),)], "value binary")
    valid, rejected = split_valid(validate_events(frame, as_of=AS_OF))
    assert valid.schema.names == VALID_SCHEMA.names
    assert [f.dataType for f in valid.schema] == [f.dataType for f in VALID_SCHEMA]
    assert rejected.schema.names == DEAD_LETTER_SCHEMA.names
    row = valid.first()
    assert row.pickup_date == date(2025, 6, 15)
    assert row.trip_duration_minutes == 17.5
    assert row.fare_per_mile == 4.25
    assert row.ingestion_time == datetime(2025, 8, 20, 10, 0, 0, 123456)
    assert row.processing_time == datetime(2025, 9, 1)
    assert rejected.count() == 0


def test_text_payload_column(spark):
    frame = spark.createDataFrame([(event(),), ("[]",)], "body string")
    codes = {r.error_code for r in validate_events(frame, as_of=AS_OF, payload="body").collect()}
    assert codes == {None, "NOT_AN_OBJECT"}


STRICT = [
    (event(), None),
    (event(vendor=1), "CONTRACT_EXTRA_FIELDS"),
    (event(event_id="17"), "CONTRACT_EVENT_ID"),
    (event(event_id=17), "CONTRACT_EVENT_ID"),
    (event(passenger_count="3"), "CONTRACT_TYPE:passenger_count"),
    (event(passenger_count=3.7), "CONTRACT_TYPE:passenger_count"),
    (event(passenger_count=True), "CONTRACT_TYPE:passenger_count"),
    (event(passenger_count=3.0), None),
    (event(trip_distance="4.2"), "CONTRACT_TYPE:trip_distance"),
    (event(payment_type=9, vendor=1), "BAD_PAYMENT_TYPE"),
]


def test_strict_contract(judge):
    rows = judge([payload for payload, _ in STRICT], strict=True)
    assert [r.error_code for r in rows] == [code for _, code in STRICT]


def test_contract_limits():
    limits = {f.name: (f.minimum, f.maximum, f.above, f.allowed) for f in EVENT_FIELDS}
    assert limits["pickup_location_id"] == limits["dropoff_location_id"] == (1, 265, None, ())
    assert limits["passenger_count"] == (1, 6, None, ())
    assert limits["payment_type"][3] == (1, 2, 3, 4)
    assert limits["source_type"][3] == ("stream",)
    assert {n for n, limit in limits.items() if limit[2] == 0} == {"trip_distance", "total_amount"}
    assert {n for n, limit in limits.items() if limit[0] == 0} == {
        "fare_amount", "tip_amount", "tolls_amount"
    }


def test_random_events_are_valid_and_keep_their_bounds(spark):
    """Seeded random events within the contract all pass and satisfy the shared rules."""
    from pyspark.sql import functions as F

    from tripmill.operators.quality import invalid_trip
    from tripmill.sources.events import encode_events

    start = F.lit("2025-06-01 00:00:00").cast("timestamp")
    drawn = spark.range(500).select(
        F.col("id"),
        (F.rand(1) * 5_000_000).cast("int").alias("s"),
        (1 + F.rand(2) * 7000).cast("int").alias("d"),
        F.rand(3).alias("r"),
    )
    events = drawn.select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.timestamp_seconds(F.unix_seconds(start) + F.col("s")).alias("pickup_datetime"),
        F.timestamp_seconds(F.unix_seconds(start) + F.col("s") + F.col("d")).alias(
            "dropoff_datetime"
        ),
        F.lit(AS_OF).cast("timestamp").alias("ingestion_time"),
        (1 + F.col("id") % 265).alias("pickup_location_id"),
        (1 + (F.col("r") * 264).cast("int")).alias("dropoff_location_id"),
        (1 + F.col("id") % 6).alias("passenger_count"),
        F.round(0.1 + F.col("r") * 30, 2).alias("trip_distance"),
        F.round(3 + F.col("r") * 90, 2).alias("fare_amount"),
        F.lit(0.0).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.round(4 + F.col("r") * 90, 2).alias("total_amount"),
        (1 + F.col("id") % 4).alias("payment_type"),
        F.lit("stream").alias("source_type"),
    ).withColumn("event_time", F.col("pickup_datetime"))
    valid, rejected = split_valid(validate_events(encode_events(events).select("value"),
                                                  as_of=AS_OF))
    assert valid.count() == 500 and rejected.count() == 0
    assert valid.filter(invalid_trip()).count() == 0
    bad = ~F.col("passenger_count").between(1, 6) | ~F.col("payment_type").isin(1, 2, 3, 4)
    late = F.col("dropoff_datetime") >= F.lit("2025-08-01").cast("timestamp")
    assert valid.filter(bad | late | (F.col("total_amount") < F.col("fare_amount"))).count() == 0


def test_rules_follow_the_field_table(spark):
    changed = tuple(
        replace(f, minimum=5) if f.name == "fare_amount" else f
        for f in EVENT_FIELDS if f.name != "tolls_amount"
    )
    spec = EventSpec(fields=(*changed, Field("tax", "number", minimum=0)))
    body = {k: v for k, v in json.loads(event()).items() if k != "tolls_amount"}
    payloads = [{**body, "tax": 1}, {**body, "tax": 1, "fare_amount": 4.5}, {**body, "tax": "x"}, body]
    frame = spark.createDataFrame([(json.dumps(p).encode(),) for p in payloads], "value binary")
    found = [r.error_code for r in validate_events(frame, spec, AS_OF).collect()]
    assert found == [None, "NEGATIVE_COMPONENT", "BAD_TYPE:tax", "MISSING_FIELDS"]
