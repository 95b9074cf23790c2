import hashlib
import random
from datetime import datetime

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from tripmill.functions.numeric import exact_sum, half_even, rounded_ratio, to_integer
from tripmill.functions.text import fingerprint, rfc3339_text, rfc3339_timestamp


def test_half_even_rounds_the_binary_value_like_python(spark):
    draw = random.Random(5)
    values = [2.675, 0.125, 1.005, 0.375, 1234567.895, 0.0, 17.85 / 4.2]
    values += [draw.uniform(0, 500) for _ in range(300)] + [k / 1000 for k in range(5, 2000, 10)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", half_even("x").alias("y")
    )
    assert all(r.y == round(r.x, 2) for r in rows.collect())


def test_exact_sum_does_not_depend_on_order(spark):
    draw = random.Random(6)
    cents = [draw.randrange(1, 10**7) for _ in range(3000)]
    sums = set()
    for seed, parts in ((1, 1), (2, 3), (3, 8)):
        random.Random(seed).shuffle(cents)
        frame = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(parts)
        sums.add(frame.agg(exact_sum(F.col("x"))).first()[0])
    assert sums == {sum(cents) / 100}


def test_exact_sum_keeps_what_lies_beyond_four_decimals(spark):
    frame = spark.range(1000).select(F.lit(0.00001).alias("x"))
    assert abs(frame.agg(exact_sum(F.col("x"))).first()[0] - 0.01) < 1e-12


def test_exact_sum_of_large_values_has_the_same_bits_in_any_order(spark):
    draw = random.Random(7)
    values = [draw.randrange(1, 10**12) / 100 for _ in range(4000)]
    sums = set()
    for seed, parts in ((1, 1), (2, 3), (3, 8), (4, 16)):
        random.Random(seed).shuffle(values)
        frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        sums.add(frame.agg(exact_sum(F.col("x"))).first()[0])
    assert len(sums) == 1 and sums.pop() > 1.9e13


@pytest.mark.parametrize("odd", [float("inf"), float("nan"), 1e300, 9e14])
def test_exact_sum_fails_rather_than_drift(spark, odd):
    frame = spark.createDataFrame([(odd,), (odd,), (1.0,)], "x double").repartition(3)
    with pytest.raises(ArithmeticException):
        frame.agg(exact_sum(F.col("x"))).collect()


def test_rounded_ratio(spark):
    rows = [(246.90, 20, 12.35), (24.69, 2, 12.35), (1.0, 3, 0.33), (5.0, 0, None)]
    frame = spark.createDataFrame(rows, "total double, n long, want double")
    got = frame.select(rounded_ratio(F.col("total"), F.col("n")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_to_integer_rounds_half_away_from_zero(spark):
    rows = [(2.5, 3), (-2.5, -3), (1.4, 1), (None, None)]
    frame = spark.createDataFrame(rows, "x double, y long")
    assert all(r.i == r.y for r in frame.select(to_integer(F.col("x")).alias("i"), "y").collect())


def test_fingerprint(spark):
    frame = spark.createDataFrame(
        [(datetime(2025, 4, 1, 7, 5), 12, 1.5), (None, 12, 1.5)], "t timestamp, p int, d double"
    )
    first, second = frame.select(fingerprint(["t", "p", "d"]).alias("id")).collect()
    assert first.id == hashlib.sha256(b"2025-04-01 07:05:00|12|1.5").hexdigest()
    assert second.id is None


def test_timestamp_text_round_trip(spark):
    frame = spark.createDataFrame(
        [(datetime(2025, 6, 1),), (datetime(2025, 6, 1, 1, 2, 3, 450),)], "t timestamp"
    ).select("t", rfc3339_text("t").alias("s"))
    rows = frame.withColumn("back", rfc3339_timestamp("s")).collect()
    assert [r.s for r in rows] == ["2025-06-01T00:00:00Z", "2025-06-01T01:02:03.000450Z"]
    assert all(r.t == r.back for r in rows)


def test_timestamps_that_are_refused(spark):
    texts = ["2025-06-01", "now", "2025-06-01T00:00:00", "0000-01-01T00:00:00Z", "",
             "2025-06-01T24:00:00Z", "2025-06-01T00:00:00 Europe/Paris", "2025-06-0100:00:00Z",
             "2025-0601T00:00:00Z", "2025-06-01T00:0000Z", "x2025-06-01T00:00:00Z"]
    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    assert frame.filter(rfc3339_timestamp("s").isNotNull()).collect() == []
