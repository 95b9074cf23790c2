"""Payloads are built, checked and landed by all cores, in methods that the JVM compiles."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tripmill.adapters import raw_events
from tripmill.session import JOB_SETTINGS, configure, workers

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def lake(spark, path, rows=300):
    """One file of one row group."""
    events = spark.range(0, rows, 1, 1).select(
        F.col("id").alias("event_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00' + make_interval(0, 0, 0, 0, 0, id)").alias("ts"),
        (F.col("id") % 9).alias("user_id"),
        (F.col("id") / 4).alias("value"),
    )
    events.write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.fixture
def own_limit(spark):
    before = spark.conf.get(LIMIT)
    yield spark
    spark.conf.set(LIMIT, before)


@pytest.mark.parametrize(("given", "kept"), [("65535", JOB_SETTINGS[LIMIT]), ("4000", "4000")])
def test_a_session_gets_methods_that_are_compiled(own_limit, given, kept):
    own_limit.conf.set(LIMIT, given)
    assert configure(own_limit).conf.get(LIMIT) == kept


def test_payloads_of_one_row_group_are_built_by_all_cores(spark, tmp_path):
    payloads = raw_events(spark, lake(spark, tmp_path))
    assert payloads.rdd.getNumPartitions() == workers(spark)
    assert payloads.count() == 300 + 43


def test_landed_parts_hold_every_payload_in_files_for_all_cores(spark, tmp_path):
    sf_dir = lake(spark, tmp_path / "lake")
    for part, files in enumerate(entry.land_late(spark, sf_dir, str(tmp_path / "stream")), 1):
        assert files == entry.BATCHES * workers(spark)
        assert len(list((tmp_path / "stream" / "landing" / str(part)).glob("*.parquet"))) == files
    landed = spark.read.parquet(f"{tmp_path}/stream/landing/*")
    expected = raw_events(spark, sf_dir)
    assert landed.count() == expected.count()
    assert landed.exceptAll(expected).isEmpty()
    late = spark.read.parquet(f"{tmp_path}/stream/landing/2")
    assert late.where("crc32(value) % 3 <> 0").isEmpty()


def test_bytes_of_payloads_are_taken_as_they_are(spark, tmp_path):
    """The texts are built valid; ``encode`` would walk every one of them to see that."""
    payloads = raw_events(spark, lake(spark, tmp_path))
    assert "encode(" not in payloads._jdf.queryExecution().optimizedPlan().toString()
    broken = payloads.filter("NOT is_valid_utf8(CAST(value AS STRING))").count()
    assert broken == sum(2 if i % 7 == 0 else 1 for i in range(300) if i % 50 == 37)


def test_equal_events_are_dealt_to_all_parts_without_a_sort(spark, tmp_path):
    one = spark.range(0, 4000, 1, 1).selectExpr(
        "CAST(NULL AS BIGINT) AS event_id", "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS ts", "3L AS user_id", "1.5D AS value"
    )
    one.write.parquet(f"{tmp_path}/events.parquet")
    payloads = raw_events(spark, str(tmp_path))
    assert "RoundRobin" not in payloads._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in payloads.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == workers(spark) and max(sizes) < 2 * 4000 / workers(spark)
