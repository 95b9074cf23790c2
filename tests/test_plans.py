"""Properties of the physical plans that must hold at any size."""

import contextlib
import io
import re
from datetime import datetime
from pathlib import Path

from conftest import AS_OF
from pyspark.sql import functions as F

from tripmill.adapters import batch_trips, raw_events, stream_trips
from tripmill.contract import BATCH_SCHEMA, VALID_SCHEMA, PipelineConfig
from tripmill.operators.conform import conform_batch, conform_stream
from tripmill.operators.dedup import dedup_latest
from tripmill.operators.quality import STAGING_GATES, intermediate_gates, run_gates
from tripmill.operators.validate import split_valid, validate_events
from tripmill.plans.batch import in_period, replace_staging
from tripmill.plans.intermediate import build_intermediate
from tripmill.plans.marts import daily_mart

CFG = PipelineConfig(as_of=AS_OF)


def plan(df) -> str:
    """The text of ``explain("formatted")``: operators first, then their details."""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


def operators(text: str, name: str) -> int:
    """How many nodes of this name the operator tree shows."""
    return len(re.findall(rf"\b{name}\b", text.split("\n\n\n")[0]))


def shuffles(text: str) -> int:
    return len(re.findall(r"Arguments: \w*partitioning\(", text))


def read_columns(text: str) -> set[str]:
    return {c.split(":")[0] for c in re.search(r"ReadSchema: struct<(.*)>", text)[1].split(",")}


def empty(spark, schema, path):
    spark.createDataFrame([], schema).write.parquet(str(path))
    return spark.read.schema(schema).parquet(str(path))


def test_dedup_limits_each_key_before_its_one_shuffle(spark):
    frame = spark.range(9).select(F.hash("id").alias("k"), F.col("id").alias("t"))
    text = plan(dedup_latest(frame, ["k"], ["t"]))
    assert shuffles(text) == 1
    assert operators(text[text.index("Exchange"):], "WindowGroupLimit") == 1


def test_intermediate_has_one_shuffle_and_no_python(spark, tmp_path):
    batch = empty(spark, BATCH_SCHEMA, tmp_path / "b")
    stream = empty(spark, VALID_SCHEMA, tmp_path / "s")
    trips = build_intermediate(batch, stream, CFG)
    assert shuffles(plan(trips)) == 1
    text = plan(daily_mart(trips))
    assert shuffles(text) == 2
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_batch_filters_reach_the_files(spark, tmp_path):
    text = plan(conform_batch(empty(spark, BATCH_SCHEMA, tmp_path / "b"), CFG))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text)[1]
    for part in ("GreaterThanOrEqual(lpep_pickup_datetime,2025-04-01", "LessThan(lpep_pickup",
                 "GreaterThanOrEqual(PULocationID,1)", "GreaterThan(trip_distance,0.0)"):
        assert part in pushed


def test_stream_period_prunes_partitions(spark, tmp_path):
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in VALID_SCHEMA]
    row = spark.range(1).select(*nulls).withColumn("pickup_date", F.current_date())
    row.write.partitionBy("pickup_date").parquet(str(tmp_path / "s"))
    stream = spark.read.schema(VALID_SCHEMA).parquet(str(tmp_path / "s"))
    text = plan(conform_stream(stream, CFG))
    assert re.search(r"PartitionFilters: \[.*pickup_date", text)


def test_payload_is_parsed_once_for_each_output(spark, tmp_path):
    raw = empty(spark, "value binary", tmp_path / "r")
    for part in split_valid(validate_events(raw, as_of=AS_OF)):
        text = plan(part)
        assert text.count("VariantExpressionEvalUtils.parseJson") == 1
        assert shuffles(text) == 0 and "Python" not in text


def test_gates_of_a_table_share_one_scan(spark, tmp_path):
    staging = empty(spark, BATCH_SCHEMA, tmp_path / "b")
    text = plan(run_gates(staging, STAGING_GATES))
    assert operators(text, "Scan parquet") == 1
    assert read_columns(text) == {
        "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID"
    }
    trips = conform_batch(staging, CFG)
    text = plan(run_gates(trips, intermediate_gates()))
    assert operators(text, "Scan parquet") == 1 and operators(text, "Expand") == 0


def test_mart_reads_only_its_columns(spark, tmp_path):
    from tripmill.contract import TRIP_SCHEMA

    text = plan(daily_mart(empty(spark, TRIP_SCHEMA, tmp_path / "t")))
    assert read_columns(text) == {
        "pickup_datetime", "dropoff_datetime", "pickup_date", "trip_distance", "total_amount",
        "source_type",
    }
    assert shuffles(text) == 1 and "partial_" in text[text.index("(1) Scan"):]


def test_staging_reads_only_the_days_of_the_period(spark, tmp_path):
    rows = [(datetime(2025, m, 10, 8), datetime(2025, m, 10, 9), 1, 2, 1.0, 3.0, 5.0, 0.0, 0.0, 6.0, 1.0)
            for m in range(1, 9)]
    staging = replace_staging(spark.createDataFrame(rows, BATCH_SCHEMA), str(tmp_path), "r1")
    events = spark.createDataFrame([], VALID_SCHEMA)
    built = build_intermediate(in_period(staging, CFG), events, CFG)
    assert re.search(r"PartitionFilters: \[[^]]*pickup_date", plan(built))
    assert built.count() == 2
    read = in_period(staging, CFG).select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) == 2


def test_no_registered_input_is_dealt_round_robin(spark):
    at = "/root/testdata/sf0.001"
    if Path(at).exists():
        for source in (batch_trips, raw_events, stream_trips):
            assert "RoundRobin" not in plan(source(spark, at))
