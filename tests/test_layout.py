"""Rows of a file in the order of a space-filling curve."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmill.sources.layout import interleaved
from tripmill.sources.tables import laid_out, write_run


def slow(cells, bits):
    """The same number, bit by bit, highest bits first."""
    return int("".join(f"{c:0{bits}b}"[i] for i in range(bits) for c in cells), 2)


def test_values_are_those_of_plain_python(spark):
    rows = [(a, b) for a in (None, -5, 0, 1, 9, 15, 16, 99) for b in (None, 0, 3, 63, 64, 1000)]
    frame = spark.createDataFrame(rows, "a bigint, b bigint")
    z = interleaved(("a", 0, 15), ("b", 0, 63), bits=4)
    for r in frame.withColumn("z", F.expr(z)).collect():
        a, b = min(15, max(0, r.a or 0)), min(15, max(0, (r.b or 0) // 4))
        assert r.z == slow((a, b), 4), r


def test_too_many_bits():
    with pytest.raises(ValueError):
        interleaved(("a", 0, 9), bits=63)
    with pytest.raises(ValueError):
        interleaved()


def groups(path, column, low, high):
    """Row groups that a filter has to read, and all of them."""
    read = every = 0
    for file in path.glob("**/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        for i in range(meta.num_row_groups):
            found = meta.row_group(i).column(at).statistics
            every += 1
            read += found.min <= high and found.max >= low
    return read, every


def test_a_filter_on_any_column_skips_row_groups(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "20000")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # one file of many row groups
    try:
        rows = spark.range(60_000).selectExpr(
            "CAST(1 + xxhash64(id, 1) % 132 + 132 AS INT) AS zone", "CAST(abs(xxhash64(id, 2)) % 1440 AS INT) AS minute",
            "xxhash64(id) AS other",
        ).coalesce(1)
        write_run(rows, str(tmp_path / "curve"), [], [interleaved(("zone", 1, 265), ("minute", 0, 1439))])
        write_run(rows, str(tmp_path / "columns"), [], ["zone", "minute"])
    finally:
        conf.unset("parquet.block.size")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    by_column, every = groups(tmp_path / "columns", "minute", 600, 630)
    assert every >= 16 and by_column > every * 0.8
    for column, low, high in (("minute", 600, 630), ("zone", 100, 104)):
        read, every = groups(tmp_path / "curve", column, low, high)
        assert every >= 16 and read <= every * 0.45
    assert spark.read.parquet(str(tmp_path / "curve")).count() == 60_000


def test_places_are_worked_out_once_per_row_not_in_comparisons(spark):
    rows = spark.range(9).selectExpr("id % 3 AS day", "id AS zone", "7 - id AS minute")
    laid = laid_out(rows, ["day"], ["zone", interleaved(("zone", 0, 9), ("minute", 0, 9))])
    plan = laid._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "shift" not in sorts[0] and "shift" in plan
    assert laid.columns == rows.columns
    assert sorted(laid.collect()) == sorted(rows.collect())
