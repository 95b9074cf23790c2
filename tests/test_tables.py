from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripmill.contract import BATCH_SCHEMA
from tripmill.operators.quality import stored_schema_gate
from tripmill.sources import footers
from tripmill.sources.tables import (
    SchemaMismatch,
    append_batch,
    compact,
    current_table,
    drop_replaced,
    load_trips,
    publish,
    read_loads,
    read_table,
    replace_table,
    write_candidate,
    write_run,
)


def month(spark, path, passenger_type, extra=False):
    frame = spark.range(4).select(
        F.lit(datetime(2025, 4, 1)).cast("timestamp_ntz").alias("lpep_pickup_datetime"),
        F.lit(datetime(2025, 4, 1, 1)).cast("timestamp_ntz").alias("lpep_dropoff_datetime"),
        F.lit(1).alias("PULocationID"),
        F.lit(2).cast("long").alias("DOLocationID"),
        F.when(F.col("id") > 0, F.col("id")).cast(passenger_type).alias("passenger_count"),
        *[F.lit(1.5).alias(n) for n in BATCH_SCHEMA.names if n.endswith(("amount", "distance"))],
        F.lit(2).cast(passenger_type).alias("payment_type"),
        *([F.lit("x").alias("ehail_fee")] if extra else []),
    )
    frame.write.parquet(path)
    return path


def test_load_trips_across_type_drift(spark, tmp_path):
    paths = [
        month(spark, str(tmp_path / "04"), "bigint"),
        month(spark, str(tmp_path / "05"), "double", extra=True),
        month(spark, str(tmp_path / "06"), "bigint"),
    ]
    loaded = load_trips(spark, paths)
    assert loaded.schema == BATCH_SCHEMA
    assert loaded.count() == 12
    assert loaded.filter("passenger_count IS NULL").count() == 3
    assert loaded.agg(F.sum("passenger_count")).first()[0] == 18.0


def test_load_trips_from_one_folder_and_a_glob(spark, tmp_path):
    """Months of one folder may differ in type, whether named by the folder or by a glob."""
    for name, kind in (("m=04", "bigint"), ("m=05", "double"), ("m=06", "int")):
        month(spark, str(tmp_path / "months" / name), kind)
    for path in (str(tmp_path / "months"), str(tmp_path / "months" / "m=*")):
        loaded = load_trips(spark, [path])
        assert loaded.schema == BATCH_SCHEMA and loaded.count() == 12
        assert loaded.agg(F.sum("passenger_count")).first()[0] == 18.0


def jobs_of(spark, name, work):
    """The result, and how many Spark jobs it took."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def many_files(spark, tmp_path, folders, each):
    """Small files of two types, written without Spark."""
    for i, (folder, kind) in enumerate(folders):
        one = month(spark, str(tmp_path / f"one{i}"), kind)
        table = pq.read_table(one)
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        for n in range(each):
            pq.write_table(table, tmp_path / folder / f"{kind}-{n}.parquet")


def test_thousands_of_files_are_typed_by_three_jobs(spark, tmp_path):
    many_files(spark, tmp_path, [("all/m=04", "bigint"), ("all/m=05", "double")], 2500)
    load, jobs = jobs_of(spark, "footers", lambda: load_trips(spark, [str(tmp_path / "all")]))
    assert jobs <= 3
    assert len(load.inputFiles()) == 5000 and load.count() == 20_000
    assert load.agg(F.sum("passenger_count")).first()[0] == 30_000.0


def test_files_of_two_types_in_one_folder(spark, tmp_path):
    many_files(spark, tmp_path, [("all", "bigint"), ("all", "double"), ("all/odd [x]{y}", "int")], 20)
    loaded = load_trips(spark, [str(tmp_path / "all")])
    assert loaded.schema == BATCH_SCHEMA and loaded.count() == 240
    assert loaded.agg(F.sum("passenger_count")).first()[0] == 360.0


def test_files_that_tasks_cannot_open_are_typed_by_spark(spark, tmp_path, monkeypatch):
    many_files(spark, tmp_path, [("all", "bigint"), ("all", "double")], 3)
    before = load_trips(spark, [str(tmp_path / "all")]).count()
    opaque = [footers.Layout(None, frozenset(), "", 6, {str(tmp_path / "all")})]
    monkeypatch.setattr("tripmill.sources.tables.layouts", lambda *a: opaque)
    assert load_trips(spark, [str(tmp_path / "all")]).count() == before == 24
    assert footers.footer("viewfs://store/x.parquet", ["a"]) == (None, "")


def test_one_file_without_a_column_is_found(spark, tmp_path):
    many_files(spark, tmp_path, [("all", "bigint")], 30)
    whole = pq.read_table(tmp_path / "all" / "bigint-0.parquet")
    pq.write_table(whole.drop_columns(["tip_amount"]), tmp_path / "all" / "bigint-17.parquet")
    with pytest.raises(SchemaMismatch, match="tip_amount"):
        load_trips(spark, [str(tmp_path / "all")])
    found = stored_schema_gate(spark, str(tmp_path / "all"), BATCH_SCHEMA.names).first()
    assert (found.passed, found.observed) == (False, len(BATCH_SCHEMA.names) - 1)
    parted = stored_schema_gate(spark, str(tmp_path / "none"), ["a"]).first()
    assert (parted.passed, parted.observed) == (False, 0)
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(str(tmp_path / "q=1" / "parted"))
    found = stored_schema_gate(spark, str(tmp_path / "q=1" / "parted"), ["id", "p", "q"]).first()
    assert (found.passed, found.observed) == (False, 2)


def test_load_trips_names_missing_columns(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(SchemaMismatch, match="lpep_pickup_datetime"):
        load_trips(spark, [str(tmp_path / "bad")])


def test_replace_table_swaps_whole_runs(spark, tmp_path):
    root = str(tmp_path)
    first = spark.range(10).select("id", F.current_date().alias("d"))
    assert replace_table(first, "t_swap", root, "r1", ["d"]).count() == 10
    second = first.filter("id < 3")
    replace_table(second, "t_swap", root, "r2", ["d"])
    assert current_table(spark, "t_swap", root).columns == ["id", "d"]
    assert current_table(spark, "t_swap", root).count() == 3
    replace_table(second, "t_swap", root, "r2", ["d"])  # a rerun replaces itself
    assert current_table(spark, "t_swap", root).count() == 3


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    replace_table(spark.range(5), "t_keep", root, "r1")
    failing = spark.range(5).withColumn("id", F.raise_error(F.lit("boom")).cast("long"))
    with pytest.raises(Exception, match="boom"):
        replace_table(failing, "t_keep", root, "r2")
    assert current_table(spark, "t_keep", root).count() == 5


def test_replacing_a_table_from_itself(spark, tmp_path):
    root = str(tmp_path)
    replace_table(spark.range(5), "t_self", root, "r1")
    replace_table(current_table(spark, "t_self", root).filter("id > 1"), "t_self", root, "r2")
    assert current_table(spark, "t_self", root).count() == 3


def test_replacing_by_no_rows(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(5).withColumn("d", F.current_date())
    replace_table(rows, "t_none", root, "r1", ["d"])
    assert replace_table(rows.limit(0), "t_none", root, "r2", ["d"]).count() == 0
    assert current_table(spark, "t_none", root).count() == 0
    assert current_table(spark, "t_none", root).dtypes == rows.dtypes


def test_append_batch_is_replay_safe(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(6).withColumn("d", F.lit(datetime(2025, 6, 1).date()))
    append_batch(frame, path, "q-0", ["d"])
    append_batch(frame, path, "q-1", ["d"])
    append_batch(frame.filter("id < 2"), path, "q-1", ["d"])
    assert read_table(spark, path, frame.schema).count() == 8
    append_batch(frame.limit(0), path, "q-2", ["d"])
    assert read_table(spark, path, frame.schema).count() == 8


def test_empty_table_reads_back_empty(spark, tmp_path):
    frame = spark.range(0).withColumn("d", F.current_date())
    write_run(frame, str(tmp_path / "e"), ["d"])
    assert read_table(spark, str(tmp_path / "e"), frame.schema).count() == 0


def test_hot_date_is_split(spark, tmp_path):
    """A date with most of the rows is written by several tasks, each sorted."""
    start = datetime(2025, 6, 1).date()
    frame = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, F.lit(start))
        .otherwise(F.lit(start + timedelta(days=1)))
        .alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        (F.col("id") % 50).alias("zone"),
    )
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        write_run(frame, str(tmp_path / "h"), ["d"], ["zone"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "h").glob("d=*")}
    assert files["d=2025-06-01"] >= 4
    assert files["d=2025-06-02"] <= files["d=2025-06-01"]
    back = spark.read.parquet(str(tmp_path / "h"))
    assert back.count() == 400_000
    ordered = back.groupBy(F.input_file_name()).agg(
        (F.array_sort(F.collect_list("zone")) == F.collect_list("zone")).alias("ok")
    )
    assert ordered.filter("NOT ok").count() == 0


def test_another_session_reads_the_published_version(spark, tmp_path):
    root = str(tmp_path)
    replace_table(spark.range(7), "t_far", root, "r1")
    write_candidate(spark.range(2), "t_far", root, "r2")  # written, not published
    fresh = spark.newSession()
    assert current_table(fresh, "t_far", root).count() == 7
    with pytest.raises(LookupError):
        current_table(fresh, "t_other", root)


def test_tables_of_two_roots_do_not_mix(spark, tmp_path):
    roots = [str(tmp_path / "a"), str(tmp_path / "b")]
    for n, root in enumerate(roots):
        replace_table(spark.range(n + 1), "t_same", root, "r1")
    assert [current_table(spark, "t_same", root).count() for root in roots] == [1, 2]


def test_old_runs_are_dropped(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        replace_table(spark.range(n), "t_old", root, f"r{n}", keep=2)
    assert sorted(p.name for p in (tmp_path / "t_old").glob("run=*")) == ["run=r2", "run=r3"]
    publish(current_table(spark, "t_old", root), "t_old", root, "r2")  # back to an older run
    assert current_table(spark, "t_old", root).count() == 2


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "stream")
    rows = spark.range(60).select("id", F.date_add(F.lit("2025-06-01").cast("date"), F.col("id").cast("int") % 3).alias("d"))
    for n in range(6):
        append_batch(rows.filter(F.col("id") % 6 == n), path, f"q-{n}", ["d"])
    assert compact(spark, str(tmp_path / "nothing"), rows.schema) is None
    new = compact(spark, path, rows.schema, ["d"])

    def ids():
        return sorted(r.id for r in read_loads(spark, path, rows.schema).collect())

    assert ids() == list(range(60))
    append_batch(rows.filter("id % 6 = 5"), path, "q-5", ["d"])  # the last batch is replayed
    assert ids() == list(range(60))
    assert drop_replaced(spark, path) == 5
    assert ids() == list(range(60))
    loads = {p.name for p in (tmp_path / "stream").glob("load_id=*")}
    assert loads == {f"load_id={new}", "load_id=q-5"}
    for folder in (tmp_path / "stream" / f"load_id={new}").glob("d=*"):
        assert len(list(folder.glob("*.parquet"))) == 1
    assert compact(spark, path, rows.schema, ["d"]) is None


def test_an_unfinished_compaction_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    append_batch(spark.range(5), path, "q-0")
    append_batch(spark.range(5), path, "compact-broken")
    assert read_loads(spark, path, spark.range(1).schema).count() == 5
