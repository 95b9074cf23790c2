"""Snapshots of live loads: no list of what was ever compacted."""

from pyspark.sql import functions as F

from tripmill.sources import loads, tables
from tripmill.sources.loads import (
    FAN,
    Merged,
    Snapshot,
    arrived_since,
    last_snapshot,
    load_names,
    make_snapshot,
    snapshot_numbers,
)
from tripmill.sources.tables import append_batch, compact, drop_replaced, read_loads, read_some_loads


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_merged_loads_grow_with_the_logarithm():
    snapshot = Snapshot()
    for n in range(5000):
        snapshot, absorbed = snapshot.with_merged(f"compact-{n}", {"q": (2 * n, 2 * n + 1)})
        assert len(snapshot.merged) <= 5 * FAN
        assert sum(last - first + 1 for m in snapshot.merged for first, last in m.covers.values()) == 2 * n + 2
        assert not [m for m in absorbed if m in snapshot.merged]
    assert snapshot.marks == {"q": 9999}


def test_the_plan_does_not_list_compacted_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    append_batch(spark.range(5), path, "compact-x")
    append_batch(spark.range(5, 7), path, "q-1-10000")
    for n in (0, 7, 9999):
        append_batch(spark.range(100, 200), path, f"q-1-{n}")  # in the merged load, not deleted yet
    append_batch(spark.range(7, 8), path, "q-2-3")
    assert make_snapshot(spark, path, Snapshot(1, (Merged("compact-x", 0, {"q-1": (0, 9999)}),), {"q-1": 9999}))
    found = read_loads(spark, path, spark.range(1).schema)
    assert sorted(r.id for r in found.collect()) == list(range(8))
    assert plan_of(found).count("q-1") == 1 and len(plan_of(found)) < 2000
    assert drop_replaced(spark, path) == 3
    assert set(load_names(spark, path)) == {"compact-x", "q-1-10000", "q-2-3"}


def test_levels_of_compaction_keep_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "FAN", 2)
    path, schema = str(tmp_path / "t"), spark.range(1).schema
    for n in range(9):
        append_batch(spark.range(n, n + 1), path, f"q-{n}")
        compact(spark, path, schema)
        assert sorted(r.id for r in read_loads(spark, path, schema).collect()) == list(range(n + 1))
    snapshot = last_snapshot(spark, path)
    assert len(snapshot.merged) == 1 and snapshot.marks == {"q": 7}
    drop_replaced(spark, path)
    assert snapshot_numbers(spark, path) == [snapshot.number]
    assert set(load_names(spark, path)) == {snapshot.merged[0].name, "q-8"}
    assert read_loads(spark, path, schema).count() == 9


def test_the_slower_of_two_compactions_leaves_nothing(spark, tmp_path, monkeypatch):
    path, schema, real = str(tmp_path / "t"), spark.range(1).schema, make_snapshot
    for n in range(4):
        append_batch(spark.range(n, n + 1), path, f"q-{n}")

    def beaten(session, place, snapshot):
        monkeypatch.setattr(tables, "make_snapshot", real)
        assert compact(session, place, schema, leave=0)
        return real(session, place, snapshot)

    monkeypatch.setattr(tables, "make_snapshot", beaten)
    assert compact(spark, path, schema) is None
    assert read_loads(spark, path, schema).count() == 4
    assert sum(n.startswith("compact-") for n in load_names(spark, path)) == 1


def test_names_that_are_no_batches_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, name in enumerate(("plain", "q-0", "q-1", "q-2", "q-x", f"q-{10**30}")):
        append_batch(spark.range(n, n + 1), path, name)
    compact(spark, path, spark.range(1).schema)
    assert sorted(r.id for r in read_loads(spark, path, spark.range(1).schema).collect()) == list(range(6))


def test_arrived_since(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.range(1).schema
    assert arrived_since(spark, path, {}) == ([], {})
    for n in range(4):
        append_batch(spark.range(n, n + 1), path, f"q-{n}")
    names, seen = arrived_since(spark, path, {"q": 1, "gone": 5})
    assert names == ["q-2", "q-3"] and seen == {"q": 3, "gone": 5}
    assert sorted(r.id for r in read_some_loads(spark, path, names, schema).collect()) == [2, 3]
    (tmp_path / "t" / "load_id=q-3" / "_SUCCESS").unlink()  # still being written
    assert arrived_since(spark, path, {"q": 1}) == (["q-2"], {"q": 2})
    new = compact(spark, path, schema)
    assert arrived_since(spark, path, {"q": 1}) == ([new], {"q": 2})
    assert arrived_since(spark, path, {"q": 2}) == ([], {"q": 2})
    assert read_some_loads(spark, path, [], schema).count() == 0
    assert read_loads(spark, path, schema).where(F.col("id") == 3).count() == 1
