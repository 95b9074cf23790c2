"""Refreshing by change sets equals the full rebuild and writes only the dates that change."""

import random

import pytest
from conftest import event
from test_pipeline import CFG, batch, stream

from tripmill.contract import TRIP_SCHEMA, VALID_SCHEMA
from tripmill.operators.conform import conform_stream
from tripmill.operators.dedup import dedup_latest
from tripmill.operators.quality import GateFailure
from tripmill.plans import changes
from tripmill.plans.batch import run_batch
from tripmill.plans.changes import apply_changes, change_set, refresh
from tripmill.sources.loads import drop_replaced
from tripmill.sources.releases import ReleaseConflict, Run, last_release, make_release
from tripmill.sources.tables import append_batch, compact, read_loads, released_tables

TABLES = ("int_trips", "mart_daily", "mart_monthly", "trip_sums")


def on(day, **changes):
    return event(
        pickup_datetime=f"{day}T08:00:00Z", event_time=f"{day}T08:00:00Z", dropoff_datetime=f"{day}T08:30:00Z",
        **changes,
    )


def land(spark, path, number, *payloads):
    append_batch(stream(spark, *payloads), path, f"q-{number}", ["pickup_date"])


def content(spark, root):
    tables = released_tables(spark, root)
    return {name: sorted(map(str, tables[name].collect())) for name in TABLES}


def rebuilt(spark, tmp_path, path, name):
    root = str(tmp_path / name)
    run_batch(spark, batch(spark), path, root, "full", CFG)
    return content(spark, root)


FIRST = [on("2025-06-02", event_id="a"), on("2025-06-03", event_id="b"), on("2025-07-04", event_id="c")]


@pytest.fixture
def lake(spark, tmp_path):
    path, root = str(tmp_path / "valid"), str(tmp_path / "root")
    land(spark, path, 0, *FIRST)
    run_batch(spark, batch(spark), path, root, "r0", CFG)
    return path, root


def test_late_events_rewrite_their_dates_only(spark, tmp_path, lake):
    path, root = lake
    land(spark, path, 1, on("2025-06-03", event_id="d"), on("2025-06-20", event_id="e"))
    done = refresh(spark, path, root, "r1", CFG)
    assert done.dates == ("pickup_date=2025-06-03", "pickup_date=2025-06-20")
    folders = {p.name for p in (tmp_path / "root" / "int_trips" / "run=r1").glob("pickup_date=*")}
    assert folders == set(done.dates)
    assert done.release.seen == {"q": 1} and all(g.passed for g in done.gates)
    assert done.release.tables["int_trips"].parts["pickup_date=2025-06-02"] == "r0"
    assert done.release.tables["stg_batch"].run_id == "r0"
    assert content(spark, root) == rebuilt(spark, tmp_path, path, "again")
    assert refresh(spark, path, root, "r2", CFG).release == done.release  # nothing new


def test_redelivered_trips_move_and_equal_ones_change_nothing(spark, tmp_path, lake):
    path, root = lake
    land(spark, path, 1, *FIRST)
    same = refresh(spark, path, root, "r1", CFG)
    assert same.dates == () and same.release.seen == {"q": 1}
    moved = on("2025-06-05", event_id="a", ingestion_time="2025-08-22T00:00:00Z")
    older = on("2025-07-04", event_id="c", ingestion_time="2025-08-01T00:00:00Z")
    land(spark, path, 2, moved, older, moved)
    done = refresh(spark, path, root, "r2", CFG)
    assert done.dates == ("pickup_date=2025-06-02", "pickup_date=2025-06-05")
    assert "pickup_date=2025-06-02" not in done.release.tables["int_trips"].parts  # no trip is left there
    assert content(spark, root) == rebuilt(spark, tmp_path, path, "again")


def test_loads_that_were_compacted_meanwhile(spark, tmp_path, lake):
    path, root = lake
    for n in range(1, 5):
        land(spark, path, n, on(f"2025-06-1{n}", event_id=f"n{n}"))
    refresh(spark, path, root, "r1", CFG)
    land(spark, path, 5, on("2025-06-21", event_id="n5"))
    land(spark, path, 6, on("2025-06-22", event_id="n6"))
    compact(spark, path, VALID_SCHEMA, ["pickup_date"])
    drop_replaced(spark, path)
    done = refresh(spark, path, root, "r2", CFG)
    assert done.dates == ("pickup_date=2025-06-21", "pickup_date=2025-06-22")
    assert content(spark, root) == rebuilt(spark, tmp_path, path, "again")


def test_old_folders_go_and_carried_ones_stay(spark, tmp_path, lake):
    path, root = lake
    for n in range(1, 4):
        land(spark, path, n, on("2025-06-03", event_id=f"n{n}"))
        refresh(spark, path, root, f"r{n}", CFG, keep=1)
    parts = {str(p.relative_to(tmp_path / "root" / "int_trips")) for p in (tmp_path / "root" / "int_trips").glob("*/*=*")}
    assert parts == {f"run={r}/{d}" for d, r in last_release(spark, root).tables["int_trips"].parts.items()}
    assert "run=r3/pickup_date=2025-06-03" in parts and "run=r0/pickup_date=2025-06-02" in parts
    assert content(spark, root) == rebuilt(spark, tmp_path, path, "again")


def test_a_release_in_between_is_not_overwritten(spark, lake, monkeypatch):
    path, root = lake
    land(spark, path, 1, on("2025-06-03", event_id="d"))
    real = changes.content_sums

    def slow(trips):
        make_release(spark, root, {"other": Run("x", "{}")})
        return real(trips)

    monkeypatch.setattr(changes, "content_sums", slow)
    with pytest.raises(ReleaseConflict):
        refresh(spark, path, root, "r1", CFG)
    monkeypatch.undo()
    assert last_release(spark, root).tables["int_trips"].run_id == "r0"


def test_a_failed_gate_releases_nothing(spark, lake, monkeypatch):
    path, root = lake
    land(spark, path, 1, on("2025-06-03", event_id="d"))
    monkeypatch.setattr(changes, "apply_changes", lambda trips, delta: trips.unionByName(trips))
    with pytest.raises(GateFailure):
        refresh(spark, path, root, "r1", CFG)
    assert last_release(spark, root).seen == {"q": 0}


def test_refresh_needs_a_release(spark, tmp_path):
    with pytest.raises(LookupError):
        refresh(spark, str(tmp_path / "valid"), str(tmp_path / "root"), "r", CFG)


@pytest.mark.parametrize("limit", [changes.BROADCAST_BYTES, 0])
def test_change_sets_equal_the_latest_of_both(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(changes, "BROADCAST_BYTES", limit)
    draw = random.Random(5)

    def some(n):
        found = [
            on(f"2025-06-0{draw.randint(1, 4)}", event_id=f"t{draw.randint(0, 25)}", tip_amount=draw.randint(0, 2),
               ingestion_time=f"2025-08-0{draw.randint(1, 3)}T00:00:00Z")
            for _ in range(n)
        ]
        return conform_stream(stream(spark, *found), CFG).select(*TRIP_SCHEMA.names)

    first, second = some(40), some(40)
    trips = dedup_latest(first, ["trip_id"], ["ingestion_time"])
    delta = change_set(trips, second)
    want = dedup_latest(first.unionByName(second), ["trip_id"], ["ingestion_time"])
    assert sorted(map(str, apply_changes(trips, delta).collect())) == sorted(map(str, want.collect()))
    kinds = {r.change for r in delta.select("change").distinct().collect()}
    assert kinds == {"add", "remove"}
    assert read_loads(spark, str(tmp_path / "none"), VALID_SCHEMA).count() == 0
