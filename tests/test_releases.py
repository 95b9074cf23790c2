"""One release for all tables: ordered, whole, and nobody's candidate is deleted."""

from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

import pytest
from conftest import event
from test_pipeline import CFG, batch, stream

from tripmill.operators.quality import GateFailure
from tripmill.plans import batch as plan
from tripmill.plans.batch import run_batch
from tripmill.sources import releases
from tripmill.sources.releases import Run, last_release, make_release, read_release, release_numbers
from tripmill.sources.tables import (
    current_table,
    publish,
    publish_together,
    released_tables,
    replace_table,
    run_path,
    write_candidate,
)


def runs_of(release):
    return {name: run.run_id for name, run in release.tables.items()}


def test_a_release_is_made_once(spark, tmp_path):
    path = str(tmp_path / "releases" / "000000000001")
    assert releases.create_if_absent(spark, path, "one")
    assert not releases.create_if_absent(spark, path, "two")
    assert releases.read_text(spark, path) == "one"
    assert [n for n in releases.names_in(spark, str(tmp_path / "releases")) if n.startswith(".new")] == []


def test_concurrent_releases_are_ordered_and_none_is_lost(spark, tmp_path):
    root = str(tmp_path)

    def make(n):
        return make_release(spark, root, {"trips": Run(f"r{n}", "{}"), "mart": Run(f"r{n}", "{}"), f"own{n}": Run(f"r{n}", "")})

    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(make, range(18)))
    assert sorted(r.number for r in made) == release_numbers(spark, root) == list(range(1, 19))
    for one in made:
        stored = read_release(spark, root, one.number)
        assert stored == one and stored.tables["trips"] == stored.tables["mart"]
    assert {f"own{n}" for n in range(18)} <= set(last_release(spark, root).tables)


def test_a_race_for_a_number_is_tried_again(spark, tmp_path, monkeypatch):
    root, real, lost = str(tmp_path), releases.create_if_absent, []

    def beaten(session, path, text):
        if not lost:
            lost.append(path)
            real(session, path, '{"tables": {"other": {"run_id": "b", "columns": ""}}}')
        return real(session, path, text)

    monkeypatch.setattr(releases, "create_if_absent", beaten)
    assert runs_of(make_release(spark, root, {"mine": Run("a", "")})) == {"other": "b", "mine": "a"}
    assert release_numbers(spark, root) == [1, 2]
    monkeypatch.setattr(releases, "create_if_absent", lambda *a: False)
    with pytest.raises(releases.ReleaseConflict):
        make_release(spark, root, {})


def test_candidates_of_other_runs_stay(spark, tmp_path):
    root = str(tmp_path)
    replace_table(spark.range(1), "t", root, "old")
    write_candidate(spark.range(5), "t", root, "other")  # another job's, not published yet
    mine = write_candidate(spark.range(3), "t", root, "mine")
    publish(mine, "t", root, "mine", keep=1)
    assert sorted(p.name for p in (tmp_path / "t").glob("run=*")) == ["run=mine", "run=other"]
    publish(spark.read.parquet(run_path(root, "t", "other")), "t", root, "other", keep=1)
    assert current_table(spark, "t", root).count() == 5


def test_abandoned_candidates_go_by_the_age_of_their_lease(spark, tmp_path):
    root = str(tmp_path)
    replace_table(spark.range(1), "t", root, "good")
    write_candidate(spark.range(2), "t", root, "left")
    spark.range(1).write.parquet(run_path(root, "t", "unknown"))
    assert releases.drop_abandoned(spark, root, timedelta(hours=1)) == []
    assert releases.drop_abandoned(spark, root, timedelta(0)) == ["t/run=left"]
    assert sorted(p.name for p in (tmp_path / "t").glob("run=*")) == ["run=good", "run=unknown"]
    assert current_table(spark, "t", root).count() == 1


def test_a_run_is_released_as_a_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert released_tables(spark, root) == {}
    run_batch(spark, batch(spark), stream(spark, event()), root, "r1", CFG)
    before = {name: df.count() for name, df in released_tables(spark, root).items()}
    assert before["stg_batch"] == 5 and before["int_trips"] == 4
    # The run writes staging and trips, then its marts fail: no reader sees any of it.
    monkeypatch.setattr(plan, "daily_mart", lambda trips: plan.monthly_mart(trips).limit(0))
    with pytest.raises(Exception):
        run_batch(spark, batch(spark).limit(3), stream(spark, event()), root, "r2", CFG)
    monkeypatch.undo()
    assert (tmp_path / "int_trips" / "run=r2").exists()
    assert {name: df.count() for name, df in released_tables(spark, root).items()} == before
    with pytest.raises(GateFailure):
        run_batch(spark, batch(spark).limit(3), stream(spark, "[]"), root, "r3", CFG)
    run_batch(spark, batch(spark).limit(3), stream(spark, event()), root, "r4", CFG, keep=1)
    assert set(runs_of(last_release(spark, root)).values()) == {"r4"}
    assert not (tmp_path / "mart_daily" / "run=r1").exists() and (tmp_path / "int_trips" / "run=r2").exists()


def test_two_runs_at_once_end_in_two_whole_releases(spark, tmp_path):
    root = str(tmp_path)
    events = stream(spark, event())

    def run(run_id):
        return run_batch(spark, batch(spark), events, root, run_id, CFG)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(run, ["a", "b"]))
    assert release_numbers(spark, root) == [1, 2]
    named = [set(runs_of(read_release(spark, root, n)).values()) for n in (1, 2)]
    assert sorted(map(sorted, named)) == [["a"], ["b"]]


def test_tables_not_named_stay_as_they_were(spark, tmp_path):
    root = str(tmp_path)
    one, two = spark.range(1), spark.range(2)
    for name, df in (("x", one), ("y", two)):
        write_candidate(df, name, root, "r1")
    publish_together({"x": one, "y": two}, root, "r1")
    replace_table(spark.range(7), "x", root, "r2")
    assert {n: df.count() for n, df in released_tables(spark, root).items()} == {"x": 7, "y": 2}
    first = read_release(spark, root, 1)
    assert {n: df.count() for n, df in released_tables(spark, root, first).items()} == {"x": 1, "y": 2}
