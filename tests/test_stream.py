
import pytest
from conftest import AS_OF, event
from test_validate import CASES

from tripmill.operators.audit import input_accounting, recent_valid, reject_profile
from tripmill.operators.validate import ROUTING_METRICS, split_valid, validate_events
from tripmill.sources.events import file_events, text_events
from tripmill.streaming import etl
from tripmill.streaming.etl import StreamTables, stream_etl

PAYLOADS = [payload.encode() for payload, _ in CASES] + [b"\xff\xfe"]


def land(spark, path, payloads, name):
    frame = spark.createDataFrame([(p,) for p in payloads], "value binary")
    frame.repartition(3).write.parquet(f"{path}/{name}")


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


@pytest.fixture
def lake(tmp_path):
    return StreamTables(str(tmp_path / "valid"), str(tmp_path / "dead"))


def start(spark, tmp_path, lake, **options):
    source = file_events(spark, str(tmp_path / "in" / "*"), **options)
    return stream_etl(source, lake, str(tmp_path / "checkpoint"), as_of=AS_OF)


def rows(df, *drop):
    return sorted(tuple(map(str, r)) for r in df.drop(*drop).collect())


def test_stream_equals_batch_and_accounts_for_every_payload(spark, tmp_path, lake):
    land(spark, tmp_path / "in", PAYLOADS, "a")
    query = finish(start(spark, tmp_path, lake, files_per_trigger=1))
    batch = spark.createDataFrame([(p,) for p in PAYLOADS], "value binary")
    valid, rejected = split_valid(validate_events(batch, as_of=AS_OF))
    assert rows(lake.read_valid(spark)) == rows(valid)
    assert rows(lake.read_dead_letter(spark)) == rows(rejected)
    seen = [p.observedMetrics[ROUTING_METRICS] for p in query.recentProgress if p.numInputRows]
    assert sum(m.consumed for m in seen) == len(PAYLOADS)
    assert sum(m.valid for m in seen) == valid.count()
    assert sum(m.rejected for m in seen) == rejected.count()
    accounts = input_accounting(batch, lake.read_valid(spark), lake.read_dead_letter(spark)).first()
    assert accounts.accounted and accounts.consumed_rows == len(PAYLOADS)
    profile = {r.error_code: r.rejected_rows for r in reject_profile(rejected).collect()}
    assert profile["NOT_AN_OBJECT"] == 5
    assert len(recent_valid(lake.read_valid(spark), 3).collect()) == 3


def test_restart_takes_only_new_files(spark, tmp_path, lake):
    land(spark, tmp_path / "in", [event().encode()], "a")
    finish(start(spark, tmp_path, lake))
    land(spark, tmp_path / "in", [event(payment_type=2).encode(), b"[]"], "b")
    finish(start(spark, tmp_path, lake))
    assert lake.read_valid(spark).count() == 2
    assert lake.read_dead_letter(spark).count() == 1


def test_replayed_batch_replaces_its_rows(spark, tmp_path, lake):
    land(spark, tmp_path / "in", [event().encode(), event().encode(), b"x"], "a")
    finish(start(spark, tmp_path, lake))
    commits = tmp_path / "checkpoint" / "commits"
    for entry in [*commits.glob("0"), *commits.glob(".0.crc")]:
        entry.unlink()  # as if the driver died after the writes, before the commit
    finish(start(spark, tmp_path, lake))
    assert lake.read_valid(spark).count() == 2
    assert lake.read_dead_letter(spark).count() == 1


def test_new_query_does_not_overwrite_another_ones_batches(spark, tmp_path, lake):
    land(spark, tmp_path / "in", [event().encode()], "a")
    finish(start(spark, tmp_path, lake))
    source = file_events(spark, str(tmp_path / "in" / "*"))
    finish(stream_etl(source, lake, str(tmp_path / "checkpoint2"), as_of=AS_OF))
    assert lake.read_valid(spark).count() == 2


def test_text_source_and_late_events(spark, tmp_path, lake):
    """Late events are taken whenever they come; only the period bounds them."""
    early = event(pickup_datetime="2025-06-01T00:00:00Z", event_time="2025-06-01T00:00:00Z")
    for name, line in (("1", event()), ("2", early)):
        folder = tmp_path / "lines"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.txt").write_text(line + "\nnot-json\n", encoding="utf-8")
        finish(
            stream_etl(
                text_events(spark, str(folder)), lake, str(tmp_path / "c"), as_of=AS_OF
            )
        )
    assert lake.read_valid(spark).count() == 2
    assert lake.read_dead_letter(spark).count() == 2


def test_live_clock(spark, tmp_path, lake):
    land(spark, tmp_path / "in", [event().encode(), event(ingestion_time="2999-01-01T00:00:00Z")
                                  .encode()], "a")
    source = file_events(spark, str(tmp_path / "in" / "*"))
    finish(stream_etl(source, lake, str(tmp_path / "checkpoint")))
    assert lake.read_valid(spark).count() == 1
    assert lake.read_dead_letter(spark).first().error_code == "INGESTION_IN_FUTURE"


def test_only_rejects_leaves_an_empty_valid_table(spark, tmp_path, lake):
    land(spark, tmp_path / "in", [b"[]"], "a")
    finish(start(spark, tmp_path, lake))
    assert lake.read_valid(spark).count() == 0
    assert lake.read_dead_letter(spark).count() == 1


def test_running_on_with_a_trigger_interval(spark, tmp_path, lake):
    land(spark, tmp_path / "in", [event().encode()], "a")
    source = file_events(spark, str(tmp_path / "in" / "*"))
    query = stream_etl(source, lake, str(tmp_path / "checkpoint"), as_of=AS_OF,
                       trigger={"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        assert query.isActive and lake.read_valid(spark).count() == 1
        land(spark, tmp_path / "in", [event(event_id="late").encode(), b"{"], "b")
        query.processAllAvailable()
        assert lake.read_valid(spark).count() == 2 and lake.read_dead_letter(spark).count() == 1
    finally:
        query.stop()
    assert not query.isActive


def test_compaction_between_restarts(spark, tmp_path, lake):
    for n in range(5):
        land(spark, tmp_path / "in", [event(event_id=f"e{n}").encode(), b"{"], f"f{n}")
        finish(start(spark, tmp_path, lake))
    before = rows(lake.read_valid(spark)), rows(lake.read_dead_letter(spark))
    lake.compact(spark)
    assert (rows(lake.read_valid(spark)), rows(lake.read_dead_letter(spark))) == before
    land(spark, tmp_path / "in", [event(event_id="last").encode()], "f9")
    finish(start(spark, tmp_path, lake))
    assert lake.read_valid(spark).count() == 6


def test_the_cache_of_a_batch_holds_no_valid_payloads_and_no_dictionaries(spark, tmp_path, lake, monkeypatch):
    setting = "spark.sql.inMemoryColumnarStorage.compressed"
    seen = []

    def watched(rows):
        kept = rows.filter("raw_payload IS NOT NULL")
        held = (kept.filter("error_code IS NULL").count(), kept.count())
        seen.append((*held, rows.sparkSession.conf.get(setting)))
        return split_valid(rows)

    before = spark.conf.get(setting)
    monkeypatch.setattr(etl, "split_valid", watched)
    land(spark, tmp_path / "in", PAYLOADS, "a")
    finish(start(spark, tmp_path, lake))
    rejected = lake.read_dead_letter(spark)
    assert seen == [(0, rejected.count(), "false")]
    assert rejected.filter("raw_payload IS NULL").count() == 0
    assert spark.conf.get(setting) == before
