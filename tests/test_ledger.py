"""The stream's ledger: a row per batch, replays, gates."""

from datetime import datetime, timedelta, timezone

from conftest import AS_OF, event
from test_stream import PAYLOADS, land

from tripmill.operators.audit import input_accounting
from tripmill.sources.events import file_events
from tripmill.sources.releases import write_text
from tripmill.streaming.etl import StreamTables, stream_etl
from tripmill.streaming.ledger import LEDGER, BatchLedger, ledger_gates, ledger_totals


def run(spark, tmp_path):
    lake = StreamTables(str(tmp_path / "valid"), str(tmp_path / "dead"))
    ledger = BatchLedger(spark, str(tmp_path / "ledger"))
    source = file_events(spark, str(tmp_path / "in" / "*"), files_per_trigger=1)
    query = stream_etl(source, lake, str(tmp_path / "checkpoint"), as_of=AS_OF, ledger=ledger)
    query.awaitTermination()
    ledger.wait()
    return lake, ledger


def test_ledger_equals_the_tables(spark, tmp_path):
    land(spark, tmp_path / "in", PAYLOADS, "a")
    _, ledger = run(spark, tmp_path)
    first = ledger.read().count()
    assert first >= 2
    land(spark, tmp_path / "in", [event().encode(), b"[]"], "b")
    lake, ledger = run(spark, tmp_path)  # goes on from the checkpoint
    rows = ledger.read()
    assert rows.count() > first and rows.select("query_id").distinct().count() == 1
    landed = spark.read.parquet(*(str(tmp_path / "in" / n) for n in "ab"))
    told = input_accounting(landed, lake.read_valid(spark), lake.read_dead_letter(spark)).first()
    assert ledger_totals(rows).first() == told and told.accounted
    newest = lake.read_valid(spark).agg({"ingestion_time": "max"}).first()[0]
    assert rows.agg({"newest_ingestion": "max"}).first()[0] == newest
    gates = {r.gate: r.passed for r in ledger_gates(rows, AS_OF, timedelta(days=30)).collect()}
    assert gates == {"ledger_balanced": True, "ledger_complete": True, "stream_fresh": True}


def test_gates_see_what_is_wrong(spark):
    when = datetime(2025, 8, 1, tzinfo=timezone.utc)
    rows = [("q", 0, 5, 3, 2, when), ("q", 2, 5, 3, 1, None), ("p", 0, 1, 1, 0, when)]
    gates = ledger_gates(spark.createDataFrame(rows, LEDGER), AS_OF, timedelta(days=7))
    assert [tuple(r) for r in gates.collect()] == [
        ("ledger_balanced", False, 1), ("ledger_complete", False, 1), ("stream_fresh", False, 0),
    ]
    none = ledger_gates(spark.createDataFrame([], LEDGER), AS_OF, timedelta(days=7))
    assert [r.passed for r in none.collect()] == [True, True, False]


def test_a_replayed_batch_counts_once(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path))
    assert ledger.read().count() == 0
    row = '{"query_id": "q", "batch_id": 0, "consumed": %d, "valid": %d, "rejected": 0}'
    write_text(spark, f"{tmp_path}/day=2025-01-01/q-000000000000.json", row % (3, 3))
    write_text(spark, f"{tmp_path}/day=2025-01-02/q-000000000000.json", row % (4, 4))
    assert [tuple(r) for r in ledger_totals(ledger.read()).collect()] == [(4, 4, 0, True)]
