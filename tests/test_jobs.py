import pytest
from conftest import event
from test_pipeline import batch as batch_frame

from tripmill.jobs import batch, stream
from tripmill.streaming.etl import StreamTables


def test_stream_then_batch(spark, tmp_path, capsys):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.txt").write_text(event() + "\n[]\n", encoding="utf-8")
    tables = ["--valid", str(tmp_path / "valid"), "--dead-letter", str(tmp_path / "dead")]
    stream.main(["--lines", str(landing), *tables, "--checkpoint", str(tmp_path / "c")], spark)
    batch_frame(spark).write.parquet(str(tmp_path / "month"))
    built = batch.main(
        [str(tmp_path / "month"), "--stream", str(tmp_path / "valid"), "--root",
         str(tmp_path / "out")],
        spark,
    )
    assert built.trips.count() == 4
    assert "gate mart_reconciles: passed" in capsys.readouterr().out


def test_topic_needs_servers():
    with pytest.raises(SystemExit):
        stream.arguments(["--topic", "t", "--valid", "v", "--dead-letter", "d",
                          "--checkpoint", "c"])


def test_another_month(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    late = {n: "2025-09-15T08:30:00Z" for n in ("event_time", "pickup_datetime", "ingestion_time")}
    text = event(**late, dropoff_datetime="2025-09-15T08:47:30Z")
    (landing / "1.txt").write_text(text + "\n" + event() + "\n", encoding="utf-8")
    tables = ["--valid", str(tmp_path / "valid"), "--dead-letter", str(tmp_path / "dead")]
    period = ["--event-start", "2025-09-01", "--event-end", "2025-10-01"]
    stream.main(["--lines", str(landing), *tables, "--checkpoint", str(tmp_path / "c"), *period], spark)
    written = StreamTables(str(tmp_path / "valid"), str(tmp_path / "dead"))
    assert [str(r.pickup_date) for r in written.read_valid(spark).collect()] == ["2025-09-15"]
    assert [r.error_code for r in written.read_dead_letter(spark).collect()] == ["OUTSIDE_EVENT_PERIOD"]
