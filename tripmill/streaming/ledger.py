"""Accounts of a stream from its own metrics: a row per micro-batch, and gates on the rows.

The validator counts what passes it. A listener writes these counts down when a batch
has ended, so that nobody has to read the tables again to know that every payload went
to one of them, and when the newest one was ingested. A replayed batch replaces its row. A
row that a stopped driver did not get to write shows up as a missing batch.
"""

from __future__ import annotations

import json
import threading
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tripmill.operators.validate import ROUTING_METRICS
from tripmill.session import clock, configure
from tripmill.sources.releases import names_in, write_text

LEDGER = (
    "query_id string, batch_id bigint, consumed bigint, valid bigint, rejected bigint,"
    " newest_ingestion timestamp"
)


class BatchLedger(StreamingQueryListener):
    """Writes the counts of one query's batches below ``path``, a folder per day of writing."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__()
        self.spark = spark
        self.path = path.rstrip("/")
        self._query_id: str | None = None
        self._early: list = []
        self._lock = threading.Lock()
        self._ended = threading.Event()

    def follow(self, query: StreamingQuery) -> None:
        """Take the events of this query, also those that came before its id was known."""
        with self._lock:
            self._query_id = str(query.id)
            early, self._early = self._early, []
        for progress in early:
            self._note(progress)

    def wait(self, seconds: float = 120) -> None:
        """After the query has ended: until its last row is written."""
        if not self._ended.wait(seconds):
            raise TimeoutError("the query has not ended or its events have not arrived")
        self.spark.streams.removeListener(self)

    def read(self) -> DataFrame:
        """The rows written so far."""
        configure(self.spark)
        if not names_in(self.spark, self.path):
            return self.spark.createDataFrame([], LEDGER)
        rows = self.spark.read.schema(LEDGER + ", day date").json(self.path)
        # A batch that was replayed on another day has a row on both.
        last = F.max_by(F.struct("consumed", "valid", "rejected", "newest_ingestion"), "day")
        return rows.groupBy("query_id", "batch_id").agg(last.alias("row")).select("query_id", "batch_id", "row.*")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._lock:
            if self._query_id is None:
                self._early.append(event.progress)
                return
        self._note(event.progress)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self._query_id in (None, str(event.id)):
            self._ended.set()

    def _note(self, progress) -> None:
        counts = progress.observedMetrics.get(ROUTING_METRICS)
        if str(progress.id) != self._query_id or counts is None or not progress.numInputRows:
            return
        newest = counts["newest_ingestion"]
        row = {
            "query_id": self._query_id,
            "batch_id": progress.batchId,
            **{name: counts[name] for name in ("consumed", "valid", "rejected")},
            "newest_ingestion": newest.astimezone(timezone.utc).isoformat() if newest else None,
        }
        day = datetime.now(timezone.utc).date().isoformat()
        name = f"{self._query_id}-{progress.batchId:012d}.json"
        write_text(self.spark, f"{self.path}/day={day}/{name}", json.dumps(row))


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """All batches together, in the columns of ``input_accounting``."""
    totals = ledger.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_rows") for c in ("consumed", "valid", "rejected"))
    )
    return totals.withColumn("accounted", F.col("valid_rows") + F.col("rejected_rows") == F.col("consumed_rows"))


def ledger_gates(ledger: DataFrame, as_of: datetime | None, within: timedelta) -> DataFrame:
    """Rows (gate, passed, observed): every batch balances, none is missing, something arrived lately."""
    configure(ledger.sparkSession)
    cutoff = clock(as_of) - F.make_dt_interval(secs=F.lit(within.total_seconds()))
    by_query = ledger.groupBy("query_id").agg(
        F.count_if(F.col("valid") + F.col("rejected") != F.col("consumed")).alias("off"),
        (F.max("batch_id") + 1 - F.count("*")).alias("missing"),
        F.count_if(F.col("newest_ingestion") >= cutoff).alias("fresh"),
    )
    found = by_query.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("off", "missing", "fresh")))
    gates = [("ledger_balanced", "off", F.col("off") == 0), ("ledger_complete", "missing", F.col("missing") == 0),
             ("stream_fresh", "fresh", F.col("fresh") > 0)]
    rows = [
        F.struct(F.lit(name).alias("gate"), passed.alias("passed"), F.col(column).alias("observed"))
        for name, column, passed in gates
    ]
    return found.select(F.inline(F.array(*rows)))
