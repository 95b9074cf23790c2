"""Trip analytics on Spark: validated events, unified trips, gates, marts and reports."""

from tripmill.contract import EventSpec, PipelineConfig
from tripmill.functions.text import fingerprint
from tripmill.operators.audit import (
    coverage,
    duplicate_rows,
    input_accounting,
    invalid_rows,
    lineage_counts,
    recent_valid,
    reconcile,
    reject_profile,
    table_inventory,
)
from tripmill.operators.conform import apply_rules, conform, conform_batch, conform_stream
from tripmill.operators.dedup import dedup_latest, rank_latest, rank_latest_spread
from tripmill.operators.quality import Gate, GateFailure, require, run_gates, schema_gate
from tripmill.operators.validate import enrich, split_valid, validate_events
from tripmill.plans.batch import run_batch
from tripmill.plans.changes import apply_changes, change_set, refresh
from tripmill.plans.intermediate import build_intermediate, unify
from tripmill.plans.marts import daily_mart, monthly_mart
from tripmill.plans.reports import batch_monthly_report, batch_vs_stream_report
from tripmill.session import configure
from tripmill.sources.events import encode_events, file_events, kafka_events, text_events
from tripmill.sources.releases import drop_abandoned, last_release
from tripmill.sources.tables import (
    append_batch,
    compact,
    current_table,
    drop_replaced,
    load_trips,
    read_loads,
    read_table,
    released_tables,
    replace_table,
)
from tripmill.streaming.etl import StreamTables, stream_etl
from tripmill.streaming.ledger import BatchLedger, ledger_gates, ledger_totals

__all__ = [name for name in dir() if not name.startswith("_")]
