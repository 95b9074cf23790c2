"""

The queries run the library on trip-shaped inputs that ``tripmill.adapters``
derives from the driver's tables. The oracle of an event query never parses
JSON: it works out the expected code of each payload from the planted defect.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from datetime import timedelta
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracles import ORACLES  # noqa: E402
from tripmill.adapters import (  # noqa: E402
    CONFIG,
    batch_trips,
    raw_events,
    stream_trips,
    validated_events,
)
from tripmill.contract import BATCH_SCHEMA, EVENT_SCHEMA  # noqa: E402
from tripmill.functions.text import fingerprint  # noqa: E402
from tripmill.operators import audit, quality  # noqa: E402
from tripmill.operators.conform import (  # noqa: E402
    FINGERPRINT_COLUMNS,
    apply_rules,
    batch_amounts,
    batch_period,
    batch_rules,
    batch_time_order,
    batch_zones,
    conform_batch,
    conform_stream,
)
from tripmill.operators.dedup import rank_latest_spread  # noqa: E402
from tripmill.operators.validate import rejected_events, valid_events  # noqa: E402
from tripmill.plans.batch import replace_staging, run_batch  # noqa: E402
from tripmill.plans.changes import refresh  # noqa: E402
from tripmill.plans.intermediate import INT_CLUSTER, build_intermediate, unify  # noqa: E402
from tripmill.plans.marts import daily_mart, monthly_mart  # noqa: E402
from tripmill.plans.reports import batch_monthly_report, batch_vs_stream_report  # noqa: E402
from tripmill.session import configure, shared_dir, workers  # noqa: E402
from tripmill.sources.events import encode_events, file_events  # noqa: E402
from tripmill.sources.releases import last_release  # noqa: E402
from tripmill.sources.tables import load_trips, released_tables, write_candidate  # noqa: E402
from tripmill.streaming.etl import StreamTables, stream_etl  # noqa: E402
from tripmill.streaming.ledger import BatchLedger, ledger_gates, ledger_totals  # noqa: E402

#: Micro-batches that a stream takes for each part of its landed files, where a query stops and restarts it.
BATCHES = 3

TABLES = (
    "benchmark",
    "conversations",
    "customer",
    "documents",
    "embeddings",
    "events",
    "labels",
    "lineitem",
    "nation",
    "orders",
    "pages",
    "part",
    "region",
    "supplier",
)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_intermediate(batch_trips(spark, sf_dir), stream_trips(spark, sf_dir), CONFIG)


def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load monthly files of differing types, replace the staging table, read it back."""
    root = shared_dir(spark, "staging")
    months = batch_trips(spark, sf_dir)
    even = F.col("DOLocationID") % 2 == 0
    months.filter(even).write.parquet(f"{root}/months/a")
    others = months.filter(even.isNull() | ~even)
    others.withColumn("payment_type", F.col("payment_type").cast("bigint")).write.parquet(
        f"{root}/months/b"
    )
    loaded = load_trips(spark, [f"{root}/months"])
    return replace_staging(loaded, root, "run").select(*BATCH_SCHEMA.names)


def batch_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many staging rows each rule group keeps, and how many all of them keep."""
    groups = {
        "period": batch_period(CONFIG),
        "time_order": batch_time_order(),
        "zones": batch_zones(CONFIG.event),
        "amounts": batch_amounts(),
        "all_rules": batch_rules(CONFIG),
    }
    kept = [
        F.count_if(reduce(lambda a, b: a & b, rules)).alias(name) for name, rules in groups.items()
    ]
    return batch_trips(spark, sf_dir).agg(F.count("*").alias("staged"), *kept)


def batch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(batch_trips(spark, sf_dir), batch_rules(CONFIG))


def trip_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = batch_trips(spark, sf_dir)
    return staged.select(fingerprint(FINGERPRINT_COLUMNS).alias("trip_id"), *FINGERPRINT_COLUMNS)


def trip_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    unified = unify(batch_trips(spark, sf_dir), stream_trips(spark, sf_dir), CONFIG)
    ranked = rank_latest_spread(unified, ["trip_id"], ["ingestion_time"])
    return ranked.select("trip_id", "ingestion_time", "tip_amount", "row_number")


def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("error_code")
    counted = validated_events(spark, sf_dir).agg(
        F.count("*").alias("consumed_rows"),
        F.count_if(code.isNull()).alias("valid_rows"),
        F.count_if(code.isNotNull()).alias("rejected_rows"),
    )
    total = F.col("valid_rows") + F.col("rejected_rows")
    return counted.withColumn("accounted", total == F.col("consumed_rows"))


def contract_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reject_profile(rejected_events(validated_events(spark, sf_dir, strict=True)))


def gates_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_gates(batch_trips(spark, sf_dir), quality.STAGING_GATES)


def gates_intermediate(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written first, as in a run: the payloads of two plans would be parsed and checked twice.
    events = write_candidate(stream_trips(spark, sf_dir), "stg_stream", shared_dir(spark, "tables"), "run")
    built = build_intermediate(batch_trips(spark, sf_dir), events, CONFIG)
    return (
        quality.schema_gate(built)
        .unionByName(quality.run_gates(built, quality.intermediate_gates(CONFIG.event)))
        .unionByName(quality.run_gates(events, [quality.stream_present(CONFIG)]))
    )


def gates_raw_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same gates before deduplication, where the unique-key gate must fail."""
    unified = unify(batch_trips(spark, sf_dir), stream_trips(spark, sf_dir), CONFIG)
    return quality.run_gates(unified, quality.intermediate_gates(CONFIG.event))


def written_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The trips and the daily mart, written one after the other as a batch run does."""
    root = shared_dir(spark, "tables")
    built = write_candidate(trips(spark, sf_dir), "int_trips", root, "run")
    return built, write_candidate(daily_mart(built), "mart_daily", root, "run")


def gates_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    built, daily = written_tables(spark, sf_dir)
    reconciled = quality.reconciliation_gate(audit.reconcile(built, daily, how="full"))
    return quality.run_gates(daily, quality.MART_GATES).unionByName(reconciled)


def gate_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_trips(spark, sf_dir)
    return quality.freshness_gate(events, CONFIG.as_of, timedelta(days=40))


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.reconcile(*written_tables(spark, sf_dir))


def content_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    built, daily = written_tables(spark, sf_dir)
    return audit.reconcile_content(audit.content_sums(built), built, daily).drop("same_trips", "same_mart")


def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of some zones and one payment type, from a table whose files are ordered for such filters."""
    root = shared_dir(spark, "clustered")
    built = trips(spark, sf_dir)
    written = write_candidate(built, "int_trips", root, "run", cluster_by=INT_CLUSTER)
    return written.where("payment_type = 2 AND pickup_location_id BETWEEN 100 AND 120")


def publish_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stream_trips(spark, sf_dir).select(*EVENT_SCHEMA.names)
    text = F.decode(F.col("value"), "UTF-8").alias("payload")
    source = F.decode(F.col("headers")[1]["value"], "UTF-8").alias("source_header")
    return encode_events(events).select("key", text, source)


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the inventory that the tables' content determines."""
    configure(spark)
    inventory = audit.table_inventory(spark, {t: f"{sf_dir}/{t}.parquet" for t in TABLES})
    return inventory.select("table_id", "row_count")


def run_stream(spark: SparkSession, sf_dir: str) -> tuple[str, StreamTables]:
    """Land the payloads as files and work them off as a stream, some files at a time."""
    root = shared_dir(spark, "stream")
    raw_events(spark, sf_dir).write.parquet(f"{root}/landing")
    tables = StreamTables(f"{root}/valid", f"{root}/dead_letter")
    source = file_events(spark, f"{root}/landing", files_per_trigger=64)
    query = stream_etl(source, tables, f"{root}/checkpoint", CONFIG.event, CONFIG.as_of)
    query.awaitTermination()
    return f"{root}/landing", tables


def stream_etl_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = run_stream(spark, sf_dir)
    return tables.read_valid(spark)


def land_late(spark: SparkSession, sf_dir: str, root: str) -> Iterator[int]:
    """Land the payloads as files in two parts, the late events second; how many files a part has.

    Payloads are built once, for both parts. Files grow in number with the cores that read them.
    """
    payloads = raw_events(spark, sf_dir).select("value", (F.crc32("value") % 3 == 0).alias("late"))
    payloads.write.partitionBy("late").parquet(f"{root}/payloads")
    written = spark.read.schema("value binary, late boolean").parquet(f"{root}/payloads")
    files = BATCHES * workers(spark)
    for part, late in (("1", False), ("2", True)):
        chosen = written.filter(F.col("late") == late).select("value").repartition(files)
        chosen.write.parquet(f"{root}/landing/{part}")
        yield files


def stream_etl_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream stops, late events arrive, it goes on from its checkpoint, and is compacted."""
    root = shared_dir(spark, "stream")
    tables = StreamTables(f"{root}/valid", f"{root}/dead_letter")
    for files in land_late(spark, sf_dir, root):
        source = file_events(spark, f"{root}/landing/*", files_per_trigger=files // BATCHES)
        stream_etl(source, tables, f"{root}/checkpoint", CONFIG.event, CONFIG.as_of).awaitTermination()
    tables.compact(spark)
    return tables.read_valid(spark)


def stream_etl_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = run_stream(spark, sf_dir)
    return audit.reject_profile(tables.read_dead_letter(spark))


def stream_etl_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, tables = run_stream(spark, sf_dir)
    return audit.input_accounting(
        spark.read.parquet(landing), tables.read_valid(spark), tables.read_dead_letter(spark)
    )


def ledger_of_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of a stream that stops and goes on with late events from its checkpoint."""
    root = shared_dir(spark, "stream")
    tables = StreamTables(f"{root}/valid", f"{root}/dead_letter")
    for files in land_late(spark, sf_dir, root):
        source = file_events(spark, f"{root}/landing/*", files_per_trigger=files // BATCHES)
        ledger = BatchLedger(spark, f"{root}/ledger")
        query = stream_etl(
            source, tables, f"{root}/checkpoint", CONFIG.event, CONFIG.as_of, ledger=ledger
        )
        query.awaitTermination()
        ledger.wait()
    return ledger.read()


def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream's own metrics say went in and out, without reading its tables."""
    return ledger_totals(ledger_of_stream(spark, sf_dir))


def gates_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    gates = ledger_gates(ledger_of_stream(spark, sf_dir), CONFIG.as_of, timedelta(days=40))
    return gates.select("gate", "passed")


def pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream run, then batch run with all gates; rows of every table written."""
    _, stream = run_stream(spark, sf_dir)
    root = shared_dir(spark, "warehouse")
    built = run_batch(
        spark, batch_trips(spark, sf_dir), stream.read_valid(spark), root, "run", CONFIG
    )
    written = {
        "stg_batch": built.staging,
        "stg_stream": stream.read_valid(spark),
        "int_trips": built.trips,
        "mart_daily": built.daily,
        "mart_monthly": built.monthly,
    }
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_id"), "row_count")
        for name, df in written.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison report read from the daily mart a batch run wrote."""
    built = run_batch(
        spark,
        batch_trips(spark, sf_dir),
        stream_trips(spark, sf_dir),
        shared_dir(spark, "warehouse"),
        "run",
        CONFIG,
    )
    return batch_vs_stream_report(built.daily)


def release_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all tables of the last release: a later run that fails a gate leaves it as it is."""
    root = shared_dir(spark, "warehouse")
    batch, events = batch_trips(spark, sf_dir), stream_trips(spark, sf_dir)
    run_batch(spark, batch, events, root, "good", CONFIG)
    try:
        run_batch(spark, batch, events.limit(0), root, "bad", CONFIG)
    except quality.GateFailure:
        pass
    release = last_release(spark, root)
    counted = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(release.number).cast("bigint").alias("release"), F.lit(name).alias("table_id"), "row_count"
        )
        for name, df in released_tables(spark, root, release).items()
    ]
    return reduce(DataFrame.unionByName, counted)


def refreshed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The released tables after a full run on part of the stream and a refresh with the late events."""
    root = shared_dir(spark, "refresh")
    tables = StreamTables(f"{root}/valid", f"{root}/dead_letter")
    for part, files in enumerate(land_late(spark, sf_dir, root)):
        source = file_events(spark, f"{root}/landing/*", files_per_trigger=max(64, files))
        stream_etl(source, tables, f"{root}/checkpoint", CONFIG.event, CONFIG.as_of).awaitTermination()
        if part:
            refresh(spark, tables.valid, f"{root}/warehouse", "second", CONFIG)
        else:
            run_batch(spark, batch_trips(spark, sf_dir), tables.valid, f"{root}/warehouse", "first", CONFIG)
    return released_tables(spark, f"{root}/warehouse")


def refresh_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refreshed(spark, sf_dir)["int_trips"]


def refresh_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both marts after the refresh, as one list of groups."""
    found = refreshed(spark, sf_dir)
    shared = ["source_type", "trip_count", "total_revenue", "average_total_amount", "average_trip_distance"]
    daily = found["mart_daily"].select(F.lit("daily").alias("mart"), F.col("pickup_date").alias("first_day"), *shared)
    monthly = found["mart_monthly"]
    monthly = monthly.select(F.lit("monthly").alias("mart"), F.col("pickup_month").alias("first_day"), *shared)
    return daily.unionByName(monthly)


def corpus_queries() -> tuple[dict, dict]:
    """Queries and oracles of the llm subpackage and its pipeline, if they can be imported."""
    try:
        from tripmill.llm import oracle_sql as corpus_sql
        from tripmill.llm import queries as corpus
    except ImportError:
        return {}, {}
    found, oracles = dict(corpus.QUERIES), dict(corpus_sql.ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        return found, oracles
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, oracles


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the daily mart of unified, deduplicated trips."""
    return daily_mart(trips(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def on(source: Callable, operator: Callable) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: operator(source(spark, sf_dir))

    return {
        "staging_load": staging_load,
        "batch_rule_counts": batch_rule_counts,
        "batch_filter": batch_filter,
        "trip_fingerprint": trip_fingerprint,
        "batch_conform": on(batch_trips, lambda df: conform_batch(df, CONFIG)),
        "stream_conform": on(stream_trips, lambda df: conform_stream(df, CONFIG)),
        "valid_enriched": on(validated_events, valid_events),
        "dead_letter": on(validated_events, rejected_events),
        "reject_profile": on(
            validated_events, lambda df: audit.reject_profile(rejected_events(df))
        ),
        "route_counts": route_counts,
        "contract_strict": contract_strict,
        "unified": lambda spark, sf_dir: unify(
            batch_trips(spark, sf_dir), stream_trips(spark, sf_dir), CONFIG
        ),
        "trip_ranking": trip_ranking,
        "int_trips": trips,
        "mart_daily": on(trips, daily_mart),
        "mart_monthly": on(trips, monthly_mart),
        "report_batch_monthly": on(trips, lambda df: batch_monthly_report(monthly_mart(df))),
        "report_batch_vs_stream": on(trips, lambda df: batch_vs_stream_report(daily_mart(df))),
        "gates_staging": gates_staging,
        "gates_intermediate": gates_intermediate,
        "gates_raw_unified": gates_raw_unified,
        "gates_mart": gates_mart,
        "gate_freshness": gate_freshness,
        "reconciliation": reconciliation,
        "content_reconciliation": content_reconciliation,
        "clustered_lookup": clustered_lookup,
        "coverage": on(trips, audit.coverage),
        "lineage_counts": on(trips, audit.lineage_counts),
        "duplicate_rows": on(trips, audit.duplicate_rows),
        "invalid_rows": on(trips, audit.invalid_rows),
        "recent_valid": on(stream_trips, audit.recent_valid),
        "publish_payload": publish_payload,
        "table_row_counts": table_row_counts,
        "stream_etl_valid": stream_etl_valid,
        "stream_etl_restart": stream_etl_restart,
        "stream_etl_rejects": stream_etl_rejects,
        "stream_etl_accounting": stream_etl_accounting,
        "stream_ledger": stream_ledger,
        "gates_ledger": gates_ledger,
        "pipeline_tables": pipeline_tables,
        "pipeline_report": pipeline_report,
        "release_tables": release_tables,
        "refresh_trips": refresh_trips,
        "refresh_marts": refresh_marts,
        **corpus_queries()[0],
    }


def oracle_sql() -> dict[str, str]:
    return ORACLES | corpus_queries()[1]
