"""Time the headline operators; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Inputs are derived from the driver's tables and written once,
outside the clock. Each operator runs once to warm up and then BENCH_RUNS times;
the median counts. Results go to a sink that evaluates every row and column.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.adapters import CONFIG, batch_trips, raw_events, stream_trips
from tripmill.contract import EVENT_SCHEMA
from tripmill.operators import audit, quality
from tripmill.operators.conform import apply_rules, batch_rules, conform_batch
from tripmill.operators.validate import rejected_events, valid_events, validate_events
from tripmill.plans.intermediate import build_intermediate
from tripmill.plans.marts import daily_mart, monthly_mart
from tripmill.plans.reports import batch_monthly_report, batch_vs_stream_report
from tripmill.session import shared_dir, tune
from tripmill.sources.events import encode_events, file_events
from tripmill.streaming.etl import StreamTables, stream_etl

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def inputs(spark: SparkSession) -> dict[str, str]:
    """Paths of the inputs, each written as one file per core."""
    root = shared_dir(spark, "bench")

    def write(name: str, df: DataFrame) -> str:
        df.repartition(int(CPUS)).write.parquet(f"{root}/{name}")
        return f"{root}/{name}"

    paths = {
        "batch": write("batch", batch_trips(spark, SF_DIR)),
        "payloads": write("payloads", raw_events(spark, SF_DIR)),
        "stream": write("stream", stream_trips(spark, SF_DIR)),
    }
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    paths["trips"] = write("trips", build_intermediate(read["batch"], read["stream"], CONFIG))
    paths["daily"] = write("daily", daily_mart(spark.read.parquet(paths["trips"])))
    return paths


def headline(spark: SparkSession, paths: dict[str, str]) -> dict[str, Callable[[], DataFrame]]:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(paths[name])

    def validated() -> DataFrame:
        return validate_events(read("payloads"), CONFIG.event, CONFIG.as_of)

    def routes() -> DataFrame:
        code = F.col("error_code")
        return validated().agg(
            F.count("*"), F.count_if(code.isNull()), F.count_if(code.isNotNull())
        )

    def gates() -> DataFrame:
        checks = [*quality.intermediate_gates(CONFIG.event), quality.stream_present(CONFIG)]
        return quality.schema_gate(read("trips")).unionByName(quality.run_gates(read("trips"), checks))

    return {
        "batch_filter": lambda: apply_rules(read("batch"), batch_rules(CONFIG)),
        "batch_conform": lambda: conform_batch(read("batch"), CONFIG),
        "valid_enriched": lambda: valid_events(validated()),
        "dead_letter": lambda: rejected_events(validated()),
        "route_counts": routes,
        "int_trips": lambda: build_intermediate(read("batch"), read("stream"), CONFIG),
        "mart_daily": lambda: daily_mart(read("trips")),
        "mart_monthly": lambda: monthly_mart(read("trips")),
        "report_batch_monthly": lambda: batch_monthly_report(monthly_mart(read("trips"))),
        "report_batch_vs_stream": lambda: batch_vs_stream_report(daily_mart(read("trips"))),
        "gates_intermediate": gates,
        "reconciliation": lambda: audit.reconcile(read("trips"), read("daily")),
        "lineage_counts": lambda: audit.lineage_counts(read("trips")),
        "publish_payload": lambda: encode_events(read("stream").select(*EVENT_SCHEMA.names)),
    }


def run_stream(spark: SparkSession, landing: str) -> None:
    root = shared_dir(spark, "bench-stream")
    tables = StreamTables(f"{root}/valid", f"{root}/dead_letter")
    source = file_events(spark, landing, files_per_trigger=64)
    query = stream_etl(source, tables, f"{root}/checkpoint", CONFIG.event, CONFIG.as_of)
    query.awaitTermination()


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tripmill-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    paths = inputs(spark)
    seconds = {
        name: median_seconds(lambda run=run: consume(run()))
        for name, run in headline(spark, paths).items()
    }
    seconds["stream_etl"] = median_seconds(lambda: run_stream(spark, paths["payloads"]))
    rows = {name: spark.read.parquet(paths[name]).count() for name in ("batch", "payloads")}
    print(
        json.dumps(
            {
                "metric": "total median wall time of the headline operators",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "rows_per_second": {
                    "batch_conform": round(rows["batch"] / seconds["batch_conform"]),
                    "valid_enriched": round(rows["payloads"] / seconds["valid_enriched"]),
                    "stream_etl": round(rows["payloads"] / seconds["stream_etl"]),
                },
                "cpus": int(CPUS),
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
