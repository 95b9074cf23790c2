"""Run the batch pipeline: ``spark-submit tripmill/jobs/batch.py --help``."""

from __future__ import annotations

import argparse
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

from tripmill.contract import EventSpec, PipelineConfig
from tripmill.jobs.options import event_period
from tripmill.plans.batch import BatchTables, run_batch
from tripmill.plans.reports import batch_monthly_report, batch_vs_stream_report
from tripmill.session import tune


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("paths", nargs="+", help="monthly trip files or folders")
    parser.add_argument("--stream", required=True, help="path of the valid-event table")
    parser.add_argument("--root", required=True, help="folder the tables are written below")
    parser.add_argument("--start", type=date.fromisoformat, default=PipelineConfig.batch_start)
    parser.add_argument("--end", type=date.fromisoformat, default=PipelineConfig.batch_end)
    event_period(parser)
    parser.add_argument("--keep", type=int, help="delete runs older than the last so many versions")
    return parser.parse_args(args)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> BatchTables:
    options = arguments(args)
    spark = tune(spark or SparkSession.builder.appName("tripmill-batch").getOrCreate())
    started = datetime.now(timezone.utc)
    run_id = f"{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    cfg = PipelineConfig(
        batch_start=options.start,
        batch_end=options.end,
        event=EventSpec(options.event_start, options.event_end),
        as_of=started,
    )
    built = run_batch(
        spark, options.paths, options.stream, options.root, run_id, cfg, options.keep
    )
    for row in built.gates:
        print(f"gate {row.gate}: passed, observed {row.observed}")
    batch_monthly_report(built.monthly).show(truncate=False)
    batch_vs_stream_report(built.daily).show(truncate=False)
    return built


if __name__ == "__main__":
    main()
