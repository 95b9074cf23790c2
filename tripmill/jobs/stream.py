"""Run the streaming ETL: ``spark-submit tripmill/jobs/stream.py --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tripmill.contract import EventSpec
from tripmill.jobs.options import event_period
from tripmill.session import tune
from tripmill.sources.events import file_events, kafka_events, text_events
from tripmill.streaming.etl import StreamTables, stream_etl


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic", help="Kafka topic; needs --servers")
    source.add_argument("--files", help="folder of Parquet files with a binary column value")
    source.add_argument("--lines", help="folder of text files, one event per line")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--valid", required=True, help="path of the valid-event table")
    parser.add_argument("--dead-letter", required=True, help="path of the dead letter table")
    parser.add_argument("--checkpoint", required=True, help="checkpoint folder of this query")
    parser.add_argument("--every", help="run on, with this trigger interval, e.g. '1 minute'")
    event_period(parser)
    parser.add_argument("--per-trigger", type=int, help="bound a micro-batch: offsets or files")
    parsed = parser.parse_args(args)
    if parsed.topic and not parsed.servers:
        parser.error("--topic needs --servers")
    return parsed


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = arguments(args)
    spark = tune(spark or SparkSession.builder.appName("tripmill-stream").getOrCreate())
    if options.topic:
        bound = {"maxOffsetsPerTrigger": str(options.per_trigger)} if options.per_trigger else {}
        events = kafka_events(spark, options.servers, options.topic, **bound)
    elif options.files:
        events = file_events(spark, options.files, options.per_trigger)
    else:
        events = text_events(spark, options.lines, options.per_trigger)
    query = stream_etl(
        events,
        StreamTables(options.valid, options.dead_letter),
        options.checkpoint,
        EventSpec(options.event_start, options.event_end),
        trigger={"processingTime": options.every} if options.every else None,
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
