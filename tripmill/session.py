"""Session settings the library relies on, and where it may put working files."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# UTC: every stored instant and every business date is UTC.
# allowDuplicateKeys: in a JSON object with a repeated key the last value wins.
# ansi: a batch value that does not fit its type fails the run, it is not replaced.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.ansi.enabled": "true",
}

# What results do not depend on. hugeMethodLimit: the JVM interprets methods above
# 8000 bytes for good, it never compiles them; the wide projections of payloads
# and trips are several times faster as several methods than as one such stage.
JOB_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on, and those for speed, to an existing session."""
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in JOB_SETTINGS.items():
        if int(spark.conf.get(key)) > int(value):
            spark.conf.set(key, value)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Settings of a job that owns its session, also where a session had lower limits of its own."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return configure(spark)


def workers(spark: SparkSession) -> int:
    """In how many parts rows are dealt where each row is costly: two for every core."""
    return 2 * spark.sparkContext.defaultParallelism


def clock(as_of: datetime | None) -> Column:
    """The run's clock as a column: a fixed instant, or the start of the query."""
    if as_of is None:
        return F.current_timestamp()
    return F.expr(sql_instant(as_of))


def sql_instant(instant: datetime) -> str:
    """An instant as an SQL literal."""
    return f"TIMESTAMP '{instant.astimezone(timezone.utc).isoformat()}'"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory below ``spark.checkpoint.dir``, else below the warehouse folder.

    Both settings name folders that all executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
