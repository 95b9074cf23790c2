"""Audit queries over the pipeline's tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.numeric import exact_sum

from tripmill.contract import EventSpec
from tripmill.operators.quality import invalid_trip


def coverage(trips: DataFrame) -> DataFrame:
    """First and last business date and trip count per source."""
    return (
        trips.groupBy("source_type")
        .agg(
            F.min("pickup_date").alias("first_date"),
            F.max("pickup_date").alias("last_date"),
            F.count("*").alias("trip_count"),
        )
        .orderBy("source_type")
    )


def lineage_counts(trips: DataFrame) -> DataFrame:
    """Rows and unique trips per source."""
    return (
        trips.groupBy("source_type")
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct("trip_id").alias("unique_trips"),
        )
        .orderBy("source_type")
    )


def duplicate_rows(trips: DataFrame) -> DataFrame:
    """Rows beyond one per trip."""
    surplus = F.count("*") - F.count_distinct("trip_id")
    return trips.agg(surplus.alias("duplicate_rows"))


def invalid_rows(trips: DataFrame, spec: EventSpec | None = None) -> DataFrame:
    """Rows that break a rule shared by both sources."""
    return trips.filter(invalid_trip(spec)).agg(F.count("*").alias("invalid_rows"))


def reconcile(trips: DataFrame, daily: DataFrame, how: str = "inner") -> DataFrame:
    """Trip counts of the intermediate table against those of the daily mart, per source.

    Both sides are aggregated to one row per source before they are joined.
    With ``how="full"`` a source that only one side has is listed as well, as
    not reconciled.
    """
    counted = trips.groupBy("source_type").agg(F.count("*").alias("intermediate_rows"))
    summed = daily.groupBy("source_type").agg(F.sum("trip_count").alias("mart_rows"))
    same = F.col("intermediate_rows").eqNullSafe(F.col("mart_rows"))
    return (
        counted.join(summed, "source_type", how)
        .withColumn("reconciled", same)
        .orderBy("source_type")
    )


def content_sums(trips: DataFrame) -> DataFrame:
    """Per date and source what identifies the content of the trips, whatever their order.

    (pickup_date, source_type, trip_count, total_revenue, row_xor, row_sum). The two checksums
    are of hashes over all columns; a pair of equal rows, which the first one does not see,
    changes the second. Sums of parts add up to those of the whole.
    """
    row = F.xxhash64(*sorted(trips.columns))
    return trips.groupBy("pickup_date", "source_type").agg(
        F.count("*").alias("trip_count"),
        F.round(exact_sum(F.col("total_amount")), 2).alias("total_revenue"),
        F.bit_xor(row).alias("row_xor"),
        F.sum(F.shiftrightunsigned(row, 32)).alias("row_sum"),
    )


def reconcile_content(kept: DataFrame, trips: DataFrame, daily: DataFrame) -> DataFrame:
    """Per date and source: the sums kept when the trips were written, the trips and the daily mart.

    ``same_trips`` compares the checksums with those of the trips as they are now,
    ``same_mart`` the mart's count and revenue with the kept ones. A date that only one
    side has is listed, as not reconciled.
    """
    keys = ["pickup_date", "source_type"]

    def side(df: DataFrame, name: str, *columns: str) -> DataFrame:
        return df.select(*keys, F.struct(*columns).alias(name))

    sums = ("trip_count", "total_revenue", "row_xor", "row_sum")
    sides = side(kept, "kept", *sums).join(side(content_sums(trips), "now", *sums), keys, "full")
    sides = sides.join(side(daily, "mart", *sums[:2]), keys, "full")
    same_mart = F.struct("kept.trip_count", "kept.total_revenue").eqNullSafe(F.col("mart"))
    compared = sides.select(
        *keys,
        F.col("now.trip_count").alias("trip_rows"),
        F.col("mart.trip_count").alias("mart_rows"),
        (F.col("kept").isNotNull() & F.col("kept").eqNullSafe(F.col("now"))).alias("same_trips"),
        (F.col("kept").isNotNull() & same_mart).alias("same_mart"),
    )
    return compared.withColumn("reconciled", F.col("same_trips") & F.col("same_mart"))


def reject_profile(rejected: DataFrame) -> DataFrame:
    """Rejected events per error code."""
    return rejected.groupBy("error_code").agg(F.count("*").alias("rejected_rows"))


def input_accounting(consumed: DataFrame, valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """Whether valid plus rejected rows equal the payloads consumed."""
    inputs = {"consumed_rows": consumed, "valid_rows": valid, "rejected_rows": rejected}
    counted = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("rows")).withColumn("part", F.lit(name))
            for name, df in inputs.items()
        ],
    )
    side_by_side = counted.agg(
        *[F.sum(F.when(F.col("part") == name, F.col("rows"))).alias(name) for name in inputs]
    )
    total = F.col("valid_rows") + F.col("rejected_rows")
    return side_by_side.withColumn("accounted", total == F.col("consumed_rows"))


def recent_valid(valid: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` events processed last."""
    return valid.orderBy(F.desc("processing_time"), F.desc("ingestion_time"), "event_id").limit(n)


def table_inventory(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Row count, size and last change of Parquet tables given as name -> path.

    Row counts come from the file footers (no column is read) and sizes from
    the file listing (no content is read).
    """

    def rows(name: str, path: str) -> DataFrame:
        return spark.read.parquet(path).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_id"),
            "row_count",
            F.lit(0).cast("bigint").alias("size_bytes"),
            F.lit(None).cast("timestamp").alias("last_modified"),
        )

    def files(name: str, path: str) -> DataFrame:
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return listing.option("pathGlobFilter", "*.parquet").load(path).select(
            F.lit(name).alias("table_id"),
            F.lit(0).cast("bigint").alias("row_count"),
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("last_modified"),
        )

    parts = [part(name, path) for name, path in tables.items() for part in (rows, files)]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table_id")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("size_bytes").alias("size_bytes"),
            F.round(F.sum("size_bytes") / 1024 / 1024, 2).alias("size_mb"),
            F.max("last_modified").alias("last_modified"),
        )
        .orderBy("table_id")
    )
