"""Reports read from the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numeric import exact_sum, rounded_ratio


def batch_monthly_report(monthly: DataFrame) -> DataFrame:
    """Monthly performance of the batch trips, oldest month first."""
    return (
        monthly.filter(F.col("source_type") == "batch")
        .select(
            "pickup_month",
            "trip_count",
            "total_revenue",
            "average_total_amount",
            "average_trip_distance",
        )
        .orderBy("pickup_month")
    )


def batch_vs_stream_report(daily: DataFrame) -> DataFrame:
    """Totals and weighted means per source, from the daily mart.

    Means are ratios of sums. The distance is weighted from the mart's rounded
    daily means, so it carries their rounding.
    """
    trips = F.sum("trip_count")
    revenue = exact_sum(F.col("total_revenue"))
    distance = exact_sum(F.col("average_trip_distance") * F.col("trip_count"))
    return (
        daily.groupBy("source_type")
        .agg(
            trips.alias("trip_count"),
            F.round(revenue, 2).alias("total_revenue"),
            rounded_ratio(revenue, trips).alias("revenue_per_trip"),
            rounded_ratio(distance, trips).alias("average_trip_distance"),
        )
        .orderBy("source_type")
    )
