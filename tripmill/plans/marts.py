"""Daily and monthly aggregates of the intermediate trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numeric import exact_sum, rounded_ratio

DAILY_PARTITION = ("pickup_date",)
DAILY_CLUSTER = ("source_type",)


def _measures() -> list[Column]:
    trips = F.count("*")
    revenue = exact_sum(F.col("total_amount"))
    return [
        trips.alias("trip_count"),
        F.round(revenue, 2).alias("total_revenue"),
        rounded_ratio(revenue, F.count("total_amount")).alias("average_total_amount"),
        rounded_ratio(
            exact_sum(F.col("trip_distance")), F.count("trip_distance")
        ).alias("average_trip_distance"),
    ]


def daily_mart(trips: DataFrame) -> DataFrame:
    """Trips, revenue and means per business date and source."""
    seconds = F.timestamp_diff("SECOND", F.col("pickup_datetime"), F.col("dropoff_datetime"))
    minutes = rounded_ratio(F.sum(seconds), F.count(seconds) * 60)
    return trips.groupBy("pickup_date", "source_type").agg(
        *_measures(), minutes.alias("average_duration_minutes")
    )


def monthly_mart(trips: DataFrame) -> DataFrame:
    """Trips, revenue and means per month and source."""
    month = F.trunc("pickup_date", "MM").alias("pickup_month")
    return trips.groupBy(month, "source_type").agg(*_measures())
