"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.session import shared_dir

#: A key with more rows than this is ranked by several tasks.
HOT_ROWS = 1_000_000
#: Hot keys that are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 100_000


def rank_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``row_number`` within ``keys``, latest first.

    Rows alike in ``order`` are ranked by ``ties`` (by default every other
    column), so that the result does not depend on how the rows are spread.
    """
    ranking = Window.partitionBy(*keys).orderBy(*latest_first(df, keys, order, ties))
    return df.withColumn("row_number", F.row_number().over(ranking))


def latest_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] | None
) -> list[Column]:
    if ties is None:
        ties = [c for c in df.columns if c not in (*keys, *order)]
    return [*map(F.desc_nulls_last, order), *map(F.asc_nulls_last, ties)]


def rank_latest_spread(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """As ``rank_latest``, with no key's rows in one task.

    Keys of more than ``hot_rows`` rows are found by a count. Their rows are dealt out by
    ranges of key and order and written to the shared folder with the number of their
    part, so that a lost executor cannot deal them anew. Rows are ranked within key and
    part, and the rows of a key's earlier parts, a prefix sum over one row per part, are
    added. The other keys are ranked as ever. The count runs at once, the rest when asked for.
    """
    hot = df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > hot_rows)
    hot = hot.select(*(F.col(k).alias(f"hot_{k}") for k in keys))
    found = hot.limit(BROADCAST_KEYS + 1).count()
    if not found:
        return rank_latest(df, keys, order, ties)
    listed = F.broadcast(hot) if found <= BROADCAST_KEYS else hot
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"hot_{k}")) for k in keys])
    rest = rank_latest(df.join(listed, same, "left_anti"), keys, order, ties)
    # Rows alike in everything are told apart by their place, so that they do not go to one task.
    apart = df.join(listed, same, "left_semi").withColumn("place", F.monotonically_increasing_id())
    sorting = latest_first(df, keys, order, ties)
    parts = apart.repartitionByRange(*map(F.asc_nulls_first, keys), *sorting, "place")
    path = shared_dir(df.sparkSession, "ranking")
    parts = parts.withColumn("part", F.spark_partition_id())
    parts.write.parquet(path)
    parts = df.sparkSession.read.schema(parts.schema).parquet(path)
    within = Window.partitionBy(*keys, "part").orderBy(*sorting, "place")
    ranked = parts.withColumn("row_number", F.row_number().over(within))
    earlier = Window.partitionBy(*(f"hot_{k}" for k in keys)).orderBy("hot_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy(*keys, "part").agg(F.count("*").alias("rows"))
    sizes = sizes.select(*(F.col(k).alias(f"hot_{k}") for k in keys), F.col("part").alias("hot_part"), "rows")
    sizes = sizes.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    joined = ranked.join(sizes, same & (F.col("part") == F.col("hot_part")))
    row_number = (F.col("row_number") + F.col("before")).cast("int").alias("row_number")
    return rest.unionByName(joined.select(*df.columns, row_number))


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``keys``: the latest by ``order``.

    The rank filter becomes a window group limit on both sides of the shuffle:
    each task sends at most one row per key, so a key that holds a large part
    of the table still costs its reducer only one row per map task.
    """
    ranked = rank_latest(df, keys, order, ties)
    return ranked.filter(F.col("row_number") == 1).drop("row_number")
