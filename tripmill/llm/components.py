"""Connected components of a links table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import in_tasks, stored

MAX_ROUNDS = 60
#: Links that a task takes on.
EACH = 200_000


def connected(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the least id that links reach.

    Every round hangs each node's larger neighbours below its least neighbour and then
    each node below the least of the smaller ones; the links end as stars, after a
    number of rounds that grows with the logarithm of the longest path. Minima are
    taken before rows are shuffled, so a hub costs each task one row.
    """
    count = links.count()

    def few(df: DataFrame) -> DataFrame:
        return in_tasks(df, count, EACH)

    edges = few(links.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct())
    edges, seen = stored(edges, "links"), None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = few(both.groupBy("u").agg(F.min("v").alias("m")))
        large = few(both.join(least, "u").where("v > u").selectExpr("v AS u", "least(u, m) AS v"))
        large = few(large.distinct())
        least = few(large.groupBy("u").agg(F.min("v").alias("m")))
        small = few(large.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v"))
        edges = few(small.unionByName(least.selectExpr("u", "m AS v")).distinct())
        edges = stored(edges, "links")
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = few(edges.select(F.col("v").alias("id")).distinct())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
