"""Connected groups in logarithmic rounds: large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corploom.operators.lookup import settled


# Edges that one task handles in a round; a short table is not dealt over every shuffle partition.
TASK_EDGES = 200_000


def components(edges: DataFrame, left: str, right: str, task_edges: int = TASK_EDGES) -> DataFrame:
    """(id, label) for every id in `edges`: the lowest id reachable from it.

    A round points the larger neighbours of each id to the least of its neighbourhood (large
    star), then its smaller ones and itself to the least of them (small star), until the edges
    are stars around the lowest ids; long chains shrink by halves. Minima are folded before
    the shuffle, hubs are split by the adaptive join, and each round is checkpointed. Rounds
    have no fixed end: they stop when a round changes nothing. A round uses as many tasks as
    its number of edges asks for, so the last short ones need no shuffle.
    """
    up = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    state = settled(up.filter("u <> v").distinct())
    mark = _mark(state)
    while mark[0]:
        tasks = -(-mark[0] // task_edges)
        state = state.coalesce(tasks)
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(tasks)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        inner = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = settled(inner.unionByName(least.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct())
        before, mark = mark, _mark(state)
        if mark == before:
            break
    roots = state.select(F.col("v").alias("id")).distinct().withColumn("label", F.col("id"))
    return state.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots)


def _mark(state: DataFrame) -> tuple:
    """Number of edges and a digest that tells whether a round changed any."""
    return tuple(state.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected(links: DataFrame, row_id: str, key: str) -> DataFrame:
    """(row_id, label): lowest row id reachable through shared keys.

    Rows are tied to the lowest row of each of their keys, so a key held by m rows gives m - 1
    edges and no pairs.
    """
    links = settled(links.filter(F.col(key).isNotNull()).select(row_id, key))
    heads = links.groupBy(key).agg(F.min(row_id).alias("_head"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    edges = links.join(heads, key).filter(F.col(row_id) != F.col("_head")).select(row_id, "_head")
    labels = components(edges, row_id, "_head").withColumnRenamed("id", row_id)
    return links.select(row_id).distinct().join(labels, row_id, "left").select(row_id, F.coalesce("label", row_id).alias("label"))
