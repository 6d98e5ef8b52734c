"""Connected components of a distributed edge list by alternating star contraction.

Each round joins every edge with its node's smallest neighbour (a partial aggregate, so a hub costs one row
a task) and re-hangs the edge under it. Rounds are cut with checkpoint() in the shared folder; the number of
rounds grows with the logarithm of the longest chain. A round has eight shuffles, and each of their tasks leaves
files of a block at least, so edges are held in as many partitions as their number needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MAX_ROUNDS = 60
EDGES_A_TASK = 200_000


def _hang(edges: DataFrame, tasks: int) -> DataFrame:
    """edges (u, v) -> for every u the edges (v, least of u and its v's)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u").coalesce(tasks)


def large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hang(both, tasks).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct().coalesce(tasks)


def small_star(edges: DataFrame, tasks: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = _hang(down, tasks)
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(hung.select("u", F.col("m").alias("v"))).where("u <> v").distinct().coalesce(tasks)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has an edge; edges are (u, v)."""
    ensure_checkpoint_dir(edges.sparkSession)
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct().checkpoint()
    signature = None
    for _ in range(MAX_ROUNDS):
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if row["n"] == 0 or (row["n"], row["h"]) == signature:
            break
        signature = (row["n"], row["h"])
        tasks = -(-row["n"] // EDGES_A_TASK)
        now = small_star(large_star(now.coalesce(tasks), tasks), tasks).checkpoint()
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
