"""Connected components of an edge table, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored

MAX_ROUNDS = 60
#: Share of all rows, and least number of them, from which on a node is a hub.
HUB, MIN_HUB = 0.001, 200


def _with_least(e: DataFrame, rows: int) -> DataFrame:
    """e with m, the least v of each u.

    Nodes with more than HUB of all rows, of which there are at most 1 / HUB, get it from a broadcast, so their rows
    need not meet; the others by a join.
    """
    least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    bar = max(MIN_HUB, HUB * rows)
    hubs = F.broadcast(least.where(F.col("n") > bar).select("u", F.col("m").alias("hub")))
    all_ = e.join(hubs, "u", "left")
    rest = all_.where("hub is null").select("u", "v").join(least.where(F.col("n") <= bar).select("u", "m"), "u")
    return rest.union(all_.where("hub is not null").select("u", "v", "hub"))


def _large_star(e: DataFrame, rows: int) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, 2 * rows).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(e: DataFrame, rows: int) -> DataFrame:
    found = _with_least(e, rows)
    return found.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    edges: two long columns u and v without nulls.  Alternating large-star and
    small-star rounds; every round is written to the shared folder, so a lost
    executor costs no more than the round at hand.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = stored(e, "edges")
    mark = _mark(e)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        large = stored(_large_star(e, mark[0]), "edges")
        e = stored(_small_star(large, mark[0]), "edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v")).distinct())


def _mark(e: DataFrame) -> tuple:
    row = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
    return tuple(row)
