"""Connected components of a graph whose nodes are any values that have an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.ranges import kept

#: Rounds after which something must be wrong: each at least halves the depth of what is not yet settled.
MAX_ROUNDS = 60


def components(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, node, root: the least node of the component of each node that has an edge; edges has by, u, v.

    Every node's neighbours are hung on the least of them, those above it first and then those below, until nothing
    changes.  A round is written to the shared folder before the next reads it.
    """
    e = kept(edges.where("u <> v").select(*by, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64(*by, "u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first())
        if now == mark or not now[0]:
            least = e.select(*by, F.col("u").alias("node"), F.col("v").alias("root"))
            return least.union(e.select(*by, F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
        both = e.select(*by, "u", "v").union(e.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*by, "u").agg(F.min("v").alias("m"))
        above = both.where("v > u").join(low, [*by, "u"]).select(*by, F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        above = kept(above, "edges")
        low = above.groupBy(*by, "u").agg(F.min("v").alias("m"))
        e = kept(above.join(low, [*by, "u"]).select(*by, F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "edges")
    raise RuntimeError("connected components did not settle")
