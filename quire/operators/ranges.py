"""Ordered work over groups of any size: running sums, neighbours, ranks.

A group of no more than ``HOT`` rows is one window.  The rows of larger ones are
cut into ranges of their order, each range is worked on alone, and what passes
from one to the next (a sum, a last row, a band that is open) is worked out from
a few values of each range and joined back.  The bounds of the ranges are
quantiles of rows drawn at random, so a value that many rows hold weighs as much
as its rows; a hash of the rows' other columns is the last key of the order and
parts them.  Bounds decide how even the ranges are and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a group from which on it is cut.
HOT = 1 << 20
#: Ranges, fewest and most, and rows that are looked at for each.
CUTS, MOST_CUTS, LOOKED_AT = 64, 256, 32
#: Hot groups that are told apart by name; if there are more, all groups are cut.
NAMED = 1000


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the one that driver and executors share (a local one only where none is set)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or "file:///tmp/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back, so that rounds do not repeat the rounds before them."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType))


def same_keys(a: DataFrame, b: DataFrame, by: Sequence[str]) -> tuple[DataFrame, Column]:
    """b with its key columns renamed, and the condition under which rows are of one group; keys may be null."""
    keys = [f"__k{i}" for i in range(len(by))]
    b = b.withColumnsRenamed(dict(zip(by, keys, strict=True)))
    return b, reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[k]) for c, k in zip(by, keys, strict=True)), F.lit(True))


def same_group(rows: DataFrame, parts: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """rows with the columns of parts of their group; a group may have null keys."""
    parts, on = same_keys(rows, parts, by)
    return rows.join(parts, on, how).drop(*(f"__k{i}" for i in range(len(by))))


def hot_groups(rows: DataFrame, by: Sequence[str], hot: int = HOT) -> tuple[DataFrame | None, int]:
    """(the keys of groups with more than hot rows, their rows in all); (None, rows) if there are too many to name them."""
    counts = rows.groupBy(*by).count().where(F.col("count") > hot)
    found = counts.limit(NAMED + 1).collect()
    if len(found) > NAMED:
        return None, counts.agg(F.sum("count")).first()[0]
    return rows.sparkSession.createDataFrame([tuple(r)[:-1] for r in found], T.StructType([rows.schema[c] for c in by])), sum(r["count"] for r in found)


def bounds_of(rows: DataFrame, place: Column, cuts: int) -> list:
    """At most cuts - 1 ascending places that part the rows evenly; nulls in a place count as least."""
    seen = [r.p for r in rows.select(place.alias("p")).orderBy(F.rand(7)).limit(cuts * LOOKED_AT).collect()]

    def key(p) -> tuple:  # nulls first, NaN last, as Spark orders them
        return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in p)

    seen.sort(key=key)
    out = []
    for i in range(1, cuts):
        p = seen[i * len(seen) // cuts] if seen else None
        if p is not None and (not out or key(out[-1]) != key(p)):
            out.append(p)
    return out


def place_in(place: Column, bounds: list, kind: T.StructType) -> Column:
    """How many bounds are no greater than place."""
    if not bounds:
        return F.lit(0)
    known = F.array(*(F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, kind, strict=True))) for b in bounds))
    return F.size(F.filter(known, lambda b: b <= place))


def in_ranges(rows: DataFrame, by: Sequence[str], order: Sequence[str], cuts: int | None = None, hot: int = HOT, sizes: DataFrame | None = None) -> tuple[DataFrame, list[str], bool]:
    """(rows with columns __tie and __cut, the order with __tie as its last key, whether any group is cut).

    Rows of a group that is not cut have the range 0 and __hot false.  Without groups the whole table is one, and it is
    cut.  cuts: so many ranges, and all groups are cut.  sizes: a table that is cheaper to count and has no smaller groups.
    """
    others = [F.col(f.name) for f in rows.schema if f.name not in {*by, *order} and _hashable(f.dataType)]
    rows = rows.withColumn("__tie", F.xxhash64(*others) if others else F.lit(0).cast("long"))
    order = [*order, "__tie"]
    place = F.struct(*order)
    named, n = (None, None) if cuts or not by else hot_groups(rows if sizes is None else sizes, by, hot)
    if named is not None and not n:
        return rows.withColumns({"__hot": F.lit(False), "__cut": F.lit(0)}), order, False
    if named is None:
        rows = rows.withColumn("__hot", F.lit(True))
    else:  # NAMED rows at most
        rows = same_group(rows, F.broadcast(named.withColumn("__is", F.lit(True))), by, "left").withColumn("__hot", F.col("__is").isNotNull()).drop("__is")
    bounds = bounds_of(rows.where("__hot"), place, cuts or (CUTS if n is None else min(MOST_CUTS, max(CUTS, n // hot))))
    kind = T.StructType([rows.schema[c] for c in order])
    return rows.withColumn("__cut", F.when(F.col("__hot"), place_in(place, bounds, kind)).otherwise(0)), order, True


def running(rows: DataFrame, value: str, order: str, out: str, by: Sequence[str] = (), cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """The sum of value over the rows before each row (column out, from 0), in each group, or over all rows without one.

    Rows of equal order come by a hash of their other columns.
    """
    marked, order, cut = in_ranges(rows, by, [order], cuts, hot)
    before = F.coalesce(F.sum(value).over(Window.partitionBy(*by, "__cut").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    if not cut:
        return marked.withColumn(out, before).drop("__tie", "__hot", "__cut")
    sums = marked.where("__hot").groupBy(*by, "__cut").agg(F.sum(value).alias("__s"))
    if not by:  # as many sums as ranges
        found = {r["__cut"]: r["__s"] or 0 for r in sums.collect()}
        begins = F.array(*(F.lit(sum(v for k, v in found.items() if k < c)).cast("long") for c in range(max(found, default=0) + 1)))
        return marked.withColumn(out, F.element_at(begins, F.col("__cut") + 1) + before).drop("__tie", "__hot", "__cut")
    earlier = Window.partitionBy(*by).orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select(*by, "__cut", F.sum("__s").over(earlier).alias("__b"))
    found = same_group(marked.withColumn("__in", before), begins, [*by, "__cut"], "left")
    return found.withColumn(out, (F.coalesce("__b", F.lit(0)) + F.col("__in")).cast("long")).drop("__tie", "__hot", "__cut", "__b", "__in")


def beside(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, before: str | None = None, behind: str | None = None, cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """rows with, of the values that are not null, the last one before each row (column before) and the first one behind it.

    A range that holds no value passes on what the ranges beside it hold.
    """
    marked, order, cut = in_ranges(rows, by, order, cuts, hot)
    marked = marked.withColumn("__v", value)
    down = [F.desc(c) for c in order]

    def last(c: str, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
        return F.last(c, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))

    wanted = {name: way for name, way in ((before, order), (behind, down)) if name}
    marked = marked.withColumns({name: last("__v", [*by, "__cut"], way) for name, way in wanted.items()})
    if cut:
        place = F.when(F.col("__v").isNotNull(), F.struct(*order))
        ends = marked.where("__hot").groupBy(*by, "__cut").agg(F.min_by("__v", place).alias("__first"), F.max_by("__v", place).alias("__last"))
        ends = ends.select(*by, "__cut", last("__last", by, ["__cut"]).alias("__before"), last("__first", by, [F.desc("__cut")]).alias("__behind"))
        marked = same_group(marked, ends, [*by, "__cut"], "left")
        marked = marked.withColumns({name: F.coalesce(F.col(name), F.col("__before" if way is order else "__behind")) for name, way in wanted.items()}).drop("__before", "__behind")
    return marked.drop("__tie", "__hot", "__cut", "__v")


def medians(rows: DataFrame, by: Sequence[str], value: str, out: str, cuts: int | None = None, hot: int = HOT, sizes: DataFrame | None = None) -> DataFrame:
    """by, out: the exact median of the values of each group that are not null.

    Values of large groups are ranked range by range and the middle ones picked, so no group's values are held together.
    """
    rows = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__x"), F.lit(1).alias("__one"))
    ranked, order, cut = in_ranges(rows, by, ["__x"], cuts, hot, sizes)
    if not cut:
        return rows.groupBy(*by).agg(F.median("__x").alias(out))
    w = Window.partitionBy(*by, "__cut").orderBy(*order)
    ranked = ranked.withColumn("__r", F.row_number().over(w))
    whole = Window.partitionBy(*by)
    counts = ranked.groupBy(*by, "__cut").agg(F.count("*").alias("__c")).select(*by, "__cut", F.sum("__c").over(whole).alias("__n"), F.coalesce(F.sum("__c").over(whole.orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    place = F.col("__b") + F.col("__r") - 1
    middle = same_group(ranked, counts, [*by, "__cut"]).where((place == F.expr("(__n - 1) div 2")) | (place == F.expr("__n div 2")))
    return middle.groupBy(*by).agg((0.5 * F.min("__x") + 0.5 * F.max("__x")).alias(out))
