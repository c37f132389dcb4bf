"""Layout geometry: token runs, boxes, bands, gaps, fits."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.ranges import CUTS, HOT, MOST_CUTS, beside, bounds_of, hot_groups, in_ranges, kept, medians, place_in, same_group


def runs(tokens: DataFrame, by: Sequence[str], order: Sequence[str], role: str, begins: Column | None = None, cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """Number the runs of equal roles in order (column run, from 0); see numbered_runs."""
    return numbered_runs(tokens, by, order, role, begins, cuts, hot)[0].drop("__cut")


def numbered_runs(tokens: DataFrame, by: Sequence[str], order: Sequence[str], role: str, begins: Column | None = None, cuts: int | None = None, hot: int = HOT) -> tuple[DataFrame, bool]:
    """Number the runs of equal roles in order; a token that begins, or follows another role, opens one (column run, from 0).

    A large group is cut into ranges of its order; a range counts the runs that open inside it, and the ends of the
    ranges tell where one goes on in the next.
    """
    own = F.lit(False) if begins is None else begins
    marked, order, cut = in_ranges(tokens.withColumn("__b", own), by, order, cuts, hot)
    w = Window.partitionBy(*by, "__cut").orderBy(*order)
    opens = F.when(F.row_number().over(w) == 1, F.lit(False)).otherwise(F.coalesce(F.lag(role).over(w) != F.col(role), F.lit(True)) | F.col("__b"))
    marked = marked.withColumn("__o", opens.cast("int")).withColumn("run", F.sum("__o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if cut:
        place = F.struct(*order)
        ends = marked.where("__hot").groupBy(*by, "__cut").agg(F.sum("__o").alias("__n"), F.min_by(F.struct(F.col(role).alias("r"), F.col("__b").alias("b")), place).alias("__first"), F.max_by(F.struct(F.col(role).alias("r")), place).alias("__last"))
        g = Window.partitionBy(*by).orderBy("__cut")
        goes_on = F.coalesce(F.lag("__last").over(g)["r"] == F.col("__first")["r"], F.lit(False)) & ~F.col("__first")["b"]
        ends = ends.withColumn("__open", (~goes_on).cast("int"))
        before = F.coalesce(F.sum(F.col("__n") + F.col("__open")).over(g.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        marked = same_group(marked, ends.select(*by, "__cut", (before + F.col("__open") - 1).alias("__from")), [*by, "__cut"], "left")
        marked = marked.withColumn("run", F.coalesce("__from", F.lit(0)) + F.col("run")).drop("__from")
    return marked.withColumn("run", F.col("run").cast("long")).drop("__b", "__tie", "__hot", "__o"), cut


def joined_runs(tokens: DataFrame, by: Sequence[str], order: Sequence[str], role: str, text: Column, aggs: dict[str, tuple], begins: Column | None = None, cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """by, run, role, text (the tokens' texts in order, one space between, nulls left out) and aggs of each run.

    aggs: name -> (aggregate function, column), of functions that may be taken of their own results, as min, max and sum.
    The texts of a run that goes through several ranges are put together range by range, then the ranges' texts.
    """
    numbered, cut = numbered_runs(tokens.withColumn("__text", text), by, order, role, begins, cuts, hot)
    keys = [*by, "run", role]

    def put(place: Column, part: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("p"), F.col(part).alias("t")))), lambda x: x["t"]), " ").alias("text")

    first = numbered.groupBy(*keys, *(["__cut"] if cut else [])).agg(put(F.struct(*order), "__text"), F.count("__text").alias("__n"), *(f(c).alias(name) for name, (f, c) in aggs.items()))
    if not cut:
        return first.drop("__n")
    parts = first.withColumn("__part", F.when(F.col("__n") > 0, F.col("text")))  # a range without texts adds no space
    return parts.groupBy(*keys).agg(put(F.col("__cut"), "__part"), *(f(name).alias(name) for name, (f, _) in aggs.items()))


def token_entities(words: DataFrame, cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """words: doc_id, pos, word, box (struct of x0, y0, x1, y1), tag.  BIO tags to entities with joined text and common box."""
    from quire.functions.text import bio_role

    named = words.withColumn("role", bio_role(F.col("tag"))).withColumns({f"__{c}": F.col("box")[c] for c in ("x0", "y0", "x1", "y1")})
    box = {c: (f, f"__{c}") for c, f in (("x0", F.min), ("y0", F.min), ("x1", F.max), ("y1", F.max))}
    out = joined_runs(named, ["doc_id"], ["pos"], "role", F.col("word"), box, F.col("tag").isin(1, 3, 5), cuts, hot).where("role <> 'other'")
    return out.withColumn("entity", F.row_number().over(Window.partitionBy("doc_id").orderBy("run")) - 1).drop("run")


def points_in_boxes(points: DataFrame, boxes: DataFrame, by: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Points inside any box of their page, edges included.

    Boxes of a page become one array, so the join is by equality and a point costs one row however many boxes there are.
    """
    few = boxes.groupBy(*by).agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("__boxes"))
    hit = F.exists("__boxes", lambda b: (F.col(x) >= b["x0"]) & (F.col(x) <= b["x1"]) & (F.col(y) >= b["y0"]) & (F.col(y) <= b["y1"]))
    return points.join(few, list(by)).where(hit).drop("__boxes")


#: A box lies on so many cells of its level in each direction, about; copies of a cell of the upper levels; the finest level (cells of 8).
SPREAD, SALTS, FINEST = 4, 16, 3


def points_in_shared_boxes(points: DataFrame, boxes: DataFrame, x: str = "x", y: str = "y", finest: int = FINEST) -> DataFrame:
    """Points inside any of many boxes that all pages share, edges included.

    Grids of cells of 2 ** level, one above the other: a box lies on the level on which it touches few cells, at most
    (2 * SPREAD + 1) ** 2, whatever its size, and a point looks at its cell on each level that has boxes.  Cells that a
    box fills need no further look and are there once, however many boxes fill them; at its edge a box brings its
    coordinates.  The few cells of the upper levels have copies among which their points are dealt.  Boxes are cut off
    where there are no points, so those of infinite size are like others.  Points without finite coordinates are in no
    box, nor are any in boxes that end before they begin.
    """
    here = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf")))
    x0, y0, x1, y1 = here.agg(F.min(x).cast("double"), F.min(y).cast("double"), F.max(x).cast("double"), F.max(y).cast("double")).first()
    if x0 is None:
        return here
    b = boxes.dropna(subset=["x0", "y0", "x1", "y1"]).select(
        F.greatest(F.col("x0").cast("double"), F.lit(x0)).alias("x0"), F.greatest(F.col("y0").cast("double"), F.lit(y0)).alias("y0"),
        F.least(F.col("x1").cast("double"), F.lit(x1)).alias("x1"), F.least(F.col("y1").cast("double"), F.lit(y1)).alias("y1"),
    )
    b = b.where("x0 <= x1 and y0 <= y1").distinct()
    span = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    b = b.withColumn("__l", F.greatest(F.lit(finest), F.coalesce(F.ceil(F.log2(span / SPREAD)).cast("int"), F.lit(finest))))
    size = F.pow(F.lit(2.0), F.col("__l"))  # a power of two, so cells are exact
    at = lambda c: F.floor(F.col(c) / size)
    b = b.withColumn("__cx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("__cy", F.explode(F.sequence(at("y0"), at("y1"))))
    fills = reduce(lambda a, c: a & c, ((F.col(f"{c}0") <= F.col(f"__c{c}") * size) & ((F.col(f"__c{c}") + 1) * size <= F.col(f"{c}1")) for c in "xy"))
    b = b.select("__l", "__cx", "__cy", *(F.when(~fills, F.col(c)).alias(f"__{c}") for c in ("x0", "y0", "x1", "y1"))).distinct()
    levels = sorted(r["__l"] for r in b.select("__l").distinct().collect())  # of a double's exponents
    if not levels:
        return here.where("false")
    copies = F.when(F.col("__l") > finest, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    b = b.withColumn("__s", F.explode(copies)).withColumnsRenamed({c: f"{c}_" for c in ("__l", "__cx", "__cy", "__s")})
    p = here.withColumn("__id", F.monotonically_increasing_id()).withColumn("__l", F.explode(F.array(*map(F.lit, levels))))
    p = p.withColumns({"__cx": at(x), "__cy": at(y), "__s": F.when(F.col("__l") > finest, (F.col("__id") % SALTS).cast("int")).otherwise(0)})
    same = reduce(lambda a, c: a & (p[c] == b[f"{c}_"]), ("__l", "__cx", "__cy", "__s"), F.lit(True))
    inside = b["__x0"].isNull() | ((p[x] >= b["__x0"]) & (p[x] <= b["__x1"]) & (p[y] >= b["__y0"]) & (p[y] <= b["__y1"]))
    found = p.join(b, same & inside, "left_semi")
    return (found if len(levels) == 1 else found.dropDuplicates(["__id"])).select(*points.columns)


def nearest(points: DataFrame, targets: DataFrame, by: Sequence[str], point_id: str, point_x: str, target_id: Sequence[str], target_x: str, cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """For each target the point with the least distance in x, the smaller id of equals.

    Points and targets of a group meet in one order by x; the neighbours left and right decide, so no pair is made.
    """
    # a point takes part once for each place: the smallest id there
    p = points.groupBy(*by, F.col(point_x).alias("__x")).agg(F.min(point_id).alias("__id"))
    t = targets.select(*by, *target_id, F.col(target_x).alias("__x"))
    both = p.select(*by, "__x", "__id", *(F.lit(None).cast(targets.schema[c].dataType).alias(c) for c in target_id), F.lit(0).alias("__t")).unionByName(
        t.select(*by, "__x", F.lit(None).cast(p.schema["__id"].dataType).alias("__id"), *target_id, F.lit(1).alias("__t"))
    )
    # a point at the target's own place stands before it
    here = F.when(F.col("__t") == 0, F.struct(F.col("__x").alias("x"), F.col("__id").alias("id")))
    cand = beside(both, by, ["__x", "__t"], here, "__l", "__r", cuts, hot).where("__t = 1")
    rank = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(c)["x"] - F.col("__x")).alias("d"), F.col(c)["id"].alias("id")))
    return cand.withColumn("__best", F.least(rank("__l"), rank("__r"))).select(*by, *target_id, F.col("__best")["id"].alias("nearest_id"), F.col("__best")["d"].alias("distance"))


def _beyond(v: np.ndarray, first: np.ndarray, tolerance: float) -> np.ndarray:
    """For each first member, the place in v (ascending, NaN last) of the first value that its band does not take."""
    n = len(v)
    j = np.searchsorted(v, first + tolerance, "right")
    while True:  # the difference decides, not the rounded sum
        back = (j > 0) & ~(v[np.maximum(j - 1, 0)] - first <= tolerance) & (v[np.maximum(j - 1, 0)] > first)
        on = (j < n) & (v[np.minimum(j, n - 1)] - first <= tolerance)
        if not (back.any() or on.any()):
            return j
        j = j - back + on


def _passage(v: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """What a range of heights does to a band that is open before it: (starts, exits, counts, open).

    The first of the starts that the open band does not take begins a band; exits has the first member of the band that
    is open at the end then, counts how many bands have begun.  open: a band may take the whole range and go on.
    """
    n = len(v)
    on = _beyond(v, v, tolerance)
    on = np.where(np.isnan(v), n, np.maximum(on, np.arange(n) + 1))
    last, count, to = np.arange(n), np.ones(n, np.int64), on
    while (to < n).any():  # twice as many steps each time
        at = np.minimum(to, n - 1)
        more = to < n
        last, count, to = np.where(more, last[at], last), count + np.where(more, count[at], 0), np.where(more, to[at], n)
    zone = slice(0, int(on[0]) + 1)
    return v[zone], v[last[zone]], count[zone], bool(on[0] >= n)


def _entries(cells: DataFrame, by: Sequence[str], tolerance: float, cuts: int) -> DataFrame:
    """by, __cut, __first, __from: the band that is open where a range begins, and its number.

    cells: by, __cut, and the heights of each range as the array v.  Each range becomes a passage; passages of
    neighbouring ranges are put together in log2(cuts) rounds, each of which doubles how far they reach back.
    """
    kinds = "starts array<double>, exits array<double>, counts array<long>, open boolean"
    shape = T.StructType([*(cells.schema[c] for c in (*by, "__cut")), *T._parse_datatype_string(kinds)])
    arrays = (pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_())

    def batch(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        own = [pa.array([r[i] for r in rows], k) for i, k in enumerate(arrays)]
        return pa.RecordBatch.from_arrays([*b.columns[: len(by) + 1], *own], names=shape.names)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(b, [_passage(np.array(v.as_py(), float), tolerance) for v in b.column(len(by) + 1)])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for own, earlier in zip(b.column(len(by) + 1).to_pylist(), b.column(len(by) + 2).to_pylist(), strict=True):
                starts, exits, counts = (np.array(own[c]) for c in ("starts", "exits", "counts"))
                open_ = own["open"]
                if earlier is not None:
                    first, count = np.array(earlier["exits"], float), np.array(earlier["counts"])
                    j = np.where(np.isnan(first), len(starts), _beyond(starts, first, tolerance))
                    at, more = np.minimum(j, len(starts) - 1), j < len(starts)
                    through = slice(None if earlier["open"] else 0)  # what an open band that takes all of the earlier range meets
                    starts, exits, counts = (
                        np.concatenate([a, b[through]]) for a, b in ((earlier["starts"], starts), (np.where(more, exits[at], first), exits), (count + np.where(more, counts[at], 0), counts))
                    )
                    open_ = open_ and earlier["open"]
                out.append((starts, exits, counts, open_))
            yield batch(b, out)

    # ranges without heights have no row: the others are numbered anew
    cells = cells.withColumn("__cut_", F.row_number().over(Window.partitionBy(*by).orderBy("__cut")))
    numbers = cells.select(*by, "__cut", F.col("__cut_").alias("__place"))
    own = kept(cells.select(*by, F.col("__cut_").alias("__cut"), "v").mapInArrow(single, shape), "bands")
    reach = 1
    while reach < cuts:
        earlier = own.select(*by, (F.col("__cut") + reach).alias("__cut"), F.struct("starts", "exits", "counts", "open").alias("__e"))
        both = same_group(own.select(*by, "__cut", F.struct("starts", "exits", "counts", "open").alias("__own")), earlier, [*by, "__cut"], "left")
        own = kept(both.mapInArrow(joined, shape), "bands")
        reach *= 2
    # of the first range the least height begins the first band
    ends = own.select(*by, (F.col("__cut") + 1).alias("__place"), F.col("exits")[0].alias("__first"), (F.col("counts")[0] - 1).alias("__from"))
    return same_group(numbers, ends, [*by, "__place"]).drop("__place")


def bands(points: DataFrame, by: Sequence[str], y: str, ids: Sequence[str], tolerance: float, cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """Number the y-bands of each group (column band): a band takes what lies within tolerance of its first member.

    Only the distinct heights of a group are walked, in order and batch by batch; the points get their band by an
    equality join on group and height.  A large group is walked range by range, each from the band that is open where it
    begins.  Points without a height have no band.
    """
    places = points.select(*by, F.col(y).cast("double").alias("__y")).where("__y is not null").distinct()
    marked, _, cut = in_ranges(places, by, ["__y"], cuts, hot, points)
    keys = [*by, "__cut"]
    marked = marked.select(*keys, "__hot", "__y")
    if cut:
        cells = marked.where("__hot").groupBy(*keys).agg(F.array_sort(F.collect_list("__y")).alias("v"))
        marked = same_group(marked, _entries(cells, by, tolerance, cuts or MOST_CUTS), keys, "left")
    else:
        marked = marked.withColumns({"__first": F.lit(None).cast("double"), "__from": F.lit(None).cast("long")})
    marked = marked.select(*keys, "__y", "__first", "__from")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first, band = None, 0.0, 0
        for b in batches:
            out = []
            for *g, v, begun, number in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if g != group:
                    group, first, band = g, v if begun is None else begun, 0 if number is None else number
                if not v - first <= tolerance and (v == v or first == first):  # NaN comes last and has a band of its own
                    first, band = v, band + 1
                out.append(band)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(out, pa.int32())], names=[*b.schema.names[:-2], "band"])

    ordered = marked.repartition(*keys).sortWithinPartitions(*keys, "__y")
    numbered = ordered.mapInArrow(walk, T.StructType([*marked.schema.fields[:-2], T.StructField("band", T.IntegerType())])).drop("__cut")
    rows = points.select(*by, *ids, F.col(y).cast("double").alias(y))
    return same_group(rows, numbered.withColumnRenamed("__y", y), [*by, y], "left").select(*by, *ids, y, "band")


def spacings(points: DataFrame, by: Sequence[str], x: str, ids: Sequence[str] = (), cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """Distance from each point to the next in its group (null for the last)."""
    found = beside(points, by, [x, *ids], F.struct(F.col(x).alias("x")), behind="__next", cuts=cuts, hot=hot)
    return found.withColumn("spacing", F.col("__next.x") - F.col(x)).withColumn("next_x", F.col("__next.x")).drop("__next")


def spacing_stats(
    gaps: DataFrame, by: Sequence[str], tolerant: bool = False, cuts: int | None = None, hot: int = HOT, sizes: DataFrame | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """n, mean, population deviation and their ratio; tolerant: of spacings up to 1.5 medians (1 at least), two of which are needed.

    sizes: the points, which are cheaper to count than their gaps.  order: spacings are added up in it, so that a mean
    has the same last bit whatever the partitions (of a group that is cut: range by range).
    """
    gaps = gaps.where("spacing is not null")
    if tolerant:
        gaps = same_group(gaps, medians(gaps, by, "spacing", "__m", cuts, hot, sizes), by).where(F.col("spacing") <= F.greatest(F.col("__m") * 1.5, F.lit(1.0)))
    found = [F.count("*").alias("n"), F.stddev_pop("spacing").alias("deviation")]
    if order:
        marked, order, cut = in_ranges(gaps, by, order, cuts, hot, sizes)
        so_far = F.sum("spacing").over(Window.partitionBy(*by, "__cut").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        whole = F.max_by("__s", F.struct(*order)).alias("__s")
        out = marked.withColumn("__s", so_far).groupBy(*by, *(["__cut"] if cut else [])).agg(whole, *([] if cut else found))
        if cut:
            parts = F.array_sort(F.collect_list(F.struct("__cut", "__s")))
            out = same_group(gaps.groupBy(*by).agg(*found), out.groupBy(*by).agg(F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["__s"]).alias("__s")), by)
        out = out.select(*by, "n", (F.col("__s") / F.col("n")).alias("mean"), "deviation")
    else:
        out = gaps.groupBy(*by).agg(found[0], F.avg("spacing").alias("mean"), found[1])
    out = out.where("n >= 2") if tolerant else out
    return out.where("mean > 0").withColumn("cv", F.col("deviation") / F.col("mean"))


def reject_reason(dots: Column, width: Column, normal: Column, cv: Column, min_dots: int = 4, min_width: float = 20, max_cv: float = 0.3) -> Column:
    """Why a band is no dotted line, the first reason that holds; null if it is one."""
    return F.when(dots < min_dots, "too_few_dots").when(width < min_width, "too_narrow").when(normal < 2, "insufficient_normal_spacings").when(cv > max_cv, "spacing_irregular")


def baseline(points: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Least squares through a group's points; flat through their mean where two points or an extent of 1 are missing."""
    fit = points.groupBy(*by).agg(
        F.count("*").alias("n"), (F.max(x) - F.min(x)).alias("extent"), F.avg(y).alias("mean_y"), F.regr_slope(y, x).alias("s"), F.regr_intercept(y, x).alias("i")
    )
    flat = (F.col("n") < 2) | (F.col("extent") < 1)
    return fit.select(*by, F.when(flat, 0.0).otherwise(F.col("s")).alias("slope"), F.when(flat, F.col("mean_y")).otherwise(F.col("i")).alias("intercept"))


def gap_targets(gaps: DataFrame, stats: DataFrame, by: Sequence[str], x: str, ratio: float = 1.3) -> DataFrame:
    """Where points are missing: gaps over ratio times the group's mean spacing, cut evenly (columns j, expected, target_x)."""
    wide = gaps.join(stats.select(*by, "mean"), list(by)).where(F.col("spacing") > F.col("mean") * ratio)
    expected = F.greatest(F.lit(1), F.bround(F.col("spacing") / F.col("mean")).cast("int") - 1)
    rows = wide.withColumn("expected", expected).withColumn("j", F.explode(F.sequence(F.lit(1), F.col("expected"))))
    return rows.withColumn("target_x", F.col(x) + F.col("j") * F.col("spacing") / (F.col("expected") + 1))


def _sweep(n_keys: int):
    """Of the boxes that are open at each height asked for: the greatest x1 and the least x0.

    Rows come by range, then height, boxes (at 0) before heights (at 1).  A box stays in the heaps until it is on top
    and ends before the height at hand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, top, low = None, [], []
        for b in batches:
            rows = []
            for i, (*g, v, asked, hi, x0, x1) in enumerate(zip(*(c.to_pylist() for c in b.columns), strict=True)):
                if g != group:
                    group, top, low = g, [], []
                if not asked:
                    heapq.heappush(top, (-x1, hi))
                    heapq.heappush(low, (x0, hi))
                    continue
                for heap in (top, low):
                    while heap and heap[0][1] < v:
                        heapq.heappop(heap)
                rows.append((i, -top[0][0] if top else None, low[0][0] if low else None))
            found = b.take(pa.array([r[0] for r in rows], pa.int32()))
            sides = [pa.array([r[k] for r in rows], pa.float64()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([*found.columns[: n_keys + 1], *sides], names=[*b.schema.names[: n_keys + 1], "__top", "__low"])

    return run


def single_sided(clusters: DataFrame, boxes: DataFrame, by: Sequence[str], cuts: int | None = None, hot: int = HOT) -> DataFrame:
    """Notes on boxes past a cluster's end: clusters has x_lo, x_hi, y_center, mean; boxes x0, y0, x1, y1.

    Only the greatest x1 and the least x0 of the boxes at a cluster's height matter.  They come from a sweep over heights
    in each group; a large group is cut into ranges of height, in which a box is swept where it begins and where it
    ends, and the ranges in between get it as a whole.  No pair of cluster and box is made.

    clusters are written once: a height that is an average has another last bit when it is worked out again, and would
    not meet itself.
    """
    clusters = kept(clusters, "clusters")
    b = boxes.select(*by, *(F.col(c).cast("double").alias(f"__{c}") for c in ("x0", "x1")), (F.col("y0") - 2).cast("double").alias("__lo"), (F.col("y1") + 2).cast("double").alias("__hi"))
    b = b.where("__lo <= __hi and not isnan(__hi)").groupBy(*by, "__lo", "__hi").agg(F.min("__x0").alias("__x0"), F.max("__x1").alias("__x1")).dropna(subset=["__x0", "__x1"])
    heights = clusters.select(*by, F.col("y_center").cast("double").alias("__v")).where("__v is not null and not isnan(__v)").distinct()
    marks = heights.union(b.select(*by, "__lo")).union(b.select(*by, "__hi"))
    named, n = (None, None) if cuts else hot_groups(marks, by, hot)
    if named is not None and not n:
        range_of = lambda c: F.lit(0)
    else:
        large = marks if named is None else same_group(marks, F.broadcast(named), by)
        bounds = bounds_of(large, F.struct("__v"), cuts or min(MOST_CUTS, max(CUTS, n // hot)))
        range_of = lambda c: place_in(F.struct(F.col(c).alias("__v")), bounds, T.StructType([marks.schema["__v"]]))
    b = b.withColumns({"__a": range_of("__lo"), "__b": range_of("__hi")})
    ends = F.when(F.col("__a") == F.col("__b"), F.array(F.struct(F.col("__a").alias("c"), F.col("__lo").alias("v"), F.col("__hi").alias("hi"))))
    ends = ends.otherwise(
        F.array(
            F.struct(F.col("__a").alias("c"), F.col("__lo").alias("v"), F.lit(float("inf")).alias("hi")), F.struct(F.col("__b").alias("c"), F.lit(float("-inf")).alias("v"), F.col("__hi").alias("hi"))
        )
    )
    open_ = b.select(*by, "__x0", "__x1", F.explode(ends).alias("e")).select(*by, F.col("e.c").alias("__cut"), F.col("e.v").alias("__v"), F.lit(0).alias("__asked"), F.col("e.hi").alias("__hi"), "__x0", "__x1")
    none = F.lit(None).cast("double")
    asked = heights.select(*by, range_of("__v").alias("__cut"), "__v", F.lit(1).alias("__asked"), none.alias("__hi"), none.alias("__x0"), none.alias("__x1"))
    keys = [*by, "__cut"]
    rows = open_.union(asked).repartition(*keys).sortWithinPartitions(*keys, "__v", "__asked")
    shape = T.StructType([*(rows.schema[c] for c in (*keys, "__v")), T.StructField("__top", T.DoubleType()), T.StructField("__low", T.DoubleType())])
    found = rows.mapInArrow(_sweep(len(keys)), shape)
    # ranges that a box covers from end to end: as many rows as pairs of ranges at most
    whole = b.where("__b - __a >= 2").groupBy(*by, "__a", "__b").agg(F.min("__x0").alias("__l"), F.max("__x1").alias("__t"))
    whole = whole.withColumn("__cut", F.explode(F.sequence(F.col("__a") + 1, F.col("__b") - 1))).groupBy(*keys).agg(F.min("__l").alias("__l"), F.max("__t").alias("__t"))
    found = same_group(found, whole, keys, "left").select(*by, F.col("__v").alias("y_center"), F.greatest("__top", "__t").alias("__top"), F.least("__low", "__l").alias("__low"))
    met = same_group(clusters.withColumn("__y", F.col("y_center").cast("double")), found.withColumnRenamed("y_center", "__y"), [*by, "__y"]).drop("__y")
    reach = 1.5 * F.col("mean")
    right = F.when(F.col("__top") > F.col("x_hi") + reach, "single_sided:no_right_anchor")
    left = F.when(F.col("__low") < F.col("x_lo") - reach, "single_sided:no_left_anchor")
    return met.select(*clusters.columns, F.explode(F.array_compact(F.array(right, left))).alias("note")).distinct()
