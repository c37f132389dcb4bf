"""Raster morphology as window functions over a pixel relation (img, y, x, v).

Every structuring element is a line (a square is two lines), so erosion is the
least and dilation the largest value of a symmetric row frame; frames end at
the border as the border does.  This form suits small rasters and checks; pages
go through ``quire.operators.pages``, whose numpy kernels give the same pixels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.graph import components as connected
from quire.operators.ranges import kept, running


def from_array(df: DataFrame, image: str, values: str, width: int, to_pixel) -> DataFrame:
    """An array of values, row by row, as pixels."""
    z = df.select(F.col(image).alias("img"), F.posexplode(values).alias("i", "e"))
    return z.select("img", F.expr(f"i div {width}").cast("int").alias("y"), (F.col("i") % width).alias("x"), to_pixel(F.col("e")).cast("int").alias("v"))


def luma(r: Column, g: Column, b: Column) -> Column:
    return F.floor(r * 0.299 + g * 0.587 + b * 0.114 + 0.5).cast("int")


def _frame(axis: str, half: int, by: Sequence[str]):
    fixed = "y" if axis == "x" else "x"
    return Window.partitionBy(*by, fixed).orderBy(axis).rowsBetween(-half, half)


def erode(px: DataFrame, col: str, axis: str, half: int, out: str, by: Sequence[str] = ("img",)) -> DataFrame:
    return px.withColumn(out, F.min(col).over(_frame(axis, half, by)))


def dilate(px: DataFrame, col: str, axis: str, half: int, out: str, by: Sequence[str] = ("img",)) -> DataFrame:
    return px.withColumn(out, F.max(col).over(_frame(axis, half, by)))


def opened(px: DataFrame, col: str, axis: str, half: int, out: str, by: Sequence[str] = ("img",)) -> DataFrame:
    return dilate(erode(px, col, axis, half, "__e", by), "__e", axis, half, out, by).drop("__e")


def closed(px: DataFrame, col: str, axis: str, half: int, out: str, by: Sequence[str] = ("img",)) -> DataFrame:
    return erode(dilate(px, col, axis, half, "__d", by), "__d", axis, half, out, by).drop("__d")


def black_tophat(px: DataFrame, col: str, axis: str, half: int, out: str, by: Sequence[str] = ("img",)) -> DataFrame:
    return closed(px, col, axis, half, "__c", by).withColumn(out, F.col("__c") - F.col(col)).drop("__c")


def otsu(px: DataFrame, by: Sequence[str] = ("img",), v: str = "v", digits: int = 6) -> DataFrame:
    """The threshold t that parts v <= t from the rest with the largest variance between; the least of equals.

    A raster enters as its histogram, 256 rows at most; the variance is rounded so that engines agree on ties.
    """
    hist = px.groupBy(*by, v).agg(F.count("*").alias("n"))
    up = Window.partitionBy(*by).orderBy(v).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    h = hist.select(
        *by, v, F.sum("n").over(up).alias("w0"), F.sum(F.col("n") * F.col(v)).over(up).alias("s0"), F.sum("n").over(whole).alias("w"), F.sum(F.col("n") * F.col(v)).over(whole).alias("s")
    )
    w1 = F.col("w") - F.col("w0")
    d = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / F.nullif(w1, F.lit(0))
    sigma = F.round(F.coalesce(F.col("w0").cast("double") * w1 * d * d, F.lit(0.0)), digits)
    return h.groupBy(*by).agg(F.min_by(v, F.struct(-sigma, F.col(v))).alias("threshold"))


def text_mask(px: DataFrame, fg: str, half_h: int, half_v: int, by: Sequence[str] = ("img",)) -> DataFrame:
    """Foreground that belongs to no rule: columns h_rule, v_rule, rule, text; the text is grown by one pixel but never into a rule."""
    px = opened(px, fg, "x", half_h, "h_rule", by)
    px = opened(px, fg, "y", half_v, "v_rule", by)
    px = px.withColumn("rule", F.greatest("h_rule", "v_rule")).withColumn("__t", F.when(F.col("rule") == 1, 0).otherwise(F.col(fg)))
    px = dilate(dilate(px, "__t", "x", 1, "__a", by), "__a", "y", 1, "__b", by)
    return px.withColumn("text", F.when(F.col("rule") == 1, 0).otherwise(F.col("__b"))).drop("__t", "__a", "__b")


def strip_color(px: DataFrame, by: Sequence[str], slice_: str, channels: Sequence[str]) -> DataFrame:
    """The brightest slice of a strip: medians along each slice, the first of the brightest."""
    mid = px.groupBy(*by, slice_).agg(*(F.median(c).alias(c) for c in channels))
    bright = sum((F.col(c) for c in channels[1:]), F.col(channels[0])) / len(channels)
    best = F.max_by(F.struct(*(F.col(c).cast("int").alias(c) for c in channels), F.col(slice_)), F.struct(F.round(bright, 6), -F.col(slice_)))
    return mid.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def background(strips: DataFrame, by: Sequence[str], ink: int = 90) -> DataFrame:
    """strips: a row for each of side top, bottom, left, right with c0, c1, c2.  The colour behind a box.

    Top and bottom count first, then left and right, unless they look inky; else the first strip there is, else white.
    """
    clean = F.least("c0", "c1", "c2") >= ink
    pair = lambda a, b: [F.avg(F.when(F.col("side").isin(a, b) & clean, F.col(c))) for c in ("c0", "c1", "c2")]
    order = F.when(F.col("side") == "top", 0).when(F.col("side") == "bottom", 1).when(F.col("side") == "left", 2).otherwise(3)
    v, h, any_ = pair("top", "bottom"), pair("left", "right"), [F.min_by(c, order) for c in ("c0", "c1", "c2")]
    return strips.groupBy(*by).agg(
        *(F.coalesce(v[i].cast("int"), h[i].cast("int"), any_[i].cast("int"), F.lit(255)).alias(f"c{i}") for i in range(3)),
        F.when(v[0].isNotNull(), "vertical").when(h[0].isNotNull(), "horizontal").otherwise("fallback").alias("origin"),
    )


#: Pixels of a tile in each direction.
TILE = 256
#: Where a pixel looks for its neighbours in other tiles; the other four directions look back.
AHEAD = ((0, 1), (1, 0), (1, 1), (1, -1))


def _tile_parts(tile: int, keys: Sequence[str]):
    """The components of each tile: box, area, first pixel (as y << 31 | x), and those of its pixels that touch other tiles."""
    import numpy as np
    import pyarrow as pa

    from quire.operators.pages import label

    def run(batches):
        for b in batches:
            out = []
            tiles = list(zip(b.column("ty").to_pylist(), b.column("tx").to_pylist(), strict=True))
            for i, pts in enumerate(b.column("pts")):
                ys, xs = (np.asarray(pts.values.field(c)) - t * tile for c, t in zip("yx", tiles[i], strict=True))
                top, left = tiles[i][0] * tile, tiles[i][1] * tile
                mask = np.zeros((ys.max() + 1, xs.max() + 1), bool)
                mask[ys, xs] = True
                lab, n = label(mask)
                y, x = np.nonzero(lab)
                of = lab[y, x] - 1
                low_y, low_x, high_y, high_x = (np.full(n, v) for v in (tile, tile, -1, -1))
                np.minimum.at(low_y, of, y), np.minimum.at(low_x, of, x), np.maximum.at(high_y, of, y), np.maximum.at(high_x, of, x)
                first = np.full(n, np.iinfo(np.int64).max)
                np.minimum.at(first, of, (y + top) << 31 | (x + left))
                area = np.bincount(of, minlength=n)
                seen, asked = ([[] for _ in range(n)] for _ in range(2))
                for k in np.flatnonzero((y == 0) | (x == 0) | (x == tile - 1) | (y == tile - 1)).tolist():
                    py, px_, c = int(y[k]), int(x[k]), int(of[k])
                    if (py == 0 and top) or (px_ == 0 and left) or px_ == tile - 1:
                        seen[c].append({"y": py + top, "x": px_ + left})
                    for dy, dx in AHEAD:
                        if py + dy == tile or not 0 <= px_ + dx < tile:
                            asked[c].append({"y": py + top + dy, "x": px_ + left + dx})
                rows = zip(low_x + left, low_y + top, high_x + left, high_y + top, area, first, seen, asked, strict=True)
                out += [(i, c + 1, *map(int, r[:6]), *r[6:]) for c, r in enumerate(rows)]
            own = b.take(pa.array([r[0] for r in out], pa.int32())).select([*keys, "ty", "tx"])
            spots = pa.list_(pa.struct([("y", pa.int32()), ("x", pa.int32())]))
            kinds = [*[pa.int32()] * 6, pa.int64(), spots, spots]
            yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array([r[k + 1] for r in out], t) for k, t in enumerate(kinds))], names=[*own.schema.names, *PART])

    return run


#: Columns of a part of a component.
PART = ("label", "x0", "y0", "x1", "y1", "area", "first", "seen", "asked")


def components(px: DataFrame, fg: str = "fg", by: Sequence[str] = ("img",), tile: int = TILE) -> DataFrame:
    """8-connected components of the pixels that are 1: by, label (from 1, by first pixel in reading order), x0, y0, x1, y1, area.

    Images are labelled tile by tile, as a task holds a tile only; pixels at a tile's edge meet their neighbours in the
    next one by an equality join, and labels that touch become one in component rounds.  Where no image is larger than
    a tile nothing of that is needed.
    """
    on = px.where(F.col(fg) == 1).select(*by, "y", "x")
    high = on.agg(F.max(F.greatest("y", "x"))).first()[0]
    tiles = on.groupBy(*by, F.expr(f"cast(y div {tile} as int)").alias("ty"), F.expr(f"cast(x div {tile} as int)").alias("tx")).agg(F.collect_list(F.struct("y", "x")).alias("pts"))
    spot = "array<struct<y:int,x:int>>"
    ddl = ", ".join(f"{c} {k}" for c, k in zip(PART, (*["int"] * 6, "long", spot, spot), strict=True))
    parts = tiles.mapInArrow(_tile_parts(tile, by), T.StructType([*(tiles.schema[c] for c in (*by, "ty", "tx")), *T._parse_datatype_string(ddl)]))
    shape = [*by, "label", "x0", "y0", "x1", "y1", "area"]
    if high is None or high < tile:
        return parts.select(*shape)
    node = F.struct("ty", "tx", "label")
    parts = kept(parts.withColumn("node", node), "parts")
    asked = parts.select(*by, F.col("node").alias("u"), F.explode("asked").alias("at"))
    edges = asked.join(parts.select(*by, F.col("node").alias("v"), F.explode("seen").alias("at")), [*by, "at"]).select(*by, "u", "v")
    roots = connected(edges, by)
    whole = parts.join(roots, [*by, "node"], "left").groupBy(*by, F.coalesce("root", "node").alias("root")).agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.sum("area").cast("int").alias("area"), F.min("first").alias("first"), F.lit(1).alias("one")
    )
    return running(whole, "one", "first", "label", by).withColumn("label", (F.col("label") + 1).cast("int")).select(*shape)


def outside_l1(px: DataFrame, boxes: DataFrame, a: str, b: str, by: Sequence[str] = ("img",)) -> DataFrame:
    """Mean absolute difference, as a share of 255, of the pixels that no box of their image covers."""
    few = boxes.groupBy(*by).agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("__b"))
    inside = F.exists(F.coalesce("__b", F.array().cast(few.schema["__b"].dataType)), lambda r: (F.col("x") >= r["x0"]) & (F.col("x") < r["x1"]) & (F.col("y") >= r["y0"]) & (F.col("y") < r["y1"]))
    return px.join(few, list(by), "left").where(~inside).groupBy(*by).agg((F.avg(F.abs(F.col(a) - F.col(b))) / 255).alias("l1"), F.count("*").alias("n"))
