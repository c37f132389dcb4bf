"""Boxes: normalised arrays [x0, y0, x1, y1], pixel structs, and the five notions of a valid box."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pixels added left, top, right and bottom, by source.
PADDING = {"funsd": (40, 5, 5, 5), "xfund_de": (30, 5, 5, 5), "xfund_fr": (30, 5, 5, 5)}
DEFAULT_PADDING = (5, 5, 5, 5)


def clamp(v: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), v))


def normalise(bbox: Column, width: Column, height: Column) -> Column:
    """Pixel box to the unit square; anything but four numbers becomes the zero box."""
    zero = F.array(*[F.lit(0.0)] * 4)
    return F.when(F.size(bbox) == 4, F.transform(bbox, lambda v, i: clamp(v / F.when(i % 2 == 0, width).otherwise(height)))).otherwise(zero)


def padding(source: Column) -> Column:
    expr = None
    for name, pad in PADDING.items():
        p = F.array(*map(F.lit, pad))
        expr = F.when(source == name, p) if expr is None else expr.when(source == name, p)
    return expr.otherwise(F.array(*map(F.lit, DEFAULT_PADDING)))


def to_pixels(bbox: Column, width: Column, height: Column, pad: Column) -> Column:
    """Truncate to pixels, pad, clip to the image."""
    at = lambda i, size: (F.get(bbox, F.lit(i)) * size).cast("int")
    return F.struct(
        F.greatest(F.lit(0), at(0, width) - pad[0]).alias("x0"),
        F.greatest(F.lit(0), at(1, height) - pad[1]).alias("y0"),
        F.least(width, at(2, width) + pad[2]).alias("x1"),
        F.least(height, at(3, height) + pad[3]).alias("y1"),
    )


def to_page(bbox: Column, width: Column, height: Column, pad: float = 0.0) -> Column:
    """Normalised box to page points, grown by pad on all sides."""
    return F.struct(
        (F.get(bbox, F.lit(0)) * width - pad).alias("x0"), (F.get(bbox, F.lit(1)) * height - pad).alias("y0"), (F.get(bbox, F.lit(2)) * width + pad).alias("x1"), (F.get(bbox, F.lit(3)) * height + pad).alias("y1")
    )


def flip_y(bbox: Column) -> Column:
    """Between bottom-left and top-left origin."""
    return F.array(F.get(bbox, F.lit(0)), 1 - F.get(bbox, F.lit(3)), F.get(bbox, F.lit(2)), 1 - F.get(bbox, F.lit(1)))


def window(box: Column, width: Column, height: Column, grow: float = 0.5, least: int = 10) -> Column:
    """The search window round a pixel box: half its size more on each side, ten pixels at least, clipped."""
    dx = F.greatest(F.lit(least), F.bround((box["x1"] - box["x0"]) * F.lit(grow)).cast("int"))
    dy = F.greatest(F.lit(least), F.bround((box["y1"] - box["y0"]) * F.lit(grow)).cast("int"))
    return F.struct(
        F.greatest(F.lit(0), box["x0"] - dx).alias("x0"), F.greatest(F.lit(0), box["y0"] - dy).alias("y0"),
        F.least(width, box["x1"] + dx).alias("x1"), F.least(height, box["y1"] + dy).alias("y1"),
    )


def odd(n: Column) -> Column:
    return n + 1 - n % 2


def kernel_size(height: Column, factor: float, least: int) -> Column:
    """An odd kernel of so many box heights."""
    return odd(F.greatest(F.lit(least), F.bround(height * F.lit(factor)).cast("int")))


def extents(b: Column, least: float = 0.0) -> Column:
    return (F.size(b) == 4) & (F.get(b, F.lit(2)) - F.get(b, F.lit(0)) > least) & (F.get(b, F.lit(3)) - F.get(b, F.lit(1)) > least)


def redactable(f: Column) -> Column:
    """An answer with a value and a box that is neither zero nor empty."""
    b = f["bbox_norm"]
    return (f["role"] == "answer") & (F.length(f["value"]) > 0) & extents(b) & F.exists(b, lambda v: v != 0)


def previewable(f: Column) -> Column:
    return redactable(f) & f["page"].isNotNull()


def imageable(f: Column) -> Column:
    """For the image lane the value may be empty."""
    return (f["role"] == "answer") & extents(f["bbox_norm"])


def legacy_valid(b: Column) -> Column:
    return extents(b, 0.001)


def in_unit_square(b: Column) -> Column:
    return extents(b) & (F.get(b, F.lit(0)) >= 0) & (F.get(b, F.lit(1)) >= 0) & (F.get(b, F.lit(2)) <= 1) & (F.get(b, F.lit(3)) <= 1)


def skip_reason(f: Column, page_count: Column) -> Column:
    """Why a field can not be redacted; null if it can."""
    return F.when(~redactable(f), "no-bbox-or-empty-value").when(~f["page"].between(0, page_count - 1), "page-out-of-range")


def contains(box: Column, x: Column, y: Column) -> Column:
    """Edges included."""
    return (x >= box["x0"]) & (x <= box["x1"]) & (y >= box["y0"]) & (y <= box["y1"])
