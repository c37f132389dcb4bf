"""Page rasters in numpy: one group for each page, its boxes in order, as later boxes see earlier erasures."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np

Box = tuple[int, int, int, int]


def gray_of(image: np.ndarray) -> np.ndarray:
    if image.ndim == 2:
        return image
    return np.floor(image @ np.array([0.299, 0.587, 0.114]) + 0.5).astype(np.uint8)


def otsu(gray: np.ndarray) -> int:
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    w0, s0 = np.cumsum(n), np.cumsum(n * np.arange(256))
    w1 = w0[-1] - w0
    with np.errstate(divide="ignore", invalid="ignore"):
        d = s0 / w0 - (s0[-1] - s0) / w1
        sigma = np.nan_to_num(w0 * w1 * d * d)
    return int(np.argmax(np.where(n > 0, np.round(sigma, 6), -1)))


def _slide(a: np.ndarray, axis: int, half: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over a frame of 2 * half + 1 cells that ends at the border; log2 passes."""
    a = np.moveaxis(a, axis, -1)
    n = a.shape[-1]
    half = min(half, n - 1)
    edge = [(0, 0)] * (a.ndim - 1) + [(half, half)]
    fill = 255 if pick is np.minimum else 0
    p = np.pad(a, edge, constant_values=fill)
    size, have = 2 * half + 1, 1
    while have * 2 <= size:
        p = pick(p[..., :-have], p[..., have:])
        have *= 2
    if rest := size - have:
        p = pick(p[..., :-rest], p[..., rest:])
    return np.moveaxis(p, -1, axis)


def erode(a: np.ndarray, axis: int, half: int) -> np.ndarray:
    return _slide(a, axis, half, np.minimum)


def dilate(a: np.ndarray, axis: int, half: int) -> np.ndarray:
    return _slide(a, axis, half, np.maximum)


def opened(a: np.ndarray, axis: int, half: int) -> np.ndarray:
    return dilate(erode(a, axis, half), axis, half)


def closed(a: np.ndarray, axis: int, half: int) -> np.ndarray:
    return erode(dilate(a, axis, half), axis, half)


def label(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected components: runs of each row, joined to touching runs of the row above."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    ys, a = np.nonzero(edge == 1)
    b = np.nonzero(edge == -1)[1]
    parent = list(range(len(ys)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    rows = np.searchsorted(ys, np.arange(h + 1)).tolist()
    al, bl = a.tolist(), b.tolist()
    for y in range(1, h):
        i, j = rows[y - 1], rows[y]
        while i < rows[y] and j < rows[y + 1]:
            if al[i] <= bl[j] and al[j] <= bl[i]:
                x, z = find(i), find(j)
                parent[max(x, z)] = min(x, z)
            if bl[i] < bl[j]:
                i += 1
            else:
                j += 1
    out, names = np.zeros((h, w), np.int32), {}
    for i, y in enumerate(ys.tolist()):
        out[y, al[i] : bl[i]] = names.setdefault(find(i), len(names) + 1)
    return out, len(names)


def count_components(mask: np.ndarray) -> int:
    return label(mask > 0)[1]


@dataclass
class Line:
    """A row of dots: sorted places, spacing, size."""

    xs: np.ndarray
    ys: np.ndarray
    spacing: float
    labels: list[int]

    def fit(self) -> tuple[float, float]:
        if len(self.xs) < 2 or self.xs[-1] - self.xs[0] < 1:
            return 0.0, float(self.ys.mean())
        slope, intercept = np.polyfit(self.xs, self.ys, 1)
        return float(slope), float(intercept)


# The default knobs of dotted_lines, classify, background, redact and touch_up, and the words of their reasons,
# notes and strategies.


def dotted_lines(fg: np.ndarray, max_dot: int = 6, y_tolerance: float = 2, min_dots: int = 4, max_cv: float = 0.3, min_width: float = 20, tolerant: bool = False) -> tuple[np.ndarray, list[Line], list[str]]:
    """(labels, lines, reasons of rejected bands)"""
    lab, n = label(fg > 0)
    if not n:
        return lab, [], []
    y, x = np.nonzero(lab)
    k = lab[y, x]
    area = np.bincount(k, minlength=n + 1)[1:]
    cx, cy = (np.bincount(k, v, n + 1)[1:] / area for v in (x, y))
    low = np.full((2, n + 1), 1 << 30)
    high = np.full((2, n + 1), -1)
    for i, v in enumerate((x, y)):
        np.minimum.at(low[i], k, v)
        np.maximum.at(high[i], k, v)
    extent = (high - low + 1)[:, 1:]
    small = np.flatnonzero((extent <= max_dot).all(0))
    if len(small) < min_dots:
        return lab, [], []
    small = small[np.argsort(cy[small], kind="stable")]
    groups: list[list[int]] = []
    for i in small.tolist():  # a band is anchored to its first member
        if groups and cy[i] - cy[groups[-1][0]] <= y_tolerance:
            groups[-1].append(i)
        else:
            groups.append([i])
    lines, reasons = [], []
    for g in groups:
        g = sorted(g, key=lambda i: cx[i])
        xs, ys = cx[g], cy[g]
        gaps = np.diff(xs)
        if len(g) < min_dots:
            reasons.append(f"too_few_dots:{len(g)}<{min_dots}")
            continue
        if xs[-1] - xs[0] < min_width:
            reasons.append(f"too_narrow:{int(xs[-1] - xs[0])}px<{min_width:g}")
            continue
        if tolerant:
            gaps = gaps[gaps <= max(1.5 * np.median(gaps), 1.0)]
            if len(gaps) < 2:
                reasons.append("insufficient_normal_spacings")
                continue
        mean = gaps.mean()
        if mean <= 0:
            continue
        if gaps.std() / mean > max_cv:
            reasons.append(f"spacing_irregular:cv={gaps.std() / mean:.2f}>{max_cv}")
            continue
        lines.append(Line(xs, ys, float(mean), [i + 1 for i in g]))
    return lab, lines, reasons


@dataclass
class Masks:
    foreground: np.ndarray
    h_rules: np.ndarray
    v_rules: np.ndarray
    text: np.ndarray


def classify(image: np.ndarray, box_height: int, h_frac: float = 1.5, h_least: int = 11, v_frac: float = 0.9, v_least: int = 15, tophat: int = 15, tophat_over: int = 20, grow: int = 1, bridge: int = 0, dotted: bool = False) -> Masks:
    """Which pixels of a window are rules, dividers or dotted lines, and which are text."""
    gray = gray_of(image)
    if not gray.size:
        z = np.zeros(gray.shape, bool)
        return Masks(z, z, z, z)
    fg = gray <= otsu(gray) if gray.min() < gray.max() else np.zeros(gray.shape, bool)
    f = fg.astype(np.uint8)
    kh, kv = max(h_least, round(h_frac * box_height)) | 1, max(v_least, round(v_frac * box_height)) | 1
    joined = closed(f, 1, (bridge | 1) // 2) if bridge else f
    h = opened(joined, 1, kh // 2) if gray.shape[1] >= kh else np.zeros_like(f)
    hat = (closed(gray, 1, tophat // 2).astype(int) - gray > tophat_over).astype(np.uint8)
    v = opened(np.maximum(hat, f), 0, kv // 2) if gray.shape[0] >= kv else np.zeros_like(f)
    rules = (h > 0) | (v > 0)
    if dotted:
        lab, lines, _ = dotted_lines(fg)
        rules |= np.isin(lab, [i for line in lines for i in line.labels])
    text = dilate(dilate((fg & ~rules).astype(np.uint8), 0, grow), 1, grow) > 0
    return Masks(fg, h > 0, v > 0, text & ~rules)


def background(image: np.ndarray, box: Box, width: int = 6, offset: int = 2, ink: int = 90) -> tuple[np.ndarray, str]:
    h, w = image.shape[:2]
    x0, x1 = (min(max(v, 0), w) for v in (box[0], box[2]))
    y0, y1 = (min(max(v, 0), h) for v in (box[1], box[3]))
    up, down = max(0, y0 - offset), min(h, y1 + offset)
    left, right = max(0, x0 - offset), min(w, x1 + offset)
    strips = [
        _strip(image[max(0, up - width) : up, x0:x1]), _strip(image[down : min(h, down + width), x0:x1]),
        _strip(image[y0:y1, max(0, left - width) : left]), _strip(image[y0:y1, right : min(w, right + width)]),
    ]
    for name, pair in (("vertical", strips[:2]), ("horizontal", strips[2:])):
        clean = [c for c in pair if c is not None and c.min() >= ink]
        if clean:
            return np.median(clean, axis=0).astype(int), name
    return next((c for c in strips if c is not None), np.array([255, 255, 255])), "fallback"


def _strip(strip: np.ndarray) -> np.ndarray | None:
    if not strip.size:
        return None
    along = 1 if strip.shape[1] >= strip.shape[0] else 0
    mid = np.median(strip, axis=along)
    return mid[np.argmax(mid.mean(axis=1))].astype(int)


def redact(image: np.ndarray, box: Box, **knobs) -> dict:
    """Overwrite the text inside a box with what lies behind it; the image changes in place."""
    h, w = image.shape[:2]
    x0, y0, x1, y1 = max(0, box[0]), max(0, box[1]), min(w, box[2]), min(h, box[3])
    none = {"text_pixels": 0, "bg_color": [255, 255, 255], "text_components": 0, "strategy": "noop_no_text"}
    if x1 <= x0 or y1 <= y0:
        return none
    dx, dy = max(10, round((x1 - x0) * 0.5)), max(10, round((y1 - y0) * 0.5))
    wx, wy = max(0, x0 - dx), max(0, y0 - dy)
    masks = classify(image[wy : min(h, y1 + dy), wx : min(w, x1 + dx)], y1 - y0, **knobs)
    text = masks.text[y0 - wy : y1 - wy, x0 - wx : x1 - wx]
    if not text.any():
        return none
    color, _ = background(image, (x0, y0, x1, y1))
    image[y0:y1, x0:x1][text] = color
    return {"text_pixels": int(text.sum()), "bg_color": [int(c) for c in color], "text_components": count_components(text), "strategy": "fill"}


def whiten(image: np.ndarray, boxes: Sequence[Box], pad: int = 0) -> int:
    """Paint boxes white; how many were drawn."""
    h, w = image.shape[:2]
    n = 0
    for x0, y0, x1, y1 in boxes:
        a, b, c, d = max(0, x0 - pad), max(0, y0 - pad), min(w, x1 + pad), min(h, y1 + pad)
        if c > a and d > b:
            image[b:d, a:c] = 255
            n += 1
    return n


@dataclass
class TouchUp:
    dots: int = 0
    clusters: int = 0
    gaps: int = 0
    notes: list[str] = field(default_factory=list)


def touch_up(image: np.ndarray, erased: Sequence[Box], max_dot: int = 8, least_lines: int = 5) -> TouchUp:
    """Clone surviving dots into the gaps that erasure tore into dotted lines, only inside erased boxes."""
    out = TouchUp()
    if not image.size or not erased:
        return out
    gray = gray_of(image)
    _, lines, _ = dotted_lines(gray <= otsu(gray), max_dot, 3, 3, 0.4, 10, tolerant=True)
    out.clusters = len(lines)
    if len(lines) < least_lines:
        out.notes.append(f"below_dotted_threshold:{len(lines)}<{least_lines}")
        return out
    half, outside, notes = max_dot // 2 + 1, 0, {}
    for line in lines:
        slope, intercept = line.fit()
        for a, b in zip(line.xs, line.xs[1:], strict=False):
            if b - a <= 1.3 * line.spacing:
                continue
            n = max(1, round((b - a) / line.spacing) - 1)
            out.gaps += 1
            for x in (a + (b - a) * np.arange(1, n + 1) / (n + 1)).tolist():
                y = slope * x + intercept
                if not any(x0 <= x <= x1 and y0 <= y <= y1 for x0, y0, x1, y1 in erased):
                    outside += 1
                    continue
                k = int(np.argmin(np.abs(line.xs - x)))
                out.dots += _clone(image, round(line.xs[k]), round(line.ys[k]), round(x), round(y), half)
        yc = line.ys.mean()
        for x0, y0, x1, y1 in erased:
            if y0 - 2 <= yc <= y1 + 2:
                if x1 > line.xs[-1] + 1.5 * line.spacing:
                    notes["single_sided:no_right_anchor"] = None
                if x0 < line.xs[0] - 1.5 * line.spacing:
                    notes["single_sided:no_left_anchor"] = None
    out.notes = [*notes, *([f"outside_erased_region:{outside}"] if outside else [])]
    return out


def _clone(image: np.ndarray, sx: int, sy: int, tx: int, ty: int, half: int) -> int:
    """Copy the ink of the dot at (sx, sy) to (tx, ty); 1 if there was any."""
    h, w = image.shape[:2]
    y0, x0 = max(0, sy - half), max(0, sx - half)
    patch = image[y0 : sy + half + 1, x0 : sx + half + 1].copy()
    gray = gray_of(patch)
    lab, n = label(gray <= otsu(gray))
    if not n:
        return 0
    at = lab[sy - y0, sx - x0]
    py, px = np.nonzero(lab == at if at else lab > 0)
    gy, gx = ty + py - (sy - y0), tx + px - (sx - x0)
    ok = (gy >= 0) & (gy < h) & (gx >= 0) & (gx < w)
    image[gy[ok], gx[ok]] = patch[py[ok], px[ok]]
    return 1


def overlay(image: np.ndarray, masks: Sequence[tuple[np.ndarray, tuple[int, int, int]]], alpha: float = 0.55) -> np.ndarray:
    """Colours blended over a copy, later masks on top."""
    out = image.astype(float)
    for mask, color in masks:
        out[mask] = (1 - alpha) * out[mask] + alpha * np.array(color)
    return np.round(out).astype(np.uint8)


#: Colours of the overlays.
COLORS = {"text": (255, 0, 0), "h_rule": (0, 200, 0), "v_rule": (0, 80, 255), "box": (255, 215, 0), "gap": (230, 0, 0), "line": (0, 180, 0), "erased": (0, 180, 200)}


def outline(image: np.ndarray, box: Box, color: tuple[int, int, int], width: int = 2) -> None:
    """A frame along the inside of a box; the image changes in place."""
    h, w = image.shape[:2]
    x0, y0, x1, y1 = max(0, box[0]), max(0, box[1]), min(w, box[2]), min(h, box[3])
    if x1 <= x0 or y1 <= y0:
        return
    view = image[y0:y1, x0:x1]
    view[:width] = view[-width:] = color
    view[:, :width] = view[:, -width:] = color


def overlay_classes(image: np.ndarray, boxes: Sequence[Box], alpha: float = 0.55, **knobs) -> np.ndarray:
    """A copy on which every box's window shows its rules, dividers and text in colour, and the box its frame."""
    out = image.copy()
    h, w = image.shape[:2]
    for x0, y0, x1, y1 in boxes:
        dx, dy = max(10, round((x1 - x0) * 0.5)), max(10, round((y1 - y0) * 0.5))
        wx0, wy0, wx1, wy1 = max(0, x0 - dx), max(0, y0 - dy), min(w, x1 + dx), min(h, y1 + dy)
        if wx1 > wx0 and wy1 > wy0:
            m = classify(image[wy0:wy1, wx0:wx1], y1 - y0, **knobs)
            out[wy0:wy1, wx0:wx1] = overlay(out[wy0:wy1, wx0:wx1], [(m.v_rules, COLORS["v_rule"]), (m.h_rules, COLORS["h_rule"]), (m.text, COLORS["text"])], alpha)
    for box in boxes:
        outline(out, box, COLORS["box"])
    return out


def overlay_touch_up(image: np.ndarray, erased: Sequence[Box], max_dot: int = 8) -> np.ndarray:
    """A copy with the erased boxes framed, the dotted lines found along their fit and the gaps in them."""
    out = image.copy()
    for box in erased:
        outline(out, box, COLORS["erased"], 1)
    gray = gray_of(image)
    _, found, _ = dotted_lines(gray <= otsu(gray), max_dot, 3, 3, 0.4, 10, tolerant=True)
    h, w = image.shape[:2]
    for line in found:
        slope, intercept = line.fit()
        spans = [(line.xs[0], line.xs[-1], COLORS["line"])]
        spans += [(a, b, COLORS["gap"]) for a, b in zip(line.xs, line.xs[1:], strict=False) if b - a > 1.3 * line.spacing]
        for a, b, color in spans:
            x = np.arange(max(0, int(a)), min(w, int(b) + 1))
            y = np.clip(np.round(slope * x + intercept).astype(int), 0, h - 1)
            out[y, x] = color
    return out


def side_by_side(a: np.ndarray, b: np.ndarray, height: int = 1000, gap: int = 20, bar: int = 30) -> np.ndarray:
    """Two pages scaled to one height beside each other on white, below a bar."""

    def scaled(image: np.ndarray) -> np.ndarray:
        h, w = image.shape[:2]
        ys = np.minimum((np.arange(height) * h) // height, h - 1)
        width = max(1, w * height // h)
        return image[ys][:, np.minimum((np.arange(width) * w) // width, w - 1)]

    left, right = scaled(a), scaled(b)
    out = np.full((height + bar, left.shape[1] + gap + right.shape[1], 3), 255, np.uint8)
    out[bar:, : left.shape[1]] = left
    out[bar:, left.shape[1] + gap :] = right
    return out


def overlay_rows(pages, fields, touch: bool = False, knobs: dict | None = None):
    """doc_id (with its page), data: a PNG of each page of blank_pages() input with what was decided on it."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from quire.sources.sinks import png

    knobs = knobs or {}
    boxes = fields.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("pos", "x0", "y0", "x1", "y1"))).alias("boxes"))
    rows = pages.join(boxes, ["doc_id", "page"], "left").select(F.format_string("%s_p%03d", "doc_id", "page").alias("doc_id"), "h", "w", "data", "boxes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                try:
                    image = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], 3)
                    at = [(f["x0"], f["y0"], f["x1"], f["y1"]) for f in r["boxes"] or []]
                    data = png(overlay_touch_up(image, at) if touch else overlay_classes(image, at, **knobs))
                except (ValueError, TypeError):  # a broken page has no picture
                    data = None
                yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"]], pa.string()), pa.array([data], pa.binary())], names=["doc_id", "data"])

    return rows.mapInArrow(run, "doc_id string, data binary")


def degrade(image: np.ndarray, blur: int = 0, salt: float = 0.0, open_: tuple[int, int] = (1, 1), close: tuple[int, int] = (1, 1), bleed: float = 0.0, seed: int = 0) -> np.ndarray:
    """Scanner wear: box blur, salt and pepper, opening or closing with a kernel of so many rows and columns, the mirrored page shining through."""
    out = image.astype(float)
    for axis in (0, 1) if blur else ():
        p = np.pad(out, [(blur, blur) if a == axis else (0, 0) for a in range(out.ndim)], mode="edge")
        n = out.shape[axis]
        out = sum(np.take(p, range(k, k + n), axis) for k in range(2 * blur + 1)) / (2 * blur + 1)
    if bleed:
        out = np.minimum(out, 255 - (255 - out[:, ::-1]) * (1 - bleed))
    rng = np.random.default_rng(seed)
    if salt:
        noise = rng.random(out.shape[:2])
        out[noise < salt / 2] = 0
        out[noise > 1 - salt / 2] = 255
    out = np.round(out).astype(np.uint8)
    for kernel, first, then in ((open_, erode, dilate), (close, dilate, erode)):
        for step in (first, then):
            for axis, n in enumerate(kernel):
                out = step(out, axis, n // 2) if n > 1 else out
    return out


#: Wear by profile.
DEGRADATIONS = {"light": {"blur": 1, "salt": 0.002}, "medium": {"blur": 2, "salt": 0.005, "open_": (3, 3)}, "heavy": {"blur": 3, "bleed": 0.8, "salt": 0.01, "close": (9, 1)}}


def blank_pages(pages, fields, knobs: dict | None = None, touch: bool = False, least_lines: int = 5):
    """Redact every page's boxes in order; a row for each page with its new pixels and statistics.

    pages: doc_id, page, h, w, data (RGB bytes); fields: doc_id, page, pos, field_id, x0, y0, x1, y1.
    A page and its boxes form one group; nothing larger is ever gathered.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F

    knobs = knobs or {}
    boxes = fields.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("pos", "field_id", "x0", "y0", "x1", "y1"))).alias("boxes"))
    rows = pages.join(boxes, ["doc_id", "page"], "left").select("doc_id", "page", "h", "w", "data", "boxes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                out = {"doc_id": r["doc_id"], "page": r["page"], "status": "ok", "error": None, "redacted": 0, "dots": 0, "clusters": 0, "gaps": 0, "notes": [], "stats": [], "data": r["data"]}
                try:
                    image = np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], 3).copy()
                    erased = []
                    for f in r["boxes"] or []:
                        box = (f["x0"], f["y0"], f["x1"], f["y1"])
                        s = redact(image, box, **knobs)
                        out["stats"].append({"field_id": f["field_id"], "text_pixels": s["text_pixels"], "text_components": s["text_components"], "bg_color": s["bg_color"], "strategy": s["strategy"]})
                        erased.append(box)
                    out["redacted"] = len(erased)
                    if touch:
                        t = touch_up(image, erased, least_lines=least_lines)
                        out |= {"dots": t.dots, "clusters": t.clusters, "gaps": t.gaps, "notes": t.notes}
                    out["data"] = image.tobytes()
                except (ValueError, IndexError) as e:  # a broken page is a row, not a failed job
                    out |= {"status": "error", "error": f"{type(e).__name__}: {e}"}
                yield pa.RecordBatch.from_pylist([out], schema=arrow)

    stat = pa.struct([("field_id", pa.string()), ("text_pixels", pa.int64()), ("text_components", pa.int64()), ("bg_color", pa.list_(pa.int64())), ("strategy", pa.string())])
    arrow = pa.schema(
        [("doc_id", pa.string()), ("page", pa.int32()), ("status", pa.string()), ("error", pa.string()), *((c, pa.int64()) for c in ("redacted", "dots", "clusters", "gaps")), ("notes", pa.list_(pa.string())), ("stats", pa.list_(stat)), ("data", pa.binary())]
    )
    ddl = "doc_id string, page int, status string, error string, redacted long, dots long, clusters long, gaps long, notes array<string>, stats array<struct<field_id:string,text_pixels:long,text_components:long,bg_color:array<long>,strategy:string>>, data binary"
    return rows.mapInArrow(run, ddl)


def run_totals(pages):
    """A row for each document: sums over its pages, notes once each in order of first sight."""
    from pyspark.sql import functions as F

    notes = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "notes"))), lambda x: x["notes"])))
    return pages.groupBy("doc_id").agg(
        F.count("*").alias("pages"), *(F.sum(c).alias(n) for c, n in (("redacted", "redacted"), ("dots", "touch_up_dots"), ("clusters", "touch_up_clusters"), ("gaps", "touch_up_gaps"))), notes.alias("touch_up_notes")
    )
