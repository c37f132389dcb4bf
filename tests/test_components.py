"""Images cut into tiles against a flood fill."""

import numpy as np
import pytest

from quire.operators import graph, raster


def fill(mask):
    out, seen = [], np.zeros_like(mask)
    for y, x in zip(*map(list, np.nonzero(mask)), strict=True):
        if seen[y, x]:
            continue
        stack, spots = [(y, x)], []
        seen[y, x] = True
        while stack:
            a, b = stack.pop()
            spots.append((a, b))
            for c in range(max(a - 1, 0), min(a + 2, mask.shape[0])):
                for d in range(max(b - 1, 0), min(b + 2, mask.shape[1])):
                    if mask[c, d] and not seen[c, d]:
                        seen[c, d] = True
                        stack.append((c, d))
        ys, xs = zip(*spots, strict=True)
        out.append((min(xs), min(ys), max(xs), max(ys), len(spots)))
    return [(i + 1, *map(int, c)) for i, c in enumerate(out)]


def masks():
    rng = np.random.default_rng(3)
    spiral = np.zeros((41, 37), bool)
    y = x = d = 0
    for _ in range(600):
        spiral[y, x] = True
        dy, dx = ((0, 1), (1, 0), (0, -1), (-1, 0))[d % 4]
        a, b = y + dy, x + dx
        if not (0 <= a < 41 and 0 <= b < 37) or (0 <= a + dy < 41 and 0 <= b + dx < 37 and spiral[a + dy, b + dx]):
            d += 1
            continue
        y, x = a, b
    return {"spiral": spiral, "full": np.ones((20, 33), bool), "noise": rng.random((40, 40)) < 0.45, "few": rng.random((30, 50)) < 0.1, "dot": np.eye(1, dtype=bool), None: np.eye(30, dtype=bool)[::-1]}


@pytest.mark.parametrize("tile", [5, 16, 1000])
def test_components_equal_a_flood_fill(spark, tile):
    every = masks()
    rows = [(k, int(y), int(x), int(v)) for k, m in every.items() for (y, x), v in np.ndenumerate(m) if v or (y + x) % 5 == 0]
    if tile < 1000:
        rows = [r for r in rows if r[0] is not None]  # images have names
        every.pop(None)
    px = spark.createDataFrame(rows, "img string, y int, x int, fg int").repartition(4)
    got = {}
    for r in raster.components(px, tile=tile).collect():
        got.setdefault(r.img, []).append((r.label, r.x0, r.y0, r.x1, r.y1, r.area))
    assert {k: sorted(v) for k, v in got.items()} == {k: fill(m) for k, m in every.items()}
    assert raster.components(px.where("fg = 0"), tile=tile).count() == 0


def test_components_of_a_graph(spark):
    edges = [(1, i, i + 1) for i in range(60)] + [(1, 100, i) for i in range(101, 140)] + [(2, 5, 5), (2, 7, 3), (2, 3, 9)]
    df = spark.createDataFrame(edges, "g int, u int, v int").repartition(3)
    got = {(r.g, r.node): r.root for r in graph.components(df, ["g"]).collect()}
    assert got == {(1, i): 0 for i in range(61)} | {(1, i): 100 for i in range(100, 140)} | {(2, i): 3 for i in (3, 7, 9)}
    assert graph.components(df.where("false"), ["g"]).count() == 0
