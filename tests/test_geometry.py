"""Boxes and points, clusters and boxes, against trying every pair."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import layout

INF = float("inf")


def test_points_in_boxes_of_any_size(spark):
    rng = random.Random(4)
    pts = [(i, rng.choice([rng.uniform(-300, 900), float(rng.randrange(-40, 90)), 8.0 * rng.randrange(9)]), rng.choice([rng.uniform(-50, 50), float(rng.randrange(60))])) for i in range(1500)]
    pts += [(2000, None, 1.0), (2001, 1.0, None), (2002, INF, 0.0), (2003, float("nan"), 0.0), (2004, 8.0, 8.0), (2004, 8.0, 8.0)]
    boxes = []
    for size in (0.0, 1.0, 7.9, 8.0, 40.0, 500.0):
        for _ in range(6):
            x, y = rng.uniform(-200, 300), rng.uniform(-30, 40)
            boxes.append((x, y, x + size, y + rng.choice([0.5, size])))
    boxes += [(8.0, 8.0, 16.0, 16.0), (5.0, 5.0, 1.0, 9.0), (None, 0.0, 1.0, 1.0)]
    p = spark.createDataFrame(pts, "id int, x double, y double").repartition(3)
    for some in (boxes, boxes[:6], [*boxes[:9], (-INF, 30.0, INF, 31.0)], [(-INF, -INF, INF, INF)], []):
        b = spark.createDataFrame(some, "x0 double, y0 double, x1 double, y1 double")
        got = sorted(r.id for r in layout.points_in_shared_boxes(p, b).collect())
        good = [(i, x, y) for i, x, y in pts if i not in (2000, 2001, 2002, 2003)]
        assert got == sorted(i for i, x, y in good if any(None not in c and c[0] <= x <= c[2] and c[1] <= y <= c[3] for c in some))


def test_a_box_over_the_whole_plane_makes_few_rows(spark, monkeypatch):
    made = []
    explain = type(spark.range(1)).join

    def join(self, other, *a, **k):
        made.append(other.count())
        return explain(self, other, *a, **k)

    monkeypatch.setattr(type(spark.range(1)), "join", join)
    p = spark.range(1000).selectExpr("id", "double(id * 1000) as x", "double(id % 77) as y")
    b = spark.createDataFrame([(-1e9, -1e9, 1e9, 1e9)], "x0 double, y0 double, x1 double, y1 double")
    assert layout.points_in_shared_boxes(p, b).count() == 1000 and max(made) <= layout.SALTS * (2 * layout.SPREAD + 1) ** 2


@pytest.mark.parametrize("how", [{}, {"hot": 100}, {"cuts": 7}])
def test_single_sided_notes_equal_all_pairs(spark, how):
    rng = random.Random(5)
    clusters = [(g, i, x, x + rng.uniform(0, 30), rng.choice([float(rng.randrange(20)), rng.uniform(0, 100)]), rng.choice([0.5, 2.0])) for g, n in (("hot", 600), ("a", 10), (None, 10)) for i in range(n) for x in [rng.uniform(0, 100)]]
    boxes = []
    for g, n in (("hot", 150), ("a", 4), (None, 3), ("other", 2)):
        for _ in range(n):
            x, y = rng.uniform(-20, 120), rng.uniform(-10, 100)
            boxes.append((g, x, y, x + rng.choice([1.0, 9.0]), y + rng.choice([0.0, 1.0, 15.0, 90.0])))
    boxes += [("hot", 0.0, 9.0, 500.0, 1.0), ("hot", 1.0, None, 2.0, 3.0)]
    c = spark.createDataFrame(clusters, "g string, i int, x_lo double, x_hi double, y_center double, mean double").repartition(3)
    b = spark.createDataFrame(boxes, "g string, x0 double, y0 double, x1 double, y1 double").repartition(3)
    want = set()
    for g, i, lo, hi, y, mean in clusters:
        for h, x0, y0, x1, y1 in boxes:
            if g == h and y0 is not None and y0 - 2 <= y <= y1 + 2:
                want |= {(g, i, "single_sided:no_right_anchor")} if x1 > hi + 1.5 * mean else set()
                want |= {(g, i, "single_sided:no_left_anchor")} if x0 < lo - 1.5 * mean else set()
    got = layout.single_sided(c, b, ["g"], **how)
    assert got.columns == [*c.columns, "note"] and sorted(map(repr, ((r.g, r.i, r.note) for r in got.collect()))) == sorted(map(repr, want))
    assert got.groupBy("g", "i").count().agg(F.max("count")).first()[0] <= 2


def test_heights_that_vary_when_worked_out_again(spark):
    shaken = F.udf(lambda i: i + random.random() * 1e-9, "double").asNondeterministic()
    c = spark.range(50).select("id", F.lit(0.0).alias("x_lo"), F.lit(1.0).alias("x_hi"), shaken(F.col("id").cast("double")).alias("y_center"), F.lit(1.0).alias("mean"))
    b = spark.range(50).select("id", F.lit(-9.0).alias("x0"), F.lit(-100.0).alias("y0"), F.lit(0.5).alias("x1"), F.lit(100.0).alias("y1"))
    got = layout.single_sided(c, b, ["id"]).select("id", "note").collect()
    assert sorted(tuple(r) for r in got) == [(i, "single_sided:no_left_anchor") for i in range(50)]
