"""Large groups cut into ranges against plain windows."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import layout, manifest, ranges

NAN = float("nan")


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def points(spark, n=4000, seed=1):
    """A group of nearly all rows, half of them at one value; small groups, one without a key; nulls, NaN."""
    rng = random.Random(seed)
    rows = [("hot", i, 5.0 if i % 2 else rng.choice([rng.randrange(300) / 4, float(rng.randrange(40)), None])) for i in range(n)]
    rows += [(g, i, rng.randrange(60) / 4) for g in ("a", None) for i in range(50)] + [("one", 0, 1.0), ("none", 0, None), ("hot", n, NAN)]
    return spark.createDataFrame(rows, "g string, i int, x double").repartition(5)


def test_half_of_the_rows_at_one_value_give_even_ranges(spark):
    df = spark.range(64_000).select((F.col("id") % 7).alias("other"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("o"), "id")
    marked, _, cut = ranges.in_ranges(df, [], ["o"])
    counts = [r["count"] for r in marked.groupBy("__cut").count().collect()]
    assert cut and 60 <= len(counts) <= 64 and max(counts) <= 2 * 1000


def test_small_groups_are_not_cut(spark):
    df = points(spark)
    marked, _, cut = ranges.in_ranges(df, ["g"], ["x"])
    assert not cut and {r["__cut"] for r in marked.select("__cut").distinct().collect()} == {0}
    marked, _, cut = ranges.in_ranges(df, ["g"], ["x"], hot=100)
    got = {r.g: r.n for r in marked.groupBy("g").agg(F.count_distinct("__cut").alias("n")).collect()}
    assert cut and got["hot"] > 40 and got["a"] == got[None] == got["one"] == 1


@pytest.mark.parametrize("how", [{}, {"hot": 100}, {"cuts": 9}])
def test_running_sums(spark, how):
    df = points(spark).withColumn("n", F.col("i") % 7)
    got = ranges.running(df, "n", "i", "s", ["g"], **how)
    want = df.withColumn("s", F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    tied = ranges.running(df.withColumn("n", F.col("n") + 1), "n", "x", "s", ["g"], **how).where("g = 'hot'").orderBy("s").collect()
    assert tied[0].s == 0 and all(b.s - a.s == a.n for a, b in zip(tied, tied[1:], strict=False))


def test_successes_and_pages(spark):
    df = points(spark).withColumn("ok", F.col("i") % 3 == 0).withColumn("pages", F.lit(2))
    got = manifest.until_successes(df, 10, "i", "ok", ["g"])
    assert max(r.i for r in got.where("g = 'hot'").collect()) == 27
    assert {(r.g, r.i): r.start_page for r in manifest.start_pages(df.where("g = 'a'"), "i", ["g"]).collect()} == {("a", i): 2 * i + 1 for i in range(50)}


@pytest.mark.parametrize("how", [{}, {"hot": 100}, {"cuts": 9}])
def test_spacings_equal_the_plain_window(spark, how):
    df = points(spark)
    w = Window.partitionBy("g").orderBy("x", "i")
    want = df.withColumn("spacing", F.lead("x").over(w) - F.col("x")).withColumn("next_x", F.lead("x").over(w))
    assert rows_of(layout.spacings(df, ["g"], "x", ["i"], **how)) == rows_of(want)


def test_spacings_are_added_in_order(spark):
    rng = random.Random(3)
    xs = sorted(rng.randrange(9000) / 100 for _ in range(700))
    df = spark.createDataFrame([(g, i, x) for g in "ab" for i, x in enumerate(xs)], "g string, i int, x double").repartition(5)
    gaps = layout.spacings(df, ["g"], "x", ["i"])
    total, down = 0.0, 0.0
    for a, b in zip(xs, xs[1:], strict=False):
        total += b - a
    for a, b in reversed(list(zip(xs, xs[1:], strict=False))):
        down += b - a
    assert total != down  # the order of the sum is seen in its last bit
    got = layout.spacing_stats(gaps, ["g"], order=["x", "i"]).collect()
    assert [(r.n, r["mean"]) for r in got] == [(699, total / 699)] * 2
    for how in ({"hot": 100}, {"cuts": 9}):
        cut = layout.spacing_stats(gaps, ["g"], order=["x", "i"], **how).collect()
        assert [r.n for r in cut] == [699] * 2 and all(abs(r["mean"] - total / 699) < 1e-12 for r in cut)


@pytest.mark.parametrize("how", [{"hot": 100}, {"cuts": 9}])
def test_values_pass_over_empty_ranges(spark, how):
    df = spark.range(2000).select(F.lit("g").alias("g"), "id", F.when(F.col("id").isin(3, 1500), F.col("id")).alias("v"))
    got = {r.id: (r.b, r.f) for r in ranges.beside(df, ["g"], ["id"], F.col("v"), "b", "f", **how).collect()}
    assert got == {i: (1500 if i > 1500 else 3 if i > 3 else None, 3 if i < 3 else 1500 if i < 1500 else None) for i in range(2000)}


@pytest.mark.parametrize("how", [{}, {"hot": 100}, {"cuts": 9}])
def test_nearest_points(spark, how):
    df = points(spark).where("x is not null and not isnan(x)")
    p, t = df.where("i % 5 = 0"), df.where("i % 5 = 1").select("g", F.col("i").alias("t"), "x")
    got = {(r.g, r.t): (r.nearest_id, r.distance) for r in layout.nearest(p, t, ["g"], "i", "x", ["t"], "x", **how).collect()}
    held = {}
    for r in p.collect():
        held.setdefault(r.g, {}).setdefault(r.x, []).append(r.i)
    held = {g: [(x, min(i)) for x, i in xs.items()] for g, xs in held.items()}
    for r in t.collect():
        best = min(((abs(x - r.x), i) for x, i in held.get(r.g, [])), default=(None, None))
        assert got[r.g, r.t] == (best[1], best[0])


@pytest.mark.parametrize("how", [{}, {"hot": 100}, {"cuts": 9}])
def test_medians(spark, how):
    df = points(spark).where("i >= 1 and not isnan(x) or x is null")
    values = {}
    for r in df.where("x is not null").collect():
        values.setdefault(r.g, []).append(r.x)
    assert {r.g: r.m for r in ranges.medians(df, ["g"], "x", "m", **how).collect()} == {g: statistics.median(v) for g, v in values.items()}


@pytest.mark.parametrize(("how", "tolerance"), [({}, 2.0), ({"hot": 100}, 0.25), ({"hot": 100}, 1000.0), ({"cuts": 9}, 2.0), ({"cuts": 64}, 0.1)])
def test_bands_equal_a_walk(spark, how, tolerance):
    df = points(spark, 1500).withColumn("x", F.when(F.col("i") % 3 == 0, F.col("x") + F.col("i") / 700).otherwise(F.col("x")))
    got = {(r.g, r.i): r.band for r in layout.bands(df, ["g"], "x", ["i"], tolerance, **how).collect()}
    want, groups = {}, {}
    for r in df.collect():
        groups.setdefault(r.g, []).append(r)
    for g, rows in groups.items():
        first, band = None, -1
        for r in sorted((r for r in rows if r.x is not None), key=lambda r: (r.x != r.x, r.x)):
            if first is None or not r.x - first <= tolerance:
                first, band = r.x, band + 1
            want[g, r.i] = band
        want |= {(g, r.i): None for r in rows if r.x is None}
    assert got == want


@pytest.mark.parametrize("how", [{}, {"hot": 100}, {"cuts": 9}])
def test_texts_of_long_runs(spark, how):
    rng = random.Random(9)
    rows = [("hot", i, "a" if i < 1500 else rng.choice("ab"), None if i % 9 == 0 or 200 < i < 700 else f"w{i}", i % 13) for i in range(2000)] + [("b", i, "a", f"v{i}", i) for i in range(4)]
    df = spark.createDataFrame(rows, "g string, i int, role string, word string, n int").repartition(5)
    got = {(r.g, r.run): (r.role, r.text, r.least) for r in layout.joined_runs(df, ["g"], ["i"], "role", F.col("word"), {"least": (F.min, "n")}, **how).collect()}
    want, run, last = {}, -1, None
    for g, _, role, word, n in rows:
        if (g, role) != last:
            run = run + 1 if last and last[0] == g else 0
        last = (g, role)
        _, texts, least = want.get((g, run), (role, [], n))
        want[g, run] = (role, texts + [word] * (word is not None), min(least, n))
    assert got == {k: (role, " ".join(texts), least) for k, (role, texts, least) in want.items()}
