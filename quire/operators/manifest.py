"""From candidates to a manifest: classify, exclude, filter, sample, count."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import seeded, stripped, subtype
from quire.operators.ranges import running
from quire.schema import CATEGORIES

VERSION = 1
#: Leftover documents that a source offers at first for the remainder of a proportional sample.
OFFERED = 32


@dataclass(frozen=True, slots=True)
class Source:
    kind: str
    subdir: str
    subset: str | None = None


#: The known sources.
SOURCES = {
    "vrdu_ad_buy": Source("pdf", "ad_buy", "ad-buy-form"),
    "vrdu_registration": Source("pdf", "registration", "registration-form"),
    "funsd": Source("image", "funsd"),
    "xfund_de": Source("image", "xfund_de"),
    "xfund_fr": Source("image", "xfund_fr"),
}
#: Which lane takes which category.
COMPATIBILITY = {
    "synthetic_acroform": ["pymupdf-redact", "image-fallback"],
    "born_digital_pdf": ["pymupdf-redact", "image-fallback"],
    "image_only_pdf": ["image-fallback"],
    "image_only_png": ["image-fallback"],
}
PROCESSABLE = ("born_digital_pdf", "synthetic_acroform")


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, s.kind, s.subdir, s.subset) for n, s in SOURCES.items()], "source string, kind string, subdir string, subset string")


def compatibility(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, a) for c, lanes in COMPATIBILITY.items() for a in lanes], "category string, approach string")


def category(text_chars: Column, widgets: Column) -> Column:
    """Text outweighs widgets; neither means an image."""
    return F.when(text_chars > 0, CATEGORIES[0]).when(widgets > 0, CATEGORIES[1]).otherwise(CATEGORIES[2])


def profile(pages: DataFrame) -> DataFrame:
    """pages: doc_id, text, widget_count, error (null unless the file is broken); a row for each document."""
    sums = pages.groupBy("doc_id").agg(
        F.count(F.when(F.col("error").isNull(), 1)).alias("page_count"), F.coalesce(F.sum(F.length(stripped(F.col("text")))), F.lit(0)).alias("text_char_count"),
        F.coalesce(F.sum("widget_count"), F.lit(0)).alias("widget_count"), F.max("error").alias("error"),
    )
    broken = F.col("error").isNotNull()
    return sums.select(
        "doc_id", F.when(broken, CATEGORIES[2]).otherwise(category(F.col("text_char_count"), F.col("widget_count"))).alias("category"),
        *(F.when(broken, F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in ("page_count", "text_char_count", "widget_count")), "error",
    )


def category_counts(profiles: DataFrame) -> DataFrame:
    """Zero-filled; a broken file counts for its category and as an error."""
    names = profiles.select(F.explode(F.array_compact(F.array("category", F.when(F.col("error").isNotNull(), "error")))).alias("category"))
    domain = profiles.sparkSession.createDataFrame([(c,) for c in (*CATEGORIES, "error")], "category string")
    counts = names.groupBy("category").agg(F.count("*").alias("n"))
    return F.broadcast(domain).join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


def exclude(docs: DataFrame, ids: DataFrame, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    return docs.join(ids.select(*key).distinct(), list(key), "left_anti")


def only(docs: DataFrame, ids: DataFrame, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    return docs.join(ids.select(*key).distinct(), list(key), "left_semi")


def compatible(docs: DataFrame, approach: str) -> DataFrame:
    """Documents whose category the lane takes; documents without a category are left out."""
    lanes = compatibility(docs.sparkSession).where(F.col("approach") == approach)
    return docs.join(F.broadcast(lanes), "category", "left_semi")


def with_subtype(docs: DataFrame, include: Sequence[str] | None = None, scope: str = "vrdu_registration") -> DataFrame:
    """Tag documents of one source; include: of these keep the named subtypes only."""
    docs = docs.withColumn("subtype", F.when(F.col("source") == scope, subtype(F.col("doc_id"))))
    return docs if include is None else docs.where((F.col("source") != scope) | F.coalesce(F.col("subtype").isin(*include), F.lit(False)))


def allocation(counts: DataFrame, n: int, seed: int) -> DataFrame:
    """counts: source, pool.  How many of n each source gives: its floor share, the rest drawn by weight of what is left.

    The rest is the first of all leftover documents in a random order.  The least of m uniform ranks, the next and so on
    are sums of exponential steps over m, m - 1, ..., so a source offers its first few ranks without a row for each
    document; where all of them are drawn it offers more.
    """
    available = counts.agg(F.sum("pool")).first()[0] or 0
    if not available:
        return counts.select("source", F.lit(0).cast("long").alias("take"))
    base = counts.withColumn("take", F.least("pool", F.expr(f"({n}L * pool) div {available}L")))
    rest = min(n, available) - base.agg(F.sum("take")).first()[0]
    if rest <= 0:
        return base.select("source", F.col("take").cast("long").alias("take"))
    left = base.where("pool > take").select("source", (F.col("pool") - F.col("take")).alias("left"))
    offered = OFFERED
    while True:
        offers = left.select("source", "left", F.explode(F.sequence(F.lit(1).cast("long"), F.least("left", F.lit(min(offered, rest))))).alias("k"))
        uniform = (F.conv(F.substring(seeded(seed, F.col("source"), F.col("k")), 1, 13), 16, 10).cast("double") + 1) / float(1 << 52)
        step = -F.ln(uniform) / (F.col("left") - F.col("k") + 1)
        rank = F.sum(step).over(Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
        drawn = offers.withColumn("rank", rank).orderBy("rank", "source", "k").limit(rest)
        extra = drawn.groupBy("source").agg(F.count("*").alias("extra"))
        if offered >= rest or not extra.join(left, "source").where(f"extra = {offered} and left > {offered}").limit(1).count():
            return base.join(extra, "source", "left").select("source", (F.col("take") + F.coalesce("extra", F.lit(0))).cast("long").alias("take"))
        offered *= 8


def sample(docs: DataFrame, n: int, seed: int, exclude_ids: DataFrame | None = None) -> DataFrame:
    """(source, doc_id) of a proportional sample: n rows, or all if there are no more."""
    ids = docs.select("source", "doc_id").distinct()
    if exclude_ids is not None:
        ids = exclude(ids, exclude_ids)
    take = allocation(ids.groupBy("source").agg(F.count("*").alias("pool")), n, seed)
    rank = F.row_number().over(Window.partitionBy("source").orderBy(seeded(seed, F.col("doc_id")), "doc_id"))
    return ids.withColumn("r", rank).where(f"r <= {n}").join(take, "source").where("r <= take").select("source", "doc_id")


def breakdown(chosen: DataFrame) -> DataFrame:
    return chosen.groupBy("source").agg(F.count("*").alias("n"))


def build_stats(candidates: DataFrame, excluded: DataFrame, included: DataFrame) -> DataFrame:
    """One row: candidates, dropped by exclusion, included."""
    parts = {"candidates": candidates, "excluded_dropped": only(candidates, excluded), "included": included}
    rows = None
    for name, df in parts.items():
        part = df.select(F.lit(name).alias("part"))
        rows = part if rows is None else rows.union(part)
    return rows.agg(*(F.count_if(F.col("part") == name).alias(name) for name in parts))


def last_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key the last; rows without a key are dropped."""
    names = [c for c in rows.columns if c != key]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), order).alias("v")).select(key, "v.*")


def review_pages(docs: DataFrame, runs: DataFrame, order: str, only_touched: bool = False) -> DataFrame:
    """The page plan of a combined file: documents in order with their first page.

    docs: doc_id, pages, the order column; runs: doc_id, touch_up_dots.
    """
    rows = docs.join(runs.select("doc_id", F.col("touch_up_dots").alias("dots")), "doc_id", "left")
    if only_touched:
        rows = rows.where(F.coalesce("dots", F.lit(0)) > 0)
    return start_pages(rows, order)


def start_pages(rows: DataFrame, order: str, by: Sequence[str] = ()) -> DataFrame:
    return running(rows, "pages", order, "start_page", by).withColumn("start_page", F.col("start_page") + 1)


def until_successes(rows: DataFrame, limit: int, order: str, ok: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows that run before so many have succeeded; skipped ones do not count."""
    counted = running(rows.withColumn("__ok", F.col(ok).cast("int")), "__ok", order, "__n", by)
    return counted.where(f"__n < {limit}").drop("__n", "__ok")
