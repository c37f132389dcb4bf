"""Audit reports over documents and rasters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.fields import has_response


def dataset_overview(docs: DataFrame) -> DataFrame:
    """Per source: documents, documents with an answer, mean counts of fields by role and of pages."""
    f = F.col("fields")
    role = lambda r: F.avg(F.size(F.filter(f, lambda x: x["role"] == r)))
    return docs.groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(F.exists(f, lambda x: has_response(x["role"], x["value"]))).alias("with_answers"), F.avg(F.size(f)).alias("mean_fields"),
        *(role(r).alias(f"mean_{r}") for r in ("answer", "question", "header")), F.avg("page_count").alias("mean_pages"),
    )


def whiteness(boxes: DataFrame, by: Sequence[str], white: str) -> DataFrame:
    """white: a box's mean brightness, 0 to 1.  Mean, least, and the shares at .98, at .95 and under .90."""
    w = F.col(white)
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return boxes.groupBy(*by).agg(F.count("*").alias("n"), F.avg(w).alias("mean_white"), F.min(w).alias("min_white"), share(w >= 0.98).alias("at_98"), share(w >= 0.95).alias("at_95"), share(w < 0.9).alias("under_90"))


def pixel_diff(pixels: DataFrame, by: Sequence[str], a: str, b: str, over: int = 10) -> DataFrame:
    """Share of pixels that differ by more than so much, mean and population deviation of the difference, brightness of both."""
    d = F.abs(F.col(a) - F.col(b))
    return pixels.groupBy(*by).agg(F.avg(F.when(d > over, 1.0).otherwise(0.0)).alias("changed"), F.avg(d).alias("mean_diff"), F.stddev_pop(d).alias("std_diff"), F.avg(a).alias("bright_a"), F.avg(b).alias("bright_b"))


def first_per_group(rows: DataFrame, by: Sequence[str], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """The first n rows of each group; Spark limits each group before the shuffle."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(f"__n <= {n}").drop("__n")


def structure(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """pairs: pages_a, pages_b, w_a, h_a, w_b, h_b.  Share of equal page counts and mean sizes."""
    return pairs.groupBy(*by).agg(F.avg((F.col("pages_a") == F.col("pages_b")).cast("int")).alias("same_pages"), *(F.avg(c).alias(f"mean_{c}") for c in ("w_a", "h_a", "w_b", "h_b")))


def run_summary(rows: DataFrame, by: str = "source") -> DataFrame:
    """rows: skipped (reason or null), redacted.  Per group and in all (null)."""
    return rows.rollup(by).agg(F.count_if(F.col("skipped").isNull()).alias("ok"), F.count_if(F.col("skipped").isNotNull()).alias("skip"), F.coalesce(F.sum("redacted"), F.lit(0)).alias("redacted"))


def degraded_records(docs: DataFrame, profiles: Sequence[str] = ("light", "medium", "heavy")) -> DataFrame:
    """A training record of each degradable training document for each profile; nothing is shuffled."""
    from quire.functions.text import degradable

    rows = docs.where((F.col("split") == "train") & degradable(F.col("source")))
    rows = rows.withColumn("profile", F.explode(F.array(*map(F.lit, profiles))))
    return rows.withColumns({"doc_id": F.concat_ws("_", "doc_id", "profile"), "source": F.concat("source", F.lit("_degraded")), "quality_tier": F.lit("degraded_synthetic"), "split": F.lit("train")})
