"""A named release: candidates to manifest to lane, as one declared plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import manifest as M


@dataclass(frozen=True, slots=True)
class Recipe:
    name: str
    description: str
    sources: tuple[str, ...]
    approach: str
    dpi: int = 150
    classifier: dict = field(default_factory=dict)
    include_subtypes: tuple[str, ...] | None = None
    exclude_ids: tuple[str, ...] = ()
    sample_size: int | None = None
    seed: int = 42
    touch_up: bool = False


#: Documents no release takes, and why.
EXCLUSIONS = {"fr_train_70": "answer boxes do not match the page"}

RECIPES = {
    r.name: r
    for r in (
        Recipe("forms-blank-beta", "blanked token- and entity-level scans, dotted lines kept", ("funsd", "xfund_de", "xfund_fr"), "image-fallback", classifier={"dotted": True}, exclude_ids=tuple(EXCLUSIONS)),
        Recipe("pdf-blank", "blanked born-digital and form PDFs", ("vrdu_ad_buy", "vrdu_registration"), "pymupdf-redact"),
    )
}


def recipe(name: str) -> Recipe:
    if name not in RECIPES:
        raise KeyError(f"unknown recipe {name!r}; known: {', '.join(sorted(RECIPES))}")
    return RECIPES[name]


@dataclass(frozen=True, slots=True)
class Release:
    candidates: DataFrame
    manifest: DataFrame
    lane: DataFrame
    counts: DataFrame
    stats: DataFrame


def plan(docs: DataFrame, profiles: DataFrame, r: Recipe) -> Release:
    """docs: records; profiles: doc_id, category, page_count, text_char_count, widget_count, error.

    Exclusion comes first, then subtypes, then the sample.
    """
    spark = docs.sparkSession
    sources = M.registry(spark).where(F.col("source").isin(*r.sources))
    known = docs.drop("page_count").join(F.broadcast(sources), "source").join(profiles, "doc_id", "left")
    image = F.col("kind") == "image"
    known = known.withColumn("category", F.when(image, "image_only_png").otherwise(F.col("category")))
    able = known.where(image | F.col("category").isin(*M.PROCESSABLE))
    out = M.exclude(able, spark.createDataFrame([(i,) for i in r.exclude_ids], "doc_id string"))
    out = M.with_subtype(out, r.include_subtypes)
    if r.sample_size is not None:
        out = M.only(out, M.sample(out, r.sample_size, r.seed), ("source", "doc_id"))
    from quire.functions.fields import manifest_entry

    stats = M.build_stats(able, spark.createDataFrame([(i,) for i in r.exclude_ids], "doc_id string"), out)
    return Release(able, manifest_entry(out), M.compatible(out, r.approach), M.category_counts(known.select("category", "error")), stats)


def missing(lane_ids: DataFrame, produced: DataFrame, ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Documents of the lane without an output."""
    return lane_ids.join(produced.select(*ids).distinct(), list(ids), "left_anti")
