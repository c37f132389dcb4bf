"""Corpus operators: deduplicate, score, order, split, roll up, fingerprint, load, sample."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.fields import quality_score
from quire.functions.text import seeded
from quire.schema import SPLITS, TIERS


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], exempt: Column | None = None) -> DataFrame:
    """The first row of each key by order; rows that exempt marks always stay.

    Spark limits each group to one row before the shuffle, so a key that holds most rows costs little.
    """
    first = df if exempt is None else df.where(~exempt)
    out = first.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")
    return out if exempt is None else out.unionByName(df.where(exempt))


def deduplicate(docs: DataFrame, order: Sequence[str | Column], content_hash: str = "content_hash") -> DataFrame:
    """First on (source, doc_id), then on content among those left; unknown content is never a copy."""
    once = keep_first(docs, ["source", "doc_id"], order)
    return keep_first(once, [content_hash], order, F.col(content_hash).isNull() | (F.col(content_hash) == ""))


def score(docs: DataFrame) -> DataFrame:
    return docs.withColumn("quality_score", quality_score(F.col("fields")))


def tier_rank(tier: Column) -> Column:
    out = F.when(tier == TIERS[0], 0)
    for i, t in enumerate(TIERS[1:], 1):
        out = out.when(tier == t, i)
    return out.otherwise(99)


def ordered(docs: DataFrame, ordinal: str) -> DataFrame:
    """Best tier first, then best score, then source; equal ones keep their ordinal order."""
    return docs.orderBy(tier_rank(F.col("quality_tier")), F.desc("quality_score"), "source", ordinal)


def split_counts(n: Column, train: float = 0.7, val: float = 0.15) -> tuple[Column, Column]:
    """(train, val) sizes of a group of n: rounded half to even; from three on val and test get one each, out of train."""
    a, v = F.bround(n * F.lit(train)).cast("long"), F.bround(n * F.lit(val)).cast("long")
    t = n - a - v
    need_v = F.when((n >= 3) & (v < 1), 1).otherwise(0)
    need_t = F.when((n >= 3) & (t < 1), 1).otherwise(0)
    return a - need_v - need_t, v + need_v


def hash_ranked(docs: DataFrame, group: Sequence[str], seed: int, ids: Sequence[str], first: Column | None = None, digits: int = 3) -> DataFrame:
    """Place of each row in its group (__r, from 1; rows with the larger first come first, then by md5 rank) and the group's size (__size).

    A group is cut by the first digits of its hashes: rows are numbered inside a cut and cuts are offset by the
    counts before them, so a group of any size spreads over as many tasks as it has cuts.
    """
    h = seeded(seed, *map(F.col, ids))
    rows = docs.withColumns({"__f": F.lit(0) if first is None else -first.cast("int"), "__h": h, "__p": F.substring(h, 1, digits)})
    cut = [*group, "__f", "__p"]
    before = Window.partitionBy(*group).orderBy("__f", "__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*cut).agg(F.count("*").alias("__n"))
    counts = counts.select(*cut, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"), F.sum("__n").over(Window.partitionBy(*group)).alias("__size"))
    place = F.row_number().over(Window.partitionBy(*cut).orderBy("__h", *ids))
    return rows.withColumn("__i", place).join(counts, cut).withColumn("__r", F.col("__o") + F.col("__i")).drop("__f", "__h", "__p", "__o", "__i")


def assign_splits(docs: DataFrame, seed: int, group: Sequence[str] = ("source",), ids: Sequence[str] = ("doc_id",), first: Column | None = None, fill: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """Stratified split by an md5 rank within each group.

    first: rows that go to val and test before others (fill = val, test, train then).
    """
    ranked = hash_ranked(docs, group, seed, ids, first)
    train, val = split_counts(F.col("__size"))
    sizes = {"train": train, "val": val, "test": F.col("__size") - train - val}
    upto = split = None
    for name in fill[:-1]:
        upto = sizes[name] if upto is None else upto + sizes[name]
        split = F.when(F.col("__r") <= upto, name) if split is None else split.when(F.col("__r") <= upto, name)
    return ranked.withColumn("split", split.otherwise(fill[-1])).drop("__r", "__size")


def split_totals(docs: DataFrame) -> DataFrame:
    return docs.groupBy(F.coalesce("split", F.lit("none")).alias("split")).agg(F.count("*").alias("n"))


def manifest_rollup(docs: DataFrame, sources: Sequence[str] = ()) -> DataFrame:
    """Documents of each source, in all and by split, zero-filled for the sources named."""
    cells = [F.count(F.when(F.col("split") == s, 1)).alias(s) for s in SPLITS]
    out = docs.groupBy("source").agg(F.count("*").alias("total"), *cells)
    if not sources:
        return out
    known = docs.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    return out.join(F.broadcast(known), "source", "full").select("source", *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("total", *SPLITS)))


def manifest_sets(docs: DataFrame, sets: Sequence[Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """Counts by several groupings in one pass."""
    return docs.groupingSets([list(map(F.col, s)) for s in sets], *keys).agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


def corpus_stats(docs: DataFrame) -> DataFrame:
    """One shape whatever the origin: (kind, name, n)."""
    both = docs.groupingSets([["source"], ["quality_tier"], ["split"], []], "source", "quality_tier", "split").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    kind = F.when(F.col("g") == 3, "source").when(F.col("g") == 5, "quality_tier").when(F.col("g") == 6, "split").otherwise("total")
    return both.select(kind.alias("kind"), F.coalesce("source", "quality_tier", "split").alias("name"), "n")


def fingerprint(docs: DataFrame, keys: Sequence[str], content: Column, digits: int = 4) -> DataFrame:
    """One hash for the set of rows, whatever their order: SHA-256 over sorted row digests, in two levels.

    The rows fall into 16 ** digits ranges of their key hash; each range is hashed
    in order, then the range hashes in order, so no task holds more than a range.
    """
    row = F.sha2(F.concat_ws("\x1f", *(F.col(k).cast("string") for k in keys), content), 256)
    rows = docs.select(F.substring(F.md5(F.concat_ws("\x1f", *map(F.col, keys))), 1, digits).alias("part"), row.alias("digest"))
    parts = rows.groupBy("part").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ""), 256).alias("d"), F.count("*").alias("n"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "d"))), lambda x: x["d"]), "")
    return parts.agg(F.sha2(joined, 256).alias("fingerprint"), F.coalesce(F.sum("n"), F.lit(0)).alias("documents"))


def load(docs: DataFrame, split: str | None = "val", require_pdf: bool = True, require_gt: bool = True, quality_tier: str | None = None, existing: DataFrame | None = None, never: Sequence[str] = ("rvlcdip",)) -> DataFrame:
    """Records for evaluation; existing (pdf_path): the files that are there.  A source that survives and holds a name in never is an error."""
    from quire.functions.fields import responses

    out = docs if split is None else docs.where(F.col("split") == split)
    if quality_tier is not None:
        out = out.where(F.col("quality_tier") == quality_tier)
    if require_gt:
        out = out.where(F.size(responses(F.col("fields"))) > 0)
    if require_pdf:
        out = out.where(F.col("pdf_path").isNotNull())
        if existing is not None:
            out = out.join(existing.select("pdf_path").distinct(), "pdf_path", "left_semi")
    bad = reduce(lambda a, b: a | b, (F.contains("source", F.lit(n)) for n in never), F.lit(False))
    # a filter of its own that no plan leaves out, moves or joins to another: its last branch is not deterministic
    fail = F.raise_error(F.concat(F.lit("source may not be loaded: "), F.col("source"))).cast("boolean")
    return out.where(F.when(bad, fail).otherwise(F.monotonically_increasing_id() >= 0))


def select_rows(docs: DataFrame, **equal: str | None) -> DataFrame:
    """filter(source=..., split=..., quality_tier=...): null arguments do not filter."""
    for name, value in equal.items():
        if value is not None:
            docs = docs.where(F.col(name) == value)
    return docs


def sample_uniform(docs: DataFrame, n: int, seed: int, ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """n rows by md5 rank; the same rows however the table is partitioned.  If there are no more than n, all, as they stand."""
    if docs.limit(n + 1).count() <= n:
        return docs
    return docs.orderBy(seeded(seed, *map(F.col, ids)), *ids).limit(n)


def load_with_fallback(master: DataFrame, field_json: DataFrame) -> DataFrame:
    """Master rows with the fields of their JSON, or none where it is missing."""
    empty = F.array().cast(field_json.schema["fields"].dataType)
    return master.join(field_json.select("source", "doc_id", "fields"), ["source", "doc_id"], "left").withColumn("fields", F.coalesce("fields", empty))
