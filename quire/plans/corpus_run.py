"""The corpus run: sources to a deduplicated, scored, ordered and split corpus with generated records behind it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import safe_name
from quire.operators import audit, corpus
from quire.sources import sinks, synthetic

#: The stages of a run, in order; the later ones need the records of those before them.
STAGES = ("ingest", "order", "consolidate", "generate", "test")
DEPENDENT = STAGES[1:4]


def build(parts: list[DataFrame], hashes: DataFrame | None = None, seed: int = 42, gt_first: str = "vrdu") -> DataFrame:
    """Records of all parts, each once, with score and split.

    hashes: source, doc_id, content_hash.  In sources that begin with gt_first, records with ground truth fill val, then test.
    """
    from quire.functions.fields import responses
    from quire.sources.forms import union_sources

    docs = union_sources(*parts)
    docs = docs.join(hashes, ["source", "doc_id"], "left") if hashes is not None else docs.withColumn("content_hash", F.lit(None).cast("string"))
    docs = corpus.score(corpus.deduplicate(docs, ["source_ord", "doc_id"]))
    preferred = F.col("source").startswith(gt_first)
    gt = (F.size(responses(F.col("fields"))) > 0).cast("int")
    a = corpus.assign_splits(docs.where(~preferred), seed)
    b = corpus.assign_splits(docs.where(preferred), seed, first=gt, fill=("val", "test", "train"))
    return a.unionByName(b).drop("content_hash")


def with_generated(docs: DataFrame, generated: DataFrame, profiles: tuple[str, ...] = ("light", "medium", "heavy")) -> DataFrame:
    """Generated records and their worn copies join after deduplication, scoring and ordering."""
    names = [c for c in docs.columns if c != "source_ord"]
    worn = audit.degraded_records(generated, profiles)
    return docs.select(*names).unionByName(generated.select(*names)).unionByName(worn.select(*names))


def export_rows(docs: DataFrame, split: str, field_files: DataFrame) -> DataFrame:
    """The documents of a split whose field file is there (column path of field_files, by its base name)."""
    name = safe_name(F.concat_ws("_", "source", F.concat("doc_id", F.lit(".json"))))
    there = field_files.select(F.element_at(F.split("path", "/"), -1).alias("__name")).distinct()
    rows = docs.where(F.col("split") == split).withColumn("__name", name)
    return rows.join(there, "__name", "left_semi").drop("__name")


def layout_values(layout: DataFrame, truth: DataFrame, keys: tuple[str, ...] = ("doc_id", "field_id")) -> DataFrame:
    """Each field of a layout with its value, '' where the truth has none; of several values of a field the greatest."""
    values = truth.groupBy(*keys).agg(F.max("value").alias("value"))
    return layout.join(values, list(keys), "left").withColumn("value", F.coalesce("value", F.lit("")))


def run(spark: SparkSession, parts: list[str], out: str, stage: str | None = None, seed: int = 42, say: Callable[[str], None] = print) -> None:
    """All stages, or one that stands alone, below the folder out; each marks its end in out/state.json.

    parts: folders with nested records, a source each.  A part that can not be read is said and left out.
    """
    if stage in DEPENDENT:
        raise ValueError(f"stage {stage} needs the records of the stages before it: run all")
    out, done = out.rstrip("/"), lambda name, **info: sinks.mark_stage(spark, f"{out}/state.json", name, **info)
    for name in STAGES if stage is None else (stage,):
        if name == "ingest":
            found = []
            for path in parts:
                try:
                    found.append(spark.read.parquet(path))
                    say(f"{path}: {found[-1].count()} records")
                except Exception as e:  # noqa: BLE001  (a broken source stops no other)
                    say(f"{path}: FAILED, {str(e).splitlines()[0]}")
            if not found:
                raise ValueError("no records")
            done(name, records=sum(f.count() for f in found))
        elif name == "order":
            _written(build(found, seed=seed), f"{out}/ordered")
            done(name, records=spark.read.parquet(f"{out}/ordered").count())
        elif name == "consolidate":
            _consolidate(spark.read.parquet(f"{out}/ordered"), out)
        elif name == "generate":
            docs, forms = spark.read.parquet(f"{out}/ordered"), synthetic.forms(spark)
            forms = corpus.assign_splits(corpus.score(forms), seed).withColumn("source_ord", F.lit(len(parts))) if "source_ord" in docs.columns else corpus.assign_splits(corpus.score(forms), seed)
            _written(with_generated(docs, forms), f"{out}/generated")
            both = spark.read.parquet(f"{out}/generated")
            _consolidate(both, out)
            done(name, new_records=both.count() - docs.count(), total_records=both.count())
        else:
            check(spark, out)
            done(name)
        say(f"{name}: done")


def _written(df: DataFrame, path: str) -> None:
    sinks.replace_folder(df.sparkSession, path, lambda new: df.write.parquet(new))


def _consolidate(docs: DataFrame, out: str) -> None:
    sinks.write_master(docs, f"{out}/master")
    sinks.write_documents(docs, f"{out}/documents")


def check(spark: SparkSession, out: str) -> None:
    """What a consolidated corpus must hold: a master row for each record, each record once, every record in a split."""
    master, docs = spark.read.parquet(f"{out}/master"), spark.read.json(f"{out}/documents")
    rows = docs.agg(F.count("*"), F.count_distinct("source", "doc_id"), F.count("split")).first()
    if not rows[0] == rows[1] == rows[2] == master.count():
        raise ValueError(f"{out}: {rows[0]} records, {rows[1]} of them different, {rows[2]} in a split, {master.count()} master rows")


def status(spark: SparkSession, out: str) -> list[dict]:
    """Each stage, whether it is complete, and since when."""
    state = sinks.stage_state(spark, f"{out.rstrip('/')}/state.json")
    return [{"stage": s, "status": state.get(s, {}).get("status", "pending"), "completed_at": state.get(s, {}).get("completed_at", "")} for s in STAGES]
