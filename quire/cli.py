"""python -m quire.cli COMMAND: the engine's plans from the shell; all paths are what Spark reads."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import caption, parse_list
from quire.operators import corpus, manifest, pages, pdf
from quire.plans import corpus_run, release
from quire.sources import files, sinks, synthetic


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="command", required=True)
    m = sub.add_parser("manifest", help="documents and profiles to a manifest")
    m.add_argument("--documents", required=True)
    m.add_argument("--profiles", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--sources", default="vrdu_ad_buy,vrdu_registration")
    m.add_argument("--approach", default="pymupdf-redact")
    m.add_argument("--sample-size", type=int)
    m.add_argument("--seed", type=int, default=42)
    m.add_argument("--exclude", default="")
    m.add_argument("--include-subtypes", default="")
    b = sub.add_parser("build", help="a named release")
    b.add_argument("recipe")
    b.add_argument("--documents", required=True)
    b.add_argument("--profiles", required=True)
    b.add_argument("--out", required=True)
    k = sub.add_parser("blank", help="blank page rasters")
    k.add_argument("--pages", required=True)
    k.add_argument("--fields", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--only", action="append", default=[])
    k.add_argument("--dot-bridge-px", type=int, default=0)
    k.add_argument("--detect-dotted", action="store_true")
    k.add_argument("--touch-up-dotted-lines", action="store_true")
    k.add_argument("--overlays", action="store_true")
    c = sub.add_parser("combine", help="the page plan of a review file, and with --files and --out the file")
    c.add_argument("--documents", required=True)
    c.add_argument("--run-log", required=True)
    c.add_argument("--only-touched", action="store_true")
    c.add_argument("--files")
    c.add_argument("--out")
    for name, text in (("blank-pdf", "blank files by lane and their run log"), ("preview", "files with their answers in colour and their log")):
        w = sub.add_parser(name, help=text)
        w.add_argument("--files", required=True)
        w.add_argument("--documents", required=True)
        w.add_argument("--out", required=True)
    r = sub.add_parser("report", help="counts of a corpus")
    r.add_argument("--documents", required=True)
    e = sub.add_parser("export", help="one split")
    e.add_argument("--documents", required=True)
    e.add_argument("--split", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--fields", help="a folder of field files; those of the split are counted")
    f = sub.add_parser("forms", help="synthetic forms")
    f.add_argument("--out", required=True)
    f.add_argument("--files", action="store_true", help="write each form's PDF too")
    u = sub.add_parser("run", help="the corpus run: all stages, or one that stands alone")
    u.add_argument("--all", action="store_true")
    u.add_argument("--stage", choices=corpus_run.STAGES)
    u.add_argument("--part", action="append", default=[], help="a folder of nested records")
    u.add_argument("--out", required=True)
    u.add_argument("--seed", type=int, default=42)
    t = sub.add_parser("status", help="which stages of a run are complete")
    t.add_argument("--out", required=True)
    return p


def _pdf_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path)


def _lane(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Run a lane once, write its files below out and its rows, without the bytes, as the log."""
    work, name = (pdf.blank_files, "blank.pdf") if a.command == "blank-pdf" else (pdf.preview_files, "preview.pdf")
    done = work(_pdf_files(spark, a.files), spark.read.parquet(a.documents))
    done.write.mode("overwrite").parquet(f"{a.out}/lane")
    done = spark.read.schema(done.schema).parquet(f"{a.out}/lane")
    written = sinks.write_files(done, f"{a.out}/files", name).count()
    sinks.write_run_log(done.drop("data"), f"{a.out}/run")
    return {"files": written, **{r.status: r["count"] for r in done.groupBy("status").count().collect()}}


def _release(spark: SparkSession, a: argparse.Namespace, r: release.Recipe) -> dict:
    out = release.plan(spark.read.parquet(a.documents), spark.read.parquet(a.profiles), r)
    stats = out.stats.first().asDict() | {"sources": list(r.sources), "classified": {x.category: x.n for x in out.counts.collect()}}
    m = sinks.manifest(out.manifest, r.description, manifest.COMPATIBILITY, stats, manifest.VERSION)
    sinks.put_text(spark, f"{a.out.rstrip('/')}/manifest.json", json.dumps(m, indent=2, ensure_ascii=False))
    return {"documents": len(m["documents"]), **stats}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = _parser()
    a = parser.parse_args(argv)
    if a.command == "run" and not a.all and a.stage is None:
        parser.error("--all or --stage is needed")
    if a.command == "run" and not a.all and a.stage in corpus_run.DEPENDENT:
        parser.error(f"stage {a.stage} needs the records of the stages before it: run --all")
    spark = spark or SparkSession.builder.appName("quire").getOrCreate()
    said: dict | DataFrame
    if a.command == "manifest":
        subtypes = tuple(parse_list(a.include_subtypes)) or None
        r = release.Recipe("manifest", "a manifest", tuple(parse_list(a.sources)), a.approach, include_subtypes=subtypes, exclude_ids=tuple(parse_list(a.exclude)), sample_size=a.sample_size, seed=a.seed)
        said = _release(spark, a, r)
    elif a.command == "build":
        said = _release(spark, a, release.recipe(a.recipe))
    elif a.command == "blank":
        pg, fl = spark.read.parquet(a.pages), spark.read.parquet(a.fields)
        if a.only:
            pg = pg.where(F.col("doc_id").isin(a.only))
        knobs = {"bridge": a.dot_bridge_px, "dotted": a.detect_dotted or a.touch_up_dotted_lines}
        pages.blank_pages(pg, fl, knobs, a.touch_up_dotted_lines).write.mode("overwrite").parquet(f"{a.out}/pages")
        log = pages.run_totals(spark.read.parquet(f"{a.out}/pages").drop("data"))
        sinks.write_run_log(log, f"{a.out}/run")
        said = {"documents": spark.read.json(f"{a.out}/run").count()}
        if a.overlays:
            said["overlays"] = sinks.write_files(pages.overlay_rows(pg, fl, a.touch_up_dotted_lines, {} if a.touch_up_dotted_lines else knobs), f"{a.out}/overlays", "overlay.png").count()
    elif a.command in ("blank-pdf", "preview"):
        said = _lane(spark, a)
    elif a.command == "combine":
        log = files.run_log(spark, a.run_log)
        said = manifest.review_pages(spark.read.parquet(a.documents), log, "ord", a.only_touched)
        if a.files and a.out:
            counts = [F.col(c) if c in log.columns else F.lit(None) for c in ("touch_up_dots", "touch_up_clusters", "touch_up_gaps")]
            notes = F.col("touch_up_notes") if "touch_up_notes" in log.columns else F.lit(None).cast("array<string>")
            captions = log.select("doc_id", F.lit(True).alias("logged"), caption(F.col("doc_id"), *counts, notes).alias("caption"))
            plan = said.select("doc_id", "ord").join(captions, "doc_id", "left").withColumn("caption", F.coalesce("caption", "doc_id"))
            data, said = pdf.combine(_pdf_files(spark, a.files), plan, "ord")
            sinks.put_bytes(spark, a.out, data)
    elif a.command == "report":
        said = corpus.corpus_stats(spark.read.parquet(a.documents))
    elif a.command == "export":
        sinks.write_split(spark.read.parquet(a.documents), a.split, a.out)
        said = {"documents": spark.read.parquet(a.out).count()}
        if a.fields:
            said["field_files"] = corpus_run.export_rows(spark.read.parquet(a.out), a.split, files.listing(spark, a.fields, "*.json")).count()
    elif a.command == "run":
        corpus_run.run(spark, a.part, a.out, None if a.all else a.stage, a.seed)
        said = {s["stage"]: s["status"] for s in corpus_run.status(spark, a.out)}
    elif a.command == "status":
        for s in corpus_run.status(spark, a.out):
            print(json.dumps(s))
        return 0
    else:
        synthetic.forms(spark).write.mode("overwrite").parquet(a.out)
        said = {"documents": spark.read.parquet(a.out).count()}
        if a.files:
            said["files"] = sinks.write_files(synthetic.form_files(synthetic.forms(spark)), f"{a.out.rstrip('/')}-files", "form.pdf").count()
    if isinstance(said, dict):
        print(json.dumps(said))
    else:
        for row in said.orderBy(*said.columns).toLocalIterator():
            print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
