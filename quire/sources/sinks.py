"""Writers."""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.fields import master_row, with_derived
from quire.pdf.forms import image_pages


def write_master(docs: DataFrame, path: str) -> None:
    master_row(docs).write.mode("overwrite").parquet(path)


def write_documents(docs: DataFrame, path: str, by: tuple[str, ...] = ("source",)) -> None:
    """Nested records with their derived views, as JSON lines in a folder for each source."""
    with_derived(docs).write.mode("overwrite").partitionBy(*by).json(path)


def write_split(docs: DataFrame, split: str, path: str) -> None:
    docs.where(F.col("split") == split).write.mode("overwrite").parquet(path)


def write_run_log(rows: DataFrame, path: str) -> None:
    """A run log in the place of the one that is there, which stays whole until the new one is."""
    replace_folder(rows.sparkSession, path, lambda new: rows.write.json(new))


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """write a folder beside path and give it the name; what was there goes last, or stays if anything fails."""
    mark = uuid.uuid4().hex
    path = path.rstrip("/")
    new, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    write(new)
    fs, there = _place(spark, path)
    moved = fs.exists(there)
    if moved and not fs.rename(there, _place(spark, old)[1]):
        raise OSError(f"{path} can not be moved aside")
    if not fs.rename(_place(spark, new)[1], there):
        if moved:
            fs.rename(_place(spark, old)[1], there)
        raise OSError(f"{new} can not be renamed")
    if moved:
        fs.delete(_place(spark, old)[1], True)


def write_labels(labels: DataFrame, path: str) -> None:
    """One JSON object for each document, its answers in order."""
    names = [c for c in labels.columns if c not in ("lane", "source", "doc_id", "page_count", "pos")]
    answers = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.struct(*names).alias("f")))), lambda x: x["f"])
    labels.groupBy("lane", "source", "doc_id", "page_count").agg(answers.alias("answer_fields")).write.mode("overwrite").partitionBy("lane").json(path)


#: Documents that one manifest or sample file may list, as a person reviews it.
LISTED = 100_000


def listed(rows: DataFrame, what: str) -> list:
    """The rows of a file that is written in one piece; more than LISTED are an error."""
    out = rows.limit(LISTED + 1).collect()
    if len(out) > LISTED:
        raise ValueError(f"{what} of more than {LISTED} documents: write it in parts (write_manifest)")
    return out


def write_manifest(entries: DataFrame, path: str) -> None:
    """A manifest of any size: its entries as JSON lines."""
    entries.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def manifest(entries: DataFrame, description: str, compatibility: dict, stats: dict | None = None, version: int = 1) -> dict:
    """The manifest of a release in one piece."""
    out = {"version": version, "description": description, "documents": [json.loads(r) for (r,) in listed(entries.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})), "a manifest")], "category_compatibility": compatibility}
    return out | ({"build_stats": stats} if stats else {})


def sample_record(chosen: DataFrame, seed: int, requested: int, excluded_from: str | None = None) -> dict:
    """What a sample was drawn by; doc_ids in order."""
    ids = sorted(r.doc_id for r in listed(chosen.select("doc_id"), "a sample"))
    by = {r["source"]: r["n"] for r in chosen.groupBy("source").agg(F.count("*").alias("n")).collect()}
    return {"seed": seed, "n_requested": requested, "n_selected": len(ids), "doc_ids": ids, "excluded_from": excluded_from, "sources_breakdown": by}


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file through Spark's file systems."""
    put_bytes(spark, path, text.encode())


def _place(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of Hadoop."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _place(spark, path)
    out = fs.create(p, True)
    try:
        for i in range(0, len(data), 1 << 20):
            out.write(bytearray(data[i : i + (1 << 20)]))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file through Spark's file systems; None if there is none."""
    fs, p = _place(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


#: Attempts to write the next version of a file that others write too.
ATTEMPTS = 100


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is not there yet, whole or not at all; False if another writer was first."""
    fs, p = _place(spark, path)
    part = f"{path}.{uuid.uuid4().hex}"
    if fs.getUri().getScheme() == "file":  # a link is made once; renaming would replace
        name, part = (fs.makeQualified(_place(spark, x)[1]).toUri().getPath() for x in (path, part))
        os.makedirs(os.path.dirname(name), exist_ok=True)
        with open(part, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(part, name)
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
        return True
    put_text(spark, part, text)
    sc = spark.sparkContext
    never = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), sc._jsc.hadoopConfiguration()).rename(_place(spark, part)[1], p, never)
    except Py4JJavaError as e:
        fs.delete(_place(spark, part)[1], False)
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def latest(spark: SparkSession, path: str) -> tuple[int, str]:
    """The newest version of a file that is written version by version (path.v1, path.v2, ...) and its text; (0, '') if there is none."""
    fs, p = _place(spark, f"{path}.v*")
    names = [f.getPath().getName() for f in fs.globStatus(p) or ()]
    n = max((int(x) for name in names if (x := name.rsplit(".v", 1)[1]).isdigit()), default=0)
    return n, get_text(spark, f"{path}.v{n}") or "" if n else ""


def commit(spark: SparkSession, path: str, change: Callable[[str], str]) -> str:
    """Write the next version of a file: change makes it from the newest one, again if another writer came between."""
    for _ in range(ATTEMPTS):
        n, text = latest(spark, path)
        text = change(text)
        if put_new(spark, f"{path}.v{n + 1}", text):
            return text
    raise OSError(f"{path} is written by others all the time")


def stage_state(spark: SparkSession, path: str) -> dict:
    return json.loads(latest(spark, path)[1] or "{}")


def mark_stage(spark: SparkSession, path: str, stage: str, **info) -> dict:
    """Note in the state file that a stage is complete; marks that others set meanwhile stay."""
    done = {stage: {"status": "complete", "completed_at": datetime.now(UTC).isoformat(), **info}}
    return json.loads(commit(spark, path, lambda text: json.dumps(json.loads(text or "{}") | done, indent=2)))


def stage_done(spark: SparkSession, path: str, stage: str) -> bool:
    return stage_state(spark, path).get(stage, {}).get("status") == "complete"


def write_files(rows: DataFrame, root: str, name: str, data: str = "data", key: str = "doc_id", once: bool = False, folders: int = 0) -> DataFrame:
    """Write the bytes of each row to root/key/name (a URI or path that executors share); key, path, length.

    Rows without bytes write nothing.  once: a file that is there already stays.  folders: to root/number/key.name, of so
    many numbers by a hash of the key, so that no folder has more entries than a task can list.
    """
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("path", T.StringType()), T.StructField("length", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)
        made = set()
        for b in batches:
            out = []
            for k, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if x is None:
                    continue
                safe = k.translate({47: 95, 92: 95})
                folder, file = (f"{base.rstrip('/')}/{zlib.crc32(k.encode()) % folders}", f"{safe}.{name}") if folders else (f"{base.rstrip('/')}/{safe}", name)
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made |= {folder} if folders else set()
                if once and fs.get_file_info(f"{folder}/{file}").type == pafs.FileType.File:
                    out.append((k, f"{folder}/{file}", fs.get_file_info(f"{folder}/{file}").size))
                    continue
                part = f"{folder}/.{file}.{uuid.uuid4().hex}"  # it gets its name whole, so an attempt that runs again harms nothing
                with fs.open_output_stream(part, compression=None) as f:
                    f.write(x)
                fs.move(part, f"{folder}/{file}")
                out.append((k, f"{folder}/{file}", len(x)))
            cols = list(zip(*out, strict=True)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=schema.names)

    return rows.select(F.col(key).cast("string"), data).mapInArrow(run, schema)


def png(image: np.ndarray) -> bytes:
    """An 8-bit grey or RGB raster as a PNG file."""
    h, w = image.shape[:2]
    rows = np.ascontiguousarray(image, np.uint8).reshape(h, -1)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rows], 1).tobytes()
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def image_pdf(pages: list[np.ndarray], dpi: int = 150, titles: list[str] | None = None) -> bytes:
    """A PDF with a page for each RGB raster and a bookmark for each title."""
    return image_pages(pages, dpi, titles)
