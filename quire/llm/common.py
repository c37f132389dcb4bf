"""Helpers that the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Used only where the session names no checkpoint folder (tests, local runs).
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints"

#: The white space that separates words; every other character belongs to a word.
SPACES = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder (URI) in the folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or LOCAL_CHECKPOINTS
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, each with as many underscores before it as make it unlike every column of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"__{name}"
        while any(c.startswith(name) for c in taken):
            name = f"_{name}"
        out.append(name)
    return out


def recounted(df: DataFrame) -> int | None:
    """Where n_chars stands if it holds whole numbers, which a changed text makes wrong."""
    at = df.columns.index("n_chars") if "n_chars" in df.columns else None
    return at if at is not None and isinstance(df.schema[at].dataType, (T.LongType, T.IntegerType)) else None


def small_batches(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the bytes of one column stay near max_bytes; a longer row stays alone."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(column)
        if col.nbytes <= max_bytes:
            yield batch
            continue
        start, size = 0, 0
        lengths = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        for i, k in enumerate(lengths):
            if size and size + k > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += k
        yield batch.slice(start, n - start)
