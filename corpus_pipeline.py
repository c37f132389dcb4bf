"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of documents.

Defined cases, of every stage: rows may have nulls in any column, repeat each
other, share a doc_id or lack one; texts may be empty or very long; docs and
benchmark may be empty; docs may have more columns, of any names and types,
which all stages but the last pass on.  Where a stage changes a text it counts
n_chars anew if that holds whole numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.bpe import bpe_documents
from quire.llm.common import read_table, stored
from quire.llm.decontaminate import drop_leaks
from quire.llm.quality import clean_lines
from quire.llm.simhash import keep_one
from quire.llm.suffix import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines.

    A null or empty text has no words and goes; equal rows fare alike.
    """
    return clean_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Rows without a doc_id come last in their group; of rows that share a doc_id the one whose columns have the least
    hash stays, so that a run again keeps the same; documents without words are one group.
    """
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of any 200-byte string that occurs twice.

    All rows stay; a null text becomes empty, a text shorter than that keeps all, and one that occurs twice and is as
    long loses all; bytes that no longer make a character are left out.
    """
    return remove_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; items without words count for nothing.
    """
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded, one row for each row of docs; a null text has no ids and decodes to ''."""
    return bpe_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]

#: SimHash components, suffix arrays and BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
