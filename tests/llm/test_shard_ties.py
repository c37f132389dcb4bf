"""Shards of tables whose rows repeat."""

import collections

import pytest
from pyspark.sql import functions as F

from quire.llm import shard
from tests.llm.test_operators import SF, table


def repeated(spark, doc_id):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(200).withColumn("text", F.substring("text", 1, 40))
    return docs.union(spark.range(0, 1000, 1, 4).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit("one text for all of them").alias("text")))


@pytest.mark.parametrize("doc_id", [None, 77])
def test_repeated_rows_are_dealt_evenly(spark, doc_id):
    d = repeated(spark, doc_id)
    rows = shard.shard_documents(d).select("doc_id", "size", "shard", "slot").collect()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    total, most = sum(size.values()), max(r.size for r in rows)
    assert len(rows) == d.count() and all(abs(size[s] - total / 16) <= most for s in range(16))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    # and no task numbers all of them
    cells = len({(r.shard, r.slot * 4 // len(slots[r.shard])) for r in rows if r.size == 25})
    assert cells > 30


def test_repeated_rows_equal_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    d = repeated(spark, None).union(table(spark, [(5, None), (5, None), (None, ""), (6, "ü" * 700)]).select("doc_id", "text"))
    d.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = shard.op1_shard(spark, str(tmp_path))
    want = con.sql(shard.ORACLE_SQL)
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))
