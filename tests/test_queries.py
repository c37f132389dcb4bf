"""Every query with SQL gives the rows that DuckDB gives."""

import os

import duckdb
import pytest

import quire.file_queries
import quire.page_queries  # noqa: F401
from quire.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted(tuple(repr(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    cur = duck.sql(ORACLE_SQL[name])
    want = rows([c[0] for c in cur.description], cur.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_results_do_not_depend_on_partitions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from quire.operators import corpus, manifest

    one, many = docs.coalesce(1), docs.repartition(7)
    for f in (lambda d: corpus.sample_uniform(d, 20, 1).select("doc_id"), lambda d: manifest.sample(d, 33, 1), lambda d: corpus.assign_splits(d.select("source", "doc_id"), 1)):
        assert sorted(map(tuple, f(one).collect())) == sorted(map(tuple, f(many).collect()))
