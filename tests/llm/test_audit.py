"""The filter audit against counting order by order."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from quire.llm import audit
from tests.llm.test_operators import DOCS, LONG, SF, WORDS

GOOD = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, GOOD, "en"), (2, GOOD, "de"), (2, GOOD, "en"), (None, GOOD, "en"), (None, GOOD, None), (3, GOOD, ""), (4, None, None), (5, "", "en"), (6, " \t\n", "en"), (7, LONG, "de"), (7, LONG, "de"),
    (8, "A $ B", "en"), (9, WORDS * 9, "fr"), (10, GOOD.upper(), "fr"), (11, GOOD + " #", "fr"), (12, "日本 \x00 ÀÉ", "ja"), (None, None, "ja"), (13, "a\x0bb\x0cc\x1cd", "ja"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (5, 1, 1), (8, None, 1), (99, 1, 1), (None, 1, 1), (10, 1, 0), (11, 1, 1)]


def tables(spark, rows=ROWS):
    docs = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], DOCS).withColumn("mask", F.lit("x")).withColumn("n", F.lit(1))
    return docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit(0))


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def slow(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails = []
    for i, t, lang in rows:
        t = t or ""
        w = words_of(t)
        f = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > least[t],
        }
        fails.append((i, lang or "", {k for k in f if f[k]}))
    out = {}
    for part in {p for _, p, _ in fails}:
        own = [(i, f) for i, p, f in fails if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for k, x in enumerate(order):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                total[x] += len(gone)
                all_ = [f for _, f in own if x in f]
                out[part, order, k + 1] = [len(left), len(gone), len(all_) - len(gone), sum(f == {x} for f in all_), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x]
        for key, v in out.items():
            if key[0] == part:
                v[-1] = total[v[-1]]
    return out


def test_audit_equals_counting(spark):
    docs, labels = tables(spark)
    got = audit.audit(docs, labels).collect()
    assert len(got) == 600 * 5
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got} == slow(ROWS, LABELS)


def test_empty_tables(spark):
    docs, labels = tables(spark)
    assert audit.audit(docs.where("false"), labels).count() == 0
    rows = audit.audit(docs, labels.where("false")).collect()
    assert len(rows) == 3000 and not any(r.good_lost or r.toxic_lost for r in rows)


def test_the_transform_is_inverted_exactly(spark):
    counts = [(7 * m * m) % 11 for m in range(32)]
    sums = [sum(n * (-1) ** bin(m & s).count("1") for m, n in enumerate(counts)) for s in range(32)]
    assert spark.createDataFrame([(sums,)], "s array<long>").select(audit.cells(F.col("s")).alias("c")).first().c == counts


@pytest.mark.parametrize("sf", [SF])
def test_op12_equals_sql(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = audit.op12_filter_audit(spark, sf)
    want = con.sql(audit.ORACLE_SQL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
