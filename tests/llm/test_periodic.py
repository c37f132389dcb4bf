"""Periodic runs against trying every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import periodic
from tests.llm.test_operators import LONG, ODD, SF, odd, table


def slow_runs(w):
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(24, 3 * q):
                out.setdefault((s, i + q - s), q)
    return sorted(((s, k, q) for (s, k), q in out.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def slow_row(doc_id, text, runs_of=slow_runs):
    w = words_of(text or "")
    n = len(w)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_of(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)))


def random_text(rng):
    t = []
    for _ in range(rng.randint(0, 6)):
        m, letters = rng.choice([1, 2, 3, 10, 40]), rng.choice([1, 2, 3, 50])
        t += [rng.randrange(letters) for _ in range(m)] * rng.choice([1, 1, 2, 3, 5, 12, 30])
        if rng.random() < 0.3:
            t = t + t[-rng.randint(1, 20) :]
    return np.array(t, np.int64)


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        texts = [random_text(rng) for _ in range(rng.randint(1, 4))]
        assert periodic.find_runs(texts) == [slow_runs(t.tolist()) for t in texts]


def test_small_trees_and_blocks_of_leaves_change_nothing(monkeypatch):
    rng = random.Random(6)
    texts = [random_text(rng) for _ in range(100)]
    want = periodic.find_runs(texts)
    monkeypatch.setattr(periodic, "TREE_WORDS", 50)
    monkeypatch.setattr(periodic, "LEAVES", 7)
    assert periodic.find_runs(texts) == want


def test_clashing_hashes_cost_nothing_but_time(monkeypatch):
    rng = random.Random(7)
    texts = [random_text(rng) for _ in range(40)]
    want = [slow_runs(t.tolist()) for t in texts]
    monkeypatch.setattr(periodic._Hashes, "windows", lambda self, size: np.zeros(len(self.sums) - size, np.uint64))
    assert periodic.find_runs(texts) == want


@pytest.mark.parametrize("x", [np.zeros(100_000, np.int64), np.tile(np.arange(5000), 20), np.arange(100_000)])
def test_long_texts(x):
    n = len(x)
    period = 1 if not x.any() else 5000
    assert periodic.find_runs([x]) == [[] if x[-1] == n - 1 else [(0, n, period)]]


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(8)
    for letters in (1, 2, 5):
        x = np.concatenate([rng.integers(0, letters, 60), [100]])
        sa, rank, common = periodic.suffix_array(x)
        order = sorted(range(len(x)), key=lambda i: x[i:].tolist())
        assert sa.tolist() == order and rank[sa].tolist() == list(range(len(x)))
        for k in range(1, len(x)):
            a, b = x[order[k - 1] :].tolist(), x[order[k] :].tolist()
            assert common[k] == next(i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q)


def test_odd_rows(spark):
    rows = [*ODD, (24, "a " * 30), (28, "x y\tz\n" * 12 + "end"), (None, "b\x0b" * 25), (31, "a\xa0a " * 40), (37, LONG), (12, None), (65, None), (9, "")]
    docs = periodic.with_tails(table(spark, rows))
    assert docs.count() == len(rows)
    got = {(r.doc_id, r.n_words, r.collapsed, tuple(map(tuple, r.runs))) for r in periodic.periodic_runs(table(spark, rows, ("runs", "n_words"))).collect()}
    for i, t in rows:
        w = words_of(t or "")
        if len(w) < 1000:
            runs = slow_runs(w)
            gone = {k for s, n, q in runs for k in range(s + q, s + n)}
            assert (i, len(w), " ".join(x for k, x in enumerate(w) if k not in gone), tuple(runs)) in got
    assert periodic.periodic_runs(odd(spark).where("false")).count() == 0


def test_op13_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: slow_row(r.doc_id, r.text) for r in docs if len(r.text or "") < 20_000}
    got = {r.doc_id: tuple(r) for r in periodic.op13_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 5
    for i, row in want.items():
        assert got[i] == row
