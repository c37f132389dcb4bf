"""Periodic runs of words: stretches that repeat themselves, and texts without the repetitions.

A run is a stretch of words with smallest period q (words q apart are equal)
and at least ``max(24, 3 q)`` words that no neighbour extends.  Texts are taken
in batches, in Arrow, and nothing is shuffled.

1. What can hold a run.  In a run each 16 words but the last period's occur
   again, q words on; so only stretches covered by 16-word strings that occur
   twice in their text are looked at (a hash decides; a clash costs time only).
2. Suffix tree.  These stretches, each with an end of its own, get a suffix
   array by prefix doubling and common prefixes from the ranks of its rounds.
   Their nesting is the suffix tree with nodes of more than two children taken
   apart: every place between two neighbours of the array joins two leaf lists
   at the depth of their common prefix.
3. Branching tandem repeats, as Stoye and Gusfield find them: for each leaf i of
   the smaller list and depth d, i + d or i - d in the other list means that the
   two suffixes agree on exactly d words, so that a square of period d stands
   there which the word behind it does not continue.  Each leaf is in a smaller
   list at most log2(n) times.
4. Runs.  Such a square is the last of its run; rotating it to the left, word by
   word, gives the others and at last the run's start.  How far is bisected by
   hashes and then compared word by word.  Squares whose root is itself periodic
   end in the same run, which keeps its smallest period.

Memory is a few hundred bytes for each word of step 1, of one batch (4 MB of
text) or one longer text.

Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; words are parted by ASCII white space only; repeated rows and
rows without doc_id get a row each; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import read_table, small_batches

LEAST, PERIODS = 24, 3
#: Words of the strings that must occur twice: a run has LEAST words or PERIODS periods, so that many at least stand before their copy.
GRAM = 16
#: Words that share one suffix tree, leaves that are looked at together.
TREE_WORDS, LEAVES = 1 << 18, 1 << 20
WORDS = re.compile("[^ \t-\r]+").findall
WORD_GAPS = r"[ \t-\r]+"
_BASE = 0x9E3779B97F4A7C15
_MIXED = np.uint64(0xBF58476D1CE4E5B9)

Runs = list[tuple[int, int, int]]


class _Hashes:
    """Equality of stretches of an array by 64-bit hashes."""

    def __init__(self, x: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            steps = np.full(len(x) + 1, np.uint64(_BASE))
            steps[0] = 1
            self.up = np.cumprod(steps)
            self.sums = np.zeros(len(x) + 1, np.uint64)
            mixed = (x.astype(np.uint64) + np.uint64(1)) * _MIXED
            mixed ^= mixed >> np.uint64(31)
            np.cumsum(mixed * self.up[:-1], out=self.sums[1:])

    def windows(self, size: int) -> np.ndarray:
        """A hash of the stretch of so many words at each place."""
        with np.errstate(over="ignore"):
            return (self.sums[size:] - self.sums[:-size]) * self.up[::-1][: len(self.up) - size]

    def same(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Whether words a to b equal those d on."""
        with np.errstate(over="ignore"):
            return (self.sums[b] - self.sums[a]) * self.up[d] == self.sums[b + d] - self.sums[a + d]


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def suspects(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the stretches covered by GRAM-word strings that occur twice in their text.

    ends: where each text ends in x.
    """
    n = len(x)
    none = np.empty(0, np.int64)
    if n < LEAST:
        return none, none
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    begin = np.flatnonzero(text[: n - GRAM + 1] == text[GRAM - 1 :])
    with np.errstate(over="ignore"):
        h = _Hashes(x).windows(GRAM)[begin] + text[begin].astype(np.uint64) * _MIXED
    order = np.argsort(h)
    s = h[order]
    equal = s[1:] == s[:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    at = begin[twice]
    if not len(at):
        return none, none
    # strings that overlap, of one text, make a stretch
    first = np.concatenate([[True], (at[1:] > at[:-1] + GRAM) | (text[at[1:]] != text[at[:-1]])])
    starts = at[first]
    lengths = at[np.concatenate([first[1:], [True]])] + GRAM - starts
    long = lengths >= LEAST
    return starts[long], lengths[long]


def suffix_array(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, the rank of each, the common prefix of each with the one before it in order); no two suffixes are equal.

    Prefix doubling: suffixes ordered by h words are ordered by 2 h words through the rank h words on; those that
    stand alone are done.  The ranks of each round tell whether 2^round words agree, so they add up to common prefixes.
    """
    n = len(x)
    sa = np.argsort(x, kind="stable")
    k = x[sa]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rounds, h = [rank.astype(np.int32)], 1
    while True:
        open_ = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
        if not len(open_):
            break
        sub = sa[open_]
        second = np.where(sub + h < n, rank[np.minimum(sub + h, n - 1)] + 1, 0)
        key = rank[sub] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sa[open_] = sub = sub[order]
        key = key[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[open_] = fresh
        rank[sub] = np.maximum.accumulate(np.where(fresh, open_, 0))
        rounds.append(rank.astype(np.int32))
        h *= 2
    a, b = sa[:-1].copy(), sa[1:].copy()
    common = np.zeros(n, np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        inside = inside[rounds[level][a[inside]] == rounds[level][b[inside]]]
        a[inside] += 1 << level
        b[inside] += 1 << level
        common[inside + 1] += 1 << level
    return sa, rank, common


def leaf_lists(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place k of the suffix array, the start of the leaf list that ends at k and the end of the one that begins there.

    The two lists are children of one node at depth common[k]; of a node's many children those on the left are joined first.
    """
    depth = common.tolist()
    n = len(depth)
    left, right, stack = [0] * n, [n] * n, [0]
    for k in range(1, n):
        d = depth[k]
        while len(stack) > 1 and depth[stack[-1]] >= d:
            right[stack.pop()] = k
        left[k] = stack[-1]
        stack.append(k)
    return np.array(left), np.array(right)


def branching_squares(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares of period most or less that the word behind them does not continue."""
    sa, rank, common = suffix_array(x)
    left, right = leaf_lists(common)
    n = len(x)
    k = np.flatnonzero((common >= 1) & (common <= most))
    left, right = left[k], right[k]
    on_left = k - left <= right - k
    start, size = np.where(on_left, left, k), np.where(on_left, k - left, right - k)
    low, high = np.where(on_left, k, left), np.where(on_left, right, k)  # the other list
    depth = common[k]
    starts, periods = [], []
    edge = np.searchsorted(np.cumsum(size), np.arange(LEAVES, size.sum() + LEAVES, LEAVES), "right") if len(k) else []
    a = 0
    for e in sorted({*np.asarray(edge, int).tolist(), len(k)}):
        if e == a:
            continue
        part = slice(a, e)
        a = e
        i = sa[_places(start[part], size[part])]
        d, lo, hi = (np.repeat(v[part], size[part]) for v in (depth, low, high))
        for first, other in ((i, i + d), (i - d, i - d)):
            ok = (other >= 0) & (other < n)
            r = rank[np.where(ok, other, 0)]
            ok &= (r >= lo) & (r < hi)
            starts.append(first[ok])
            periods.append(d[ok])
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.empty(0, np.int64),) * 2


def _runs(x: np.ndarray, longest: int) -> Runs:
    """(start, length, period) of all runs of x, in which equal stretches of length LEAST have ends of their own."""
    start, period = branching_squares(x, longest // PERIODS)
    hashes = _Hashes(x)
    # the run reaches back that far at least
    need = np.maximum(LEAST, PERIODS * period) - 2 * period
    ok = start >= need
    start, period, need = start[ok], period[ok], need[ok]
    ok = hashes.same(start - need, start, period)
    start, period = start[ok], period[ok]
    low, high = np.zeros(len(start), np.int64), start.copy()  # the least start for which all words agree
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) // 2
        same = hashes.same(middle, start[open_], period[open_])
        high[open_[same]] = middle[same]
        low[open_[~same]] = middle[~same] + 1
    order = np.lexsort((period, start + 2 * period, low))
    out: Runs = []
    seen = (-1, -1)
    for s, e, q in zip(low[order].tolist(), (start + 2 * period)[order].tolist(), period[order].tolist(), strict=True):
        if (s, e) != seen:  # else of a larger period
            differ = np.flatnonzero(x[s : e - q] != x[s + q : e])
            if len(differ):  # hashes clashed
                s += int(differ[-1]) + 1
            if e - s >= max(LEAST, PERIODS * q):
                out.append((s, e - s, q))
            seen = (s, e)
    return out


def find_runs(texts: list[np.ndarray]) -> list[Runs]:
    """The runs of each text, given as numbers of its words, by start, then period."""
    out: list[Runs] = [[] for _ in texts]
    ends = np.cumsum([len(t) for t in texts])
    x = np.concatenate(texts) if texts else np.empty(0, np.int64)
    starts, lengths = suspects(x, ends)
    top = int(x.max()) + 1 if len(x) else 0
    a = 0
    while a < len(starts):
        e = max(a + 1, int(np.searchsorted(np.cumsum(lengths[a:]), TREE_WORDS)) + a)
        s, n = starts[a:e], lengths[a:e]
        a = e
        close = np.cumsum(n + 1) - 1  # where the ends of the stretches lie
        at = _places(s, n + 1)
        part = x[np.minimum(at, len(x) - 1)]
        part[close] = top + np.arange(len(close))
        for begin, length, period in _runs(part, int(n.max())):
            place = int(at[begin])
            t = int(np.searchsorted(ends, place, "right"))
            out[t].append((place - (int(ends[t - 1]) if t else 0), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def collapsed(words: list[str], runs: Runs) -> str:
    """The words, but of each run only the first period, joined by one space."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return " ".join(words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed."""
    run_type = pa.list_(pa.struct([pa.field(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            words = [WORDS(t or "") for t in b.column(1).to_pylist()]
            number = _Numbers().__getitem__
            runs = find_runs([np.fromiter(map(number, w), np.int64, len(w)) for w in words])
            lists = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs], run_type)
            texts = pa.array(map(collapsed, words, runs), pa.string(), size=len(words))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, words), pa.int64(), size=len(words)), lists, texts], names=["doc_id", "n_words", "runs", "collapsed"])

    found = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
    out = [docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("runs", found), T.StructField("collapsed", T.StringType())]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(out))


def with_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: texts whose doc_id has a CRC-32 that ends in 0 repeat themselves from some word on, as the contract of op13 says."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def tail(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")

    words = F.filter(F.split("text", WORD_GAPS), lambda w: w != "")
    periodic = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(""))[0]
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_tails(read_table(spark, sf_dir, "documents")))
    # runs come by start, then period, so of equal ones the first stays
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
