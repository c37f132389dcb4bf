"""Toxicity: Levenshtein automata over a learned lexicon, read in context.

From a bounded sample of labelled documents (``SAMPLE`` of each class at most,
by a hash of doc_id) the lexicon is learned: whole words and word beginnings
whose documents are toxic far more often than clean.  Terms stand in a trie;
its product with the Levenshtein automaton of distance 1 runs as one automaton
whose states are built when first met, so a misspelled term is caught in one
walk over the word.  Words that clean documents use are no misspellings.

A document's hits are then read in context: hits inside quotation marks or
behind a reporting word count for less, hits near other hits for more.  A
logistic regression on these few features gives the score.  It is fitted on the
sample, each document read with a lexicon to which its own part of the sample
did not add.

Defined cases: a null or empty text has no hits and gets the score of a text
without hits; where nothing can be learned every score is 0; repeated rows get
equal results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import read_table, small_batches, stored
from quire.llm.language import held_out, sampled

SAMPLE = 6000
#: Parts of the sample that learn for each other.
PARTS = 5
TERMS = 4000
MIN_TOXIC = 5
MIN_WEIGHT = 1.8
STEMS = (3, 4, 5, 6, 7, 8)
#: Letters from which on a term is caught misspelled, and from which on whatever the edit; below that the first letter must stand and none be missing.
FUZZY_LENGTH, FUZZY_FREELY = 4, 5
FUZZY_WEIGHT = 0.8
QUOTED = 0.35
NEAR = 12
THRESHOLD = 0.7
CACHED_WORDS = 300_000
CACHED_STATES = 60_000

_tokens = re.compile(r"\w[\w@$*]*").findall
#: Words that report what someone else said.
REPORTING = frozenset("said says wrote writes called quoted quote quotes reported dit écrit cite sagte schrieb zitiert dijo escribió citó".split())
_OPEN, _CLOSE = "“«„", "”»"


def tokens_of(text: str | None) -> list[str]:
    return _tokens((text or "").lower())


def bare(token: str) -> str:
    return token.rstrip("@$*")


class FuzzyTrie:
    """All terms within one edit of a word, by a lazily built product of trie and Levenshtein automaton."""

    def __init__(self, terms: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for t in terms:
            node = 0
            for c in t:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][c]
            self.term[node] = t
        self._reset()

    def _reset(self) -> None:
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.number: dict[frozenset, int] = {}
        self.start = self._state(self._close({(0, 0)}))

    def _close(self, pairs: set[tuple[int, int]]) -> frozenset:
        """With edits left, a term's letter may be missing from the word."""
        out = set(pairs)
        for node, edits in pairs:
            if edits == 0:
                out.update((n, 1) for n in self.children[node].values())
        return frozenset(out)

    def _state(self, s: frozenset) -> int:
        if s not in self.number:
            self.number[s] = len(self.sets)
            self.sets.append(s)
            self.moves.append({})
        return self.number[s]

    def _step(self, state: int, c: str) -> int:
        to: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            if (n := self.children[node].get(c)) is not None:
                to.add((n, edits))
            if edits == 0:
                to.add((node, 1))  # one letter too many
                to.update((n, 1) for n in self.children[node].values())  # another letter
        return self._state(self._close(to)) if to else -1

    def find(self, word: str) -> list[str]:
        if len(self.sets) > CACHED_STATES:
            self._reset()
        state = self.start
        for c in word:
            moves = self.moves[state]
            nxt = moves.get(c)
            if nxt is None:
                nxt = moves[c] = self._step(state, c)
            if nxt < 0:
                return []
            state = nxt
        return sorted({self.term[n] for n, _ in self.sets[state] if self.term[n]})


class Matcher:
    """The best lexicon match of each word: (weight, term), or None."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], clean: frozenset[str], cached: int = CACHED_WORDS) -> None:
        self.words, self.stems, self.clean, self.cached = words, stems, clean, cached
        self.fuzzy = FuzzyTrie(sorted(w for w in words if len(w) >= FUZZY_LENGTH))
        self.known: set[str] = set()
        self.hits: dict[str, tuple[float, str]] = {}

    def match(self, token: str) -> tuple[float, str] | None:
        w = bare(token)
        found = [(self.words[w], w)] if w in self.words else []
        found += [(self.stems[w[:k]], w[:k] + "-") for k in STEMS if len(w) > k and w[:k] in self.stems]
        if not found and len(w) >= FUZZY_LENGTH and w not in self.clean:
            found = [(FUZZY_WEIGHT * self.words[t], t) for t in self.fuzzy.find(w) if len(t) >= FUZZY_FREELY or (w[0] == t[0] and len(w) >= len(t))]
        return max(found, default=None)

    def hits_in(self, tokens: list[str]) -> set[str]:
        distinct = set(tokens)
        fresh = distinct.difference(self.known)
        if fresh:
            if len(self.known) > self.cached:
                self.known.clear()
            for t in fresh:
                if m := self.match(t):
                    self.hits[t] = m
            self.known |= fresh
        return {t for t in distinct if t in self.hits} if len(distinct) < len(self.hits) else distinct & self.hits.keys()


N_FEATURES = 9
#: So many of them, the first, are evidence of toxicity, which never lowers a score.
EVIDENCE = 7


def features(text: str | None, matcher: Matcher) -> list[float]:
    tokens = tokens_of(text)
    hot = matcher.hits_in(tokens)
    if not hot:
        return [0.0] * N_FEATURES
    where = [i for i, t in enumerate(tokens) if t in hot]
    quoted = _quoted(text.lower(), hot)
    seen: Counter = Counter()
    each, near, reported = [], 0, 0
    for k, i in enumerate(where):
        t = tokens[i]
        q = seen[t] in quoted.get(t, ()) or not REPORTING.isdisjoint(tokens[max(0, i - 3) : i])
        seen[t] += 1
        reported += q
        weight, term = matcher.hits[t]
        each.append((weight * (QUOTED if q else 1.0), term))
        near += (k > 0 and i - where[k - 1] <= NEAR) or (k + 1 < len(where) and where[k + 1] - i <= NEAR)
    best: dict[str, float] = {}
    for w, t in each:
        best[t] = max(best.get(t, 0.0), w)
    own = sum(w for w, _ in each)
    # terms that clean texts use now and then: so many hits are evidence in so long a text only if there are more than it explains
    return [
        max(best.values()), min(30.0, sum(best.values())), math.log1p(own), min(5.0, 10 * own / len(tokens)), math.log1p(len(best)), near / len(where), own / math.sqrt(len(tokens)),
        reported / len(where), math.log1p(len(tokens)),
    ]


def _quoted(text: str, hot: set[str]) -> dict[str, set[int]]:
    """Of each hit word, which of its occurrences stand between quotation marks of their line."""
    out: dict[str, set[int]] = {}
    if '"' not in text and not any(c in text for c in _OPEN):
        return out
    count: Counter = Counter()
    for line in text.split("\n"):
        inside = False
        for m in re.finditer(r'["“«„”»]|\w[\w@$*]*', line):
            s = m[0]
            if s == '"':
                inside = not inside and '"' in line[m.end() :]
            elif s in _OPEN:
                inside = True
            elif s in _CLOSE:
                inside = False
            elif s in hot:
                if inside:
                    out.setdefault(s, set()).add(count[s])
                count[s] += 1
    return out


class ToxicityModel:
    def __init__(self, matcher: Matcher | None, mean=None, scale=None, weights=None, bias: float = 0.0) -> None:
        self.matcher, self.mean, self.scale, self.weights, self.bias = matcher, mean, scale, weights, bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.matcher is None:
            return np.zeros(len(texts))
        x = np.array([features(t, self.matcher) for t in texts]).reshape(len(texts), N_FEATURES)
        return 1 / (1 + np.exp(-np.clip((x - self.mean) / self.scale @ self.weights + self.bias, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Weights that do not fall below 0 for the first features: more evidence never lowers a score."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    scale[x.std(0) < 1e-9] = 1.0
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    free = np.ones(z.shape[1], bool)
    w = np.zeros(z.shape[1])
    for _ in range(N_FEATURES + 1):
        w = np.where(free, w, 0.0)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            pen = np.r_[np.full(z.shape[1] - 1, ridge), 1e-6]
            g = z.T @ (p - y) + pen * w
            h = (z * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ z + np.diag(pen)
            step = np.zeros_like(w)
            step[free] = np.linalg.solve(h[np.ix_(free, free)], g[free])
            w -= step / max(1.0, np.abs(step).max() / 4)
            if np.abs(step).max() < 1e-6:
                break
        low = np.flatnonzero(w[:EVIDENCE] < -1e-9)
        if not len(low):
            break
        free[low] = False
    return mean, scale, w[:-1], float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, text, toxic, part of the sampled labelled documents; the label sample is broadcast, being bounded."""
    one = labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = sampled(one, "toxic", F.col("doc_id"), SAMPLE)
    few = few.select("doc_id", "toxic", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int").alias("part"))
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(few), "doc_id").select("text", "toxic", "part")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents of each part each word and word beginning occurs; '' counts the documents."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        keys = list(zip(*counts.keys(), strict=True)) if counts else [(), (), ()]
        kinds = (pa.string(), pa.int32(), pa.bool_())
        out = pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(keys, kinds, strict=True)), pa.array(counts.values(), pa.int64())], names=["term", "part", "toxic", "n"])
        counts.clear()
        return out

    for b in small_batches(batches, 0):
        for text, label, part in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            words = {w for t in set(tokens_of(text)) if not (w := bare(t)).isdigit()}
            own = words | {w[:k] + "-" for w in words for k in STEMS if len(w) > k} | {""}
            counts.update((t, part, label > 0) for t in own)
        if len(counts) > 200_000:
            yield flush()
    yield flush()


def _lexicon(counts: DataFrame, without: int | None) -> tuple[dict, dict, frozenset] | None:
    """(words, stems, clean words one edit from a word) learned from all parts but one; None if there is nothing to learn.

    counts: term, and t0, c0, t1, ... of each part.
    """
    seen = lambda kind: sum((F.col(f"{kind}{k}") for k in range(PARTS) if k != without), F.lit(0))
    both = counts.select("term", seen("t").alias("t"), seen("c").alias("c"))
    total = both.where("term = ''").first()
    if total is None or not total.t or not total.c:
        return None
    weight = F.log((F.col("t") + 0.5) / (total.t + 1)) - F.log((F.col("c") + 0.5) / (total.c + 1))
    terms = both.where(f"term <> '' and t >= {MIN_TOXIC} and length(term) >= 3 and octet_length(term) <= 64").withColumn("w", weight)
    found = terms.where(F.col("w") >= MIN_WEIGHT).orderBy(F.desc(F.col("w") * F.log1p("t")), "term").limit(TERMS).collect()
    if not found:
        return None
    words = {r.term: r.w for r in found if not r.term.endswith("-")}
    stems = {r.term[:-1]: r.w for r in found if r.term.endswith("-")}
    trie_words = sorted(w for w in words if len(w) >= FUZZY_LENGTH)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = FuzzyTrie(trie_words)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([w for w in b.column(0).to_pylist() if trie.find(w)], pa.string())], names=["word"])

    # at most the words one edit from a term that the sample's clean documents use
    clean = both.where("c > 0 and term <> '' and not endswith(term, '-')").select("term").mapInArrow(near, "word string")
    return words, stems, frozenset(r.word for r in clean.collect())


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> ToxicityModel:
    """The lexicon comes from all sampled documents; the regression sees each with the lexicon of the other parts, as it will see new ones."""
    rows = stored(labelled(docs, labels, learn), "toxic-sample")
    counts = rows.mapInArrow(_word_counts, "term string, part int, toxic boolean, n long")
    of = lambda k, toxic: F.coalesce(F.sum(F.when((F.col("part") == k) & (F.col("toxic") == toxic), F.col("n"))), F.lit(0))
    counts = counts.groupBy("term").agg(*(of(k, toxic).alias(f"{'t' if toxic else 'c'}{k}") for k in range(PARTS) for toxic in (True, False)))
    counts = stored(counts, "toxic-terms")
    whole = _lexicon(counts, None)
    if whole is None:
        return ToxicityModel(None)
    shared = docs.sparkSession.sparkContext.broadcast([_lexicon(counts, k) for k in range(PARTS)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [x and Matcher(*x, cached=CACHED_WORDS // PARTS) for x in shared.value]
        for b in small_batches(batches, 0):
            x = [features(t, matchers[k]) if matchers[k] else [0.0] * N_FEATURES for t, k in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1).cast(pa.int32())], names=["x", "toxic"])

    found = rows.mapInArrow(measure, "x array<double>, toxic int").collect()
    y = np.array([float(r.toxic > 0) for r in found])
    if len(set(y.tolist())) < 2:
        return ToxicityModel(None)
    # classes count alike as they do in the sample; order must not matter to the last digit
    x = np.array([r.x for r in found]).reshape(len(found), N_FEATURES)
    order = np.lexsort([*x.T, y])
    return ToxicityModel(Matcher(*whole), *fit_logistic(x[order], y[order]))


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted, one row per document."""
    m = model.matcher
    packed = (m and (m.words, m.stems, m.clean), model.mean, model.scale, model.weights, model.bias)
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, *rest = shared.value
        own = ToxicityModel(terms and Matcher(*terms), *rest)
        for b in small_batches(batches, 1):
            s = own.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = T.StructType([docs.select("doc_id").schema[0], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"), F.col("doc_id").isNotNull() & ~held_out(3, 1))
    return score_documents(docs, model).select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")
