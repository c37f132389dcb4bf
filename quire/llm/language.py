"""Language identification with a blended-spectrum string kernel.

A text is the set of its hashed letter n-grams, n = 1 to 3 (presence, not
counts); k(x, y) = |X and Y| / sqrt(|X| |Y|).  Nystrom landmarks from the
training sample span the feature space, one-versus-rest kernel ridge
regression gives a weight for every landmark and language, and whole batches
are scored as two matrix products.

Training reads only text and lang of rows outside the held-out part, about
``SAMPLE`` rows for each language, fewer if there are so many languages that all
together would be more than ``ROWS``, and takes their n-gram sets (bits, of
fixed size) to the driver, not their texts; of more than ``LABELS`` languages
the most frequent are learned.  The driver goes through them in
blocks: it keeps landmarks and sums, not a matrix of all rows.

A long text is scored in windows, all of them, and the mean of their values counts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is everything when there is nothing to learn from.  Repeated rows get equal
results; ties go to the language that sorts first; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import read_table, small_batches

BITS = 13
SIZE = 1 << BITS
ORDERS = 3
SAMPLE = 400
ROWS = 50_000
#: Most labels that a sample knows: more languages than any corpus tells apart.
LABELS = 2048
#: At least so many, and two for each language.
LANDMARKS = 256
#: Characters of a window; the values of a longer text are the mean over its windows.
WINDOW = 20_000
#: Rows whose presences are unpacked at a time.
AT_ONCE = 2048
RIDGE = 1e-2
#: Sharpness of the softmax that turns regression values into a score.
SHARP = 6.0
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Each code point's own number if it is a letter, else that of a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.uint32)


def spectrum(text: str | None) -> np.ndarray | None:
    """Presence (0 or 1) of the hashed n-grams of the whole text; None without letters."""
    if not text:
        return None
    x = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    gap = x == 32
    if gap.all():
        return None
    again = np.zeros(len(x), bool)
    again[1:] = gap[1:] & gap[:-1]
    x = np.concatenate([[np.uint32(32)], x[~again], [np.uint32(32)]]).astype(np.uint32)
    out = np.zeros(SIZE, np.uint8)
    h = np.zeros(len(x), np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, ORDERS + 1):
            h = (h[: len(x) - n + 1] * np.uint32(0x01000193) + x[n - 1 :]) * np.uint32(0x9E3779B1)
            out[(h ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BITS)] = 1
    return out


def windows(text: str) -> Iterator[str]:
    """The whole text, in even parts of WINDOW characters at most: the n-grams of one much longer would be nearly all there are."""
    parts = max(1, -(-len(text) // WINDOW))
    for k in range(parts):
        yield text[len(text) * k // parts : len(text) * (k + 1) // parts]


@dataclass
class LanguageModel:
    names: list[str]
    landmarks: np.ndarray  # (m, SIZE), unit length
    weights: np.ndarray  # (m, languages)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not self.names:
            return out
        whose: list[int] = []
        held: list[np.ndarray] = []
        total, n = np.zeros((len(texts), len(self.names))), np.zeros(len(texts))

        def score() -> None:
            if held:
                x = np.stack(held).astype(np.float32)
                x /= np.sqrt(x.sum(1, keepdims=True))
                np.add.at(total, whose, (x @ self.landmarks.T) @ self.weights)
                np.add.at(n, whose, 1)
                whose.clear(), held.clear()

        for i, text in enumerate(texts):
            for part in windows(text or ""):
                if (s := spectrum(part)) is not None:
                    whose.append(i)
                    held.append(s)
                    if len(held) == 128:
                        score()
        score()
        some = np.flatnonzero(n)
        f = total[some] / n[some, None]
        e = np.exp(SHARP * (f - f.max(1, keepdims=True))) if len(some) else f
        e /= e.sum(1, keepdims=True)
        for i, b, p in zip(some.tolist(), f.argmax(1).tolist() if len(some) else [], e, strict=True):
            out[i] = (self.names[b], float(p[b]))
        return out


def _unit(packed: list[bytes]) -> np.ndarray:
    """Rows of packed presences at unit length."""
    x = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), SIZE // 8), axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(1, x.sum(1, keepdims=True)))


def fit(packed: list[bytes], langs: list[str]) -> LanguageModel:
    """packed: the SIZE presences of each text, eight to a byte."""
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], np.zeros((0, SIZE), np.float32), np.zeros((0, 0), np.float32))
    number = {a: i for i, a in enumerate(names)}
    label = np.array([number[a] for a in langs])
    # landmarks in turn from every language
    order = _in_turn(langs)
    marks = _unit([packed[i] for i in order[: max(LANDMARKS, 2 * len(names))]])
    s, u = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = s > 1e-6 * s.max()
    root = u[:, keep] / np.sqrt(s[keep])
    # every language weighs the same
    count = np.bincount(label)
    weight = 1 / count[label]
    weight *= len(langs) / weight.sum()
    left, right = RIDGE * np.eye(root.shape[1]), np.zeros((root.shape[1], len(names)))
    for at in range(0, len(packed), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        phi = (_unit(packed[part]) @ marks.T).astype(np.float64) @ root
        y = np.where(label[part, None] == np.arange(len(names)), 1.0, -1.0) * weight[part, None]
        left += phi.T @ (phi * weight[part, None])
        right += phi.T @ y
    return LanguageModel(names, marks, (root @ np.linalg.solve(left, right)).astype(np.float32))


def _in_turn(langs: list[str]) -> list[int]:
    seen: dict[str, int] = {}
    place = []
    for a in langs:
        seen[a] = seen.get(a, -1) + 1
        place.append(seen[a])
    return sorted(range(len(langs)), key=lambda i: (place[i], langs[i]))


def sampled(df: DataFrame, label: str, key: Column, per_label: int, rows: int | None = None) -> DataFrame:
    """About per_label rows of each label (the LABELS most frequent ones), fewer if all together would be more than rows, chosen by a hash of key; no row moves."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).limit(LABELS).collect()
    if not counts:
        return df.where(F.lit(False))
    if rows is not None:
        per_label = min(per_label, rows / len(counts))
    share = F.create_map(*(F.lit(x) for r in counts for x in (r[0], min(1.0, per_label / r[1]))))
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < share[F.col(label)] * (1 << 20))


def train(docs: DataFrame, learn: Column) -> LanguageModel:
    rows = sampled(docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text", "lang"), "lang", F.col("doc_id"), SAMPLE, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 0):
            got = [(s, a) for t, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if (s := spectrum(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(s).tobytes() for s, _ in got], pa.binary()), pa.array([a for _, a in got], pa.string())], names=["bits", "lang"])

    found = sorted((r.lang, bytes(r.bits)) for r in rows.select("text", "lang").mapInArrow(run, "bits binary, lang string").collect())
    return fit([b for _, b in found], [a for a, _ in found])


def held_out(modulus: int, rest: int) -> Column:
    """Whether crc32(doc_id as text) leaves this rest; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks: LANDMARKS x SIZE floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            got = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = T.StructType([docs.select("doc_id").schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, F.col("doc_id").isNotNull() & ~held_out(4, 2))
    return identify(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
