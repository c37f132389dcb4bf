"""Benchmark decontamination: a BM25 index of test items, searched by every training passage.

Each document is read as overlapping windows of words, long enough that every
item lies whole in one of them, and, if it has several, as one passage more,
the whole document, in which items stand whose pieces lie far apart.  A passage
is the query; an item is retrieved when its BM25 score reaches the least score
that a passage with at least ``SIMILARITY`` of the item's five-word shingles
can have.  The search is block-max WAND: items stand in blocks of ``BLOCK``,
and each term keeps its largest impact in each block.  For all passages of a
batch at once these bounds, with the lightest terms taken for granted, say
which blocks can hold an item; passages with such blocks are walked item by
item, each term's list skipping to the pivot, the first item that the largest
impacts of the lists before it can lift over the threshold, or to the next such
block.

Retrieved items are verified on the document's shingles: the whole item, its
question (all but the last sentence) and its answer (the last sentence) must
each be there by ``SIMILARITY``.  A part of fewer than five words is one shingle
of its own length, and a part without words asks for nothing.

Items go to the executors in groups of bounded size, one pass over the
documents for each group, so no broadcast grows with the benchmark.  Document
frequencies, the mean length and the window length are those of all items, so
groups change nothing but the number of passes.

Defined cases: null texts have no words and never match; items without words
are left out; items of fewer than five words are one shingle; items of equal
words share one entry, with all their ids; ids may have any type; repeated
documents are each reported; columns besides those named are passed through by
``drop_leaks``, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm.common import read_table, small_batches, stored

SHINGLE = 5
SIMILARITY = 0.8
K1, B = 1.2, 0.75
BLOCK = 4
#: Bytes of item text that are indexed and broadcast at a time.
ITEM_BYTES = 8 << 20
#: Share of the threshold that the lightest terms of an item may hold without being looked up for a block's bound.
TAKEN_FOR_GRANTED = 0.5
_ENOUGH = 1 - 1e-9

_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def shingles(words: list) -> set[tuple]:
    """Runs of SHINGLE words; of fewer words the one run of all."""
    if not len(words):
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def split_item(text: str) -> tuple[list[str], list[str]]:
    """(question words, answer words): the answer is the last line, or else the last sentence."""
    body = text.strip()
    cut = body.rfind("\n")
    if cut < 0:
        ends = [m.end() for m in re.finditer(r"[.?!]\s+", body)]
        cut = ends[-1] if ends else 0
    return words_of(body[:cut]), words_of(body[cut:])


@dataclass
class Statistics:
    """Of all items: distinct ones, their mean and largest number of words, and in how many each word occurs."""

    n: int
    mean: float
    longest: int
    df: dict[str, int]


@dataclass
class ItemIndex:
    """Impacts are divided by their item's threshold: an item is retrieved at a sum of 1."""

    span: int = 1  # words of the longest of all items
    ids: list[list] = field(default_factory=list)
    full: list[float] = field(default_factory=list)  # thresholds
    vocabulary: dict[str, int] = field(default_factory=dict)
    # the items as numbers of words, one behind the other, and where their answers begin
    words: np.ndarray = None
    begins: np.ndarray = None
    answers: np.ndarray = None
    # postings by term, and each term's largest impact
    keys: np.ndarray = None  # term * items + item
    starts: np.ndarray = None
    items: np.ndarray = None
    impacts: np.ndarray = None
    top: np.ndarray = None
    # block bounds by term, of the heavier terms only
    block_starts: np.ndarray = None
    blocks: np.ndarray = None
    bounds: np.ndarray = None
    granted: np.ndarray = None  # by block: the most that the terms not looked up can add


def _entries(rows: list[tuple]) -> list[tuple[tuple[str, ...], str, list]]:
    """(words, least text, ids) of the items that differ in words."""
    by_words: dict[tuple[str, ...], list] = {}
    for item_id, text in rows:
        if words := tuple(words_of(text)):
            entry = by_words.setdefault(words, [text, []])
            entry[0] = min(entry[0], text)
            entry[1].append(item_id)
    return [(w, t, sorted(i for i in ids if i is not None)) for w, (t, ids) in sorted(by_words.items())]


def statistics(rows: list[tuple]) -> Statistics:
    words = [w for w, _, _ in _entries(rows)]
    return Statistics(len(words), sum(map(len, words)) / max(1, len(words)), max(map(len, words), default=1), Counter(t for w in words for t in set(w)))


def build_index(rows: list[tuple], of_all: Statistics | None = None) -> ItemIndex:
    """of_all: statistics of all items, if rows are but a group of them."""
    of_all = of_all or statistics(rows)
    entries = _entries(rows)
    index, n = ItemIndex(span=of_all.longest), len(entries)
    index.vocabulary = {t: i for i, t in enumerate(sorted({t for w, _, _ in entries for t in w}))}
    number = index.vocabulary.__getitem__
    idf = {t: math.log(1 + (of_all.n - d + 0.5) / (d + 0.5)) for t in index.vocabulary for d in [of_all.df[t]]}
    post: list[tuple[int, int, float, bool]] = []
    granted, answers = [0.0] * n, []
    for k, (words, text, ids) in enumerate(entries):
        tf = Counter(words)
        norm = K1 * (1 - B + B * len(words) / of_all.mean)
        w = {t: idf[t] * c * (K1 + 1) / (c + norm) for t, c in tf.items()}
        n_shingles = len(shingles(words))
        lost = n_shingles - math.ceil(SIMILARITY * n_shingles - 1e-9)
        # so many shingles may be missing, and with them at most as many words
        heavy = sorted(w.values(), reverse=True)
        least = max(sum(heavy[lost:]), 0.25 * heavy[-1])
        index.ids.append(ids)
        index.full.append(least)
        answers.append(len(split_item(text)[0]))
        for t, x in sorted(w.items(), key=lambda p: (p[1], p[0])):
            x /= least
            light = granted[k] + x <= TAKEN_FOR_GRANTED
            if light:
                granted[k] += x
            post.append((number(t), k, x, light))
    post.sort()
    index.words = np.array([number(t) for w, _, _ in entries for t in w], np.int32)
    index.begins = np.cumsum([0, *(len(w) for w, _, _ in entries)])
    index.answers = index.begins[:-1] + np.array(answers, np.int64)
    terms = len(index.vocabulary)
    term = np.array([p[0] for p in post], np.int64)
    index.items = np.array([p[1] for p in post], np.int64)
    index.impacts = np.array([p[2] for p in post], np.float64)
    index.keys = term * max(1, n) + index.items
    index.starts = np.searchsorted(term, np.arange(terms + 1))
    index.top = np.maximum.reduceat(index.impacts, index.starts[:-1]) if terms else np.zeros(0)
    heavy = ~np.array([p[3] for p in post], bool)
    blocks = n // BLOCK + 1
    uniq, inv = np.unique(term[heavy] * blocks + index.items[heavy] // BLOCK, return_inverse=True)
    index.bounds = np.zeros(len(uniq))
    np.maximum.at(index.bounds, inv, index.impacts[heavy])
    index.blocks = uniq % blocks
    index.block_starts = np.searchsorted(uniq // blocks, np.arange(terms + 1))
    index.granted = np.zeros(blocks)
    np.maximum.at(index.granted, np.arange(n) // BLOCK, np.array(granted)) if n else None
    return index


def _live_blocks(index: ItemIndex, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
    """passage * blocks + block, where the block's bound for this passage reaches 1."""
    size = index.block_starts[term + 1] - index.block_starts[term]
    row = np.repeat(np.arange(len(term)), size)
    at = index.block_starts[term][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    blocks = len(index.granted)
    key, inv = np.unique(passage[row] * blocks + index.blocks[at], return_inverse=True)
    return key[np.bincount(inv, index.bounds[at], len(key)) + index.granted[key % blocks] >= _ENOUGH]


def wand(index: ItemIndex, terms: np.ndarray, live: np.ndarray) -> list[tuple[int, float]]:
    """(item, share of its threshold) of the items in these blocks that the terms lift to their threshold."""
    n, last = max(1, len(index.ids)), len(index.items) - 1
    base, end, top = terms * n, index.starts[terms + 1], index.top[terms]
    at = index.starts[terms]
    out = []
    while True:
        head = np.where(at < end, index.items[np.minimum(at, last)], n)
        order = np.argsort(head, kind="stable")
        reach = np.cumsum(top[order])
        p = int(np.searchsorted(reach, _ENOUGH))
        if p == len(order) or (pivot := int(head[order[p]])) == n:
            return out
        j = int(np.searchsorted(live, pivot // BLOCK))
        if j == len(live):
            return out
        if live[j] != pivot // BLOCK:
            at = np.maximum(at, np.searchsorted(index.keys, base + int(live[j]) * BLOCK))
            continue
        at = np.maximum(at, np.searchsorted(index.keys, base + pivot))
        here = at[at < end]
        score = float(index.impacts[here[index.items[here] == pivot]].sum())
        if score >= _ENOUGH:
            out.append((pivot, score))
        at = np.maximum(at, np.searchsorted(index.keys, base + pivot + 1))


def search(index: ItemIndex, docs: list[list[str]]) -> dict[tuple[int, int], float]:
    """{(document, item): score} of the items that a passage retrieves: of its best window, or else of the whole document."""
    if not index.ids:
        return {}
    half = index.span + index.span // 4 + 4
    get, unknown = index.vocabulary.get, repeat(-1)
    terms, passages, owner, whole = [], [], [], []
    for d, words in enumerate(docs):
        ids = np.fromiter(map(get, words, unknown), np.int64, len(words))
        at = np.flatnonzero(ids >= 0)
        # window k has the words of the slots k and k + 1
        windows = max(1, -(-len(words) // half) - 1)
        slot, first = at // half, len(owner)
        for k in (np.minimum(slot, windows - 1), np.maximum(slot - 1, 0)):
            terms.append(ids[at])
            passages.append(first + k)
        if windows > 1:
            terms.append(ids[at])
            passages.append(np.full(len(at), first + windows))
        owner += [d] * (windows + (windows > 1))
        whole += [False] * windows + [True] * (windows > 1)
    size = len(index.vocabulary)
    pair = np.unique(np.concatenate(passages) * size + np.concatenate(terms)) if terms else np.empty(0, np.int64)
    passage, term = pair // size, pair % size
    live = _live_blocks(index, passage, term)
    blocks = len(index.granted)
    found: dict[tuple[int, int], float] = {}
    for k in np.unique(live // blocks).tolist():  # windows come before their document
        a, z = np.searchsorted(live, (k * blocks, (k + 1) * blocks))
        x, y = np.searchsorted(passage, (k, k + 1))
        for item, score in wand(index, term[x:y], live[a:z] - k * blocks):
            key = (owner[k], item)
            if not whole[k]:
                found[key] = max(found.get(key, 0.0), score * index.full[item])
            else:
                found.setdefault(key, score * index.full[item])
    return found


def _overlaps(index: ItemIndex, item: int, runs: dict[int, set], ids: list[int]) -> list[float]:
    """Shares of the whole item, its question and its answer in a document; runs: its word runs by length, as far as known."""
    a, m, z = int(index.begins[item]), int(index.answers[item]), int(index.begins[item + 1])
    out = []
    for x, y in ((a, z), (a, m), (m, z)):
        part = shingles(index.words[x:y].tolist())
        n = min(SHINGLE, y - x)
        if n not in runs:
            runs[n] = set(zip(*(ids[i:] for i in range(n)), strict=False))
        out.append(len(part & runs[n]) / len(part) if part else 1.0)
        if out[-1] < SIMILARITY:
            break
    return out


def leaks(index: ItemIndex, docs: list[list[str]]) -> list[tuple[int, int, float, float, float, float]]:
    """(document, item, score, overlap, question overlap, answer overlap) of the verified items."""
    found = search(index, docs)
    get = index.vocabulary.get
    out, now, ids, runs = [], -1, [], {}
    for d, item in sorted(found):
        if d != now:
            now, ids, runs = d, [get(w, -1) for w in docs[d]], {}
        shares = _overlaps(index, item, runs, ids)
        if shares[-1] >= SIMILARITY:
            out.append((d, item, found[d, item], *shares))
    return out


def keyed_items(items: DataFrame) -> DataFrame:
    """The items that have words, with a key of their words and their number."""
    schema = T.StructType([*items.select("item_id", "text").schema, T.StructField("key", T.LongType()), T.StructField("n_words", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            words = [words_of(t) for t in b.column(1).to_pylist()]
            keep = [i for i, w in enumerate(words) if w]
            keys = [xxhash.xxh64_intdigest(" ".join(words[i]).encode()) - (1 << 63) for i in keep]
            cols = [b.column(0).take(pa.array(keep, pa.int64())), b.column(1).take(pa.array(keep, pa.int64())), pa.array(keys, pa.int64()), pa.array([len(words[i]) for i in keep], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return items.select("item_id", "text").mapInArrow(run, schema)


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small_batches(batches, 0):
        yield pa.RecordBatch.from_arrays([pa.array([w for t in b.column(0).to_pylist() for w in set(words_of(t))], pa.string())], names=["word"])


def item_groups(items: DataFrame) -> Iterator[tuple[list[tuple], Statistics | None]]:
    """All items, in groups of about ITEM_BYTES of text, items of equal words together; with the statistics of all if there are several groups."""
    items = stored(keyed_items(items), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = math.ceil(total / ITEM_BYTES)
    if n == 1:
        yield [(r.item_id, r.text) for r in items.collect()], None
    if n < 2:
        return
    once = items.groupBy("key").agg(F.min("text").alias("text"), F.min("n_words").alias("n_words"))
    count, n_words, longest = once.agg(F.count("*"), F.sum("n_words"), F.max("n_words")).first()
    df = stored(once.select("text").mapInArrow(_distinct_words, "word string").groupBy("word").agg(F.count("*").alias("df")), "item-words")
    group = F.pmod(F.col("key"), F.lit(n))
    for k in range(n):
        mine = items.where(group == k)
        known = df.join(mine.select("text").mapInArrow(_distinct_words, "word string").distinct(), "word", "left_semi")
        yield [(r.item_id, r.text) for r in mine.collect()], Statistics(count, n_words / count, longest, {r.word: r.df for r in known.collect()})


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for each document and item that it holds; item_ids lists the items of equal words, item_id is the first."""
    spark, parts = docs.sparkSession, []
    of_item = items.schema["item_id"].dataType
    doubles = [T.StructField(c, T.DoubleType()) for c in ("bm25", "overlap", "question_overlap", "answer_overlap")]
    schema = T.StructType([docs.select("doc_id").schema[0], T.StructField("item_id", of_item), T.StructField("item_ids", T.ArrayType(of_item)), *doubles])
    kind = to_arrow_type(of_item)
    for group, of_all in item_groups(items):
        shared = spark.sparkContext.broadcast(build_index(group, of_all))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for b in small_batches(batches, 1, 1 << 20):
                rows = leaks(index, [words_of(t) for t in b.column(1).to_pylist()])
                if rows:
                    d, i, *shares = zip(*rows, strict=True)
                    ids = [index.ids[x] for x in i]
                    cols = [b.column(0).take(pa.array(d, pa.int64())), pa.array([(x or [None])[0] for x in ids], kind), pa.array(ids, pa.list_(kind)), *(pa.array(x, pa.float64()) for x in shares)]
                    yield pa.RecordBatch.from_arrays(cols, names=schema.names)

        parts.append(docs.select("doc_id", "text").mapInArrow(run, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns; nothing is shuffled."""
    at = docs.columns.index("text")
    for group, of_all in item_groups(items):
        shared = docs.sparkSession.sparkContext.broadcast(build_index(group, of_all))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in small_batches(batches, at, 1 << 20):
                bad = {r[0] for r in leaks(shared.value, [words_of(t) for t in b.column(at).to_pylist()])}
                yield b.take(pa.array([i for i in range(b.num_rows) if i not in bad], pa.int64())) if bad else b

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.transform("item_ids", lambda x: x.cast("string")), ",")
    return found.select("doc_id", "item_id", ids.alias("item_ids"), F.round("bm25", 6).alias("bm25"), "overlap", "question_overlap", "answer_overlap")


#: Every item against every document by shingles; the scores of those found from the windows' words.
ORACLE_SQL = f"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM documents
), body AS (
    SELECT item_id, text, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS body FROM benchmark WHERE text IS NOT NULL
), cut AS (
    SELECT item_id, text, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS every,
        regexp_extract_all(lower(CASE WHEN contains(body, chr(10)) THEN regexp_extract(body, '(?s)^(.*)\\n[^\\n]*$', 1) ELSE regexp_extract(body, '(?s)^(.*[.?!]\\s+)', 1) END), '[\\p{{L}}\\p{{N}}_]+') AS question
    FROM body
), item AS (
    SELECT min(item_id) AS item_id, string_agg(cast(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids, every, arg_min(question, text) AS question FROM cut WHERE len(every) > 0 GROUP BY every
), parts AS (
    SELECT item_id, 0 AS part, every AS ws FROM item UNION ALL SELECT item_id, 1, question FROM item UNION ALL SELECT item_id, 2, every[len(question) + 1:] FROM item
), grams AS (
    SELECT DISTINCT item_id, part, least({SHINGLE}, len(ws)) AS n, array_to_string(ws[i:i + least({SHINGLE}, len(ws)) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(1, len(ws) - {SHINGLE} + 1) + 1)) AS i FROM parts WHERE len(ws) > 0)
), size AS (
    SELECT item_id, part, count(*) AS total FROM grams GROUP BY item_id, part
), held AS (
    SELECT doc_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM grams) WHERE len(ws) >= n)
), hits AS (
    SELECT doc_id, item_id, part, count(DISTINCT held.g) AS k FROM held JOIN grams ON held.n = grams.n AND held.g = grams.g GROUP BY doc_id, item_id, part
), shares AS (
    SELECT h.doc_id, h.item_id, h.k / s.total AS overlap,
        CASE WHEN q.total IS NULL THEN 1.0::DOUBLE ELSE coalesce((SELECT k FROM hits x WHERE x.doc_id = h.doc_id AND x.item_id = h.item_id AND x.part = 1), 0) / q.total END AS question_overlap,
        CASE WHEN a.total IS NULL THEN 1.0::DOUBLE ELSE coalesce((SELECT k FROM hits x WHERE x.doc_id = h.doc_id AND x.item_id = h.item_id AND x.part = 2), 0) / a.total END AS answer_overlap
    FROM hits h JOIN size s ON h.item_id = s.item_id AND s.part = 0 LEFT JOIN size q ON h.item_id = q.item_id AND q.part = 1 LEFT JOIN size a ON h.item_id = a.item_id AND a.part = 2 WHERE h.part = 0 AND h.k / s.total >= {SIMILARITY}
), found AS (
    SELECT * FROM shares WHERE question_overlap >= {SIMILARITY} AND answer_overlap >= {SIMILARITY}
), stats AS (
    SELECT count(*) AS n, avg(len(every)) AS mean, max(len(every)) + max(len(every)) // 4 + 4 AS half FROM item
), tf AS (
    SELECT item_id, t, len(every) AS size, count(*) AS c FROM (SELECT item_id, every, unnest(every) AS t FROM item) GROUP BY item_id, t, len(every)
), impact AS (
    SELECT item_id, tf.t, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * c * {K1 + 1}::DOUBLE / (c + {K1}::DOUBLE * ({1 - B}::DOUBLE + {B}::DOUBLE * size / mean)) AS w
    FROM tf JOIN (SELECT t, count(*) AS df FROM tf GROUP BY t) d ON tf.t = d.t, stats
), least_ AS (
    SELECT i.item_id, greatest(list_sum(list_sort(list(w), 'DESC')[any_value(total - ceil({SIMILARITY}::DOUBLE * total - 1e-9)::BIGINT) + 1:]), 0.25::DOUBLE * min(w)) AS least FROM impact i JOIN size s ON i.item_id = s.item_id AND s.part = 0 GROUP BY i.item_id
), words AS (
    SELECT d.doc_id, d.ws[p] AS t, (p - 1) // half AS slot, greatest(1, (len(ws) + half - 1) // half - 1) AS windows FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM doc WHERE doc_id IN (SELECT doc_id FROM found)) d, stats
), windowed AS (
    SELECT DISTINCT doc_id, t, unnest([least(slot, windows - 1), greatest(slot - 1, 0), -1]) AS k FROM words
), scored AS (
    SELECT f.doc_id, f.item_id, k, sum(w) AS score FROM found f JOIN windowed x ON f.doc_id = x.doc_id JOIN impact i ON i.item_id = f.item_id AND i.t = x.t GROUP BY f.doc_id, f.item_id, k
), best AS (
    SELECT doc_id, s.item_id, coalesce(max(CASE WHEN k >= 0 AND score >= least * (1 - 1e-9) THEN score END), max(CASE WHEN k = -1 THEN score END)) AS bm25 FROM scored s JOIN least_ l ON s.item_id = l.item_id GROUP BY doc_id, s.item_id
)
SELECT f.doc_id, f.item_id, i.item_ids, round(bm25, 6) AS bm25, overlap, question_overlap, answer_overlap FROM found f JOIN best b ON f.doc_id = b.doc_id AND f.item_id = b.item_id JOIN item i ON f.item_id = i.item_id
"""
