"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into ``segments`` parts.  Of two fingerprints that differ
in at most k bits, the ``choose`` most alike parts together differ by at most
one bit (3 parts of about 21 bits, 1 of them, for k = 4 or 5; more parts give
longer keys, and ``scheme`` takes them as fingerprints get more).  Each such
union of parts is indexed once for every bit of it, with this bit made a
wildcard.  Fingerprints that share a variant meet in an equality shuffle and
are verified.

Only distinct fingerprints take part: exact copies cost one row.  A run of
fingerprints under one variant never becomes all its pairs: short runs are
compared; long ones are cut again by parts of which near fingerprints have one
in common, and what is still long is covered from hubs.  A partition gives back
a spanning forest of what it has linked.

Defined cases: no words (null, empty or blank text): fingerprint zero.  Fewer
words than a shingle: the one shingle of all words.  Repeated rows: each row is
returned; a null doc_id never names a component unless all its ids are null.
``near_duplicates`` reads doc_id and text only.  ``keep_one`` takes rows as they
are, whether or not they have a doc_id or share it, and keeps one of each group:
that with the smallest doc_id (none last), of those the one whose columns have
the least hash; columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import read_table, small_batches, stored, unused
from quire.llm.components import connected_components

SHINGLE = 4
SEED = 42
BITS = 4
#: By how many bits fingerprints of distinct words of near copies differ.
COPY_BITS = 5
#: Runs up to this length are compared pair by pair.
SHORT_RUN = 24
#: Most distinct fingerprints, segments and how many of them make a key; the keys have 20, 24, 30 and 26 equal bits or more.
SCHEMES = ((1 << 23, 3, 1), (1 << 29, 5, 2), (1 << 63, 6, 3), (1 << 63, 7, 3))


def simhash(text: str | None, shingle: int | None = SHINGLE) -> int:
    """The fingerprint over runs of so many words, repeats included; None: over the distinct words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() is A-Z only
    if not words:
        return 0
    if shingle is None:
        words, shingle = sorted(set(words)), 1
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[shingle - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        part = h[i : i + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    out = 0
    for b in np.flatnonzero(ones * 2 > len(h)).tolist():
        out |= 1 << b
    return out


def fingerprints(rows: DataFrame, shingle: int | None = SHINGLE) -> DataFrame:
    """The columns of rows without text, and behind them the 64-bit fingerprint as a signed long (fp), row by row."""
    at = rows.columns.index("text")
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, at):
            fp = np.array([simhash(t, shingle) for t in b.column(at).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), pa.array(fp)], names=[*names, "fp"])

    return rows.mapInArrow(run, T.StructType([*rows.select(*names).schema, T.StructField("fp", T.LongType())]))


def scheme(distinct: int, k: int = BITS) -> tuple[int, int]:
    """(segments, choose) for so many distinct fingerprints: keys so long that few unlike ones share one."""
    for most, *parts in SCHEMES:
        if distinct <= most and _apart(*parts, k) <= 1:
            return tuple(parts)
    raise ValueError(f"no scheme bears {k} bits")


def _apart(segments: int, choose: int, k: int) -> int:
    """The most bits by which the choose most alike of these segments differ together, if all differ by k."""
    return k // segments * choose + max(0, k % segments - (segments - choose))


def variant_masks(segments: int = 3, choose: int = 1, k: int = BITS) -> list[int]:
    """One mask for each indexed variant: the bits that must be equal."""
    if _apart(segments, choose, k) > 1:
        raise ValueError("the chosen segments of near fingerprints would differ by more than one bit")
    cuts = [round(i * 64 / segments) for i in range(segments + 1)]
    parts = [sum(1 << b for b in range(a, z)) for a, z in zip(cuts, cuts[1:], strict=False)]
    return [m & ~(1 << b) for c in combinations(parts, choose) for m in [sum(c)] for b in range(64) if m >> b & 1]


def _variants(masks: list[int]):
    m = np.array(masks, np.uint64)
    tags = (np.arange(1, len(masks) + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                b = whole.slice(i, 4096)
                fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                with np.errstate(over="ignore"):
                    key = ((fp[:, None] & m) ^ tags) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(fp, len(m)).view(np.int64))], names=["key", "fp"])

    return run


def _near(a: np.ndarray, b, k: int = BITS) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= k


def hub_links(a: np.ndarray, k: int = BITS) -> list[tuple[int, int]]:
    """Index pairs that join exactly those members of a that chains of links join; few of them, if many are alike."""
    n = len(a)
    label = np.arange(n)
    out = []

    def join(i: int, near: np.ndarray) -> None:
        for x in np.unique(label[near]).tolist():
            if x != label[i]:
                j = int(near[np.argmax(label[near] == x)])
                out.append((i, j))
                label[label == x] = label[i]

    left = np.arange(n)
    while len(left):
        near = np.flatnonzero(_near(a, a[left[0]], k))
        join(int(left[0]), near)
        covered = np.zeros(n, bool)
        covered[near] = True
        left = left[~covered[left]]
    # links between two groups have an end outside the largest group
    names, counts = np.unique(label, return_counts=True)
    if len(names) > 1:
        for i in np.flatnonzero(label != names[np.argmax(counts)]).tolist():
            join(i, np.flatnonzero(_near(a, a[i], k)))
    return out


def _short_links(key: np.ndarray, fp: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of rows sorted by key, all near pairs under one key, given that no key has more than SHORT_RUN."""
    one, two = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for s in range(1, min(SHORT_RUN, len(key))):
        same = np.flatnonzero(key[s:] == key[:-s])
        if not len(same):
            break
        hit = same[_near(fp[same], fp[same + s], k) & (fp[same] != fp[same + s])]
        one.append(fp[hit])
        two.append(fp[hit + s])
    return np.concatenate(one), np.concatenate(two)


def run_links(a: np.ndarray, k: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join exactly those of the distinct fingerprints a that chains of links join.

    Of k + 1 parts near fingerprints have one in common, so unlike ones meet under few of them.
    """
    cuts = [round(i * 64 / (k + 1)) for i in range(k + 2)]
    one, two = [], []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        key = a >> np.uint64(lo) & np.uint64((1 << (hi - lo)) - 1)
        order = np.argsort(key, kind="stable")
        key, fp = key[order], a[order]
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        size = np.diff(edge)
        for r in np.flatnonzero(size > SHORT_RUN).tolist():
            part = fp[edge[r] : edge[r + 1]]
            if pairs := hub_links(part, k):
                i, j = np.array(pairs).T
                one.append(part[i])
                two.append(part[j])
        short = np.repeat((size > 1) & (size <= SHORT_RUN), size)
        x, y = _short_links(key[short], fp[short], k)
        one.append(x)
        two.append(y)
    return np.concatenate(one), np.concatenate(two)


def _links(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by variant key: a spanning forest of the verified links of this partition."""
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (p := parent.get(root, root)) != root:
                root = p
            while x != root:
                parent[x], x = root, parent.get(x, x)
            return root

        def union(xs: np.ndarray, ys: np.ndarray) -> None:
            for x, y in zip(xs.view(np.int64).tolist(), ys.view(np.int64).tolist(), strict=True):
                x, y = find(x), find(y)
                parent[max(x, y)] = min(x, y)
                parent.setdefault(min(x, y), min(x, y))

        def settle(key: np.ndarray, fp: np.ndarray) -> None:
            if len(key) < 2:
                return
            edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
            size = np.diff(edge)
            for r in np.flatnonzero(size > SHORT_RUN).tolist():
                a = np.unique(fp[edge[r] : edge[r + 1]])
                if len({find(x) for x in a.view(np.int64).tolist()}) > 1:
                    union(*run_links(a, k))
            short = np.repeat((size > 1) & (size <= SHORT_RUN), size)
            x, y = _short_links(key[short], fp[short], k)
            if len(x):
                pairs = np.unique(np.stack([x, y], 1), axis=0)
                union(np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))

        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            key = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            cut = int(np.searchsorted(key, key[-1]))  # the last run may go on
            settle(key[:cut], fp[:cut])
            key, fp = key[cut:], fp[cut:]
        settle(key, fp)
        nodes = [x for x in parent if find(x) != x]
        for i in range(0, len(nodes), 1 << 16):
            part = nodes[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], names=["u", "v"])

    return run


def fingerprint_components(prints: DataFrame, segments: int | None = None, choose: int = 1, k: int = BITS) -> DataFrame:
    """(node, root) of the distinct fingerprints (column fp) that have a link; segments and choose by their number unless named."""
    single = stored(prints.select("fp").distinct(), "simhash-distinct")
    if segments is None:
        segments, choose = scheme(single.count(), k)
    keyed = single.mapInArrow(_variants(variant_masks(segments, choose, k)), "key long, fp long")
    links = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_links(k), "u long, v long")
    return connected_components(links)


def near_duplicates(docs: DataFrame, segments: int | None = None, choose: int = 1) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id that links reach), one row per document."""
    prints = stored(fingerprints(docs.select("doc_id", "text")), "simhash")
    roots = fingerprint_components(prints, segments, choose)
    per_print = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    rooted = per_print.join(roots, per_print.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind)
    return _hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def keep_one(docs: DataFrame, shingle: int | None = None, k: int = COPY_BITS) -> DataFrame:
    """One row of each group of near copies; rows equal in all columns are one.

    A changed word moves four shingles but one word, so fingerprints of distinct words tell near copies better.
    """
    one, two = unused(docs, "i1", "i2")
    every = [F.col(f"`{f.name}`") for f in docs.schema if _hashable(f.dataType)]
    rows = docs.withColumns({one: F.xxhash64(*every), two: F.xxhash64(F.lit(1), *every)})
    who = F.struct(F.col("doc_id").isNull(), "doc_id", F.col(one).alias("i1"), F.col(two).alias("i2"))
    prints = stored(fingerprints(rows.select("text", who.alias("who")), shingle), "simhash")
    first = prints.groupBy("fp").agg(F.min("who").alias("who"))
    roots = fingerprint_components(prints, k=k)
    best = first.join(roots, first.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("who").alias("who"))
    kept = rows.join(best.select(F.col("who.i1").alias(one), F.col("who.i2").alias(two)), [one, two], "left_semi")
    return kept.dropDuplicates([one, two]).select(*(F.col(f"`{c}`") for c in docs.columns))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
