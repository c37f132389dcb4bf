"""Removal of byte strings that occur twice, by suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
is removed.

1. Anchors.  Of the ``GRAM``-byte strings inside each LENGTH-byte window the
   one with the least hash is the window's anchor, so equal windows have equal
   anchors.  Anchors that occur once in the corpus rule their windows out.
2. Shards.  What is left of a text is cut into contexts, runs of windows with
   one anchor; contexts go to the shard of their anchor.  Frequent anchors are
   salted over several shards; equal contexts that meet on the way settle each
   other and travel once.
3. In a shard, of about ``SHARD_BYTES``, windows whose hash stands alone are put
   aside and the rest is sorted into a suffix array by Larsson-Sadakane
   refinement; Kasai's lemma gives common prefixes, and neighbours that share
   LENGTH bytes are repeats.
4. Shards of one salted anchor publish each of their distinct windows once, as a
   sorted run of fingerprints (128 bits) that says which windows the shard has
   marked already.  A run travels in a few packed pieces, cut by the leading bits
   of the fingerprints; pieces of equal bits meet in a task.  There the runs are
   merged two by two, the smaller searched in the larger by bisection, and only
   windows that no shard has marked get an answer.
5. Spans, joined to runs, return to the texts.

The suffix arrays decide wherever windows of different contexts meet in a
shard.  Where whole contexts or whole texts are equal no array is needed: a
text that occurs twice is one repeat as a whole, and so is a context.  A text
is known by two 64-bit hashes; copies ride along with it.  Text travels
compressed.

Defined cases: null is empty; texts shorter than LENGTH keep all; matches never
cross documents; repeated rows repeat each other and lose all from LENGTH bytes
on; other columns pass through ``remove_repeats``, whose text is what is left,
decoded without broken characters; ``n_chars`` is counted anew if it holds whole
numbers; columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import recounted, read_table, small_batches, stored, unused

LENGTH = 200
GRAM = 32
#: Window starts that are hashed at a time, so that a text of any length takes bounded memory.
STRIDE = 1 << 19
SHARD_BYTES = 1 << 20
#: Occurrences of an anchor that may share a shard.
GROUP = 2048
REMEMBERED = 300_000
#: Published windows that one task merges, about; pieces that a run is cut into at most.
MERGED, PIECES = 1 << 17, 1 << 10

_P = 0x9E3779B97F4A7C15
_M = (1 << 64) - 1
_LOW = np.uint64((1 << 20) - 1)


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 14)
            with np.errstate(over="ignore"):
                for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
                    steps = np.full(size, np.uint64(base))
                    steps[0] = 1
                    setattr(cls, name, np.cumprod(steps))
        return cls.up[:n], cls.down[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def rolling(a: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each size-byte string of a."""
    n = len(a)
    up, down = _Powers.of(n + 1)
    c = np.zeros(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:n], out=c[1:])
        return _mix((c[size:] - c[:-size]) * down[: n - size + 1])


def window_anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(anchor place, anchor hash) of the window at each start."""
    starts = len(text) - length + 1
    if starts <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    whole, w, places, hashes = np.frombuffer(text, np.uint8), length - gram + 1, [], []
    for at in range(0, starts, STRIDE):
        a = whole[at : at + STRIDE + length - 1]
        h = rolling(a, gram)
        n = len(h)
        x = np.full(-(-n // w) * w, np.uint64(_M))
        x[:n] = h & ~_LOW | np.arange(n, dtype=np.uint64)  # the place in the low bits parts ties: the first counts
        x = x.reshape(-1, w)
        before = np.minimum.accumulate(x, 1).ravel()
        behind = np.minimum.accumulate(x[:, ::-1], 1)[:, ::-1].ravel()
        p = (np.minimum(behind[: n - w + 1], before[w - 1 : n]) & _LOW).astype(np.int64)
        places.append(p + at)
        hashes.append(h[p].view(np.int64))
    return np.concatenate(places), np.concatenate(hashes)


_SEEDS = (42, xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42))


def text_key(text: bytes) -> tuple[int, int]:
    """The same as xxhash64(text) and xxhash64(1, text) in Spark, 128 bits together."""
    return tuple(k - (1 << 64) if k >> 63 else k for k in (xxhash.xxh64_intdigest(text, s) for s in _SEEDS))


def spark_key(text: Column) -> tuple[Column, Column]:
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, t1, t2, pos): each anchor of each text that is new to this partition."""
    seen: set[tuple[int, int]] = set()
    for b in small_batches(batches, 0):
        hs, one, two, places = [], [], [], []
        for text in b.column(0).to_pylist():
            raw = _bytes(text)
            key = text_key(raw)
            if len(raw) < LENGTH or key in seen:
                continue
            if len(seen) < 4 * REMEMBERED:
                seen.add(key)
            p, h = window_anchors(raw)
            first = np.concatenate([[0], np.flatnonzero(p[1:] != p[:-1]) + 1])
            hs.append(h[first])
            places.append(p[first])
            one.append(np.full(len(first), key[0]))
            two.append(np.full(len(first), key[1]))
        if hs:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (hs, one, two, places)], names=["h", "t1", "t2", "pos"])


def _pack(column: int, names: list[str], once: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """text gives way to its compressed bytes, with its key and n_bytes behind all columns; once: long enough texts, each once for a partition."""
        codec = pa.Codec("zstd", 3)
        seen: set[tuple[int, int]] = set()
        for b in small_batches(batches, column):
            raws = [_bytes(t) for t in b.column(column).to_pylist()]
            keys = [text_key(r) for r in raws]
            if once:
                keep = []
                for i, (k, r) in enumerate(zip(keys, raws, strict=True)):
                    if len(r) >= LENGTH and k not in seen:
                        keep.append(i)
                        if len(seen) < 4 * REMEMBERED:
                            seen.add(k)
                if not keep:
                    continue
                b, raws, keys = b.take(pa.array(keep)), [raws[i] for i in keep], [keys[i] for i in keep]
            cols = list(b.columns)
            cols[column] = pa.array([codec.compress(r, asbytes=True) for r in raws], pa.binary())
            more = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(map(len, raws), pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, *more], names=names)

    return run


def _unpack(data: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(data, size, asbytes=True) if size else b""


def packed(docs: DataFrame, names: list[str], once: bool = False) -> DataFrame:
    """names: of the two halves of the key and of the size."""
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in docs.schema]
    out = T.StructType([*fields, *(T.StructField(n, T.LongType()) for n in names)])
    return docs.mapInArrow(_pack(docs.columns.index("text"), out.names, once), out)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that spans cover."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


CONTEXTS = "h long, salt long, t1 long, t2 long, s long, n long, context binary"
_CONTEXT_KINDS = [*[pa.int64()] * 6, pa.binary()]
_CONTEXT_NAMES = ["h", "salt", "t1", "t2", "s", "n", "context"]


def _contexts(group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of windows with one recurring anchor.  A row without bytes is settled: a span of n bytes whose windows all recur."""
        met: dict[bytes, list] = {}
        done: set[tuple[int, int]] = set()
        for whole in batches:
            for i in range(0, whole.num_rows, 64):
                b = whole.slice(i, 64)
                rows: list[tuple] = []
                settled: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for one, two, z, size, marks in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    key = (one, two)
                    if key in done:
                        continue
                    if len(done) < 4 * REMEMBERED:
                        done.add(key)
                    raw = _unpack(z, size)
                    p, h = window_anchors(raw)
                    edge = np.concatenate([[0], np.flatnonzero(p[1:] != p[:-1]) + 1, [len(p)]])
                    often = {m["pos"]: m["n"] for m in marks}
                    for a, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                        n = often.get(int(p[a]))
                        if n is None:
                            continue
                        context = raw[a : e + LENGTH - 1]
                        name = xxhash.xxh3_128_digest(context)
                        salt = int.from_bytes(name[:6], "big") % -(-n // group) if n > group else -1
                        first = met.get(name)
                        if first is None:
                            if len(met) >= REMEMBERED:
                                met.clear()
                            met[name] = [key, a, False]
                            rows.append((int(h[a]), salt, *key, a, e - a, context))
                        elif first[0] != key or first[1] != a:
                            if not first[2]:
                                settled.setdefault(first[0], []).append((first[1], first[1] + len(context)))
                                first[2] = True
                            settled.setdefault(key, []).append((a, a + len(context)))
                # settled runs need no shard of their anchor: they spread by text and place
                rows += [(key[0], s, *key, s, e - s, None) for key, spans in settled.items() for s, e in _joined(spans)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _CONTEXT_KINDS, strict=True)], names=_CONTEXT_NAMES)

    return run


def suffix_array(t: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of their first depth bytes at least, 8-byte words of t at each place)."""
    n = len(t)
    words = np.zeros(n, np.uint64)
    for j in range(8):
        words[: n - j] |= t[j:].astype(np.uint64) << np.uint64(56 - 8 * j) if j else t.astype(np.uint64) << np.uint64(56)
    sa = np.argsort(words)
    k = words[sa]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    while h < depth:
        # groups of one are in place; the others are refined by the rank h bytes on
        single = np.concatenate([new, [True]])
        open_ = np.flatnonzero(~(single[:-1] & single[1:]))
        if not len(open_):
            break
        sub = sa[open_]
        onward = sub + h
        second = np.where(onward < n, rank[np.minimum(onward, n - 1)] + 1, 0)
        key = rank[sub] * (n + 1) + second
        order = np.argsort(key)
        sa[open_] = sub = sub[order]
        key = key[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[open_] = fresh
        rank[sub] = np.maximum.accumulate(np.where(fresh, open_, 0))
        h *= 2
    return sa, words


def repeats(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its starts have a length-byte string that starts elsewhere in these contexts too."""
    sizes = np.array([len(c) for c in contexts])
    t = np.frombuffer(b"".join(contexts), np.uint8)
    n = len(t)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(n)  # bytes up to the end of the own context
    sa, words = suffix_array(t, length)
    sa = sa[left[sa] >= length]
    again = np.zeros(n, bool)
    if len(sa) > 1:
        # Kasai: along a run of places whose predecessors run along too, the common prefix shrinks by one
        phi = np.full(n, -1)
        phi[sa[1:]] = sa[:-1]
        i = np.flatnonzero(phi >= 0)
        j = phi[i]
        head = np.concatenate([[True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)])
        at = np.flatnonzero(head)
        run = np.diff(np.concatenate([at, [len(i)]]))
        hi, hj, most = i[at], j[at], np.minimum(left[i[at]], left[j[at]])
        most = np.minimum(most, run + length)
        lcp = np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        while len(live):
            x = words[hi[live] + lcp[live]] ^ words[hj[live] + lcp[live]]
            same = sum((x < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8)) + (x == 0)
            lcp[live] += same
            live = live[(same == 8) & (lcp[live] < most[live])]
        reach = np.repeat(np.minimum(lcp, most) + hi, run) - i
        hit = i[reach >= length]
        again[hit] = True
        again[phi[hit]] = True
    return [again[e - s : e - length + 1] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]


def shard_repeats(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """As repeats, but contexts in which no window's hash occurs twice do not enter the suffix array."""
    starts = [len(c) - length + 1 for c in contexts]
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    h = rolling(flat, length)
    offset = np.cumsum([0, *(len(c) for c in contexts)])
    index = np.concatenate([np.arange(o, o + s) for o, s in zip(offset.tolist(), starts, strict=False)])
    owner = np.repeat(np.arange(len(contexts)), starts)
    own = h[index]
    order = np.argsort(own)
    k = own[order]
    same = k[1:] == k[:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    out = [np.zeros(s, bool) for s in starts]
    some = np.unique(owner[twice]).tolist()
    if some:
        # the part of each context that its recurring windows cover
        cut = []
        bounds = np.cumsum([0, *starts])
        for c in some:
            w = np.flatnonzero(twice[bounds[c] : bounds[c + 1]])
            cut.append((c, int(w[0]), int(w[-1]) + 1))
        for (c, a, e), got in zip(cut, repeats([contexts[c][a : e + length - 1] for c, a, e in cut], length), strict=True):
            out[c][a:e] = got
    return out


#: A span (e is set), or a piece of a run of published windows (_W).
FOUND = "t1 long, t2 long, s long, e long, run long, piece int, windows binary"
_FOUND_KINDS = [*[pa.int64()] * 5, pa.int32(), pa.binary()]
_FOUND_NAMES = ["t1", "t2", "s", "e", "run", "piece", "windows"]
SPANS = "t1 long, t2 long, s long, e long"


def _spans(marks: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [(a, b + LENGTH - 1) for a, b in edge.reshape(-1, 2).tolist()]


def _found(rows: list[tuple]) -> pa.RecordBatch:
    cols = [*zip(*rows, strict=True), *[[None] * len(rows)] * 3] if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _FOUND_KINDS, strict=True)], names=_FOUND_NAMES)


_W = np.dtype([("w", "S16"), ("t1", "i8"), ("t2", "i8"), ("s", "i8"), ("marked", "?")])


def _published(contexts: list[tuple[bytes, np.ndarray, tuple]]) -> np.ndarray:
    """Each distinct window of these contexts once, in order of its fingerprint."""
    parts = []
    for context, marks, (one, two, s) in contexts:
        digests = b"".join([xxhash.xxh3_128_digest(context[i : i + LENGTH]) for i in range(len(marks))])
        part = np.empty(len(marks), _W)
        part["w"], part["t1"], part["t2"], part["s"], part["marked"] = np.frombuffer(digests, "S16"), one, two, s + np.arange(len(marks)), marks
        parts.append(part)
    every = np.concatenate(parts) if parts else np.empty(0, _W)
    # a window that occurs twice here is marked at both places, so any one of them will do
    return every[np.unique(every["w"], return_index=True)[1]]


def _pieces(run: np.ndarray, pieces: int) -> list[tuple[int, bytes]]:
    """A sorted run by the leading bits of its fingerprints; pieces: a power of two, PIECES at most."""
    lead = np.ascontiguousarray(run["w"]).view(">u2").reshape(-1, 8)[:, 0].astype(np.int64) * pieces >> 16
    edge = np.concatenate([[0], np.flatnonzero(np.diff(lead)) + 1, [len(run)]]) if len(run) else [0]
    return [(int(lead[a]), run[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:], strict=True)]


def _halves(w: np.ndarray) -> list[np.ndarray]:
    """The fingerprint as two signed longs that sort as its bytes do."""
    halves = np.ascontiguousarray(w).view(">u8").reshape(-1, 2).astype(np.uint64) ^ np.uint64(1 << 63)
    return [np.ascontiguousarray(halves[:, i]).view(np.int64) for i in (0, 1)]


def _whole(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    """What _halves took apart."""
    halves = np.stack([w1, w2], 1).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(halves.astype(">u8")).view("S16").ravel()


def _shards(shard_bytes: int, pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by shard: spans, and for salted or cut shards the run of their distinct windows in pieces."""

        def settle(rows: dict[bytes, list[tuple]], shared: set[bytes], name: int) -> Iterator[pa.RecordBatch]:
            spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
            contexts, open_ = list(rows), []
            for context, marks in zip(contexts, shard_repeats(contexts), strict=True):
                places = rows[context]
                if len(places) > 1:
                    marks = np.ones(len(marks), bool)
                if runs := _spans(marks):
                    for one, two, s in places:
                        spans.setdefault((one, two), []).extend((s + a, s + b) for a, b in runs)
                if context in shared:
                    open_.append((context, marks, places[0]))
            out = [(*key, s, e) for key, found in spans.items() for s, e in _joined(found)]
            for i in range(0, len(out), 20_000):
                yield _found(out[i : i + 20_000])
            if cut := _pieces(_published(open_), pieces):
                cols = [*[[None] * len(cut)] * 4, [name] * len(cut), *zip(*cut, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _FOUND_KINDS, strict=True)], names=_FOUND_NAMES)

        rows: dict[bytes, list[tuple]] = {}
        shared: set[bytes] = set()
        size, now, cuts = 0, None, 0

        def name() -> int:
            """Of the run of this shard: the same whenever the task runs."""
            return int.from_bytes(xxhash.xxh64_digest(repr((now, cuts)).encode()), "big", signed=True)

        for b in batches:
            settled = []
            for h, salt, one, two, s, n, context in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if context is None:
                    settled.append((one, two, s, s + n))
                    continue
                if (h, salt) != now:
                    if size >= shard_bytes:
                        yield from settle(rows, shared, name())
                        rows, shared, size = {}, set(), 0
                    now, cuts = (h, salt), 0
                elif size >= 4 * shard_bytes:  # a shard that outgrew its salt is cut
                    shared.update(rows)
                    yield from settle(rows, shared, name())
                    rows, shared, size = {}, set(), 0
                    cuts += 1
                places = rows.setdefault(context, [])
                if (one, two, s) not in places[-1:]:
                    size += len(context) if not places else 0
                    places.append((one, two, s))
                if salt >= 0 or cuts:
                    shared.add(context)
            if settled:
                yield _found(settled)
        yield from settle(rows, shared, name()) if rows else ()

    return run


_RUN = np.dtype([("w", "S16"), ("place", "u8"), ("twice", "?")])


def merge_runs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two sorted runs of distinct windows as one; a window of both is there twice unless it has the same place in both."""
    if len(a) < len(b):
        a, b = b, a
    if not len(b):
        return a
    at = np.searchsorted(a["w"], b["w"])
    same = a["w"][np.minimum(at, len(a) - 1)] == b["w"]
    i = at[same]
    a["twice"][i] |= b["twice"][same] | (a["place"][i] != b["place"][same])
    return np.insert(a, at[~same], b[~same])


def _place(run: np.ndarray) -> np.ndarray:
    one, two, s = (np.ascontiguousarray(run[c]).view(np.uint64) for c in ("t1", "t2", "s"))
    with np.errstate(over="ignore"):
        return _mix(one * np.uint64(_P) + two + s * np.uint64(0xD6E8FEB86659FD93))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From published runs, one behind the other: spans of windows that no shard has marked and two shards hold."""
    merged: list[np.ndarray] = []  # runs, each at least twice as long as the next
    asked: list[np.ndarray] = []
    now, parts = None, []

    def push() -> None:
        run = np.concatenate(parts) if parts else np.empty(0, _W)
        parts.clear()
        asked.append(run[~run["marked"]])
        r = np.empty(len(run), _RUN)
        r["w"], r["twice"], r["place"] = run["w"], run["marked"], _place(run)
        while len(r):  # once, unless two shards have one name
            first = np.concatenate([[True], r["w"][1:] != r["w"][:-1]])
            merged.append(r[first])
            r = r[~first]
            while len(merged) > 1 and len(merged[-2]) < 2 * len(merged[-1]):
                merged.append(merge_runs(merged.pop(), merged.pop()))

    for b in batches:
        run, w1, w2, one, two, s, marked = (b.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        part = np.empty(b.num_rows, _W)
        part["w"], part["t1"], part["t2"], part["s"], part["marked"] = _whole(w1, w2), one, two, s, marked
        edge = np.concatenate([[0], np.flatnonzero(run[1:] != run[:-1]) + 1, [len(run)]]) if len(run) else [0]
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            if run[x] != now:
                push()
                now = run[x]
            parts.append(part[x:y])
    push()
    while len(merged) > 1:
        merged.append(merge_runs(merged.pop(), merged.pop()))
    for q in asked:
        if len(q):
            every = merged[0]
            hit = q[every["twice"][np.searchsorted(every["w"], q["w"])]]
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (hit["t1"], hit["t2"], hit["s"], hit["s"] + LENGTH)], names=["t1", "t2", "s", "e"])


def _across_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_across for each piece; rows (piece, run, windows) in order of piece and run."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))

    def opened(some: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for _, run, data in some:
            w = np.frombuffer(data, _W)
            cols = [np.full(len(w), run), *_halves(w["w"]), *(np.ascontiguousarray(w[c]) for c in ("t1", "t2", "s", "marked"))]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, cols)), names=["run", "w1", "w2", "t1", "t2", "s", "marked"])

    for _, some in groupby(rows, itemgetter(0)):
        yield from _across(opened(some))


def repeated_spans(docs: DataFrame, group: int = GROUP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(t1, t2, s, e): byte spans of distinct texts that repeated strings cover; they may overlap."""
    texts = docs.select("text")
    anchors = texts.mapInArrow(_anchor_rows, "h long, t1 long, t2 long, pos long")
    place = F.xxhash64("t1", "t2", "pos")
    often = anchors.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    often = stored(often.select("h", "n"), "anchors")
    marks = anchors.join(often, "h").groupBy("t1", "t2").agg(F.collect_set(F.struct("pos", "n")).alias("marks"))
    one = packed(texts, ["t1", "t2", "size"], once=True).withColumnRenamed("text", "z")
    contexts = one.join(marks, ["t1", "t2"]).select("t1", "t2", "z", "size", "marks").mapInArrow(_contexts(group), CONTEXTS)
    dealt = contexts.repartition("h", "salt").sortWithinPartitions("h", "salt")
    # no more windows than these share an anchor that is salted
    most = (often.where(F.col("n") > group).agg(F.sum("n")).first()[0] or 0) * (LENGTH - GRAM + 1)
    pieces = min(PIECES, 1 << (-(-most // MERGED)).bit_length())
    found = stored(dealt.mapInArrow(_shards(shard_bytes, pieces), FOUND), "repeats")
    windows = found.where("e is null").select("piece", "run", "windows")
    spans = found.where("e is not null").select("t1", "t2", "s", "e")
    if windows.limit(1).count():
        spans = spans.union(windows.repartition(pieces, "piece").sortWithinPartitions("piece", "run").mapInArrow(_across_pieces, SPANS))
    one, two = spark_key(F.col("text"))
    copies = docs.select(one.alias("t1"), two.alias("t2")).groupBy("t1", "t2").count().where("count > 1")
    return spans.union(copies.select("t1", "t2", F.lit(0).cast("long").alias("s"), F.lit(1 << 62).alias("e")))


def _cover(spans: list | None, size: int) -> list[tuple[int, int]]:
    """Maximal removed runs."""
    return _joined([(x["s"], min(x["e"], size)) for x in spans or ()]) if size >= LENGTH else []


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for s, e in runs:
        parts.append(raw[at:s])
        at = e
    return b"".join([*parts, raw[at:]])


def _with_spans(docs: DataFrame, **how: int) -> DataFrame:
    """The columns of docs, text packed, and behind them the text's size and spans."""
    one, two, size, spans = unused(docs, "t1", "t2", "size", "spans")
    found = repeated_spans(docs, **how).groupBy("t1", "t2").agg(F.collect_list(F.struct("s", "e")).alias(spans))
    found = found.select(F.col("t1").alias(f"{one}_"), F.col("t2").alias(f"{two}_"), spans)
    rows = packed(docs, [one, two, size])
    return rows.join(found, (rows[one] == found[f"{one}_"]) & (rows[two] == found[f"{two}_"]), "left").drop(one, two, f"{one}_", f"{two}_")


def removal_report(docs: DataFrame, **how: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per document."""
    rows = _with_spans(docs.select("doc_id", "text"), **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, count, digest = [], [], []
            for z, n, spans in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                runs = _cover(spans, n)
                removed.append(sum(e - s for s, e in runs))
                count.append(len(runs))
                digest.append(hashlib.sha256(_kept(_unpack(z, n), runs)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    longs = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    return rows.mapInArrow(run, T.StructType([docs.select("doc_id").schema[0], *longs, T.StructField("kept_sha256", T.StringType())]))


def remove_repeats(docs: DataFrame, **how: int) -> DataFrame:
    """All rows and columns; text without its repeated bytes (and n_chars counted anew)."""
    rows = _with_spans(docs, **how)
    at, n_at = docs.columns.index("text"), recounted(docs)
    names = docs.columns
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, at):
            texts = [_kept(_unpack(z, n), _cover(spans, n)).decode("utf-8", "ignore") for z, n, spans in zip(*(b.column(i).to_pylist() for i in (at, width, width + 1)), strict=True)]
            cols = list(b.columns[:width])
            cols[at] = pa.array(texts, pa.string())
            if n_at is not None:
                cols[n_at] = pa.array(map(len, texts), b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return rows.mapInArrow(run, docs.schema)


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(read_table(spark, sf_dir, "documents"))


#: By the contract: every 200-byte string by its MD5, over the hex form, cut into parts to stay quick.
ORACLE_SQL = """
WITH d AS (
    SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents
), c AS (
    SELECT doc_id, j, substr(h, 1000 * j + 1, 1400) AS part, n FROM (SELECT doc_id, h, n, unnest(range(0, (n - 200) // 500 + 1)) AS j FROM d WHERE n >= 200)
), w AS (
    SELECT doc_id, 500 * j + i AS i, md5(substr(part, 2 * i + 1, 400)) AS s FROM (SELECT doc_id, j, part, n, unnest(range(0, least(500, n - 199 - 500 * j))) AS i FROM c)
), r AS (
    SELECT w.doc_id, w.i FROM w JOIN (SELECT s FROM w GROUP BY s HAVING count(*) > 1) t ON w.s = t.s
), o AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens FROM r
), k AS (
    SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM o
), spans AS (
    SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM k GROUP BY doc_id, run
), pieces AS (
    SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM spans
), cut AS (
    SELECT p.doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) || substr(any_value(h), 2 * max(e) + 1) AS kept
    FROM pieces p JOIN d ON p.doc_id = d.doc_id GROUP BY p.doc_id
)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
"""
