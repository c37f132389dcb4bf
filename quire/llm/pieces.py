"""SentencePiece BPE encoding and decoding over a table of distinct chunks.

No piece of the model goes on past the start of a word, which a marker shows
(``▁``, in place of a space), nor holds a line break or a tab, nor a letter and
the comma behind it.  So texts are cut there, and no merge crosses a cut.

1. Frequent chunks.  The corpus is counted chunk by chunk; the most frequent
   ones, ``FREQUENT_BYTES`` at most, are segmented and travel to all workers by
   the shared folder.
2. Codes.  Texts are taken in blocks of about ``BLOCK`` bytes.  Each becomes a
   list of 16-bit codes, one for each chunk: its number among the frequent ones,
   or a mark that says "the next rare one".  The distinct rare chunks of a block
   stand beside its codes, dealt into buckets by their CRC-32.
3. Table.  Rare chunks are exchanged by bucket; there each distinct one is
   segmented once, whatever the number of blocks that ask for it.
4. Join.  Id lists come back to their block in the order in which they were asked
   for; codes, then ids, are put together by position.

No key is hot: a block asks for a chunk once, and what most blocks would ask for
is among the frequent ones.  Which chunks are frequent decides speed only.  A
chunk of more than ``LONG_CHUNK`` characters that cannot be cut is no word; it
is segmented where it stands.

Defined cases: a null or empty text has the begin and end ids only and decodes
to ''; repeated rows and rows without doc_id get a row each; a very long chunk is
cut further wherever no piece holds both neighbours, then merged in a heap; a
text that holds the marker itself decodes to a space there, as the library does;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache
from string import ascii_letters

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.bpe import ship
from quire.llm.common import read_table, small_batches, stored

MARK = "▁"
#: Frequent chunks: so many, of so many bytes with their ids.
FREQUENT, FREQUENT_BYTES = 65_535, 16 << 20
#: The code of a rare chunk.
RARE = 65_535
#: Distinct chunks that a task counts at a time; those it met less often than LEAST_COUNT among them are none of the most frequent.
COUNTED_AT_ONCE, LEAST_COUNT = 200_000, 4
#: Bytes of a block, chunks that a bucket should be asked for, fewest buckets.
BLOCK, ASKED, BUCKETS = 16 << 20, 500_000, 16
#: Chunks of more characters than this are cut further; longer lists of symbols merge in a heap.
LONG = 64
#: Chunks of more characters stay where they are.
LONG_CHUNK = 1000
#: Between words of a list; no byte of UTF-8.
BETWEEN = b"\xff"
#: Columns of a block.
PARTS = ("sizes", "codes", "slots", "buckets", "long")
#: Ids that are put together at a time.
STRIDE = 1 << 20
#: Rows of a batch that goes back.
ROWS = 1000
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("quire-each-byte", _each_byte)


def _messages(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protocol buffer message, in order."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        n = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + n]
        at += n


class PieceModel:
    """Pieces, scores and settings of a model file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            top = list(_messages(f.read()))
        trainer = dict(_messages(next((v for k, v in top if k == 2), b"")))
        normal = dict(_messages(next((v for k, v in top if k == 3), b"")))
        pieces, kinds, scores = [], [], []
        for k, v in top:
            if k == 1:
                part = dict(_messages(v))
                pieces.append(part[1].decode())
                scores.append(float(np.frombuffer(part.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(part.get(3, NORMAL))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models with byte fallback are read")
        if normal.get(1, b"") != b"identity" or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError("only models that leave texts as they are, with marked spaces, are read")
        self.prefix = bool(normal.get(3, 1))
        self.begin, self.end = (pieces.index(trainer.get(k, d).decode() if isinstance(trainer.get(k, d), bytes) else d) for k, d in ((46, b"<s>"), (47, b"</s>")))
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes on past a marker")
        #: what a merge to this piece costs: the least goes first
        self.cost = {p: -scores[i] for p, i in self.ids.items()}
        self.byte_ids = [0] * 256
        for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
            if k == BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        letters = set("".join(self.ids))
        breaks = "".join(re.escape(c) for c in "\t\n\x0b\x0c\r" if c not in letters)
        #: neighbours inside a piece
        self.neighbours = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        after = "".join(re.escape(c) for c in map(chr, range(0x21, 0x7F)) if not c.isalpha() and not any(x + c in self.neighbours for x in ascii_letters))
        word = f"{MARK}*[A-Za-z]++(?=[{after}])|" if after else ""
        self._cut = re.compile(f"{word}{MARK}*[^{MARK}{breaks}]+|{MARK}+" + (f"|[{breaks}]" if breaks else "")).findall
        spelled = [
            p.replace(MARK, " ").encode() if k == NORMAL else bytes([int(p[3:5], 16)]) if k == BYTE else trainer.get(44, b" \xe2\x81\x87 ") if k == UNKNOWN else b""
            for p, k in zip(pieces, kinds, strict=True)
        ]
        self.bytes_ = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.marked = np.fromiter((k == NORMAL and p.startswith(MARK) for p, k in zip(pieces, kinds, strict=True)), bool, len(pieces))
        self.silent = np.fromiter((k == CONTROL for k in kinds), bool, len(kinds))

    def chunks(self, text: str) -> list[str]:
        """The text in parts that no piece crosses."""
        if not text:
            return []
        marked = text.replace(" ", MARK)
        found = self._cut(MARK + marked if self.prefix else marked)
        if len(max(found, key=len)) > LONG:
            found = [part for c in found for part in (self._fine(c) if len(c) > LONG else (c,))]
        return found

    def _fine(self, chunk: str) -> Iterator[str]:
        start, near = 0, self.neighbours
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in near:
                yield chunk[start:i]
                start = i
        yield chunk[start:]

    def segment(self, chunk: str) -> list[int]:
        """The ids of one chunk: the cheapest neighbours merge again and again, the leftmost of equals."""
        whole = self.ids.get(chunk) if len(chunk) == 1 else None
        parts = [chunk] if whole is not None else self._merged(chunk)
        out = []
        for p in parts:
            i = self.ids.get(p)
            if i is None:
                out += [self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
        return out

    def _merged(self, chunk: str) -> list[str]:
        get, none = self.cost.get, float("inf")
        parts = list(chunk)
        if len(parts) > LONG:
            return self._merged_long(parts)
        costs = [get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while costs:
            best = min(costs)
            if best == none:
                break
            i = costs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i:
                costs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(costs):
                costs[i] = get(parts[i] + parts[i + 1], none)
        return parts

    def _merged_long(self, parts: list[str]) -> list[str]:
        n, get = len(parts), self.cost.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int, j: int) -> None:
            if (c := get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (c, i, len(parts[i]), len(parts[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j >= n or len(parts[i]) != left or len(parts[j]) != right:
                continue  # one side has merged meanwhile
            parts[i], parts[j] = parts[i] + parts[j], ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that make no character become U+FFFD each."""
        out = b"".join(self.bytes_[_places(self.starts[x], self.lengths[x])].tobytes() for x in (ids[a : a + STRIDE] for a in range(0, len(ids), STRIDE)))
        heard = np.flatnonzero(~self.silent[ids[:2]])  # begin and end stand alone; the first other piece decides
        if self.prefix and len(heard) and self.marked[ids[heard[0]]]:
            out = out[1:]
        return out.decode("utf-8", "quire-each-byte")


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] places, then those of starts[1], and so on."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


@cache
def model(path: str | None) -> PieceModel:
    """Of this process: the default model where it is installed (None), or one that was shipped."""
    return PieceModel(default_model() if path is None else SparkFiles.get(path))


def model_name(spark: SparkSession, path: str | None) -> str | None:
    """What names a model to workers: None for the default one; others are shipped."""
    if path is None:
        return None
    with open(path, "rb") as f:
        return ship(spark, f.read(), "pieces", ".model")


def chunk_counts(docs: DataFrame, name: str | None = None, least: int = LEAST_COUNT) -> DataFrame:
    """(chunk, n) of all texts; of the many that a task meets less often than least the number, under a null chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, counts = model(name).chunks, Counter()

        def flush() -> pa.RecordBatch:
            often = {c: n for c, n in counts.items() if n >= least}
            out = pa.RecordBatch.from_arrays([pa.array([*often, None], pa.string()), pa.array([*often.values(), len(counts) - len(often)], pa.int64())], names=["chunk", "n"])
            counts.clear()
            return out

        for b in small_batches(batches, 0):
            for text in b.column(0).to_pylist():
                counts.update(chunks(text or ""))
                if len(counts) > COUNTED_AT_ONCE:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def frequent_chunks(docs: DataFrame, name: str | None = None, room: int = FREQUENT_BYTES, most: int = FREQUENT, least: int = LEAST_COUNT) -> tuple[pa.Table, int]:
    """(chunk, ids) of the most frequent chunks, the most frequent first; and about how many rare ones blocks will ask for.

    A histogram of the counts (64 steps to a doubling) gives the count from which on they fit, in number and in bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = model(name).segment
        for b in batches:
            ids = pa.array([None if c is None else segment(c) for c in b.column(0).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids], names=["chunk", "n", "ids"])

    short = F.col("chunk").isNull() | (F.char_length("chunk") <= LONG_CHUNK)
    counted = stored(chunk_counts(docs, name, least).where(short).mapInArrow(run, "chunk string, n long, ids array<int>"), "chunks")
    weight = F.coalesce(F.octet_length("chunk") + 4 * F.size("ids") + 64, F.lit(0))
    step = F.when(F.col("chunk").isNotNull(), F.floor(F.log2("n") * 64).cast("int"))
    steps = {r.s: r for r in counted.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.sum(weight).alias("w"), F.sum("n").alias("n")).collect()}
    rare = steps.pop(None).n or 0 if None in steps else 0
    from_ = None
    for s, r in sorted(steps.items(), reverse=True):
        room, most = room - r.w, most - r.k
        if room < 0 or most < 0:
            break
        from_ = s
    rows = [] if from_ is None else counted.where(step >= from_).orderBy(F.desc("n"), "chunk").collect()
    return pa.table({"chunk": pa.array([r.chunk for r in rows], pa.string()), "ids": pa.array([r.ids for r in rows], pa.list_(pa.int32()))}), rare


class Frequent:
    """The frequent chunks in a worker."""

    def __init__(self, path: str) -> None:
        with pa.memory_map(path) as f:
            table = pa.ipc.open_file(f).read_all().combine_chunks()
            self.number = {c: i for i, c in enumerate(table["chunk"].to_pylist())}
            lists = table["ids"].chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
            offsets = lists.offsets.to_numpy().astype(np.int64)
            self.ids = np.array(lists.values.to_numpy(), np.int64)
        n = len(self.number)
        self.starts, self.lengths = np.zeros(RARE + 1, np.int64), np.zeros(RARE + 1, np.int64)
        if n:
            self.starts[:n], self.lengths[:n] = offsets[:-1], np.diff(offsets)


@lru_cache(maxsize=1)
def frequent(path: str) -> Frequent:
    return Frequent(path)


def _packed(*arrays: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a if isinstance(a, bytes) else a.tobytes() for a in arrays))


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _lists(ids: list[list[int]]) -> bytes:
    """How many, the length of each, then all ids."""
    lengths = np.fromiter(map(len, ids), "<u4", len(ids))
    return _packed(np.array([len(ids)], "<u4"), lengths, np.fromiter((i for x in ids for i in x), "<u4", int(lengths.sum())))


def _block(pieces: PieceModel, number: dict[str, int], texts: list[str | None], buckets: int) -> tuple[bytes, bytes, bytes, bytes, bytes, list[dict]]:
    """(chunks of each text, codes, rare ones in order, bucket of each rare one, id lists of the long ones, words by bucket) of a block.

    Rare ones are numbered as they come up; in order stands 0 for a new one, else its number plus 1.
    """
    sizes, codes, local, slots = [], [], {}, []
    for text in texts:
        chunks = pieces.chunks(text or "")
        sizes.append(len(chunks))
        found = list(map(number.get, chunks))
        if None in found:
            for c, i in zip(chunks, found, strict=True):
                if i is None:
                    known = len(local)
                    k = local.setdefault(c, known)
                    slots.append(0 if k == known else k + 1)
            found = [RARE if i is None else i for i in found]
        codes.append(np.array(found, "<u2"))
    words = list(local)
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    bucket = np.fromiter((buckets if len(w) > LONG_CHUNK else zlib.crc32(r) % buckets for w, r in zip(words, raw, strict=True)), _bucket_type(buckets), len(words))
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
    rare = [{"bucket": k, "words": _packed(BETWEEN.join([raw[i] for i in order[a:e].tolist()]))} for k, (a, e) in enumerate(zip(edge, edge[1:], strict=False)) if e > a]
    long = _lists([pieces.segment(words[i]) for i in order[edge[-1] :].tolist()])
    return _packed(np.array(sizes, "<u4")), _packed(*codes), _packed(np.array(slots, "<u4")), _packed(bucket), long, rare


def _bucket_type(buckets: int) -> str:
    return "<u2" if buckets < 1 << 16 else "<u4"


def _coded(name: str | None, known: str, buckets: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, number = model(name), frequent(SparkFiles.get(known)).number
        held, size = [], 0

        def close() -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column(0) for b in held])
            own = _block(pieces, number, [t for b in held for t in b.column(1).to_pylist()], buckets)
            kinds = [pa.binary()] * 5 + [pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(ids)], ids), *(pa.array([v], k) for v, k in zip(own, kinds, strict=True))], names=["doc_id", *PARTS, "rare"])

        for b in small_batches(batches, 1, block):
            held.append(b)
            size += b.column(1).nbytes + b.num_rows
            if size >= block:
                yield close()
                size = 0
        if held:
            yield close()

    return run


def _segmented(name: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, bucket, lists): the ids of the words that a block asks a bucket for; words met before are known."""
        segment, known = model(name).segment, {}
        for b in batches:
            out = []
            for words in b.column(2).to_pylist():
                found = []
                for w in _unpacked(words).split(BETWEEN):
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = segment(w.decode("utf-8", "surrogatepass"))
                    found.append(ids)
                out.append(_lists(found))
                if len(known) > 2 * ASKED:
                    known.clear()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["block", "bucket", "lists"])

    return run


def _assembled(name: str | None, known: str, buckets: int, keep_text: bool, names: list[str]):
    def whole(ids: np.ndarray) -> tuple:
        text = model(name).decode(ids)
        return (len(ids), ids, text) if keep_text else (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, often = model(name), frequent(SparkFiles.get(known))
        for b in batches:
            for r in range(b.num_rows):
                sizes, codes, slots, bucket, long, lists = (b.column(c)[r].as_py() for c in range(1, 7))
                # the rare ones' ids behind those of the frequent ones
                lengths, pool = [], [often.ids]
                for data in [*(x["lists"] for x in sorted(lists or (), key=lambda x: x["bucket"])), long]:
                    x = np.frombuffer(_unpacked(data), "<u4").astype(np.int64)
                    lengths.append(x[1 : 1 + x[0]])
                    pool.append(x[1 + x[0] :])
                length, pool = np.concatenate(lengths), np.concatenate(pool)
                start = len(often.ids) + np.cumsum(length) - length
                place = np.empty(len(length), np.int64)  # of each rare one among the lists, by its number
                place[np.argsort(np.frombuffer(_unpacked(bucket), _bucket_type(buckets)), kind="stable")] = np.arange(len(length))
                codes, slots = np.frombuffer(_unpacked(codes), "<u2"), np.frombuffer(_unpacked(slots), "<u4").astype(np.int64)
                new = slots == 0
                place = place[np.where(new, np.cumsum(new) - 1, slots - 1)]
                starts, counts = often.starts[codes], often.lengths[codes]
                rare = codes == RARE
                starts[rare], counts[rare] = start[place], length[place]
                edge = np.cumsum([0, *np.frombuffer(_unpacked(sizes), "<u4").tolist()]).tolist()
                out = []
                for a, e in zip(edge, edge[1:], strict=False):
                    steps = [(i, min(i + STRIDE, e)) for i in range(a, e, STRIDE)]
                    out.append(whole(np.concatenate([[pieces.begin], *(pool[_places(starts[i:j], counts[i:j])] for i, j in steps), [pieces.end]]).astype("<u4")))
                docs = b.column(0)[r].values
                for i in range(0, len(out), ROWS):
                    n, ids, texts = zip(*out[i : i + ROWS], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [docs.slice(i, ROWS), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32()) if keep_text else pa.string()), pa.array(texts, pa.string())], names=names
                    )

    return run


def piece_documents(docs: DataFrame, model_path: str | None = None, keep_text: bool = True, room: int = FREQUENT_BYTES, most: int = FREQUENT, least: int = LEAST_COUNT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens, ids (begin and end among them), decoded; without keep_text their SHA-256 instead."""
    spark = docs.sparkSession
    name = model_name(spark, model_path)
    table, asked = frequent_chunks(docs, name, room, most, least)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema) as writer:
        writer.write_table(table)
    known = ship(spark, sink.getvalue().to_pybytes(), "frequent", ".arrow")
    buckets = max(BUCKETS, -(-asked // ASKED))

    id_type = docs.schema["doc_id"]
    rare = T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("words", T.BinaryType())]))
    blocks = T.StructType([T.StructField("doc_id", T.ArrayType(id_type.dataType)), *(T.StructField(c, T.BinaryType()) for c in PARTS), T.StructField("rare", rare)])
    coded = docs.select("doc_id", "text").mapInArrow(_coded(name, known, buckets, block), blocks)
    coded = stored(coded.select(F.monotonically_increasing_id().alias("block"), "*"), "coded")  # written, so that a block keeps its number
    wanted = coded.select("block", F.inline("rare")).repartition(buckets, "bucket")
    answers = wanted.mapInArrow(_segmented(name), "block long, bucket int, lists binary").groupBy("block").agg(F.collect_list(F.struct("bucket", "lists")).alias("lists"))
    whole = coded.drop("rare").join(answers.hint("shuffle_hash"), "block", "left").drop("block")
    names = ["doc_id", "n_tokens", "ids", "decoded"] if keep_text else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = (T.LongType(), T.ArrayType(T.IntegerType()) if keep_text else T.StringType(), T.StringType())
    return whole.mapInArrow(_assembled(name, known, buckets, keep_text, names), T.StructType([id_type, *(T.StructField(c, k) for c, k in zip(names[1:], kinds, strict=True))]))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_documents(read_table(spark, sf_dir, "documents"), keep_text=False)
