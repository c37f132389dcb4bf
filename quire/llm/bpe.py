"""BPE encoding and decoding with a transducer lexicon.

The corpus is counted word by word; the most frequent words are encoded once,
compiled into a minimal acyclic transducer with their ids as output, and the
file is shipped to every executor, where workers memory-map it.  Words outside
it are merged exactly, so the lexicon decides only speed.

Defined cases: a null or empty text has no ids and decodes to ''.  Very long
words merge in a heap, in n log n.  Other columns are not read; repeated rows
get equal results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import read_table, shared_dir, small_batches, stored
from quire.llm.lexicon import Lexicon, compile_lexicon
from quire.sources.sinks import put_bytes

#: So many words, each of at most so many UTF-8 bytes, bound the lexicon.
LEXICON_WORDS = 65536
LEXICON_BYTES = 48
CACHED_WORDS = 250_000
COUNTED_AT_ONCE = 200_000
#: Words of more symbols than this merge in a heap.
LONG_WORD = 100
#: Words that merge in step.
IN_STEP = 4096
NO_PAIR = 1 << 62

#: Blocks whose letters and marks no Unicode version has changed since long.  A text with a character outside them
#: is normalised and split by the library's own tables, as Unicode versions differ between libraries.
STABLE = ((0x00, 0x1B), (0x20, 0x84), (0x86, 0x24F), (0x2000, 0x206F), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
RECENT = re.compile("[^" + "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in STABLE) + "]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable Latin-1, else the next from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _word_pattern(pattern: str):
    """findall of the tokenizer's pattern for texts without RECENT characters: its classes written out, letters first."""
    stable = [chr(c) for a, z in STABLE for c in range(a, z + 1)]

    def ranges(kind: str) -> str:
        own = [ord(c) for c in stable if unicodedata.category(c)[0] == kind]
        cuts = [i for i in range(len(own)) if i == 0 or own[i] != own[i - 1] + 1]
        return "".join(f"\\U{own[i]:08x}-\\U{own[j - 1]:08x}" for i, j in zip(cuts, [*cuts[1:], len(own)], strict=True))

    if not pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"):
        raise ValueError(f"unknown split pattern {pattern}")
    letters, digits = ranges("L"), ranges("N")
    first = pattern.removesuffix(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    return re.compile(f"[{letters}]+|{first}|[{digits}]|[^\\s{letters}{digits}]+").findall


class WordBPE:
    """The model of a tokenizer file of the word-end kind."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        #: left << 32 | right -> rank << 32 | merged
        self.pairs: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs[self.vocab[a] << 32 | self.vocab[b]] = r << 32 | self.vocab[a + b]
        letters = byte_letters()
        self.first = [self.vocab.get(c) for c in letters]
        self.last = [self.vocab.get(c + self.end) for c in letters]
        self.decimal = {i: str(i) for i in self.token}
        keys = sorted(self.pairs)
        self.pair_keys = np.array(keys or [-1], np.int64)
        self.pair_values = np.array([self.pairs[k] for k in keys] or [NO_PAIR], np.int64)
        self.every_byte = None not in self.first and None not in self.last
        self.first_ids, self.last_ids = (np.array([-1 if i is None else i for i in x], np.int32) for x in (self.first, self.last))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = _word_pattern(split["pattern"]["Regex"])
        self.library = path
        self.specials = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word (its UTF-8 bytes) by merging the best pair again and again, the leftmost of equals."""
        first = self.first
        ids = [first[b] for b in word]
        ids[-1] = self.last[word[-1]]
        if None in ids:
            ids = [i for i in ids if i is not None]
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        get = self.pairs.get
        pairs = [get(a << 32 | b, NO_PAIR) for a, b in zip(ids, ids[1:], strict=False)]
        while pairs:
            best = min(pairs)
            if best == NO_PAIR:
                break
            i = pairs.index(best)
            ids[i : i + 2] = [best & 0xFFFFFFFF]
            del pairs[i]
            if i:
                pairs[i - 1] = get(ids[i - 1] << 32 | ids[i], NO_PAIR)
            if i < len(pairs):
                pairs[i] = get(ids[i] << 32 | ids[i + 1], NO_PAIR)
        return ids

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """As merge of each word; words of like length are merged in step, a row of a matrix each."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        for at in range(0, len(order), IN_STEP):
            rows = order[at : at + IN_STEP]
            rows = rows[sizes[rows] > 0]
            if len(rows) and (sizes[rows[-1]] > LONG_WORD or not self.every_byte):
                for r in rows.tolist():
                    out[r] = self.merge(words[r])
            elif len(rows):
                for r, ids in zip(rows.tolist(), self._merge_rows([words[r] for r in rows.tolist()], sizes[rows]), strict=True):
                    out[r] = ids
        return out

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (b >= 0), self.pair_values[at], NO_PAIR)

    def _merge_rows(self, words: list[bytes], sizes: np.ndarray) -> list[list[int]]:
        n, width = len(words), int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        ids = np.full((n, width), -1, np.int32)
        ids[inside] = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        ids[np.arange(n), sizes - 1] = self.last_ids[np.fromiter((w[-1] for w in words), np.uint8, n)]
        done: list[list[int]] = [[]] * n
        rows = np.arange(n)
        if width > 1:
            ranks = self._ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while len(rows):
            if ids.shape[1] > 1:
                i = ranks.argmin(1)
                best = ranks[np.arange(len(rows)), i]
                ended = best == NO_PAIR
            else:
                ended = np.ones(len(rows), bool)
            if ended.any():
                for r, x in zip(rows[ended].tolist(), ids[ended].tolist(), strict=True):
                    done[r] = x[: x.index(-1)] if x[-1] < 0 else x
                go = ~ended
                if not go.any():
                    break
                rows, ids, ranks, i, best = rows[go], ids[go], ranks[go], i[go], best[go]
            every = np.arange(len(rows))
            ids[every, i] = best & 0xFFFFFFFF
            # one symbol and one pair go; those behind them move up
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > i[:, None]), 1)
            cols = cols[:-1]
            ranks = np.take_along_axis(ranks, cols + (cols >= i[:, None]), 1)
            for left in (i - 1, i):
                ok = (left >= 0) & (left < ids.shape[1] - 1)
                r, c = every[ok], left[ok]
                ranks[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        return done

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = lambda a, b: (r >> 32, r & 0xFFFFFFFF) if (r := self.pairs.get(a << 32 | b)) is not None else None
        heap = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(n - 1) if (r := rank(ids[i], ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has merged meanwhile
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := rank(new, ids[k]):
                    heapq.heappush(heap, (r[0], i, new, ids[k], r[1]))
            if (h := before[i]) >= 0 and (r := rank(ids[h], new)):
                heapq.heappush(heap, (r[0], h, ids[h], new, r[1]))
        return [i for i in ids if i >= 0]

    def split(self, text: str) -> list[str]:
        """The words of normalised text."""
        if not RECENT.search(text):
            return self.words(text)
        letters = _letter_bytes()
        return [bytes(letters[c] for c in w).decode("utf-8", "surrogatepass") for w, _ in _splitter(self.library).pre_tokenize_str(text)]

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(special, string) in order; the strings that are not special are normalised text."""
        if self.specials is None or "<|" not in text:
            yield False, self.normal(text)
            return
        at = 0
        for m in self.specials.finditer(text):
            if m.start() > at:
                yield False, self.normal(text[at : m.start()])
            yield True, m[0]
            at = m.end()
        if at < len(text):
            yield False, self.normal(text[at:])

    def normal(self, text: str) -> str:
        if RECENT.search(text):
            return _normalizer(self.library).normalize_str(text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # letters are lowered one by one, without the rule for a final sigma
            text = text.replace("Σ", "σ")
        return text.lower()


@cache
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _normalizer(path: str):
    return _library(path).normalizer


def _splitter(path: str):
    return _library(path).pre_tokenizer


@cache
def _letter_bytes() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_letters())}


@cache
def model(path: str) -> WordBPE:
    return WordBPE(path)


@lru_cache(maxsize=1)
def lexicon(path: str) -> Lexicon:
    return Lexicon(path)


class _Numbers(dict):
    """A number for each word; a word asked for the first time gets the next one and is noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Encodes texts through the lexicon and a bounded cache of words already met."""

    def __init__(self, bpe: WordBPE, lex: Lexicon | None) -> None:
        self.bpe, self.lex = bpe, lex
        self.numbers = _Numbers()
        #: by number
        self.ids: list[str] = []
        self.texts: list[str] = []
        self.frequent: list[str] = []  # those met so far that the lexicon holds: they stay

    def _learn(self) -> None:
        """The ids of all words noted, at once."""
        special, token, decimal = self.bpe.special, self.bpe.token, self.bpe.decimal
        words = self.numbers.new
        self.numbers.new = []
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        places = self.lex.find(raw).tolist() if self.lex else [-1] * len(raw)
        rare = iter(self.bpe.merge_all([b for b, p in zip(raw, places, strict=True) if p < 0]))
        for w, p in zip(words, places, strict=True):
            if p >= 0:
                ids = self.lex.output(p)
                self.frequent.append(w)
            else:
                ids = next(rare)
            if w in special:  # no word of a text looks like one: it would split
                ids = [special[w]]
            self.ids.append(" ".join([decimal[i] for i in ids]))
            self.texts.append(" ".join([token[i] for i in ids]))

    def _forget(self) -> None:
        """Let go of rare words."""
        keep = [self.numbers[w] for w in self.frequent]
        self.ids, self.texts, self.numbers = [self.ids[n] for n in keep], [self.texts[n] for n in keep], _Numbers()
        self.numbers.update(zip(self.frequent, range(len(keep)), strict=True))

    def encode_all(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by one space, decoded text) of each text; words are learned for all at once."""
        if len(self.numbers) > CACHED_WORDS:
            self._forget()
        pieces, split, number = self.bpe.pieces, self.bpe.split, self.numbers.__getitem__
        found = []
        for text in texts:
            of_text: list[int] = []
            for special, s in pieces(text or ""):
                of_text += (number(s),) if special else map(number, split(s))
            found.append(of_text)
        self._learn()
        out = []
        ids_of, text_of = self.ids.__getitem__, self.texts.__getitem__
        for of_text in found:
            ids = " ".join(map(ids_of, of_text))
            out.append((ids.count(" ") + 1 if ids else 0, ids, " ".join(map(text_of, of_text))))
        return out

    def encode(self, text: str | None) -> tuple[int, str, str]:
        return self.encode_all([text])[0]


@lru_cache(maxsize=1)
def encoder(vocabulary: str, path: str) -> Encoder:
    """The latest of a worker process: its cache serves the tasks that the process runs, and goes with the next lexicon."""
    return Encoder(model(vocabulary), lexicon(path))


def vocabulary_file(spark: SparkSession, path: str | None) -> str | None:
    """What names a vocabulary to workers: None for the default one, which each finds where it is installed; others are shipped."""
    if path is None:
        return None
    with open(path, "rb") as f:
        return ship(spark, f.read(), "vocabulary", ".json")


def resolved(name: str | None) -> str:
    """The path of a vocabulary in this process."""
    return default_vocabulary() if name is None else SparkFiles.get(name)


def word_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """How often each normalised word occurs, over all texts; vocabulary as vocabulary_file gives it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, counts = model(resolved(vocabulary)), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for b in small_batches(batches, 0):
            for text in b.column(0).to_pylist():
                for special, s in bpe.pieces(text or ""):
                    if not special:
                        counts.update(bpe.split(s))
                if len(counts) > COUNTED_AT_ONCE:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, vocabulary: str | None = None, limit: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words, at most limit, each of bounded length.

    A histogram of the counts (64 steps to a doubling) gives the count from which on there are no more than limit
    words; so each word that reaches the driver is one of them, whatever the number of partitions.
    """
    counts = stored(word_counts(docs, vocabulary).where((F.octet_length("word") <= LEXICON_BYTES) & (F.col("n") > 1)), "words")
    step = F.floor(F.log2("n") * 64).cast("int")
    room, least = limit, None
    for s, k in sorted(((r.s, r.k) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect()), reverse=True):
        if k > room:
            break
        room, least = room - k, s
    if least is None:
        return []
    return [r.word for r in counts.where(step >= least).select("word").collect()]


def ship(spark: SparkSession, data: bytes, stem: str, suffix: str) -> str:
    """Give a file to every executor, by the folder that all share; the name to find it by."""
    name = f"{stem}-{hashlib.sha256(data).hexdigest()[:24]}{suffix}"
    if not any(f.endswith(name) for f in spark.sparkContext.listFiles):
        path = f"{shared_dir(spark, stem)}/{name}"
        put_bytes(spark, path, data)
        spark.sparkContext.addFile(path)
    return name


def bpe_documents(docs: DataFrame, vocabulary: str | None = None, words: int = LEXICON_WORDS, keep_text: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, one space between), decoded; without keep_text their SHA-256 instead."""
    spark = docs.sparkSession
    bpe = model(vocabulary or default_vocabulary())
    vocabulary = vocabulary_file(spark, vocabulary)
    frequent = [w.encode() for w in frequent_words(docs, vocabulary, words)]
    name = ship(spark, compile_lexicon(dict(zip(frequent, bpe.merge_all(frequent), strict=True))), "lexicon", ".bin")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(resolved(vocabulary), SparkFiles.get(name))
        for b in small_batches(batches, 1, 2 << 20):
            n, ids, texts = [], [], []
            for k, i, t in enc.encode_all(b.column(1).to_pylist()):
                n.append(k)
                ids.append(i if keep_text else hashlib.sha256(i.encode()).hexdigest())
                texts.append(t if keep_text else hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=names)

    names = ["doc_id", "n_tokens", "ids", "decoded"] if keep_text else ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    out = T.StructType([docs.select("doc_id").schema[0], T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.StringType()) for c in names[2:])])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_documents(read_table(spark, sf_dir, "documents"), keep_text=False)
