"""Quality rules, line first.

Each line of a document meets the line rules; failing lines are removed, and a
document goes if it fails a base rule or if the removed lines held too large a
share of its words.

Defined cases: a null text counts as empty; an empty text has no words, so it
fails the base rule.  Any other columns, whatever their names, pass through
``clean_lines`` untouched, but for ``n_chars``, which is counted anew if it holds
whole numbers.  Repeated rows get equal results, row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quire.llm.common import SPACES, read_table, recounted, small_batches

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: A document goes when failing lines held more than this share of its word characters.
MAX_REMOVED = 0.5
#: Share of a line's word characters that may be symbols or separators.
MAX_SYMBOLS = 0.1
MAX_UPPER = 0.7
SYMBOLS = "#*$%&|<>"

#: Share of a line's words that may equal the word before.
MAX_STUTTER = 0.5

#: Phrases that mark boilerplate lines (lower case).
BOILERPLATE = (
    "all rights reserved", "licensed under the", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "accept all cookies", "enable javascript", "subscribe to our newsletter", "sign up for our", "click here", "lorem ipsum", "copyright (c)",
    "copyright ©", "permission is hereby granted",
)
_SEPARATORS = frozenset(("|", ">", "»", "•", "·", "/", "::", "-"))
_SENTENCE_END = (".", "!", "?", "…", ":", ";", '"', "'", "”", "’", ")", "]", "»", ",", "。")


def count_chars(text: str, chars: str) -> int:
    return sum(map(text.count, chars))


def line_fails(line: str, symbols: bool = True, phrases: tuple[str, ...] = BOILERPLATE) -> str:
    """The rule that a line with words fails, or ''.  symbols, phrases: what its document has at all."""
    words = line.split()
    if not words:
        return ""
    n = len(words)
    if symbols and count_chars(line, SYMBOLS) > MAX_SYMBOLS * sum(map(len, words)):
        return "navigation" if line.count("|") * 4 > n else "symbols"
    if n >= 3 and line.count("!!") and sum(w.endswith("!!") for w in words) * 2 > n:
        return "punctuation"
    if n >= 4:
        if sum(map(_SEPARATORS.__contains__, words)) * 4 > n:
            return "navigation"
        if len(line) >= 20 and sum(map(str.isupper, words)) > MAX_UPPER * n:
            return "punctuation"
        if n >= 8 and sum(map(eq, words, islice(words, 1, None))) > MAX_STUTTER * n:
            return "stutter"
    if n >= 40 and not words[-1].endswith(_SENTENCE_END) and not any(w[-1] in ".!?,;:" for w in words):
        return "punctuation"
    if phrases and n <= 60:
        low = line.lower()
        if any(p in low for p in phrases):
            return "boilerplate"
    return ""


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in windows of so many words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        s = np.zeros(n, np.uint64)
        for i in range(window):
            s = s * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    order = np.argsort(s)
    t = s[order]
    same = t[1:] == t[:-1]
    if not same.any():
        return 0
    both = np.zeros(n, bool)
    both[1:] |= same
    both[:-1] |= same
    seen: dict[tuple, int] = {}
    marks = np.zeros(len(words) + 1, np.int64)
    # equal sums are only a hint: the words themselves decide
    for i in order[both].tolist():
        j = seen.setdefault(tuple(words[i : i + window]), i)
        if j != i:
            for k in (i, j):
                marks[k] += 1
                marks[k + window] -= 1
    return int((np.cumsum(marks) > 0).sum())


def judge(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned text)"""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six ASCII spaces
    n_words = len(words)
    word_chars = len(text) - count_chars(text, SPACES)
    n_symbols = count_chars(text, SYMBOLS)
    low = text.lower()
    phrases = tuple(p for p in BOILERPLATE if p in low)
    lines = text.split("\n")
    seen: set[str] = set()
    dup = removed = 0
    good: list[str] = []
    for line in lines:
        if not line.strip(SPACES):
            good.append(line)
            continue
        again = line in seen
        if again:
            dup += 1
        else:
            seen.add(line)
        if (again and len(line) >= 20) or line_fails(line, n_symbols > 0, phrases):
            removed += len(line) - count_chars(line, SPACES)
        else:
            good.append(line)
    n_repeat = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    kept = not base_failed and removed <= MAX_REMOVED * word_chars
    return n_words, word_chars, n_symbols, dup, n_repeat, base_failed, kept, "\n".join(good) if removed else text


RULES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(n, T.BooleanType()) for n in ("base_failed", "kept")]
)


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id and the rule columns, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            cols = list(zip(*(judge(t)[:7] for t in b.column(1).to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols)], names=["doc_id", *RULES.names])

    out = T.StructType([docs.select("doc_id").schema[0], *RULES])
    return docs.select("doc_id", "text").mapInArrow(run, out)


def clean_lines(docs: DataFrame) -> DataFrame:
    """The documents that pass, all their columns, with failing lines cut from text (and n_chars counted anew)."""
    at, n_at = docs.columns.index("text"), recounted(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, at):
            got = [judge(t) for t in b.column(at).to_pylist()]
            keep = [i for i, g in enumerate(got) if g[6]]
            if not keep:
                continue
            cols = [c.take(pa.array(keep)) for c in b.columns]
            texts = [got[i][7] for i in keep]
            cols[at] = pa.array(texts, b.schema.field(at).type)
            if n_at is not None:
                cols[n_at] = pa.array(map(len, texts), b.schema.field(n_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"))


_WORD = r"[^\x20\x09-\x0D]"
_PHRASES = " OR ".join(f"contains(low, '{p}')" for p in BOILERPLATE)
ORACLE_SQL = f"""
WITH d AS (
    SELECT doc_id, t, regexp_extract_all(t, '{_WORD}+') AS ws, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols
    FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), windows AS (
    SELECT doc_id, i, md5(array_to_string(ws[i:i + 7], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) > 8)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS c FROM windows) WHERE c > 1
), opened AS (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 8 THEN 0 ELSE 1 END AS o FROM twice
), runs AS (
    SELECT doc_id, i, sum(o) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS r FROM opened
), rep AS (
    SELECT doc_id, sum(n)::BIGINT AS n_repeat_words FROM (SELECT doc_id, r, max(i) - min(i) + 8 AS n FROM runs GROUP BY doc_id, r) GROUP BY doc_id
), split AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(0, len(string_split(t, chr(10))))) AS j FROM d
), lines AS (
    SELECT doc_id, line, lower(line) AS low, regexp_extract_all(line, '{_WORD}+') AS w, row_number() OVER (PARTITION BY doc_id, line ORDER BY j) > 1 AS again FROM split WHERE regexp_matches(line, '{_WORD}')
), counted AS (
    SELECT *, len(w) AS n, length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars FROM lines
), judged AS (
    SELECT doc_id, chars, again,
        length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) > {MAX_SYMBOLS}::DOUBLE * chars
        OR (n >= 3 AND 2 * len(list_filter(w, lambda x: ends_with(x, '!!'))) > n)
        OR (n >= 4 AND 4 * len(list_filter(w, lambda x: x IN ('|', '>', '»', '•', '·', '/', '::', '-'))) > n)
        OR (n >= 4 AND length(line) >= 20 AND len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x))) > {MAX_UPPER}::DOUBLE * n)
        OR (n >= 8 AND len(list_filter(range(2, n + 1), lambda k: w[k] = w[k - 1])) > {MAX_STUTTER}::DOUBLE * n)
        OR (n >= 40 AND NOT regexp_matches(w[n], '[.!?…:;"''”’)\\]»,。]$') AND len(list_filter(w, lambda x: regexp_matches(x, '[.!?,;:]$'))) = 0)
        OR (n <= 60 AND ({_PHRASES}))
        OR (again AND length(line) >= 20) AS fails
    FROM counted
), per AS (
    SELECT doc_id, count(*) FILTER (WHERE again) AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE fails), 0) AS removed FROM judged GROUP BY doc_id
), done AS (
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(removed, 0) AS removed
    FROM d LEFT JOIN per ON d.doc_id = per.doc_id LEFT JOIN rep ON d.doc_id = rep.doc_id
), based AS (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM done
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND removed <= {MAX_REMOVED}::DOUBLE * word_chars AS kept FROM based
"""
