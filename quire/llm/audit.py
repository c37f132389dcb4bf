"""How five filters act on each other, over all 120 orders of them.

1. A row of documents becomes a mask of the filters it fails; nothing but the
   mask, the part, the doc_id and a hash of the text goes on.
2. Per part and label 32 signed sums are taken, one for each set s of filters:
   the sum of (-1)^(filters of s that a document fails).  They are the
   Walsh-Hadamard transform of the number of documents with each mask.
3. The transform is its own inverse but for a factor of 32, so five butterfly
   steps over the sums and an exact division give the 32 cells.
4. Each order and step reads its counts off the cells; a filter's Shapley value
   has a closed form, as a document that fails k filters is removed by each of
   them in 120 / k of the orders.

A text identical to an earlier one (E) is found without bringing copies
together: the smallest doc_id of each text is a pre-aggregated minimum, and rows
meet it by text and doc_id, a key that parts copies.

Defined cases: a null text is empty and so equal to an empty one; a row without
doc_id neither fails E nor has a label; rows that share a text and its smallest
doc_id all pass E, and each counts; a doc_id with several labels has those that
any of its rows give; a null lang is the part ''; empty documents give no rows.
Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import read_table, stored

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
CELLS = 1 << len(FILTERS)
ORDERS = 120
WORD_GAPS = r"[ \t-\r]+"
LEAST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 100, 80, 10, "[#$%&*|]"


def text_mask(text: Column) -> Column:
    """The bits of the filters A to D that a text fails."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        n = F.size(words)
        return F.when(n < LEAST_WORDS, BIT["A"]).otherwise(0) + F.when(100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n, BIT["B"]).otherwise(0)

    words = F.filter(F.split(text, WORD_GAPS), lambda w: w != "")
    points = F.char_length(text)
    capitals = points - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return (
        F.transform(F.array(words), of_words)[0]  # the words are taken once
        + F.when(100 * capitals > CAPITALS_PERCENT * points, BIT["C"]).otherwise(0)
        + F.when(text.rlike(SYMBOLS), BIT["D"]).otherwise(0)
    )


def masked(docs: DataFrame) -> DataFrame:
    """(part, doc_id, mask, n): how many rows with this doc_id and part have the mask."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("")).alias("part"), "doc_id", F.unhex(F.sha2(text, 256)).alias("h"), text_mask(F.col("text")).alias("mask"))
    rows = stored(rows.groupBy("part", "doc_id", "h", "mask").agg(F.count("*").alias("n")), "masks")
    first = rows.where("doc_id is not null").groupBy("h").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    rows = rows.join(first, ["h", "doc_id"], "left").withColumn("mask", F.col("mask") + F.when(later, BIT["E"]).otherwise(0))
    return rows.groupBy("part", "doc_id", "mask").agg(F.sum("n").alias("n"))


def signed_sums(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, good, toxic, sums): the 32 signed parity sums of each part and label."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, True).otherwise(False)).alias("good"), F.max(F.when(F.col("toxic") == 1, True).otherwise(False)).alias("toxic"))
    # rows without doc_id have no label and stay out of the join
    known = masks.where("doc_id is not null").join(marks, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    known = known.union(masks.where("doc_id is null").select("part", "mask", "n", F.lit(False), F.lit(False)))
    sums = [F.sum(F.col("n") * (1 - 2 * (F.bit_count(F.col("mask").bitwiseAND(s)) % 2))).alias(f"s{s}") for s in range(CELLS)]
    return known.groupBy("part", "good", "toxic").agg(*sums).select("part", "good", "toxic", F.array(*(f"s{s}" for s in range(CELLS))).alias("sums"))


def cells(sums: Column) -> Column:
    """The number of documents with each mask, from the signed sums: the transform once more, divided by 32."""

    def butterfly(values: Column, bit: int) -> Column:
        def step(v: Column) -> Column:
            return F.array(*(v[m ^ bit] - v[m] if m & bit else v[m] + v[m | bit] for m in range(CELLS)))

        return F.transform(F.array(values), step)[0]  # the values are taken once

    for bit in BIT.values():
        sums = butterfly(sums, bit)
    return F.transform(sums, lambda x: F.shiftright(x, len(FILTERS)))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the seven counts of it, for all parts, orders and steps."""
    by_label = signed_sums(masked(docs), labels).select("part", "good", "toxic", F.posexplode(cells(F.col("sums"))).alias("mask", "n"))
    counted = by_label.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
    whole = counted.groupBy("part").agg(*(F.array_sort(F.collect_list(F.struct("mask", c))).getField(c).alias(c) for c in ("n", "good", "toxic")))
    steps = [(order, k + 1, BIT[f], sum(BIT[g] for g in order[:k])) for order in map("".join, permutations(FILTERS)) for k, f in enumerate(order)]
    table = ", ".join(f"struct('{o}' AS filter_order, {k} AS step, {own} AS own, {earlier} AS earlier)" for o, k, own, earlier in steps)
    whole = whole.select("*", F.inline(F.expr(f"array({table})")))

    def total(counts: str, weight) -> Column:
        return F.aggregate(F.transform(F.col(counts), lambda n, m: n * weight(m)), F.lit(0).cast("long"), lambda a, x: a + x)

    def has(m: Column, bits: str) -> Column:
        return m.bitwiseAND(F.col(bits)) != 0

    def one(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    removed = lambda m: one(has(m, "own") & ~has(m, "earlier"))
    return whole.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: one(~has(m, "own") & ~has(m, "earlier"))).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: one(has(m, "own") & has(m, "earlier"))).alias("redundant"),
        total("n", lambda m: one(m == F.col("own"))).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("n", lambda m: F.when(has(m, "own"), (ORDERS / F.bit_count(m)).cast("long")).otherwise(0)).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
WITH base AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failing AS (
    SELECT doc_id, part,
        CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 'E' ELSE '' END AS fails
    FROM base
), marks AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), kinds AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT o, k, substr(o, k, 1) AS own, substr(o, 1, k - 1) AS earlier FROM orders, (SELECT unnest(range(1, 6)) AS k)
), met AS (
    SELECT part, o, k, own, fails, n, good, bad, contains(fails, own) AS fails_own, length(translate(fails, earlier, '')) < length(fails) AS gone FROM kinds, steps
), counted AS (
    SELECT part, o, k, own, coalesce(sum(n) FILTER (NOT gone AND NOT fails_own), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails_own), 0) AS removed,
        coalesce(sum(n) FILTER (gone AND fails_own), 0) AS redundant, coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
        coalesce(sum(good) FILTER (NOT gone AND fails_own), 0) AS good_lost, coalesce(sum(bad) FILTER (NOT gone AND fails_own), 0) AS toxic_lost
    FROM met GROUP BY part, o, k, own
)
SELECT part, o AS filter_order, k::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
    good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""
