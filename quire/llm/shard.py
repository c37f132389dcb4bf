"""Sharding by histogram sort.

Rows are ordered by a 60-bit key of their text (the first 15 hex digits of its
MD5) and doc_id.  A splitter is where so many bytes lie below it; it is found
by counting, again and again, the exact bytes of the key ranges that may hold
it, each round 1,024 times narrower, for all splitters in one pass.  A round
stops for a splitter whose place misses its target by no more than the
tolerance (0: until a single row is left).  Then rows are exchanged once, to
``cells`` even parts of each shard, cut further by the first bits of the key
where there are many rows, and numbered there.  Cells and bits follow the row
count; the counts of the parts, at most ``PARTS`` and one for each cell, say
where each begins.

Equal texts stand side by side and share a shard unless a splitter falls among
them; then doc_id parts them, so a group of copies of any size spreads over as
many cells as its bytes fill.  Where a splitter falls among rows that are equal
in text and doc_id too, the rows of that group (of one for each splitter, at
most) are written to the shared folder with a number each, which is a third key
that further rounds narrow.  Only DataFrame functions run.

Defined cases: a null text has no bytes and counts 1, as an empty one does; a
null doc_id sorts first; rows equal in text and doc_id, repeated rows among
them, are dealt like any others; an empty table gives no rows.  Columns of the input that clash with those added are
renamed with the prefix ``doc_``, twice or more if that name is taken too.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import read_table, stored, unused

SHARDS = 16
#: Parts of a shard, fewest and most.
CELLS = (4, 16)
#: Rows that one task should sort and number.
ROWS = 1 << 18
#: Most parts by the first bits of the key.
PARTS = 1 << 16
#: Share of a shard's bytes by which a splitter may miss its target.
TOLERANCE = 0.0
KEY_BITS, DIGIT = 60, 10
NO_ID, MOST = -(1 << 63), (1 << 63) - 1
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def row_size() -> Column:
    return (F.octet_length(_text()) + 1).cast("long")


def row_key() -> Column:
    return F.conv(F.substring(F.md5(_text()), 1, 15), 16, 10).cast("long")


def row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def _digits(bits: int) -> list[int]:
    """How many bits each round leaves open to its right."""
    return [*range(bits - DIGIT, 0, -DIGIT), 0]


def _among(groups: Collection[tuple[int, ...]], *cols: Column) -> Column:
    """Whether the columns are one of these tuples."""
    known = F.struct(*cols)
    return cols[0].isin(sorted({g[0] for g in groups})) & known.isin(*(F.struct(*(F.lit(v).cast("long") for v in g)) for g in sorted(groups)))


def find_splitters(keys: DataFrame, parts: int, tolerance: float = TOLERANCE, ties: Callable[[list[tuple[int, int]]], DataFrame] | None = None) -> list[tuple[int, int, int]]:
    """parts - 1 ascending bounds (k, d, m): a row lies behind a bound if its (k, d, m) is greater.

    keys: long columns k, d, size.  ties(groups) gives the rows of these (k, d) with an m of their own; without it rows
    equal in k and d are not parted.  Each round collects at most 1,024 sums for each bound that is still open.
    """
    total = keys.agg(F.sum("size")).first()[0]
    if not total:
        return []
    slack = tolerance * total / parts
    #: bound number -> (bytes below the range, the range: values of the columns so far)
    open_, bounds = {i: (0, ()) for i in range(1, parts)}, {}
    names, rows, wide = ("k", "d", "m"), keys, None  # wide: bits that the range leaves open in the column at hand
    steps = [(c, shift) for c, bits in (("k", KEY_BITS), ("d", 64), ("m", 64)) for shift in _digits(bits)]
    for col, shift in steps:
        if not open_:
            break
        done = [F.col(c) for c in names[: names.index(col)]]
        fresh = shift == _digits(KEY_BITS if col == "k" else 64)[0]
        wide = None if fresh else wide
        if col == "m" and fresh:
            rows = ties([r for _, r in open_.values()])
        ranges = {r for _, r in open_.values()}
        inside_of = [*done, *([] if fresh else [F.shiftright(col, wide)])]
        part = rows.where(_among(ranges, *inside_of)) if inside_of else rows
        found = part.groupBy(*(c.alias(f"c{i}") for i, c in enumerate([*done, F.shiftright(col, shift)]))).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
        inside: dict[tuple, list] = {}
        for *path, size, count in sorted(map(tuple, found)):
            inside.setdefault((*path[:-1], *([] if fresh else [path[-1] >> (wide - shift)])), []).append((path, size, count))
        still = {}
        for i, (below, parent) in open_.items():
            for path, size, count in inside[parent]:
                if (below + size) * parts >= i * total:
                    last = shift == 0 and (col == "m" or col == "d" and ties is None)
                    if count == 1 or last or below + size - i * total / parts <= slack:
                        bound = [*path[:-1], path[-1] << shift | (1 << shift) - 1]
                        bounds[i] = (*bound, *[MOST] * (3 - len(bound)))
                    else:
                        still[i] = (below, tuple(path))
                    break
                below += size
        open_, wide = still, shift
    return [bounds[i] for i in sorted(bounds)]


def parts_of(rows: int, shards: int = SHARDS) -> tuple[int, int]:
    """(cells of a shard, bits of the key that cut them further) for so many rows."""
    cells = max(CELLS[0], min(CELLS[1], -(-rows // (shards * ROWS))))
    return cells, max(0, min((PARTS - 1).bit_length(), (rows // ROWS).bit_length() if rows > shards * cells * ROWS else 0))


def shard_documents(docs: DataFrame, shards: int = SHARDS, cells: int | None = None, tolerance: float = TOLERANCE, bits: int | None = None) -> DataFrame:
    """All rows and columns, with size, text_crc32, law ('bytes'), shard, slot (gapless in each shard) and grown_shard (null).

    cells, bits: as parts_of gives them for the number of rows, unless named.
    """
    names, own = renamed(docs), unused(docs, "k", "d", "m", "c", "p", "size", "first")
    key, doc, number, cell_, part, size, first = own
    keys = stored(docs.select(row_key().alias("k"), row_id().alias("d"), row_size().alias("size")), "shard-keys")
    by_count = parts_of(keys.count(), shards)
    cells, bits = by_count[0] if cells is None else cells, by_count[1] if bits is None else bits
    put = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)), row_size().alias(size), F.crc32(_text()).alias("text_crc32"), row_key().alias(key), row_id().alias(doc))
    keys = keys.withColumn("m", F.lit(0).cast("long"))
    apart: list[DataFrame] = []
    groups: set[tuple[int, int]] = set()

    def numbered(among: list[tuple[int, int]]) -> DataFrame:
        groups.update(among)
        apart.append(stored(put.where(_among(groups, F.col(key), F.col(doc))).withColumn(number, F.monotonically_increasing_id()), "shard-ties"))
        return apart[0].select(F.col(key).alias("k"), F.col(doc).alias("d"), F.col(size).alias("size"), F.col(number).alias("m"))

    bounds = find_splitters(keys, shards * cells, tolerance, numbered)
    put = put.withColumn(number, F.lit(0).cast("long"))
    if apart:
        put = put.where(~_among(groups, F.col(key), F.col(doc))).union(apart[0])
        keys = keys.where(~_among(groups, F.col("k"), F.col("d"))).union(apart[0].select(key, doc, size, number))
    limits = F.array(*(F.struct(*(F.lit(v).cast("long").alias(c) for c, v in zip("kdm", b, strict=True))) for b in bounds)) if bounds else None

    def cell(*at: Column) -> Column:
        return F.size(F.filter(limits, lambda b: b < F.struct(*(v.alias(c) for c, v in zip("kdm", at, strict=True))))) if bounds else F.lit(0)

    def prefix(k: Column) -> Column:
        return F.shiftright(k, KEY_BITS - bits).cast("int")

    put = put.withColumn(cell_, cell(F.col(key), F.col(doc), F.col(number))).withColumn(part, prefix(F.col(key)))
    counts = keys.groupBy(cell(F.col("k"), F.col("d"), F.col("m")).alias("c"), prefix(F.col("k")).alias("p")).count()
    # the parts of a shard in the order of their rows: a window over counts only, at most PARTS and one for each cell
    before = Window.partitionBy(F.floor(F.col("c") / cells)).orderBy("c", "p").rowsBetween(Window.unboundedPreceding, -1)
    if bits:
        begin = counts.select(F.col("c").alias(cell_), F.col("p").alias(part), F.coalesce(F.sum("count").over(before), F.lit(0)).alias(first))
        put = put.join(F.broadcast(begin), [cell_, part])
    else:
        so_far, found = [], {r.c: r["count"] for r in counts.collect()}
        for c in range(shards * cells):
            so_far.append(so_far[-1] + found.get(c - 1, 0) if c % cells else 0)
        put = put.withColumn(first, F.element_at(F.array(*(F.lit(n).cast("long") for n in so_far)), F.col(cell_) + 1))
    place = F.row_number().over(Window.partitionBy(cell_, part).orderBy(key, doc, number)) - 1
    return put.select(
        *(F.col(f"`{n}`") for n in names), F.col(size).alias("size"), "text_crc32", F.lit("bytes").alias("law"), F.floor(F.col(cell_) / cells).cast("int").alias("shard"),
        (F.col(first) + place).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def renamed(docs: DataFrame) -> list[str]:
    """The names of the columns beside those added: each that clashes gets the prefix doc_, again until it is like no other."""
    taken = {c.lower() for c in (*docs.columns, *ADDED)}
    out = []
    for c in docs.columns:
        name = c
        while name.lower() in ADDED or (name != c and name.lower() in taken):
            name = f"doc_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents")).select("doc_id", *ADDED)


#: CRC-32 by its definition: the table from its polynomial, then byte by byte over the hex form, cut into parts to stay quick.
ORACLE_SQL = """
WITH bits AS (
    SELECT n, list_reduce(list_prepend(n, range(0, 8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(0, 256) t(n)
), tab AS (
    SELECT list(c ORDER BY n) AS crc_table FROM bits
), base AS MATERIALIZED (
    SELECT doc_id, row_number() OVER () AS r, lower(hex(encode(coalesce(text, '')))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
        substr(md5(coalesce(text, '')), 1, 15) AS k
    FROM documents
), parts AS (
    SELECT r, j, substr(h, 1000 * j + 1, 1000) AS part FROM (SELECT r, h, unnest(range(0, size // 500 + 1)) AS j FROM base)
), bytes AS (
    SELECT r, flatten(list(list_transform(range(0, length(part) // 2),
        lambda i: (strpos('0123456789abcdef', substr(part, 2 * i + 1, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(part, 2 * i + 2, 1)) - 1) ORDER BY j)) AS b
    FROM parts GROUP BY r
), crcs AS (
    SELECT r, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, crc_table[(xor(a, x) & 255) + 1])), 4294967295) AS crc FROM bytes, tab
), summed AS (
    SELECT doc_id, r, size, k, (sum(size) OVER (ORDER BY k, doc_id NULLS FIRST, r ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS below, (sum(size) OVER ())::BIGINT AS total FROM base
), placed AS (
    SELECT *, (16 * below // total)::INTEGER AS shard FROM summed
)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY k, doc_id NULLS FIRST, p.r) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed p JOIN crcs c ON p.r = c.r
"""
