"""Every operator over the shared tables, each with the SQL that gives the same rows.

``documents`` stand for documents, ``labels`` for ground truth, a user's
``events`` for tokens in order, ``conversations`` for pages, ``embeddings`` for
8 x 8 rasters, ``lineitem`` for coordinates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import boxes, fields, text
from quire.operators import audit, corpus, layout, manifest, pdf, ranges, raster
from quire.plans import release
from quire.sources import forms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SEED = 42


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def judged(spark: SparkSession, d: str) -> DataFrame:
    """Documents with has_gt: a label of quality 1."""
    good = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.join(good, "doc_id", "left").withColumn("has_gt", (F.coalesce("quality", F.lit(0)) == 1).cast("int"))


JUDGED = """judged AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, CASE WHEN coalesce(l.quality, 0) = 1 THEN 1 ELSE 0 END AS has_gt
    FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id
)"""
DEDUPED = f"""{JUDGED}, deduped AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn FROM judged) WHERE rn = 1
)"""
SPLIT = f"""{DEDUPED}, ranked AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY has_gt DESC, md5('{SEED}|' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM deduped
), sized AS (
    SELECT *, round_even(n * 0.7::DOUBLE, 0)::BIGINT AS a, round_even(n * 0.15::DOUBLE, 0)::BIGINT AS v FROM ranked
), fixed AS (
    SELECT *, v + CASE WHEN n >= 3 AND v < 1 THEN 1 ELSE 0 END AS val_n,
        a - CASE WHEN n >= 3 AND v < 1 THEN 1 ELSE 0 END - CASE WHEN n >= 3 AND n - a - v < 1 THEN 1 ELSE 0 END AS train_n FROM sized
), split AS (
    SELECT *, CASE WHEN r <= val_n THEN 'val' WHEN r <= n - train_n THEN 'test' ELSE 'train' END AS split FROM fixed
)"""


def deduped(spark: SparkSession, d: str) -> DataFrame:
    return corpus.keep_first(judged(spark, d).withColumn("h", F.md5("text")), ["h"], ["doc_id"])


def divided(spark: SparkSession, d: str) -> DataFrame:
    return corpus.assign_splits(deduped(spark, d), SEED, first=F.col("has_gt"), fill=("val", "test", "train"))


@query(f"WITH {DEDUPED} SELECT doc_id, source, lang, md5(text) AS h FROM deduped")
def dedup_keep_first(spark, d):
    return deduped(spark, d).select("doc_id", "source", "lang", "h")


@query(
    """WITH once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, doc_id ORDER BY doc_id) AS a FROM documents) WHERE a = 1),
    long AS (SELECT *, CASE WHEN n_chars >= 100 THEN md5(text) ELSE '' END AS h FROM once)
    SELECT doc_id, h FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id) AS b FROM long) WHERE b = 1 OR h = ''"""
)
def dedup_exempt(spark, d):
    docs = table(spark, d, "documents").withColumn("content_hash", F.when(F.col("n_chars") >= 100, F.md5("text")).otherwise(""))
    return corpus.deduplicate(docs, ["doc_id"]).select("doc_id", F.col("content_hash").alias("h"))


@query(f"WITH {SPLIT} SELECT doc_id, source, split FROM split")
def split_stratified(spark, d):
    return divided(spark, d).select("doc_id", "source", "split")


@query(
    f"""WITH {SPLIT} SELECT source, count(*) AS total, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'val') AS val,
    count(*) FILTER (WHERE split = 'test') AS test FROM split GROUP BY source UNION ALL SELECT 'none_such', 0, 0, 0, 0"""
)
def manifest_counts(spark, d):
    return corpus.manifest_rollup(divided(spark, d), ["none_such", "src0"])


@query(f"WITH {SPLIT} SELECT coalesce(split, 'none') AS split, count(*) AS n FROM split GROUP BY 1")
def split_counts(spark, d):
    return corpus.split_totals(divided(spark, d))


@query("SELECT source, lang, grouping(source, lang)::BIGINT AS level, count(*) AS n FROM documents GROUP BY GROUPING SETS ((source, lang), (source), (lang), ())")
def manifest_grouping_sets(spark, d):
    out = corpus.manifest_sets(table(spark, d, "documents").select("source", "lang"), [["source", "lang"], ["source"], ["lang"], []], ["source", "lang"])
    return out.withColumn("level", F.col("level").cast("long"))


@query(
    f"""WITH {SPLIT}, t AS (SELECT source, lang AS quality_tier, split FROM split)
    SELECT 'source' AS kind, source AS name, count(*) AS n FROM t GROUP BY source UNION ALL SELECT 'quality_tier', quality_tier, count(*) FROM t GROUP BY 2
    UNION ALL SELECT 'split', split, count(*) FROM t GROUP BY 2 UNION ALL SELECT 'total', NULL, count(*) FROM t"""
)
def corpus_stats(spark, d):
    return corpus.corpus_stats(divided(spark, d).withColumnRenamed("lang", "quality_tier"))


@query(
    f"""WITH {JUDGED} SELECT source, avg((CASE WHEN quality IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END + has_gt) / 2) AS score FROM judged GROUP BY source"""
)
def quality_score(spark, d):
    f = F.struct(F.when(F.col("quality").isNotNull(), "answer").otherwise("other").alias("role"), F.lit("x").alias("value"), F.when(F.col("has_gt") == 1, F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0)))).otherwise(F.array(*map(F.lit, (0.0, 0.0, 0.0, 0.0)))).alias("bbox_norm"))
    scored = corpus.score(judged(spark, d).select("source", F.array(f).alias("fields")))
    return scored.groupBy("source").agg(F.avg("quality_score").alias("score"))


_RANK = "CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 3 ELSE 99 END"


@query(f"SELECT source, lang, n, row_number() OVER (ORDER BY {_RANK}, n DESC, source) AS place FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang)")
def order_master(spark, d):
    groups = table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    tier = F.when(F.col("lang") == "en", "clean").when(F.col("lang") == "de", "degraded").when(F.col("lang") == "fr", "clean_synthetic").when(F.col("lang") == "es", "degraded_synthetic")
    w = Window.orderBy(corpus.tier_rank(tier), F.desc("n"), "source")  # a row for each source and language
    return groups.withColumn("place", F.row_number().over(w).cast("long"))


@query("SELECT source, lang, count(*) AS ok, sum(n_chars)::BIGINT AS redacted FROM documents GROUP BY ROLLUP (source, lang)")
def run_summary_rollup(spark, d):
    return table(spark, d, "documents").rollup("source", "lang").agg(F.count("*").alias("ok"), F.sum("n_chars").alias("redacted"))


@query(
    """SELECT source, count(*) FILTER (WHERE reason IS NULL) AS ok, count(*) FILTER (WHERE reason IS NOT NULL) AS skip, coalesce(sum(n_chars), 0)::BIGINT AS redacted
    FROM (SELECT *, CASE WHEN n_chars < 200 THEN 'short' END AS reason FROM documents) GROUP BY ROLLUP (source)"""
)
def run_summary(spark, d):
    rows = table(spark, d, "documents").withColumn("skipped", F.when(F.col("n_chars") < 200, "short")).withColumnRenamed("n_chars", "redacted")
    return audit.run_summary(rows)


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def exclude_anti(spark, d):
    return manifest.exclude(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").where("toxic = 1"))


@query(
    """WITH c AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'born_digital_pdf' WHEN 'de' THEN 'synthetic_acroform' WHEN 'fr' THEN 'image_only_pdf' END AS category FROM documents)
    SELECT doc_id, category FROM c WHERE category IN ('born_digital_pdf', 'synthetic_acroform')"""
)
def compat_semi(spark, d):
    kind = F.when(F.col("lang") == "en", "born_digital_pdf").when(F.col("lang") == "de", "synthetic_acroform").when(F.col("lang") == "fr", "image_only_pdf")
    return manifest.compatible(table(spark, d, "documents").select("doc_id", kind.alias("category")), "pymupdf-redact")


@query("SELECT d.doc_id, coalesce(cast(l.quality AS VARCHAR), 'StringMatch') AS match_type FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def match_type_left_default(spark, d):
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("StringMatch")).alias("match_type"))


@query(
    f"""WITH pools AS (SELECT source, count(*) AS pool FROM documents GROUP BY source), av AS (SELECT sum(pool)::BIGINT AS available FROM pools),
    base AS (SELECT source, pool, least(pool, (137 * pool) // available)::BIGINT AS take, available FROM pools, av),
    short AS (SELECT (least(137, max(available)) - sum(take))::BIGINT AS short FROM base),
    slots AS (SELECT source, pool - take AS left_, short, unnest(range(1, least(pool - take, short) + 1)) AS k FROM base, short WHERE pool > take),
    steps AS (SELECT *, -ln((('0x' || substr(md5('{SEED}|' || source || '|' || k), 1, 13))::BIGINT::DOUBLE + 1) / 4503599627370496::DOUBLE) / (left_ - k + 1) AS step FROM slots),
    ranks AS (SELECT source, k, sum(step) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS rank FROM steps),
    drawn AS (SELECT source, row_number() OVER (ORDER BY rank, source, k) AS r FROM ranks),
    extra AS (SELECT source, count(*) AS extra FROM drawn, short WHERE r <= short GROUP BY source),
    takes AS (SELECT b.source, b.take + coalesce(e.extra, 0) AS take FROM base b LEFT JOIN extra e ON b.source = e.source),
    ranked AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}|' || doc_id), doc_id) AS r FROM documents)
    SELECT k.source, k.doc_id FROM ranked k JOIN takes t ON k.source = t.source WHERE k.r <= t.take"""
)
def sample_proportional(spark, d):
    return manifest.sample(table(spark, d, "documents").select("source", "doc_id"), 137, SEED)


@query(f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY md5('{SEED}|' || doc_id), doc_id) AS r FROM documents) WHERE r <= 100")
def sample_uniform(spark, d):
    return corpus.sample_uniform(table(spark, d, "documents").select("doc_id", "source"), 100, SEED)


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def last_wins_payload(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id")
    return manifest.last_of_each(rows.withColumn("o", F.col("event_id")), "user_id", "o").select("user_id", "event_type", "event_id")


@query("SELECT user_id, k, v FROM (SELECT user_id, event_type AS k, arg_max(cast(event_id AS VARCHAR), event_id) AS v FROM events GROUP BY user_id, event_type)")
def payload_map(spark, d):
    flat = table(spark, d, "events").select("user_id", F.col("event_id").alias("pos"), F.col("event_type").alias("field_id"), F.col("event_id").cast("string").alias("value"), F.lit("answer").alias("role"))
    return fields.payload_rows(flat, ["user_id"], "pos")


@query("SELECT doc_id, CASE WHEN n_chars >= 300 THEN 'b=' || n_chars ELSE 'b=' || source END || ',a=' || lang AS payload FROM documents")
def payload_in_row(spark, d):
    f = lambda key, value: F.struct(F.lit(key).alias("field_id"), value.alias("value"), F.lit("answer").alias("role"))
    n = F.when(F.col("n_chars") >= 300, F.col("n_chars").cast("string")).otherwise("")
    docs = table(spark, d, "documents").select("doc_id", F.array(f("b", F.col("source")), f("a", F.col("source")), f("b", n), f("a", F.col("lang"))).alias("fields"))
    m = F.col("gt_payload")
    return fields.with_derived(docs).select("doc_id", F.concat(F.lit("b="), m["b"], F.lit(",a="), m["a"]).alias("payload"))


_ISLANDS = """islands AS (
    SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT - 1 AS run FROM (
        SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = event_type THEN 0 ELSE 1 END AS o FROM events)
)"""


@query(f"WITH {_ISLANDS} SELECT user_id, run, event_type, count(*) AS n, min(event_id) AS first_id FROM islands GROUP BY user_id, run, event_type")
def bio_entities(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return layout.runs(e, ["user_id"], ["ts", "event_id"], "event_type").groupBy("user_id", "run", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(
    f"""WITH {_ISLANDS} SELECT user_id, run, min(value) AS x0, max(value) AS x1, md5(string_agg(cast(event_id AS VARCHAR), ' ' ORDER BY ts, event_id)) AS joined FROM islands GROUP BY user_id, run"""
)
def entity_union(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    e = layout.joined_runs(e, ["user_id"], ["ts", "event_id"], "event_type", F.col("event_id").cast("string"), {"x0": (F.min, "value"), "x1": (F.max, "value")})
    return e.select("user_id", "run", "x0", "x1", F.md5("text").alias("joined"))


def line_boxes(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    b = F.array(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / 50, F.col("l_extendedprice") / 50000)
    return li.withColumn("b", b)


_BOX = "l_orderkey, l_linenumber, l_discount AS x0, l_tax AS y0, l_quantity / 50 AS x1, l_extendedprice / 50000 AS y1"


@query(
    f"""WITH b AS (SELECT {_BOX} FROM lineitem) SELECT l_orderkey, l_linenumber, greatest(0, least(1, x0 / 0.05::DOUBLE)) AS x0, greatest(0, least(1, y0 / 0.07::DOUBLE)) AS y0,
    greatest(0, least(1, x1 / 0.05::DOUBLE)) AS x1, greatest(0, least(1, y1 / 0.07::DOUBLE)) AS y1 FROM b"""
)
def bbox_normalise(spark, d):
    n = boxes.normalise(F.col("b"), F.lit(0.05), F.lit(0.07))
    return line_boxes(spark, d).select("l_orderkey", "l_linenumber", *(n[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))


@query(
    f"""WITH b AS (SELECT *, CASE l_linenumber WHEN 1 THEN 40 WHEN 2 THEN 30 ELSE 5 END AS p FROM (SELECT {_BOX} FROM lineitem))
    SELECT l_orderkey, l_linenumber, greatest(0, trunc(x0 * 800)::INTEGER - p) AS x0, greatest(0, trunc(y0 * 600)::INTEGER - 5) AS y0,
    least(800, trunc(x1 * 800)::INTEGER + 5) AS x1, least(600, trunc(y1 * 600)::INTEGER + 5) AS y1 FROM b"""
)
def bbox_px_padding(spark, d):
    source = F.when(F.col("l_linenumber") == 1, "funsd").when(F.col("l_linenumber") == 2, "xfund_de").otherwise("else")
    return line_boxes(spark, d).select("l_orderkey", "l_linenumber", boxes.to_pixels(F.col("b"), F.lit(800), F.lit(600), boxes.padding(source)).alias("p")).select("l_orderkey", "l_linenumber", "p.*")


@query(
    """WITH p AS (SELECT p_partkey, p_size AS x0, p_size AS y0, p_size + p_partkey % 97 AS x1, p_size + p_partkey % 31 AS y1 FROM part),
    w AS (SELECT *, greatest(10, round_even((x1 - x0) * 0.5::DOUBLE, 0)::INTEGER) AS dx, greatest(10, round_even((y1 - y0) * 0.5::DOUBLE, 0)::INTEGER) AS dy FROM p)
    SELECT p_partkey, greatest(0, x0 - dx)::INTEGER AS x0, greatest(0, y0 - dy)::INTEGER AS y0, least(120, x1 + dx)::INTEGER AS x1, least(60, y1 + dy)::INTEGER AS y1,
    (greatest(11, round_even((y1 - y0) * 1.5::DOUBLE, 0)::INTEGER) // 2 * 2 + 1)::INTEGER AS kernel FROM w"""
)
def window_expansion(spark, d):
    p = F.struct(F.col("p_size").alias("x0"), F.col("p_size").alias("y0"), (F.col("p_size") + F.col("p_partkey") % 97).cast("int").alias("x1"), (F.col("p_size") + F.col("p_partkey") % 31).cast("int").alias("y1"))
    rows = table(spark, d, "part").select("p_partkey", p.alias("p"))
    return rows.select("p_partkey", boxes.window(F.col("p"), F.lit(120), F.lit(60)).alias("w"), boxes.kernel_size(F.col("p.y1") - F.col("p.y0"), 1.5, 11).alias("kernel")).select("p_partkey", "w.*", "kernel")


@query(
    f"""WITH b AS (SELECT *, CASE WHEN l_linenumber % 2 = 1 THEN 'answer' ELSE 'question' END AS role, CASE WHEN l_linenumber > 2 THEN 'v' ELSE '' END AS value, l_linenumber - 1 AS page FROM (SELECT {_BOX} FROM lineitem))
    SELECT l_linenumber, count(*) FILTER (WHERE role = 'answer' AND value <> '' AND x1 > x0 AND y1 > y0 AND NOT (x0 = 0 AND y0 = 0 AND x1 = 0 AND y1 = 0)) AS redactable,
    count(*) FILTER (WHERE role = 'answer' AND value <> '' AND x1 > x0 AND y1 > y0 AND page IS NOT NULL) AS previewable, count(*) FILTER (WHERE role = 'answer' AND x1 > x0 AND y1 > y0) AS imageable,
    count(*) FILTER (WHERE x1 - x0 > 0.001::DOUBLE AND y1 - y0 > 0.001::DOUBLE) AS legacy, count(*) FILTER (WHERE x1 > x0 AND y1 > y0 AND x0 >= 0 AND y0 >= 0 AND x1 <= 1 AND y1 <= 1) AS in_square,
    count(*) FILTER (WHERE role = 'answer' AND value <> '' AND x1 > x0 AND y1 > y0 AND page > 3) AS out_of_range FROM b GROUP BY l_linenumber"""
)
def validity_rules(spark, d):
    f = F.struct(F.when(F.col("l_linenumber") % 2 == 1, "answer").otherwise("question").alias("role"), F.when(F.col("l_linenumber") > 2, "v").otherwise("").alias("value"), F.col("b").alias("bbox_norm"), (F.col("l_linenumber") - 1).alias("page"))
    x = F.col("f")
    return line_boxes(spark, d).select("l_linenumber", "b", f.alias("f")).groupBy("l_linenumber").agg(
        F.count_if(boxes.redactable(x)).alias("redactable"), F.count_if(boxes.previewable(x)).alias("previewable"), F.count_if(boxes.imageable(x)).alias("imageable"),
        F.count_if(boxes.legacy_valid(F.col("b"))).alias("legacy"), F.count_if(boxes.in_unit_square(F.col("b"))).alias("in_square"),
        F.count_if(F.coalesce(boxes.skip_reason(x, F.lit(4)) == "page-out-of-range", F.lit(False))).alias("out_of_range"),
    )


_TAGS = ("ECONOMY", "STANDARD", "SMALL", "BRUSHED")


@query(
    "SELECT p_partkey, CASE "
    + " ".join(f"WHEN regexp_matches(n, '(^|_){t}(_|$)') THEN '{t}'" for t in _TAGS)
    + " END AS subtype, split_part(n, '_', 1) AS source FROM (SELECT p_partkey, replace(upper(p_type), ' ', '_') AS n FROM part)"
)
def subtype_tag(spark, d):
    n = F.replace(F.upper("p_type"), F.lit(" "), F.lit("_"))
    return table(spark, d, "part").select("p_partkey", text.subtype(n, _TAGS).alias("subtype"), F.split_part(n, F.lit("_"), F.lit(1)).alias("source"))


#: White space at both ends, in any alphabet.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _sql_stripped(value: str) -> str:
    return f"regexp_replace({value}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


#: The pages of every seventh conversation hold white space only.
_CAT = """cat AS (
    SELECT conv_id, coalesce(sum(CASE WHEN role = 'system' THEN length(_STRIPPED) END), 0)::BIGINT AS text_char_count, count(*) FILTER (WHERE role = 'assistant') AS widget_count,
        max(CASE WHEN conv_id % 13 = 0 THEN 'broken' END) AS error FROM conversations GROUP BY conv_id
), typed AS (
    SELECT conv_id, CASE WHEN error IS NOT NULL THEN 'image_only_pdf' WHEN text_char_count > 0 THEN 'born_digital_pdf' WHEN widget_count > 0 THEN 'synthetic_acroform' ELSE 'image_only_pdf' END AS category, error FROM cat
)""".replace("_STRIPPED", _sql_stripped("CASE WHEN conv_id % 7 = 0 THEN regexp_replace(text, '[^ ]', chr(10) || chr(9), 'g') ELSE text END"))


def profiles(spark, d):
    c = table(spark, d, "conversations").withColumn("text", F.when(F.col("conv_id") % 7 == 0, F.regexp_replace("text", "[^ ]", "\n\t")).otherwise(F.col("text")))
    return manifest.profile(c.select(F.col("conv_id").alias("doc_id"), F.when(F.col("role") == "system", F.col("text")).alias("text"), (F.col("role") == "assistant").cast("int").alias("widget_count"), F.when(F.col("conv_id") % 13 == 0, "broken").alias("error")))


@query(
    f"""WITH {_CAT} SELECT conv_id AS doc_id, category, CASE category WHEN 'born_digital_pdf' THEN 'content-stream' WHEN 'synthetic_acroform' THEN 'widget' ELSE 'skipped:' || category END AS lane FROM typed"""
)
def category_dispatch(spark, d):
    return profiles(spark, d).select("doc_id", "category", pdf.dispatch(F.col("category")).alias("lane"))


@query(
    f"""WITH {_CAT}, names AS (SELECT category FROM typed UNION ALL SELECT 'error' FROM typed WHERE error IS NOT NULL),
    domain AS (SELECT unnest(['born_digital_pdf', 'synthetic_acroform', 'image_only_pdf', 'image_only_png', 'error']) AS category)
    SELECT d.category, count(n.category) AS n FROM domain d LEFT JOIN names n ON d.category = n.category GROUP BY d.category"""
)
def category_counts_zero_fill(spark, d):
    return manifest.category_counts(profiles(spark, d))


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k"))


_PB = "SELECT DISTINCT (p_size % 50)::DOUBLE AS x0, (p_partkey % 60)::DOUBLE AS y0, (p_size % 50 + 1)::DOUBLE AS x1, (p_partkey % 60 + 1)::DOUBLE AS y1 FROM part"


@query(
    f"""WITH b AS ({_PB}), e AS (SELECT event_id, value AS x, extract(minute FROM ts)::DOUBLE AS y FROM events)
    SELECT event_id FROM e WHERE EXISTS (SELECT 1 FROM b WHERE x >= x0 AND x <= x1 AND y >= y0 AND y <= y1)"""
)
def point_in_box_semi(spark, d):
    p = table(spark, d, "part")
    x, y = F.col("p_size") % 50, F.col("p_partkey") % 60
    b = p.select(x.cast("double").alias("x0"), y.cast("double").alias("y0"), (x + 1).cast("double").alias("x1"), (y + 1).cast("double").alias("y1"))
    e = table(spark, d, "events").select("event_id", F.col("value").alias("x"), F.minute("ts").cast("double").alias("y"))
    return layout.points_in_shared_boxes(e, b).select("event_id")


@query(
    """WITH p AS (SELECT user_id, event_id, value FROM events WHERE event_type = 'view'), t AS (SELECT user_id, event_id AS target, value FROM events WHERE event_type <> 'view')
    SELECT t.user_id, t.target, arg_min(p.event_id, row(abs(p.value - t.value), p.event_id)) AS nearest_id FROM t JOIN p ON t.user_id = p.user_id GROUP BY t.user_id, t.target"""
)
def nearest_dot(spark, d):
    e = table(spark, d, "events")
    p = e.where("event_type = 'view'").select("user_id", "event_id", "value")
    t = e.where("event_type <> 'view'").select("user_id", F.col("event_id").alias("target"), "value")
    return layout.nearest(p, t, ["user_id"], "event_id", "value", ["target"], "value").select("user_id", "target", "nearest_id").where("nearest_id is not null")


_PTS = "SELECT user_id, event_id, floor(value)::DOUBLE AS y FROM events"


@query(
    f"""WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY y, event_id) AS r FROM ({_PTS})),
    walk AS (SELECT user_id, event_id, y, r, y AS first, 0 AS band FROM p WHERE r = 1
        UNION ALL SELECT p.user_id, p.event_id, p.y, p.r, CASE WHEN p.y - w.first > 2 THEN p.y ELSE w.first END, CASE WHEN p.y - w.first > 2 THEN w.band + 1 ELSE w.band END
        FROM walk w JOIN p ON p.user_id = w.user_id AND p.r = w.r + 1)
    SELECT user_id, event_id, y, band FROM walk"""
)
def y_bands(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.floor("value").cast("double").alias("y"))
    return layout.bands(e, ["user_id"], "y", ["event_id"], 2.0)


_GAPS = """gaps AS (SELECT user_id, event_id, value AS x, lead(value) OVER (PARTITION BY user_id ORDER BY value, event_id) - value AS spacing FROM events),
mid AS (SELECT user_id, greatest(median(spacing) * 1.5, 1.0::DOUBLE) AS cut FROM gaps WHERE spacing IS NOT NULL GROUP BY user_id),
stats AS (SELECT g.user_id, count(*) AS n, avg(spacing) AS mean, stddev_pop(spacing) AS deviation FROM gaps g JOIN mid m ON g.user_id = m.user_id WHERE spacing <= cut GROUP BY g.user_id HAVING count(*) >= 2 AND avg(spacing) > 0)"""


def value_gaps(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("x"))
    return layout.spacings(e, ["user_id"], "x", ["event_id"]).drop("next_x")


@query(f"WITH {_GAPS} SELECT user_id, n, round(mean, 6) AS mean, round(deviation / mean, 6) AS cv FROM stats")
def cluster_spacing_cv(spark, d):
    return layout.spacing_stats(value_gaps(spark, d), ["user_id"], tolerant=True, sizes=table(spark, d, "events"), order=["x", "event_id"]).select("user_id", "n", F.round("mean", 6).alias("mean"), F.round("cv", 6).alias("cv"))


@query(
    f"""WITH {_GAPS}, wide AS (SELECT g.*, greatest(1, round_even(spacing / mean, 0)::INTEGER - 1) AS expected FROM gaps g JOIN stats s ON g.user_id = s.user_id WHERE spacing > mean * 1.3::DOUBLE),
    rows_ AS (SELECT *, unnest(range(1, expected + 1))::INTEGER AS j FROM wide) SELECT user_id, event_id, j, expected, floor((x + j * spacing / (expected + 1)) * 1000)::BIGINT AS target_milli FROM rows_"""
)
def gap_targets(spark, d):
    gaps = value_gaps(spark, d)
    out = layout.gap_targets(gaps, layout.spacing_stats(gaps, ["user_id"], tolerant=True, sizes=table(spark, d, "events"), order=["x", "event_id"]), ["user_id"], "x")
    return out.select("user_id", "event_id", "j", "expected", F.floor(F.col("target_x") * 1000).cast("long").alias("target_milli"))


@query(
    """SELECT user_id, CASE WHEN count(*) < 2 OR max(x) - min(x) < 1 THEN 0.0::DOUBLE ELSE round(regr_slope(y, x), 6) END AS slope,
    round(CASE WHEN count(*) < 2 OR max(x) - min(x) < 1 THEN avg(y) ELSE regr_intercept(y, x) END, 5) AS intercept
    FROM (SELECT user_id, extract(minute FROM ts)::DOUBLE AS x, value AS y FROM events) GROUP BY user_id"""
)
def baseline_fit(spark, d):
    e = table(spark, d, "events").select("user_id", F.minute("ts").cast("double").alias("x"), F.col("value").alias("y"))
    return layout.baseline(e, ["user_id"], "x", "y").select("user_id", F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"))


@query(
    """WITH c AS (SELECT user_id, min(value) AS x_lo, max(value) AS x_hi, avg(value) AS y_center, 1.0::DOUBLE AS mean FROM events GROUP BY user_id),
    b AS (SELECT DISTINCT user_id, value - 3 AS x0, value - 500 AS y0, value + 3 AS x1, value + 500 AS y1 FROM events),
    j AS (SELECT c.user_id, x_lo, x_hi, x0, x1 FROM c JOIN b ON c.user_id = b.user_id WHERE y0 - 2 <= y_center AND y_center <= y1 + 2)
    SELECT DISTINCT user_id, 'single_sided:no_right_anchor' AS note FROM j WHERE x1 > x_hi + 1.5::DOUBLE UNION ALL SELECT DISTINCT user_id, 'single_sided:no_left_anchor' FROM j WHERE x0 < x_lo - 1.5::DOUBLE"""
)
def single_sided_notes(spark, d):
    e = table(spark, d, "events")
    c = e.groupBy("user_id").agg(F.min("value").alias("x_lo"), F.max("value").alias("x_hi"), F.avg("value").alias("y_center"), F.lit(1.0).alias("mean"))
    v = F.col("value")
    b = e.select("user_id", (v - 3).alias("x0"), (v - 500).alias("y0"), (v + 3).alias("x1"), (v + 500).alias("y1")).distinct()
    return layout.single_sided(c, b, ["user_id"]).select("user_id", "note").distinct()


def rasters(spark, d):
    return raster.from_array(table(spark, d, "embeddings"), "vec_id", "embedding", 8, lambda e: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((e.cast("double") + 0.5) * 255).cast("int"))))


PX = """px AS (
    SELECT vec_id AS img, (i // 8)::INTEGER AS y, (i % 8)::INTEGER AS x, greatest(0, least(255, floor((embedding[i + 1]::DOUBLE + 0.5::DOUBLE) * 255)))::INTEGER AS v
    FROM (SELECT vec_id, embedding, unnest(range(0, 64)) AS i FROM embeddings)
)"""
OTSU = f"""{PX}, hist AS (SELECT img, v, count(*) AS n FROM px GROUP BY img, v),
cum AS (SELECT img, v, sum(n) OVER w AS w0, sum(n * v) OVER w AS s0, sum(n) OVER (PARTITION BY img) AS w, sum(n * v) OVER (PARTITION BY img) AS s FROM hist WINDOW w AS (PARTITION BY img ORDER BY v ROWS UNBOUNDED PRECEDING)),
sig AS (SELECT img, v, round(coalesce(w0::DOUBLE * (w - w0)::DOUBLE * (s0::DOUBLE / w0 - (s - s0)::DOUBLE / nullif(w - w0, 0)) * (s0::DOUBLE / w0 - (s - s0)::DOUBLE / nullif(w - w0, 0)), 0), 6) AS sigma FROM cum),
otsu AS (SELECT img, arg_min(v, row(-sigma, v)) AS threshold FROM sig GROUP BY img)"""
FG = f"{OTSU}, fg AS (SELECT px.img, y, x, v, CASE WHEN v <= threshold THEN 1 ELSE 0 END AS fg FROM px JOIN otsu ON px.img = otsu.img)"


def _sql_line(src: str, out: str, col: str, name: str, axis: str, half: int, first: str, second: str) -> str:
    other = "y" if axis == "x" else "x"
    w = f"(PARTITION BY img, {other} ORDER BY {axis} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    return f"{out}_0 AS (SELECT *, {first}({col}) OVER {w} AS t_{name} FROM {src}), {out} AS (SELECT *, {second}(t_{name}) OVER {w} AS {name} FROM {out}_0)"


def foreground(spark, d):
    px = rasters(spark, d)
    return px.join(raster.otsu(px), "img").withColumn("fg", (F.col("v") <= F.col("threshold")).cast("int")).drop("threshold")


@query(f"WITH {OTSU} SELECT img, threshold FROM otsu")
def otsu_threshold(spark, d):
    return raster.otsu(rasters(spark, d))


@query(f"WITH {FG}, {_sql_line('fg', 'h', 'fg', 'h_rule', 'x', 1, 'min', 'max')} SELECT img, y, x, h_rule FROM h")
def h_open(spark, d):
    return raster.opened(foreground(spark, d), "fg", "x", 1, "h_rule").select("img", "y", "x", "h_rule")


@query(f"WITH {FG}, {_sql_line('fg', 'h', 'fg', 'v_rule', 'y', 1, 'min', 'max')} SELECT img, y, x, v_rule FROM h")
def v_open(spark, d):
    return raster.opened(foreground(spark, d), "fg", "y", 1, "v_rule").select("img", "y", "x", "v_rule")


@query(f"WITH {FG}, {_sql_line('fg', 'h', 'fg', 'joined', 'x', 1, 'max', 'min')} SELECT img, y, x, joined FROM h")
def bridge_close(spark, d):
    return raster.closed(foreground(spark, d), "fg", "x", 1, "joined").select("img", "y", "x", "joined")


@query(f"WITH {PX}, {_sql_line('px', 'h', 'v', 'c', 'x', 1, 'max', 'min')} SELECT img, y, x, c - v AS hat FROM h")
def tophat(spark, d):
    return raster.black_tophat(rasters(spark, d), "v", "x", 1, "hat").select("img", "y", "x", "hat")


@query(
    f"""WITH {FG}, {_sql_line('fg', 'h', 'fg', 'h_rule', 'x', 1, 'min', 'max')}, {_sql_line('h', 'v2', 'fg', 'v_rule', 'y', 1, 'min', 'max')},
    r AS (SELECT img, y, x, fg, greatest(h_rule, v_rule) AS rule, CASE WHEN greatest(h_rule, v_rule) = 1 THEN 0 ELSE fg END AS t FROM v2),
    a AS (SELECT *, max(t) OVER (PARTITION BY img, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS a FROM r),
    b AS (SELECT *, max(a) OVER (PARTITION BY img, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS b FROM a)
    SELECT img, y, x, rule, CASE WHEN rule = 1 THEN 0 ELSE b END AS text FROM b"""
)
def text_mask(spark, d):
    return raster.text_mask(foreground(spark, d), "fg", 1, 1).select("img", "y", "x", "rule", "text")


@query(
    f"""WITH {PX}, mid AS (SELECT img, y, median(v)::DOUBLE AS m FROM px WHERE y < 3 GROUP BY img, y) SELECT img, arg_max(trunc(m)::INTEGER, row(round(m, 6), -y)) AS c0, arg_max(y, row(round(m, 6), -y)) AS y FROM mid GROUP BY img"""
)
def strip_background(spark, d):
    return raster.strip_color(rasters(spark, d).where("y < 3"), ["img"], "y", ["v"]).select("img", F.col("v").alias("c0"), "y")


_SIDE = "CASE WHEN y = 0 THEN 'top' WHEN y = 7 THEN 'bottom' WHEN x = 0 THEN 'left' WHEN x = 7 THEN 'right' END"


@query(
    f"""WITH {PX}, s AS (SELECT img, {_SIDE} AS side, v FROM px), m AS (SELECT img, side, trunc(median(v)::DOUBLE)::INTEGER AS c0 FROM s WHERE side IS NOT NULL GROUP BY img, side),
    k AS (SELECT img, avg(CASE WHEN side IN ('top', 'bottom') AND c0 >= 90 THEN c0 END) AS a, avg(CASE WHEN side IN ('left', 'right') AND c0 >= 90 THEN c0 END) AS b, max(CASE WHEN side = 'top' THEN c0 END) AS t FROM m GROUP BY img)
    SELECT img, coalesce(trunc(a)::INTEGER, trunc(b)::INTEGER, t) AS c0, CASE WHEN a IS NOT NULL THEN 'vertical' WHEN b IS NOT NULL THEN 'horizontal' ELSE 'fallback' END AS origin FROM k"""
)
def strip_vote(spark, d):
    side = F.when(F.col("y") == 0, "top").when(F.col("y") == 7, "bottom").when(F.col("x") == 0, "left").when(F.col("x") == 7, "right")
    s = rasters(spark, d).withColumn("side", side).where("side is not null").groupBy("img", "side").agg(F.median("v").cast("int").alias("c0"))
    return raster.background(s.withColumns({"c1": F.col("c0"), "c2": F.col("c0")}), ["img"]).select("img", "c0", "origin")


@query(f"WITH {PX} SELECT img, round(avg(abs(v - least(v, 200))) / 255, 9) AS l1, count(*) AS n FROM px WHERE NOT (x >= 2 AND x < 6 AND y >= 2 AND y < 5) GROUP BY img")
def outside_box_l1(spark, d):
    px = rasters(spark, d).withColumn("w", F.least("v", F.lit(200)))
    b = px.select("img").distinct().select("img", F.lit(2).alias("x0"), F.lit(2).alias("y0"), F.lit(6).alias("x1"), F.lit(5).alias("y1"))
    return raster.outside_l1(px, b, "v", "w").select("img", F.round("l1", 9).alias("l1"), "n")


@query(
    f"""WITH RECURSIVE {FG}, on_ AS (SELECT img, y * 8 + x AS p, y, x FROM fg WHERE fg = 1),
    reach AS (SELECT img, p, y, x, p AS q FROM on_ UNION SELECT o.img, o.p, o.y, o.x, r.q FROM reach r JOIN on_ o ON o.img = r.img AND abs(o.x - r.x) <= 1 AND abs(o.y - r.y) <= 1),
    lab AS (SELECT img, p, y, x, min(q) AS root FROM reach GROUP BY img, p, y, x)
    SELECT img, min(x)::INTEGER AS x0, min(y)::INTEGER AS y0, max(x)::INTEGER AS x1, max(y)::INTEGER AS y1, count(*)::INTEGER AS area FROM lab GROUP BY img, root"""
)
def components(spark, d):
    return raster.components(foreground(spark, d)).select("img", "x0", "y0", "x1", "y1", "area")


@query(f"WITH {PX} SELECT img, count(*) AS n, round(avg(v / 255::DOUBLE), 9) AS mean_white, round(min(v / 255::DOUBLE), 9) AS min_white, avg(CASE WHEN v / 255::DOUBLE >= 0.98 THEN 1.0::DOUBLE ELSE 0 END) AS at_98, avg(CASE WHEN v / 255::DOUBLE >= 0.95 THEN 1.0::DOUBLE ELSE 0 END) AS at_95, avg(CASE WHEN v / 255::DOUBLE < 0.9 THEN 1.0::DOUBLE ELSE 0 END) AS under_90 FROM px GROUP BY img")
def whiteness_buckets(spark, d):
    out = audit.whiteness(rasters(spark, d).withColumn("w", F.col("v") / 255), ["img"], "w")
    return out.withColumns({c: F.round(c, 9) for c in ("mean_white", "min_white")})


@query(f"WITH {PX}, p AS (SELECT img, v, least(v, 200) AS u FROM px) SELECT img, avg(CASE WHEN v - u > 10 THEN 1.0::DOUBLE ELSE 0 END) AS changed, round(avg(v - u), 9) AS mean_diff, round(stddev_pop(v - u), 9) AS std_diff, round(avg(v), 9) AS bright_a, round(avg(u), 9) AS bright_b FROM p GROUP BY img")
def pixel_diff(spark, d):
    out = audit.pixel_diff(rasters(spark, d).withColumn("u", F.least("v", F.lit(200))), ["img"], "v", "u")
    return out.withColumns({c: F.round(c, 9) for c in ("mean_diff", "std_diff", "bright_a", "bright_b")})


@query(f"WITH {SPLIT} SELECT doc_id || '_' || p AS doc_id, 'synthetic_' || source || '_degraded' AS source, p AS profile, 'degraded_synthetic' AS quality_tier, 'train' AS split FROM split, (SELECT unnest(['light', 'medium', 'heavy']) AS p) WHERE split = 'train'")
def degrade_cross(spark, d):
    docs = divided(spark, d).select(F.col("doc_id").cast("string").alias("doc_id"), F.concat(F.lit("synthetic_"), "source").alias("source"), "split", F.lit("clean").alias("quality_tier"))
    return audit.degraded_records(docs).select("doc_id", "source", "profile", "quality_tier", "split")


@query("SELECT conv_id, turn, length(text)::BIGINT AS pages, (coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1)::BIGINT AS start_page FROM conversations")
def page_offsets(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("pages"))
    return manifest.start_pages(c, "turn", ["conv_id"])


@query("WITH c AS (SELECT conv_id, turn, role, coalesce(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM conversations) SELECT conv_id, turn, role FROM c WHERE n < 2")
def limit_successes(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "role").withColumn("ok", F.col("role") == "assistant")
    return manifest.until_successes(c, 2, "turn", "ok", ["conv_id"]).drop("ok")


@query(
    f"""WITH {JUDGED} SELECT source, count(*) AS documents, count(*) FILTER (WHERE has_gt = 1) AS with_answers, round(avg(CASE WHEN quality IS NULL THEN 1 ELSE 2 END), 9) AS mean_fields, round(avg(has_gt), 9) AS mean_answer,
    round(avg(CASE WHEN quality = 0 THEN 1 ELSE 0 END), 9) AS mean_question, round(avg(n_chars), 6) AS mean_pages FROM judged GROUP BY source"""
)
def dataset_overview(spark, d):
    f = lambda role, value: F.struct(role.alias("role"), value.alias("value"))
    own = F.when(F.col("quality") == 1, f(F.lit("answer"), F.lit("v"))).when(F.col("quality") == 0, f(F.lit("question"), F.lit("")))
    docs = judged(spark, d).withColumn("fields", F.array_compact(F.array(f(F.lit("other"), F.lit("")), own))).withColumnRenamed("n_chars", "page_count")
    out = audit.dataset_overview(docs).drop("mean_header")
    return out.withColumns({c: F.round(c, 9) for c in ("mean_fields", "mean_answer", "mean_question")}).withColumn("mean_pages", F.round("mean_pages", 6))


@query(f"WITH {JUDGED} SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM judged WHERE has_gt = 1) WHERE r = 1")
def first_answered(spark, d):
    return audit.first_per_group(judged(spark, d).where("has_gt = 1").select("source", "doc_id"), ["source"], ["doc_id"])


@query(
    """WITH r AS (SELECT substr(md5(source || chr(31) || doc_id), 1, 4) AS part, sha256(source || chr(31) || doc_id || chr(31) || text) AS digest FROM documents),
    p AS (SELECT part, sha256(string_agg(digest, '' ORDER BY digest)) AS d, count(*) AS n FROM r GROUP BY part) SELECT sha256(string_agg(d, '' ORDER BY part)) AS fingerprint, sum(n)::BIGINT AS documents FROM p"""
)
def fingerprint(spark, d):
    return corpus.fingerprint(table(spark, d, "documents"), ["source", "doc_id"], F.col("text"))


@query(f"WITH {SPLIT} SELECT doc_id, source FROM split WHERE split = 'val' AND has_gt = 1 AND lang = 'en'")
def loader_filter(spark, d):
    f = F.struct(F.when(F.col("has_gt") == 1, "answer").otherwise("other").alias("role"), F.lit("v").alias("value"), F.lit("k").alias("field_id"))
    docs = divided(spark, d).withColumns({"fields": F.array(f), "quality_tier": F.col("lang"), "pdf_path": F.concat(F.lit("p"), "doc_id")})
    return corpus.load(docs, "val", quality_tier="en").select("doc_id", "source")


@query(
    """WITH s AS (SELECT doc_id, text, source, lang, n_chars FROM documents) SELECT source, cast(doc_id AS VARCHAR) AS doc_id, true AS has_pdf, 1 AS field_count,
    CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END AS response_field_count, CASE WHEN n_chars >= 500 THEN '{"' || lang || '":"' || n_chars || '"}' ELSE '{}' END AS gt_payload_json FROM s"""
)
def master_rows(spark, d):
    f = F.struct(F.col("lang").alias("field_id"), F.when(F.col("n_chars") >= 500, F.col("n_chars").cast("string")).otherwise("").alias("value"), F.lit("answer").alias("role"))
    none = F.lit(None).cast("string")
    docs = table(spark, d, "documents").select(
        "source", F.col("doc_id").cast("string").alias("doc_id"), none.alias("image_path"), F.lit("x.pdf").alias("pdf_path"), F.lit(1).alias("page_count"), none.alias("quality_tier"), F.lit(0.0).alias("quality_score"), F.col("lang").alias("language"), none.alias("doc_class"), none.alias("split"), F.array(f).alias("fields")
    )
    return fields.master_row(docs).select("source", "doc_id", "has_pdf", "field_count", "response_field_count", "gt_payload_json")


@query(
    """WITH d AS (SELECT doc_id, lang FROM documents), r AS (SELECT doc_id, quality AS dots FROM labels)
    SELECT d.doc_id, d.lang, coalesce(r.dots, 0) AS dots, d.doc_id || CASE WHEN r.doc_id IS NULL THEN '' ELSE '  |  0 clusters  0 gaps  ' || coalesce(r.dots, 0) || ' dots stamped' || CASE WHEN r.dots = 1 THEN '  |  a, b' ELSE '' END END AS caption
    FROM d LEFT JOIN r ON d.doc_id = r.doc_id"""
)
def review_captions(spark, d):
    logged = table(spark, d, "labels").select("doc_id", F.col("quality").alias("dots"), F.lit(True).alias("logged"))
    rows = table(spark, d, "documents").select("doc_id", "lang").join(logged, "doc_id", "left")
    notes = F.when(F.col("dots") == 1, F.array(F.lit("a"), F.lit("b")))
    none = F.lit(None).cast("int")
    line = text.caption(F.col("doc_id").cast("string"), F.col("dots"), none, none, notes, F.coalesce("logged", F.lit(False)))
    return rows.select("doc_id", "lang", F.coalesce("dots", F.lit(0)).alias("dots"), line.alias("caption"))


_REVIEW = """r AS (SELECT d.doc_id, d.n_chars AS pages, l.quality AS dots FROM documents d {how} JOIN labels l ON d.doc_id = l.doc_id {where})
    SELECT doc_id, pages, dots, (coalesce(sum(pages) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1)::BIGINT AS start_page FROM r"""


def reviewed(spark, d, only: bool):
    docs = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("pages"))
    runs = table(spark, d, "labels").select("doc_id", F.col("quality").alias("touch_up_dots"))
    return manifest.review_pages(docs, runs, "doc_id", only)


@query("WITH " + _REVIEW.format(how="LEFT", where=""))
def review_plan(spark, d):
    return reviewed(spark, d, False)


@query("WITH " + _REVIEW.format(how="", where="WHERE l.quality > 0"))
def only_touched(spark, d):
    return reviewed(spark, d, True)


#: Four turns share a page; each turn is a field whose value is its first word, and a line of text.
_PAGES = """c AS (SELECT conv_id, turn, floor(turn / 4)::BIGINT AS page, text, split_part(text, ' ', 1) AS value FROM conversations)"""


def turn_fields(spark, d, word: int = 1):
    box = F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0)))
    page = F.floor(F.col("turn") / 4)
    return table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), page.alias("page"), F.split_part("text", F.lit(" "), F.lit(word)).alias("value"), box.alias("bbox_norm"), F.lit(100.0).alias("page_w"), F.lit(1e6).alias("page_h")
    )


def turn_spans(spark, d):
    y = F.col("turn").cast("double")
    return table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.floor(F.col("turn") / 4).alias("page"), F.lit(1.0).alias("x0"), y.alias("y0"), F.lit(9.0).alias("x1"), (y + 0.5).alias("y1"), "text")


@query(
    f"""WITH {_PAGES}, f AS (SELECT conv_id, turn, page, list_filter(list_transform(string_split(value, chr(10)), lambda x: {_sql_stripped('x')}), lambda x: x <> '') AS lines FROM c),
    h AS (SELECT f.conv_id AS doc_id, f.turn AS pos, any_value(len(lines)) AS n, count(*) AS hits FROM f JOIN c ON f.conv_id = c.conv_id AND f.page = c.page WHERE len(list_filter(lines, lambda x: contains(c.text, x))) > 0 GROUP BY f.conv_id, f.turn)
    SELECT doc_id, pos, hits FROM h WHERE hits >= n"""
)
def redaction_hits(spark, d):
    return pdf.targets(turn_fields(spark, d), turn_spans(spark, d)).where("complete").groupBy("doc_id", "pos").agg(F.count("*").alias("hits"))


@query("SELECT 'all' AS part, doc_id FROM documents UNION ALL SELECT 'english', doc_id FROM documents WHERE lang = 'en'")
def union_all_sources(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return docs.select(F.lit("all").alias("part"), "doc_id").unionByName(docs.where("lang = 'en'").select(F.lit("english").alias("part"), "doc_id"))


@query("SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels")
def key_difference(spark, d):
    return table(spark, d, "documents").select("doc_id").exceptAll(table(spark, d, "labels").select("doc_id"))


@query("SELECT s AS seed, CASE WHEN s % 10 < 7 THEN 'train' WHEN s % 10 < 8 THEN 'val' ELSE 'test' END AS split, CASE WHEN source IN ('src1', 'src2') THEN true ELSE false END AS degradable, replace(replace(source || '/' || s, '/', '_'), chr(92), '_') AS name FROM (SELECT doc_id AS s, source FROM documents)")
def seed_split(spark, d):
    s = F.col("doc_id")
    return table(spark, d, "documents").select(s.alias("seed"), text.seed_split(s).alias("split"), text.degradable(F.col("source"), ("src1", "src2")).alias("degradable"), text.safe_name(F.concat_ws("/", "source", s.cast("string"))).alias("name"))


_LANES = """flds AS (
    SELECT l_orderkey AS doc_id, l_linenumber AS pos, CASE WHEN l_linenumber % 3 = 0 THEN 'question' ELSE 'answer' END AS role, CASE WHEN l_quantity > 10 THEN cast(l_partkey AS VARCHAR) ELSE '' END AS value,
        (l_linenumber - 1)::INTEGER AS page, l_discount AS x0, l_tax AS y0, l_quantity / 50 AS x1, l_extendedprice / 50000 AS y1 FROM lineitem
)"""


def order_fields(spark, d):
    li = table(spark, d, "lineitem")
    f = F.struct(
        F.col("l_linenumber").alias("pos"), F.concat(F.lit("f"), "l_linenumber").alias("field_id"), F.lit("x").alias("label"), F.when(F.col("l_quantity") > 10, F.col("l_partkey").cast("string")).otherwise("").alias("value"),
        F.when(F.col("l_linenumber") % 3 == 0, "question").otherwise("answer").alias("role"), F.array(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / 50, F.col("l_extendedprice") / 50000).alias("bbox_norm"), (F.col("l_linenumber") - 1).cast("int").alias("page"),
    )
    return li.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_sort(F.collect_list(f)).alias("fields")).withColumns({"source": F.lit("s"), "page_count": F.lit(3)})


_VALID = "role = 'answer' AND value <> '' AND x1 > x0 AND y1 > y0"


@query(
    f"""WITH {_LANES} SELECT 'content_stream' AS lane, doc_id, 'f' || pos AS field_id, value AS expected_value FROM flds WHERE {_VALID} AND page BETWEEN 0 AND 2
    UNION ALL SELECT 'widget', doc_id, 'f' || pos, value FROM flds WHERE role = 'answer' AND value <> '' UNION ALL SELECT 'image', doc_id, 'f' || pos, value FROM flds WHERE role = 'answer'"""
)
def lane_labels(spark, d):
    docs = order_fields(spark, d)
    parts = [fields.labels(docs, lane).select("lane", "doc_id", "field_id", "expected_value") for lane in fields.LANES]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    f"""WITH {_LANES} SELECT doc_id, 'f' || pos AS field_id, CASE WHEN NOT ({_VALID}) THEN 'no-bbox-or-empty-value' ELSE 'page-out-of-range' END AS reason
    FROM flds WHERE role = 'answer' AND (NOT ({_VALID}) OR page > 2)"""
)
def skipped_fields(spark, d):
    return pdf.skipped_fields(order_fields(spark, d)).select("doc_id", "field_id", "reason")


@query(
    f"""WITH {_LANES}, g AS (SELECT doc_id, count(*) FILTER (WHERE {_VALID} AND page <= 2)::INTEGER AS able, count(*) FILTER (WHERE role = 'answer' AND value <> '')::INTEGER AS answers FROM flds GROUP BY doc_id)
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'planned' WHEN 1 THEN 'planned' ELSE 'skipped' END AS status, CASE WHEN doc_id % 3 = 2 THEN 'image_only_pdf' END AS reason,
    CASE WHEN doc_id % 3 = 0 THEN able END AS redactable_field_count, CASE WHEN doc_id % 3 = 1 THEN answers END AS clearable_field_count FROM g"""
)
def lane_rows(spark, d):
    kind = F.when(F.col("doc_id") % 3 == 0, "born_digital_pdf").when(F.col("doc_id") % 3 == 1, "synthetic_acroform").otherwise("image_only_pdf")
    return pdf.plan_row(order_fields(spark, d).withColumn("category", kind)).select("doc_id", "status", "reason", "redactable_field_count", "clearable_field_count")


@query(
    """SELECT doc_id, CASE WHEN n_chars < 300 THEN 'no annotations' WHEN lang = 'en' AND doc_id % 2 = 0 THEN 'no pdf path' WHEN lang = 'en' AND doc_id % 3 = 0 THEN 'pdf not found'
    WHEN lang <> 'en' AND doc_id % 2 = 0 THEN 'no image path' WHEN lang <> 'en' AND doc_id % 3 = 0 THEN 'no images found' END AS reason FROM documents"""
)
def skip_ladder(spark, d):
    i = F.col("doc_id")
    path = F.when(i % 2 != 0, "p")
    source = F.when(F.col("lang") == "en", "synthetic_x").otherwise("funsd")
    reason = pdf.legacy_skip(F.when(F.col("n_chars") < 300, 0).otherwise(1), source, path, i % 3 != 0, path, F.when(i % 3 == 0, 0).otherwise(1))
    return table(spark, d, "documents").select("doc_id", reason.alias("reason"))


@query(
    """WITH p AS (SELECT l_returnflag AS source, l_linenumber AS a, (l_orderkey % 7 + 1)::INTEGER AS b, l_quantity AS w, l_extendedprice AS h FROM lineitem)
    SELECT source, round(avg(CASE WHEN a = b THEN 1 ELSE 0 END), 9) AS same_pages, round(avg(w), 6) AS mean_w_a, round(avg(h), 4) AS mean_h_a FROM p GROUP BY source"""
)
def structure_pairs(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("source"), F.col("l_linenumber").alias("pages_a"), (F.col("l_orderkey") % 7 + 1).cast("int").alias("pages_b"), F.col("l_quantity").alias("w_a"), F.col("l_extendedprice").alias("h_a"), F.col("l_quantity").alias("w_b"), F.col("l_extendedprice").alias("h_b")
    )
    out = audit.structure(li, ["source"])
    return out.select("source", F.round("same_pages", 9).alias("same_pages"), F.round("mean_w_a", 6).alias("mean_w_a"), F.round("mean_h_a", 4).alias("mean_h_a"))


@query(
    """WITH w AS (SELECT event_id, CASE WHEN value > 50 THEN 'v' ELSE '' END AS value, CASE WHEN event_id % 5 = 0 THEN 'd' END AS dv FROM events)
    SELECT event_id AS doc_id, (value <> '' OR dv IS NOT NULL) AS changed, CASE WHEN value <> '' AND dv IS NOT NULL THEN 'value,default_value' WHEN value <> '' THEN 'value' WHEN dv IS NOT NULL THEN 'default_value' END AS had FROM w"""
)
def widget_audit(spark, d):
    none = F.lit(None).cast("string")
    w = table(spark, d, "events").select(F.col("event_id").alias("doc_id"), F.lit("n").alias("name"), F.when(F.col("value") > 50, "v").otherwise("").alias("value"), F.when(F.col("event_id") % 5 == 0, "d").alias("default_value"), none.alias("appearance"), none.alias("background"))
    left = pdf.residual_widgets(w).select("doc_id", F.array_join("left", ",").alias("had"))
    return pdf.cleared_widgets(w).select("doc_id", "changed").join(left, "doc_id", "left")


@query(
    f"""WITH {_PAGES}, f AS (SELECT conv_id, turn, page, {_sql_stripped("unnest(string_split(split_part(text, ' ', 2), chr(10)))")} AS line FROM c)
    SELECT f.conv_id AS doc_id, f.turn AS pos, count(DISTINCT line)::INTEGER AS n FROM f WHERE line <> '' AND EXISTS (SELECT 1 FROM c WHERE c.conv_id = f.conv_id AND c.page = f.page AND contains(c.text, f.line)) GROUP BY f.conv_id, f.turn"""
)
def residual_lines(spark, d):
    return pdf.residual_text(turn_fields(spark, d, 2), turn_spans(spark, d)).select("doc_id", "pos", F.size("lines").alias("n"))


@query(
    """WITH t AS (SELECT user_id, event_id, value, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 3 WHEN 'purchase' THEN 5 ELSE 0 END + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS tag FROM events),
    r AS (SELECT *, CASE WHEN tag IN (1, 2) THEN 'header' WHEN tag IN (3, 4) THEN 'question' WHEN tag IN (5, 6) THEN 'answer' ELSE 'other' END AS role FROM t),
    o AS (SELECT *, CASE WHEN tag IN (1, 3, 5) OR role IS DISTINCT FROM lag(role) OVER w THEN 1 ELSE 0 END AS o FROM r WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    n AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM o),
    e AS (SELECT user_id, run, role, string_agg(cast(event_id AS VARCHAR), ' ' ORDER BY event_id) AS text, min(value) AS x0, max(value) AS x1 FROM n WHERE role <> 'other' GROUP BY user_id, run, role)
    SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY run) - 1 AS entity, role, md5(text) AS text, x0, x1 FROM e"""
)
def tagged_entities(spark, d):
    tag = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 3).when(F.col("event_type") == "purchase", 5).otherwise(0) + F.when(F.col("event_id") % 4 == 0, 1).otherwise(0)
    v = F.col("value")
    words = table(spark, d, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("pos"), F.col("event_id").cast("string").alias("word"), F.struct(v.alias("x0"), v.alias("y0"), v.alias("x1"), v.alias("y1")).alias("box"), tag.alias("tag"))
    return layout.token_entities(words).select("doc_id", F.col("entity").cast("long").alias("entity"), "role", F.md5("text").alias("text"), "x0", "x1")


@query(f"WITH {JUDGED} SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {_RANK}, coalesce(quality, 0) DESC, source, doc_id) AS r FROM judged) WHERE r <= 100")
def best_records(spark, d):
    """The first hundred of the corpus in its order (a report)."""
    tier = F.when(F.col("lang") == "en", "clean").when(F.col("lang") == "de", "degraded").when(F.col("lang") == "fr", "clean_synthetic").when(F.col("lang") == "es", "degraded_synthetic")
    rows = judged(spark, d).select("doc_id", "source", tier.alias("quality_tier"), F.coalesce("quality", F.lit(0)).alias("quality_score"))
    return corpus.ordered(rows, "doc_id").limit(100).select("doc_id")


@query(
    f"""WITH docs AS (SELECT source, doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)),
    pools AS (SELECT source, count(*) AS pool FROM docs GROUP BY source), av AS (SELECT sum(pool)::BIGINT AS available FROM pools),
    base AS (SELECT source, pool, least(pool, (61 * pool) // available)::BIGINT AS take, available FROM pools, av),
    short AS (SELECT (least(61, max(available)) - sum(take))::BIGINT AS short FROM base),
    slots AS (SELECT source, pool - take AS left_, short, unnest(range(1, least(pool - take, short) + 1)) AS k FROM base, short WHERE pool > take),
    steps AS (SELECT *, -ln((('0x' || substr(md5('7|' || source || '|' || k), 1, 13))::BIGINT::DOUBLE + 1) / 4503599627370496::DOUBLE) / (left_ - k + 1) AS step FROM slots),
    ranks AS (SELECT source, k, sum(step) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS rank FROM steps),
    drawn AS (SELECT source, row_number() OVER (ORDER BY rank, source, k) AS r FROM ranks),
    extra AS (SELECT source, count(*) AS extra FROM drawn, short WHERE r <= short GROUP BY source),
    takes AS (SELECT b.source, b.take + coalesce(e.extra, 0) AS take FROM base b LEFT JOIN extra e ON b.source = e.source),
    ranked AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('7|' || doc_id), doc_id) AS r FROM docs)
    SELECT k.source, k.doc_id FROM ranked k JOIN takes t ON k.source = t.source WHERE k.r <= t.take"""
)
def sample_excluding(spark, d):
    return manifest.sample(table(spark, d, "documents").select("source", "doc_id"), 61, 7, table(spark, d, "labels").where("toxic = 1"))


@query("SELECT source, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY source")
def sample_breakdown(spark, d):
    return manifest.breakdown(table(spark, d, "documents").where("lang = 'en'"))


@query("SELECT doc_id, source FROM documents WHERE lang = 'en' AND source = 'src0'")
def selected_rows(spark, d):
    return corpus.select_rows(table(spark, d, "documents"), lang="en", source="src0", n_chars=None).select("doc_id", "source")


@query(
    """WITH t AS (SELECT 'a_' || CASE doc_id % 4 WHEN 0 THEN 'Amendment' WHEN 1 THEN 'Short-Form' WHEN 2 THEN 'Amendment_Report' ELSE 'x' END || '_' || doc_id AS doc_id, CASE WHEN lang = 'en' THEN 'vrdu_registration' ELSE 'funsd' END AS source, doc_id % 4 AS k FROM documents)
    SELECT doc_id, source, CASE WHEN source = 'vrdu_registration' THEN 'Amendment' END AS subtype FROM t WHERE source <> 'vrdu_registration' OR k IN (0, 2)"""
)
def subtype_filter(spark, d):
    k = F.col("doc_id") % 4
    tag = F.when(k == 0, "Amendment").when(k == 1, "Short-Form").when(k == 2, "Amendment_Report").otherwise("x")
    docs = table(spark, d, "documents").select(F.concat_ws("_", F.lit("a"), tag, F.col("doc_id").cast("string")).alias("doc_id"), F.when(F.col("lang") == "en", "vrdu_registration").otherwise("funsd").alias("source"))
    return manifest.with_subtype(docs, ["Amendment"])


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def missing_outputs(spark, d):
    return release.missing(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"))


@query("SELECT (SELECT count(*) FROM documents) AS candidates, (SELECT count(*) FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)) AS excluded_dropped, (SELECT count(*) FROM documents WHERE lang = 'en') AS included")
def manifest_stats(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return manifest.build_stats(docs, table(spark, d, "labels").where("toxic = 1"), docs.where("lang = 'en'"))


@query("SELECT 0 AS source_ord, source, cast(doc_id AS VARCHAR) AS doc_id FROM documents UNION ALL SELECT 1, 'conv', cast(conv_id AS VARCHAR) FROM conversations WHERE turn = 0 UNION ALL SELECT 2, 'page', cast(page_id AS VARCHAR) FROM pages")
def union_sources(spark, d):
    parts = [
        forms.record(table(spark, d, t).where(where), source=source, doc_id=F.col(key))
        for t, where, source, key in (("documents", "true", F.col("source"), "doc_id"), ("conversations", "turn = 0", F.lit("conv"), "conv_id"), ("pages", "true", F.lit("page"), "page_id"))
    ]
    return forms.union_sources(*parts).select("source_ord", "source", "doc_id")


@query(
    """WITH a AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations), m AS (SELECT * FROM (VALUES ('system', 'Exact'), ('assistant', 'Fuzzy')) t(role, kind))
    SELECT cast(conv_id AS VARCHAR) AS doc_id, pos, a.role AS field_id, upper(a.role[1]) || a.role[2:] AS label, text AS value, coalesce(kind, 'StringMatch') AS match_type, (turn % 3)::INTEGER AS page, 0.25::DOUBLE AS x0, 1.0::DOUBLE AS x1 FROM a LEFT JOIN m ON a.role = m.role"""
)
def json_line_records(spark, d):
    """Conversations as the JSON lines of annotated PDFs, read back into records."""
    place = F.array(F.col("turn") % 3, F.lit(0.25), F.lit(0.5), F.lit(7.0), F.lit(0.75))
    quoted = lambda c: F.substring(F.to_json(F.struct(F.col(c).alias("x"))), F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("x")))) - 6)  # noqa: E731  {"x":...}
    one = F.concat(F.lit("["), quoted("role"), F.lit(",[["), quoted("text"), F.lit(","), F.to_json(place), F.lit("]]]"))
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("a")))), lambda x: x["a"]), ",").alias("all"))
    lines = rows.select(F.parse_json(F.concat(F.lit('{"filename":"'), "conv_id", F.lit('.pdf","page_count":3,"annotations":['), "all", F.lit("]}"))).alias("v"), F.lit(0).alias("subset_ord"), F.col("conv_id").alias("line_no"))
    kinds = spark.createDataFrame([("system", "Exact"), ("assistant", "Fuzzy")], "field_id string, match_type string")
    f = fields.flat(forms.pdf_corpus(lines, "c", match_types=kinds))
    return f.select("doc_id", F.col("pos").cast("long").alias("pos"), "field_id", "label", "value", "match_type", "page", F.col("bbox_norm")[0].alias("x0"), F.col("bbox_norm")[2].alias("x1"))


@query(f"WITH {PX} SELECT img, y, x, floor(v * 0.299::DOUBLE + (255 - v) * 0.587::DOUBLE + (v // 2) * 0.114::DOUBLE + 0.5::DOUBLE)::INTEGER AS gray FROM px")
def page_gray(spark, d):
    v = F.col("v")
    return rasters(spark, d).select("img", "y", "x", raster.luma(v, 255 - v, F.floor(v / 2)).alias("gray"))


@query("SELECT path, sum(length(path)) OVER (ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT DISTINCT coalesce(url, '') AS path FROM pages)".replace("sum(length(path))", "coalesce(sum(length(path))").replace("1 PRECEDING)", "1 PRECEDING), 0)::BIGINT"))
def running_offsets(spark, d):
    paths = table(spark, d, "pages").select(F.coalesce("url", F.lit("")).alias("path")).distinct().withColumn("n", F.length("path"))
    return ranges.running(paths, "n", "path", "before").select("path", "before")
