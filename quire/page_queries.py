"""Queries over records, files and rasters that go through readers, writers and the page operators; they join those of ``quire.queries``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import boxes, fields, text
from quire.operators import corpus, manifest, pages, pdf
from quire.operators.ranges import kept, scratch
from quire.plans import corpus_run
from quire.queries import FG, OTSU, PX, SPLIT, _sql_line, divided, order_fields, query, rasters, table
from quire.sources import files, forms, sinks, synthetic


# records


_LINES = """li AS (SELECT l_orderkey, l_linenumber, (l_linenumber * 10)::INTEGER AS x0, 5 AS y0, (l_linenumber * 10 + 9)::INTEGER AS x1, (5 + l_quantity)::INTEGER AS y1, l_returnflag || l_linestatus AS word,
    CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 3 WHEN l_linestatus = 'O' THEN 6 ELSE 0 END AS tag FROM lineitem)"""


@query(
    f"""WITH {_LINES}, r AS (SELECT *, CASE WHEN tag IN (1, 2) THEN 'header' WHEN tag IN (3, 4) THEN 'question' WHEN tag IN (5, 6) THEN 'answer' ELSE 'other' END AS role FROM li),
    o AS (SELECT *, CASE WHEN tag IN (1, 3, 5) OR role IS DISTINCT FROM lag(role) OVER w THEN 1 ELSE 0 END AS o FROM r WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, word, y1, tag)),
    n AS (SELECT *, sum(o) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, word, y1, tag ROWS UNBOUNDED PRECEDING) AS run FROM o),
    e AS (SELECT l_orderkey, run, role, string_agg(word, ' ' ORDER BY l_linenumber, word, y1, tag) AS t, min(x0) / 100::DOUBLE AS x0, min(y0) / 100::DOUBLE AS y0, max(x1) / 100::DOUBLE AS x1, max(y1) / 100::DOUBLE AS y1 FROM n WHERE role <> 'other' GROUP BY l_orderkey, run, role)
    SELECT 'train_' || l_orderkey AS doc_id, 'f' || (row_number() OVER (PARTITION BY l_orderkey ORDER BY run) - 1) AS field_id, CASE WHEN role <> 'answer' THEN t ELSE '' END AS label, CASE WHEN role = 'answer' THEN t ELSE '' END AS value, role, x0, y0, x1, y1 FROM e"""
)
def token_scan_fields(spark, d):
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    box = F.array((n * 10).cast("double"), F.lit(5.0), (n * 10 + 9).cast("double"), F.rint(q + 5))
    tag = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 3).when(F.col("l_linestatus") == "O", 6).otherwise(0)
    one = F.struct(n.alias("n"), F.concat("l_returnflag", "l_linestatus").alias("w"), box.alias("b"), tag.alias("t"))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("z"))  # an order has few lines
    part = lambda k: F.transform("z", lambda x: x[k])
    room = 1 << 32  # no line lies outside a page of so many times 100 pixels; by a power of two the division stays exact
    size = F.lit(100 * room)
    scans = rows.select(
        F.lit("train").alias("split"), F.col("l_orderkey").cast("string").alias("id"), F.lit("x.png").alias("image_path"), size.alias("width"), size.alias("height"), part("w").alias("words"), part("b").alias("bboxes"), part("t").alias("ner_tags")
    )
    f = fields.flat(forms.token_scans(scans))
    return f.select("doc_id", "field_id", "label", "value", "role", *((F.col("bbox_norm")[i] * float(room)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))


@query(
    "SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN 'b=' || n_chars ELSE '' END AS payload, (CASE WHEN n_chars % 3 = 0 THEN 1 ELSE 0 END)::INTEGER AS answered FROM documents"
)
def legacy_payloads(spark, d):
    """A blank value is an answer in the record and none in its older form."""
    f = lambda key, value, role: F.struct(F.lit(key).alias("field_id"), value.alias("value"), F.lit(role).alias("role"))
    n = F.when(F.col("n_chars") % 3 == 0, F.col("n_chars").cast("string")).otherwise("  ")
    docs = table(spark, d, "documents").select("doc_id", F.array(f("a", F.lit(" "), "answer"), f("b", n, "answer"), f("c", F.lit("x"), "question")).alias("fields"))
    out = fields.legacy_record(docs)
    payload = F.array_join(F.transform(F.map_entries("gt_payload"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return out.select("doc_id", payload.alias("payload"), F.size(F.filter("fields", lambda x: x["has_response"])).alias("answered"))


@query("SELECT 'rvlcdip_train_' || lpad(cast(row_number() OVER (ORDER BY path) - 1 AS VARCHAR), 6, '0') AS doc_id, path AS image_path FROM (SELECT DISTINCT coalesce(url, '') AS path FROM pages)")
def label_scan_ids(spark, d):
    images = table(spark, d, "pages").select(F.coalesce("url", F.lit("")).alias("path")).distinct()
    return forms.label_scans(images, "train").select("doc_id", "image_path")


@query("SELECT l_orderkey AS doc_id, 'f' || l_linenumber AS field_id, CASE WHEN l_quantity > 10 THEN cast(l_partkey AS VARCHAR) ELSE '' END AS value, (l_linenumber - 1)::INTEGER AS page FROM lineitem")
def nested_and_flat(spark, d):
    docs = order_fields(spark, d).withColumn("fields", F.transform("fields", lambda f: f.dropFields("pos")))
    return fields.flat(fields.nested(fields.flat(docs))).select("doc_id", "field_id", "value", "page")


@query(
    """WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages), s AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN 'vrdu_ad_buy_7' WHEN 1 THEN 'funsd' WHEN 2 THEN 'xfund_de_9' ELSE 'other_1' END AS stem, CASE page_id % 3 WHEN 0 THEN 'a.PDF' WHEN 1 THEN 'dir.x/b' ELSE 'c_p000.png' END AS name FROM u)
    SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'vrdu_ad_buy' WHEN 1 THEN 'funsd' WHEN 2 THEN 'xfund_de' ELSE 'other' END AS source, CASE page_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '' ELSE '.png' END AS suffix, page_id % 3 = 0 AS is_pdf,
    CASE WHEN page_id % 3 = 0 THEN 'pdf' ELSE 'image' END AS render, CASE page_id % 3 WHEN 0 THEN 'a_p002.PDF' WHEN 1 THEN 'dir.x/b_p002' ELSE 'c_p002.png' END AS second, CASE WHEN page_id % 5 = 0 THEN '/abs/' || name ELSE 'base/' || name END AS path,
    CASE WHEN page_id % 7 = 0 THEN NULL ELSE 'v' || page_id END AS value FROM s"""
)
def file_names(spark, d):
    i = F.col("page_id")
    stem = F.when(i % 4 == 0, "vrdu_ad_buy_7").when(i % 4 == 1, "funsd").when(i % 4 == 2, "xfund_de_9").otherwise("other_1")
    name = F.when(i % 3 == 0, "a.PDF").when(i % 3 == 1, "dir.x/b").otherwise("c_p000.png")
    rows = table(spark, d, "pages").select("page_id", stem.alias("stem"), name.alias("name"))
    source = text.source_of_stem(F.col("stem"), list(manifest.SOURCES))
    return rows.select(
        "page_id", source.alias("source"), text.suffix(F.col("name")).alias("suffix"), text.is_pdf(F.col("name")).alias("is_pdf"), text.render_path(F.col("name"), source, F.lit("pdf")).alias("render"),
        text.page_image_candidates(F.col("name"), F.lit(2))[0].alias("second"), text.resolve_path(F.lit(""), F.when(i % 5 == 0, F.concat(F.lit("/abs/"), "name")), F.col("name"), base="base").alias("path"),
        fields.nullable(F.when(i % 7 == 0, "NaN").otherwise(F.concat(F.lit("v"), i.cast("string")))).alias("value"),
    )


@query("SELECT doc_id AS id, source, lang AS category, CASE WHEN lang = 'en' THEN 'a.pdf' END AS pdf, CASE WHEN lang <> 'en' THEN 'b.png' END AS image, 'dir/' || doc_id || '.fields.json' AS fields_json, n_chars::BIGINT AS text_char_count FROM documents")
def manifest_entries(spark, d):
    en = F.col("lang") == "en"
    docs = table(spark, d, "documents").select(
        "doc_id", "source", F.col("lang").alias("category"), F.when(en, "a.pdf").alias("pdf_path"), F.lit("b.png").alias("image_path"), F.lit("dir").alias("subdir"), F.lit(1).alias("page_count"), F.col("n_chars").cast("long").alias("text_char_count"), F.lit(0).alias("widget_count"), F.lit(None).cast("string").alias("subtype")
    )
    return fields.manifest_entry(docs).select("id", "source", "category", "pdf", "image", "fields_json", "text_char_count")


@query(
    """WITH c AS (SELECT conv_id, turn, role, length(text)::BIGINT AS n FROM conversations), f AS (SELECT conv_id, role, min(turn) AS t FROM c GROUP BY conv_id, role)
    SELECT c.conv_id AS doc_id, count(*) AS pages, sum(n)::BIGINT AS redacted, sum(turn)::BIGINT AS dots, any_value(k.notes) AS notes FROM c JOIN (SELECT conv_id, string_agg(role, ',' ORDER BY t) AS notes FROM f GROUP BY conv_id) k ON c.conv_id = k.conv_id GROUP BY c.conv_id"""
)
def run_totals(spark, d):
    zero = F.lit(0).cast("long")
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page"), F.length("text").cast("long").alias("redacted"), F.col("turn").cast("long").alias("dots"), zero.alias("clusters"), zero.alias("gaps"), F.array("role").alias("notes"))
    return pages.run_totals(rows).select("doc_id", "pages", "redacted", F.col("touch_up_dots").alias("dots"), F.array_join("touch_up_notes", ",").alias("notes"))


@query("SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def only_listed(spark, d):
    return manifest.only(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels").where("quality = 1"))


@query("WITH k AS (SELECT * FROM (VALUES ('vrdu_ad_buy', 'pdf', 'ad_buy'), ('vrdu_registration', 'pdf', 'registration'), ('funsd', 'image', 'funsd'), ('xfund_de', 'image', 'xfund_de'), ('xfund_fr', 'image', 'xfund_fr')) t(source, kind, subdir)), d AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'funsd' WHEN 1 THEN 'vrdu_ad_buy' ELSE 'unknown' END AS source FROM documents) SELECT doc_id, d.source, kind, subdir FROM d JOIN k ON d.source = k.source")
def registered_sources(spark, d):
    i = F.col("doc_id")
    docs = table(spark, d, "documents").select("doc_id", F.when(i % 3 == 0, "funsd").when(i % 3 == 1, "vrdu_ad_buy").otherwise("unknown").alias("source"))
    return docs.join(F.broadcast(manifest.registry(spark)), "source").select("doc_id", "source", "kind", "subdir")


@query(
    """WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages), f AS (SELECT DISTINCT url AS path, regexp_extract(url, '[^/]*$') AS base FROM u), b AS (SELECT base, min(path) AS first FROM f GROUP BY base),
    n AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE regexp_extract(url, '[^/]*$') END AS fname FROM u)
    SELECT page_id, coalesce(f.path, b.first) AS image_path FROM n LEFT JOIN f ON n.fname = f.path LEFT JOIN b ON regexp_extract(n.fname, '[^/]*$') = b.base"""
)
def files_by_name(spark, d):
    u = table(spark, d, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    name = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.element_at(F.split("url", "/"), -1))
    return forms.with_files(u.select("page_id", name.alias("fname")), u.select(F.col("url").alias("path")), "fname").select("page_id", "image_path")


@query("SELECT d.source, d.doc_id, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS n FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def fields_or_none(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id")
    known = docs.join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id").select("source", "doc_id", F.array(F.struct(F.lit("f").alias("field_id"))).alias("fields"))
    return corpus.load_with_fallback(docs, known).select("source", "doc_id", F.size("fields").alias("n"))


@query(
    f"""WITH {SPLIT}, k AS (SELECT * FROM (VALUES ('supplier', 50, 1000), ('invoice', 50, 2000), ('compliance', 30, 3000), ('patient', 30, 4000)) t(form, n, base)), g AS (SELECT form, base + unnest(range(0, n)) AS seed FROM k),
    r AS (SELECT 'synthetic_' || form AS source, 'synthetic_' || form || '_' || lpad(cast(seed AS VARCHAR), 5, '0') AS doc_id, 'clean_synthetic' AS quality_tier, CASE WHEN seed % 10 < 7 THEN 'train' WHEN seed % 10 < 8 THEN 'val' ELSE 'test' END AS split FROM g)
    SELECT source, cast(doc_id AS VARCHAR) AS doc_id, lang AS quality_tier, split FROM split UNION ALL SELECT * FROM r
    UNION ALL SELECT source || '_degraded', doc_id || '_' || p, 'degraded_synthetic', 'train' FROM r, (SELECT unnest(['light', 'medium', 'heavy']) AS p) WHERE split = 'train'"""
)
def corpus_with_generated(spark, d):
    docs = divided(spark, d).select("source", F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").alias("quality_tier"), "split")
    generated = synthetic.forms(spark).select("source", "doc_id", "quality_tier", "split")
    return corpus_run.with_generated(docs, generated)


@query("SELECT l_orderkey AS doc_id, count(*) AS n, count(*) FILTER (WHERE l_discount <= l_quantity / 50 AND l_tax <= l_extendedprice / 50000) AS ordered FROM lineitem GROUP BY l_orderkey")
def box_contains(spark, d):
    """How many of an order's boxes hold their own corner, turned upside down and back."""
    f = fields.flat(order_fields(spark, d))
    b = boxes.flip_y(boxes.flip_y(F.col("bbox_norm")))
    box = F.struct(*(b[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))
    near = lambda i, c: F.abs(box[c] - F.col("bbox_norm")[i]) < 1e-9
    own = F.struct(*(F.col("bbox_norm")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))
    ok = near(0, "x0") & near(1, "y0") & near(2, "x1") & near(3, "y1") & boxes.contains(own, own["x0"], own["y0"])
    return f.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(ok).alias("ordered"))


# files written and read again


@query("SELECT source, cast(doc_id AS VARCHAR) AS doc_id, true AS has_pdf, 1 AS response_field_count, '{\"k\":\"' || lang || '\"}' AS gt_payload_json FROM documents")
def master_file(spark, d):
    path = scratch(spark, "master")
    sinks.write_master(_records(spark, d), path)
    return spark.read.parquet(path).select("source", "doc_id", "has_pdf", "response_field_count", "gt_payload_json")


def _records(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    f = forms.field(F.lit("k"), F.lit("K"), F.col("lang"), F.lit("answer"), F.array(F.lit(0.0), F.lit(0.0), F.lit(0.5), F.lit(0.5)), F.lit(0), "pdf")
    docs = table(spark, d, "documents")
    return forms.record(docs, source=F.col("source"), doc_id=F.col("doc_id"), image_path=none, pdf_path=F.lit("x.pdf"), page_count=F.lit(1), language=F.col("lang"), fields=F.array(f), split=F.when(F.col("n_chars") >= 300, "train").otherwise("val"))


@query("SELECT source, cast(doc_id AS VARCHAR) AS doc_id, lang AS value FROM documents")
def document_files(spark, d):
    """Nested records as JSON in a folder for each source, read back by the strict reader."""
    path = scratch(spark, "documents")
    sinks.write_documents(_records(spark, d), path)
    back = spark.read.schema("source string, doc_id string, fields array<struct<value:string>>, gt_payload map<string,string>").json(path)
    return back.where("gt_payload['k'] = fields[0].value").select("source", "doc_id", F.col("fields")[0]["value"].alias("value"))


@query("SELECT source, cast(doc_id AS VARCHAR) AS doc_id FROM documents WHERE n_chars >= 300")
def split_file(spark, d):
    path = scratch(spark, "split")
    sinks.write_split(_records(spark, d), "train", path)
    return spark.read.parquet(path).select("source", "doc_id")


@query("SELECT user_id AS doc_id, arg_max(event_type, event_id) AS status, max(event_id) AS n FROM events GROUP BY user_id")
def run_log_file(spark, d):
    """Events as a run log in order of time; of each document the last line counts."""
    path = scratch(spark, "run")
    rows = table(spark, d, "events").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("status"), F.col("event_id").alias("n"))
    sinks.write_run_log(rows.repartitionByRange(4, "n").sortWithinPartitions("n"), path)
    return files.run_log(spark, path).select("doc_id", "status", "n")


@query("SELECT l_orderkey AS doc_id, count(*) AS n, min('f' || l_linenumber) AS first FROM lineitem WHERE l_linenumber % 3 <> 0 AND l_quantity > 10 GROUP BY l_orderkey")
def label_files(spark, d):
    path = scratch(spark, "labels")
    sinks.write_labels(fields.labels(order_fields(spark, d), "widget"), path)
    back = spark.read.schema("doc_id long, lane string, answer_fields array<struct<field_id:string>>").json(path)
    return back.where("lane = 'widget'").select("doc_id", F.size("answer_fields").cast("long").alias("n"), F.col("answer_fields")[0]["field_id"].alias("first"))


@query("SELECT cast(doc_id AS VARCHAR) AS doc_id, source FROM documents")
def manifest_parts(spark, d):
    path = scratch(spark, "manifest")
    sinks.write_manifest(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "source"), path)
    return spark.read.schema("doc_id string, source string").json(path)


# PDF files


def _text_pdf(lines: list[str]) -> bytes:
    from quire.pdf.objects import Name, Pdf, Stream, write

    out = Pdf()
    font = out.add({"Type": Name("Font"), "Subtype": Name("Type1"), "BaseFont": Name("Helvetica"), "Encoding": Name("WinAnsiEncoding")})
    body = b"".join(b"BT /F 10 Tf 50 %d Td " % (740 - 20 * i) + write(t.encode("cp1252", "replace")) + b" Tj ET\n" for i, t in enumerate(lines))
    out.add_page({"MediaBox": [0, 0, 600, 800], "Resources": {"Font": {"F": font}}, "Contents": out.add(Stream({}, body))})
    return out.save()


def label_pdfs(spark: SparkSession, d: str) -> DataFrame:
    """A file for each document: its source and language as lines of a page; every third is a form."""
    from quire.pdf.forms import form_file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(i, pdf.TOGETHER) for whole in batches for i in range(0, whole.num_rows, pdf.TOGETHER)):
            out = [
                form_file("Form", [("source", "Source", r["source"], [0.4, 0.2, 0.9, 0.23]), ("lang", "Language", r["lang"], [0.4, 0.3, 0.9, 0.33])]) if r["doc_id"] % 3 == 2 else _text_pdf([f"Source: {r['source']}", f"Language: {r['lang']}"])
                for r in b.to_pylist()
            ]
            paths = [f"/in/{i}.pdf" for i in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(out, pa.binary())], names=["path", "content"])

    docs = table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"))
    # a file costs as much however few bytes its row has, so rows are dealt by their number
    return docs.repartition(docs.count() // pdf.FILES_A_TASK + 1, "doc_id").mapInArrow(run, "path string, content binary")


def _lane_docs(spark: SparkSession, d: str) -> DataFrame:
    box = F.array(F.lit(0.1), F.lit(50.0 / 800), F.lit(0.6), F.lit(65.0 / 800))
    f = F.struct(F.lit("source").alias("field_id"), F.coalesce("source", F.lit("")).alias("value"), box.alias("bbox_norm"), F.lit(0).alias("page"), F.lit("answer").alias("role"))
    kind = F.when(F.col("doc_id") % 3 == 2, "synthetic_acroform").when(F.col("doc_id") % 3 == 1, "image_only_pdf").otherwise("born_digital_pdf")
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), kind.alias("category"), F.array(f).alias("fields"))


@query(
    "SELECT cast(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 = 2 THEN 'Form' || chr(10) || 'Source' || chr(10) || 'Language' ELSE 'Source: ' || source || chr(10) || 'Language: ' || lang END AS text, CASE WHEN doc_id % 3 = 2 THEN 2 ELSE 0 END AS widget_count FROM documents"
)
def pdf_text(spark, d):
    return pdf.page_rows(label_pdfs(spark, d)).where("error is null").select("doc_id", "text", "widget_count")


@query("SELECT cast(doc_id AS VARCHAR) AS doc_id, 'born_digital_pdf' AS category, 1::BIGINT AS page_count FROM documents")  # forms have text too, and text outweighs widgets
def pdf_categories(spark, d):
    return manifest.profile(pdf.page_rows(label_pdfs(spark, d))).select("doc_id", "category", "page_count")


@query(
    """SELECT cast(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 = 1 THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN doc_id % 3 = 0 THEN 1 END AS redacted_field_count, CASE WHEN doc_id % 3 = 2 THEN 2 END AS cleared_widget_count,
    CASE doc_id % 3 WHEN 0 THEN 'Source:' || chr(10) || 'Language: ' || lang WHEN 2 THEN 'Form' || chr(10) || 'Source' || chr(10) || 'Language' END AS left_text FROM documents"""
)
def pdf_blanked(spark, d):
    """Both lanes over real files: what the run says, and the text that is left in what it wrote."""
    done = pdf.blank_files(label_pdfs(spark, d), _lane_docs(spark, d))
    path = scratch(spark, "blank")
    done.write.parquet(path)
    done = spark.read.schema(done.schema).parquet(path)
    written = done.where("data is not null").select(F.concat(F.lit("/out/"), "doc_id", F.lit(".pdf")).alias("path"), F.col("data").alias("content"))
    left = pdf.page_rows(written).select("doc_id", F.regexp_replace("text", r" +(?=\n|$)", "").alias("left_text"))
    return done.select("doc_id", "status", "redacted_field_count", "cleared_widget_count").join(left, "doc_id", "left")


@query("SELECT cast(doc_id AS VARCHAR) AS doc_id, 'source' AS name, source AS value FROM documents WHERE doc_id % 3 = 2 UNION ALL SELECT cast(doc_id AS VARCHAR), 'lang', lang FROM documents WHERE doc_id % 3 = 2")
def pdf_widgets(spark, d):
    widgets = kept(pdf.widget_rows(label_pdfs(spark, d)), "widgets")  # the files are made and read once
    left = pdf.residual_widgets(widgets)
    rows = widgets.select("doc_id", "name", "value")
    return rows.join(left.select("doc_id", "name"), ["doc_id", "name"], "left_semi")


@query("SELECT cast(doc_id AS VARCHAR) AS doc_id, 'ok' AS status, CASE WHEN doc_id % 3 = 2 THEN 2 ELSE 0 END AS had_value FROM documents")
def pdf_light_clearing(spark, d):
    return pdf.blanked_widgets(label_pdfs(spark, d)).select("doc_id", "status", "had_value")


@query("SELECT cast(doc_id AS VARCHAR) AS doc_id, 'ok' AS status, 1 AS recolored_targets, 0 AS skipped_fields FROM documents")
def pdf_previews(spark, d):
    return pdf.preview_files(label_pdfs(spark, d), _lane_docs(spark, d)).select("doc_id", "status", "recolored_targets", "skipped_fields")


# rasters through the page operators


def per_raster(spark: SparkSession, d: str, ddl: str, work: Callable[[np.ndarray], dict]) -> DataFrame:
    """work on each 8 x 8 raster as a grey image; img and what work gives."""
    schema = pdf._arrow(f"img bigint, {ddl}")
    px = rasters(spark, d).groupBy("img").agg(F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "v"))), lambda p: p["v"]).alias("v"))  # 64 pixels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"img": i, **work(np.array(v, np.uint8).reshape(8, 8))} for i, v in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return px.select(F.col("img").cast("long").alias("img"), "v").mapInArrow(run, f"img bigint, {ddl}")


def _rgb(gray: np.ndarray) -> np.ndarray:
    return np.repeat(gray[:, :, None], 3, 2)


@query(f"WITH {OTSU} SELECT img, threshold::INTEGER AS threshold FROM otsu")
def page_otsu(spark, d):
    return per_raster(spark, d, "threshold int", lambda g: {"threshold": pages.otsu(pages.gray_of(g))})


@query(
    f"""WITH RECURSIVE {FG}, on_ AS (SELECT img, y * 8 + x AS p, y, x FROM fg WHERE fg = 1),
    reach AS (SELECT img, p, y, x, p AS q FROM on_ UNION SELECT o.img, o.p, o.y, o.x, r.q FROM reach r JOIN on_ o ON o.img = r.img AND abs(o.x - r.x) <= 1 AND abs(o.y - r.y) <= 1),
    lab AS (SELECT img, p, min(q) AS root FROM reach GROUP BY img, p) SELECT img, count(DISTINCT root)::INTEGER AS n FROM lab GROUP BY img"""
)
def page_components(spark, d):
    return per_raster(spark, d, "n int", lambda g: {"n": pages.count_components(g <= pages.otsu(g))})


@query(
    f"""WITH {FG}, {_sql_line("fg", "h", "fg", "h_rule", "x", 1, "min", "max")}, {_sql_line("h", "c", "v", "closed", "x", 1, "max", "min")}, u AS (SELECT *, greatest(fg, CASE WHEN closed - v > 20 THEN 1 ELSE 0 END) AS u FROM c),
    {_sql_line("u", "w", "u", "v_rule", "y", 1, "min", "max")}, r AS (SELECT img, y, x, fg, greatest(h_rule, v_rule) AS rule, CASE WHEN greatest(h_rule, v_rule) = 1 THEN 0 ELSE fg END AS t FROM w),
    a AS (SELECT *, max(t) OVER (PARTITION BY img, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS a FROM r),
    b AS (SELECT *, max(a) OVER (PARTITION BY img, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS b FROM a)
    SELECT img, sum(fg)::INTEGER AS foreground, sum(rule)::INTEGER AS rules, sum(CASE WHEN rule = 1 THEN 0 ELSE b END)::INTEGER AS text FROM b GROUP BY img"""
)
def page_classes(spark, d):
    def work(g: np.ndarray) -> dict:
        m = pages.classify(g, 2, h_least=3, v_least=3, tophat=3)
        return {"foreground": int(m.foreground.sum()), "rules": int((m.h_rules | m.v_rules).sum()), "text": int(m.text.sum())}

    return per_raster(spark, d, "foreground int, rules int, text int", work)


@query(
    f"""WITH {PX}, s AS (SELECT img, CASE WHEN y = 0 AND x BETWEEN 2 AND 5 THEN 'a' WHEN y = 6 AND x BETWEEN 2 AND 5 THEN 'b' WHEN x = 0 AND y BETWEEN 2 AND 4 THEN 'c' WHEN x = 7 AND y BETWEEN 2 AND 4 THEN 'd' END AS side, v FROM px),
    m AS (SELECT img, side, trunc(median(v)::DOUBLE)::INTEGER AS c FROM s WHERE side IS NOT NULL GROUP BY img, side),
    k AS (SELECT img, avg(CASE WHEN side IN ('a', 'b') AND c >= 90 THEN c END) AS p, avg(CASE WHEN side IN ('c', 'd') AND c >= 90 THEN c END) AS q, max(CASE WHEN side = 'a' THEN c END) AS t FROM m GROUP BY img)
    SELECT img, coalesce(trunc(p)::INTEGER, trunc(q)::INTEGER, t) AS color, CASE WHEN p IS NOT NULL THEN 'vertical' WHEN q IS NOT NULL THEN 'horizontal' ELSE 'fallback' END AS origin FROM k"""
)
def page_background(spark, d):
    def work(g: np.ndarray) -> dict:
        color, origin = pages.background(_rgb(g), (2, 2, 6, 5), width=1, offset=1)
        return {"color": int(color[0]), "origin": origin}

    return per_raster(spark, d, "color int, origin string", work)


@query(
    f"""WITH {FG}, t AS (SELECT img, max(threshold) AS threshold, max(v) AS top, min(v) AS low FROM px JOIN otsu USING (img) GROUP BY img),
    a AS (SELECT *, max(fg) OVER (PARTITION BY img, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS a FROM fg),
    b AS (SELECT *, max(a) OVER (PARTITION BY img, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS b FROM a),
    c AS (SELECT img, trunc(median(v)::DOUBLE)::INTEGER AS color FROM px WHERE y = 7 AND x BETWEEN 2 AND 5 GROUP BY img),
    n AS (SELECT img, sum(b)::BIGINT AS text_pixels, sum(v) FILTER (WHERE b = 0)::BIGINT AS kept FROM b WHERE x BETWEEN 2 AND 5 AND y BETWEEN 2 AND 4 GROUP BY img)
    SELECT n.img, text_pixels, (coalesce(kept, 0) + text_pixels * color)::BIGINT AS inside, CASE WHEN text_pixels > 0 THEN 'fill' ELSE 'noop_no_text' END AS strategy FROM n JOIN c ON n.img = c.img"""
)
def page_redacted(spark, d):
    """A box of each raster overwritten with what lies below it: the window is too small for rules, so all ink in it is text."""

    def work(g: np.ndarray) -> dict:
        image = _rgb(g).copy()
        s = pages.redact(image, (2, 2, 6, 5), tophat_over=255, v_least=15)
        return {"text_pixels": s["text_pixels"], "inside": int(image[2:5, 2:6, 0].astype(int).sum()), "strategy": s["strategy"]}

    return per_raster(spark, d, "text_pixels bigint, inside bigint, strategy string", work)


@query(f"WITH {PX} SELECT img, sum(CASE WHEN (x BETWEEN 1 AND 4 AND y BETWEEN 1 AND 3) OR (x >= 6 AND y >= 6) OR (x BETWEEN 4 AND 5 AND y >= 4) THEN 255 ELSE v END)::BIGINT AS total, 3::INTEGER AS drawn FROM px GROUP BY img")
def page_whitened(spark, d):
    def work(g: np.ndarray) -> dict:
        image = _rgb(g).copy()
        n = pages.whiten(image, [(2, 2, 4, 3), (7, 7, 20, 20), (5, 5, 5, 9)], 1)
        return {"total": int(image[:, :, 0].astype(int).sum()), "drawn": n}

    return per_raster(spark, d, "total bigint, drawn int", work)


@query(f"WITH {FG} SELECT img, sum(CASE WHEN fg = 1 THEN round_even((1 - 0.55::DOUBLE) * v + 0.55::DOUBLE * 255, 0) ELSE v END)::BIGINT AS red, sum(CASE WHEN fg = 1 THEN round_even((1 - 0.55::DOUBLE) * v, 0) ELSE v END)::BIGINT AS green FROM fg GROUP BY img")
def page_overlay(spark, d):
    def work(g: np.ndarray) -> dict:
        out = pages.overlay(_rgb(g), [(g <= pages.otsu(g), pages.COLORS["text"])]).astype(int)
        return {"red": int(out[:, :, 0].sum()), "green": int(out[:, :, 1].sum())}

    return per_raster(spark, d, "red bigint, green bigint", work)


@query(
    f"""WITH {PX}, {_sql_line("px", "a", "v", "one", "y", 1, "min", "max")} SELECT img, sum(one)::BIGINT AS opened FROM a GROUP BY img"""
)
def page_wear(spark, d):
    """An opening along y with a kernel of three rows."""
    return per_raster(spark, d, "opened bigint", lambda g: {"opened": int(pages.degrade(g, open_=(3, 1)).astype(int).sum())})


@query(f"WITH {PX} SELECT img, 0 AS page, 8 AS h, 8 AS w, sum(v)::BIGINT AS total FROM px GROUP BY img")
def scanned_pdf_pages(spark, d):
    """Rasters as image PDFs, read back."""
    from quire.pdf.forms import image_pages

    made = per_raster(spark, d, "content binary", lambda g: {"content": image_pages([_rgb(g)])})
    rows = pdf.scanned_pages(made.select(F.concat(F.lit("/in/"), F.col("img").cast("string"), F.lit(".pdf")).alias("path"), "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = [int(np.frombuffer(x, np.uint8).astype(int).sum()) // 3 for x in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(list(map(int, b.column(0).to_pylist())), pa.int64()), *(b.column(i) for i in (1, 2, 3)), pa.array(total, pa.int64())], names=["img", "page", "h", "w", "total"])

    return rows.select("doc_id", "page", "h", "w", "data").mapInArrow(run, "img bigint, page int, h int, w int, total bigint")
