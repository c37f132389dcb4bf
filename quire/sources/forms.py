"""Readers of form corpora, from local exports to the nested record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.boxes import clamp, normalise
from quire.functions.text import stripped, title_label
from quire.operators.corpus import keep_first
from quire.operators.ranges import running
from quire.operators.layout import token_entities
from quire.schema import DOCUMENT, FIELD

FIELD_DDL = FIELD.simpleString()


def field(field_id: Column, label: Column, value: Column, role: Column, box: Column, page: Column, fmt: str, match: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    parts = zip(FIELD.names, (field_id, label, value, role, box, page.cast("int"), F.lit(fmt), none if match is None else match), strict=True)
    return F.struct(*(c.alias(n) for n, c in parts))


def record(df: DataFrame, **columns) -> DataFrame:
    """df with the record's columns; those not named are null."""
    return df.select(*(columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DOCUMENT))


def token_scans(rows: DataFrame, source: str = "funsd", prefixed: bool = True) -> DataFrame:
    """rows: split, id, image_path (null drops the row), width, height, words, bboxes, ner_tags; one page each.

    Arrays are cut to the shortest; runs of one tag kind become fields.  prefixed: ids begin with their split; the older
    reader leaves it out (and keeps legacy_record() of what this gives).
    """
    rows = rows.where("image_path is not null").withColumn("doc_id", F.concat_ws("_", "split", "id") if prefixed else F.col("id"))
    n = F.least(F.size("words"), F.size("bboxes"), F.size("ner_tags"))
    z = F.arrays_zip(F.slice("words", 1, n), F.slice("bboxes", 1, n), F.slice("ner_tags", 1, n))
    b = normalise(F.col("t.1"), F.col("width"), F.col("height"))
    box = F.struct(*(b[i].alias(k) for i, k in enumerate(("x0", "y0", "x1", "y1"))))
    t = rows.select("doc_id", "width", "height", F.posexplode(z).alias("pos", "t")).select("doc_id", "pos", F.col("t.0").alias("word"), box.alias("box"), F.col("t.2").alias("tag"))
    e = token_entities(t)
    f = field(F.concat(F.lit("f"), F.col("entity")), F.when(F.col("role") != "answer", F.col("text")).otherwise(""), F.when(F.col("role") == "answer", F.col("text")).otherwise(""), F.col("role"), F.array("x0", "y0", "x1", "y1"), F.lit(0), "image")
    fields = e.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("entity", f.alias("f")))), lambda x: x["f"]).alias("fields"))
    out = rows.join(fields, "doc_id", "left")
    return record(
        out, source=F.lit(source), doc_id=F.col("doc_id"), image_path=F.col("image_path"), page_count=F.lit(1), language=F.lit("en"), doc_class=F.lit("form"),
        fields=F.coalesce("fields", F.array().cast(f"array<{FIELD_DDL}>")), quality_tier=F.lit("degraded"),
    )


ENTITY_JSON = "documents array<struct<id:string,img:struct<fname:string,width:int,height:int>,document:array<struct<id:bigint,text:string,label:string,box:array<int>>>>>"


def entity_scans(spark: SparkSession, path: str, language: str, images: DataFrame | None = None, root: str = "") -> DataFrame:
    """Nested JSON with one entry for each scan; images (path): the files there are, below the folder root.

    A scan has the file at its name below root, or else, of the files with its base name, the one whose path sorts
    first.  Scans without a file are left out.
    """
    docs = spark.read.option("multiLine", True).schema(ENTITY_JSON).json(path).select(F.explode("documents").alias("d")).select("d.*")
    w, h = (F.coalesce(F.col(f"img.{c}"), F.lit(1)) for c in ("width", "height"))

    def one(x: Column) -> Column:
        role = F.lower(F.coalesce(x["label"], F.lit("other")))
        answer = role == "answer"
        return field(x["id"].cast("string"), F.when(answer, "").otherwise(x["text"]), F.when(answer, x["text"]).otherwise(""), role, normalise(x["box"].cast("array<double>"), w, h), F.lit(0), "image")

    name = F.col("img.fname")
    out = docs.withColumn("fields", F.transform("document", one)).withColumn("fname", name)
    if images is not None:
        out = with_files(out, images, "fname", root).where("image_path is not null")
    else:
        out = out.withColumn("image_path", F.col("fname"))
    return record(
        out, source=F.lit(f"xfund_{language}"), doc_id=F.col("id"), image_path=F.col("image_path"), page_count=F.lit(1), language=F.lit(language), doc_class=F.lit("form"),
        fields=F.col("fields"), quality_tier=F.lit("degraded"),
    )


def with_files(docs: DataFrame, files: DataFrame, name: str, root: str = "") -> DataFrame:
    """docs with image_path: the file (column path) at this name below root, else the first with this base name, else null."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    exact = files.select(F.col("path").alias("__exact")).distinct()
    by_base = files.groupBy(base("path").alias("__base")).agg(F.min("path").alias("__first"))
    whole = F.concat(F.lit(root.rstrip("/") + "/" if root else ""), F.col(name))
    found = docs.join(exact, whole == F.col("__exact"), "left").join(by_base, base(name) == F.col("__base"), "left")
    return found.withColumn("image_path", F.coalesce("__exact", "__first")).drop("__exact", "__base", "__first")


def pdf_lines(spark: SparkSession, path: str, subset_ord: int = 0) -> DataFrame:
    """JSON lines (gz or not) as variants; blank and broken lines are left out; of several files those whose names sort later are later."""
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("n"))
    text = spark.read.text(path).withColumn("line_no", place).where(stripped(F.col("value")) != "")
    return text.withColumn("v", F.try_parse_json("value")).where("v is not null").select("v", F.lit(subset_ord).alias("subset_ord"), "line_no")


def pdf_corpus(lines: DataFrame, source: str, files: DataFrame | None = None, match_types: DataFrame | None = None) -> DataFrame:
    """lines: v, subset_ord, line_no; files: doc_id, pdf_path, content_hash of the PDFs there are; match_types: field_id, match_type.

    Lines without a file are dropped; of files with one content the first line counts, across subsets.
    """
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    name = F.coalesce(get("$.filename", "string"), get("$.doc_id", "string"))
    docs = lines.select("subset_ord", "line_no", "v", F.replace(F.regexp_replace(name, r"\.pdf$", ""), F.lit(" "), F.lit("_")).alias("doc_id"), get("$.page_count", "int").alias("page_count"))
    if files is not None:
        docs = keep_first(docs.join(files, "doc_id"), ["content_hash"], ["subset_ord", "line_no"], F.col("content_hash").isNull())
    else:
        docs = docs.withColumn("pdf_path", F.lit(None).cast("string"))
    a = docs.select("doc_id", F.posexplode(F.try_variant_get("v", "$.annotations", "array<variant>")).alias("i", "a"))
    m = a.select("doc_id", "i", F.try_variant_get("a", "$[0]", "string").alias("field_id"), F.posexplode(F.try_variant_get("a", "$[1]", "array<variant>")).alias("j", "m"))
    place = F.try_variant_get("m", "$[1]", "array<double>")
    m = m.where("field_id is not null").withColumn("value", stripped(F.try_variant_get("m", "$[0]", "string"))).withColumn("b", F.when(F.size(place) == 5, place)).where("value is not null")
    if match_types is not None:
        m = m.join(match_types, "field_id", "left")
    else:
        m = m.withColumn("match_type", F.lit(None).cast("string"))
    box = F.when(F.col("b").isNotNull(), F.array(*(clamp(F.col("b")[k]) for k in (1, 2, 3, 4)))).otherwise(F.array(*[F.lit(0.0)] * 4))
    f = field(F.col("field_id"), title_label(F.col("field_id")), F.col("value"), F.lit("answer"), box, F.coalesce(F.col("b")[0].cast("int"), F.lit(0)), "pdf", F.coalesce("match_type", F.lit("StringMatch")))
    fields = m.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "j", f.alias("f")))), lambda x: x["f"]).alias("fields"))
    return record(
        docs.join(fields, "doc_id", "left"), source=F.lit(source), doc_id=F.col("doc_id"), pdf_path=F.col("pdf_path"), page_count=F.coalesce("page_count", F.lit(1)), language=F.lit("en"), doc_class=F.lit("form"),
        fields=F.coalesce("fields", F.array().cast(f"array<{FIELD_DDL}>")), quality_tier=F.lit("clean"),
    )


def match_types(spark: SparkSession, path: str) -> DataFrame:
    """meta.json: the match type of each field, given as text or inside an object."""
    v = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    kv = v.select(F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("field_id", "m"))
    kind = F.when(F.schema_of_variant("m") == "STRING", F.try_variant_get("m", "$", "string")).when(F.schema_of_variant("m").startswith("OBJECT"), F.coalesce(F.try_variant_get("m", "$.match_type", "string"), F.lit("StringMatch")))
    return kv.select("field_id", kind.alias("match_type")).where("match_type is not null")


def label_scans(images: DataFrame, split: str, order: str = "path") -> DataFrame:
    """Scans without fields; ids count up in order within the split."""
    n = F.col("__before")
    out = running(images.withColumn("__one", F.lit(1)), "__one", order, "__before").drop("__one").withColumn("doc_id", F.concat(F.lit(f"rvlcdip_{split}_"), F.lpad(n.cast("string"), 6, "0")))
    return record(out, source=F.lit("rvlcdip"), doc_id=F.col("doc_id"), image_path=F.col("path"), page_count=F.lit(1), language=F.lit("en"), doc_class=F.lit("invoice"), fields=F.array().cast(f"array<{FIELD_DDL}>"), quality_tier=F.lit("degraded"))


def union_sources(*parts: DataFrame) -> DataFrame:
    """All parts, with the place of each in source_ord."""
    out = parts[0].withColumn("source_ord", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        out = out.unionByName(p.withColumn("source_ord", F.lit(i)))
    return out
