"""Expressions over a document's array of fields; all of them stay inside the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import stripped
from quire.schema import DOCUMENT, check_columns


def has_response(role: Column, value: Column, strip: bool = False) -> Column:
    """An answer with a value; strip: blanks alone are none."""
    return (role == "answer") & (F.length(stripped(value) if strip else value) > 0)


def responses(fields: Column, strip: bool = False) -> Column:
    return F.filter(fields, lambda f: has_response(f["role"], f["value"], strip))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def last_wins_map(entries: Column) -> Column:
    """A map from an array of (key, value) structs; of equal keys the last counts.  Two sorts, no search."""
    placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value"))))
    last = _let(placed, lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i + 1)["key"] != e["key"], F.lit(True))))
    in_order = F.array_sort(F.transform(last, lambda e: F.struct(e["i"].alias("i"), e["key"].alias("key"), e["value"].alias("value"))))
    return F.map_from_entries(F.transform(in_order, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))


def payload_rows(flat: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """The payload as rows: of the answers with one field_id the last value by order; combined before the shuffle."""
    answers = flat.where(has_response(F.col("role"), F.col("value")))
    return answers.groupBy(*by, F.col("field_id").alias("k")).agg(F.max_by("value", order).alias("v"))


def gt_payload(fields: Column, strip: bool = False) -> Column:
    return last_wins_map(F.transform(responses(fields, strip), lambda f: F.struct(f["field_id"].alias("key"), f["value"].alias("value"))))


def share(fields: Column, test) -> Column:
    """Share of the fields that pass; null without fields."""
    return F.size(F.filter(fields, test)) / F.nullif(F.size(fields), F.lit(0))


def quality_score(fields: Column) -> Column:
    """Mean of fill rate and box coverage, 0 without fields."""
    from quire.functions.boxes import in_unit_square

    filled = share(fields, lambda f: has_response(f["role"], f["value"]))
    boxed = share(fields, lambda f: in_unit_square(f["bbox_norm"]))
    return F.coalesce((filled + boxed) / 2, F.lit(0.0))


def with_derived(docs: DataFrame) -> DataFrame:
    return docs.withColumn("gt_payload", gt_payload(F.col("fields")))


def legacy_record(docs: DataFrame) -> DataFrame:
    """The older record: what derives from it is stored in it, and values of blanks alone are none."""
    flagged = F.transform("fields", lambda f: f.withField("has_response", F.coalesce(has_response(f["role"], f["value"], strip=True), F.lit(False))))
    return docs.withColumns({"gt_payload": gt_payload(F.col("fields"), strip=True), "fields": flagged})


def without_derived(docs: DataFrame) -> DataFrame:
    check_columns(docs.columns)
    return docs.select(*[c for c in DOCUMENT.names if c in docs.columns])


def nullable(value: Column) -> Column:
    """Empty strings and the text of a missing number are null."""
    return F.when(~F.lower(value).isin("", "nan", "none"), value)


def master_row(docs: DataFrame) -> DataFrame:
    """The flat row of each document."""
    fields = F.col("fields")
    return docs.select(
        "source", "doc_id", "image_path", "pdf_path", "page_count", "quality_tier", "quality_score", "language", "doc_class", "split",
        F.col("pdf_path").isNotNull().alias("has_pdf"), F.size(fields).alias("field_count"), F.size(responses(fields)).alias("response_field_count"),
        F.to_json(gt_payload(fields)).alias("gt_payload_json"),
    )


def manifest_entry(docs: DataFrame) -> DataFrame:
    """docs: source, doc_id, pdf_path, image_path, category, subdir, page_count, text_char_count, widget_count, subtype."""
    return docs.select(
        F.col("doc_id").alias("id"), "category", "source", "doc_id", F.col("pdf_path").alias("pdf"), F.when(F.col("pdf_path").isNull(), F.col("image_path")).alias("image"),
        F.format_string("%s/%s.fields.json", "subdir", "doc_id").alias("fields_json"), "subtype", "page_count", "text_char_count", "widget_count",
    )


def flat(docs: DataFrame) -> DataFrame:
    """A row for each field with its place; order carries meaning."""
    return docs.select("source", "doc_id", F.posexplode("fields").alias("pos", "f")).select("source", "doc_id", "pos", "f.*")


def nested(fields: DataFrame) -> DataFrame:
    """The inverse of flat: fields in order of pos."""
    names = [c for c in fields.columns if c not in ("source", "doc_id", "pos")]
    packed = F.array_sort(F.collect_list(F.struct("pos", F.struct(*names).alias("f"))))
    return fields.groupBy("source", "doc_id").agg(F.transform(packed, lambda x: x["f"]).alias("fields"))


LANES = ("content_stream", "widget", "image")


def labels(docs: DataFrame, lane: str) -> DataFrame:
    """The answer key: one row for each field that the lane takes; docs needs page_count and fields."""
    from quire.functions import boxes

    rows = docs.select("source", "doc_id", "page_count", F.posexplode("fields").alias("pos", "f"))
    f = F.col("f")
    kept = {
        "content_stream": boxes.redactable(f) & f["page"].between(0, F.col("page_count") - 1),
        "widget": has_response(f["role"], f["value"]),
        "image": f["role"] == "answer",
    }[lane]
    kind = {"content_stream": F.lit("text"), "widget": F.lit("acroform"), "image": F.lit(None).cast("string")}[lane]
    return rows.where(kept).select(
        F.lit(lane).alias("lane"), "source", "doc_id", "page_count", "pos", f["field_id"].alias("field_id"), f["label"].alias("label"), f["page"].alias("page"),
        f["bbox_norm"].alias("bbox_norm"), f["value"].alias("expected_value"), kind.alias("field_type"),
    )
