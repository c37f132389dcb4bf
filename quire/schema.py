"""The nested document record and what derives from it."""

from __future__ import annotations

from pyspark.sql import types as T

FIELD = T.StructType(
    [
        T.StructField("field_id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("bbox_norm", T.ArrayType(T.DoubleType())),
        T.StructField("page", T.IntegerType()),
        T.StructField("source_fmt", T.StringType()),
        T.StructField("match_type", T.StringType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("image_path", T.StringType()),
        T.StructField("pdf_path", T.StringType()),
        T.StructField("page_count", T.IntegerType()),
        T.StructField("language", T.StringType()),
        T.StructField("doc_class", T.StringType()),
        T.StructField("fields", T.ArrayType(FIELD)),
        T.StructField("quality_tier", T.StringType()),
        T.StructField("quality_score", T.DoubleType()),
        T.StructField("split", T.StringType()),
    ]
)

#: The closed string sets of the record model.
ROLES = ("question", "answer", "header", "other")
TIERS = ("clean", "degraded", "clean_synthetic", "degraded_synthetic")
SPLITS = ("train", "val", "test")
CATEGORIES = ("born_digital_pdf", "synthetic_acroform", "image_only_pdf", "image_only_png")

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def check_columns(columns: list[str], schema: T.StructType = DOCUMENT, derived: tuple[str, ...] = ("gt_payload",)) -> None:
    """Unknown columns of an input are an error, derived ones are not."""
    unknown = sorted(set(columns) - set(schema.names) - set(derived))
    if unknown:
        raise ValueError(f"unexpected columns: {', '.join(unknown)}")
