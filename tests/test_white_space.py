"""White space, forbidden sources and samples as they stand."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quire.functions import text
from quire.operators import corpus, manifest

ODD = ["", " \n\t ", "\x1c\x85 a b ", "　x\n", "​", "a" + " " * 5000 + "b", " ", "a\x0bb\x0c\x1dc\r\nd\n\n \r e", None]


def test_strips_as_python_does(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    for r in df.select("i", text.stripped(F.col("t")).alias("s"), text.lines(F.col("t")).alias("ls")).collect():
        t = ODD[r.i]
        assert r.s == (None if t is None else t.strip())
        assert r.ls == (None if t is None else [x.strip() for x in t.splitlines() if x.strip()])


def test_pages_of_white_space_hold_no_text(spark):
    pages = spark.createDataFrame([("a", "\n\t \n", 0), ("b", "\n x\n", 0), ("c", "  ", 2)], "doc_id string, text string, widget_count int").withColumn("error", F.lit(None).cast("string"))
    got = {r.doc_id: (r.category, r.text_char_count) for r in manifest.profile(pages).collect()}
    assert got == {"a": ("image_only_pdf", 0), "b": ("born_digital_pdf", 1), "c": ("synthetic_acroform", 0)}


@pytest.mark.parametrize("source", ["rvlcdip", "rvlcdip_x", "old_rvlcdip"])
def test_forbidden_sources_fail_whatever_is_asked_for(spark, source):
    docs = spark.createDataFrame([("1", source, "val", "p"), ("2", "ok", "val", "p"), ("3", source, "train", "p"), ("4", source, "val", None)], "doc_id string, source string, split string, pdf_path string")
    files = spark.createDataFrame([("p",), ("q",)], "pdf_path string")
    for ask in (lambda d: d.count(), lambda d: d.select("doc_id").collect(), lambda d: d.agg(F.max("doc_id")).collect()):
        with pytest.raises(PySparkException, match="source may not be loaded"):
            ask(corpus.load(docs, "val", require_gt=False, existing=files))
    # those that other conditions drop do no harm
    assert corpus.load(docs.where("doc_id <> '1'"), "val", require_gt=False, existing=files).count() == 1
    assert corpus.load(docs, "val", require_gt=False, existing=files.where("pdf_path = 'q'")).count() == 0


def test_a_sample_of_all_keeps_the_order(spark):
    docs = spark.range(50).selectExpr("cast(49 - id as string) as doc_id").coalesce(1)
    assert [r.doc_id for r in corpus.sample_uniform(docs, 50, 1).collect()] == [str(49 - i) for i in range(50)]
    assert len({r.doc_id for r in corpus.sample_uniform(docs, 49, 1).collect()}) == 49
