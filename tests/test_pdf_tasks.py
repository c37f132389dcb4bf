"""PDF work is dealt by the number of files, done once, and leaves nothing behind."""

import gc
import weakref

from quire import page_queries
from quire.operators import pdf
from quire.pdf.forms import clear_widgets
from quire.pdf.objects import Pdf

SF = "/root/testdata/sf0.001"


def test_files_are_dealt_by_number(spark, monkeypatch):
    monkeypatch.setattr(pdf, "FILES_A_TASK", 50)
    files, docs = page_queries.label_pdfs(spark, SF), page_queries._lane_docs(spark, SF)
    n = docs.count()
    assert files.rdd.getNumPartitions() == n // 50 + 1
    sizes = pdf._with_fields(files, docs).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == n and len(sizes) == n // 50 + 1 and max(sizes) < 100


def test_widgets_are_read_once(spark):
    assert "InArrow" not in page_queries.pdf_widgets(spark, SF)._jdf.queryExecution().toString()


def test_a_file_goes_without_the_garbage_collector():
    file = Pdf(page_queries._text_pdf(["a"]))
    gone = weakref.ref(file)
    gc.disable()
    try:
        clear_widgets(file)
        assert len(file.pages()) == 1
        del file
        assert gone() is None
    finally:
        gc.enable()
