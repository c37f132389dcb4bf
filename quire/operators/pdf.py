"""PDF lanes: what to redact and what was missed as joins over spans and widgets, and the lanes over files themselves.

Files come as rows (path, content), as Spark's binaryFile source gives them; each is opened in the task that holds it,
and a file that can not be read is a row with an error, not a failed job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.boxes import skip_reason, to_page
from quire.functions.fields import has_response
from quire.functions.text import lines as value_lines
from quire.pdf.forms import blank_widgets, clear_widgets, widget_name, widget_parts, widgets
from quire.pdf.objects import Pdf, Ref
from quire.pdf.text import Glyph, Span, glyphs, put_text, redact, search, spans

#: Points that a field's box, and a hit in it, are widened by.
PAD, GROW = 1.5, 0.5
RED = (0.9, 0.1, 0.1)
#: Errors that broken files cause.
BROKEN = (ValueError, TypeError, KeyError, IndexError, AttributeError, EOFError, ArithmeticError, RecursionError)


def targets(fields: DataFrame, text_spans: DataFrame, pad: float = PAD, grow: float = GROW, complete_by: str = "hits") -> DataFrame:
    """Rectangles to redact for each field.

    fields: doc_id, pos, page, value, bbox_norm, page_w, page_h; text_spans: doc_id, page, x0, y0, x1, y1, text.
    A value's lines are looked for in the spans inside the padded box.  If there are as many hits as lines
    (complete_by 'hits'), or every line has one ('lines'), the hits are the targets, else the whole box is.
    """
    area = fields.withColumn("area", to_page(F.col("bbox_norm"), F.col("page_w"), F.col("page_h"), pad)).withColumn("lines", value_lines(F.col("value")))
    a, s = area.alias("a"), text_spans.withColumnsRenamed({"doc_id": "__d", "page": "__p"}).alias("s")
    r = F.col("a.area")
    within = (F.col("s.x0") >= r["x0"]) & (F.col("s.x1") <= r["x1"]) & (F.col("s.y0") >= r["y0"]) & (F.col("s.y1") <= r["y1"])
    found = a.join(s, (F.col("a.doc_id") == F.col("__d")) & (F.col("a.page") == F.col("__p")) & within, "left")
    lines = F.filter("lines", lambda v: F.contains(F.col("text"), v))
    rows = found.select("doc_id", "pos", "page", "area", F.size("lines").alias("n_lines"), F.when(F.col("text").isNotNull(), lines).alias("m"), *(F.col(f"s.{c}").alias(c) for c in ("x0", "y0", "x1", "y1")))
    hit = F.when(F.size("m") > 0, F.struct((F.col("x0") - grow).alias("x0"), (F.col("y0") - grow).alias("y0"), (F.col("x1") + grow).alias("x1"), (F.col("y1") + grow).alias("y1")))
    g = rows.groupBy("doc_id", "pos", "page", "area", "n_lines").agg(F.array_sort(F.collect_list(hit)).alias("hits"), F.array_distinct(F.flatten(F.collect_list("m"))).alias("matched"))
    full = (F.size("hits") if complete_by == "hits" else F.size("matched")) >= F.col("n_lines")
    return g.withColumn("complete", full & (F.col("n_lines") > 0)).select("doc_id", "pos", "page", "complete", F.explode(F.when(F.col("complete"), F.col("hits")).otherwise(F.array("area"))).alias("rect"))


def skipped_fields(docs: DataFrame) -> DataFrame:
    """docs: doc_id, page_count, fields.  Answers that can not be redacted, with the reason."""
    rows = docs.select("doc_id", "page_count", F.posexplode("fields").alias("pos", "f")).where("f.role = 'answer'")
    return rows.withColumn("reason", skip_reason(F.col("f"), F.col("page_count"))).where("reason is not null").select("doc_id", "pos", F.col("f.field_id").alias("field_id"), "reason")


def residual_text(fields: DataFrame, text_spans: DataFrame, pad: float = PAD) -> DataFrame:
    """Fields of which a line still stands in the text of their padded box."""
    area = fields.withColumn("area", to_page(F.col("bbox_norm"), F.col("page_w"), F.col("page_h"), pad)).withColumn("line", F.explode(value_lines(F.col("value"))))
    s = text_spans.withColumnsRenamed({"doc_id": "__d", "page": "__p"})
    r = F.col("area")
    touch = (F.col("x0") < r["x1"]) & (F.col("x1") > r["x0"]) & (F.col("y0") < r["y1"]) & (F.col("y1") > r["y0"])
    left = area.join(s, (F.col("doc_id") == F.col("__d")) & (F.col("page") == F.col("__p")) & touch & F.contains(F.col("text"), F.col("line")), "left_semi")
    return left.groupBy("doc_id", "pos").agg(F.collect_set("line").alias("lines"))


def cleared_widgets(widgets: DataFrame) -> DataFrame:
    """widgets: doc_id, name, value, default_value, appearance, background.  Their cleared form and whether anything was there."""
    had = (F.length(F.coalesce("value", F.lit(""))) > 0) | F.col("default_value").isNotNull() | F.col("appearance").isNotNull() | F.col("background").isNotNull()
    blank = F.lit(None).cast("string")
    return widgets.withColumn("changed", had).withColumns({c: blank for c in ("default_value", "appearance", "background")}).withColumn("value", F.lit(""))


def residual_widgets(widgets: DataFrame) -> DataFrame:
    left = F.array_compact(F.array(*(F.when(F.length(F.coalesce(c, F.lit(""))) > 0, F.lit(c)) for c in ("value", "default_value", "appearance", "background"))))
    return widgets.withColumn("left", left).where(F.size("left") > 0).select("doc_id", "name", "left")


def dispatch(category: Column) -> Column:
    """The lane of a category, or why there is none."""
    return (
        F.when(category == "born_digital_pdf", "content-stream").when(category == "synthetic_acroform", "widget")
        .when(category.startswith("image_only"), F.concat(F.lit("skipped:"), category)).otherwise(F.concat(F.lit("skipped:unknown_category:"), F.coalesce(category, F.lit("null"))))
    )


def legacy_skip(field_count: Column, source: Column, pdf_path: Column, pdf_found: Column, image_path: Column, images_found: Column) -> Column:
    """The first reason to skip a document, null if none holds."""
    form = source.startswith("synthetic_")
    return (
        F.when(F.coalesce(field_count, F.lit(0)) == 0, "no annotations").when(form & pdf_path.isNull(), "no pdf path").when(form & ~pdf_found, "pdf not found")
        .when(~form & image_path.isNull(), "no image path").when(~form & (images_found == 0), "no images found")
    )


def _documents(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?i)\.pdf$", "")


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


#: Files that one task works on, about.
FILES_A_TASK = 1000
#: Rows, and bytes of text and files in them, that are handed on at a time, about.
TOGETHER, TOGETHER_BYTES = 256, 1 << 20


def _per_file(rows: DataFrame, ddl: str, work: Callable[[dict], list[dict]]) -> DataFrame:
    """work on each row; what it gives, and a row with an error where it can not."""
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done, size = [], 0
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                try:
                    out = work(row)
                except BROKEN as e:
                    out = [{"doc_id": row["doc_id"], "status": "error", "error": f"{type(e).__name__}: {e}"}]
                done += out
                size += sum(len(v) for r in out for v in r.values() if isinstance(v, (bytes, str)))
                if done and (len(done) >= TOGETHER or size >= TOGETHER_BYTES):
                    yield pa.RecordBatch.from_pylist(done, schema=schema)
                    done, size = [], 0
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)

    return rows.mapInArrow(run, ddl)


def page_rows(files: DataFrame) -> DataFrame:
    """What profile() needs of each page: doc_id, page, text, widget_count, page_w, page_h, error."""

    def work(row: dict) -> list[dict]:
        pdf = Pdf(row["content"])
        count: dict[int, int] = {}
        for i, _ in widgets(pdf):
            count[i] = count.get(i, 0) + 1
        out = []
        for i, (_, page) in enumerate(pdf.pages()):
            x0, y0, x1, y1 = pdf.media_box(page)
            out.append({"doc_id": row["doc_id"], "page": i, "text": "\n".join(s.text for s in spans(glyphs(pdf, page))), "widget_count": count.get(i, 0), "page_w": x1 - x0, "page_h": y1 - y0})
        return out

    return _per_file(files.select(_documents(F.col("path")).alias("doc_id"), "content"), "doc_id string, page int, text string, widget_count int, page_w double, page_h double, error string", work)


def span_rows(files: DataFrame) -> DataFrame:
    """The text of each page as targets() and residual_text() take it: doc_id, page, x0, y0, x1, y1, text, size."""

    def work(row: dict) -> list[dict]:
        pdf = Pdf(row["content"])
        return [{"doc_id": row["doc_id"], "page": i, **dict(zip(s._fields, s, strict=True))} for i, (_, page) in enumerate(pdf.pages()) for s in spans(glyphs(pdf, page))]

    rows = _per_file(files.select(_documents(F.col("path")).alias("doc_id"), "content"), "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, text string, size double, error string", work)
    return rows.where("error is null").drop("error")


def widget_rows(files: DataFrame) -> DataFrame:
    """The widgets as residual_widgets() takes them: doc_id, page, name, value, default_value, appearance, background."""

    def work(row: dict) -> list[dict]:
        pdf = Pdf(row["content"])
        return [{"doc_id": row["doc_id"], "page": i, "name": widget_name(pdf, w), **widget_parts(pdf, w)} for i, w in widgets(pdf)]

    ddl = "doc_id string, page int, name string, value string, default_value string, appearance string, background string, error string"
    return _per_file(files.select(_documents(F.col("path")).alias("doc_id"), "content"), ddl, work).where("error is null").drop("error")


def _lines(value: str) -> list[str]:
    return [s for v in re.split(r"\r?\n", value) if (s := v.strip())]


def _grown(box: tuple[float, ...], by: float) -> tuple[float, float, float, float]:
    return box[0] - by, box[1] - by, box[2] + by, box[3] + by


def find_targets(found: list[Glyph], box: tuple[float, ...], value: str, by_line: bool = False) -> list[Span]:
    """Where a value's lines stand in its widened box; the whole box if some do not.  by_line: a line counts once however often it is there."""
    area, lines = _grown(box, PAD), _lines(value)
    hits = [search(found, line, area) for line in lines]
    all_ = [s for h in hits for s in h]
    enough = sum(bool(h) for h in hits) if by_line else len(all_)
    if all_ and enough >= len(lines):
        return [s._replace(x0=a, y0=b, x1=c, y1=d) for s in all_ for a, b, c, d in [_grown(s[:4], GROW)]]
    first = next((g for g in found if area[0] <= g.x0 <= area[2] and area[1] <= (g.y0 + g.y1) / 2 <= area[3]), None)
    size, x, y = (first.size, first.base_x, first.base_y) if first else (10.0, area[0], area[3])
    return [Span(*area, " ".join(lines), size, x, y)]


def _answers(row: dict, pages: int) -> tuple[list[dict], list[dict]]:
    """(fields that can be found on a page, fields left out with the reason): of answers only."""
    able, skipped = [], []
    for f in row["fields"] or []:
        b = f["bbox_norm"]
        if f["role"] != "answer":
            continue
        if not f["value"] or not b or len(b) != 4 or None in b or not any(b) or b[2] <= b[0] or b[3] <= b[1]:
            skipped.append({"field_id": f["field_id"], "reason": "no-bbox-or-empty-value"})
        elif f["page"] is None or not 0 <= f["page"] < pages:
            skipped.append({"field_id": f["field_id"], "reason": "page-out-of-range"})
        else:
            able.append(f)
    return able, skipped


def _located(pdf: Pdf, pages: list[tuple[Ref, dict]], able: list[dict], by_line: bool) -> dict[int, list[Span]]:
    found: dict[int, list[Glyph]] = {}
    out: dict[int, list[Span]] = {}
    for f in able:
        i = f["page"]
        if i not in found:
            found[i] = glyphs(pdf, pages[i][1])
        x0, y0, x1, y1 = pdf.media_box(pages[i][1])
        b = f["bbox_norm"]
        box = (b[0] * (x1 - x0), b[1] * (y1 - y0), b[2] * (x1 - x0), b[3] * (y1 - y0))
        out.setdefault(i, []).extend(find_targets(found[i], box, f["value"], by_line))
    return out


def _with_fields(files: DataFrame, docs: DataFrame) -> DataFrame:
    """docs: doc_id, category, fields."""
    n = docs.count() // FILES_A_TASK + 1  # files are small and costly, so parts of so many rows, not bytes
    contents = files.select(_documents(F.col("path")).alias("doc_id"), "content").repartition(n, "doc_id")
    return docs.select("doc_id", "category", "fields").repartition(n, "doc_id").join(contents, "doc_id", "left").select("doc_id", "category", "fields", "content")


RUN = "doc_id string, approach string, status string, reason string, error string, redacted_field_count int, widget_cleared_count int, cleared_widget_count int, skipped_fields array<struct<field_id:string,reason:string>>, data binary"


def blank_files(files: DataFrame, docs: DataFrame) -> DataFrame:
    """The run of both PDF lanes: a row for each document of docs (doc_id, category, fields) with its blank file in data.

    Born-digital files lose widget values and the glyphs of their answers, forms lose what their widgets show; images
    and unknown categories are skipped, files that are missing or broken are errors.
    """

    def work(row: dict) -> list[dict]:
        category = row["category"]
        if category not in ("born_digital_pdf", "synthetic_acroform"):
            reason = category if (category or "").startswith("image_only") else f"unknown_category:{'null' if category is None else category}"
            return [{"doc_id": row["doc_id"], "approach": f"skipped:{reason}", "status": "skipped", "reason": reason}]
        if row["content"] is None:
            raise ValueError("the file is missing")
        pdf = Pdf(row["content"])
        if category == "synthetic_acroform":
            return [{"doc_id": row["doc_id"], "approach": "widget", "status": "ok", "cleared_widget_count": clear_widgets(pdf), "data": pdf.save()}]
        pages = pdf.pages()
        able, skipped = _answers(row, len(pages))
        cleared = blank_widgets(pdf)
        for i, hits in _located(pdf, pages, able, False).items():
            redact(pdf, *pages[i], [s[:4] for s in hits])
        return [{"doc_id": row["doc_id"], "approach": "content-stream", "status": "ok", "redacted_field_count": len(able), "widget_cleared_count": cleared, "skipped_fields": skipped, "data": pdf.save()}]

    return _per_file(_with_fields(files, docs), RUN, work)


def preview_files(files: DataFrame, docs: DataFrame) -> DataFrame:
    """A file for each document in which its answers are written anew in colour; doc_id, status, error, recolored_targets, skipped_fields, data."""

    def work(row: dict) -> list[dict]:
        if row["content"] is None:
            raise ValueError("the file is missing")
        pdf = Pdf(row["content"])
        pages = pdf.pages()
        able, _ = _answers(row, len(pages))
        located = _located(pdf, pages, able, True)
        for i, hits in located.items():
            redact(pdf, *pages[i], [s[:4] for s in hits])
            put_text(pdf, pages[i][0], [(s.base_x, s.base_y, s.size or 10.0, s.text, RED) for s in hits])
        return [{"doc_id": row["doc_id"], "status": "ok", "recolored_targets": sum(map(len, located.values())), "skipped_fields": len(row["fields"] or []) - len(able), "data": pdf.save()}]

    return _per_file(_with_fields(files, docs), "doc_id string, status string, error string, recolored_targets int, skipped_fields int, data binary", work)


def blanked_widgets(files: DataFrame) -> DataFrame:
    """The lighter clearing before a page is drawn: values empty, appearances gone; doc_id, status, error, had_value, data."""

    def work(row: dict) -> list[dict]:
        pdf = Pdf(row["content"])
        return [{"doc_id": row["doc_id"], "status": "ok", "had_value": blank_widgets(pdf, only_set=True), "data": pdf.save()}]

    return _per_file(files.select(_documents(F.col("path")).alias("doc_id"), "content"), "doc_id string, status string, error string, had_value int, data binary", work)


def scanned_pages(files: DataFrame) -> DataFrame:
    """Pages that are one image, as blank_pages() takes them: doc_id, page, h, w, data; others have an error instead."""
    from quire.pdf.forms import page_image

    def work(row: dict) -> list[dict]:
        pdf, out = Pdf(row["content"]), []
        for i, (_, page) in enumerate(pdf.pages()):
            try:
                image = page_image(pdf, page)
                out.append({"doc_id": row["doc_id"], "page": i, "h": image.shape[0], "w": image.shape[1], "data": image.tobytes()})
            except BROKEN as e:
                out.append({"doc_id": row["doc_id"], "page": i, "error": f"{type(e).__name__}: {e}"})
        return out

    return _per_file(files.select(_documents(F.col("path")).alias("doc_id"), "content"), "doc_id string, page int, h int, w int, data binary, error string", work)


def page_images(files: DataFrame, folder: str) -> DataFrame:
    """As scanned_pages(), with pages that are one JPEG too: those are put below folder (which all share) and decoded by the image source."""
    from quire.pdf.forms import page_jpeg
    from quire.sources.files import images
    from quire.sources.sinks import write_files

    def work(row: dict) -> list[dict]:
        pdf = Pdf(row["content"])
        return [{"doc_id": f"{row['doc_id']}_p{i:06d}", "data": d} for i, (_, page) in enumerate(pdf.pages()) if (d := page_jpeg(pdf, page)) is not None]

    named = files.select(_documents(F.col("path")).alias("doc_id"), "content")
    jpegs = _per_file(named, "doc_id string, data binary, error string", work)
    plain = scanned_pages(files)
    if not write_files(jpegs.where("error is null"), folder, "page.jpg").agg(F.count("*")).first()[0]:
        return plain
    name = F.element_at(F.split("path", "/"), -2)
    found = images(files.sparkSession, folder, nested=True).select(F.regexp_replace(name, r"_p\d{6}$", "").alias("doc_id"), F.right(name, F.lit(6)).cast("int").alias("page"), "h", "w", "data", "error")
    return plain.join(found.select("doc_id", "page"), ["doc_id", "page"], "left_anti").unionByName(found)


def page_pngs(files: DataFrame, folder: str | None = None) -> DataFrame:
    """The pages of scanned_pages(), or with a folder of page_images(), as PNG files: doc_id (with its page), data; pages that need a rasteriser are left out."""
    import numpy as np

    from quire.sources.sinks import png

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            data = [png(np.frombuffer(r["data"], np.uint8).reshape(r["h"], r["w"], 3)) for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    rows = scanned_pages(files) if folder is None else page_images(files, folder)
    named = rows.where("error is null").select(F.format_string("%s_p%03d", "doc_id", "page").alias("doc_id"), "h", "w", "data")
    return named.mapInArrow(run, "doc_id string, data binary")


#: Bytes that one combined file may gather.
COMBINED_BYTES = 1 << 30


def combine(files: DataFrame, plan: DataFrame, order: str) -> tuple[bytes, dict]:
    """One file of the documents of plan (doc_id, caption or null, order column) in order: (bytes, what was included and missing).

    A bookmark leads to each document and its caption stands on its first page.  The file is made in one piece, so
    more than COMBINED_BYTES are an error.
    """
    named = files.select(_documents(F.col("path")).alias("__id"), "content", "length")
    rows = plan.select("doc_id", "caption", F.col(order).alias("__o")).join(named, F.col("doc_id") == F.col("__id"), "left")
    size = rows.agg(F.sum("length")).first()[0] or 0
    if size > COMBINED_BYTES:
        raise ValueError(f"a combined file of {size} bytes: combine fewer documents")
    out, marks, missing, included = Pdf(), [], [], []
    for r in rows.orderBy("__o", "doc_id").toLocalIterator():
        if r.content is None:
            missing.append(r.doc_id)
            continue
        refs = out.take_pages(Pdf(bytes(r.content)))
        included.append(r.doc_id)
        if not refs:
            continue
        marks.append((r.doc_id, refs[0]))
        if r.caption is not None:
            x0, y0, x1, y1 = out.media_box(out.objects[refs[0].n])
            size = max(8.0, (x1 - x0) / 80)
            put_text(out, refs[0], [(4, y1 - y0 - size * 0.5, size, r.caption, (0, 0, 0))], (0, y1 - y0 - size * 1.7, x1 - x0, y1 - y0))
    out.bookmarks(marks)
    return out.save(), {"included": len(included), "missing": missing}


def plan_row(docs: DataFrame) -> DataFrame:
    """What each document's lane will do: docs has doc_id, source, category, fields, page_count.

    Status is planned or skipped; the run log's rows come from the lane that did the work.
    """
    lane = dispatch(F.col("category"))
    answers = F.size(F.filter("fields", lambda f: has_response(f["role"], f["value"])))
    able = F.size(F.filter("fields", lambda f: (f["role"] == "answer") & skip_reason(f, F.col("page_count")).isNull()))
    skip = lane.startswith("skipped")
    return docs.select(
        "doc_id", "source", "category", lane.alias("approach"), F.when(skip, "skipped").otherwise("planned").alias("status"), F.when(skip, F.substring(lane, 9, 200)).alias("reason"),
        F.when(lane == "content-stream", able).alias("redactable_field_count"), F.when(lane == "widget", answers).alias("clearable_field_count"),
    )
