"""PDF files: objects, text, widgets, the lanes, combined files."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import pdf as L
from quire.pdf import forms as W
from quire.pdf import text as X
from quire.pdf.objects import Name, Pdf, PdfError, Reader, Stream, write
from quire.sources import sinks, synthetic

FIELDS = [("name", "Name", "Ada Moss", [0.4, 0.2, 0.9, 0.23]), ("town", "Town", "Lund (north)", [0.4, 0.3, 0.9, 0.33])]


def text_file(lines, compress=False, streams=False):
    """A page of (x, y from the top, text) in 12 points; streams: its dictionaries packed in an object stream."""
    body = b"0.5 g 50 50 20 20 re f " + b"".join(b"BT /F 12 Tf 1 0 0 1 %d %d Tm (%s) Tj ET " % (x, 792 - y, t.encode("latin-1").replace(b"(", rb"\(").replace(b")", rb"\)")) for x, y, t in lines)
    raw = zlib.compress(body) if compress else body
    font = b"<</Type/Font/Subtype/Type1/BaseFont/Helvetica/Encoding/WinAnsiEncoding>>"
    objects = {1: b"<</Type/Catalog/Pages 2 0 R>>", 2: b"<</Type/Pages/Kids[3 0 R]/Count 1/MediaBox[0 0 612 792]>>", 3: b"<</Type/Page/Parent 2 0 R/Contents 4 0 R/Resources<</Font<</F 5 0 R>>>>>>", 5: font}
    content = b"<</Length %d%s>>\nstream\n" % (len(raw), b"/Filter/FlateDecode" if compress else b"") + raw + b"\nendstream"
    out = b"%PDF-1.5\n"
    if streams:
        inner, head = b"", b""
        for n, o in objects.items():
            head += b"%d %d " % (n, len(inner))
            inner += o + b" "
        packed = zlib.compress(head + inner)
        out += b"4 0 obj\n" + content + b"\nendobj\n9 0 obj\n<</Type/ObjStm/N 4/First %d/Filter/FlateDecode/Length %d>>stream\n" % (len(head), len(packed)) + packed + b"\nendstream endobj\n"
        return out + b"10 0 obj <</Type/XRef/Root 1 0 R/Size 11/W[1 1 1]/Length 0>>stream\n\nendstream endobj\n"
    for n, o in (objects | {4: content}).items():
        out += b"%d 0 obj\n" % n + o + b"\nendobj\n"
    return out + b"trailer <</Root 1 0 R/Size 6>>\n%%EOF"


def words(data):
    pdf = Pdf(data)
    return [s.text.strip() for _, p in pdf.pages() for s in X.spans(X.glyphs(pdf, p))]


def test_values_round_trip():
    v = {"A": [1, -2.5, True, None, Name("x y#")], "S": b"a(b)\\c\r\n\x00\xff", "D": {"E": b""}}
    assert Reader(write(v)).value() == v
    assert Reader(rb"(a\101\n\(x(y)\
z) <48 6>").value() == b"aA\n(x(y)z"
    assert Reader(b"[1 0 R 2 3 R 4]").value() == [(1,), (2,), 4]


@pytest.mark.parametrize("how", [{}, {"compress": True}, {"streams": True}, {"compress": True, "streams": True}])
def test_files_of_all_kinds_are_read_and_written(how):
    data = text_file([(72, 100, "Name: Ada (M) Moss"), (300, 400, "Größe")], **how)
    assert words(data) == ["Name: Ada (M) Moss", "Größe"] == words(Pdf(data).save())


def test_broken_files_are_errors():
    for bad in (b"", b"no pdf", b"%PDF-1.4 nothing here", b"%PDF-1.4\n1 0 obj <</Type/Catalog>> endobj trailer <</Root 1 0 R/Encrypt 2 0 R>>"):
        with pytest.raises(PdfError):
            Pdf(bad)
    assert Pdf(b"%PDF-1.4\n1 0 obj <</Type/Catalog>> endobj").pages() == []
    loop = Pdf(b"%PDF-1.4\n1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj 2 0 obj <</Type/Pages/Kids[2 0 R 2 0 R]>> endobj")
    assert loop.pages() == []


def test_predictors():
    from quire.pdf.objects import _unpredict

    rng = np.random.default_rng(0)
    image = rng.integers(0, 256, (6, 12), dtype=np.uint8)
    rows, above = [], np.zeros(12, int)
    for y, r in enumerate(image.astype(int)):
        left, corner = np.r_[np.zeros(3, int), r[:-3]], np.r_[np.zeros(3, int), above[:-3]]
        p = left + above - corner
        paeth = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        kind = y % 5
        rows.append(bytes([kind]) + ((r - (0, left, above, (left + above) // 2, paeth)[kind]) % 256).astype(np.uint8).tobytes())
        above = r
    assert _unpredict(b"".join(rows), {"Predictor": 15, "Colors": 3, "Columns": 4}) == image.tobytes()


def test_places_of_glyphs():
    pdf = Pdf(text_file([(72, 100, "AB i")]))
    g = X.glyphs(pdf, pdf.pages()[0][1])
    assert [x.text for x in g] == ["A", "B", " ", "i"] and g[0].x0 == 72 and abs(g[1].x0 - (72 + 0.667 * 12)) < 1e-6 and abs(g[0].base_y - 100) < 1e-6
    assert X.search(g, "b i", (0, 0, 600, 800))[0][:1] == (g[1].x0,) and not X.search(g, "b i", (0, 0, 600, 50))


def test_redaction_takes_glyphs_and_nothing_else():
    content = b"q 0 0 1 RG 10 10 m 90 90 l S Q BT /F 10 Tf 14 TL 1 0 0 1 50 700 Tm [(Na) -50 (me: A) 20 (da)] TJ T* (second) Tj (third) ' 1 2 (fo) \" ET BI /W 1 /H 1 ID xyz EI BT /F 10 Tf 50 600 Td (end) Tj ET"
    pdf = Pdf(text_file([]))
    pdf.objects[4] = Stream({}, content)
    ref, page = pdf.pages()[0]
    before = X.glyphs(pdf, page)
    hit = X.search(before, "Ada", (0, 0, 612, 792))[0]
    assert X.redact(pdf, ref, page, [hit[:4]]) == 3
    after = Pdf(pdf.save())
    page = after.pages()[0][1]
    left = X.glyphs(after, page)
    kept = [g for g in before if not X.inside(g, hit[:4])]
    assert [g.text for g in left] == [g.text for g in kept]
    assert all(abs(a.x0 - b.x0) < 0.01 and abs(a.y0 - b.y0) < 0.01 for a, b in zip(left, kept, strict=True))
    data = after.contents(page)
    assert b"10 10 m 90 90 l S" in data and b"ID xyz EI" in data and b"Ada" not in data


def test_redaction_reaches_into_forms_of_one_page_only():
    pdf = Pdf(text_file([(72, 100, "on the page")]))
    form = pdf.add(Stream({"Type": Name("XObject"), "Subtype": Name("Form"), "BBox": [0, 0, 612, 792], "Matrix": [1, 0, 0, 1, 10, 0], "Resources": pdf.objects[3]["Resources"]}, b"BT /F 12 Tf 72 500 Td (secret) Tj ET"))
    shared = {"Font": {"F": pdf.objects[3]["Resources"]["Font"]["F"]}, "XObject": {"X": form}}
    pdf.objects[3] |= {"Resources": shared, "Contents": pdf.add(Stream({}, b"/X Do"))}
    pdf.add_page({"MediaBox": [0, 0, 612, 792], "Resources": shared, "Contents": pdf.add(Stream({}, b"/X Do"))})
    ref, page = pdf.pages()[0]
    hit = X.search(X.glyphs(pdf, page), "secret", (0, 0, 612, 792))[0]
    assert abs(hit.x0 - 82) < 1e-6 and X.redact(pdf, ref, page, [hit[:4]]) == 6
    assert words(pdf.save()) == ["secret"]


def test_type0_fonts_are_read_by_their_map():
    pdf = Pdf(text_file([]))
    cmap = pdf.add(Stream({}, b"1 beginbfrange <0001> <0003> <0041> endbfrange 1 beginbfchar <0010> <00660069> endbfchar"))
    below = pdf.add({"Type": Name("Font"), "Subtype": Name("CIDFontType2"), "DW": 500, "W": [1, [600, 700], 3, 3, 800]})
    pdf.objects[5] = {"Type": Name("Font"), "Subtype": Name("Type0"), "DescendantFonts": [below], "ToUnicode": cmap, "Encoding": Name("Identity-H")}
    pdf.objects[4] = Stream({}, b"BT /F 10 Tf 0 700 Td <0001000200030010> Tj ET")
    g = X.glyphs(pdf, pdf.pages()[0][1])
    assert [x.text for x in g] == ["A", "B", "C", "fi"] and [round(x.x1 - x.x0, 6) for x in g] == [6, 7, 8, 5]


def test_widgets_are_cleared():
    data = W.form_file("Form", FIELDS)
    pdf = Pdf(data)
    assert {W.widget_name(pdf, w): W.widget_parts(pdf, w)["value"] for _, w in W.widgets(pdf)} == {"name": "Ada Moss", "town": "Lund (north)"}
    assert W.clear_widgets(pdf) == 2 and W.clear_widgets(pdf) == 0
    back = Pdf(pdf.save())
    assert all(v is None for _, w in W.widgets(back) for v in W.widget_parts(back, w).values()) and b"Ada" not in pdf.save()
    light = Pdf(data)
    assert W.blank_widgets(light) == 2 and W.blank_widgets(light) == 0
    parts = [W.widget_parts(light, w) for _, w in W.widgets(light)]
    assert all(p["value"] == "" and p["appearance"] is None and p["background"] for p in parts)


def files(spark, rows):
    return spark.createDataFrame([(f"/in/{n}.pdf", d, len(d)) for n, d in rows], "path string, content binary, length long")


def records(spark, rows):
    """rows: doc_id, category, [(field_id, value, box, page, role)]"""
    f = "array<struct<field_id:string,value:string,bbox_norm:array<double>,page:int,role:string>>"
    data = [(d, c, [{"field_id": i, "value": v, "bbox_norm": b, "page": p, "role": r} for i, v, b, p, r in fs]) for d, c, fs in rows]
    return spark.createDataFrame(data, f"doc_id string, category string, fields {f}")


PAGE = text_file([(72, 100, "Name: Ada Moss"), (72, 130, "Town: Lund"), (72, 145, "near Graz"), (72, 300, "Ada Moss stays here")], compress=True)
BOX = [100 / 612, 85 / 792, 300 / 612, 105 / 792]
ANSWERS = [
    ("a", "Ada Moss", BOX, 0, "answer"), ("b", "Lund\nnear Graz", [70 / 612, 115 / 792, 300 / 612, 150 / 792], 0, "answer"), ("c", "x", [0.0] * 4, 0, "answer"), ("d", "x", BOX, 4, "answer"),
    ("e", "", BOX, 0, "answer"), ("q", "Town", BOX, 0, "question"),
]


def test_blank_files(spark):
    f = files(spark, [("born", PAGE), ("form", W.form_file("Form", FIELDS)), ("bad", b"%PDF-1.4 broken"), ("scan", PAGE)])
    docs = records(spark, [("born", "born_digital_pdf", ANSWERS), ("form", "synthetic_acroform", []), ("bad", "born_digital_pdf", []), ("gone", "born_digital_pdf", []), ("scan", "image_only_pdf", []), ("odd", None, [])])
    got = {r.doc_id: r for r in L.blank_files(f, docs).collect()}
    assert {k: (r.status, r.reason) for k, r in got.items()} == {
        "born": ("ok", None), "form": ("ok", None), "bad": ("error", None), "gone": ("error", None), "scan": ("skipped", "image_only_pdf"), "odd": ("skipped", "unknown_category:null"),
    }
    assert words(bytes(got["born"].data)) == ["Name:", "Town:", "Ada Moss stays here"]
    assert got["born"].redacted_field_count == 2 and [tuple(s) for s in got["born"].skipped_fields] == [("c", "no-bbox-or-empty-value"), ("d", "page-out-of-range"), ("e", "no-bbox-or-empty-value")]
    assert got["form"].cleared_widget_count == 2 and "missing" in got["gone"].error
    # nothing is left in the files: by the same checks that the tables have
    done = files(spark, [(k, bytes(r.data)) for k, r in got.items() if r.data])
    assert L.residual_widgets(L.widget_rows(done)).count() == 0 and L.residual_widgets(L.widget_rows(f)).count() == 2
    sizes = L.page_rows(done).where("error is null").select("doc_id", "page", "page_w", "page_h")
    flat = docs.select("doc_id", F.posexplode("fields").alias("pos", "f")).select("doc_id", "pos", "f.*").where("role = 'answer' and page = 0 and value <> ''").join(sizes, ["doc_id", "page"])
    assert L.residual_text(flat, L.span_rows(done)).count() == 0 and L.residual_text(flat, L.span_rows(f)).count() >= 2


def test_files_without_a_hit_lose_the_whole_box():
    pdf = Pdf(PAGE)
    found = X.glyphs(pdf, pdf.pages()[0][1])
    box = (100, 85, 300, 105)
    assert [t[:4] for t in L.find_targets(found, box, "Other")] == [(98.5, 83.5, 301.5, 106.5)]
    assert len(L.find_targets(found, box, "Ada Moss")) == 1 and L.find_targets(found, box, "Ada Moss")[0].text == "Ada Moss"
    twice = X.glyphs(Pdf(text_file([(72, 100, "no no")])), Pdf(text_file([(72, 100, "no no")])).pages()[0][1])
    assert len(L.find_targets(twice, (0, 0, 600, 200), "no\nyes")) == 2 and len(L.find_targets(twice, (0, 0, 600, 200), "no\nyes", by_line=True)) == 1


def test_profiles_of_files(spark):
    from quire.operators import manifest

    f = files(spark, [("born", PAGE), ("form", W.form_file("", [("a", "", "v", [0.1, 0.1, 0.2, 0.2])])), ("scan", W.image_pages([np.zeros((9, 7, 3), np.uint8)])), ("bad", b"x")])
    got = {r.doc_id: (r.category, r.widget_count, r.error is None) for r in manifest.profile(L.page_rows(f)).collect()}
    assert got == {"born": ("born_digital_pdf", 0, True), "form": ("synthetic_acroform", 1, True), "scan": ("image_only_pdf", 0, True), "bad": ("image_only_pdf", 0, False)}


def test_previews(spark, tmp_path):
    f = files(spark, [("born", PAGE), ("bad", b"x")])
    docs = records(spark, [("born", "born_digital_pdf", ANSWERS), ("bad", "born_digital_pdf", [])])
    out = L.preview_files(f, docs)
    got = {r.doc_id: r for r in out.collect()}
    assert got["bad"].status == "error" and got["born"].recolored_targets == 3 and got["born"].skipped_fields == 4
    pdf = Pdf(bytes(got["born"].data))
    page = pdf.pages()[0][1]
    assert b"0.9 0.1 0.1 rg" in pdf.contents(page)
    for wanted in ("Ada Moss", "Lund", "near Graz", "Ada Moss stays here"):
        assert X.search(X.glyphs(pdf, page), wanted, (0, 0, 612, 792))
    written = sinks.write_files(out, str(tmp_path), "preview.pdf").collect()
    assert [(r.doc_id, r.length) for r in written] == [("born", len(got["born"].data))] and (tmp_path / "born/preview.pdf").read_bytes() == bytes(got["born"].data)


def test_combined_file(spark, monkeypatch):
    f = files(spark, [("a", PAGE), ("b", W.form_file("Form", FIELDS)), ("c", text_file([(72, 100, "third")]))])
    plan = spark.createDataFrame([("c", 0, "c  |  2 clusters"), ("a", 1, None), ("x", 2, "gone"), ("b", 3, "b é")], "doc_id string, ord int, caption string")
    data, said = L.combine(f, plan, "ord")
    assert said == {"included": 3, "missing": ["x"]}
    pdf = Pdf(data)
    pages = pdf.pages()
    text = [[s.text for s in X.spans(X.glyphs(pdf, p))] for _, p in pages]
    assert len(pages) == 3 and text[0] == ["third", "c  |  2 clusters"] and "Ada Moss stays here" in text[1] and text[2][-1] == "b é" and text[2][0] == "Form"
    marks, at = [], pdf.get(pdf.root["Outlines"])["First"]
    while at is not None:
        m = pdf.get(at)
        marks.append((m["Title"], [r for r, _ in pages].index(m["Dest"][0])))
        at = m.get("Next")
    assert marks == [(b"c", 0), (b"a", 1), (b"b", 2)]
    monkeypatch.setattr(L, "COMBINED_BYTES", 10)
    with pytest.raises(ValueError, match="fewer"):
        L.combine(f, plan, "ord")


def test_form_files_hold_their_values(spark):
    docs = synthetic.forms(spark, {"invoice": (3, 2000)})
    want = {r.doc_id: {x.field_id: x.value for x in r.fields} for r in docs.collect()}
    rows = synthetic.form_files(docs).collect()
    got = {}
    for r in rows:
        pdf = Pdf(bytes(r.data))
        got[r.doc_id] = {W.widget_name(pdf, w): W.widget_parts(pdf, w)["value"] for _, w in W.widgets(pdf)}
        w = next(w for _, w in W.widgets(pdf))
        assert re.fullmatch(r"\d+", str(w["F"])) and w["Rect"][1] < w["Rect"][3]
    assert got == want and len(got) == 3


def test_scanned_pages_feed_the_raster_lane(spark):
    from quire.operators import pages as P

    image = np.full((60, 90, 3), 250, np.uint8)
    image[20:28, 30:32] = 20
    f = files(spark, [("scan", W.image_pages([image, image[:, :, :]])), ("text", PAGE)])
    rows = L.scanned_pages(f)
    got = {(r.doc_id, r.page): r for r in rows.collect()}
    assert "rasteriser" in got["text", 0].error and (np.frombuffer(got["scan", 1].data, np.uint8).reshape(60, 90, 3) == image).all()
    boxes = spark.createDataFrame([("scan", 0, 0, "a", 20, 10, 50, 40)], "doc_id string, page int, pos int, field_id string, x0 int, y0 int, x1 int, y1 int")
    blank = P.blank_pages(rows.where("error is null").drop("error"), boxes).where("page = 0").first()
    assert blank.status == "ok" and np.frombuffer(blank.data, np.uint8).min() == 250


def test_light_clearing(spark):
    f = files(spark, [("form", W.form_file("Form", FIELDS)), ("bad", b"x")])
    got = {r.doc_id: r for r in L.blanked_widgets(f).collect()}
    assert got["form"].had_value == 2 and got["bad"].status == "error" and words(bytes(got["form"].data)) == ["Form", "Name", "Town"]


def test_stage_state(spark, tmp_path):
    path = f"{tmp_path}/state.json"
    assert not sinks.stage_done(spark, path, "ingest") and sinks.stage_state(spark, path) == {}
    sinks.mark_stage(spark, path, "ingest", documents=3)
    sinks.mark_stage(spark, path, "order")
    assert sinks.stage_done(spark, path, "ingest") and sinks.stage_state(spark, path)["ingest"]["documents"] == 3 and not sinks.stage_done(spark, path, "split")


def test_commands_for_files(spark, tmp_path, capsys):
    from quire import cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in/born.pdf").write_bytes(PAGE)
    records(spark, [("born", "born_digital_pdf", ANSWERS)]).withColumn("ord", F.lit(0)).withColumn("pages", F.lit(1)).write.parquet(f"{tmp_path}/docs")
    for command, name in (("blank-pdf", "blank.pdf"), ("preview", "preview.pdf")):
        assert cli.main([command, "--files", f"{tmp_path}/in", "--documents", f"{tmp_path}/docs", "--out", f"{tmp_path}/{command}"], spark) == 0
        assert (tmp_path / command / "files/born" / name).is_file()
    spark.createDataFrame([("born", 3, 2, 1, ["n"])], "doc_id string, touch_up_dots int, touch_up_clusters int, touch_up_gaps int, touch_up_notes array<string>").write.json(f"{tmp_path}/log")
    assert cli.main(["combine", "--documents", f"{tmp_path}/docs", "--run-log", f"{tmp_path}/log", "--files", f"{tmp_path}/in", "--out", f"{tmp_path}/all.pdf"], spark) == 0
    assert "born  |  2 clusters  1 gaps  3 dots stamped  |  n" in words((tmp_path / "all.pdf").read_bytes())
    assert '"included": 1' in capsys.readouterr().out


def test_fetching(spark, tmp_path):
    import subprocess
    import zipfile

    from quire.sources import fetch

    (tmp_path / "a.txt").write_text("data")
    url = (tmp_path / "a.txt").as_uri()
    assert fetch.download(url, f"{tmp_path}/in/b.txt") and (tmp_path / "in/b.txt").read_text() == "data"
    assert fetch.download("file:///no/such", f"{tmp_path}/in/b.txt") and not fetch.download("file:///no/such", f"{tmp_path}/in/c.txt") and not fetch.download("no address", f"{tmp_path}/in/c.txt")
    assert sorted(p.name for p in (tmp_path / "in").iterdir()) == ["b.txt"]
    repo = tmp_path / "repo"
    for args in (["init", "-q", str(repo)], ["-C", str(repo), "-c", "user.name=a", "-c", "user.email=a@b", "commit", "-q", "--allow-empty", "-m", "x"]):
        subprocess.run(["git", *args], check=True)
    assert fetch.clone(repo.as_uri(), f"{tmp_path}/copy", ".git") and fetch.clone("file:///no/such", f"{tmp_path}/copy", ".git") and not fetch.clone("file:///no/such", f"{tmp_path}/other")
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips/x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("d/one.txt", "1" * 1000)
        z.writestr("two.txt", "")
    (tmp_path / "zips/bad.zip").write_bytes(b"PK nothing")
    got = {(r.archive[-7:], r.path): (r.length, r.error is None) for r in fetch.unzipped(spark, f"{tmp_path}/zips").collect()}
    assert got == {("s/x.zip", "d/one.txt"): (1000, True), ("s/x.zip", "two.txt"): (0, True), ("bad.zip", None): (None, False)}


def test_page_cache(spark, tmp_path):
    image = np.arange(9 * 7 * 3, dtype=np.uint8).reshape(9, 7, 3)
    f = files(spark, [("scan", W.image_pages([image, image])), ("text", PAGE), ("bad", b"x")])
    rows = L.page_pngs(f)
    first = sinks.write_files(rows, str(tmp_path), "page.png", once=True).collect()
    assert sorted(r.doc_id for r in first) == ["scan_p000", "scan_p001"]
    (tmp_path / "scan_p000/page.png").write_bytes(b"kept")
    again = {r.doc_id: r.length for r in sinks.write_files(rows, str(tmp_path), "page.png", once=True).collect()}
    assert again["scan_p000"] == 4 and (tmp_path / "scan_p001/page.png").read_bytes() == sinks.png(image)


def test_jpeg_scans(spark, tmp_path):
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(16, 24, 1)
    for x in range(16):
        for y in range(24):
            image.setRGB(x, y, 0xC02040 if y < 8 else 0x20A0F0)
    jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(f"{tmp_path}/a.jpg"))
    raw = (tmp_path / "a.jpg").read_bytes()
    pdf = Pdf(W.image_pages([np.zeros((9, 7, 3), np.uint8)]))
    look = pdf.add(Stream({"Type": Name("XObject"), "Subtype": Name("Image"), "Width": 16, "Height": 24, "ColorSpace": Name("DeviceRGB"), "BitsPerComponent": 8, "Filter": Name("DCTDecode")}, raw))
    for n in (look, pdf.add(Stream(dict(pdf.objects[look.n].head), b"no jpeg"))):
        pdf.add_page({"MediaBox": [0, 0, 16, 24], "Resources": {"XObject": {"I": n}}, "Contents": pdf.add(Stream({}, b"16 0 0 24 0 0 cm /I Do"))})
    f = files(spark, [("scan", pdf.save()), ("text", PAGE), ("bad", b"x")])
    got = {(r.doc_id, r.page): r for r in L.page_images(f, f"{tmp_path}/jpegs").collect()}
    assert {k: r.error is None for k, r in got.items()} == {("scan", 0): True, ("scan", 1): True, ("scan", 2): False, ("text", 0): False, ("bad", None): False}
    px = np.frombuffer(got["scan", 1].data, np.uint8).reshape(24, 16, 3).astype(int)
    assert abs(px[2, 3] - (0xC0, 0x20, 0x40)).max() < 12 and abs(px[20, 3] - (0x20, 0xA0, 0xF0)).max() < 12
    assert sorted(r.doc_id for r in L.page_pngs(f, f"{tmp_path}/again").collect()) == ["scan_p000", "scan_p001"]
    assert L.page_images(f.where("path like '%text%'"), f"{tmp_path}/none").count() == 1
