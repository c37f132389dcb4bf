"""Page rasters: kernels against plain loops, erasure, dotted lines, sinks, sources."""

import json

import numpy as np
import pytest
from quire.operators import pages as P
from quire.pdf.forms import page_image
from quire.pdf.objects import Pdf
from quire.operators import raster
from quire.sources import files, sinks


def page(h=80, w=120, paper=250):
    return np.full((h, w, 3), paper, np.uint8)


def glyph(image, y, x, ink=30):
    image[y : y + 8, x : x + 2] = ink
    image[y + 3 : y + 5, x : x + 6] = ink


@pytest.mark.parametrize("axis", [0, 1])
@pytest.mark.parametrize("half", [0, 1, 3, 7, 40])
def test_morphology_equals_plain_loops(axis, half):
    a = np.random.default_rng(half).integers(0, 256, (9, 13), dtype=np.uint8)
    for f, pick in ((P.erode, min), (P.dilate, max)):
        want = np.array([[pick((a[max(0, y - half) : y + half + 1, x] if axis == 0 else a[y, max(0, x - half) : x + half + 1]).tolist()) for x in range(13)] for y in range(9)])
        assert (f(a, axis, half) == want).all()


def test_labels_equal_flood_fill():
    for seed in range(20):
        m = np.random.default_rng(seed).random((12, 17)) < 0.4
        got, n = P.label(m)
        seen = np.zeros_like(got)
        k = 0
        for y, x in zip(*np.nonzero(m), strict=True):
            if not seen[y, x]:
                k += 1
                todo = [(y, x)]
                seen[y, x] = k
                while todo:
                    a, b = todo.pop()
                    for c in range(max(0, a - 1), min(12, a + 2)):
                        for d in range(max(0, b - 1), min(17, b + 2)):
                            if m[c, d] and not seen[c, d]:
                                seen[c, d] = k
                                todo.append((c, d))
        assert n == k and (got == seen).all()


def test_rules_and_text():
    image = page(30, 120)
    image[25] = 30
    glyph(image, 8, 20)
    glyph(image, 8, 60)
    m = P.classify(image, 20)
    assert m.h_rules[25].all() and not m.text[25].any() and m.text[8:16, 20:26].any()
    assert not (m.text & (m.h_rules | m.v_rules)).any()


@pytest.mark.parametrize("ink", [30, 130])
def test_dividers(ink):
    image = page(80, 80)
    image[:, 39] = ink
    for y in (10, 40):
        glyph(image, y, 10)
    m = P.classify(image, 30)
    assert m.v_rules[:, 39].mean() > 0.9 and not m.text[:, 39].any()


def test_blank_and_empty_windows():
    assert not P.classify(page(), 20).text.any() and P.classify(page(0, 0), 5).text.size == 0
    assert P.redact(page(), (10, 10, 5, 5))["strategy"] == "noop_no_text"


def test_redact_keeps_rules_and_outside():
    image = page()
    image[40] = 30
    for y, x in ((26, 30), (26, 44), (60, 30)):
        glyph(image, y, x)
    before = image.copy()
    s = P.redact(image, (20, 20, 100, 45))
    assert s["strategy"] == "fill" and s["text_components"] == 2 and (image[26:34, 30:50] == 250).all() and (image[40] == 30).all()
    outside = np.ones(image.shape[:2], bool)
    outside[20:45, 20:100] = False
    assert (image[outside] == before[outside]).all()


def dots(image, y, xs, r=2, ink=40):
    yy, xx = np.mgrid[: image.shape[0], : image.shape[1]]
    for x in xs:
        image[(yy - y) ** 2 + (xx - x) ** 2 <= r * r] = ink


def test_touch_up_fills_gaps_inside_only():
    image = page(200, 400)
    rows = range(20, 200, 30)
    for y in rows:
        dots(image, y, [x for x in range(20, 380, 8) if not 150 < x < 200])
    assert P.touch_up(image.copy(), [(140, 10, 210, 30)], least_lines=10).notes == ["below_dotted_threshold:6<10"]
    t = P.touch_up(image, [(140, 10, 210, 30)])
    assert t.dots == 6 and t.clusters == 6 and any(n.startswith("outside_erased_region") for n in t.notes)
    _, lines, _ = P.dotted_lines(P.gray_of(image) < 128, tolerant=True)
    assert np.diff(lines[0].xs).max() < 8 * 1.3 and np.diff(lines[1].xs).max() > 40


def test_rejected_bands():
    m = np.zeros((40, 100), bool)
    m[5, [5, 9, 13, 17]] = True
    m[20, [5, 10, 40, 90]] = True
    m[30, [5, 30]] = True
    assert [r.split(":")[0] for r in P.dotted_lines(m)[2]] == ["too_narrow", "spacing_irregular", "too_few_dots"]


def test_background_votes():
    image = page(60, 60)
    image[:20] = 10
    assert P.background(image, (20, 24, 40, 40))[1] == "vertical" and P.background(page(10, 10), (0, 0, 10, 10))[1] == "fallback"


def test_window_form_equals_kernels(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 256, (6, 8, 8))
    df = spark.createDataFrame([(i, [int(v) for v in x.ravel()]) for i, x in enumerate(a)], "img int, e array<int>")
    px = raster.from_array(df, "img", "e", 8, lambda e: e)
    t = {r.img: r.threshold for r in raster.otsu(px).collect()}
    assert t == {i: P.otsu(x.astype(np.uint8)) for i, x in enumerate(a)}
    hat = {(r.img, r.y, r.x): r.h for r in raster.black_tophat(px, "v", "x", 2, "h").collect()}
    for i, x in enumerate(a):
        want = P.closed(x.astype(np.uint8), 1, 2).astype(int) - x
        assert all(hat[i, y, c] == want[y, c] for y in range(8) for c in range(8))


def test_pages_are_blanked_in_order(spark):
    image = page()
    for x in (30, 44):
        glyph(image, 26, x)
    rows = [("d", 0, 80, 120, image.tobytes()), ("d", 1, 80, 120, page().tobytes()), ("e", 0, 80, 120, b"broken")]
    pg = spark.createDataFrame(rows, "doc_id string, page int, h int, w int, data binary")
    f = spark.createDataFrame([("d", 0, 0, "a", 20, 20, 60, 45), ("d", 0, 1, "b", 20, 20, 60, 45)], "doc_id string, page int, pos int, field_id string, x0 int, y0 int, x1 int, y1 int")
    got = {(r.doc_id, r.page): r for r in P.blank_pages(pg, f).collect()}
    assert [s.strategy for s in got["d", 0].stats] == ["fill", "noop_no_text"] and got["e", 0].status == "error" and got["d", 1].redacted == 0
    assert np.frombuffer(got["d", 0].data, np.uint8).min() == 250
    assert {r.doc_id: r.pages for r in P.run_totals(P.blank_pages(pg, f)).collect()} == {"d": 2, "e": 1}


def test_wear_keeps_shape():
    for knobs in P.DEGRADATIONS.values():
        assert P.degrade(page(), **knobs).shape == (80, 120, 3)
    a = page()
    assert P.whiten(a, [(1, 1, 4, 4), (9, 9, 9, 12)]) == 1 and (a[1:4, 1:4] == 255).all()
    assert P.overlay(page(), [(np.ones((80, 120), bool), (255, 0, 0))])[0, 0].tolist() == [253, 112, 112]


def test_image_pdf():
    data = sinks.image_pdf([page(), page(40, 40)], titles=["a", "b"])
    back = Pdf(data)
    assert data.startswith(b"%PDF-1.7") and len(back.pages()) == 2 and "Outlines" in back.root
    assert (page_image(back, back.pages()[0][1]) == page()).all()
    start = int(data.rsplit(b"startxref\n", 1)[1].split(b"\n")[0])
    assert data[start : start + 4] == b"xref"
    with pytest.raises(ValueError, match="needs a page"):
        sinks.image_pdf([])


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    d = {"source": "s", "doc_id": "1", "page_count": 1, "fields": [{"field_id": "a", "value": "v", "role": "answer", "bbox_norm": [0, 0, 1, 1], "page": 0}], "gt_payload": {"old": "x"}}
    (tmp_path / "in/1.json").write_text(json.dumps(d))
    docs = files.field_json(spark, str(tmp_path / "in"))
    sinks.write_documents(docs, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out")).first()
    assert back.gt_payload.asDict() == {"a": "v"} and back.source == "s"
    sinks.write_master(docs, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).first().gt_payload_json == '{"a":"v"}'
    (tmp_path / "in/2.json").write_text(json.dumps(d | {"odd": 1}))
    with pytest.raises(ValueError, match="odd"):
        files.field_json(spark, str(tmp_path / "in"))
    assert files.listing(spark, str(tmp_path / "in"), "*.json", content=True).count() == 2


def test_run_log_keeps_the_last_row(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"doc_id":"a","n":1}\n\n{"n":5}\n{"doc_id":"a","n":2}\n{"doc_id":"b","n":3}\n')
    assert {r.doc_id: r.n for r in files.run_log(spark, str(tmp_path / "r.jsonl")).collect()} == {"a": 2, "b": 3}


def test_manifest_and_sample_records(spark, tmp_path):
    e = spark.createDataFrame([("a", None)], "id string, pdf string")
    m = sinks.manifest(e, "d", {"c": ["x"]}, {"included": 1})
    assert m["documents"] == [{"id": "a", "pdf": None}] and m["version"] == 1 and m["build_stats"] == {"included": 1}
    sinks.put_text(spark, f"file://{tmp_path}/m.json", json.dumps(m))
    assert [r.id for r in files.manifest_documents(spark, f"{tmp_path}/m.json").collect()] == ["a"]
    c = spark.createDataFrame([("s", "b"), ("s", "a")], "source string, doc_id string")
    assert sinks.sample_record(c, 1, 2)["doc_ids"] == ["a", "b"]


def test_run_logs_as_a_stream(spark, tmp_path):
    from quire.streaming import runlog

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"doc_id":"a","status":"ok","at":"2024-01-01T00:00:00Z"}\n{"doc_id":"a","status":"ok","at":"2024-01-01T00:01:00Z"}\n{"doc_id":"b","status":"skipped","at":"2024-01-01T00:02:00Z"}\n')
    rows = runlog.follow(spark, str(tmp_path / "in"), "doc_id string, status string, at timestamp")
    runlog.drain(runlog.first_seen(rows, "doc_id", "at"), str(tmp_path / "out"), str(tmp_path / "c"))
    assert sorted(r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def png(image):
    import struct
    import zlib

    h, w = image.shape[:2]
    kind = {1: 0, 3: 2, 4: 6}[image.shape[2] if image.ndim == 3 else 1]
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + image[y].tobytes() for y in range(h))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def test_images_come_as_rgb(spark, tmp_path):
    rng = np.random.default_rng(1)
    image, grey, alpha = (rng.integers(0, 256, (5, 7, n), dtype=np.uint8) for n in (3, 1, 4))
    for name, data in (("a", png(image)), ("b", b"no image"), ("c", png(grey)), ("d", png(alpha))):
        (tmp_path / f"{name}.png").write_bytes(data)
    got = {r.path[-5]: r for r in files.images(spark, str(tmp_path)).collect()}
    assert set(got) == set("abcd") and got["b"].data is None and "image" in got["b"].error and got["b"].h is None
    for name, want in (("a", image), ("c", np.repeat(grey, 3, 2)), ("d", alpha[:, :, :3])):
        r = got[name]
        assert (r.h, r.w, r.error) == (5, 7, None) and (np.frombuffer(r.data, np.uint8).reshape(5, 7, 3) == want).all(), name


def test_wear_by_profile():
    page = np.full((21, 21), 255, np.uint8)
    page[10, 5:16] = 0
    page[3:18, 10] = 0
    wide, tall = P.degrade(page, close=(1, 9)), P.degrade(page, close=(9, 1))
    assert (wide[10] == page[10]).all() and (wide[0] == 255).all()
    assert (tall[10, 5:10] == 255).all() and tall[10, 10] == 0  # a closing along y takes the thin horizontal stroke only
    dark = np.zeros((9, 9), np.uint8)
    dark[4, 3:6] = 255
    assert not P.degrade(dark, open_=(3, 3)).any() and P.degrade(dark, open_=(1, 3))[4, 4] == 255  # light of less than three rows goes
    assert P.DEGRADATIONS["medium"]["open_"] == (3, 3) and P.DEGRADATIONS["heavy"]["close"] == (9, 1)


def test_overlays(spark):
    image = page(60, 120)
    image[50] = 30
    glyph(image, 20, 40)
    out = P.overlay_classes(image, [(30, 15, 60, 35)])
    assert (out[15, 30:60] == P.COLORS["box"]).all() and (out[20:28, 40:42, 0] > 120).all() and (out[22, 45] != image[22, 45]).any() and (image[15, 30] == 250).all()
    dots = page(60, 120)
    for x in [*range(5, 50, 5), *range(80, 115, 5)]:
        dots[30:32, x : x + 2] = 20
    got = P.overlay_touch_up(dots, [(50, 25, 80, 35)])
    assert (got[25, 50:80] == P.COLORS["erased"]).all() and (got[30:32, 60] == P.COLORS["gap"]).all(1).any()
    both = P.side_by_side(page(50, 100), page(200, 100), height=100)
    assert both.shape == (130, 200 + 20 + 50, 3)
    rows = spark.createDataFrame([("d", 0, 60, 120, image.tobytes()), ("e", 1, 60, 120, b"short")], "doc_id string, page int, h int, w int, data binary")
    f = spark.createDataFrame([("d", 0, 0, "a", 30, 15, 60, 35)], "doc_id string, page int, pos int, field_id string, x0 int, y0 int, x1 int, y1 int")
    got = {r.doc_id: r.data for r in P.overlay_rows(rows, f).collect()}
    assert got["e_p001"] is None and bytes(got["d_p000"]) == sinks.png(out)
    assert {r.doc_id for r in P.overlay_rows(rows, f, touch=True).collect()} == {"d_p000", "e_p001"}
