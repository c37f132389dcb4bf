import collections

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quire.functions import boxes, fields, text
from quire.operators import audit, corpus, layout, manifest, pdf, ranges
from quire.plans import corpus_run, release
from quire.schema import DOCUMENT, check_columns
from quire.sources import forms as S
from quire.sources import synthetic


def field(i, value="v", role="answer", box=(0.1, 0.1, 0.2, 0.2), page=0):
    return Row(field_id=i, label=i, value=value, role=role, bbox_norm=None if box is None else list(map(float, box)), page=page, source_fmt="pdf", match_type=None)


def doc(spark, *rows):
    """rows: (source, doc_id, fields, split)"""
    data = [(s, d, None, f"{d}.pdf", 3, "en", "form", list(f), "clean", None, split) for s, d, f, split in rows]
    return spark.createDataFrame(data, DOCUMENT)


def test_last_of_equal_payload_keys_wins(spark):
    d = doc(spark, ("s", "1", [field("a", "1"), field("b", "2"), field("a", "3"), field("c", ""), field("d", "x", "question")], None))
    assert fields.with_derived(d).first().gt_payload == {"a": "3", "b": "2"}


def test_flat_and_nested_are_inverse(spark):
    d = doc(spark, ("s", "1", [field("b"), field("a"), field("a", "2")], None))
    assert fields.nested(fields.flat(d)).first().fields == d.first().fields


def test_quality_score_of_golden_counts(spark):
    """5 of 17 fields filled and all boxed; 15 of 15 filled and 12 boxed; no fields."""
    a = [field(str(i), role="answer" if i < 5 else "question") for i in range(17)]
    b = [field(str(i), box=(0, 0, 0, 0) if i < 3 else (0.1, 0.1, 0.2, 0.2)) for i in range(15)]
    got = {r.doc_id: r.quality_score for r in corpus.score(doc(spark, ("s", "a", a, None), ("s", "b", b, None), ("s", "c", [], None))).collect()}
    assert got == {"a": pytest.approx(0.6470588235294118), "b": pytest.approx(0.9), "c": 0.0}


def test_skip_reasons_and_labels(spark):
    d = doc(spark, ("s", "1", [field("a"), field("b", box=(0, 0, 0, 0)), field("c", ""), field("d", page=7), field("q", role="question")], None))
    assert [(r.field_id, r.reason) for r in pdf.skipped_fields(d).orderBy("pos").collect()] == [("b", "no-bbox-or-empty-value"), ("c", "no-bbox-or-empty-value"), ("d", "page-out-of-range")]
    count = {lane: fields.labels(d, lane).count() for lane in fields.LANES}
    assert count == {"content_stream": 1, "widget": 3, "image": 4}


def test_unknown_columns_are_errors():
    check_columns(["doc_id", "gt_payload"])
    with pytest.raises(ValueError, match="extra"):
        check_columns(["doc_id", "extra"])


def test_null_and_odd_boxes(spark):
    d = spark.createDataFrame([(None,), ([1.0],), ([0.2, 0.2, 0.1, 0.3],), ([-1.0, 0.0, 0.5, 2.0],)], "b array<double>")
    got = d.select(boxes.in_unit_square(F.col("b")), boxes.normalise(F.col("b"), F.lit(1), F.lit(1))).collect()
    assert [bool(r[0]) for r in got] == [False] * 4
    assert [r[1] for r in got] == [[0.0] * 4, [0.0] * 4, [0.2, 0.2, 0.1, 0.3], [0.0, 0.0, 0.5, 1.0]]


@pytest.mark.parametrize(
    ("name", "want"),
    [("Short-Form_Short-Form", "Short-Form"), ("20_Amendment", "Amendment"), ("x_Report_y", "Report"), ("Reporting", None), ("", None), ("a_Statement_Amendment", "Amendment")],
)
def test_subtypes(spark, name, want):
    assert spark.range(1).select(text.subtype(F.lit(name))).first()[0] == want


def test_names(spark):
    row = spark.range(1).select(
        text.title_label(F.lit("gross_amount a-b")), text.source_of_stem(F.lit("vrdu_ad_buy_12"), ["vrdu", "vrdu_ad_buy"]), text.source_of_stem(F.lit("other_1"), ["x"]),
        text.resolve_path(F.lit(""), F.lit("a.png"), base="/data"), text.suffix(F.lit("/x/A.PDF")), fields.nullable(F.lit("nan")),
    ).first()
    assert list(row) == ["Gross Amount A-B", "vrdu_ad_buy", "other", "/data/a.png", ".pdf", None]


def test_page_image_candidates(spark):
    got = spark.range(1).select(*(text.page_image_candidates(F.lit(b), F.lit(p)) for b, p in (("a.png", 0), ("a_p000.png", 2), ("a.png", 12)))).first()
    assert list(got) == [["a.png"], ["a_p002.png"], ["a_p012.png"]]


def test_split_sizes_follow_half_even_rounding(spark):
    n = spark.range(1, 400).select("id", *(c.alias(k) for c, k in zip(corpus.split_counts(F.col("id")), ("a", "v"), strict=True)))
    for r in n.collect():
        a, v = round(r.id * 0.7), round(r.id * 0.15)
        t = r.id - a - v
        if r.id >= 3:
            a, v = a - (v < 1) - (t < 1), max(v, 1)
        assert (r.a, r.v) == (a, v)


def test_samples(spark):
    rows = [("a", f"a{i}") for i in range(800)] + [("b", f"b{i}") for i in range(200)]
    d = spark.createDataFrame(rows, "source string, doc_id string")
    n = {r["source"]: r["n"] for r in manifest.breakdown(manifest.sample(d, 100, 7)).collect()}
    assert n == {"a": 80, "b": 20}
    assert manifest.sample(d, 5000, 7).count() == 1000
    first = {r.doc_id for r in manifest.sample(d, 100, 7).collect()}
    assert first == {r.doc_id for r in manifest.sample(d, 100, 7).collect()} != {r.doc_id for r in manifest.sample(d, 100, 8).collect()}
    gone = spark.createDataFrame([(i,) for i in first], "doc_id string")
    assert not first & {r.doc_id for r in manifest.sample(d, 100, 7, gone).collect()}
    assert manifest.sample(d.where("false"), 5, 1).count() == 0


def test_deduplicate_keeps_unknown_content(spark):
    d = spark.createDataFrame([("s", "1", "h", 0), ("s", "1", "x", 1), ("t", "2", "h", 2), ("t", "3", "", 3), ("t", "4", None, 4), ("t", "5", "", 5)], "source string, doc_id string, content_hash string, o int")
    assert sorted(r.o for r in corpus.deduplicate(d, ["o"]).collect()) == [0, 3, 4, 5]


def test_fingerprint_ignores_order(spark):
    d = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "source string, doc_id string, t string")
    one, two = (corpus.fingerprint(x, ["source", "doc_id"], F.col("t")).first() for x in (d, d.orderBy(F.desc("t"))))
    assert one == two and one.documents == 2
    assert corpus.fingerprint(d.where("t = 'x'"), ["source", "doc_id"], F.col("t")).first() != one


def test_load_refuses_forbidden_sources(spark):
    d = doc(spark, ("rvlcdip", "1", [field("a")], "val"), ("s", "2", [field("a")], "train"))
    assert corpus.load(d, "train").count() == 1
    with pytest.raises(Exception, match="may not be loaded"):
        corpus.load(d, "val").collect()


def test_broken_files_count_twice(spark):
    p = spark.createDataFrame([("a", "text", 0, None), ("b", "", 2, None), ("c", None, None, "boom"), ("d", " ", 0, None)], "doc_id string, text string, widget_count int, error string")
    prof = manifest.profile(p)
    assert {r.doc_id: r.category for r in prof.collect()} == {"a": "born_digital_pdf", "b": "synthetic_acroform", "c": "image_only_pdf", "d": "image_only_pdf"}
    assert {r.category: r.n for r in manifest.category_counts(prof).collect()} == {"born_digital_pdf": 1, "synthetic_acroform": 1, "image_only_pdf": 2, "image_only_png": 0, "error": 1}


def test_bio_tags_become_entities(spark):
    words = [("d", i, w, (float(i), 0.0, i + 1.0, 1.0), t) for i, (w, t) in enumerate([("Name", 3), (":", 4), ("Ada", 5), ("Moss", 6), ("x", 0), ("Bob", 5), ("Cy", 5)])]
    t = spark.createDataFrame(words, "doc_id string, pos int, word string, box struct<x0:double,y0:double,x1:double,y1:double>, tag int")
    got = [(r.entity, r.role, r.text, r.x0, r.x1) for r in layout.token_entities(t).orderBy("entity").collect()]
    assert got == [(0, "question", "Name :", 0.0, 2.0), (1, "answer", "Ada Moss", 2.0, 4.0), (2, "answer", "Bob", 5.0, 6.0), (3, "answer", "Cy", 6.0, 7.0)]


def test_token_scans_cut_to_the_shortest(spark):
    rows = [("train", "1", "p.png", 10, 10, ["a", "b", "c"], [[0.0, 0.0, 5.0, 5.0], [1.0, 1.0, 2.0, 2.0]], [1, 5, 5]), ("train", "2", None, 1, 1, [], [], []), ("test", "3", "q.png", 1, 1, [], [], [])]
    d = S.token_scans(spark.createDataFrame(rows, "split string, id string, image_path string, width int, height int, words array<string>, bboxes array<array<double>>, ner_tags array<int>"))
    got = {r.doc_id: [(f.role, f.value, f.bbox_norm) for f in r.fields] for r in d.collect()}
    assert got == {"train_1": [("header", "", [0.0, 0.0, 0.5, 0.5]), ("answer", "b", [0.1, 0.1, 0.2, 0.2])], "test_3": []}


def test_entity_scans(spark, tmp_path):
    p = tmp_path / "x.json"
    p.write_text('{"documents":[{"id":"de_1","img":{"fname":"a.jpg","width":100,"height":200},"document":[{"id":1,"text":"Q","label":"QUESTION","box":[0,0,50,50]},{"id":2,"text":"A","label":"answer","box":[10,20,300]}]},{"id":"de_2","img":null,"document":[]}]}')
    images = spark.createDataFrame([("/y/a.jpg",), ("/x/a.jpg",)], "path string")
    got = S.entity_scans(spark, str(p), "de", images).collect()
    assert [(r.doc_id, r.source, r.image_path, [(f.role, f.label, f.value) for f in r.fields]) for r in got] == [("de_1", "xfund_de", "/x/a.jpg", [("question", "Q", ""), ("answer", "", "A")])]
    assert got[0].fields[0].bbox_norm == [0.0, 0.0, 0.5, 0.25] and got[0].fields[1].bbox_norm == [0.0] * 4


def test_pdf_corpus(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "d.jsonl.gz", "wt") as f:
        f.write('{"filename":"a b.pdf","page_count":3,"annotations":[["contract_num",[["2418178",[0,0.67,0.08,0.73,0.09]],["x",[1,2]],7]],"bad",["property",[["WLAX",[1,0,0.19,0.06,1.5]]]]]}\n\nnot json\n{"filename":"c.pdf","annotations":[]}\n{"filename":"copy.pdf"}\n{"filename":"gone.pdf"}\n')
    (tmp_path / "meta.json").write_text('{"property":{"match_type":"General"},"contract_num":"Number","z":{"q":1},"n":3}')
    files = spark.createDataFrame([("a_b", "a b.pdf", "h1"), ("c", "c.pdf", "h2"), ("copy", "copy.pdf", "h2")], "doc_id string, pdf_path string, content_hash string")
    types = S.match_types(spark, str(tmp_path / "meta.json"))
    assert {tuple(r) for r in types.collect()} == {("property", "General"), ("contract_num", "Number"), ("z", "StringMatch")}
    got = {r.doc_id: r for r in S.pdf_corpus(S.pdf_lines(spark, str(tmp_path / "d.jsonl.gz")), "vrdu_ad_buy", files, types).collect()}
    assert set(got) == {"a_b", "c"} and got["a_b"].page_count == 3 and got["c"].page_count == 1 and got["c"].fields == []
    assert [(f.field_id, f.label, f.value, f.page, f.bbox_norm, f.match_type) for f in got["a_b"].fields] == [
        ("contract_num", "Contract Num", "2418178", 0, [0.67, 0.08, 0.73, 0.09], "Number"), ("contract_num", "Contract Num", "x", 0, [0.0] * 4, "Number"), ("property", "Property", "WLAX", 1, [0.0, 0.19, 0.06, 1.0], "General"),
    ]


def test_label_scans(spark):
    d = S.label_scans(spark.createDataFrame([("b",), ("a",)], "path string"), "test")
    assert [(r.doc_id, r.image_path, r.fields) for r in d.orderBy("doc_id").collect()] == [("rvlcdip_test_000000", "a", []), ("rvlcdip_test_000001", "b", [])]


def test_redaction_completeness_two_ways(spark):
    """A line hit twice hides a missed line from the count of hits, not from the count of lines."""
    f = spark.createDataFrame([("d", 0, 0, "alpha\nbeta", [0.0, 0.0, 1.0, 1.0], 100.0, 100.0)], "doc_id string, pos int, page int, value string, bbox_norm array<double>, page_w double, page_h double")
    s = spark.createDataFrame([("d", 0, 1.0, 1.0, 5.0, 5.0, "alpha"), ("d", 0, 1.0, 11.0, 5.0, 15.0, "alpha")], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    assert [r.complete for r in pdf.targets(f, s).collect()] == [True, True]
    by_lines = pdf.targets(f, s, complete_by="lines").collect()
    assert [r.complete for r in by_lines] == [False] and by_lines[0].rect.x0 == -1.5
    assert [r.lines for r in pdf.residual_text(f, s).collect()] == [["alpha"]]


def test_widgets(spark):
    w = spark.createDataFrame([("d", "a", "v", None, None, None), ("d", "b", "", None, None, None), ("d", "c", None, "x", "ap", None)], "doc_id string, name string, value string, default_value string, appearance string, background string")
    done = pdf.cleared_widgets(w)
    assert {r.name: r.changed for r in done.collect()} == {"a": True, "b": False, "c": True}
    assert pdf.residual_widgets(done).count() == 0 and pdf.residual_widgets(w).count() == 2


def test_lanes(spark):
    d = doc(spark, ("vrdu_ad_buy", "1", [field("a"), field("b", box=(0, 0, 0, 0))], None), ("funsd", "2", [field("a")], None)).withColumn("category", F.when(F.col("doc_id") == "1", "born_digital_pdf").otherwise("odd"))
    got = {r.doc_id: (r.approach, r.status, r.reason, r.redactable_field_count) for r in pdf.plan_row(d).collect()}
    assert got == {"1": ("content-stream", "planned", None, 1), "2": ("skipped:unknown_category:odd", "skipped", "unknown_category:odd", None)}


def test_review_pages_and_limits(spark):
    d = spark.createDataFrame([("a", 2, 0), ("b", 3, 1), ("c", 1, 2)], "doc_id string, pages int, ord int")
    runs = spark.createDataFrame([("a", 12), ("b", 0), ("c", 5)], "doc_id string, touch_up_dots int")
    assert [(r.doc_id, r.start_page) for r in manifest.review_pages(d, runs, "ord", True).orderBy("ord").collect()] == [("a", 1), ("c", 3)]
    r = spark.createDataFrame([(i, i in (1, 3)) for i in range(6)], "o int, ok boolean")
    assert [x.o for x in manifest.until_successes(r, 2, "o", "ok").orderBy("o").collect()] == [0, 1, 2, 3]


def test_synthetic_forms(spark):
    f = synthetic.forms(spark)
    n = {r["source"]: r["count"] for r in f.groupBy("source").count().collect()}
    assert n == {"synthetic_supplier": 50, "synthetic_invoice": 50, "synthetic_compliance": 30, "synthetic_patient": 30}
    a, b = (sorted(map(str, x.collect())) for x in (f, synthetic.forms(spark).repartition(5)))
    assert a == b
    row = f.where("doc_id = 'synthetic_invoice_02007'").first()
    assert row.split == "val" and len(row.fields) == 7 and all(x.value and 0 <= x.bbox_norm[0] < x.bbox_norm[2] <= 1 and 0 <= x.bbox_norm[1] < x.bbox_norm[3] <= 1 for x in row.fields)
    with pytest.raises(ValueError, match="unknown"):
        synthetic.forms(spark, {"nope": (1, 1)})
    spark.dataSource.register(synthetic.FormSource)
    assert spark.read.format("quire_forms").option("form", "patient").option("count", 3).load().count() == 21


def test_release_plan(spark):
    docs = doc(spark, ("funsd", "train_1", [field("a")], None), ("xfund_fr", "fr_train_70", [field("a")], None), ("vrdu_ad_buy", "v", [field("a")], None))
    prof = spark.createDataFrame([("v", "born_digital_pdf", 1, 5, 0, None)], "doc_id string, category string, page_count long, text_char_count long, widget_count long, error string")
    r = release.plan(docs, prof, release.recipe("forms-blank-beta"))
    assert [x.doc_id for x in r.manifest.collect()] == ["train_1"] and r.stats.first().excluded_dropped == 1 and r.lane.count() == 1
    assert [x.doc_id for x in release.plan(docs, prof, release.recipe("pdf-blank")).manifest.collect()] == ["v"]
    with pytest.raises(KeyError):
        release.recipe("nope")


def test_corpus_run(spark):
    rows = [("vrdu_x", f"{i}", [field("a")] if i % 2 else [], None) for i in range(10)]
    built = corpus_run.build([doc(spark, *rows), doc(spark, ("funsd", "1", [field("a")], None))])
    got = {r.doc_id: r.split for r in built.where("source = 'vrdu_x'").collect()}
    assert all(int(i) % 2 for i, s in got.items() if s != "train") and sorted(got.values()).count("train") == 7
    all_ = corpus_run.with_generated(built, synthetic.forms(spark))
    assert all_.where("endswith(source, '_degraded')").where("split <> 'train'").count() == 0
    assert all_.where("endswith(source, '_degraded')").count() == 3 * synthetic.forms(spark).where("split = 'train'").count()


def test_empty_tables(spark):
    d = doc(spark, ("s", "1", [field("a")], None)).where("false")
    assert corpus.manifest_rollup(d).count() == 0 and audit.dataset_overview(d).count() == 0 and corpus.assign_splits(d, 1).count() == 0
    assert corpus.fingerprint(d, ["source", "doc_id"], F.lit("")).first().documents == 0


def test_cli(spark, tmp_path, capsys):
    import json

    from quire.cli import main

    t = str(tmp_path)
    assert main(["forms", "--out", f"{t}/forms"], spark) == 0
    assert main(["report", "--documents", f"{t}/forms"], spark) == 0
    assert main(["export", "--documents", f"{t}/forms", "--split", "val", "--out", f"{t}/val"], spark) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert said[0] == {"documents": 160} and {"kind": "total", "name": None, "n": 160} in said and said[-1] == {"documents": 16}
    docs = doc(spark, ("vrdu_registration", "1_Amendment", [field("a")], None), ("vrdu_registration", "2_Report", [field("a")], None), ("vrdu_ad_buy", "3", [field("a")], None))
    docs.write.parquet(f"{t}/docs")
    prof = [(i, "born_digital_pdf", 1, 5, 0, None) for i in ("1_Amendment", "2_Report", "3")]
    spark.createDataFrame(prof, "doc_id string, category string, page_count long, text_char_count long, widget_count long, error string").write.parquet(f"{t}/prof")
    assert main(["manifest", "--documents", f"{t}/docs", "--profiles", f"{t}/prof", "--out", t, "--include-subtypes", "Report", "--exclude", "3"], spark) == 0
    m = json.loads((tmp_path / "manifest.json").read_text())
    assert [d["id"] for d in m["documents"]] == ["2_Report"] and m["build_stats"]["excluded_dropped"] == 1
    pages_ = spark.createDataFrame([("d", 0, 40, 40, bytes([250]) * 4800)], "doc_id string, page int, h int, w int, data binary")
    pages_.write.parquet(f"{t}/pages")
    spark.createDataFrame([("d", 0, 0, "a", 1, 1, 9, 9)], "doc_id string, page int, pos int, field_id string, x0 int, y0 int, x1 int, y1 int").write.parquet(f"{t}/fields")
    assert main(["blank", "--pages", f"{t}/pages", "--fields", f"{t}/fields", "--out", f"{t}/b", "--touch-up-dotted-lines"], spark) == 0
    spark.createDataFrame([("d", 2, 0)], "doc_id string, pages int, ord int").write.parquet(f"{t}/order")
    assert main(["combine", "--documents", f"{t}/order", "--run-log", f"{t}/b/run"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["start_page"] == 1
    with pytest.raises(KeyError):
        main(["build", "nope", "--documents", f"{t}/docs", "--profiles", f"{t}/prof", "--out", t], spark)


def test_bands_of_a_hot_group(spark):
    """300,000 points of one user: an array that grows by a copy for each point does not end here."""
    from quire.operators import layout

    hot = spark.range(300_000).selectExpr("1L as u", "id", "(id * 7919 % 200003) / 8d as y")
    few = spark.createDataFrame([(2, 0, 1.0), (2, 1, 3.0), (2, 2, 3.5), (2, 3, None), (None, 4, 9.0)], "u long, id long, y double")
    got = {(r.u, r.id): r.band for r in layout.bands(hot.union(few), ["u"], "y", ["id"], 2.0).collect()}
    assert len(got) == 300_005
    assert [got[2, i] for i in range(4)] == [0, 0, 1, None] and got[None, 4] == 0
    first, band, want = None, -1, {}
    for y, i in sorted((i * 7919 % 200003 / 8, i) for i in range(300_000)):
        if first is None or y - first > 2:
            first, band = y, band + 1
        want[i] = band
    assert all(got[1, i] == b for i, b in want.items())


def test_remainder_draw_follows_what_is_left(spark):
    """Each leftover document has the same chance: the extra draws of many seeds against the law's mean."""
    from quire.operators.manifest import allocation

    pools = {"hot": 2_000_000_000, "a": 2_000_000_003, "b": 400_000_000, "c": 5, "d": 1}
    counts = spark.createDataFrame(list(pools.items()), "source string, pool long").coalesce(1)
    total, n, seeds = sum(pools.values()), 9, 25
    base = {s: n * p // total for s, p in pools.items()}
    rest, extra = n - sum(base.values()), collections.Counter()
    for seed in range(seeds):
        take = {r["source"]: r["take"] for r in allocation(counts, n, seed).collect()}
        assert sum(take.values()) == n and all(base[s] <= take[s] <= pools[s] for s in pools)
        extra.update({s: take[s] - base[s] for s in pools})
    for s, p in pools.items():
        share = (p - base[s]) / (total - sum(base.values()))
        mean, deviation = seeds * rest * share, (seeds * rest * share * (1 - share)) ** 0.5
        assert abs(extra[s] - mean) <= 4 * deviation + 0.01


def test_a_source_may_give_all_of_the_remainder(spark, monkeypatch):
    """More than a source offers at first, and sources that run out."""
    pools = {f"s{i:02d}": 1 for i in range(40)} | {"big": 60}
    counts = spark.createDataFrame(list(pools.items()), "source string, pool long").coalesce(1)
    want = {r["source"]: r["take"] for r in manifest.allocation(counts, 50, 3).collect()}
    assert sum(want.values()) == 50 and want["big"] > 30 and all(want[s] <= 1 for s in pools if s != "big")
    monkeypatch.setattr(manifest, "OFFERED", 2)
    assert {r["source"]: r["take"] for r in manifest.allocation(counts, 50, 3).collect()} == want
    assert {r["source"]: r["take"] for r in manifest.allocation(counts, 100, 3).collect()} == pools


def test_running_sums_over_all_rows(spark):
    import random

    rng = random.Random(3)
    rows = [(f"k{rng.randrange(10**6):06d}{i}", rng.randrange(5)) for i in range(700)] + [(None, 3)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(5)
    got = {r.k: r.before for r in ranges.running(df, "n", "k", "before", cuts=7).collect()}
    so_far, want = 0, {}
    for k, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "")):
        want[k] = so_far
        so_far += n
    assert got == want
    assert ranges.running(df.where("false"), "n", "k", "before").count() == 0
    assert [r.before for r in ranges.running(df.where("k is null"), "n", "k", "before").collect()] == [0]


def test_scans_have_the_file_at_their_name_before_one_of_that_base_name(spark):
    docs = spark.createDataFrame([("1", "b/x.jpg"), ("2", "c/x.jpg"), ("3", "y.jpg"), ("4", "z.jpg")], "id string, fname string")
    images = spark.createDataFrame([("/root/a/x.jpg",), ("/root/b/x.jpg",), ("/root/d/y.jpg",), ("/root/c/y.jpg",)], "path string")
    got = {r.id: r.image_path for r in S.with_files(docs, images, "fname", "/root/").collect()}
    assert got == {"1": "/root/b/x.jpg", "2": "/root/a/x.jpg", "3": "/root/c/y.jpg", "4": None}


def test_long_payloads_are_no_search(spark):
    d = doc(spark, ("s", "1", [field(str(i % 4000), str(i)) for i in range(12_000)], None))
    got = fields.with_derived(d).first().gt_payload
    assert got == {str(i % 4000): str(i) for i in range(8000, 12_000)}


def test_files_in_one_piece_are_bounded(spark, monkeypatch, tmp_path):
    from quire.sources import sinks

    monkeypatch.setattr(sinks, "LISTED", 3)
    ids = spark.range(5).selectExpr("cast(id as string) as doc_id", "'s' as source")
    with pytest.raises(ValueError, match="in parts"):
        sinks.manifest(ids, "", {})
    with pytest.raises(ValueError, match="in parts"):
        sinks.sample_record(ids, 1, 5)
    sinks.write_manifest(ids, f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m").count() == 5 and sinks.sample_record(ids.limit(2), 1, 2)["n_selected"] == 2


def test_values_of_forms_suit_their_kind(spark):
    import re

    assert {n for names in synthetic.FORMS.values() for n in names} == set(synthetic.KIND_OF)
    kinds = {
        "date": r"20\d\d-[01]\d-[0-3]\d", "amount": r"\d+\.\d\d", "email": r"[a-z.]+@[a-z]+\.example", "rate": r"\d+ %", "code": r"[A-Z]{2}\d{7}", "reference": r"\d{4}/\d{6}", "doctor": r"Dr [A-Z]\w+ [A-Z]\w+", "person": r"[A-Z]\w+ [A-Z]\w+", "company": r"[A-Z].* \S+", "address": r"\d+ .+",
    }
    for r in fields.flat(synthetic.forms(spark, {k: (20, 7) for k in synthetic.FORMS})).collect():
        kind = synthetic.KIND_OF[r.field_id]
        assert re.fullmatch(kinds[kind], r.value) if kind in kinds else r.value in synthetic.WORDS[kind], (r.field_id, r.value)


def test_runs_go_on_across_ranges(spark):
    import random

    rng = random.Random(5)
    rows = [(g, i, rng.choice(["a", "a", "a", "b", None]), rng.random() < 0.1) for g, n in (("x", 900), ("y", 3), (None, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, o int, role string, b boolean").repartition(5)
    for begins in (None, F.col("b")):
        got = {(r.g, r.o): r.run for r in layout.runs(df, ["g"], ["o"], "role", begins).collect()}
        want, last, run = {}, (0, None), -1
        for g, o, role, b in rows:
            if o == 0:
                last, run = None, -1
            if last is None or last[0] is None or role is None or last[0] != role or (begins is not None and b):
                run += 1
            last = (role,)
            want[g, o] = run
        assert got == want


def test_running_sums_in_groups(spark):
    rows = [(g, i, i % 7) for g, n in (("x", 800), (None, 30), ("z", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, o int, n int").repartition(4)
    got = {(r.g, r.o): r.s for r in ranges.running(df, "n", "o", "s", ["g"], cuts=8).collect()}
    assert got == {(g, o): sum(i % 7 for i in range(o)) for g, o, _ in rows}
