"""The training-data operators against brute force, on small and odd tables."""

import collections
import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import bpe, decontaminate, html, language, lexicon, quality, shard, simhash, suffix, toxicity, warc
from quire.llm.components import connected_components

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
LONG = " ".join(f"word{i % 997} filler" for i in range(20_000))
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
#: null, empty, blank, one word, few words, repeats of rows, ids and texts, a null id, a very long text
ODD = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "one"), (5, "a b c"), (6, WORDS), (6, WORDS), (7, WORDS.upper()), (None, WORDS), (None, WORDS), (8, LONG), (9, LONG + " end."), (10, "<|endoftext|> Ünï \x00 日本 🙂 'S x's")]


def table(spark, rows, extra=()):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    return df


def odd(spark):
    return table(spark, ODD, ("fp", "size", "shard", "slot", "tkey", "kept", "score"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# quality


def slow_repeat(words):
    c = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    m = [False] * len(words)
    for i in range(len(words) - 7):
        if c[tuple(words[i : i + 8])] > 1:
            m[i : i + 8] = [True] * 8
    return sum(m)


def test_repeated_words_equal_brute_force():
    rng = np.random.default_rng(1)
    for n in (0, 7, 8, 9, 40, 300):
        for k in (2, 3, 30):
            w = [b"w%d" % i for i in rng.integers(0, k, n)]
            assert quality.repeated_words(w) == slow_repeat(w)


def test_quality_of_odd_rows(spark):
    got = quality.quality_report(odd(spark))
    assert got.count() == len(ODD) and got.columns == ["doc_id", *quality.RULES.names]
    by = {r.doc_id: r for r in got.collect()}
    assert by[0].n_words == 0 and by[0].base_failed and not by[0].kept and by[6].n_words == 24 and by[6].kept and by[8].n_words == 40_000
    assert quality.quality_report(odd(spark).where("false")).count() == 0
    kept = quality.clean_lines(odd(spark))
    assert kept.columns == odd(spark).columns and {r.doc_id for r in kept.collect()} <= {6, 7, 8, 9, None}


def test_quality_counts(spark):
    t = "a b\na b\n\n \na b \n#x $| y\n" + WORDS
    r = quality.quality_report(table(spark, [(1, t)])).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (len(t.split()), len("".join(t.split())), 3, 1)


@pytest.mark.parametrize(
    ("line", "rule"),
    [("A plain sentence, with words.", ""), ("home | news | sport | more", "navigation"), ("THIS IS ALL CAPITALS AND LOUD", "punctuation"), ("All rights reserved.", "boilerplate"), ("x### y$$$ z%%% &&&", "symbols"), ("a a a a a a a a b b b", "stutter"), ("Short title", "")],
)
def test_line_rules(line, rule):
    assert quality.line_fails(line) == rule


def test_cleaning_cuts_lines_and_counts_anew(spark):
    back = " ".join(reversed(WORDS.split())) + "."
    r = quality.clean_lines(table(spark, [(1, f"{WORDS}.\nAll rights reserved.\n{back}")])).first()
    assert r.text == f"{WORDS}.\n{back}" and r.n_chars == len(r.text)


# near duplicates


def slow_simhash(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps):
    """Smallest index reachable over links of at most four bits."""
    n, out = len(fps), [-1] * len(fps)
    for i in range(n):
        if out[i] < 0:
            todo, out[i] = [i], i
            while todo:
                x = todo.pop()
                for y in range(n):
                    if out[y] < 0 and (fps[x] ^ fps[y]).bit_count() <= 4:
                        out[y] = i
                        todo.append(y)
    return out


def test_simhash_equals_brute_force():
    for _, t in ODD:
        assert simhash.simhash(t) == slow_simhash(t)


@pytest.mark.parametrize("scheme", [(3, 1), (5, 2), (6, 3)])
def test_every_near_pair_shares_a_variant(scheme):
    masks = simhash.variant_masks(*scheme)
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for k in rng.choice(64, 4, replace=False).tolist():
            b ^= 1 << k
        assert any(a & m == b & m for m in masks)
    with pytest.raises(ValueError, match="more than one bit"):
        simhash.variant_masks(2, 1)


def cloud(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 4)
    return [int(centres[i % 4]) ^ sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 7), replace=False)) for i in range(n)]


@pytest.mark.parametrize("links", [simhash.run_links, simhash.hub_links])
def test_long_runs_join_what_chains_join(links):
    for seed in range(5):
        a = np.unique(np.array(cloud(150, seed), np.uint64))
        want = slow_components(a.tolist())
        got = links(a)
        place = {x: i for i, x in enumerate(a.tolist())}
        pairs = got if isinstance(got, list) else [(place[x], place[y]) for x, y in zip(got[0].tolist(), got[1].tolist(), strict=True)]
        label = list(range(len(a)))
        for i, j in pairs:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
        assert len(set(label)) == len(set(want)) and len(set(zip(label, want, strict=True))) == len(set(want))


def test_schemes_follow_the_number_of_fingerprints():
    assert [simhash.scheme(n) for n in (0, 10**6, 10**8, 10**10)] == [(3, 1), (3, 1), (5, 2), (6, 3)]
    assert [simhash.scheme(n, 5) for n in (10**6, 10**10)] == [(3, 1), (7, 3)]
    for n, k in ((10**6, 4), (10**8, 4), (10**10, 4), (10**10, 5)):
        assert len(simhash.variant_masks(*simhash.scheme(n, k), k)) < 1000


@pytest.mark.parametrize("scheme", [(3, 1), (5, 2), (6, 3)])
def test_fingerprint_components(spark, scheme):
    fps = sorted(set(cloud(400, 9)))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    root = {r.node: r.root for r in simhash.fingerprint_components(spark.createDataFrame([(f,) for f in signed], "fp long"), *scheme).collect()}
    want = slow_components(fps)
    got = [root.get(f, f) for f in signed]
    assert len(set(zip(got, want, strict=True))) == len(set(want)) == len(set(got))


def test_near_duplicates_of_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark))
    assert got.count() == len(ODD)
    by = {r.doc_id: r.component_id for r in got.collect()}
    assert by[0] == by[1] == by[2] == 0 and by[3] == by[4] == 3 and by[6] == by[7] == by[None] == 6
    assert simhash.near_duplicates(odd(spark).where("false")).count() == 0
    kept = simhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter([0, 3, 5, 6, 8, 10] + ([9] if by[9] == 9 else []))


def test_op6_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    fps = [slow_simhash(t) for _, t in docs]
    want = slow_components(fps)
    least = {c: min(docs[i][0] for i in range(len(docs)) if want[i] == c) for c in set(want)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op6_simhash(spark, SF).collect()}
    assert got == {d: (f"{fp:016x}", least[c]) for (d, _), fp, c in zip(docs, fps, want, strict=True)}


def test_one_of_each_group_whatever_its_id(spark):
    other = " ".join(f"quite{i} another{i}" for i in range(30))
    rows = [(5, WORDS), (5, other), (5, WORDS), (2, WORDS + " "), (None, other), (None, "text without id " * 9), (None, None), (7, "")]
    got = simhash.keep_one(table(spark, rows, ("__i1", "fp", "who")))
    assert {(r.doc_id, r.text) for r in got.collect()} == {(2, WORDS + " "), (5, other), (None, "text without id " * 9), (7, "")} and got.count() == 4
    assert got.columns == table(spark, rows, ("__i1", "fp", "who")).columns


def test_components_of_hubs(spark, monkeypatch):
    from quire.llm import components

    monkeypatch.setattr(components, "MIN_HUB", 3)
    rng = np.random.default_rng(1)
    edges = [(0, i) for i in range(1, 60)] + [(100 + int(a), 100 + int(b)) for a, b in rng.integers(0, 40, (25, 2))] + [(59, 300), (300, 301)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    label = {}
    for a, b in edges:
        label.setdefault(a, a)
        label.setdefault(b, b)
    for a, b in edges * 40:
        label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in connected_components(e).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[1001] == got[1000] == 1000


# suffix arrays


def slow_removal(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    c = collections.Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        m = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if c[r[i : i + length]] > 1:
                m[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(r, m, strict=True) if not y)
        out.append((len(r), sum(m), sum(m[i] and (i == 0 or not m[i - 1]) for i in range(len(m))), hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    rng = np.random.default_rng(seed)
    text = lambda n: "".join(chr(97 + int(i)) for i in rng.integers(0, 6, n))
    p = [text(n) for n in (199, 200, 201, 350, 700)]
    rows = [text(int(rng.integers(0, 400))) + p[int(rng.integers(0, 5))] + text(int(rng.integers(0, 300))) for _ in range(40)]
    rows += ["z" * 199, "z" * 200, "z" * 450, "", None, text(150) * 4, p[3] + p[4], p[4] + p[3], "ä" * 100, "ä" * 101, p[2]]
    return rows + rows[3:6] + rows[:1] * 3


@pytest.mark.parametrize(("seed", "how"), [(1, {}), (2, {"group": 2, "shard_bytes": 2000}), (3, {"group": 1, "shard_bytes": 1}), (4, {"group": 3})])
def test_removal_equals_brute_force(spark, seed, how):
    rows = passages(seed)
    d = table(spark, list(enumerate(rows))).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in suffix.removal_report(d, **how).collect()}
    assert [got[i] for i in range(len(rows))] == slow_removal(rows)


def test_repeats_of_contexts():
    rng = np.random.default_rng(0)
    for _ in range(20):
        c = [bytes(rng.integers(97, 99, int(rng.integers(8, 60))).astype(np.uint8)) for _ in range(8)]
        count = collections.Counter(x[i : i + 8] for x in c for i in range(len(x) - 7))
        assert [m.tolist() for m in suffix.repeats(c, 8)] == [[count[x[i : i + 8]] > 1 for i in range(len(x) - 7)] for x in c]


def test_merged_runs_equal_counting(spark):
    rng = np.random.default_rng(3)
    for _ in range(30):
        runs = []
        for k in range(int(rng.integers(1, 9))):
            w = np.unique(rng.integers(0, 40, int(rng.integers(0, 30))).astype("S16"))
            r = np.empty(len(w), suffix._W)
            r["w"], r["t1"], r["t2"], r["s"], r["marked"] = w, k, 0, rng.integers(0, 2, len(w)), rng.integers(0, 2, len(w)) == 1
            runs.append(r)
        at = collections.defaultdict(set)
        for r in runs:
            for x in r.tolist():
                at[x[0]] |= {x[1:4]} | ({"more"} if x[4] else set())
        want = sorted((x[1], x[2], x[3], x[3] + suffix.LENGTH) for r in runs for x in r.tolist() if not x[4] and len(at[x[0]]) > 1)
        batches = []
        for k, r in enumerate(runs):
            w = np.array([x.ljust(16, b"\0") for x in r["w"].tolist()], "S16")
            h = suffix._halves(w) if len(w) else [np.empty(0, np.int64)] * 2
            assert suffix._whole(*h).tolist() == w.tolist()
            cols = [np.full(len(r), k), *h, *(np.ascontiguousarray(r[c]) for c in ("t1", "t2", "s", "marked"))]
            batches.append(pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["run", "w1", "w2", "t1", "t2", "s", "marked"]))
        got = sorted(tuple(x.values()) for b in suffix._across(iter(batches)) for x in b.to_pylist())
        assert got == want


def test_a_frequent_passage_costs_no_more_than_its_windows(spark):
    """Shards of one anchor answer for unmarked windows only, and each publishes a window once."""
    rng = np.random.default_rng(8)
    word = lambda n: "".join(chr(97 + int(i)) for i in rng.integers(0, 26, n))
    passage = word(500)
    rows = [word(int(rng.integers(20, 260))) + passage + word(int(rng.integers(20, 260))) for _ in range(300)]
    d = table(spark, list(enumerate(rows))).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in suffix.removal_report(d, group=20).collect()}
    assert [got[i] for i in range(len(rows))] == slow_removal(rows)
    assert suffix.repeated_spans(d, group=20).count() < 4 * len(rows)


@pytest.mark.parametrize("name", ["__n", "__tkey", "__spans", "__t1", "__size", "h", "t1"])
def test_removal_beside_any_column(spark, name):
    d = table(spark, [(1, "abc" * 100), (2, "abc" * 100), (3, None)], (name,)).withColumn("n_chars", F.lit("many"))
    got = suffix.remove_repeats(d)
    assert got.columns == d.columns and {(r.doc_id, r.text, r.n_chars) for r in got.collect()} == {(1, "", "many"), (2, "", "many"), (3, "", "many")}


def test_removal_of_odd_rows(spark):
    assert suffix.removal_report(odd(spark)).count() == len(ODD)
    got = suffix.remove_repeats(odd(spark))
    assert got.columns == odd(spark).columns and got.count() == len(ODD)
    by = {r.doc_id: r.text for r in got.collect()}
    assert by[0] == "" and by[6] == WORDS and len(by[8]) < len(LONG)
    assert suffix.removal_report(odd(spark).where("false")).count() == 0


def test_text_key_is_sparks(spark):
    for _, t in ODD[1:]:
        if t:
            assert tuple(spark.createDataFrame([(t,)], "t string").select(*suffix.spark_key(F.col("t"))).first()) == suffix.text_key(t.encode())


# decontamination


def slow_leaks(items, docs):
    out = set()
    for d, t in docs:
        words = decontaminate.words_of(t)
        for i, x in items:
            q, a = decontaminate.split_item(x or "")
            if not q + a:
                continue
            ok = True
            for part in (q + a, q, a):
                n = min(5, len(part))
                have = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
                own = {tuple(part[k : k + n]) for k in range(len(part) - n + 1)} if n else set()
                ok = ok and (not own or len(own & have) / len(own) >= 0.8)
            if ok:
                out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    extra = [(10_000 + k, "Some words before. " + r.text.upper() + " and behind it." * k) for k, r in enumerate(items.orderBy("item_id").take(6))]
    cut = [(20_000 + k, " ".join(r.text.split()[: int(len(r.text.split()) * s)])) for k, r in enumerate(items.orderBy("item_id").take(6)) for s in (0.7, 0.88)]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(extra + cut, "doc_id long, text string"))
    got = {(r.doc_id, i) for r in decontaminate.find_leaks(every, items).collect() for i in r.item_ids}
    assert got == slow_leaks([tuple(r) for r in items.select("item_id", "text").collect()], [tuple(r) for r in every.collect()]) and len(got) > 6
    bad = {d for d, _ in got}
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - bad


def test_leaks_in_pieces(spark):
    """An item cut in two by more words than a window holds is still in the document."""
    own = [f"w{i}" for i in range(59)]
    rows = [(k, " ".join(own[:30] + [f"x{i}" for i in range(n)] + own[30:])) for k, n in enumerate((0, 30, 400))] + [(9, " ".join(own[:40]))]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(own)), (2, "other words of an item that nobody has")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.overlap for r in decontaminate.find_leaks(docs, items).collect()}
    assert set(got) == slow_leaks([tuple(r) for r in items.collect()], rows) == {(0, 1), (1, 1), (2, 1)} and abs(got[2, 1] - 51 / 55) < 1e-9
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()] == [9]


def test_answers_decide(spark):
    item = "Which town lies between the old mill and bridge of the river. Paris town"
    rows = [(1, f"so it was said {item} and more"), (2, f"so it was said {item.replace('Paris town', 'London here')} and more"), (3, "Paris town"), (4, item.replace(". Paris", ", or so it is told. Paris"))]
    items = [(7, item), (8, "one sentence of nine plain words without an answer")]
    docs = spark.createDataFrame([*rows, (5, items[1][1])], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == slow_leaks(items, [*rows, (5, items[1][1])]) == {(1, 7), (4, 7), (5, 8)}


def test_wand_equals_scoring_all():
    rng = np.random.default_rng(12)
    vocab = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(vocab[int(i)] for i in np.minimum(rng.geometric(0.06, n), 59))
    rows = [(k, text(int(rng.integers(1, 30)))) for k in range(70)]
    index = decontaminate.build_index(rows)
    docs = [decontaminate.words_of(text(int(n))) for n in rng.integers(0, 400, 60)] + [decontaminate.words_of(t) for _, t in rows]
    got = decontaminate.search(index, docs)
    half = index.span + index.span // 4 + 4
    want = {}
    for d, words in enumerate(docs):
        windows = max(1, -(-len(words) // half) - 1)
        for k in range(windows + (windows > 1)):
            have = np.unique([index.vocabulary[w] for w in (words if k == windows else words[k * half : (k + 2) * half]) if w in index.vocabulary]).astype(int)
            for item in range(len(index.ids)):
                at = [p for t in have for p in range(index.starts[t], index.starts[t + 1]) if index.items[p] == item]
                score = index.impacts[at].sum()
                if score >= 1 - 1e-9 and (k < windows or (d, item) not in want):
                    want[d, item] = max(want.get((d, item), 0.0), score * index.full[item])
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and len(got) > 80


def test_leaks_in_groups_of_items(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    one = rows_of(decontaminate.find_leaks(docs, items))
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 1500)
    assert len(list(decontaminate.item_groups(items))) > 3
    assert rows_of(decontaminate.find_leaks(docs, items)) == one


def test_items_may_have_any_id(spark):
    docs = table(spark, [(1, WORDS), (2, "other")]).withColumn("item_id", F.lit("x"))
    items = spark.createDataFrame([("b", WORDS), ("a", WORDS.upper()), (None, WORDS)], "item_id string, text string")
    assert [(r.doc_id, r.item_id, r.item_ids) for r in decontaminate.find_leaks(docs, items).collect()] == [(1, "a", ["a", "b"])]
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()] == [2]


def test_leaks_of_odd_rows(spark):
    items = spark.createDataFrame([(1, WORDS), (2, WORDS.lower()), (3, None), (4, ""), (5, "a b c"), (None, "x y z w v u t s")], "item_id long, text string")
    got = decontaminate.find_leaks(odd(spark), items)
    assert {(r.doc_id, tuple(r.item_ids)) for r in got.collect()} == {(6, (1, 2)), (7, (1, 2)), (None, (1, 2)), (5, (5,))}
    assert got.where("doc_id = 6").count() == 2
    assert decontaminate.drop_leaks(odd(spark), items).count() == len(ODD) - 6
    assert decontaminate.find_leaks(odd(spark), items.where("false")).count() == 0 and decontaminate.find_leaks(odd(spark).where("false"), items).count() == 0


# sharding


def slow_shards(rows):
    order = sorted(rows, key=lambda r: (hashlib.md5((r[1] or "").encode()).hexdigest()[:15], r[0] if r[0] is not None else -(1 << 63)))
    size = [len((t or "").encode()) + 1 for _, t in order]
    out, below, slots = {}, 0, collections.Counter()
    for (i, t), s in zip(order, size, strict=True):
        k = 16 * below // sum(size)
        out[i] = (s, zlib.crc32((t or "").encode()), k, slots[k])
        slots[k] += 1
        below += s
    return out


def test_shards_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    hot = spark.range(150).select((F.col("id") + 10_000).alias("doc_id"), F.lit("the same text " * 9).alias("text"))
    for d in (docs, docs.union(hot), docs.limit(3)):
        rows = [tuple(r) for r in d.collect()]
        got = {r.doc_id: (r.size, r.text_crc32, r.shard, r.slot) for r in shard.shard_documents(d).select("doc_id", "size", "text_crc32", "shard", "slot").collect()}
        assert got == slow_shards(rows)


@pytest.mark.parametrize(("cells", "bits"), [(1, 0), (16, 0), (4, 5), (7, 12)])
def test_parts_change_no_shard(spark, cells, bits):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    d = docs.union(spark.range(150).select((F.col("id") + 10_000).alias("doc_id"), F.lit("the same text " * 9).alias("text")))
    got = {r.doc_id: (r.size, r.text_crc32, r.shard, r.slot) for r in shard.shard_documents(d, cells=cells, bits=bits).select("doc_id", "size", "text_crc32", "shard", "slot").collect()}
    assert got == slow_shards([tuple(r) for r in d.collect()])


def test_parts_follow_the_row_count():
    assert shard.parts_of(0) == shard.parts_of(10**6) == (4, 0) and shard.parts_of(10**8) == (16, 9) and shard.parts_of(10**12) == (16, 16)
    for n in (10**7, 10**8, 10**9, 10**10):
        cells, bits = shard.parts_of(n)
        assert n / (16 * cells + 2**bits) < 2 * shard.ROWS


def test_shards_beside_clashing_names(spark):
    d = table(spark, [(1, "a"), (2, None)], ("size", "doc_size", "Slot", "__k", "__size", "a b"))
    got = shard.shard_documents(d)
    assert got.columns[5:] == ["doc_doc_size", "doc_size", "doc_Slot", "__k", "__size", "a b", *shard.ADDED[:3], "shard", "slot", "grown_shard"] and got.count() == 2


def test_shards_of_odd_rows(spark):
    d = odd(spark)
    got = shard.shard_documents(d, tolerance=0.01)
    assert got.count() == len(ODD) and {"doc_size", "doc_shard", "doc_slot", "shard", "tkey"} <= set(got.columns)
    for s, slots in got.groupBy("shard").agg(F.collect_list("slot")).collect():
        assert 0 <= s < 16 and sorted(slots) == list(range(len(slots)))
    assert shard.shard_documents(d.where("false")).count() == 0


def test_sharding_plan_has_no_python(spark, capsys):
    shard.shard_documents(spark.read.parquet(f"{SF}/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


# language and toxicity


def test_languages_of_held_out_documents(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language.op2_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[0] > 0.98 and held[1] > 150 and got.where("score < 0 or score > 1").count() == 0


def test_every_language_is_learned(spark):
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"]
    texts = [(k, " ".join(words[4 * k : 4 * k + 4]) * 3) for k in range(150)]
    rows = [(1000 * k + i, f"{t} {i}") for k, t in texts for i in range(3)]
    docs = spark.createDataFrame([(i, t, f"l{i // 1000:03d}") for i, t in rows], "doc_id long, text string, lang string")
    model = language.train(docs, F.lit(True))
    assert len(model.names) == 150 and len(model.landmarks) == 300
    right = language.identify(docs, model).join(docs, "doc_id").where("lang = lang_pred").count()
    assert right > 0.95 * len(rows)


def test_fitting_in_blocks_changes_nothing(monkeypatch):
    rng = np.random.default_rng(0)
    packed = [np.packbits(rng.integers(0, 2, language.SIZE) * rng.integers(0, 2, language.SIZE)).tobytes() for _ in range(50)]
    langs = [f"l{i % 4}" for i in range(50)]
    whole = language.fit(packed, langs)
    monkeypatch.setattr(language, "AT_ONCE", 7)
    assert np.allclose(whole.weights, language.fit(packed, langs).weights, atol=1e-4)


def test_language_of_odd_rows(spark):
    docs = table(spark, [(i, t) for i, t in ODD] + [(100 + i, "the and with " * 9) for i in range(9)] + [(200 + i, "été où ça leur " * 9) for i in range(9)]).withColumn("lang", F.when(F.col("doc_id") >= 200, "fr").when(F.col("doc_id") >= 100, "en"))
    model = language.train(docs, F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    assert got[0] == got[1] == got[2] == ("und", 0.0) and got[100][0] == "en" and got[200][0] == "fr"
    none = language.train(docs.where("false"), F.lit(True))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"} and language.identify(docs.where("false"), model).count() == 0


def test_fuzzy_trie_equals_edit_distance():
    def near(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1] <= 1

    rng = np.random.default_rng(2)
    word = lambda: "".join("abc"[i] for i in rng.integers(0, 3, int(rng.integers(1, 7))))
    terms = sorted({word() for _ in range(30)})
    trie = toxicity.FuzzyTrie(terms)
    for _ in range(400):
        w = word()
        assert trie.find(w) == [t for t in terms if near(w, t)]


def test_short_terms_are_caught_misspelled():
    m = toxicity.Matcher({"scum": 5.0, "moron": 5.0, "fool": 4.0}, {}, frozenset({"foot"}))
    assert m.match("scum") == (5.0, "scum") and m.match("scvm")[1] == m.match("scumm")[1] == m.match("scum***")[1] == "scum"
    assert m.match("scm") is None and m.match("cum") is None and m.match("slum")[1] == "scum"
    assert m.match("foot") is None and m.match("pool") is None and m.match("mron")[1] == "moron" and m.match("oron")[1] == "moron"


def test_toxicity_of_held_out_documents(spark):
    """Of the documents whose label the words can tell (the rest of the toxic labels lie on junk), nearly all."""
    sf = SF.replace("sf0.001", "sf0.1")
    got = toxicity.op5_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.9 * (n[1, 0] + n[1, 1]) and n.get((0, 1), 0) <= 0.005 * n[0, 0]


def test_toxic_documents_are_told_apart(spark):
    rng = np.random.default_rng(4)
    vocab = [f"{a}{b}" for a in "ba ko ti su re".split() for b in "lan mor vin des tur".split()]
    text = lambda n: [vocab[i] for i in rng.integers(0, len(vocab), n)]
    rows, labels = [], []
    for i in range(400):
        w = text(60)
        toxic = i % 4 == 0
        if toxic:
            for k in (5, 20, 41):
                w[k] = ["wretch", "imbecile", "vermin"][int(rng.integers(0, 3))]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    base = " ".join(text(60))
    odd_rows = [(1000, base), (1001, base + " imbecille wretch verminn"), (1002, 'he said "wretch" once ' + base), (1003, None), (1004, "")]
    docs = table(spark, rows + odd_rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    held = [(got[i].predicted, t) for i, _, t in labels if i % 3 == 1]
    assert sum(p == t for p, t in held) / len(held) > 0.97
    assert got[1001].score > got[1002].score > got[1000].score == got[1003].score == got[1004].score
    assert all(0 <= r.score <= 1 for r in got.values())
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), F.lit(True))
    assert {r.score for r in toxicity.score_documents(docs, none).collect()} == {0.0}


# BPE


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    lib = Tokenizer.from_file(path)
    rows = [*ODD, (20, "İSTANBUL Σίσυφος ΟΔΟΣ"), (21, "²½ x²y 3½ ¹\x1c\x85 z"), (22, "x" * 700), (23, "a<|startoftext|>b <|ENDOFTEXT|>"), (24, "é ṩ ﬁ ǅ"), (25, "don't WE'LL 'tis")]
    odd_rows = table(spark, [(1_000_000 + k, t) for k, (_, t) in enumerate(rows)])
    docs = odd_rows.union(spark.read.parquet(f"{SF}/documents.parquet").select(DOCS.names))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = bpe.bpe_documents(docs, words=500).collect()
    assert len(got) == docs.count() == len(texts)
    for r in got:
        want = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == " ".join(map(str, want)) and r.n_tokens == len(want)
        assert r.decoded == (lib.decode(want, skip_special_tokens=False) if want else "")
    assert rows_of(bpe.bpe_documents(docs, vocabulary=path, words=0)) == rows_of(bpe.bpe_documents(docs))
    enc = bpe.Encoder(bpe.model(path), None)
    for _, t in rows:
        want = lib.encode(t or "", add_special_tokens=False).ids
        assert enc.encode(t) == (len(want), " ".join(map(str, want)), lib.decode(want, skip_special_tokens=False) if want else "")


def test_words_merged_in_step_equal_words_merged_alone():
    m = bpe.model(bpe.default_vocabulary())
    rng = np.random.default_rng(6)
    words = [b"", b"a", b"ab", "日本".encode(), b"x" * 99, b"y" * 101, *(bytes(rng.integers(97, 104, int(rng.integers(1, 40))).astype(np.uint8)) for _ in range(500))]
    assert m.merge_all(words) == [m.merge(w) if w else [] for w in words] and m.merge_all([]) == []


def test_a_forgetful_encoder_gives_the_same(monkeypatch):
    docs = [t or "" for _, t in ODD] + ["one two three one", "four <|endoftext|> five one"]
    want = [bpe.Encoder(bpe.model(bpe.default_vocabulary()), None).encode(t) for t in docs]
    monkeypatch.setattr(bpe, "CACHED_WORDS", 2)
    enc = bpe.Encoder(bpe.model(bpe.default_vocabulary()), None)
    assert [enc.encode(t) for t in docs] == want and [enc.encode(t) for t in docs] == want


def test_bpe_of_empty_tables(spark):
    assert bpe.bpe_documents(odd(spark).where("false")).count() == 0
    assert bpe.bpe_documents(table(spark, [(1, None), (2, "")])).select("ids").distinct().collect()[0][0] == ""


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): [i, i + 1] for i, w in enumerate("tap taps top tops stop stops a".split())}
    p = tmp_path / "l.bin"
    p.write_bytes(lexicon.compile_lexicon(words))
    lex = lexicon.Lexicon(str(p))
    assert all(lex.output(int(k)) == words[w] for w, k in zip(words, lex.find(list(words)), strict=True))
    assert lex.find([b"", b"ta", b"tapss", b"b"]).tolist() == [-1] * 4
    # states by right language: the ends of tap, top and stop are one
    rights = {frozenset(w[k:] for w in words if w.startswith(pre)) for w0 in words for k in range(len(w0) + 1) for pre in [w0[:k]]}
    assert lex.n_states == len(rights)


# WARC


def test_archives_round_trip(spark):
    big = "<p>" + "x" * 2000 + "</p>"
    rows = [(1, "http://a/x y", big), (2, None, big), (9, "http://a/\r\nz", big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (None, "u", big), (7, "u", "é" * 700), (7, "u", "é" * 700), (8, "u", "0" * 999), (10, "u", "0" * 999), (11, "u", "0" * 1000), (12, "u", "0" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumn("archive", F.lit("x"))
    names, folder = warc.deduplicated_archives(pages)
    got = warc.read_archives(names, folder).collect()
    assert len(got) == len(rows)
    kind = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kind == collections.Counter(
        {(9, "response", None): 1, (1, "revisit", 9): 1, (2, "revisit", 9): 1, (None, "revisit", 9): 1, (7, "response", None): 1, (7, "revisit", 7): 1, (12, "response", None): 1, (11, "revisit", 12): 1}
        | {(i, "response", None): 1 for i in (3, 4, 5, 6, 8, 10)}
    )
    for r in got:
        html_ = next(h for i, _, h in rows if i == r.page_id) or ""
        assert r.payload_bytes == len(html_.encode()) and r.payload_digest == hashlib.sha1(html_.encode()).hexdigest()  # noqa: S324
    ids = [r.record_id for r in got]
    assert len(set(ids)) == len(ids) and {r.refers_to_record for r in got if r.refers_to_record} <= {r.record_id for r in got if r.record_type == "response"}
    none, where = warc.deduplicated_archives(pages.where("false"))
    assert warc.read_archives(none, where).count() == 0


@pytest.mark.parametrize("name", ["op1_shard", "op4_decontaminate", "op8_suffix", "op9_quality_rules", "op10_warc"])
def test_queries_equal_sql(spark, name):
    import duckdb

    from quire.llm.entry import ORACLE_SQL, QUERIES

    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    cur = c.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    assert [d[0] for d in cur.description] == got.columns
    assert sorted(map(repr, cur.fetchall())) == sorted(repr(tuple(r)) for r in got.collect())


# HTML


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), (None, ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b<br>c</p>d", "a\nb c\nd"), ("<p>x &lt;b&gt;\n y&nbsp;z&#233;</p>", "x <b> y zé"),
        ("<script>var t='<p>no</p>'</script><style>p{}</style><p>yes", "yes"), ("<nav>m</nav><header>h</header><article><header><h1>T</h1></header><p>a <b>b</b></p><aside>s</aside></article><footer>f</footer>", "T\na b"),
        ("<div class='post-comments'>c</div><main><p>m</p><form>f</form></main>", "m"), ("<!-- x <p>y --><ul><li>1<li>2</ul>", "1\n2"), ("<p title='a>b'>q</p", "q"), ("<div id=cookie-notice>n</div><p>ok<script>", "ok"),
        ("<article><p>a</p><section class='comments'><article><p>c</p></article></section></article>", "a"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<b>" * 3000 + "deep", "deep"),
        ('<article><section class="related-work"><p>Earlier studies.</p></section><p class="notice">Body.</p><p>End</p></article>', "Earlier studies.\nBody.\nEnd"),
        ('<main><article class="teaser">..</article><p>The real story text.</p></main>', "..\nThe real story text."),
        ("<article><p>a</p><div class='share'>s</div><section class='related'>r</section><li class='comment odd'>c</li><div class='notice'>n</div><p class='social-history'>h</p></article>", "a\nn\nh"),
        ("<article><p>a</p></article><div class=sidebar>" + "s " * 400 + "</div>", "a"), ("<div class='widget'><p>" + "w " * 200 + "</p></div><p>x</p>", ("w " * 200).strip() + "\nx"),
        ("<article><p>a</p><div class='comments'>" + "c " * 400 + "</div><div class='ad'>b</div><span class='comment'>code</span></article>", "a\ncode"),
    ],
)
def test_main_text(page, text):
    assert html.Page(page or "").text() == text


def test_marked_slots_need_their_host(spark):
    page = "<main><article><p>own text {0} of this page</p><div class='banner box-{0}'>unlike promotion {0}</div><p class='notice {1}'>a notice {0}</p></article></main>"
    rows = [(i, "http://h.example/", page.format(i, "other" if i else "rare")) for i in range(12)] + [(100 + i, "http://few.example/", page.format(i, "x")) for i in range(3)]
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "own text 3 of this page" and got[0] == "own text 0 of this page\na notice 0"
    assert got[101] == "own text 1 of this page\nunlike promotion 1\na notice 1"


def test_templates_of_a_hot_host_are_dealt(spark):
    rows = [(i, f"http://h{i % 40 if i > 300 else 0}.example/", f"<div><i>Follow us</i></div><p>own text {i}</p>") for i in range(700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    templates, hot = html.site_templates(pages)
    assert 0 < hot.count() <= 1 / html.HOT
    got = html.with_templates(pages, templates, hot, small=0)
    assert rows_of(got.select("page_id", F.array_sort("template"))) == rows_of(html.with_templates(pages, templates, hot).select("page_id", F.array_sort("template")))
    assert got.count() == 700 and got.where("template is null").count() == 0
    assert {r.text for r in html.extract_pages(pages).collect()} == {f"own text {i}" for i in range(700)}


def test_quoted_passages_stay_on_unmarked_pages(spark):
    quote, links = "a passage that many pages of this host quote in full " * 5, "<ul><li><a href=/a>one</a></li></ul>"
    rows = [(i, "http://q.example/", f"<body><div>{links}<p>own words {i} {'x' * i}</p><p>{quote}</p><p>more {i}</p></div><div><p>{quote}</p></div></body>") for i in range(9)]
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == f"own words 4 xxxx\n{quote.strip()}\nmore 4"


def test_site_templates_go_and_article_passages_stay(spark):
    rows = [(i, f"http://Site.example/{i}", f"<div><div><i>Follow us on everything</i></div><p>own text {i}</p></div>") for i in range(12)]
    rows += [(100 + i, "https://other.example/x", f"<article><p>quoted everywhere</p><p>own {i}</p></article>") for i in range(12)] + [(200, None, None), (201, "no url", "<p>t</p>"), (0, "http://site.example/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("template", F.lit(1))
    got = html.extract_pages(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(rows)
    by = {r.page_id: r.text for r in got.collect()}
    assert by[3] == "own text 3" and by[104] == "quoted everywhere\nown 4" and by[200] == "" and by[201] == "t"
    assert html.extract_pages(pages.where("false")).count() == 0


# pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    seen = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == names, name
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.5 * seen[0]
    assert P.STAGES[-1][1](spark, docs, SF).count() == seen[-1]


def test_pipeline_takes_odd_rows(spark, tmp_path):
    import corpus_pipeline as P

    table(spark, ODD).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "no such words anywhere in here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} <= {6, 7, 8, 9, None}


def test_pipeline_stages_beside_any_columns(spark):
    import corpus_pipeline as P

    names = ("__n", "__tkey", "__spans", "__i1", "__i2", "__t1", "fp", "who", "item_id", "h", "size", "n_tokens", "ids")
    docs = table(spark, [(None if i is None else i + 100, t) for i, t in ODD], names).withColumn("n_chars", F.lit("many")).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        assert 0 < out.count() <= len(ODD) and stage(spark, docs.where("false"), SF).count() == 0
    assert P.STAGES[-1][1](spark, docs, SF).count() == len(ODD)


def test_pipeline_equals_brute_force(spark):
    """Every stage worked out plainly over all documents of the smallest tables."""
    from tokenizers import Tokenizer

    import corpus_pipeline as P

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [(i, g[7]) for i, t in rows for g in [quality.judge(t)] if g[6]]

    def print_of(text):
        h = [xxhash.xxh64_intdigest(w, 42) for w in set(text.encode().lower().split())]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [print_of(t) for _, t in kept]
    label = list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= simhash.COPY_BITS and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    kept = [min((d for d, x in zip(kept, label, strict=True) if x == c), key=lambda d: d[0]) for c in sorted(set(label))]
    raws = [t.encode() for _, t in kept]
    count = collections.Counter(r[i : i + 200] for r in raws for i in range(len(r) - 199))
    cleaned = []
    for (i, _), r in zip(kept, raws, strict=True):
        m = bytearray(len(r))
        for k in range(len(r) - 199):
            if count[r[k : k + 200]] > 1:
                m[k : k + 200] = b"\1" * 200
        cleaned.append((i, bytes(x for x, y in zip(r, m, strict=True) if not y).decode("utf-8", "ignore")))
    bad = {d for d, _ in slow_leaks(items, cleaned)}
    lib = Tokenizer.from_file(bpe.default_vocabulary())
    want = {}
    for i, t in cleaned:
        if i not in bad:
            ids = lib.encode(t, add_special_tokens=False).ids
            want[i] = (len(ids), " ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False) if ids else "")
    got = {r.doc_id: (r.n_tokens, r.ids, r.decoded) for r in P.run(spark, SF).collect()}
    assert got == want and len(want) > 50


def test_pages_equal_brute_force(spark):
    """Templates counted plainly, on pages whose content is marked and on the same pages without the marks."""
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.1')}/pages.parquet").collect()]
    bare = [(i, u, (h or "").replace("article", "div").replace("<nav", "<div").replace("</nav", "</div").replace("footer", "div").replace('class="ad"', "")) for i, u, h in rows]
    for table_ in (rows, bare):
        hosts = collections.defaultdict(dict)
        for _, u, h in table_:
            p = html.Page(h or "")
            name = (u or "").split("://", 1)[-1].split("/")[0].split("?")[0].split("#")[0].split("@")[-1].lower()
            hosts[name][p.content()] = p.subtrees()
        want = {}
        for i, u, h in table_:
            name = (u or "").split("://", 1)[-1].split("/")[0].split("?")[0].split("#")[0].split("@")[-1].lower()
            contents = hosts[name]
            n = collections.Counter(x for s in contents.values() for x in s)
            often = frozenset(x for x, k in n.items() if k >= html.MIN_PAGES and k >= html.MIN_SHARE * len(contents))
            firm = frozenset(x for x in often if n[x] >= html.FIRM * len(contents))
            want[i] = html.Page(h or "").text(often, firm)
        got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(table_, "page_id long, url string, html string")).collect()}
        assert got == want
    assert any(html.Page(h).text() != want[i] for i, _, h in bare)


def test_copies_of_a_page_are_no_template(spark):
    own = "a long own text of this one page that many mirrors hold " * 6
    copied = f"<html><body><div><p>{own}</p></div></body></html>"
    moved = "<html><body><div><p>%s</p></div><p>seen %d times</p></body></html>"
    rows = [(i, "http://mirror.example/a", copied) for i in range(10)] + [(10 + i, f"http://mirror.example/m{i}", moved % (own + "more", i)) for i in range(6)]
    rows += [(50 + i, f"http://mirror.example/{i}", f"<html><body><div><i>Follow us</i></div><p>own text {i}</p></body></html>") for i in range(20)]
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == own.strip() for i in range(10))
    assert all(got[10 + i] == f"{own}more\nseen {i} times" for i in range(6))
    assert all(got[50 + i] == f"own text {i}" for i in range(20))


def test_templates_inside_marked_content(spark):
    links = "<div><a href=/x>Other things to read</a> <a href=/y>More of them</a></div>"
    quote = "a passage that many pages quote " * 8
    rows = [(i, "http://m.example/", f"<main><div><p>We are closed on Sunday</p></div>{links}<h2>Summary</h2><p>{quote}</p><p>own text {i} {'of this page ' * 40}</p></main>") for i in range(12)]
    rows += [(50 + i, "http://a.example/", f"<article><p>quoted everywhere</p><p>own {i}, see <a href=/z>there</a></p>{links}</article>") for i in range(12)]
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == f"Summary\n{quote.strip()}\nown text 3 {('of this page ' * 40).strip()}"
    assert got[54] == "quoted everywhere\nown 4, see there"
