"""Chunk tables against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quire.llm import pieces
from tests.llm.test_operators import ODD, SF, odd, table

LETTERS = [*"abcdefghi    etaonrs\n\t\r\x0b\x0c▁▁.,()=-_0123ÜñéλЖ日本語한글🙂\x00", "�", "﻿", "​", "　", "\xa0"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def expected(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_chunks_and_merges_equal_the_library(library):
    model, rng = pieces.PieceModel(pieces.default_model()), random.Random(1)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 2, 5, 20, 200]))) for _ in range(600)]
    texts += [" " * k + "x" + "=" * k + "日" * k for k in range(0, 100, 7)] + ["ab" * 500, "▁" * 70 + "▁a▁", "<s></s><unk><0x41>"]
    for text in texts:
        ids = [model.begin, *(i for c in model.chunks(text) for i in model.segment(c)), model.end]
        assert ids == library.encode(text, add_bos=True, add_eos=True), text
        assert model.decode(np.array(ids)) == library.decode(ids)


def test_any_ids_decode_as_the_library_does(library):
    model, rng = pieces.PieceModel(pieces.default_model()), random.Random(2)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(0, 259), rng.randrange(259, 32000)]) for _ in range(rng.choice([1, 2, 5, 30]))]
        ids = [i for i in ids if i > 2]
        if ids:
            assert model.decode(np.array([1, *ids, 2])) == library.decode([1, *ids, 2])


def test_long_symbol_lists_merge_as_short_ones(monkeypatch):
    model, rng = pieces.PieceModel(pieces.default_model()), random.Random(3)
    for _ in range(200):
        chunk = "▁" * rng.randint(0, 20) + "".join(rng.choice("aetionrsh=") for _ in range(rng.randint(2, 40)))
        assert model._merged(chunk) == model._merged_long(list(chunk))


@pytest.mark.parametrize(("room", "most", "least", "block"), [(pieces.FREQUENT_BYTES, pieces.FREQUENT, 4, 4 << 20), (2000, 30, 1, 1000), (0, 0, 2, 1 << 16), (1 << 20, 1000, 1, 1)])
def test_documents_equal_the_library(spark, library, room, most, least, block):
    rows = [*ODD, (20, "日本語 " * 300 + "  x  \n\n y▁z "), (21, "ab" * 4000), (22, "=" * 3000 + " a, b" * 9)]
    got = pieces.piece_documents(table(spark, rows), keep_text=False, room=room, most=most, least=least, block=block).collect()
    assert sorted(map(repr, ((r.doc_id, *tuple(r)[1:]) for r in got))) == sorted(repr((i, *expected(library, t))) for i, t in rows)


def test_ids_and_texts(spark, library):
    got = {r.doc_id: r for r in pieces.piece_documents(odd(spark).where("doc_id in (0, 5, 10)")).collect()}
    assert got[0].ids == [1, 2] and got[0].decoded == ""
    assert got[5].ids == library.encode("a b c", add_bos=True, add_eos=True) and got[10].decoded == ODD[-1][1]


def test_frequent_chunks(spark):
    docs = table(spark, [(1, "a b, a"), (2, "a b\nb"), (None, None)]).repartition(1)
    model = pieces.PieceModel(pieces.default_model())
    found, rare = pieces.frequent_chunks(docs, least=1)
    assert found["chunk"].to_pylist()[:2] == ["▁a", "▁b"] and rare == 0
    assert dict(zip(*found.to_pydict().values(), strict=True)) == {c: model.segment(c) for c in ("▁a", "▁b", ",", "\n", "b")}
    found, rare = pieces.frequent_chunks(docs, least=2)
    assert found["chunk"].to_pylist() == ["▁a", "▁b"] and rare == 3


def test_empty_table(spark):
    assert pieces.piece_documents(odd(spark).where("false")).count() == 0


def test_op11_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = pieces.op11_pieces(spark, SF).collect()
    assert len(got) == len(docs) and all(tuple(r)[1:] == expected(library, docs[r.doc_id]) for r in got)


def test_a_model_of_ones_own_is_shipped(spark, tmp_path, library):
    with open(pieces.default_model(), "rb") as f:
        (tmp_path / "own.model").write_bytes(f.read())
    got = pieces.piece_documents(table(spark, [(1, "some words")]).withColumn("codes", F.lit(1)), str(tmp_path / "own.model")).first()
    assert got.ids == library.encode("some words", add_bos=True, add_eos=True)
