"""Languages: the kernel machine against one that is written out, and texts of any length."""

import math

import numpy as np
from pyspark.sql import functions as F

from quire.llm import language
from tests.llm.test_operators import SF


def test_nystroem_with_all_rows_is_kernel_ridge():
    """With every row a landmark the values are those of exact weighted kernel ridge regression on sets of n-grams."""
    rng = np.random.default_rng(2)
    letters = {"a": "abcdefg ", "b": "efghijk ", "c": "bdfhjlm "}
    rows = [(lang, "".join(rng.choice(list(letters[lang]), rng.integers(20, 90)))) for lang in "aabbbc" for _ in range(9)]
    sets = [frozenset(np.flatnonzero(language.spectrum(t)).tolist()) for _, t in rows]
    model = language.fit([np.packbits(language.spectrum(t)).tobytes() for _, t in rows], [a for a, _ in rows])
    assert len(model.landmarks) == len(rows)

    def kernel(x, y):
        return len(x & y) / math.sqrt(len(x) * len(y))

    k = np.array([[kernel(x, y) for y in sets] for x in sets])
    weight = np.array([1 / sum(b == a for b, _ in rows) for a, _ in rows])
    weight *= len(rows) / weight.sum()
    y = np.array([[1.0 if a == name else -1.0 for name in "abc"] for a, _ in rows])
    alpha = np.linalg.solve(k + language.RIDGE * np.diag(1 / weight), y)
    for text in ("abc def gab", "hijk efgh", "jlm bdf hj", "abefjl mk"):
        own = frozenset(np.flatnonzero(language.spectrum(text)).tolist())
        f = np.array([kernel(own, x) for x in sets]) @ alpha
        e = np.exp(language.SHARP * (f - f.max()))
        (lang, score), best = model.predict([text])[0], int(f.argmax())
        assert lang == "abc"[best] and abs(score - e[best] / e.sum()) < 1e-3


def test_texts_of_any_length(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.train(docs, ~language.held_out(4, 2))
    held = [(r.lang, r.text) for r in docs.where(language.held_out(4, 2)).select("lang", "text").collect()]
    for lang in sorted({a for a, _ in held}):
        long = "\n".join(t for a, t in held if a == lang)
        long = long * (1 + 3_000_000 // len(long))
        assert model.predict([long])[0][0] == lang
    assert "".join(language.windows("x" * 50_001)) == "x" * 50_001 and list(language.windows("")) == [""] and max(map(len, language.windows("y" * 99_999))) <= language.WINDOW


def test_windows_without_letters_do_not_count(spark):
    docs = spark.createDataFrame([(i, "the and with of to " * 9 if i % 2 else "der und mit von zu " * 9, "en" if i % 2 else "de") for i in range(40)], "doc_id long, text string, lang string")
    model = language.train(docs, F.lit(True))
    text = "der und mit von zu " * 1000
    assert [p[0] for p in model.predict([text + "1" * 60_000, None, "7" * 90_000, text])] == ["de", "und", "und", "de"]
