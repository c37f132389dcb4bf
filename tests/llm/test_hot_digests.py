"""Revisits of payloads that many records share."""

import collections

import pytest
from pyspark.sql import functions as F

from quire.llm import warc


@pytest.mark.parametrize("least", [5, 200])
def test_hot_digests_are_resolved_as_others(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "MIN_HOT", least)
    rows = [(f"a{i % 3}", i, i, 2000 if i % 4 else 10, f"d{0 if i % 3 else i % 40}-{bool(i % 4)}") for i in range(400)]
    rows += [("b", 1, None, 3000, "none"), ("b", 2, None, 3000, "none"), ("b", 3, 7, None, None)]
    index = spark.createDataFrame(rows, warc.INDEX).repartition(3)
    got = {(r.archive, r.record): r.o_page for r in warc.resolve(index).collect()}
    groups = collections.defaultdict(list)
    for r in rows:
        if (r[3] or 0) >= 1000:
            groups[r[4]].append(r)
    assert len(got) == len(rows)
    for r in rows:
        if r[2] is None:
            continue
        best = max((x[2] for x in groups[r[4]]), default=None) if (r[3] or 0) >= 1000 else None
        assert got[r[0], r[1]] == (None if best is None or best == r[2] else best)
    assert warc.resolve(index.where(F.lit(False))).count() == 0
