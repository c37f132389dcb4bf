"""Windows that shards of one anchor publish travel in packed pieces."""

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import suffix


def found(texts, salts, pieces):
    rows = [(7, salts[i], i, 0, 0, len(t) - suffix.LENGTH + 1, t) for i, t in sorted(enumerate(texts), key=lambda x: salts[x[0]])]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), suffix._CONTEXT_KINDS, strict=True)], names=suffix._CONTEXT_NAMES)
    return [r for b in suffix._shards(300, pieces)(iter([batch])) for r in b.to_pylist()]


@pytest.mark.parametrize("pieces", [1, 4, 16])
def test_pieces_of_runs_find_what_shards_share(pieces):
    rng = np.random.default_rng(2)
    text = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    shared = text(230)
    texts = [text(int(rng.integers(0, 60))) + shared + text(int(rng.integers(0, 60))) for _ in range(60)]
    rows = found(texts, [i % 20 for i in range(60)], pieces)
    packed = [r for r in rows if r["windows"] is not None]
    assert len(packed) <= 20 * pieces < sum(len(r["windows"]) for r in packed) // suffix._W.itemsize  # few rows, many windows
    packed.sort(key=lambda r: (r["piece"], r["run"]))
    batch = pa.RecordBatch.from_pylist([{k: r[k] for k in ("piece", "run", "windows")} for r in packed])
    across = [r for b in suffix._across_pieces(iter([batch.slice(0, 3), batch.slice(3)])) for r in b.to_pylist()]
    got = [set() for _ in texts]
    for r in [*(r for r in rows if r["e"] is not None), *across]:
        got[r["t1"]] |= set(range(r["s"], r["e"]))
    count = {}
    for t in texts:
        for i in range(len(t) - 199):
            count[t[i : i + 200]] = count.get(t[i : i + 200], 0) + 1
    assert got == [{j for i in range(len(t) - 199) if count[t[i : i + 200]] > 1 for j in range(i, i + 200)} for t in texts]
