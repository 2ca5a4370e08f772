"""The tokenizer's known units take little memory and give the rows of `Seen`."""

import tracemalloc

import numpy as np

from stayline.llm import packing, texts


def test_same_rows_as_seen():
    draw, flat, plain = np.random.default_rng(5), packing.KnownUnits(), texts.Seen()
    for size in (0, 1, 50, 400, 400):
        keys = np.unique(draw.integers(0, 600, size).astype(np.uint64) * np.uint64(1 << 54))
        for a, b in zip(flat.places(keys), plain.places(keys)):
            assert a.tolist() == b.tolist()


def test_a_unit_takes_few_bytes(monkeypatch):
    monkeypatch.setattr(packing.WordTokenizer, "__init__", lambda self: self._clear())
    seen = packing.WordTokenizer().seen
    keys = np.arange(200_000, dtype=np.uint64) << np.uint64(40)
    tracemalloc.start()
    try:
        seen.places(keys)
        assert tracemalloc.get_traced_memory()[0] < 32 * len(keys)
    finally:
        tracemalloc.stop()
