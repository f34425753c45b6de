import random

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import words as W
from tests.llm.conftest import shingle_set


@pytest.mark.parametrize("block, chunk", [(64, 200), (1 << 18, 1 << 21)])
def test_shingles_are_the_texts_sets(monkeypatch, block, chunk):
    monkeypatch.setattr(W, "BLOCK", block)
    random.seed(block)
    texts = ["".join(random.choice("ab \nZé.\t ") for _ in range(random.choice([0, 1, 3, 10, 50, 300])))
             for _ in range(200)] + [None, "a" * 1000, "A b C d e F", " "]
    monkeypatch.setattr(W, "CHUNK", chunk)
    seen, rows = {}, 0
    for i, j, values, before in W.text_shingles(pa.array(["skipped", *texts])[1:]):
        for k in range(i, j):
            own = shingle_set(texts[k])
            got = values[before[k - i]:before[k - i + 1]]
            assert len(got) == len(own)
            assert seen.setdefault(tuple(got.tolist()), own) == own
            rows += 1
    assert rows == len(texts)
    assert len({frozenset(s) for s in seen.values()}) == len(seen)


def test_span_hashes_tell_spans_apart():
    data = np.frombuffer(b"ab ab abc", np.uint8)
    a, b, c, d = W.span_hashes(data, np.array([0, 2, 5, 6]), np.array([2, 5, 6, 9]))
    assert len({a, b, c, d}) == 4
    assert W.span_hashes(data, np.array([0, 3]), np.array([2, 5]))[1] == a
