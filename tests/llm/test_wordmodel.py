import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import wordmodel as M
from footfall.llm.langid import held_out
from tests.llm.conftest import words

PIECES = [M.MARK.encode(), (M.MARK + "a").encode(), b"ab", b"b", b"abc", "é".encode(), b"ca", (M.MARK + "ab").encode()]


def all_segmentations(word, logs):
    """Sum over every way to cut the word into pieces, by plain recursion."""
    if not word:
        return 1.0, {p: 0.0 for p in logs}
    total, uses = 0.0, Counter()
    for piece, value in logs.items():
        if word.startswith(piece):
            rest, inner = all_segmentations(word[len(piece):], logs)
            share = math.exp(value) * rest
            total += share
            uses[piece] += share
            for p, n in inner.items():
                uses[p] += math.exp(value) * n
    return total, uses


@pytest.mark.parametrize("texts", [["a", "abc", "abcab", "é", "xéa", "bb"], ["ab" * 5] * 3 + ["c"]])
def test_recursions_equal_enumeration(texts):
    lattice = M.Lattice(PIECES)
    logs = dict(zip(lattice.pieces, lattice.logs, strict=True))
    marked = [(M.MARK + t).encode() for t in texts]
    got = lattice.log_sums(marked)
    expected = Counter()
    weights = np.arange(1.0, len(marked) + 1)
    for word, weight, value in zip(marked, weights, got, strict=True):
        total, uses = all_segmentations(word, logs)
        assert math.isclose(value, math.log(total), rel_tol=1e-9)
        for piece, n in uses.items():
            expected[piece] += weight * n / total
    found, gained = lattice.expected(marked, weights)
    assert math.isclose(gained, float(got @ weights), rel_tol=1e-9)
    for piece, n in zip(lattice.pieces, found, strict=True):
        assert math.isclose(n, expected[piece], rel_tol=1e-9, abs_tol=1e-12)


def test_long_words_of_mixed_lengths(monkeypatch):
    lattice = M.Lattice(PIECES)
    rng = np.random.default_rng(1)
    some = [bytes(rng.choice(list(b"abc"), n).tolist()) for n in [1, 700, 3, 40, 40, 2, 5000, 9] * 40]
    whole = lattice.log_sums(some)
    monkeypatch.setattr(M, "_BATCH_CELLS", 1)
    assert np.allclose(whole[:16], [lattice.log_sums([w])[0] for w in some[:16]])
    assert np.isfinite(whole).all()


def brute(rows, pieces):
    training = [t for i, t in rows if i % 7 != 2]
    counts = Counter(w for t in training for w in words(t))
    n, v = sum(counts.values()) + len(training), len(counts) + 1
    lattice = M.Lattice(pieces)
    own = list(counts)
    marked, weights = [(M.MARK + w).encode() for w in own], np.array([counts[w] for w in own], dtype=float)
    per_word = [lattice.log_sums(marked) @ weights / weights.sum()]
    while len(per_word) < 2 or per_word[-1] - per_word[-2] >= M.TOLERANCE:
        logs = M.Lattice.normalised(np.append(lattice.expected(marked, weights)[0] + 1, len(training) + 1))
        lattice = M.Lattice(pieces, logs[:-1])
        per_word.append(lattice.log_sums(marked) @ weights / weights.sum())
    assert len(per_word) > 3
    out = {}
    for i, t in rows:
        tokens = words(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        base += math.log10((len(training) + 1) / (n + v + 1))
        score = sum(lattice.log_sums([(M.MARK + w).encode() for w in tokens])) if tokens else 0.0
        out[i] = (len(tokens) + 1, sum(counts[w] > 0 for w in tokens) + 1, n, base, (score + logs[-1]) / math.log(10))
    return out


@pytest.mark.parametrize("frequent", [M.FREQUENT, 50])
def test_equals_brute_force(documents, monkeypatch, frequent):
    monkeypatch.setattr(M, "FREQUENT", frequent)
    some = documents.limit(60)
    wanted = brute([(r.doc_id, r.text) for r in some.collect()], M.vocabulary_pieces())
    rows = M.text_scores(some, F.col("doc_id") % 7 != 2).collect()
    assert len(rows) == len(wanted)
    for r in rows:
        assert tuple(r)[1:4] == wanted[r.doc_id][:3]
        assert np.allclose(tuple(r)[4:], wanted[r.doc_id][3:], rtol=1e-9)


def test_learning_helps_on_held_out_texts(documents):
    learned = M.text_scores(documents, ~held_out("doc_id", 7, 2)).collect()
    blank = {r.doc_id: r.score for r in M.text_scores(documents, F.lit(False)).collect()}
    held = [r for r in learned if zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
    assert held and all(r.score > blank[r.doc_id] for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in learned)


def test_odd_rows(odd_docs, no_docs):
    rows = M.text_scores(odd_docs, F.col("doc_id") < 8).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_tokens == by_id[2].n_tokens == by_id[3].n_tokens == 1
    assert by_id[1].score == by_id[2].score == by_id[3].score < 0
    assert by_id[7].n_tokens == 30_001 and by_id[8].n_known == 1
    assert len({(r.n_tokens, r.n_known, r.base_score, r.score) for r in rows if r.doc_id == 6}) == 1
    assert M.text_scores(no_docs, F.lit(True)).count() == 0
    untrained = M.text_scores(odd_docs, F.lit(None).cast("boolean")).collect()
    assert {r.n_known for r in untrained} == {0} and {r.train_tokens for r in untrained} == {0}
    assert all(math.isfinite(r.score) for r in untrained)
