import math
import random

import pyarrow as pa
import pytest

from footfall.llm import negatives


def brute_force(rows, every=100):
    own = {(i, (lab + 1) % 10 if i % 7 == 0 else lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
           if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i, lab, a in own:
        if i % every:
            continue
        found = [(-sum(x * y for x, y in zip(a, b, strict=False)), j, other) for j, other, b in own if j != i]
        positives = sorted({(s, j) for s, j, other in found if other == lab})[:5]
        for s, j in positives:
            inside = sorted({(t, k) for t, k, other in found if other != lab and 30 * -s <= 100 * -t <= 90 * -s})[:10]
            out |= {(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(inside, start=1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("scale", [1.0, 3e5, 1e12])
def test_equals_brute_force(spark, scale):
    """Also where fields are wider than a machine word."""
    rng = random.Random(int(scale))
    rows = [(i, [rng.gauss(0.02, 0.1) * (scale if scale < 1e9 else rng.choice([1, 1e3])) for _ in range(12)], rng.choice([1, 1, 1, 2, 3]))
            for i in rng.sample(range(900), 400)]
    found = negatives.hard_negatives(frame(spark, rows), 20).collect()
    assert {tuple(r) for r in found} == brute_force(rows, 20) and len(found) == len(set(found)) > 50


def test_ties_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "FIELDS", 5)
    rng = random.Random(8)
    rows = [(i, [rng.choice([0.0, 0.25, 0.5]) for _ in range(4)], i % 3) for i in range(200)]
    rows += rows[:50] + [(1000 + i, [0.25] * 4, 1) for i in range(80)]
    found = negatives.hard_negatives(frame(spark, rows), 20).collect()
    assert {tuple(r) for r in found} == brute_force(rows, 20) and len(found) == len(set(found))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [0.5, 0.5], 1), (100, None, 1), (200, [0.5, None], 1), (300, [nan, 0.5], 1), (400, [0.5, inf], 1),
            (500, [0.5, 0.5], None), (600, [], 1), (700, [0.5, 0.5], 1), (701, [0.5, 0.5, 0.5], 2), (702, [0.5], 2),
            (703, [0.3, 0.4], 0), (704, [-0.5, -0.5], 2), (705, [0.2, 0.2], 0), (800, [0.0, 0.0], 5), (801, [0.0], 5)]
    found = negatives.hard_negatives(frame(spark, rows).selectExpr("*", "'x' AS rank", "1 AS score")).collect()
    assert {tuple(r) for r in found} == brute_force(rows)
    assert negatives.hard_negatives(frame(spark, []).selectExpr("*")).count() == 0


def test_packed_products_are_exact():
    rng = random.Random(2)
    for reach, top in ((1, 1), (255, 255), (1 << 20, 1 << 20), (1 << 70, 1 << 65), (0, 5), (5, 0)):
        vectors = [[rng.randint(-top, top) for _ in range(9)] for _ in range(33)]
        anchor = [rng.randint(-reach, reach) for _ in range(9)]
        limit = (1 << 63) - 1
        wanted = [max(-limit, min(limit, sum(x * y for x, y in zip(anchor, v, strict=True)))) for v in vectors]
        assert negatives.Packed(vectors, 9, reach).scores(anchor).tolist() == wanted


def test_floor_of_components():
    assert negatives.integer_vectors(pa.array([[0.5, -0.001], None, [], [1e30]])) == [[128, -1], [], [], [int(256 * 1e30)]]
