import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import neardup
from footfall.llm.components import components
from tests.llm.conftest import shingle_set


def groups(sets):
    """Components by brute force over an inverted index."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    postings = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            postings[s].append(i)
    for i, own in sets.items():
        shared = Counter(j for s in own for j in postings[s] if j > i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def expect_groups(frame):
    sets = {r.doc_id: shingle_set(r.text) for r in frame.select("doc_id", "text").collect()}
    found = {r.doc_id: r for r in neardup.near_duplicates(frame).collect()}
    wanted = groups(sets)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == {
        i: (len(sets[i]), wanted[i], wanted[i] == i) for i in sets}
    return found


def test_equals_brute_force(documents):
    found = expect_groups(documents)
    assert any(not r.kept for r in found.values())


def test_dense_group_around_the_threshold(spark, monkeypatch):
    """Variants of one text, pairwise just above and below the threshold, so that stars alone miss links."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 7)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for doc in range(60):
        own = list(base)
        for at in rng.sample(range(400), rng.choice([6, 9, 12, 14])):
            own[at] = f"x{doc}_{at}"
        rows.append((doc, " ".join(own)))
    expect_groups(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.mark.parametrize("n_words,most", [(200, 14), (1400, 70)])
def test_large_group_around_the_threshold(spark, n_words, most):
    """Keys of many classes, sets on both sides of ``LEAST``: every link is found."""
    rng = random.Random(n_words)
    base, rows = [f"w{i}" for i in range(n_words)], []
    for doc in range(260):
        own = list(base)
        for at in rng.sample(range(n_words), rng.randint(most // 5, most)):
            own[at] = f"x{doc}_{at}"
        rows.append((doc, " ".join(own)))
    found = expect_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    groups_found = Counter(r.component_id for r in found.values())
    assert len(groups_found) > 10 and max(groups_found.values()) > 64


def test_classes_without_a_further_link(spark):
    """What only one set has bounds its links; the last of these sets can have none, the others can."""
    mixed = spark.createDataFrame(
        [(k, 4, 1, 80, c, c) for k in (1, 2) for c in (1, 2, 3, 4)], "key long, n long, center long, smallest long, class_id long, label long")
    sizes = {1: range(100), 2: range(86), 3: [*range(86), *range(200, 214)], 4: [*range(75), *range(300, 325)]}
    classes = spark.createDataFrame([(c, len(own)) for c, own in sizes.items()], "class_id long, n_shingles long")
    sets = spark.createDataFrame([(c, np.array(own, np.uint64).tobytes()) for c, own in sizes.items()], "class_id long, items binary")
    assert {r.class_id for r in neardup._joinable(mixed, classes, sets).collect()} == {1, 2, 3}


def test_chain_and_copies(spark):
    rows, own = [], [f"w{i}" for i in range(200)]
    for doc in range(30):
        rows += [(100 - doc, " ".join(own)), (1000 + doc, " ".join(own).upper())]
        own = own[8:] + [f"n{doc}_{k}" for k in range(8)]
    found = expect_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in found.values()} == {71}


def test_odd_rows(odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert by_id[1] == (0, 1, True) and by_id[2] == (0, 2, True) and by_id[3] == (0, 3, True)
    assert by_id[5] == (1, 5, True) and by_id[6] == (1, 5, False)
    assert by_id[None] == (2, None, True)
    assert by_id[7] == (1, 7, True) and by_id[8] == (1, 8, True)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_dropping_keeps_one_row_of_each_group(odd_docs, no_docs, documents):
    kept = neardup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, None, 7, 8, 9, 10])
    assert neardup.drop_near_duplicates(no_docs).count() == 0
    twice = documents.unionByName(documents)
    wanted = neardup.near_duplicates(documents).where("kept").select("doc_id").collect()
    assert sorted(neardup.drop_near_duplicates(twice).select("doc_id").collect()) == sorted(wanted)


@pytest.mark.parametrize("seed", [1, 2])
def test_pigeonhole_guarantee(seed):
    """Signatures within the radius always share a key."""
    rng = np.random.default_rng(seed)
    for errors in (0, 10, 30, neardup.RADIUS):
        a = rng.integers(0, 1 << 16, neardup.SYMBOLS, dtype=np.uint16)
        b = a.copy()
        at = rng.permutation(neardup.SYMBOLS)[:errors]
        b[at] ^= np.uint16(1)
        wrong = (a != b).reshape(neardup.CHUNKS, neardup.WIDTH).sum(axis=1)
        assert wrong.min() <= 1


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)]
    frame = spark.createDataFrame(links, "a long, b long")
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    wanted = {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.label for r in components(frame).collect()} == wanted
    assert components(frame.where(F.lit(False))).count() == 0
