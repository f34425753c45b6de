import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import toxicity
from footfall.llm.queries import op11_toxic_passages


def segments_by_definition(scores):
    """Maximal segments: take the best one (shortest, first), then look left and right of it."""
    best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i = -best[2]
    j = i - best[1]
    return segments_by_definition(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in segments_by_definition(scores[j:])]


@pytest.mark.parametrize("seed", range(200))
def test_maximal_segments(seed):
    """Equal sums are avoided, as the definition does not tell such segments apart."""
    rng = random.Random(seed)
    scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.randrange(1, 1 << 20) / (1 << 30) for _ in range(rng.randint(0, 24))]
    runs, at = [], 0
    while at < len(scores):
        end = at
        while end < len(scores) and (scores[end] > 0) == (scores[at] > 0):
            end += 1
        if scores[at] > 0:
            runs.append((at, end))
        at = end
    found = toxicity.maximal_segments([sum(scores[:a]) for a, _ in runs], [sum(scores[:b]) for _, b in runs])
    assert [(runs[x][0], runs[y][1]) for x, y in found] == segments_by_definition(scores)


def test_long_scan_is_linear():
    low = [float(-k) for k in range(200_000)]
    assert len(toxicity.maximal_segments(low, [x + 0.5 for x in low])) == 200_000
    high = [float(k) for k in range(200_000)]
    assert toxicity.maximal_segments([x - 0.5 for x in high], high) == [(0, 199_999)]


def test_extreme_value_law():
    rng = np.random.default_rng(4)
    n = rng.integers(50, 3000, 20_000)
    best = np.maximum(0, (np.log(0.02 * n) - np.log(-np.log(rng.random(len(n))))) / 1.7)
    decay, scale = toxicity.extreme_value_law(n, best)
    assert abs(decay - 1.7) < 0.05 and abs(scale - 0.02) < 0.002
    assert toxicity.extreme_value_law(np.array([], int), np.array([])) == (1.0, 1.0)


def test_p_values_and_probabilities():
    model = toxicity.Model(*(np.zeros(0, np.int32),) * 3, share=0.1, decay=1.0, scale=0.01)
    falling = [model.p_value([s], 1000) for s in (0.5, 1, 2, 5, 10, 50, 5000)]
    assert falling == sorted(falling, reverse=True) and abs(model.p_value([5.0], 1000) + np.expm1(-10 * np.exp(-5.0))) < 1e-12
    assert model.p_value([6.0, 5.5], 1000) < model.p_value([6.0], 1000)
    rising = [model.probability(p) for p in (1.0, 0.5, 0.37, 0.36, 0.1, 1e-3, 1e-300)]
    assert rising == sorted(rising) and rising[0] == 0 and 0.99 < rising[-1] <= 1


def test_scores_by_plain_counting(spark):
    """Token scores and segments of a small corpus, against a loop over its texts."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["badness", "badly", "baddest", "Ünfug"]
    texts = []
    for i in range(80):
        own = rng.choices(words[:60], k=20)
        toxic = i % 4 == 0
        if toxic:
            own[rng.randrange(20)] = rng.choice(words[60:])
        texts.append((i, " ".join(own), int(toxic)))
    table = spark.createDataFrame(texts, "doc_id long, text string, label int")
    counted = toxicity.map_arrow(table.select("text", "label"), toxicity._count, "bucket long, toxic long, other long").groupBy(
        "bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).collect()
    model = toxicity.Model(*(np.array([r[c] for r in counted], np.int32) for c in ("bucket", "toxic", "other")), share=0.25)

    def plain(word):
        raw, rate = word.encode(), 0.25
        for size in (*toxicity.BEGINNINGS, None):
            if size is not None and len(raw) <= size:
                continue
            hits = [label for _, t, label in texts if any(
                (w.lower().encode()[:size] == raw[:size] and len(w.encode()) > size) if size else w.lower().encode() == raw
                for w in t.split())]
            rate = (sum(hits) + toxicity.PRIOR * rate) / (len(hits) + toxicity.PRIOR)
        return min(np.log(rate / (1 - rate)) - np.log(1 / 3), toxicity.HIGHEST) - toxicity.DRIFT

    for _, text, _ in texts[:12]:
        own = text.split()
        scores = [plain(w.lower()) for w in own]
        _, _, _, sizes, found = next(model.segments(pa.array([text])))
        assert sizes.tolist() == [20]
        ends = np.cumsum([len(w.encode()) + 1 for w in own])
        wanted = {(int(ends[a]) - len(own[a].encode()) - 1, int(ends[b - 1]) - 1): sum(scores[a:b]) for a, b in segments_by_definition(scores)}
        got = {(a, b): s for s, a, b in found.get(0, [])}
        assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-5 for k in got)


def test_held_out_texts(spark, sf):
    rows = op11_toxic_passages(spark, sf.replace("0.001", "0.1")).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows) and len(rows) == 10_000
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(sf.replace("0.001", "0.1") + "/labels.parquet").collect()}
    held = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = ([r.predicted for r, label in held if label == x] for x in (1, 0))
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.05 * len(clean) and len(toxic) > 80


def test_passages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.learn(docs, labels)
    rows = toxicity.scored(docs, model).join(docs, "doc_id").where("size(passages) > 0").collect()
    cut = [r.text[p.begin:p.end] for r in rows for p in r.passages]
    assert cut and all(c and not c[0].isspace() and not c[-1].isspace() for c in cut)
    assert any("idiot" in c or "moron" in c or "scum" in c or "trash" in c for c in cut)


def test_odd_rows(spark, odd_docs, no_docs, documents, sf):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 11)] * 2 + [(4, None), (None, 1), (99, 7)], "doc_id long, label int")
    many = documents.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    model = toxicity.learn(many, labels.unionByName(spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "toxic")
                                                    .withColumnRenamed("toxic", "label")))
    rows = toxicity.scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {0.0}
    assert toxicity.scored(no_docs, model).count() == 0
    assert toxicity.learn(no_docs, labels) is None and toxicity.learn(odd_docs, labels.where("false")) is None
    assert {r.score for r in toxicity.scored(odd_docs, None).collect()} == {0.0}


def test_sample_is_bounded(spark, documents, sf, monkeypatch):
    """A third of the labels in one group of copies; the bound holds and copies count once."""
    monkeypatch.setattr(toxicity, "LABELLED", 60)
    copies = spark.range(1000, 1100).selectExpr("id AS doc_id", "'you worthless idiot, you scum' AS text")
    docs = documents.select("doc_id", "text").unionByName(copies)
    labels = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "toxic AS label").unionByName(
        copies.selectExpr("doc_id", "1 AS label"))
    model = toxicity.learn(docs, labels)
    assert model is None or (model.toxic + model.other).max() <= 60
