import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import langid, quality
from footfall.llm.queries import op3_quality_votes
from footfall.llm.words import span_hashes


def test_votes_equal_a_full_comparison(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    voter = quality.learn(documents, documents.join(labels, "doc_id").select("text", "label"))
    texts = [r.text for r in documents.limit(40).collect()]
    got = voter.scores(pa.array(texts))
    for text, score in zip(texts, got, strict=True):
        vector = next(v for _, v in voter.vectors_of(pa.array([text])))[0]
        cosines = voter.vectors.astype(np.float64) @ vector
        near = np.argsort(-cosines)[:quality.NEIGHBOURS]
        weight = np.maximum(cosines[near], 0) ** quality.SHARPNESS
        assert abs((weight * voter.labels[near]).sum() / weight.sum() - score) < 1e-3


def test_runs_agree_and_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    rows = op3_quality_votes(spark, sf).collect()
    assert sorted(rows) == sorted(op3_quality_votes(spark, sf).collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = [r.predicted == label for r, label in held]
    bad = [r.predicted == 0 for r, label in held if label == 0]
    assert sum(right) >= 0.93 * len(right) and sum(bad) >= 0.7 * len(bad) and len(bad) > 5
    pairs = [(a.score, b.score) for a, x in held for b, y in held if x > y]
    assert sum(a > b for a, b in pairs) >= 0.95 * len(pairs)


def test_odd_rows(odd_docs, no_docs, documents):
    labelled = odd_docs.select("text", (F.col("doc_id") % 2).cast("int").alias("label"))
    voter = quality.learn(odd_docs, labelled)
    rows = quality.scored(odd_docs, voter).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {float(voter.labels.mean())}
    assert quality.scored(no_docs, voter).count() == 0
    assert quality.learn(odd_docs, labelled.where("label > 5")) is None
    assert {r.score for r in quality.scored(odd_docs, None).collect()} == {0.0}
    assert quality.learn(no_docs, labelled) is not None


def test_held_out_rule(spark):
    frame = spark.createDataFrame([(1,), (None,)], "doc_id long").select("doc_id", langid.held_out("doc_id", 5).alias("o"))
    import zlib
    assert {r.doc_id: r.o for r in frame.collect()} == {1: zlib.crc32(b"1") % 5 == 0, None: True}


def plain_features(text):
    """Damped counts by feature, word by word."""
    def hashed(raw):
        return int(span_hashes(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0])

    def shape(raw):
        kinds = re.sub(rb"[\x80-\xff]|[a-z]", b"a", re.sub(rb"[A-Z]", b"A", re.sub(rb"[0-9]", b"0", raw)))
        return re.sub(rb"(?s)(.)\1+", rb"\1", kinds)

    found = re.findall(rb"[^\x20\x09-\x0d]+", text.encode())
    forms = [hashed(shape(w)) for w in found]
    half, quarter = quality.FEATURES // 2, quality.FEATURES // 4
    seen = collections.Counter()
    for k, word in enumerate(found):
        pair = forms[(k + 1) % len(forms)] ^ (forms[k] * 3 % 2 ** 64)
        lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), word)
        seen.update([hashed(lower) % half, half + forms[k] % quarter, half + pair % quarter,
                     half + quarter + hashed(word[-3:]) % quarter])
    return {f: 1 + math.log(n) for f, n in seen.items()}


def test_scores_equal_a_plain_computation(spark):
    vocabulary = ["alpha", "Beta", "gamma9", "DELTA", "x-1", "été", "...", "omega", "Iota!", "42"]
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 30))) for _ in range(60)]
    marks = [int(k) for k in rng.integers(0, 2, 36)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    labelled = list(zip(texts, marks, strict=False)) + [(texts[0], 1 - marks[0])] * 2
    voter = quality.learn(docs, spark.createDataFrame(labelled, "text string, label int"))
    counts = [plain_features(t) for t in texts]
    seen = collections.Counter(f for own in counts for f in own)
    rows = np.zeros((len(texts), quality.FEATURES))
    for k, own in enumerate(counts):
        for f, n in own.items():
            rows[k, f] = n * (math.log((1 + len(texts)) / (1 + seen[f])) + 1)
    votes = collections.defaultdict(list)
    for text, label in labelled:
        votes[text].append(label)
    learned = list(votes)
    own = rows[[texts.index(t) for t in learned]]
    space = np.linalg.svd(own / np.linalg.norm(own, axis=1, keepdims=True), full_matrices=False)[2][:quality.DIMENSIONS]
    vectors = rows @ space.T
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    for vector, got in zip(vectors, voter.scores(pa.array(texts)), strict=True):
        cosines = vectors[[texts.index(t) for t in learned]] @ vector
        near = np.argsort(-cosines)[:quality.NEIGHBOURS]
        weight = np.maximum(cosines[near], 0) ** quality.SHARPNESS
        expected = sum(w * np.mean(votes[learned[k]]) for w, k in zip(weight, near, strict=True)) / weight.sum()
        assert got == pytest.approx(expected, abs=1e-3)


def test_a_third_of_the_labels_on_copies_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(quality, "LABELLED", 100)
    good, bad = "a fine long sentence about number {} and rivers", "BUY NOW !!! {} $$$ CLICK"
    rows = [((bad if k % 4 == 0 else good).format(k), int(k % 4 != 0)) for k in range(800)] + [(good.format(1), 0)] * 400
    labelled = spark.createDataFrame(rows, "text string, label int").repartition(7)
    voter = quality.learn(labelled, labelled)
    assert len(voter.labels) == 100 and len(voter.vectors) == 100
    assert sum(0 < label < 1 for label in voter.labels) <= 1
    scores = voter.scores(pa.array([good.format(k) for k in range(2, 90, 4)] + [bad.format(k) for k in range(0, 90, 4)]))
    assert min(scores[:22]) > 0.8 and max(scores[22:]) < 0.2
    numbered = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "doc_id long, text string, label int")
    by_id = quality.learn_by_id(numbered.select("doc_id", "text"), numbered.select("doc_id", "label"))
    assert (by_id.labels == voter.labels).all() and (by_id.vectors == voter.vectors).all()
    again = quality.learn(labelled, labelled.repartition(3))
    assert (again.labels == voter.labels).all() and (again.vectors == voter.vectors).all()
