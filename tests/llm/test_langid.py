import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from footfall.llm import langid


def brute_bits(training, text):
    """Code length by following the definition byte by byte."""
    counts = defaultdict(Counter)
    for t in training:
        data = b"\n" * langid.ORDER + t.lower().encode()
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER + 1):
                counts[k, data[i - k:i]][data[i]] += 1
    data, total = b"\n" * langid.ORDER + text.lower().encode(), 0.0
    for i in range(langid.ORDER, len(data)):
        for k in range(langid.ORDER, -2, -1):
            if k < 0:
                total += 8.0
                break
            own = counts.get((k, data[i - k:i]))
            if own is None:
                continue
            size = sum(own.values()) + len(own)
            if data[i] in own:
                total -= math.log2(own[data[i]] / size)
                break
            total -= math.log2(len(own) / size)
    return total


def test_code_lengths(spark, monkeypatch):
    texts = {"en": ["The cat sat on the mat. The dog!", "a hat that the cat had"], "fr": ["Le chat été là, le chien"]}
    rows = [(t, name) for name, own in texts.items() for t in own]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    asked = ["The cat", "le chat là", "zzz 日本 q", "", "x"]
    monkeypatch.setattr(langid, "_CELL_BLOCK", 10)
    bits, sizes = model.bits(pa.array(asked))
    assert model.names == ["en", "fr"] and sizes.tolist() == [len(t.encode()) for t in asked]
    for row, text in zip(bits, asked, strict=True):
        for got, name in zip(row, model.names, strict=True):
            assert math.isclose(got, brute_bits(texts[name], text), rel_tol=1e-5, abs_tol=1e-4)


def test_held_out_accuracy(documents):
    out = langid.held_out("doc_id", 5)
    model = langid.learn(documents.where(~out))
    found = langid.identify(documents.where(out), model)
    assert found.where("lang_pred = lang").count() >= 0.97 * found.count()
    assert found.where("score < 0 or score > 1 or score is null").isEmpty()
    kept = langid.accepted(found)
    assert kept.count() == found.count()


def test_odd_rows(odd_docs, no_docs, documents):
    model = langid.learn(documents)
    found = langid.identify(odd_docs, model)
    assert found.columns == [c for c in odd_docs.columns if c != "score"] + ["lang_pred", "score", "bits_per_byte"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {1, 2, 3, 9} and all(r.score == 0 and r.bits_per_byte is None for r in rows if r.doc_id in und)
    assert all(0 < r.score <= 1 for r in rows if r.doc_id not in und)
    assert langid.identify(no_docs, model).count() == 0
    unknown = langid.identify(odd_docs, langid.learn(no_docs)).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}
    assert langid.accepted(found).where(F.col("doc_id").isin(1, 2, 3, 9)).isEmpty()


def learned_bytes(model):
    return {name: int(n.sum()) for name, (_, n) in zip(model.names, model.grams, strict=True)}


def test_every_language_is_learned_up_to_the_bound(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 4_000)
    monkeypatch.setattr(langid, "TEXT_BYTES", 250)
    rows = [(f"{i} " + "a" * 10_000, "five") for i in range(5)]
    rows += [("b" * 100_000, "one long")] + [(f"{i:03d} short one", "one long") for i in range(200)]
    rows += [("c c c", "copies")] * 10_000 + [("d d", "copies"), ("e", "copies")]
    rows += [(f"{i:05d} text of a large language", "many") for i in range(20_000)]
    rows += [("f" * 300, "short"), ("g" * 300, "short")]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    found = learned_bytes(model)
    assert found["five"] == 4_000 and found["copies"] == 9 and found["short"] == 600
    assert 4_000 - 1 <= found["one long"] <= 4_000
    assert 4_000 <= found["many"] <= 4_000 + 250


def test_long_texts_share_the_room():
    assert langid._level([10, 100, 100], 110) == 50 and langid._level([5, 6], 10) == 5 and langid._level([7], 3) == 3


def test_many_languages_keep_every_context(spark):
    """40 languages over nearly all byte values: a dense table of them would exceed any sensible number of cells."""
    texts = {f"{i:02d}": ["".join(chr(0x4E00 + (937 * i + 71 * k * k) % 20000) for k in range(200)) + f" word{i} " * 20]
             for i in range(40)}
    model = langid.learn(spark.createDataFrame([(t, name) for name, own in texts.items() for t in own],
                                               "text string, lang string"))
    for (grams, _), seen in zip(model.grams, model.tables()[1], strict=True):
        for order in range(langid.ORDER + 1):
            assert len(seen[order]) == len(np.unique(grams & ((1 << (8 * order + 8)) - 1)))
    asked = [texts["07"][0][:90], texts["31"][0][20:99]]
    bits, _ = model.bits(pa.array(asked))
    assert [model.names[k] for k in bits.argmin(axis=1)] == ["07", "31"]
    for row, text in zip(bits, asked, strict=True):
        for got, name in zip(row, model.names, strict=True):
            assert math.isclose(got, brute_bits(texts[name], text), rel_tol=1e-5)


def test_rare_contexts_of_a_small_language_are_kept():
    """Many bytes and languages, with counts that put the small language's contexts last."""
    rng = np.random.default_rng(3)
    grams = {f"l{i:03d}": (np.unique(rng.integers(0, 1 << 32, 3_000)), None) for i in range(100)}
    grams = {name: (g, np.full(len(g), 50.0 if name != "l099" else 1.0)) for name, (g, _) in grams.items()}
    model = langid.Model(grams)
    own, n = model.grams[model.names.index("l099")]
    cost = model._gram_costs(own.astype(np.uint32), model.names.index("l099"))
    distinct = np.unique(own >> 8, return_counts=True, return_inverse=True)
    assert np.allclose(cost, -np.log2(n / (2 * distinct[2][distinct[1]])))


def test_long_texts_are_sampled_from_beginning_to_end(spark):
    texts = [("a" * 900 + "é" * 900 + "z" * 900,), ("short",), ("é" * 4,)]
    frame = spark.createDataFrame(texts, "text string")
    got = [r[0] for r in frame.select(langid._windows(F.col("text"), F.lit(800).cast("long"))).collect()]
    assert got[1:] == ["short", "é" * 4]
    assert got[0][:50] == "a" * 50 and got[0][-50:] == "z" * 50 and "é" * 50 in got[0]
    assert 500 <= len(got[0].encode()) <= 1_000
