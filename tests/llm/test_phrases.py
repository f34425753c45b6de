import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import phrases


def brute_force(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            own = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(own)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(own[i:i + k])) for i in range(len(own) - k + 1))
    candidates = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    dropped = {(lang, p[i:j]) for (lang, p), f in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
               if j - i < len(p) and 100 * f >= 100 * counts[lang, p[i:j]]}
    out = []
    for lang in totals:
        own = []
        for (other, p), a in candidates.items():
            if other == lang and (lang, p) not in dropped:
                cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                own.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, totals[lang], -score)
                for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], start=1)]
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(25)]
    fixed = [" ".join(rng.choices([f"r{i}" for i in range(40)], k=rng.randint(2, 7))) for _ in range(15)]
    rows = []
    for _ in range(n):
        parts = rng.choices(common, weights=[1 / (i + 1) for i in range(25)], k=rng.randint(3, 30))
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts)), rng.choice(fixed))
        text = "".join(p + rng.choice([" ", " ", " ", ", ", "\t", ".\n", "  ", "! "]) for p in parts)
        rows.append((rng.choice(["en", "en", "en", "de", None]), text.title() if rng.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize("top,shares", [(10, (0.05, 0.2, 1.0)), (2000, (0.1, 1.0)), (40, (1.0,)), (3, (0.01, 0.3, 0.6, 1.0))])
def test_equals_brute_force(spark, top, shares):
    """Whatever is opened first, and where languages settle in different rounds."""
    rows = corpus(top)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    found = phrases.collocations(docs, 8, 5, top, shares).collect()
    assert sorted(tuple(r) for r in found) == brute_force(rows, 8, 5, top) and len(found) >= 6


def test_early_rounds_settle(spark, monkeypatch):
    """With few wanted, the last share is not opened."""
    opened = []
    grown = phrases._grown
    monkeypatch.setattr(phrases, "_grown", lambda *a: opened.append(1) or grown(*a))
    rows = [("en", t) for _, t in corpus(5)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = phrases.collocations(docs, 8, 5, 2, (0.3, 0.6, 1.0)).collect()
    assert sorted(tuple(r) for r in found) == brute_force(rows, 8, 5, 2) and len(opened) < 3


def test_small_maps(spark, monkeypatch):
    """Marks set by chance change nothing."""
    monkeypatch.setattr(phrases, "MAP_BITS", 7)
    marks = phrases.Bitmap(spark.range(50).selectExpr("xxhash64(id) AS key"), "key")
    assert len(marks.bits) == 2
    rows = corpus(11, 150)
    found = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), 5, 4, 50).collect()
    assert sorted(tuple(r) for r in found) == brute_force(rows, 5, 4, 50)


class Odd:
    """Marks odd keys."""

    def __getitem__(self, keys):
        return keys % 2 == 1


class Every:
    def __getitem__(self, keys):
        return np.ones(len(keys), dtype=bool)


def test_runs_that_end_inside_phrases(monkeypatch):
    keys = np.random.default_rng(1).integers(0, 6, 500).astype(np.uint64)
    batch = pa.RecordBatch.from_arrays([pa.array([keys[:200].tobytes(), b"", keys[200:].tobytes()], pa.binary())], ["stream"])

    def all_of(k):
        return sorted(zip(*(np.concatenate(x).tolist() for x in zip(*(x[1:] for x in phrases._grams(batch, [k], Odd(), [Every()] * 4)), strict=True)), strict=True))

    whole = {k: all_of(k) for k in (2, 3, 5)}
    monkeypatch.setattr(phrases, "TOKENS", 17)
    assert {k: all_of(k) for k in (2, 3, 5)} == whole
    assert len(whole[3]) == sum(keys[i:i + 3].all() and bool(keys[i] % 2 or keys[i + 2] % 2) for i in range(498))


def test_exact_beyond_64_bits(spark):
    """a * n alone fits, a thousand times that does not: counts as they would come from a large corpus."""
    grown = spark.createDataFrame(
        [("en", "x", 1, 3_000_000_000), ("en", "y", 1, 2_999_999_999), ("en", "x y", 2, 2_999_999_998)], "lang string, phrase string, k int, f long")
    limits = spark.createDataFrame([("en", 9_000_000_000_000, 9_000_000_000, -1)], "lang string, n long, limit long, bound long")
    row = phrases._scored(grown, limits).collect()[0]
    assert row.score == 1000 * 2_999_999_998 * 9_000_000_000_000 // (3_000_000_000 * 2_999_999_999)


def test_odd_rows(spark, odd_docs, no_docs):
    assert phrases.collocations(no_docs).collect() == []
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    found = phrases.collocations(odd_docs, 2).collect()
    assert sorted(tuple(r) for r in found) == brute_force(rows, 2, 5, 2000) and found
    assert phrases.collocations(odd_docs.where("text IS NULL OR text = ''")).collect() == []
