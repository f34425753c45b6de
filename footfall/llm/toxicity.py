"""Toxic passages as maximum-scoring segments of token log-odds, calibrated by extreme values.

A token's score is the log-odds that a text that has it is toxic, less the log-odds of any text, less ``DRIFT``, so that
ordinary tokens score below zero. The rate of a token is a posterior mean under a Dirichlet prior of weight ``PRIOR``
centred on the rate of its beginning, which has such a prior centred on a shorter beginning, and so on to the rate of all
texts: a word seen once or twice leans on what begins like it. Texts are counted, not occurrences, each text once.

All maximal segments of a text (those that cannot be widened or split to score more) are found in one scan with a
stack, in time linear in its tokens. The best segment of N ordinary tokens scores s or more with probability
1 - exp(-K N exp(-l s)); l and K are the most likely ones for non-toxic texts held back from the counting. Several
segments count together, those of equal text once and all after the first only if their normalised score is above
``NOTABLE``: the sum of the r best has the tail exp(-t) t^(r-1) / (r! (r-1)!). The
least of these p-values, 2^-r of the error for each r, becomes a probability by the bound 1 / (-e p ln p) on the odds
that evidence of this strength can give, from the share of toxic labels on.

Bounds: at most ``LABELLED`` labelled rows are learned from, chosen by a hash of their ids; counts are kept in
2^``BUCKET_BITS`` buckets, so the broadcast model has at most 50 MB.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.storage import map_arrow, stored
from footfall.llm.words import PUNCTUATED, chunks, mix, odd_numbers, span_hashes, text_buffer, word_spans

LABELLED = 30_000
BUCKET_BITS = 22
BEGINNINGS = (4, 5, 6, 7, 8)
PRIOR = 12.0
DRIFT = 1.0
HIGHEST = 6.0
NOTABLE = 2.0
SIGNIFICANT = 0.05
THRESHOLD = 0.3

_SALTS = odd_numbers(301, len(BEGINNINGS) + 1)


def _folded(data: np.ndarray) -> np.ndarray:
    """The UTF-8 bytes with A-Z and the capitals of the second Latin block (C3 80 to C3 9E) in lower case."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[capital] += 32
    return out


def _tokens(column: pa.Array) -> Iterator[tuple]:
    """For each run of texts [i, j): bytes, where texts begin, where tokens begin and end, tokens before each text, the
    number of each token among the distinct ones, and of those the buckets, a row per beginning, -1 where there is none."""
    data, starts = text_buffer(column)
    for i, j in chunks(starts):
        part, own = _folded(data[starts[i]:starts[j]]), starts[i:j + 1] - starts[i]
        hashes, begin, end, before = word_spans(part, own, False, PUNCTUATED)
        _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        order = np.argsort(first)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        a, b = begin[first[order]], end[first[order]]
        buckets = np.full((len(_SALTS), len(order)), -1, dtype=np.int64)
        for row, (size, salt) in enumerate(zip((*BEGINNINGS, None), _SALTS, strict=True)):
            longer = np.flatnonzero(b - a > size) if size else np.arange(len(a))
            if len(longer):
                stop = a[longer] + size if size else b
                code = mix(span_hashes(part, a[longer], stop) ^ salt)
                buckets[row, longer] = (code >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        yield i, j, part, own, begin, end, before, place[number], buckets


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts each bucket occurs."""
    for batch in batches:
        labels = batch.column("label").to_numpy()
        for i, j, _, _, _, _, before, number, buckets in _tokens(batch.column("text")):
            text = np.repeat(np.arange(j - i), np.diff(before))
            size = max(1, buckets.shape[1])
            text, word = np.divmod(np.unique(text * size + number), size)
            seen = buckets[:, word]
            code = np.unique((text + (seen << 32))[seen >= 0])
            bucket, toxic = code >> 32, labels[i:j][code & 0xFFFFFFFF] == 1
            own, at = np.unique(bucket, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(np.bincount(at, weights=toxic, minlength=len(own)).astype(np.int64)),
                 pa.array(np.bincount(at, weights=~toxic, minlength=len(own)).astype(np.int64))], ["bucket", "toxic", "other"])


def maximal_segments(left: list[float], right: list[float]) -> list[tuple[int, int]]:
    """Of runs of positive scores, with the sums of all scores before and after each: all maximal segments.

    Each is given as its first and last run. Every run is pushed once, and merged once at most.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # first run, last run, sum before, sum after, the lower one below
    for run, (low, high) in enumerate(zip(left, right, strict=True)):
        first, last = run, run
        below = len(stack) - 1
        while True:
            while below >= 0 and stack[below][2] >= low:
                below = stack[below][4]
            if below < 0 or stack[below][3] >= high:
                stack.append((first, last, low, high, below))
                break
            first, _, low, _, under = stack[below]
            del stack[below:]
            below = under
    return [(first, last) for first, last, *_ in stack]


class Model:
    """Counts of texts by bucket, and the extreme-value law of ordinary texts."""

    def __init__(self, buckets: np.ndarray, toxic: np.ndarray, other: np.ndarray, share: float,
                 decay: float = 1.0, scale: float = 1.0) -> None:
        self.buckets, self.toxic, self.other = buckets, toxic, other
        self.share, self.decay, self.scale = share, decay, scale
        self._dense: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dense": None}

    def token_scores(self, buckets: np.ndarray) -> np.ndarray:
        """Scores of distinct tokens, given by their buckets."""
        if self._dense is None:
            dense = np.zeros((2, 1 << BUCKET_BITS), dtype=np.float32)
            dense[0, self.buckets], dense[1, self.buckets] = self.toxic, self.other
            self._dense = dense[0], dense[1]
        rate = np.full(buckets.shape[1], self.share)
        for row in buckets:
            toxic, other = (np.where(row >= 0, table[row], 0.0) for table in self._dense)
            rate = (toxic + PRIOR * rate) / (toxic + other + PRIOR)
        odds = np.log(rate / (1 - rate)) - math.log(self.share / (1 - self.share))
        return np.minimum(odds, HIGHEST) - DRIFT

    def p_value(self, scores: list[float], n: int) -> float:
        """Of segment scores of one text, falling, among ``n`` tokens."""
        least, total = 1.0, 0.0
        for r, score in enumerate(scores, start=1):
            own = self.decay * score - math.log(self.scale * n)
            if r > 1 and own <= NOTABLE:
                break
            total += own
            if r == 1:
                tail = -math.expm1(-math.exp(-total))
            else:
                tail = math.exp(-total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r))
            least = min(least, tail * 2.0 ** min(r, 1000) / 2)
        return max(least, 1e-300)

    def probability(self, p: float) -> float:
        if p >= math.exp(-1):
            return self.share * (1 - p) / (1 - math.exp(-1))
        against = -math.e * p * math.log(p) * (1 - self.share)
        return self.share / (self.share + against)

    def segments(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, dict[int, list[tuple[float, int, int]]]]]:
        """From text ``i`` on: bytes, token counts, and of texts that have any their segments (score, first byte within the
        text, end)."""
        for i, j, part, own, begin, end, before, number, buckets in _tokens(column):
            score = self.token_scores(buckets)[number]
            found: dict[int, list[tuple[float, int, int]]] = {}
            positive = score > 0
            if positive.any():
                cuts = np.zeros(len(score) + 1, dtype=bool)
                cuts[1:-1] = positive[1:] != positive[:-1]
                cuts[before] = True
                edges = np.flatnonzero(cuts | (np.arange(len(score) + 1) == len(score)) | (np.arange(len(score) + 1) == 0))
                starts, ends = edges[:-1], edges[1:]
                up = positive[starts]
                starts, ends = starts[up], ends[up]
                sums = np.concatenate([[0.0], np.cumsum(score)])
                text = np.searchsorted(before, starts, side="right") - 1
                new = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]])).tolist() + [len(text)]
                low, high = sums[starts].tolist(), sums[ends].tolist()
                first, last = begin[starts].tolist(), end[ends - 1].tolist()
                for a, b in zip(new[:-1], new[1:], strict=True):
                    at = int(text[a])
                    shift = int(own[at])
                    found[at] = sorted(((high[a + y] - low[a + x], first[a + x] - shift, last[a + y] - shift)
                                        for x, y in maximal_segments(low[a:b], high[a:b])), key=lambda s: (-s[0], s[1]))
            yield i, part, own, np.diff(before), found


def _extremes(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text its tokens and its best segment's score, 0 without one."""
    for batch in batches:
        for _, _, _, sizes, found in model.value.segments(batch.column("text")):
            best = [found[k][0][0] if k in found else 0.0 for k in range(len(sizes))]
            yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(best, pa.float64())], ["n", "best"])


def extreme_value_law(n: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """The most likely decay and scale, given token counts and best scores, where 0 stands for no segment at all."""
    above = best > 0
    if not above.any() or n.sum() == 0:
        return 1.0, 1.0 / max(1.0, float(n.sum()))

    def scale(decay: float) -> float:
        return float(above.sum() / (n * np.exp(-decay * best)).sum())

    decays = np.exp(np.linspace(math.log(0.02), math.log(20), 2000))
    likely = [above.sum() * (math.log(d) + math.log(scale(d))) - d * best[above].sum() for d in decays]
    decay = float(decays[int(np.argmax(likely))])
    return decay, scale(decay)


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, label 0 or 1) marks.

    Three quarters of the sample are counted, the rest fit the extreme-value law. Of equal texts one counts, and is toxic
    if any of them is. None if there are not both labels.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = stored(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED), "labelled")
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text <> ''").join(
        F.broadcast(sample), "doc_id").groupBy(F.xxhash64("text").alias("hash")).agg(
        F.min("text").alias("text"), F.max("label").alias("label")), "texts")
    held = F.pmod(F.col("hash"), F.lit(4)) == 0
    sizes = {row["label"]: row["n"] for row in texts.where(~held).groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    counted = map_arrow(texts.where(~held).select("text", "label"), _count, "bucket long, toxic long, other long").groupBy(
        "bucket").agg(F.sum("toxic").cast("int").alias("toxic"), F.sum("other").cast("int").alias("other")).where(
        "toxic > 0 OR other > 1").toArrow()
    model = Model(*(counted.column(c).to_numpy().astype(np.int32) for c in ("bucket", "toxic", "other")),
                  sizes[1] / (sizes[0] + sizes[1]))
    shared = spark.sparkContext.broadcast(model)
    seen = map_arrow(texts.where(held & (F.col("label") == 0)).select("text"), lambda it: _extremes(shared, it),
                     "n long, best double").where("n > 0").toArrow()
    model.decay, model.scale = extreme_value_law(seen.column("n").to_numpy(), seen.column("best").to_numpy())
    return model


def _characters(part: np.ndarray, at: list[int]) -> list[int]:
    """Code points before the byte positions given."""
    heads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
    return heads[at].tolist()


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted and passages (begin, end in code points, score, p_value) of every row of ``docs``.

    ``docs`` has doc_id and text; other columns are not used. Passages are the maximal segments whose own p-value is at
    most ``SIGNIFICANT``, in order of their place. A text that is NULL, empty or without a word scores 0, as does every
    text without a model. Repeated rows score alike; whole texts are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ("doc_id long, score double, predicted int, "
              "passages array<struct<begin: long, end: long, score: double, p_value: double>>")
    if model is None:
        empty = F.array().cast("array<struct<begin: long, end: long, score: double, p_value: double>>")
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), empty.alias("passages"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("p_value", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for i, part, starts, sizes, found in own.segments(batch.column("text")):
                values, passages = np.zeros(len(sizes)), [[] for _ in sizes]
                for k, segments in found.items():
                    n = int(sizes[k])
                    once = {part[starts[k] + a:starts[k] + b].tobytes(): s for s, a, b in reversed(segments)}
                    values[k] = own.probability(own.p_value(sorted(once.values(), reverse=True), n))
                    marked = sorted((a, b, s, p) for s, a, b in segments if (p := own.p_value([s], n)) <= SIGNIFICANT)
                    if marked:
                        ends = _characters(part[starts[k]:starts[k + 1]], [x for a, b, _, _ in marked for x in (a, b)])
                        passages[k] = [{"begin": ends[2 * q], "end": ends[2 * q + 1], "score": s, "p_value": p}
                                       for q, (_, _, s, p) in enumerate(marked)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:i + len(sizes)], pa.array(values),
                     pa.array((values >= THRESHOLD).astype(np.int32)), pa.array(passages, kind)],
                    ["doc_id", "score", "predicted", "passages"])

    return map_arrow(rows, score, schema)
