"""Hard negatives by exact inner products of integer vectors, many candidates per multiplication.

Kronecker packing: the candidates of a block are laid side by side in wide integers, one per vector component. A
candidate's component, raised by a bias so that it is not negative, fills a field of its own, wide enough for the whole
inner product; so the anchor's component (raised likewise) times the wide integer multiplies it with that component of
all candidates at once, and no field can run over into its neighbour. The products are added over the components, the
fields read off and the biases' share, known from the vectors' sums, taken away: exact scores, whatever the components.

Anchors are taken in blocks of about ``ANCHORS``, fewer if their vectors have more than ``COMPONENTS`` components
together, which are broadcast; each block is held against all rows, where
they lie. A task returns no more of an anchor than can be among the first ones overall, and Spark merges these lists.
Nothing is shuffled but the lists, so a label that holds most of the rows is no hot spot.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.storage import map_arrow, stored

SCALE = 256
LABELS = 10
ANCHORS = 8192
COMPONENTS = 1 << 20
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT = 30
MOST_PERCENT = 90
FIELDS = 2048
_HIGH = (1 << 63) - 1


def integer_vectors(column: pa.Array) -> list[list[int]]:
    """floor(SCALE * x) of every component as exact integers; NULL vectors are empty."""
    rows = column.to_pylist()
    lengths = [len(row or ()) for row in rows]
    flat = np.floor(np.array([x for row in rows for x in row or ()], dtype=np.float64) * SCALE)
    small = not len(flat) or np.abs(flat).max() < 2.0 ** 62
    values = flat.astype(np.int64).tolist() if small else [int(x) for x in flat]
    ends = np.concatenate([[0], np.cumsum(lengths)]).tolist()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


class Packed:
    """A block of candidate vectors as one wide integer per component.

    Shorter vectors count as zero beyond their end. ``reach`` bounds the absolute value of the anchors' components.
    """

    def __init__(self, vectors: list[list[int]], width: int, reach: int) -> None:
        self.n, self.width, self.reach = len(vectors), width, reach
        full = [row + [0] * (width - len(row)) for row in vectors]
        self.bias = max((-min(row) for row in full if row), default=0)
        self.bias = max(self.bias, 0)
        top = max((max(row) for row in full if row), default=0) + self.bias
        bits = max(1, (width * top * 2 * reach).bit_length())
        self.bytes = 4 if bits <= 32 else 8 if bits <= 63 else -(-bits // 8)
        self.sums = [sum(row) for row in full]
        self.wide = [self._joined([row[k] + self.bias for row in full]) for k in range(width)]

    def _joined(self, fields: list[int]) -> int:
        if self.bytes in (4, 8):
            return int.from_bytes(np.array(fields, dtype=f"<u{self.bytes}").tobytes(), "little")
        return int.from_bytes(b"".join(x.to_bytes(self.bytes, "little") for x in fields), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The anchor's inner product with every candidate; beyond 64 bits, the nearest BIGINT."""
        total = 0
        for x, wide in zip(anchor, self.wide, strict=False):
            total += (x + self.reach) * wide
        for wide in self.wide[len(anchor):]:
            total += self.reach * wide
        # the sum of (a + r)(c + b) is a.c + b sum(a) + r sum(c) + width r b
        known = self.bias * sum(anchor[:self.width]) + self.width * self.reach * self.bias
        raw = total.to_bytes(self.n * self.bytes, "little")
        if self.bytes in (4, 8):
            fields = np.frombuffer(raw, dtype=f"<u{self.bytes}")
            if self.bytes == 4 or known.bit_length() < 62:
                return fields.astype(np.int64) - known - self.reach * np.array(self.sums, dtype=np.int64)
            exact = fields.tolist()
        else:
            exact = [int.from_bytes(raw[k:k + self.bytes], "little") for k in range(0, len(raw), self.bytes)]
        return np.array([min(max(x - known - self.reach * s, -_HIGH), _HIGH) for x, s in zip(exact, self.sums, strict=True)],
                        dtype=np.int64)


class Anchors:
    """A block of anchors: ids, labels, integer vectors and, once known, the positives (id, score) of each."""

    def __init__(self, ids: list[int], labels: list[int], vectors: list[list[int]]) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.width = max(map(len, vectors), default=0)
        self.reach = max((abs(x) for row in vectors for x in row), default=0)
        self.positives: dict[tuple[int, int], list[tuple[int, int]]] = {}


def _packs(batch: pa.RecordBatch, anchors: Anchors) -> Iterator[tuple[int, np.ndarray, Packed]]:
    """The batch's rows by label and in order of id, packed: label, ids, block."""
    ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
    order = np.lexsort((ids, labels))
    vectors = integer_vectors(batch.column("embedding"))
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    for own in np.split(order, cuts):
        for at in range(0, len(own), FIELDS):
            rows = own[at:at + FIELDS]
            block = [vectors[k][:anchors.width] for k in rows.tolist()]
            yield int(labels[rows[0]]), ids[rows], Packed(block, anchors.width, anchors.reach)


def _first(ids: np.ndarray, scores: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The first ``n`` different (score, id), given in that order."""
    out: list[tuple[int, int]] = []
    for pair in zip(scores.tolist(), ids.tolist(), strict=True):
        if not out or out[-1] != pair:
            if len(out) == n:
                break
            out.append(pair)
    return out


def _best(lists: dict, key: object, found: list[tuple[int, int]], n: int) -> None:
    if found:
        merged = sorted({*lists.get(key, ()), *found}, key=lambda pair: (-pair[0], pair[1]))
        lists[key] = merged[:n]


def _window(score: int) -> tuple[int, int]:
    """Least and largest negative score s with 30 p <= 100 s <= 90 p."""
    return -(-LEAST_PERCENT * score // 100), MOST_PERCENT * score // 100


def _own_positives(anchors: Anchors, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best: dict[int, list[tuple[int, int]]] = {}
    of_label: dict[int, list[int]] = {}
    for k, label in enumerate(anchors.labels):
        of_label.setdefault(label, []).append(k)
    for batch in batches:
        for label, ids, block in _packs(batch, anchors):
            for k in of_label.get(label, ()):
                scores = block.scores(anchors.vectors[k])
                order = np.argsort(-scores, kind="stable")
                order = order[ids[order] != anchors.ids[k]]
                _best(best, k, _first(ids[order], scores[order], POSITIVES), POSITIVES)
    rows = [(anchors.ids[k], anchors.labels[k], i, s) for k, pairs in best.items() for s, i in pairs]
    yield _rows(rows, ["anchor_id", "label", "positive_id", "positive_score"])


def _own_negatives(anchors: Anchors, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    best: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    wanted = [(k, anchors.positives.get((anchor, label), [])) for k, (anchor, label) in enumerate(
        zip(anchors.ids, anchors.labels, strict=True))]
    for batch in batches:
        for label, ids, block in _packs(batch, anchors):
            for k, positives in wanted:
                windows = [(i, s, *_window(s)) for i, s in positives]
                windows = [w for w in windows if w[2] <= w[3]]
                if not windows or anchors.labels[k] == label:
                    continue
                scores = block.scores(anchors.vectors[k])
                order = np.argsort(-scores, kind="stable")
                order = order[ids[order] != anchors.ids[k]]
                falling = -scores[order]
                for i, s, low, high in windows:
                    a, b = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
                    if a < b:
                        own = order[a:b]
                        _best(best, (k, i, s), _first(ids[own], scores[own], NEGATIVES), NEGATIVES)
    rows = [(anchors.ids[k], anchors.labels[k], i, s, j, t) for (k, i, s), pairs in best.items() for t, j in pairs]
    yield _rows(rows, ["anchor_id", "label", "positive_id", "positive_score", "negative_id", "negative_score"])


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _ranked(found: DataFrame, key: list[str], score: str, node: str, n: int) -> DataFrame:
    """Of the tasks' lists, the first ``n`` of each key with their rank; what several tasks found counts once."""
    order = Window.partitionBy(*key).orderBy(F.desc(score), node)
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, label (changed where vec_id is divisible by 7) of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"),
                          F.col("label").cast("long").alias("label"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
                      & finite).withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label")))


def hard_negatives(vectors: DataFrame, every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over the rows of ``vectors``.

    ``vectors`` has vec_id, embedding and label; other columns are not used. Rows without vec_id, label or vector, or
    with a NULL or non-finite component, take no part. Anchors are the rows whose vec_id is divisible by ``every``. Rows
    repeated with one vec_id, label and vector count once; rows that differ under one vec_id are rows of their own (as
    anchors: the least vector of a label stands for them), but never each other's partners. Equal scores come by vec_id. A
    vector shorter than another counts as zero beyond its end; without components all scores are 0. Anchors without
    positives, positives without a negative in range, and empty tables give no rows.
    """
    spark, rows = vectors.sparkSession, usable(vectors)
    anchors = stored(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "label").agg(
        F.min("embedding").alias("embedding")).withColumn("spread", F.xxhash64("vec_id")), "anchors")
    n, width = anchors.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    most = max(1, min(ANCHORS, COMPONENTS // max(1, width)))
    blocks = -(-n * 5 // (4 * most)) or 1  # four fifths full on average
    out = []
    for number in range(blocks):
        own = anchors.where(F.pmod("spread", F.lit(blocks)) == number).orderBy("vec_id", "label").toArrow()
        block = Anchors(own.column("vec_id").to_pylist(), own.column("label").to_pylist(),
                        integer_vectors(own.column("embedding").combine_chunks()))
        shared = spark.sparkContext.broadcast(block)
        found = map_arrow(rows, lambda it, held=shared: _own_positives(held.value, it),
                          "anchor_id long, label long, positive_id long, positive_score long")
        chosen = _ranked(found, ["anchor_id", "label"], "positive_score", "positive_id", POSITIVES)
        for row in chosen.orderBy("anchor_id", "label", "rank").collect():
            block.positives.setdefault((row["anchor_id"], row["label"]), []).append((row["positive_id"], row["positive_score"]))
        known = spark.sparkContext.broadcast(block)
        found = map_arrow(
            rows, lambda it, held=known: _own_negatives(held.value, it),
            "anchor_id long, label long, positive_id long, positive_score long, negative_id long, negative_score long")
        key = ["anchor_id", "label", "positive_id", "positive_score"]
        out.append(stored(_ranked(found, key, "negative_score", "negative_id", NEGATIVES), "negatives"))
    return reduce(DataFrame.unionByName, out).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
