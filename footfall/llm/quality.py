"""Quality scores by nearest-neighbour voting in a latent semantic space.

A text's features are hashed counts of its words, their shapes (letters, digits and punctuation reduced to classes)
and their endings, damped by a logarithm and weighted by the inverse document frequency over all documents. The
leading right singular vectors of the labelled texts' feature matrix span the latent space; labelled texts and
documents are projected onto them and scaled to length one.

The labelled vectors are broadcast. Every document's cosine with every labelled vector is computed, block by block,
without an index; the labels of the ``NEIGHBOURS`` nearest vote, weighted by similarity to the power ``SHARPNESS``.

Bounds: the ``LABELLED`` distinct labelled texts that come first in the order of their hashes are learned from, all if
there are fewer. Rows of equal text are one text, whose label is the mean of theirs, so a large group of copies has one
vote like any other text. The space has ``DIMENSIONS`` dimensions over ``FEATURES`` features; the broadcast is
FEATURES x DIMENSIONS and LABELLED x DIMENSIONS numbers of four bytes, 5 MB together. The driver holds the learned texts'
features as sparse rows, of six bytes a feature and FEATURES at most each, and ``ROWS`` of them as dense ones at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.storage import map_arrow
from footfall.llm.words import chunks, span_hashes, text_buffer, word_spans

FEATURES = 16_384
DIMENSIONS = 64
LABELLED = 4_000
ROWS = 128
NEIGHBOURS = 25
SHARPNESS = 4
THRESHOLD = 0.3
SEED = 5


def _shapes() -> np.ndarray:
    """Bytes by class: digit, upper case, lower case, blank, line end, other ASCII as itself, non-ASCII as a letter."""
    table = np.arange(256, dtype=np.uint8)
    table[48:58], table[65:91], table[97:123], table[128:] = 48, 65, 97, 97
    return table


_SHAPE = _shapes()


def _features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each run of texts: rows, features and damped counts of their distinct (text, feature) pairs.

    A word's shape keeps the order of its character classes without repeats, so its length does not matter.
    """
    data, starts = text_buffer(column)
    for i, j in chunks(starts):
        part, own = data[starts[i]:starts[j]], starts[i:j + 1] - starts[i]
        hashes, begin, end, before = word_spans(part, own)
        if not len(hashes):
            yield i, j, *(np.zeros(0, np.int64),) * 2, np.zeros(0, np.float32)
            continue
        text = np.repeat(np.arange(j - i), np.diff(before))
        shape = _SHAPE[part]
        new = np.ones(len(part), dtype=bool)
        new[1:] = shape[1:] != shape[:-1]
        new[begin] = True
        squeezed, place = shape[new], np.concatenate([[0], np.cumsum(new)])
        forms = span_hashes(squeezed, place[begin], place[end])
        tail = np.maximum(begin, end - 3)
        endings = span_hashes(part, tail, end)
        # The next word of the same text; the last one is followed by the first.
        following = np.arange(1, len(forms) + 1)
        some = np.diff(before) > 0
        following[before[1:][some] - 1] = before[:-1][some]
        pairs = np.concatenate([forms, forms[following] ^ (forms * np.uint64(3))])
        values = np.concatenate([hashes % np.uint64(FEATURES // 2), FEATURES // 2 + pairs % np.uint64(FEATURES // 4),
                                 3 * FEATURES // 4 + endings % np.uint64(FEATURES // 4)])
        code = np.concatenate([text] * 4) * FEATURES + values.astype(np.int64)
        code, count = np.unique(code, return_counts=True)
        yield i, j, code // FEATURES, code % FEATURES, (1 + np.log(count)).astype(np.float32)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        n += len(batch)
        for _, _, _, feature, _ in _features(batch.column("text")):
            total += np.bincount(feature, minlength=FEATURES)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(FEATURES), -1)), pa.array(np.append(total, n))],
                                     ["feature", "n"])


def _labelled_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each learned text's key, label, features and damped counts: at most ``FEATURES`` of them, however long it is."""
    for batch in batches:
        for i, j, row, feature, value in _features(batch.column("text")):
            edges = np.searchsorted(row, np.arange(j - i + 1)).tolist()
            spans = list(zip(edges[:-1], edges[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key")[i:j], batch.column("label")[i:j],
                 pa.array([feature[a:b].astype(np.uint16).tobytes() for a, b in spans], pa.binary()),
                 pa.array([value[a:b].tobytes() for a, b in spans], pa.binary())], ["key", "label", "features", "counts"])


class _Matrix:
    """The learned texts' weighted features as rows of length one, kept sparse and multiplied some rows at a time."""

    def __init__(self, sample: pa.Table, weights: np.ndarray) -> None:
        self.rows = []
        for own, count in zip(sample.column("features"), sample.column("counts"), strict=True):
            at = np.frombuffer(own.as_buffer(), np.uint16)
            value = np.frombuffer(count.as_buffer(), np.float32) * weights[at]
            length = np.linalg.norm(value)
            self.rows.append((at, value / length if length > 0 else value))

    def _dense(self) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(0, len(self.rows), ROWS):
            part = self.rows[i:i + ROWS]
            block = np.zeros((len(part), FEATURES), dtype=np.float32)
            for k, (at, value) in enumerate(part):
                block[k, at] = value
            yield i, block

    def times(self, right: np.ndarray) -> np.ndarray:
        return np.concatenate([block @ right for _, block in self._dense()])

    def transposed_times(self, right: np.ndarray) -> np.ndarray:
        return sum(block.T @ right[i:i + len(block)] for i, block in self._dense())


class Voter:
    """The projection, and the labelled vectors with their labels."""

    def __init__(self, projection: np.ndarray, vectors: np.ndarray, labels: np.ndarray) -> None:
        self.projection, self.vectors, self.labels = projection, vectors, labels

    def vectors_of(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Unit vectors of the texts from row ``i`` on; a text without words has zeros."""
        for i, j, row, feature, value in _features(column):
            out = np.zeros((j - i, self.projection.shape[1]), dtype=np.float32)
            edges = np.searchsorted(row, np.arange(j - i + 1))
            for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                if b > a:
                    out[k] = value[a:b] @ self.projection[feature[a:b]]
            length = np.linalg.norm(out, axis=1, keepdims=True)
            yield i, out / np.where(length > 0, length, 1)

    def scores(self, column: pa.Array) -> np.ndarray:
        out, prior = np.empty(len(column)), float(self.labels.mean())
        take = min(NEIGHBOURS, len(self.labels))
        for i, block in self.vectors_of(column):
            for at in range(0, len(block), 1024):
                rows = block[at:at + 1024]
                cosines = rows @ self.vectors.T
                nearest = np.argpartition(-cosines, take - 1, axis=1)[:, :take]
                near = np.take_along_axis(cosines, nearest, axis=1)
                weight = np.maximum(near, 0.0).astype(np.float64) ** SHARPNESS
                total = weight.sum(axis=1)
                vote = (weight * self.labels[nearest]).sum(axis=1) / np.where(total > 0, total, 1)
                out[i + at:i + at + len(rows)] = np.where(total > 0, np.clip(vote, 0, 1), prior)
        return out


def _text_key() -> Column:
    """A hash by which equal texts meet; NULL for those of blanks alone."""
    return F.when(F.trim("text") != "", F.xxhash64("text")).alias("key")


def learn(docs: DataFrame, labelled: DataFrame) -> Voter | None:
    """A voter from ``labelled`` (text, label 0 or 1), with document frequencies from all of ``docs`` (text).

    None if there is no labelled text that is more than blanks.
    """
    return _learn(docs, labelled.select(_text_key(), "label"), labelled)


def learn_by_id(docs: DataFrame, labels: DataFrame) -> Voter | None:
    """The same from ``labels`` (doc_id, label) of ``docs`` (doc_id, text). The join moves hashes instead of texts."""
    return _learn(docs, docs.select("doc_id", _text_key()).join(labels, "doc_id").select("key", "label"), docs)


def _learn(docs: DataFrame, keys: DataFrame, texts: DataFrame) -> Voter | None:
    """``keys`` (key, label) say which of ``texts`` (text) are learned."""
    counts = map_arrow(docs.select("text"), _document_frequencies, "feature long, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).collect()
    frequency = np.zeros(FEATURES)
    total = 0
    for row in counts:
        if row["feature"] < 0:
            total = row["n"]
        else:
            frequency[row["feature"]] = row["n"]
    weights = np.log((1 + total) / (1 + frequency)).astype(np.float32) + 1

    chosen = keys.select("key", F.col("label").cast("int").alias("label")).where("key IS NOT NULL AND label in (0, 1)") \
        .groupBy("key").agg(F.avg("label").alias("label")).orderBy("key").limit(LABELLED)
    # At most LABELLED keys with their labels; a task sends one row for all its copies of a text.
    learned = texts.select(_text_key(), "text").join(F.broadcast(chosen), "key").groupBy("key").agg(
        F.first("label").alias("label"), F.first("text").alias("text"))
    sample = map_arrow(learned, _labelled_rows, "key long, label double, features binary, counts binary").orderBy("key").toArrow()
    if not len(sample):
        return None
    labels = sample.column("label").to_numpy()
    matrix = _Matrix(sample, weights)
    size = min(DIMENSIONS, len(labels), FEATURES)
    probe = np.random.default_rng(SEED).standard_normal((FEATURES, size + 16)).astype(np.float32)
    basis = np.linalg.qr(matrix.times(probe))[0]
    for _ in range(4):
        basis = np.linalg.qr(matrix.times(matrix.transposed_times(basis)))[0]
    space = np.linalg.svd(matrix.transposed_times(basis).T, full_matrices=False)[2][:size].T
    vectors = matrix.times(space)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Voter((weights[:, None] * space).astype(np.float32), vectors / np.where(length > 0, length, 1), labels)


def scored(docs: DataFrame, voter: Voter | None) -> DataFrame:
    """(doc_id, text) -> doc_id, score, predicted; other columns are not used.

    Every whole text is scored. A text that is NULL, empty or without a word, or near no labelled text, has the share of
    label 1 among the learned texts; without any labelled text all score 0. Repeated rows score alike.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if voter is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(voter)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values), pa.array((values >= THRESHOLD).astype("int32"))],
                ["doc_id", "score", "predicted"])

    return map_arrow(rows, score, "doc_id long, score double, predicted int")
