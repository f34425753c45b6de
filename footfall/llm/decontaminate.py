"""Benchmark items found inside documents: containment search with minhash sketches of items, partitioned by size.

An item's set is its distinct five-word shingles, words being runs of letters, digits and other non-ASCII characters
in lower case, so that case and punctuation do not hide a passage. A document contains an item when at least
``CONTAINMENT`` percent of the item's shingles are in it. A document may be a thousand times longer than an item, and
banded signatures of both would then agree almost nowhere; so only the item is sketched, and the sketch is looked up in
the document's whole set.

Items are partitioned by size at powers of two. In a partition of sizes up to u, an item's sketch is its
floor((1 - c) u) + 1 smallest shingles under one hash order (all, if it has fewer). A document that holds the share c
of the item misses fewer than that many, so it holds at least one of the sketch: no contaminated document is lost.
Documents with fewer shingles than the share needs are passed over. Candidates are confirmed on the full sets.

The items' sets go to every task in blocks of at most ``BLOCK_SHINGLES`` shingles (16 MB); more items mean more passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.storage import map_arrow, stored
from footfall.llm.words import PUNCTUATED, chunks, distinct_per_text, odd_numbers, shingles, text_buffer, word_spans

CONTAINMENT = 75
BLOCK_SHINGLES = 2_000_000
_ORDER = odd_numbers(211, 1)[0]
_BITS = np.uint64((1 << 20) - 1)


def _text_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each run of texts from row ``i`` on: all shingles, and the number before each text."""
    data, starts = text_buffer(pc.utf8_lower(column))
    for i, j in chunks(starts):
        hashes, _, _, before = word_spans(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i], False, PUNCTUATED)
        yield i, *shingles(hashes, before)


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, values, before in _text_sets(batch.column("text")):
            values, before = distinct_per_text(values, before)
            raw = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id")[i:i + len(before) - 1], pa.array(np.diff(before)),
                 pa.array([raw[8 * a:8 * b] for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True)],
                          pa.binary())], ["item_id", "n", "items"])


class Index:
    """The sketches and full sets of a block of items."""

    def __init__(self, rows: list) -> None:
        self.ids = [row["item_id"] for row in rows]
        self.sets = [np.frombuffer(row["items"], np.uint64) for row in rows]
        hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for number, values in enumerate(self.sets):
            upper = 1 << max(0, len(values) - 1).bit_length()
            size = upper * (100 - CONTAINMENT) // 100 + 1
            least = values[np.argsort(values * _ORDER, kind="stable")[:size]]
            hashes.append(least)
            owners.append(np.full(len(least), number))
        keys, owner = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.seen = np.zeros(int(_BITS) + 1, dtype=bool)
        self.seen[(self.keys & _BITS).astype(np.int64)] = True

    def matches(self, column: pa.Array) -> list[tuple[int, int, int, int]]:
        """(row, item number, shared, item's shingles) of the texts that contain an item."""
        out = []
        for i, values, before in _text_sets(column):
            maybe = np.flatnonzero(self.seen[(values & _BITS).astype(np.int64)])
            low = np.searchsorted(self.keys, values[maybe], side="left")
            high = np.searchsorted(self.keys, values[maybe], side="right")
            hit = high > low
            rows = np.searchsorted(before, maybe[hit], side="right") - 1
            wanted: dict[int, set[int]] = {}
            for row, a, b in zip(rows.tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
                wanted.setdefault(row, set()).update(self.owner[a:b].tolist())
            for row, numbers in sorted(wanted.items()):
                text = np.unique(values[before[row]:before[row + 1]])
                for number in sorted(numbers):
                    item = self.sets[number]
                    if 100 * len(text) < CONTAINMENT * len(item):
                        continue
                    at = np.minimum(np.searchsorted(text, item), len(text) - 1)
                    shared = int((text[at] == item).sum())
                    if 100 * shared >= CONTAINMENT * len(item):
                        out.append((i + row, number, shared, len(item)))
        return out


def _indexes(items: DataFrame) -> Iterator[Broadcast]:
    """The items in blocks of bounded size, ready in every task."""
    sets = stored(map_arrow(items.select(F.col("item_id").cast("long"), "text"), _item_sets,
                            "item_id long, n long, items binary").where("n > 0"), "items")
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_SHINGLES)
    for block in range(blocks):
        rows = sets.where(F.pmod(F.xxhash64("item_id", "items"), F.lit(blocks)) == block).collect()
        yield items.sparkSession.sparkContext.broadcast(Index(rows))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): one row per document row and item that it contains.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not used. Texts that are NULL, empty
    or without a word match nothing. A text or item of fewer than five words has one shingle, the whole of it, so a
    short item is found only in documents that are equal to it. Repeated rows on either side give repeated rows; ids
    may be NULL. Without documents or items there are no rows.
    """
    found = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shared long, n_item long")
    for shared_index in _indexes(items):
        def search(batches: Iterator[pa.RecordBatch], index: Broadcast = shared_index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = index.value.matches(batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([index.value.ids[r[1]] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                    ["doc_id", "item_id", "n_shared", "n_item"])

        found = found.union(map_arrow(
            docs.select(F.col("doc_id").cast("long"), "text"), search, "doc_id long, item_id long, n_shared long, n_item long"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item. No row is shuffled.

    A NULL or empty text, or one without a word, contains nothing and stays. Repeated rows stay or go together. Without
    items, or where no item has a word, all rows stay; no rows give no rows.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    position = docs.columns.index("text")
    for shared_index in _indexes(items):
        def clean(batches: Iterator[pa.RecordBatch], index: Broadcast = shared_index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(len(batch), dtype=bool)
                keep[[row for row, *_ in index.value.matches(batch.column(position))]] = False
                yield batch.filter(pa.array(keep))

        docs = map_arrow(docs, clean, schema)
    return docs
