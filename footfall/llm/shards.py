"""Training-order materialisation: token sequences in fixed-stride shards, in a keyed pseudo-random order.

Texts are tokenized with an existing vocabulary, each followed by the end-of-text token, and packed within an input
partition into sequences of ``LENGTH`` tokens. A first pass counts the sequences of each partition; sums of these
counts number all sequences from 0 to N - 1. A keyed Feistel network over the next power of four, walked along its
cycle until it falls below N, sends each number to a global slot, one to one. A second pass sends each sequence
to the shard that holds its slot, sorts the shard by slot and writes it. So shard k holds the slots from k * SHARD on,
every record has the same stride, and a reader can resume at any slot by arithmetic alone.

Shards are written by Spark's own file writer, which commits each task's file once. It ends every record with a
separator; here that is the end-of-text token with which each record ends, so a record is ``LENGTH`` little-endian
16-bit token ids, the last of them end-of-text. Unused places hold end-of-text as well.

The numbering follows partitions and rows of the input, so ``docs`` should be read from a table as it is; the second
pass stops the job if a partition differs from its count.
"""

from __future__ import annotations

import re
from base64 import b64decode
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.storage import fresh_path, map_arrow, stored
from footfall.llm.words import odd_numbers, span_hashes, text_buffer

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256
LENGTH = 1024
SHARD = 8192
KEY = 20240501
ROUNDS = 6
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WIDE_SPACE = re.compile("[" + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")
_CHUNK = 1 << 22
_KEPT_PIECES = 500_000


class Tokenizer:
    """The vocabulary, and how to tokenize many texts at once.

    A token never reaches across a blank that follows a non-blank, so texts are cut there and each distinct piece of a
    batch is tokenized once, all of them joined in one call and split again by the tokens' lengths in bytes. Tokens of
    up to ``_KEPT_PIECES`` pieces are kept from batch to batch.
    """

    def __init__(self, vocabulary: bytes) -> None:
        self.vocabulary = vocabulary
        self._ready: tuple | None = None
        self._forget()

    def _forget(self) -> None:
        """Empties the kept pieces: their hashes in order, the first and the number of their tokens, and the tokens."""
        self.known, self.spans = np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
        self.flat = np.zeros(0, np.uint16)

    def __reduce__(self) -> tuple:
        return Tokenizer, (self.vocabulary,)

    def _load(self) -> tuple:
        if self._ready is None:
            import tiktoken

            ranks = {b64decode(word): int(rank) for word, rank in map(bytes.split, self.vocabulary.splitlines())}
            sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            for word, rank in ranks.items():
                sizes[rank] = len(word)
            self._ready = (tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes)
        return self._ready

    def _plain(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        encoding, _ = self._load()
        rows = [encoding.encode_ordinary(text or "") for text in column.to_pylist()]
        counts = np.array([len(row) for row in rows], dtype=np.int64)
        return np.fromiter((t for row in rows for t in row), np.uint16, int(counts.sum())), counts

    def _tokenized(self, raw: bytes, begin: np.ndarray, end: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of the byte ranges, one after the other, and their numbers; those marked are tokenized singly."""
        encoding, sizes = self._load()
        spans = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        count, rest = np.zeros(len(spans), np.int64), np.flatnonzero(~alone)
        singles = [encoding.encode_ordinary(spans[k].decode()) for k in np.flatnonzero(alone)]
        count[alone] = [len(ids) for ids in singles]
        ids = np.array(encoding.encode_ordinary(b"".join([spans[k] for k in rest]).decode()), dtype=np.uint16)
        if len(rest):
            ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum([len(spans[k]) for k in rest])) + 1
            count[rest] = np.diff(ends, prepend=0)
        single = np.fromiter((t for x in singles for t in x), np.uint16, int(count[alone].sum()))
        return np.concatenate([single, ids]), count

    def _pieces(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each piece of the texts its first token among those kept and their number; the pieces before each text."""
        white = np.zeros(256, dtype=bool)
        white[[9, 10, 11, 12, 13, 32]] = True
        cut = data == 32
        cut[1:] &= ~white[data[:-1]]
        heads = starts[:-1][np.diff(starts) > 0]
        cut[heads] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(data))
        hashes = span_hashes(data, begin, end)
        is_head = np.isin(begin, heads, assume_unique=True)
        hashes[is_head] ^= np.uint64(1)  # pieces that begin a text are told apart from those after a blank
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > _KEPT_PIECES:
            self._forget()
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = self.known[at] != distinct if len(self.known) else np.ones(len(distinct), dtype=bool)
        if new.any():
            own = first[new]
            order = np.argsort(~is_head[own], kind="stable")  # tokens of single pieces come first
            own = own[order]
            flat, count = self._tokenized(data.tobytes(), begin[own], end[own], is_head[own])
            lead = len(self.flat) + np.cumsum(count) - count
            self.flat = np.concatenate([self.flat, flat])
            known = np.concatenate([self.known, distinct[new][order]])
            place = np.argsort(known, kind="stable")
            self.known = known[place]
            self.spans = np.concatenate([self.spans, np.stack([lead, count])], axis=1)[:, place]
            at = np.searchsorted(self.known, distinct)
        return self.spans[0][at][which], self.spans[1][at][which], np.searchsorted(begin, starts)

    def batches(self, column: pa.Array, only_counts: bool) -> Iterator[tuple[int, np.ndarray | None, np.ndarray]]:
        """For each run of texts from row ``i`` on: all tokens (unless only counts are wanted) and those of each text."""
        data, starts = text_buffer(column)
        i, n = 0, len(column)
        while i < n:
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + _CHUNK, side="right")) - 1)
            part, own = data[starts[i]:starts[j]], starts[i:j + 1] - starts[i]
            if not len(part):
                yield i, np.zeros(0, np.uint16), np.zeros(j - i, np.int64)
            elif _WIDE_SPACE.search(part.tobytes().decode()):
                yield i, *self._plain(column[i:j])
            else:
                lead, count, before = self._pieces(part, own)
                total = np.concatenate([[0], np.cumsum(count)])
                tokens = None
                if not only_counts:
                    tokens = self.flat[np.repeat(lead - total[:-1], count) + np.arange(total[-1])]
                yield i, tokens, total[before[1:]] - total[before[:-1]]
            i = j


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each of the numbers below ``n``: a keyed Feistel network, walked until it falls below ``n``."""
    half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    keys = odd_numbers(key, ROUNDS)
    out = numbers.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        left, right = out[todo] >> half, out[todo] & low
        for salt in keys:
            mixed = (right + np.uint64(1)) * salt
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & low)
        out[todo] = (left << half) | right
        todo = out >= n
    return out.astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], tokenizer, length: int) -> Iterator[pa.RecordBatch]:
    """The sequences of a partition: number within it, used tokens, ids of the documents in it."""
    room, part = length - 1, TaskContext.get().partitionId()
    number, used, ids = 0, 0, []
    done: list[tuple[int, int, list]] = []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(done), pa.int32()), pa.array([r[0] for r in done], pa.int64()),
             pa.array([r[1] for r in done], pa.int64()), pa.array([r[2] for r in done], pa.list_(pa.int64()))],
            ["part", "number", "n_tokens", "doc_ids"])

    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        for i, _, counts in tokenizer.value.batches(batch.column("text"), True):
            for name, count in zip(names[i:i + len(counts)], counts.tolist(), strict=True):
                left = count + (count > 0)
                while left:
                    ids.append(name)
                    step = min(left, room - used)
                    used, left = used + step, left - step
                    if used == room:
                        done.append((number, used, ids))
                        number, used, ids = number + 1, 0, []
        if done:
            yield rows()
            done = []
    if used:
        done.append((number, used, ids))
    yield rows()


def _write_records(batches: Iterator[pa.RecordBatch], tokenizer, offsets: dict[int, tuple[int, int]], n: int,
                   key: int, length: int) -> Iterator[pa.RecordBatch]:
    """The sequences of a partition: slot, and all tokens but the closing one."""
    room, (number, last) = length - 1, offsets.get(TaskContext.get().partitionId(), (0, 0))
    held = np.zeros(0, np.uint16)

    def rows(tokens: np.ndarray) -> pa.RecordBatch:
        nonlocal number
        count = len(tokens) // room
        if number + count > last:
            raise ValueError("the documents differ from those that were counted; read them from a table")
        slots = permuted(np.arange(number, number + count), n, key)
        number += count
        raw = pa.Array.from_buffers(pa.binary(), count, [
            None, pa.py_buffer(np.arange(count + 1, dtype=np.int32) * np.int32(2 * room)),
            pa.py_buffer(tokens.astype("<u2").tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(slots), raw], ["slot", "record"])

    for batch in batches:
        for _, tokens, counts in tokenizer.value.batches(batch.column("text"), False):
            ends = np.cumsum(counts)[counts > 0]
            held = np.concatenate([held, np.insert(tokens, ends, END)])
            whole = len(held) // room * room
            if whole:
                yield rows(held[:whole])
                held = held[whole:]
    if len(held):
        yield rows(np.concatenate([held, np.full(room - len(held), END, np.uint16)]))
    if number != last:
        raise ValueError("the documents differ from those that were counted; read them from a table")


def write_shards(docs: DataFrame, path: str | None = None, vocabulary: str = VOCABULARY,
                 key: int = KEY, length: int = LENGTH, shard: int = SHARD) -> tuple[str, DataFrame]:
    """Writes all texts of ``docs`` (doc_id, text) as shards; their folder, and (slot, n_tokens, doc_ids) per sequence.

    Texts that are NULL or empty have no token and are in no sequence; a NULL id stands as NULL in doc_ids; repeated rows
    are tokenized each. n_tokens counts the used places, ends of text included. Without tokens there is no shard.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        tokenizer = spark.sparkContext.broadcast(Tokenizer(file.read()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = stored(map_arrow(rows, lambda it: _count(it, tokenizer, length),
                               "part int, number long, n_tokens long, doc_ids array<long>"), "sequences")
    parts = sorted(tuple(row) for row in counted.groupBy("part").agg(F.count("*").alias("n")).collect())
    ends = list(accumulate(count for _, count in parts))
    offsets = {part: (end - count, end) for (part, count), end in zip(parts, ends, strict=True)}
    n = ends[-1] if ends else 0

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = np.array([offsets[p][0] for p in batch.column("part").to_pylist()], dtype=np.int64)
            slot = permuted(first + batch.column("number").to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), batch.column("n_tokens"), batch.column("doc_ids")],
                                             ["slot", "n_tokens", "doc_ids"])

    contents = map_arrow(counted, slots, "slot long, n_tokens long, doc_ids array<long>")
    path = path or fresh_path(spark, "shards")
    if n:
        shards = -(-n // shard)
        records = map_arrow(rows, lambda it: _write_records(it, tokenizer, offsets, n, key, length), "slot long, record binary")
        (records.repartitionById(shards, F.floor(F.col("slot") / shard).cast("int")).sortWithinPartitions("slot")
         .select(F.col("record").cast("string").alias("value"))
         .write.option("encoding", "ISO-8859-1").option("lineSep", END.to_bytes(2, "little").decode("latin-1")).text(path))
    return path, contents


def read_shards(spark: SparkSession, path: str, start: int = 0, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(slot, shard, record) from slot ``start`` on; shards below it are not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    number = F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("int")
    files = files.withColumn("shard", number).where(F.col("shard") >= start // shard).select("shard", "content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = 2 * length
        for batch in batches:
            for number, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                raw = content.as_buffer()
                count = len(raw) // stride
                if len(raw) != count * stride:
                    raise ValueError(f"shard {number} does not consist of whole records")
                skip = max(0, start - number * shard)
                for at in range(skip, count, 1024):
                    some = min(1024, count - at)
                    slot = np.arange(at, at + some) + number * shard
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot), pa.array(np.full(some, number, np.int32)),
                         pa.Array.from_buffers(pa.binary(), some, [
                             None, pa.py_buffer(np.arange(some + 1, dtype=np.int32) * np.int32(stride)),
                             raw.slice(at * stride, some * stride)])], ["slot", "shard", "record"])

    return map_arrow(files, records, "slot long, shard int, record binary")


def materialise(docs: DataFrame, path: str | None = None, vocabulary: str = VOCABULARY, key: int = KEY) -> DataFrame:
    """Writes shards and reads them back: slot, shard, n_tokens, doc_ids, crc32 of the record's bytes."""
    path, contents = write_shards(docs, path, vocabulary, key)
    spark = docs.sparkSession
    if contents.isEmpty():
        return contents.select("slot", F.lit(0).alias("shard"), "n_tokens", "doc_ids", F.lit(0).cast("long").alias("crc32"))
    read = read_shards(spark, path).select("slot", "shard", F.crc32("record").alias("crc32"))
    return read.join(contents, "slot").select("slot", "shard", "n_tokens", "doc_ids", "crc32")
