"""Subword lattice likelihood of texts, beside a plain word unigram.

The pieces are those of an existing vocabulary, together with the 256 single bytes, so that every text has a
segmentation. A piece's probability is learned from the training texts by expectation maximisation: its expected number
of uses over all segmentations, plus one, from scores that the vocabulary's order gives. Rounds go on until one adds
less than ``TOLERANCE`` to the training words' mean log probability (natural log). Words are put in lower case and begin
with the vocabulary's word mark; an end token closes a text.

A word's probability is the sum over all its segmentations of the product of the pieces' probabilities, by forward
recursion in log space over the word's bytes. As no piece crosses a word's beginning, a text's marginal probability is
the product of its words' and the end's; so the recursion runs once per distinct word of all texts, in blocks of words
of similar length.

Words meet their counts by a 64-bit hash. Words of at least one in ``FREQUENT`` tokens, at most that many, are broadcast
and cover most of a text; the others are summed by text and word and joined. Counts of pieces are one vector of the
vocabulary's size. So no table grows in one place with the corpus.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.storage import map_arrow, stored
from footfall.llm.words import chunks, odd_numbers, text_buffer, word_spans

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
FREQUENT = 1_000_000
TOLERANCE = 0.01
_LOG10 = np.log(10.0)
_BATCH_CELLS = 1 << 16
_STEP = np.uint64(odd_numbers(301, 1)[0])
_LETTERS = odd_numbers(303, 256)
_SPREAD = np.uint64(odd_numbers(305, 1)[0])


def _hash_bytes(piece: bytes) -> int:
    value = 0
    for byte in piece:
        value = (value * int(_STEP) + int(_LETTERS[byte])) & ((1 << 64) - 1)
    return value


def vocabulary_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The ordinary pieces of a vocabulary file in its order, as bytes; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i).encode() for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Lattice:
    """Pieces with log probabilities, and the forward and backward recursions over many words at once."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray | None = None) -> None:
        first = dict.fromkeys([*pieces, *(bytes([b]) for b in range(256))])
        self.pieces = list(first)
        self.longest = max(map(len, self.pieces))
        hashes = np.array([_hash_bytes(p) for p in self.pieces], dtype=np.uint64)
        lengths = np.array([len(p) for p in self.pieces])
        self.order = [np.flatnonzero(lengths == n) for n in range(self.longest + 1)]
        self.tables = []
        for n, own in enumerate(self.order):
            own = own[np.argsort(hashes[own], kind="stable")]
            self.order[n] = own
            seen = np.zeros(1 << 16, dtype=bool)
            seen[hashes[own] * _SPREAD >> np.uint64(48)] = True
            self.tables.append((hashes[own], seen))
        # The vocabulary lists pieces by merge order; a start that falls with the rank as word frequencies do.
        self.logs = logs if logs is not None else self.normalised(1 / (10.0 + np.arange(len(self.pieces))))

    @staticmethod
    def normalised(weights: np.ndarray) -> np.ndarray:
        return np.log(weights / weights.sum())

    def _uses(self, words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each piece length: (length, word, end position, piece) of every place where a piece of it fits."""
        n, width = words.shape
        prefix = np.zeros((n, width + 1), dtype=np.uint64)
        for k in range(width):
            prefix[:, k + 1] = prefix[:, k] * _STEP + _LETTERS[words[:, k]]
        out, power = [], 1
        for size in range(1, min(self.longest, width) + 1):
            power = power * int(_STEP) & ((1 << 64) - 1)
            keys, seen = self.tables[size]
            if not len(keys):
                continue
            span = prefix[:, size:] - prefix[:, :-size] * np.uint64(power)
            maybe = seen[span * _SPREAD >> np.uint64(48)]
            maybe &= (np.arange(size, width + 1) <= lengths[:, None])
            place = np.flatnonzero(maybe)
            wanted = span.ravel()[place]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = keys[at] == wanted
            word, end = np.divmod(place[found], span.shape[1])
            out.append((size, word, end + size, self.order[size][at[found]]))
        return out

    def _forward(self, uses: list, n: int, width: int) -> tuple[np.ndarray, list]:
        """Log sums over the segmentations of every prefix; the uses by end position."""
        word = np.concatenate([u[1] for u in uses])
        end = np.concatenate([u[2] for u in uses])
        piece = np.concatenate([u[3] for u in uses])
        start = end - np.concatenate([np.full(len(u[1]), u[0]) for u in uses])
        order = np.argsort(end * n + word, kind="stable")
        word, end, piece, start = word[order], end[order], piece[order], start[order]
        edges = np.searchsorted(end, np.arange(width + 2))
        alpha = np.full((n, width + 1), -np.inf)
        alpha[:, 0] = 0.0
        steps = []
        for k in range(1, width + 1):
            part = slice(edges[k], edges[k + 1])
            w, s, p = word[part], start[part], piece[part]
            if not len(w):
                break
            steps.append((k, w, s, p))
            value = alpha[w, s] + self.logs[p]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            best = np.maximum.reduceat(value, first)
            group = np.cumsum(np.concatenate([[0], (w[1:] != w[:-1]).astype(np.int64)]))
            alpha[w[first], k] = best + np.log(np.add.reduceat(np.exp(value - best[group]), first))
        return alpha, steps

    def _blocks(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places, byte matrix, lengths) of words of similar length."""
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            upto = at + 1
            while upto < len(order) and (upto - at + 1) * int(sizes[order[min(upto + 255, len(order) - 1)]]) <= _BATCH_CELLS:
                upto = min(upto + 256, len(order))
            own = order[at:upto]
            width = int(sizes[own[-1]])
            matrix = np.zeros((len(own), width), dtype=np.uint8)
            inside = np.arange(width) < sizes[own][:, None]
            matrix[inside] = np.frombuffer(b"".join([words[i] for i in own]), np.uint8)
            yield own, matrix, sizes[own]
            at = upto

    def log_sums(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability; every word has at least one byte."""
        out = np.empty(len(words))
        for own, matrix, lengths in self._blocks(words):
            alpha, _ = self._forward(self._uses(matrix, lengths), *matrix.shape)
            out[own] = alpha[np.arange(len(own)), lengths]
        return out

    def expected(self, words: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected uses of every piece over the words' segmentations, the words counted by weight, and the sum of the
        words' log probabilities by weight."""
        total, gained = np.zeros(len(self.pieces)), 0.0
        for own, matrix, lengths in self._blocks(words):
            alpha, steps = self._forward(self._uses(matrix, lengths), *matrix.shape)
            whole = alpha[np.arange(len(own)), lengths]
            gained += float(whole @ weights[own])
            beta = np.full(alpha.shape, -np.inf)
            beta[np.arange(len(own)), lengths] = 0.0
            for k, w, s, p in reversed(steps):
                step = self.logs[p] + beta[w, k]
                beta[w, s] = np.logaddexp(beta[w, s], step)  # one piece at most between two places of a word
                total += np.bincount(p, weights=weights[own][w] * np.exp(alpha[w, s] + step - whole[w]),
                                     minlength=len(total))
        return total, gained


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, word, uses in training texts) of the distinct words, summed over runs of batches of bounded size."""
    for batch in batches:
        data, starts = text_buffer(batch.column("text"))
        training = batch.column("training").to_numpy(zero_copy_only=False)
        for i, j in chunks(starts, 1 << 24):
            part = data[starts[i]:starts[j]]
            hashes, begin, end, before = word_spans(part, starts[i:j + 1] - starts[i])
            if not len(hashes):
                continue
            used = np.repeat(training[i:j], np.diff(before))
            distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            raw = part.tobytes()
            words = [raw[a:b].lower() for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(words, pa.binary()),
                 pa.array(np.bincount(which, weights=used, minlength=len(distinct)).astype(np.int64))],
                ["hash", "word", "n"])


def word_table(docs: DataFrame) -> DataFrame:
    """(hash, word, n): all distinct words of ``docs`` (text, training) and their uses in the training texts."""
    words = map_arrow(docs.select("text", "training"), _word_counts, "hash long, word binary, n long")
    return stored(words.groupBy("hash").agg(F.min("word").alias("word"), F.sum("n").alias("n")), "words")


def learn(words: DataFrame, texts: int, pieces: list[bytes]) -> tuple[Lattice, float]:
    """Piece probabilities from the word table; the log probability of the end token, one per training text."""
    spark = words.sparkSession
    used, before, lattice, end = words.where("n > 0"), None, Lattice(pieces), 0.0
    uses_of_all = used.agg(F.sum("n")).first()[0] or 0
    while True:
        current = spark.sparkContext.broadcast(lattice)

        def expected(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            total, gained = np.zeros(len(current.value.pieces)), 0.0
            for batch in batches:
                marked = [MARK.encode() + w for w in batch.column("word").to_pylist()]
                uses, logs = current.value.expected(marked, batch.column("n").to_numpy().astype(float))
                total, gained = total + uses, gained + logs
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1)), pa.array(np.append(total[found], gained))],
                                             ["piece", "n"])

        sums = map_arrow(used, expected, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(len(lattice.pieces) + 1)
        counts[sums.column("piece").to_numpy()] = sums.column("n").to_numpy()
        current.unpersist()
        likelihood = counts[-1] / max(uses_of_all, 1)
        if before is not None and likelihood - before < TOLERANCE:
            return lattice, end
        logs = Lattice.normalised(np.append(counts[:-1] + 1, texts + 1))
        before, lattice, end = likelihood, Lattice(pieces, logs[:-1]), float(logs[-1])


class _Frequent:
    """Log probabilities of the frequent words, in the order of their hashes."""

    def __init__(self, rows: pa.Table) -> None:
        hashes = rows.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.base, self.score = (rows.column(c).to_numpy()[order] for c in ("base", "score"))


def _by_text(batches: Iterator[pa.RecordBatch], frequent) -> Iterator[pa.RecordBatch]:
    """Per text a row with the sums over frequent words, and a row for each other distinct word."""
    table = frequent.value
    names = ["row_id", "hash", "uses", "doc_id", "n_known", "base", "score"]
    for batch in batches:
        rows, ids = batch.column("row_id"), batch.column("doc_id")
        data, starts = text_buffer(batch.column("text"))
        for i, j in chunks(starts):
            hashes, _, _, before = word_spans(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
            text = np.repeat(np.arange(j - i), np.diff(before))
            at = np.minimum(np.searchsorted(table.hashes, hashes), max(len(table.hashes) - 1, 0))
            common = table.hashes[at] == hashes if len(table.hashes) else np.zeros(len(hashes), dtype=bool)
            own, at = text[common], at[common]
            base, score = (np.bincount(own, weights=v[at], minlength=j - i) if len(own) else np.zeros(j - i)
                           for v in (table.base, table.score))
            yield pa.RecordBatch.from_arrays(
                [rows[i:j], pa.nulls(j - i, pa.int64()), pa.array(np.diff(before) + 1), ids[i:j],
                 pa.array(np.bincount(own, minlength=j - i)), pa.array(base), pa.array(score)], names)
            other, owner = hashes[~common], text[~common]
            if len(other):
                order = np.lexsort((other, owner))
                other, owner = other[order], owner[order]
                first = np.flatnonzero(np.concatenate([[True], (other[1:] != other[:-1]) | (owner[1:] != owner[:-1])]))
                uses = np.diff(np.append(first, len(other)))
                n = len(first)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(owner[first] + i)), pa.array(other[first].view(np.int64)), pa.array(uses),
                     pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()),
                     pa.nulls(n, pa.float64())], names)


def text_scores(docs: DataFrame, training: Column, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Texts for which ``training`` is true are learned from; all whole texts are scored. A text that is NULL or has no word
    is the end token alone. Logs are to base 10. Repeated rows are scored each, and learned from each. If nothing is
    learned from, all words are unknown. Other columns are not used.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(training, F.lit(False)).alias("training"))
    words = word_table(rows)
    texts = rows.where("training").count()
    lattice, end = learn(words, texts, vocabulary_pieces(vocabulary))
    n_words, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    tokens, distinct = n_words + texts, v + (texts > 0)
    model = spark.sparkContext.broadcast(lattice)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            logs = model.value.log_sums([MARK.encode() + w for w in batch.column("word").to_pylist()])
            base = np.log10((n + 1) / (tokens + 1 * (distinct + 1)))
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("n"), pa.array(base),
                                              pa.array(logs / _LOG10)], ["hash", "n", "base", "score"])

    table = stored(map_arrow(words, sums, "hash long, n long, base double, score double"), "word_logs")
    often = (F.col("n") > 0) & (F.col("n") * FREQUENT >= tokens)
    frequent = spark.sparkContext.broadcast(_Frequent(table.where(often).select("hash", "base", "score").toArrow()))

    marked = rows.select(F.xxhash64("doc_id", "text").alias("row_id"), "doc_id", "text")
    parts = stored(map_arrow(marked, lambda it: _by_text(it, frequent), (
        "row_id long, hash long, uses long, doc_id long, n_known long, base double, score double")), "text_words")
    rare = table.where(~often).select("hash", "n", F.col("base").alias("word_base"), F.col("score").alias("word_score"))
    of_words = parts.where("hash IS NOT NULL").select("row_id", "hash", "uses").join(rare, "hash").select(
        "row_id", F.when(F.col("n") > 0, F.col("uses")).otherwise(0).alias("n_known"),
        (F.col("uses") * F.col("word_base")).alias("base"), (F.col("uses") * F.col("word_score")).alias("score"))
    of_words = of_words.groupBy("row_id").agg(*[F.sum(c).alias(f"more_{c}") for c in ("n_known", "base", "score")])
    of_texts = parts.where("hash IS NULL").select("row_id", "doc_id", F.col("uses").alias("n_tokens"), "n_known", "base",
                                                  "score")
    copies = of_texts.groupBy("row_id").agg(F.count("*").alias("copies"), *[
        F.max(c).alias(c) for c in ("doc_id", "n_tokens", "n_known", "base", "score")])
    base_end = float(np.log10((texts + 1) / (tokens + 1 * (distinct + 1))))

    def whole(name: str, per_text: Column) -> Column:
        return (F.col(name) + F.coalesce(F.col(f"more_{name}") / F.col("copies"), F.lit(0)) + per_text).alias(name)

    sums_of = copies.join(of_words, "row_id", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return sums_of.select(
        "doc_id", "n_tokens", whole("n_known", F.lit(int(texts > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), whole("base", F.lit(base_end)).alias("base_score"),
        whole("score", F.lit(end / _LOG10)).alias("score"))
