"""Phrase collocations by best-first branch-and-bound growth.

A phrase of two to five words is scored by its weakest cut: floor(1000 a n / (l r)), with a its count, n the words of
its language, l and r the counts of the two parts. Every occurrence of a phrase is one of its first and of its last word,
so a is at most the count of any part; hence a score is at most floor(1000 n / f) with f the count of the first word,
and likewise of the last. The counts of prefixes (and suffixes) thus bound all that grows from them.

The frontier is made of words, best bound (rarest) first. A round opens the rarest words of each language, as many as
make up a share of all words, and grows the phrases that begin or end with one of them, word by word: a phrase of k
words is counted only if its part of k - 1 words is frequent. Of phrases that begin and end with opened words, all parts
and all extensions by one word are then counted, so their scores and whether they survive are exact. A language is
settled when ``TOP`` survivors score above the bound of the words not opened, which also settles all ties; else the
next, larger share is opened. The last share is all words.

A longer candidate never has a larger count than a part of it, and if it has the same, so has every phrase between;
so it is enough to look at the extensions by one word to see what is dropped.

Counting reads the texts as rows of word keys, made once: rare words become gaps. Bitmaps of a fixed size tell opened
words and frequent parts; a bit set by chance lets something be counted that is not needed, and nothing is missed.
Counts are summed per task before the shuffle and decided on exact sums. Words and phrases are told apart by 64-bit hashes
while they are counted, and by their text from then on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.storage import map_arrow, stored
from footfall.llm.words import chunks, mix, odd_numbers, text_buffer, word_spans

BREAKS = b".,;:!?\n\x0b\x0c\r"
SEPARATORS = b" \t" + BREAKS
LEAST = 100
LONGEST = 5
TOP = 2000
SHARES = (1 / 3, 1.0)
MAP_BITS = 25
TOKENS = 1 << 18
RUN = 1 << 20
UNKNOWN = "und"

_FACTOR = np.uint64(odd_numbers(211, 1)[0])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(BREAKS)] = True


def _words(column: pa.Array, salts: np.ndarray) -> Iterator[tuple]:
    """For each run of texts [i, j): lower-cased bytes, the words' keys (never 0), first bytes, ends, words before each
    text, and whether a word begins a piece. Keys differ between languages."""
    data, starts = text_buffer(column)
    for i, j in chunks(starts, RUN):
        part, own = data[starts[i]:starts[j]], starts[i:j + 1] - starts[i]
        hashes, begin, end, before = word_spans(part, own, True, SEPARATORS)
        keys = mix(hashes ^ np.repeat(salts[i:j], np.diff(before)))
        keys[keys == 0] = 1
        gaps = np.searchsorted(np.flatnonzero(_IS_BREAK[part]), begin)
        new = np.ones(len(begin), dtype=bool)
        new[1:] = gaps[1:] != gaps[:-1]
        new[before[:-1][np.diff(before) > 0]] = True
        yield i, j, part, keys, begin, end, before, new


def _salts(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("salt").to_numpy().view(np.uint64)


def _strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    lengths = end - begin
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], lengths)
    return pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(offsets.astype(np.int32)),
                                                           pa.py_buffer(_LOWER[data[at]])])


def _released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what earlier ones held goes back to the system."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _released(batches):
        lang = batch.column("lang")
        for i, _, part, keys, begin, end, before, _ in _words(batch.column("text"), _salts(batch)):
            own, first, n = np.unique(keys, return_index=True, return_counts=True)
            text = i + np.searchsorted(before, first, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(text)), pa.array(own.view(np.int64)), _strings(part, begin[first], end[first]),
                 pa.array(n)], ["lang", "key", "word", "n"])


class Bitmap:
    """Marks of 64-bit keys, by their leading bits; packed for the way, as few are set in most."""

    def __init__(self, keys: DataFrame, column: str) -> None:
        place = F.shiftrightunsigned(F.col(column), 64 - MAP_BITS)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        rows = keys.select(F.shiftright(place, 6).alias("at"), bit.alias("bit"))
        table = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.shift, self.bits = np.uint64(64 - MAP_BITS), np.zeros(1 << (MAP_BITS - 6), dtype=np.uint64)
        self.bits[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)

    def __getstate__(self) -> dict:
        return {"shift": self.shift, "packed": zlib.compress(self.bits.tobytes(), 1)}

    def __setstate__(self, state: dict) -> None:
        self.shift, self.bits = state["shift"], np.frombuffer(zlib.decompress(state["packed"]), dtype=np.uint64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> self.shift
        return (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _streams(frequent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as the number of its words and the keys of its frequent ones, 0 where words do not adjoin."""
    marks = frequent.value
    for batch in _released(batches):
        for i, j, _, keys, _, _, before, new in _words(batch.column("text"), _salts(batch)):
            kept = marks[keys]
            texts = np.repeat(np.arange(j - i), np.diff(before))
            gap = new | ~np.concatenate([[False], kept[:-1]])  # a gap before this word
            keys, gap, texts = keys[kept], gap[kept], texts[kept]
            place = np.arange(len(keys)) + np.cumsum(gap)
            out = np.zeros(len(keys) + int(gap.sum()), dtype=np.uint64)
            out[place] = keys
            size = np.bincount(texts, minlength=j - i) + np.bincount(texts, weights=gap, minlength=j - i).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(size)]).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang")[i:j], pa.array(np.diff(before)),
                 pa.array([out[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                ["lang", "n_words", "stream"])


def _grams(batch: pa.RecordBatch, sizes: list[int], opened: Bitmap, known: list[Bitmap]) -> Iterator[tuple]:
    """Phrases of k words to count, for k in ``sizes`` and in runs of at most ``TOKENS``: k, hash, first and last word,
    hashes of the part without the last and of the part without the first word, and whether the first word is open.

    ``known[k - 3]`` marks the frequent phrases of k - 1 words. What is counted depends on the phrase's words alone, so of each
    phrase all occurrences are counted or none.
    """
    stream = text_buffer(batch.column("stream"))[0].view(np.uint64)
    for at in range(0, len(stream), TOKENS):
        keys = stream[at:at + TOKENS + max(sizes) - 1]
        n = min(TOKENS, len(keys))
        open_word, parts, whole = opened[keys], keys, keys != 0  # of k - 1 words, from each place on
        for k in range(2, max(sizes) + 1):
            parts, whole = parts[:len(keys) - k + 2], whole[:-1] & (keys[k - 1:] != 0)
            if k in sizes:
                begins = np.flatnonzero(whole[:n])
                begins = begins[open_word[begins] | open_word[begins + k - 1]]
                if k > 2:
                    frequent = known[k - 3]
                    begins = begins[~open_word[begins] | frequent[parts[begins]]]
                    begins = begins[~open_word[begins + k - 1] | frequent[parts[begins + 1]]]
                first, last, left = keys[begins], keys[begins + k - 1], parts[begins]
                yield k, mix(left * _FACTOR + last), first, last, left, parts[begins + 1], open_word[begins]
            if k < max(sizes):
                parts = mix(parts[:-1] * _FACTOR + keys[k - 1:])


def _count_grams(k: int, opened, known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = [x.value for x in known]
    for batch in _released(batches):
        for _, hashes, *_ in _grams(batch, [k], opened.value, marks):
            own, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], ["gram", "n"])


def _name_grams(opened, known, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How frequent phrases are made: a counted part and the word after it, or before it where the first is not open."""
    marks = [x.value for x in known]
    for batch in _released(batches):
        for k, hashes, begin, end, left, right, first in _grams(batch, list(range(2, len(known) + 2)), opened.value, marks):
            held = marks[k - 2][hashes]
            own, at = np.unique(hashes[held], return_index=True)
            begin, end, left, right, first = (x[held][at] for x in (begin, end, left, right, first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), k, dtype=np.int32)), pa.array(own.view(np.int64)),
                 pa.array(np.where(first, left, right).view(np.int64)), pa.array(np.where(first, end, begin).view(np.int64)),
                 pa.array(first)], ["k", "gram", "part", "key", "after"])


def _grown(stream: DataFrame, words: DataFrame, opened: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, phrase, k, f of all frequent phrases that begin or end with an opened word, and of all frequent words."""
    context = stream.sparkSession.sparkContext
    marks = context.broadcast(Bitmap(opened, "key"))
    known, counted = [], []
    for k in range(2, longest + 1):
        found = stored(map_arrow(stream.select("stream"), lambda it, k=k, known=tuple(known): _count_grams(k, marks, known, it),
                                 "gram long, n long").groupBy("gram").agg(F.sum("n").alias("f")).where(F.col("f") >= least),
                       "counts")
        if found.isEmpty():
            break
        known.append(context.broadcast(Bitmap(found, "gram")))
        counted.append(found)
    levels = [words.select("lang", F.col("key").alias("gram"), F.col("word").alias("phrase"), F.lit(1).alias("k"), "f")]
    if known:
        made = stored(map_arrow(stream.select("stream"), lambda it: _name_grams(marks, known, it),
                                "k int, gram long, part long, key long, after boolean").dropDuplicates(["k", "gram"]), "made")
    for k, found in enumerate(counted, start=2):
        part = levels[-1].select(F.col("gram").alias("part"), "lang", "phrase")
        named = made.where(F.col("k") == k).join(found, "gram").join(part, "part").join(words.select("key", "word"), "key")
        phrase = F.when(F.col("after"), F.concat_ws(" ", "phrase", "word")).otherwise(F.concat_ws(" ", "word", "phrase"))
        levels.append(stored(named.select("lang", "gram", phrase.alias("phrase"), F.lit(k).alias("k"), "f"), "phrases"))
    for sent in (marks, *known):  # what was made with them is written
        sent.destroy()
    return reduce(DataFrame.unionByName, levels)


def _first_words(phrase: Column, n: Column) -> Column:
    return F.call_function("substring_index", phrase, F.lit(" "), n)


def _scored(grown: DataFrame, limits: DataFrame) -> DataFrame:
    """Of the phrases that begin and end with opened words, those that survive: lang, phrase, a, l, r, n, score, bound."""
    counts = grown.select("lang", "phrase", "f")
    words = grown.where("k = 1")
    phrase, k = F.col("phrase"), F.col("k")
    longer = grown.where("k > 2")
    inside = longer.select("lang", _first_words(phrase, k - 1).alias("phrase"), F.col("f").alias("a")).unionByName(
        longer.select("lang", _first_words(phrase, 1 - k).alias("phrase"), F.col("f").alias("a")))
    cuts = grown.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"),
                                       F.explode(F.sequence(F.lit(1), k - 1)).alias("cut")).withColumns(
        {"left": _first_words(phrase, F.col("cut")), "right": _first_words(phrase, F.col("cut") - k)})
    parts = [counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
             for side, name in (("left", "l"), ("right", "r"))]
    firsts, lasts = (words.select("lang", F.col("phrase").alias(name), F.col("f").alias(f"f_{name}")) for name in ("first", "last"))
    both = (cuts.withColumns({"first": _first_words(phrase, F.lit(1)), "last": _first_words(phrase, F.lit(-1))})
            .join(firsts, ["lang", "first"]).join(lasts, ["lang", "last"]).join(limits, "lang")
            .where((F.col("f_first") <= F.col("limit")) & (F.col("f_last") <= F.col("limit"))))
    wide = {name: F.col(name).cast("decimal(18,0)") for name in ("a", "n", "l", "r")}
    scored = both.join(parts[0], ["lang", "left"]).join(parts[1], ["lang", "right"]).withColumn(
        "score", F.call_function("div", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)"), wide["l"] * wide["r"]))
    weakest = scored.groupBy("lang", "phrase", "a", "n", "bound").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    return weakest.join(inside.distinct(), ["lang", "phrase", "a"], "left_anti").select(
        "lang", "phrase", "a", "least.l", "least.r", "n", "least.score", "bound")


def _limits(words: DataFrame, totals: DataFrame, share: float) -> DataFrame:
    """Per language: n, the largest count of an opened word, and the bound of all that is not opened (-1: nothing is left).

    Words are opened from the rarest on, all of one count together. A language has at most sqrt(2 n) different counts.
    """
    steps = words.groupBy("lang", "f").agg((F.col("f") * F.count("*")).alias("here"))
    rising = Window.partitionBy("lang").orderBy("f")
    all_of = Window.partitionBy("lang")
    placed = steps.withColumns({"upto": F.sum("here").over(rising), "all": F.sum("here").over(all_of),
                                "least": F.min("f").over(all_of)})
    is_open = (F.col("upto") <= F.col("all") * share) | (F.col("f") == F.col("least")) | F.lit(share >= 1)
    ends = placed.groupBy("lang").agg(F.max(F.when(is_open, F.col("f"))).alias("limit"),
                                      F.min(F.when(~is_open, F.col("f"))).alias("next"))
    return ends.join(totals, "lang").select("lang", "n", "limit", F.coalesce(
        F.expr("cast(n as decimal(18,0)) * 1000 div next"), F.lit(-1)).cast("long").alias("bound"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 shares: tuple[float, ...] = SHARES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases.

    ``docs`` has text and lang; other columns are not used. A NULL text counts as empty, a NULL lang as ``und``. Repeated
    rows count as often as they occur. Equal scores rank by count, then by phrase in byte order. Languages without a phrase
    that occurs ``least`` times have no rows; so has an empty table.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("salt"), "text")
    words = stored(map_arrow(texts, _count_words, "lang string, key long, word string, n long")
                   .groupBy("lang", "key", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "words")
    frequent = docs.sparkSession.sparkContext.broadcast(Bitmap(words, "key"))
    stream = stored(map_arrow(texts, lambda it: _streams(frequent, it), "lang string, n_words long, stream binary"), "streams")
    frequent.destroy()
    totals = stored(stream.groupBy("lang").agg(F.sum("n_words").alias("n")), "totals")
    ranking = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    settled = []
    for share in shares:
        limits = stored(_limits(words, totals, share), "limits")
        opened = words.join(limits, "lang").where(F.col("f") <= F.col("limit"))
        grown = _grown(stream, words, opened, longest, least)
        best = stored(_scored(grown, limits).withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top), "best")
        above = best.where(F.col("score") > F.col("bound")).groupBy("lang").agg(F.count("*").alias("above"))
        done = stored(limits.join(above, "lang", "left").where((F.col("bound") < 0) | (F.col("above") >= top)).select("lang"), "done")
        settled.append(best.join(done, "lang", "left_semi"))
        words, stream, totals = (x.join(done, "lang", "left_anti") for x in (words, stream, totals))
        if totals.isEmpty() or words.isEmpty():
            break
    return reduce(DataFrame.unionByName, settled).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
                                                         "l", "r", "n", "score")
