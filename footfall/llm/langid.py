"""Language identification by prediction by partial matching over bytes.

Per language a context tree holds, for each context of up to ``ORDER`` bytes, how often each byte followed in the
training texts. The statistics are frozen. A byte x after a context costs -log2 of count / (total + distinct) if x was
seen there; else the escape, distinct / (total + distinct), and the cost of x in the context without its first byte;
an unseen context passes on at no cost; below the empty context all 256 bytes are equally likely. Texts are put in
lower case first and begin after ``ORDER`` newlines.

The language with the least total cost wins, by name among equals. Its score is its posterior under equal priors.

Bounds: each language is learned from about ``SAMPLE_BYTES`` of its distinct texts (all, if there are fewer), taken in
the order of a hash until that many bytes are reached. A text counts with ``TEXT_BYTES`` at most, from windows over its whole length; where that
leaves room, all texts are taken and the longer ones share the room evenly. All their contexts are
kept, as costs per language, context and byte seen and escapes per language and context; so memory follows the sample,
whatever the number of languages and byte values. Every text is scored whole, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.storage import map_arrow, stored
from footfall.llm.words import text_buffer

ORDER = 3
SAMPLE_BYTES = 4_000_000
TEXT_BYTES = SAMPLE_BYTES // 16
WINDOWS = 8
UNKNOWN = "und"
RAW_BITS = 8.0
_CELL_BLOCK = 4_000_000
_HASH_BITS = 60
_LEVEL_BITS = 12


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each after ``ORDER`` newlines; the places of the texts' own bytes; each text's first."""
    data, starts = text_buffer(pc.utf8_lower(column))
    n = len(starts) - 1
    shift = np.repeat(ORDER * np.arange(1, n + 1), np.diff(starts))
    out = np.full(len(data) + ORDER * n, 10, dtype=np.uint8)
    places = np.arange(len(data)) + shift
    out[places] = data
    return out, places, starts


def _slices(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes."""
    _, starts = text_buffer(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of 4-grams that end in the first ``most`` bytes of each text."""
    for batch in batches:
        names = batch.column("lang").to_pylist()
        for name in sorted(set(names)):
            own = batch.filter(pa.array([x == name for x in names]))
            for i, j in _slices(own.column("text")):
                data, places, starts = _padded(own.column("text")[i:j])
                most = own.column("most")[i:j].to_numpy()
                places = places[np.arange(len(places)) < np.repeat(starts[:-1] + most, np.diff(starts))]
                wide = data.astype(np.uint32)
                grams = wide[places]
                for k in range(1, ORDER + 1):
                    grams |= wide[places - k] << np.uint32(8 * k)
                grams, counts = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
                    ["lang", "gram", "n"])


class Model:
    """Frozen counts of byte 4-grams per language; the cost tables are built once per Python worker."""

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.names = sorted(grams)
        self.grams = [grams[name] for name in self.names]
        self._tables: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tables": None}

    def _counts(self, language: int, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Context and byte as one number, ascending, and counts."""
        grams, counts = self.grams[language]
        keys, where = np.unique(grams & ((1 << (8 * order + 8)) - 1), return_inverse=True)
        return keys, np.bincount(where, weights=counts, minlength=len(keys))

    def tables(self) -> tuple[list, list, list]:
        """Per language, a list by order: contexts with escapes; contexts with a byte; the costs of the latter."""
        if self._tables is None:
            self._tables = self._build()
        return self._tables

    def _build(self) -> tuple[list, list, list]:
        escapes, seen, costs = [], [], []
        for i in range(len(self.names)):
            own = []
            for order in range(ORDER + 1):
                keys, count = self._counts(i, order)
                contexts, at, distinct = np.unique(keys >> 8, return_inverse=True, return_counts=True)
                total = np.bincount(at, weights=count, minlength=len(contexts))
                escape = -np.log2(distinct / (total + distinct))
                cost = -np.log2(count / (total + distinct)[at])
                own.append(((contexts.astype(np.uint32), escape.astype(np.float32)), keys.astype(np.uint32),
                            cost.astype(np.float32)))
            for whole, part in zip((escapes, seen, costs), zip(*own, strict=True), strict=True):
                whole.append(list(part))
        return escapes, seen, costs

    def _gram_costs(self, grams: np.ndarray, language: int) -> np.ndarray:
        """The cost of each gram's last byte after its first ``ORDER``; ``grams`` ascend, each once."""
        escapes, seen, costs = (part[language] for part in self.tables())
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for order in range(ORDER, -1, -1):
            keys = grams[left] & np.uint32((1 << (8 * order + 8)) - 1)
            at, found = _places(seen[order], keys)
            out[left[found]] += costs[order][at[found]]
            left, keys = left[~found], keys[~found]
            contexts, escape = escapes[order]
            at, found = _places(contexts, keys >> np.uint32(8))
            out[left[found]] += escape[at[found]]
        out[left] += RAW_BITS
        return out

    def bits(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Code length of every text under every language, and the texts' bytes."""
        data, places, starts = _padded(column)
        total = np.zeros((len(starts) - 1, len(self.names)))
        for a in range(0, len(places), _CELL_BLOCK):
            at = places[a:a + _CELL_BLOCK]
            grams = data[at].astype(np.uint32)
            for k in range(1, ORDER + 1):
                grams |= data[at - k].astype(np.uint32) << np.uint32(8 * k)
            grams, which = np.unique(grams, return_inverse=True)
            text = int(np.searchsorted(starts, a, side="right")) - 1
            inner = np.unique(np.concatenate([[a], starts[(starts > a) & (starts < a + len(at))]]))
            texts = np.searchsorted(starts, inner, side="right") - 1
            texts[0] = text
            for i in range(len(self.names)):
                total[texts, i] += np.add.reduceat(self._gram_costs(grams, i)[which], inner - a)
        return total, np.diff(starts)


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each number is in ascending ``keys``, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def held_out(column: str, parts: int, remainder: int = 0) -> Column:
    """Whether the id's CRC-32, as text, leaves ``remainder``; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts == remainder


def _level(sizes: list[int], room: int) -> int:
    """The length to which the longest of ``sizes`` are cut so that together they fill ``room``, less than their sum."""
    left = sorted(sizes)
    while left and left[0] * len(left) <= room:
        room -= left.pop(0)
    return room // max(1, len(left))


def _limits(sizes: DataFrame, names: list[str]) -> dict[str, int]:
    """Per language the spread below which its texts reach ``SAMPLE_BYTES``, from ``sizes`` (lang, spread, n).

    Spreads are counted by their leading bits; where the last group holds much, it is divided by the bits that follow.
    So a language exceeds the bound by little or by one text, and at most 2**``_LEVEL_BITS`` sums of it reach the driver.
    """
    spark, out, before = sizes.sparkSession, {}, dict.fromkeys(names, 0)
    rows = sizes.withColumn("n", F.least("n", F.lit(TEXT_BYTES)))
    last = dict.fromkeys(names, 0)
    for shift in range(_HASH_BITS - _LEVEL_BITS, -1, -_LEVEL_BITS):
        if not last:
            break
        groups = spark.createDataFrame(list(last.items()), "lang string, last long")
        counted = rows.join(F.broadcast(groups), "lang").where(
            F.shiftright("spread", shift + _LEVEL_BITS) == F.col("last")).groupBy(
            "lang", F.shiftright("spread", shift).alias("group")).agg(F.sum("n").alias("n")).toArrow()
        open_names, last = list(last), {}
        for name in open_names:
            own = counted.filter(pc.equal(counted.column("lang"), name)).sort_by("group")
            group, n = own.column("group").to_numpy(), own.column("n").to_numpy()
            upto = before[name] + np.cumsum(n)
            k = int(np.searchsorted(upto, SAMPLE_BYTES))
            if shift and n[k] > SAMPLE_BYTES // 64:
                last[name], before[name] = int(group[k]), int(upto[k] - n[k])
            else:
                out[name] = int(group[k] + 1) << shift
    return out


def _windows(text: Column, most: Column) -> Column:
    """The text if it has at most ``most`` bytes, else ``WINDOWS`` windows evenly spread from its first to its last
    character, of about so many bytes together."""
    length = F.char_length(text)
    size = F.ceil(most * length / F.octet_length(text) / WINDOWS).cast("int")
    starts = [F.floor((length - size) * k / (WINDOWS - 1)).cast("int") + 1 for k in range(WINDOWS)]
    return F.when(F.octet_length(text) <= most, text).otherwise(F.concat(*[F.substring(text, at, size) for at in starts]))


def _sample(rows: DataFrame) -> DataFrame | None:
    """(lang, text, most): each text to learn from once, and how many of its bytes; None if there is none.

    The sizes of distinct texts are stored, as one narrow row each. Texts are the same if their 64-bit hashes are.
    """
    hashed = rows.withColumn("spread", F.shiftrightunsigned(F.xxhash64("text"), 64 - _HASH_BITS))
    sizes = stored(hashed.groupBy("lang", "spread").agg(F.max(F.octet_length("text")).cast("long").alias("n")), "sizes")
    totals = sizes.groupBy("lang").agg(
        F.sum("n").alias("all"), F.sum(F.least("n", F.lit(TEXT_BYTES))).alias("cut")).collect()
    if not totals:
        return None
    chosen = {row["lang"]: (1 << _HASH_BITS, SAMPLE_BYTES) for row in totals}
    many = [row["lang"] for row in totals if row["cut"] >= SAMPLE_BYTES]
    chosen |= {name: (limit, TEXT_BYTES) for name, limit in _limits(sizes, many).items()}
    few = {row["lang"]: row for row in totals if row["cut"] < SAMPLE_BYTES < row["all"]}
    if few:  # fewer than SAMPLE_BYTES / TEXT_BYTES texts of such a language are long
        long: dict[str, list[int]] = {}
        for row in sizes.where(F.col("lang").isin(*few) & (F.col("n") > TEXT_BYTES)).select("lang", "n").collect():
            long.setdefault(row["lang"], []).append(row["n"])
        for name, own in long.items():
            short = few[name]["cut"] - TEXT_BYTES * len(own)
            chosen[name] = 1 << _HASH_BITS, _level(own, SAMPLE_BYTES - short)
    bounds = rows.sparkSession.createDataFrame(
        [(name, limit, most) for name, (limit, most) in chosen.items()], "lang string, limit long, most long")
    taken = hashed.join(F.broadcast(bounds), "lang").where(F.col("spread") < F.col("limit"))
    return taken.select("lang", "spread", "most", _windows(F.col("text"), F.col("most")).alias("text")).groupBy("lang", "spread", "most").agg(F.min("text").alias("text")).select("lang", "text", "most")


def learn(docs: DataFrame) -> Model:
    """Context trees from the rows of ``docs`` (text, lang) that have both.

    Only sums per language and the counts of the bounded sample reach the driver.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), "text").where("lang IS NOT NULL AND text <> ''")
    sample = _sample(rows)
    if sample is None:
        return Model({})
    counted = map_arrow(sample, _count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")).toArrow()
    name, gram, n = (counted.column(c) for c in ("lang", "gram", "n"))
    return Model({x: (gram.filter(pc.equal(name, x)).to_numpy(), n.filter(pc.equal(name, x)).to_numpy().astype(float))
                  for x in pc.unique(name).to_pylist()})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and bits_per_byte; columns of these names are replaced.

    A text that is NULL or has no letter, and every text if no language was learned, is ``und`` with score 0; its
    bits_per_byte is NULL. Repeated rows are scored alike; no rows give no rows.
    """
    kept = [name for name in docs.columns if name not in ("lang_pred", "score", "bits_per_byte")]
    plain = docs.select(*[F.col(f"`{name}`") for name in kept])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in plain.schema]
                          + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                             T.StructField("bits_per_byte", T.DoubleType())])
    if not model.names:
        return plain.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                            F.lit(None).cast("double").alias("bits_per_byte"))
    shared, text = docs.sparkSession.sparkContext.broadcast(model), kept.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        names = np.array(trees.names, dtype=object)
        for whole in batches:
            for i, j in _slices(whole.column(text)):
                batch = whole.slice(i, j - i)
                bits, size = trees.bits(batch.column(text))
                has_letter = pc.fill_null(pc.match_substring_regex(batch.column(text), r"\p{L}"), False).to_numpy(
                    zero_copy_only=False)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(bits)), best]
                odds = np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
                rate = least / np.maximum(size, 1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.where(has_letter, names[best], UNKNOWN), pa.string()),
                     pa.array(np.where(has_letter, 1 / odds, 0.0)), pa.array(rate, mask=~has_letter)], schema.names)

    return map_arrow(plain, predict, schema)


def accepted(identified: DataFrame) -> DataFrame:
    """Rows whose text has a letter and is coded by some language in fewer bits than its bytes have.

    So NULL and empty texts go, and all rows if no language was learned; repeated rows stay or go together.
    """
    return identified.where((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < RAW_BITS))
