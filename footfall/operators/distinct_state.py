"""Mergeable distinct counts: exact by sets of ids, approximate by HyperLogLog sketches.

A state table has one row per (group, bucket of 32,768 ids): a row sum, the ids seen and a sketch of the sessions. The
ids of a bucket are a sorted list of 16-bit positions while there are at most ``FEW``, and a bitmap of 4 KB beyond; so
sparse ids cost a few bytes each, and a full bucket one bit each. Rows of one key merge by sum, set union and sketch
union, so states roll up to any coarser group without the detail, and partial loads merge on read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "uv_bucket"
FEW = 1024
MEASURES_DDL = f"{BUCKET} BIGINT, pv BIGINT, uv_ids ARRAY<SMALLINT>, uv_bits BINARY, session_hll BINARY"
_ENTRY = "STRUCT<pv: BIGINT, hll: BINARY, id: SMALLINT>"
_WORDS = 512
_KEY = "__key"


def _grouped(rows: DataFrame, by: Sequence[str]):
    """Rows by ``by`` and bucket. Sets and sketches are aggregated in sorted order; a number in front sorts fast."""
    return rows.groupBy(F.xxhash64(*by, BUCKET).alias(_KEY), *by, BUCKET)


def _bits_of(ids: Column) -> Column:
    """The bitmap of sorted positions, as ``bitmap_construct_agg`` lays it out: 64 positions a word, least byte first."""
    zero = F.lit(0).cast("long")

    def bit(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int").bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)))

    def add(done: Column, i: Column) -> Column:
        word = F.call_function("shiftright", i.cast("int"), F.lit(6))
        gap = F.array_repeat(zero, word - done["word"] - 1)
        return F.when(word == done["word"], F.struct(done["words"], done["word"], done["bits"].bitwiseOR(bit(i)).alias("bits"))) \
            .otherwise(F.struct(F.concat(done["words"], F.array(done["bits"]), gap).alias("words"), word.alias("word"),
                                bit(i).alias("bits")))

    start = F.struct(F.array().cast("array<bigint>").alias("words"), F.lit(0).alias("word"), zero.alias("bits"))
    words = F.aggregate(ids, start, add, lambda done: F.concat(
        done["words"], F.array(done["bits"]), F.array_repeat(zero, F.lit(_WORDS - 1) - done["word"])))
    return F.unhex(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(w), 16, "0")), ""))


def _either(a: Column, b: Column) -> Column:
    """The union of two bitmaps, word by word."""
    def word(bits: Column, k: Column) -> Column:
        return F.conv(F.hex(F.substring(bits, 8 * k + 1, F.lit(8))), 16, -10).cast("long")

    # The array of one makes each side once, not once per word.
    return F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), lambda both: F.unhex(F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda k: F.lpad(
            F.hex(word(both["a"], k).bitwiseOR(word(both["b"], k))), 16, "0")), "")))[0]


def build_state(rows: DataFrame, by: Sequence[str], pv: str = "pv", user: str = "user_id",
                session: str = "session_id") -> DataFrame:
    """State of ``rows`` at the grain ``by``. Rows without a user fall in the NULL bucket.

    Only buckets of more than ``FEW`` ids ever take the room of a bitmap.
    """
    keyed = rows.select(
        *by, F.col(pv).alias("pv"), F.col(session).alias("__session"),
        F.bitmap_bucket_number(F.col(user)).alias(BUCKET),
        F.bitmap_bit_position(F.col(user)).cast("smallint").alias("__bit"))
    sets = _grouped(keyed, by).agg(
        F.sum("pv").alias("pv"), F.collect_set("__bit").alias("__ids"), F.hll_sketch_agg("__session").alias("session_hll"))
    few = F.size("__ids") <= FEW
    ids = F.array_sort("__ids")
    return sets.select(*by, BUCKET, "pv", F.when(few, ids).alias("uv_ids"), F.when(~few, _bits_of(ids)).alias("uv_bits"),
                       "session_hll")


def merge_state(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """Merge states that share a key, or roll them up to the coarser grain ``by``.

    Bitmaps are united first. Then listed ids become rows, which are combined before the shuffle; a bucket that anywhere
    is a bitmap stays one.
    """
    none = F.lit(None)
    united = _grouped(states.where(F.col("uv_bits").isNotNull()), by).agg(
        F.sum("pv").alias("pv"), F.hll_union_agg("session_hll").alias("hll"), F.bitmap_or_agg("uv_bits").alias("bits"))
    whole = F.struct(F.col("pv"), F.col("session_hll").alias("hll"), none.alias("id"))
    single = F.transform(F.coalesce("uv_ids", F.array().cast("array<smallint>")), lambda i: F.struct(
        none.alias("pv"), none.alias("hll"), i.alias("id")).cast(_ENTRY))
    listed = states.where(F.col("uv_bits").isNull()).select(
        *by, BUCKET, F.explode(F.concat(F.array(whole.cast(_ENTRY)), single)).alias("e"))
    entries = listed.select(*by, BUCKET, "e.*", none.cast("binary").alias("bits")).unionByName(
        united.select(*by, BUCKET, "pv", "hll", none.cast("smallint").alias("id"), "bits"))
    sums = _grouped(entries, by).agg(
        F.sum("pv").alias("pv"), F.hll_union_agg("hll").alias("session_hll"), F.collect_set("id").alias("__ids"),
        F.first("bits", ignorenulls=True).alias("__bits"))
    few = F.col("__bits").isNull() & (F.size("__ids") <= FEW)
    ids = F.array_sort("__ids")
    bits = F.when(F.col("__bits").isNull(), _bits_of(ids)).when(F.size("__ids") == 0, F.col("__bits")).otherwise(
        _either(F.col("__bits"), _bits_of(ids)))
    return sums.select(*by, BUCKET, "pv", F.when(few, ids).alias("uv_ids"), F.when(~few, bits).alias("uv_bits"), "session_hll")


def count_state(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """``pv``, exact ``uv`` and estimated ``session_cnt`` per group of states that are at the grain ``by``, one per bucket."""
    ids = F.coalesce(F.size("uv_ids"), F.bitmap_count("uv_bits"))
    return states.groupBy(*by).agg(
        F.sum("pv").alias("pv"),
        F.sum(F.when(F.col(BUCKET).isNotNull(), ids).otherwise(0)).alias("uv"),
        F.hll_sketch_estimate(F.hll_union_agg("session_hll")).alias("session_cnt"))


def read_state(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """``pv``, exact ``uv`` and estimated ``session_cnt`` per group."""
    return count_state(merge_state(states, by), by)
