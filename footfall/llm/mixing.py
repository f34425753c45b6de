"""Mixing sources to target weights by Pareto order sampling.

Size is counted in words. Sources, ordered by code point with NULL last, weigh 1, 2, 3, 1, 2, 3, ... and share all words
by weight; a target stops at ``MOST`` times its source's size and the excess is shared again until none is above.

With target / size = whole + share, every document of the source is taken ``whole`` times for certain, and once more
with an inclusion probability p of its own. Short documents are likelier than long ones, so that a source's words come
from more documents: with length = n / (n + ``MIDDLE``) of a document of n words, in 1,024ths, and its mean over the
source's words, p = share + min(share, 1 - share) * (mean - length). As lengths are below 1, p lies strictly between
0 and 1, and the words expected are share of the source's, exactly its rest.

The extra takes are a fixed-size sample: documents are ranked by their random odds u / (1 - u) divided by the inclusion
odds p / (1 - p), and those of least rank are taken until the source's remaining words are reached; the last one is
taken if that comes nearer. u is a hash of the id, so reruns agree.

The rank at which a source's words are reached is found without ordering a source: words are summed in 4,096 bins of
the rank, then in 4,096 bins of the bin that crosses the target, then by document in what is left of that, one
16-millionth of the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.storage import stored

WEIGHTS = (1, 2, 3)
MOST = 3
MIDDLE = 256
SEED = "mix"
BINS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def random_number(doc_id: str | Column) -> Column:
    """A number above 0 and below 1 from the id; a NULL id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(column.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def _length() -> Column:
    """How long a document is, from 0 to 1,023; integers, so that sums do not depend on their order."""
    return F.expr(f"(size * 1024) div (size + {MIDDLE})")


def _targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, lengths) -> with target. One row per source is ordered; only sums reach the driver."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = stored(sizes.select("source", "source_size", "lengths", weight.alias("weight")), "weights")
    most = F.col("source_size") * MOST
    total, weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (total / weights if weights else 0.0), -1
    while True:
        above = F.col("weight") * F.lit(level) > most
        n, stopped, open_weight = weighed.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (total - stopped) / open_weight
    return weighed.select("source", "source_size", "lengths",
                          F.least(most.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def _inclusion() -> Column:
    """A document's inclusion probability from its size and its source's share and mean length."""
    lean = (F.col("mean_length") - _length()) / 1024.0
    return F.col("share") + F.least(F.col("share"), 1 - F.col("share")) * lean


def _rank() -> Column:
    """The Pareto rank q, as q / (1 + q), which orders alike and lies between 0 and 1."""
    odds = (F.col("u") / (1 - F.col("u"))) / (_inclusion() / (1 - _inclusion()))
    return F.when(F.col("share") > 0, odds / (1 + odds))


def _crossing(rows: DataFrame, cell: Column) -> DataFrame:
    """Per source the first cell at which the words taken reach ``rest``: source, cell, words before it, its words."""
    sums = rows.groupBy("source", "rest", "before", cell.alias("cell")).agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("cell")
    reached = F.col("before") + F.sum("words").over(order)
    return (sums.withColumn("reached", reached).where("reached >= rest and reached - words < rest")
            .select("source", "rest", "cell", (F.col("reached") - F.col("words")).alias("before"), "words"))


def plan(sized: DataFrame) -> DataFrame:
    """(source, size, u) per document -> per source: source_size, target, whole, share, mean_length, cutoff, with_cutoff.

    A document is taken ``whole`` times, and once more if its rank is below ``cutoff``, or equal to it where
    ``with_cutoff`` is set.
    """
    lengths = F.sum((F.col("size") * _length()).cast("decimal(19,0)")).alias("lengths")
    sources = _targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), lengths))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = sources.withColumn("whole", F.floor(ratio)).withColumn("share", ratio - F.col("whole")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size"))
    mean = F.when(F.col("source_size") > 0, F.col("lengths").cast("double") / F.col("source_size")).otherwise(0.0)
    sources = stored(sources.withColumn("mean_length", mean).drop("lengths"), "sources")

    part = sources.where("share > 0").select(F.col("source").alias("s"), "share", "mean_length", "rest")
    ranked = sized.join(part, F.col("source").eqNullSafe(F.col("s"))).select("source", "rest", "size", _rank().alias("rank"))
    ranked = stored(ranked, "ranked")

    def inside(cells: DataFrame, bins: int) -> DataFrame:
        found = cells.select(F.col("source").alias("s"), "cell", "before")
        return ranked.join(found, F.col("source").eqNullSafe(F.col("s")) & (F.floor(F.col("rank") * bins) == F.col("cell"))
                           ).select("source", "rest", "before", "size", "rank")

    coarse = stored(_crossing(ranked.withColumn("before", F.lit(0).cast("long")), F.floor(F.col("rank") * BINS)), "coarse")
    fine = stored(_crossing(inside(coarse, BINS), F.floor(F.col("rank") * BINS * BINS)), "fine")
    last = _crossing(inside(fine, BINS * BINS), F.col("rank"))
    nearer = F.col("before") + F.col("words") - F.col("rest") <= F.col("rest") - F.col("before")
    cutoffs = last.select(F.col("source").alias("s"), F.col("cell").alias("cutoff"), nearer.alias("with_cutoff"))
    return stored(sources.join(cutoffs, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "rest"), "plan")


def _copies() -> Column:
    taken = (_rank() < F.col("cutoff")) | ((_rank() == F.col("cutoff")) & F.col("with_cutoff"))
    return (F.col("whole") + F.coalesce(F.when(taken, 1), F.lit(0))).cast("long")


def _sized(docs: DataFrame) -> DataFrame:
    return stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count("text").alias("size"),
                              random_number("doc_id").alias("u")), "sized")


def _with_plan(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return rows.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")


def mixture(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, copies.

    A text that is NULL, empty or blank has size 0; it is copied like the others, but no words are taken. NULL is a source
    of its own, the last. Rows of one id share one random number, so repeated rows of a source are taken or left
    together. Without words all targets are 0; without rows there is no result row. Other columns are not used.
    """
    sized = _sized(docs)
    return _with_plan(sized, plan(sized)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"), _copies().alias("copies"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mixture takes it; no text is shuffled.

    A NULL or empty text, or one without a word, has no size; its row is copied like the others. A NULL source is a source of
    its own, the last one. No rows give no rows.
    """
    kept = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    rows = kept.select("row", F.col("row.source").cast("string").alias("source"), word_count("row.text").alias("size"),
                       random_number("row.doc_id").alias("u"))
    taken = _with_plan(rows, plan(_sized(docs))).withColumn("copy", F.explode(F.array_repeat(F.lit(0), _copies().cast("int"))))
    return taken.select("row.*")
