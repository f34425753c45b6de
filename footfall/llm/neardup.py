"""Near-duplicate groups by a multi-index Hamming join over b-bit minhash signatures.

A text's set is its distinct word shingles. A signature holds ``SYMBOLS`` minhash values cut to ``BITS`` bits; two sets
of similarity J agree in about J of them. The signature distance is the number of symbols that differ. The symbols are
split into ``CHUNKS`` chunks of ``WIDTH``: two signatures that differ in at most ``RADIUS`` symbols have, by
pigeonhole, a chunk with at most one error. The allowed chunk errors are enumerated by leaving out each symbol of a
chunk in turn, so such two meet under an equal key: no pair within ``RADIUS`` is lost.

At similarity 0.75 a distance is 31.3 on average (binomial of 125 and 0.25, deviation 4.8); 50 or more comes up once
in some 10,000 pairs that are exactly at the threshold, and practically never above 0.8.

Equal sets are collapsed to one class first. Under each key all classes are compared with the smallest; verified
links make groups. Of the classes under keys that still hold several groups those go that can have no further link: a link
shares at least 3/7 of both sizes together, and a class shares no shingle that only it has. Around a large group of near
copies that is most of what is not in it, so nearly all its keys are done with, by counts that take one pass. Then the keys of
three or more classes that still hold several groups are searched in full, group against group, in blocks, for pairs
within ``RADIUS``. Before such a pair leaves its task it is held against the ``LEAST`` smallest hashes of both sets: that is
the similarity itself, but for hash collisions, of sets up to that size, and an estimate with a deviation of 0.014 of
larger ones, which pass from ``LEAST_SHARE`` on. Nearest pairs come first; a pair that is a link beyond doubt joins its
groups there and then, and pairs of groups so joined are left out, as they change nothing. So a large group of texts that
are alike, but not enough, is compared without sending its pairs anywhere. Every link counts only when confirmed on the
full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components
from footfall.llm.storage import map_arrow, stored
from footfall.llm.words import chunks, mix, odd_numbers, text_buffer, text_shingles

WIDTH = 5
CHUNKS = 25
SYMBOLS = WIDTH * CHUNKS
RADIUS = 2 * CHUNKS - 1
BITS = 16
SIMILARITY = 75
BLOCK_ROWS = 1000
ELEMENTS = 1 << 17
LEAST = 1024
LEAST_SHARE = 0.66
DOUBT = 1
BROADCAST_ROWS = 1_000_000
ROW_KEY = "__row_key"

_PERMUTATIONS = odd_numbers(101, SYMBOLS)
_SLOT_SALTS = odd_numbers(103, SYMBOLS)
_CLASS_SALT = np.uint64(odd_numbers(107, 1)[0])
_SLOT_MASK = np.uint64(127)


def _binary(rows: np.ndarray) -> pa.Array:
    """A byte matrix as a column of equally long binaries."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _signatures(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One row of symbols per set; empty sets have zeros."""
    out = np.zeros((len(before) - 1, SYMBOLS), dtype=np.uint16)
    full = np.flatnonzero(np.diff(before) > 0)
    if len(full):
        product = np.empty_like(values)
        for k in range(SYMBOLS):
            np.multiply(values, _PERMUTATIONS[k], out=product)
            out[full, k] = np.minimum.reduceat(product, before[full]).astype(np.uint16)
    return out


def _class_ids(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """A hash of each set that does not depend on order."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(mix(values ^ _CLASS_SALT), out=sums[1:])
    return mix(sums[before[1:]] - sums[before[:-1]] + np.diff(before).astype(np.uint64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for i, j, values, before in text_shingles(text):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[i:j], batch.column("text_hash")[i:j], pa.array(np.diff(before)),
                 pa.array(_class_ids(values, before).view(np.int64)),
                 _binary(_signatures(values, before).view(np.uint8))],
                ["doc_id", "text_hash", "n_shingles", "class_id", "signature"])


def _matrix(column: pa.Array) -> np.ndarray:
    return text_buffer(column)[0].view(np.uint16).reshape(len(column), SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each class: one per chunk and symbol left out. The lowest seven bits tell chunk and symbol."""
    for whole in batches:
        for at in range(0, len(whole), 1000):
            batch = whole.slice(at, 1000)
            symbols = _matrix(batch.column("signature")).astype(np.uint64)
            ids, sizes = batch.column("class_id").to_numpy(), batch.column("n_shingles").to_numpy()
            keys = np.empty((len(ids), SYMBOLS), dtype=np.uint64)
            for slot in range(SYMBOLS):
                chunk, left_out = divmod(slot, WIDTH)
                key = np.zeros(len(ids), dtype=np.uint64)
                for k in range(WIDTH):
                    if k != left_out:
                        key = (key << np.uint64(BITS)) | symbols[:, chunk * WIDTH + k]
                keys[:, slot] = (mix(key ^ _SLOT_SALTS[slot]) & ~_SLOT_MASK) | np.uint64(slot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, SYMBOLS)),
                 pa.array(np.repeat(sizes, SYMBOLS))], ["key", "class_id", "n_shingles"])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures differ in at most ``RADIUS`` symbols."""
    for batch in batches:
        errors = (_matrix(batch.column("signature_a")) != _matrix(batch.column("signature_b"))).sum(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(errors <= RADIUS))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, values, before in text_shingles(batch.column("text")):
            raw = values.tobytes()
            parts = [raw[8 * a:8 * b] for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_class_ids(values, before).view(np.int64)), pa.array(parts, pa.binary())], ["class_id", "items"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the similarity."""
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("items_a"), batch.column("items_b"), strict=True):
            x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= SIMILARITY * (len(both) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _likeness(x: np.ndarray, y: np.ndarray, size_x: int, size_y: int) -> int:
    """Of two sets, by their least hashes in order: 0 if they are no link, 2 if they are one beyond doubt, else 1."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    new = np.concatenate([[True], both[1:] != both[:-1]])
    if size_x <= LEAST and size_y <= LEAST:
        union = int(new.sum())
        shared = 100 * (len(both) - union)
        return int(shared >= (SIMILARITY - DOUBT) * union) + int(shared >= (SIMILARITY + DOUBT) * union)
    end = np.flatnonzero(new)[:LEAST + 1]
    upto = int(end[LEAST]) if len(end) > LEAST else len(both)
    return int(upto - min(len(end), LEAST) >= LEAST_SHARE * min(len(end), LEAST))


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set the least hashes, cut to 32 bits, in order."""
    for batch in batches:
        parts = [np.unique((mix(np.frombuffer(items.as_buffer(), np.uint64).copy()) >> np.uint64(32)).astype(np.uint32))[:LEAST]
                 .tobytes() for items in batch.column("items")]
        yield pa.RecordBatch.from_arrays([batch.column("class_id"), pa.array(parts, pa.binary())], ["class_id", "least"])


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per set and element, at most ``ELEMENTS`` at once, or one set."""
    for batch in batches:
        values, starts = text_buffer(batch.column("items"))
        for i, j in chunks(starts, 8 * ELEMENTS):
            ids = np.repeat(batch.column("class_id").to_numpy()[i:j], np.diff(starts[i:j + 1]) // 8)
            items = np.frombuffer(values[starts[i]:starts[j]].tobytes(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(ids)], ["item", "class_id"])


def _group_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and block pair: pairs of different groups within ``RADIUS``, each under one key only.

    A pair meets under several keys; it counts under its first chunk with at most one error, the erring symbol (else
    the first) left out. A pair with the key's smallest class was compared before.
    """
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["a", "b"])

    def found(table: pa.Table) -> pa.RecordBatch:
        names = ("key", "bi", "bj", "block", "class_id", "label", "center", "n_shingles")
        key, bi, bj, block, node, label, center, size = (table.column(n).to_numpy() for n in names)
        symbols = _matrix(table.column("signature").combine_chunks())
        least = [np.frombuffer(v, np.uint32) for v in table.column("least").to_pylist()]
        a_side, b_side, errors, step = [], [], [], 1
        while step < len(key):
            same = (key[step:] == key[:-step]) & (bi[step:] == bi[:-step]) & (bj[step:] == bj[:-step])
            if not same.any():
                break
            i = np.flatnonzero(same)
            j = i + step
            low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            wanted = ((label[i] != label[j]) & ((bi[i] == bj[i]) | (block[i] != block[j])) & (node[i] != center[i])
                      & (node[j] != center[j]) & (100 * low >= SIMILARITY * high))
            i, j = i[wanted], j[wanted]
            for at in range(0, len(i), 20_000):
                p, q = i[at:at + 20_000], j[at:at + 20_000]
                wrong = symbols[p] != symbols[q]
                distance = wrong.sum(axis=1)
                near = distance <= RADIUS
                p, q, wrong = p[near], q[near], wrong[near].reshape(-1, CHUNKS, WIDTH)
                first = (wrong.sum(axis=2) <= 1).argmax(axis=1)
                left_out = wrong[np.arange(len(p)), first].argmax(axis=1)
                own = (key[p].view(np.uint64) & _SLOT_MASK) == (first * WIDTH + left_out).astype(np.uint64)
                a_side.append(p[own])
                b_side.append(q[own])
                errors.append(distance[near][own])
            step += 1
        if not a_side:
            return empty
        p, q, distance = np.concatenate(a_side), np.concatenate(b_side), np.concatenate(errors)
        order = np.argsort(distance, kind="stable")
        joined: dict[int, int] = {}

        def group(own: int) -> int:
            while own in joined:
                own = joined[own]
            return own

        kept = []
        for k, one, other in zip(order.tolist(), label[p[order]].tolist(), label[q[order]].tolist(), strict=True):
            one, other = group(one), group(other)
            if one != other and (like := _likeness(least[p[k]], least[q[k]], size[p[k]], size[q[k]])):
                kept.append(k)
                if like == 2:
                    joined[max(one, other)] = min(one, other)
        p, q = p[kept], q[kept]
        return pa.RecordBatch.from_arrays([pa.array(node[p]), pa.array(node[q])], ["a", "b"])

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        key, bi, bj = (table.column(n).to_numpy() for n in ("key", "bi", "bj"))
        if not len(key):
            continue
        last = np.flatnonzero((key != key[-1]) | (bi != bi[-1]) | (bj != bj[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield found(table.slice(0, cut).combine_chunks())
        held = table.slice(cut)
    if held is not None:
        yield found(held.combine_chunks())


def _sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """class_id and items, the whole set, of the classes in ``ids``, from one text each."""
    places = stored(ids.distinct().join(classes.select("class_id", "at"), "class_id").select("at").distinct(), "places")
    wanted = F.broadcast(places) if places.count() <= BROADCAST_ROWS else places
    texts = docs.join(wanted, F.col("row_key") == F.col("at"), "left_semi").select("text")
    return stored(map_arrow(texts, _sets, "class_id long, items binary").dropDuplicates(["class_id"]), "sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class_id")).union(pairs.select("b"))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b) of class ids those that are links."""
    a, b = (sets.select(F.col("class_id").alias(name), F.col("items").alias(f"items_{name}")) for name in ("a", "b"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "items_a", "items_b")
    return stored(map_arrow(joined, _confirmed, "a long, b long"), "confirmed")


def _star_pairs(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The smallest class under a key with each other one, if sizes allow it and signatures are within the radius."""
    stars = members.where("center <> class_id").select(F.col("center").alias("a"), F.col("class_id").alias("b")).distinct()
    a, b = (classes.select(F.col("class_id").alias(name), F.col("signature").alias(f"signature_{name}"),
                           F.col("n_shingles").alias(f"n_{name}")) for name in ("a", "b"))
    sized = stars.join(a, "a").join(b, "b").where(100 * F.least("n_a", "n_b") >= SIMILARITY * F.greatest("n_a", "n_b"))
    return map_arrow(sized.select("a", "b", "signature_a", "signature_b"), _close, "a long, b long")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``members``, with labels, under keys of several groups."""
    grouped = members.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "key", "center", "smallest", "class_id", F.coalesce("label", "class_id").alias("label"))
    return _of_several_groups(grouped)


def _of_several_groups(grouped: DataFrame) -> DataFrame:
    keys = stored(grouped.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
                  .where("low <> high").select("key", "n"), "mixed_keys")
    return stored(grouped.join(keys, "key"), "mixed")


def _joinable(mixed: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``mixed`` without the classes that can have no link to any other class in it.

    A link of sets of s and t elements shares at least 3 (s + t) / 7 of them; s - u bounds what a set shares that has u
    elements which no other set has; t is at least the least size under the class's keys, and 3 s / 4.
    """
    own = map_arrow(sets, _elements, "item long, class_id long").groupBy("item").agg(
        F.count("*").alias("n"), F.min("class_id").alias("class_id")).where("n = 1").groupBy("class_id").agg(
        F.count("*").alias("own"))
    least = mixed.groupBy("class_id").agg(F.min("smallest").alias("smallest"))
    bound = F.greatest(F.ceil(F.col("n_shingles") * SIMILARITY / 100), F.col("smallest"))
    alone = least.join(classes.select("class_id", "n_shingles"), "class_id").join(own, "class_id").where(
        (100 + SIMILARITY) * (F.col("n_shingles") - F.col("own")) < SIMILARITY * (F.col("n_shingles") + bound))
    return _of_several_groups(mixed.drop("n").join(stored(alone.select("class_id"), "alone"), "class_id", "left_anti"))


def _cross_pairs(mixed: DataFrame, classes: DataFrame, least: DataFrame) -> DataFrame:
    """Pairs within the radius that meet under a key and are in different groups."""
    parts = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    facts = least.join(classes.select("class_id", "signature", "n_shingles"), "class_id")
    rows = (mixed.join(facts, "class_id").withColumn("block", F.pmod("class_id", parts).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .select("key", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block",
                    "class_id", "label", "center", "n_shingles", "signature", "least"))
    blocks = rows.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    return map_arrow(blocks, _group_pairs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles, class_id, component_id, kept.

    ``docs`` has ``doc_id`` and ``text``; other columns are not used. Texts that are NULL, empty or without a word have
    no shingle and are linked with nothing: they are their own component and kept. Rows of equal sets share a
    class; rows that repeat a doc_id with one text are both reported. A row without doc_id takes part; its component is
    named by the smallest doc_id in it, NULL if there is none, and it is kept only in the latter case. No rows give no
    rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.withColumn("row_key", F.xxhash64("doc_id", "text_hash"))
    sketch = stored(map_arrow(
        texts.select("doc_id", "text_hash", "text"), _sketch, "doc_id long, text_hash long, n_shingles long, class_id long, signature binary"), "sketch")
    classes = stored(sketch.where("n_shingles > 0").groupBy("class_id", "n_shingles", "signature").agg(
        F.min("doc_id").alias("first_id"), F.min(F.xxhash64("doc_id", "text_hash")).alias("at")), "classes")
    keys = map_arrow(classes.select("class_id", "n_shingles", "signature"), _keys,
                     "key long, class_id long, n_shingles long")
    shared = stored(keys.groupBy("key").agg(F.min("class_id").alias("center"), F.count("*").alias("n"),
                                            F.min("n_shingles").alias("smallest")).where("n > 1"), "shared_keys")
    members = stored(keys.drop("n_shingles").join(shared, "key"), "members")

    stars = stored(_star_pairs(members, classes), "candidates")
    labels = stored(components(_similar(stars, _sets_of(_ends(stars), classes, texts))), "labels")
    mixed = _mixed(members.where("n > 2"), labels)
    sets = _sets_of(mixed.select("class_id"), classes, texts)
    mixed = _joinable(mixed, classes, sets)
    least = stored(map_arrow(sets.join(mixed.select("class_id").distinct(), "class_id", "left_semi"), _least,
                             "class_id long, least binary"), "least")
    more = _similar(stored(_cross_pairs(mixed, classes, least), "candidates"), sets)
    if not more.isEmpty():
        known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        labels = stored(components(known.unionByName(more)), "labels")

    named = classes.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "class_id", "first_id", F.coalesce("label", "class_id").alias("label"))
    named = stored(named, "named")
    firsts = stored(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "firsts")
    of_class = stored(named.join(firsts, "label").select("class_id", "component_id"), "components")
    result = sketch.join(of_class, "class_id", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return result.select("doc_id", "text_hash", "n_shingles", "class_id", "component_id",
                         F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each group: that of the smallest doc_id.

    Texts without words stay. Of rows that repeat a kept doc_id within a group, one stays.
    """
    found = near_duplicates(docs).where("kept")
    bare = F.when(F.col("n_shingles") == 0, F.col("text_hash"))
    kept = stored(found.groupBy("doc_id", "component_id", bare.alias("bare")).agg(F.min("text_hash").alias("text_hash"))
                  .select(F.xxhash64("doc_id", "text_hash").alias("row_key")).distinct(), "kept")
    keyed = docs.withColumn(ROW_KEY, F.xxhash64("doc_id", F.xxhash64("text")))
    return (keyed.join(kept.withColumnRenamed("row_key", ROW_KEY), ROW_KEY, "left_semi")
            .dropDuplicates([ROW_KEY]).select(*[keyed[f"`{name}`"] for name in docs.columns]))
