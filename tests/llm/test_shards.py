import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import shards as S


@pytest.fixture(scope="module")
def tokenizer():
    with open(S.VOCABULARY, "rb") as file:
        return S.Tokenizer(file.read())


@pytest.mark.parametrize("alphabet, chunk", [("wide", 300), ("plain", 1000), ("plain", 1 << 23)])
def test_tokens_equal_the_librarys(monkeypatch, tokenizer, alphabet, chunk):
    monkeypatch.setattr(S, "_CHUNK", chunk)
    monkeypatch.setattr(S, "_KEPT_PIECES", 500)
    letters = ["a", "b", " ", "  ", "\n", "é", "'s", "1", ".", "\t", " x", "&&&", "'"]
    letters += [" ", " "] if alphabet == "wide" else []
    rng = random.Random(3)
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 40]))) for _ in range(1000)] + [None, ""]
    encoding = tokenizer._load()[0]
    wanted = [encoding.encode_ordinary(t or "") for t in texts]
    got, counts = [], []
    for _, tokens, count in tokenizer.batches(pa.array(texts, pa.string()), False):
        ends = np.cumsum(count)
        got += [tokens[e - c:e].tolist() for e, c in zip(ends, count, strict=True)]
    for _, _, count in tokenizer.batches(pa.array(texts, pa.string()), True):
        counts += count.tolist()
    assert got == wanted and counts == [len(w) for w in wanted]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 70_001])
def test_permutation_is_one_to_one(n):
    slots = S.permuted(np.arange(n), n, S.KEY)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 100:
        assert not np.array_equal(slots, S.permuted(np.arange(n), n, S.KEY + 1))
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


def read_all(spark, path, start=0, **sizes):
    return sorted(S.read_shards(spark, path, start, **sizes).collect())


def test_round_trip(spark, documents, tokenizer, tmp_path):
    sizes = {"length": 128, "shard": 7}
    path, contents = S.write_shards(documents, str(tmp_path / "shards"), **sizes)
    records, meta = read_all(spark, path, **sizes), sorted(contents.collect())
    n = len(meta)
    assert [r.slot for r in records] == [m.slot for m in meta] == list(range(n))
    assert all(r.shard == r.slot // 7 and len(r.record) == 256 for r in records)
    assert read_all(spark, path, 23, **sizes) == records[23:]

    # Undo the permutation: the streams of the partitions, in order, hold each text and an end.
    order = S.permuted(np.arange(n), n, S.KEY)
    streams, encoding = {}, tokenizer._load()[0]
    used = {m.slot: m for m in meta}
    ids, tokens = [], []
    for slot in order.tolist():
        row = np.frombuffer(records[slot].record, "<u2")
        assert row[-1] == S.END and (row[used[slot].n_tokens:] == S.END).all()
        tokens += row[:used[slot].n_tokens].tolist()
        ids += [i for i in used[slot].doc_ids if not ids or ids[-1] != i]
    texts, own = [], []
    for t in tokens:
        if t == S.END:
            texts.append(encoding.decode(own))
            own = []
        else:
            own.append(t)
    assert not streams and not own
    by_id = {r.doc_id: r.text for r in documents.collect()}
    assert texts == [by_id[i] for i in ids] and sorted(ids) == sorted(by_id)


def test_result_rows(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    rows = sorted(S.materialise(documents, path).collect())
    records = {r.slot: r.record for r in read_all(spark, path)}
    assert [r.crc32 for r in rows] == [zlib.crc32(records[r.slot]) for r in rows]
    assert rows == sorted(S.materialise(documents, str(tmp_path / "again")).collect())
    assert {i for r in rows for i in r.doc_ids} == {r.doc_id for r in documents.collect()}


def test_changed_input_stops_the_job(spark, documents, tmp_path, monkeypatch):
    count = S._count
    monkeypatch.setattr(S, "_count", lambda it, *more: count((b.slice(1) for b in it), *more))
    with pytest.raises(Exception, match="differ from those that were counted"):
        S.write_shards(documents, str(tmp_path / "shards"), length=64)


def test_odd_rows(spark, odd_docs, no_docs, tmp_path):
    rows = S.materialise(odd_docs, str(tmp_path / "odd")).collect()
    assert {i for r in rows for i in r.doc_ids} == {3, 4, 5, 6, None, 7, 8, 9, 10}
    assert S.materialise(no_docs, str(tmp_path / "none")).collect() == []
    assert S.materialise(odd_docs.where("doc_id < 3"), str(tmp_path / "blank")).collect() == []
    assert re.search("slot.*shard.*n_tokens.*doc_ids.*crc32", str(S.materialise(no_docs, str(tmp_path / "n2")).columns))
