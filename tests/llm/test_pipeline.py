"""The stages one after the other against brute force on the smallest tables."""

from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from footfall.llm import langid, shards
from footfall.llm.mixing import MOST
from tests.llm.conftest import shingle_set
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_neardup import groups


def test_stages_and_run(spark, sf, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_dedup", "decontamination", "source_mix", "token_shards"]
    docs, kept = documents, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), documents.schema)
        kept.append(docs)
    language, dedup, clean, mixed = kept
    assert all(frame.columns == documents.columns for frame in kept)

    rows = {r.doc_id: r for r in documents.collect()}
    model = langid.learn(documents.where(~langid.held_out("doc_id", 5)))
    wanted = {r.doc_id for r in langid.identify(documents, model).collect() if r.lang_pred != "und" and r.bits_per_byte < 8}
    assert {r.doc_id for r in language.collect()} == wanted

    label = groups({i: shingle_set(rows[i].text) for i in wanted})
    wanted = {i for i in wanted if label[i] == i}
    assert Counter(r.doc_id for r in dedup.collect()) == Counter(wanted)

    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    wanted -= {doc for doc, *_ in brute_contamination(dedup, items)}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(wanted)

    taken = {r[0]: r[4] // max(r[1], 1) for r in brute_mix([(r.doc_id, r.text, r.source) for r in clean.collect()])}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in taken.items() if n})
    assert max(taken.values()) <= MOST

    result = corpus_pipeline.run(spark, sf).collect()
    with open(shards.VOCABULARY, "rb") as file:
        encoding = shards.Tokenizer(file.read())._load()[0]
    tokens = sum(n * (len(encoding.encode_ordinary(rows[i].text)) + 1) for i, n in taken.items())
    assert sum(r.n_tokens for r in result) == tokens
    assert {i for r in result for i in r.doc_ids} == {i for i, n in taken.items() if n}
    assert sorted(r.slot for r in result) == list(range(len(result)))


def test_empty_and_odd_documents(spark, sf, odd_docs, no_docs):
    for docs in (no_docs, odd_docs):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, docs, sf)
            count = rows.count()
        assert (count == 0) == (docs is no_docs)


def test_clashing_columns_pass_unchanged(spark, sf, documents):
    """Names that the stages use themselves, in either case: the values that come in go out."""
    small = documents.where("doc_id < 60")
    for number, names in enumerate((["score", "lang_pred", "bits_per_byte", "row", "u", "s", "copy", "size"],
                                    ["Score", "Lang_Pred", "BITS_PER_BYTE", "column_0", "Block", "text_hash", "Copies", "key"])):
        docs = small.withColumns({n: F.concat(F.lit(f"{n} of "), "doc_id") for n in names})
        for _, stage in corpus_pipeline.STAGES[:-1][:1 if number else 4]:
            docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
            assert docs.columns == documents.columns + names
            rows = docs.collect()
            assert rows and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names)


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
