"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    decontaminate, fingerprint, langid, mixing, neardup, negatives, phrases, pii, quality, shards, toxicity, warc, wordmodel)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = langid.held_out("doc_id", 5)
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("label"))
    voter = quality.learn_by_id(docs, labels.where(~out))
    return quality.scored(docs, voter).select("doc_id", out.alias("held_out"), "score", "predicted")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op6_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op8_training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.materialise(_table(spark, sf_dir, "documents"))


def op9_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = wordmodel.text_scores(_table(spark, sf_dir, "documents"), ~langid.held_out("doc_id", 7, 2))
    return scores.withColumn("held_out", langid.held_out("doc_id", 7, 2))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langid.held_out("doc_id", 5)
    model = langid.learn(docs.where(~out).select("text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op11_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = langid.held_out("doc_id", 4, 2)
    labels = _table(spark, sf_dir, "labels").where(~out).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.scored(docs, toxicity.learn(docs, labels)).select("doc_id", out.alias("held_out"), "score", "predicted")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_decontamination": op2_decontamination,
    "op3_quality_votes": op3_quality_votes,
    "op4_source_mix": op4_source_mix,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_multiset_fingerprints": op6_multiset_fingerprints,
    "op7_personal_data": op7_personal_data,
    "op8_training_shards": op8_training_shards,
    "op9_lattice_scores": op9_lattice_scores,
    "op10_language": op10_language,
    "op11_toxic_passages": op11_toxic_passages,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
