"""Raw documents to training shards, stage by stage; each stage's rows are written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import decontaminate, langid, mixing, neardup, shards
from footfall.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the others go, with NULL and empty texts. Learned as in the query: not from
    every fifth id. Repeated rows stay or go together; all columns pass unchanged, under private names meanwhile."""
    model = langid.learn(docs.where(~langid.held_out("doc_id", 5)).select("text", "lang"))
    private = ["text" if name == "text" else f"column_{k}" for k, name in enumerate(docs.columns)]
    return langid.accepted(langid.identify(docs.toDF(*private), model)).select(*private).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; repeats are repeated rows."""
    return mixing.mix(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order, read back from their shards: slot, shard, n_tokens, doc_ids, crc32."""
    return shards.materialise(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_shards", token_shards),
]

# Minhash groups, tokens and permuted slots are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
