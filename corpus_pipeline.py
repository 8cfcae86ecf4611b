"""A training corpus from raw documents: quality rules, near-dedup, benchmark decontamination, PII surrogates, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from binoscope.llm import decontaminate, minhash, packing, pii, quality
from binoscope.llm.shared import findable, written

NEAR_PERCENT = 80               # Jaccard similarity of near-duplicates; op1 has 85


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and stay near a language; the others go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest id."""
    return minhash.keep_first(docs, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; all documents stay."""
    return decontaminate.remove_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get surrogates; all documents stay."""
    return pii.replace_entities(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in the training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination),
    ("pii_surrogates", pii_surrogates), ("best_fit_packing", best_fit_packing)]

# MinHash components, keyed surrogates and token ids are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written and read again."""
    findable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
