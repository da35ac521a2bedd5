"""A corpus pipeline: five stages, each one operator, that take documents to packed training sequences.

Each stage gets what its predecessor kept and reads the other tables itself. All but the last return documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymeter.llm import boosted_rules, minhash_dedup, packing, rule_ensemble, spaced_seeds
from waymeter.llm.tables import table
from waymeter.session import prepare, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees."""
    prepare(spark)
    return boosted_rules.keep(docs, table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores as good."""
    prepare(spark)
    return rule_ensemble.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    prepare(spark)
    return minhash_dedup.dedup(docs, size=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    prepare(spark)
    return spaced_seeds.decontaminate(docs, table(spark, sf_dir, "benchmark"), spaced_seeds.SHORT_CHANGES)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: Fitted models and packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each result is a written table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def statements() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
