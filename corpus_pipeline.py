"""The corpus pipeline: five stages, each over all documents that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skein.llm import decontaminate, mixing, near_dup, quality, sharding
from skein.llm.common import Workspace, table

#: The mixture's token budget as a part of the tokens that reach it. Documents are taken once at most, so that the
#: mixture doesn't bring back copies.
MIX_FRACTION, MIX_EPOCHS = 0.8, 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(Workspace(spark, "quality"), docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(Workspace(spark, "near_dup"), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(Workspace(spark, "decontaminate"), docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(Workspace(spark, "mixing"), docs, MIX_FRACTION, MIX_EPOCHS, annotate=False)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(Workspace(spark, "sharding"), docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: A fitted classifier and a likelihood aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are written and read again."""
    ws, docs = Workspace(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = ws.put(f"stage{k}", stage(spark, docs, sf_dir))
        if k:
            ws.drop(f"stage{k - 1}")
    return docs
