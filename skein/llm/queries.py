"""One query for each operator of this subpackage, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, html_text, line_dedup, mixing, near_dup, pii, quality, sharding, url_lists, vector_join
from .common import Workspace, table

#: The key of the query's pseudonyms. A user passes a secret of their own.
PSEUDONYM_KEY = "example key"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(Workspace(spark, "op1"), table(spark, sf_dir, "pages"))


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise_table(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.vector_links(Workspace(spark, "op3"), table(spark, sf_dir, "embeddings"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = url_lists.with_fetch_time(table(spark, sf_dir, "pages"))
    return url_lists.filter_urls(Workspace(spark, "op4"), captures, url_lists.entries_table(spark))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(Workspace(spark, "op5"), table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "n_copies")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assignments(Workspace(spark, "op7"), table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(Workspace(spark, "op8"), table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(Workspace(spark, "op9"), table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(Workspace(spark, "op10"), table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_pii_pseudonyms,
        op3_embedding_near_dedup,
        op4_url_filters,
        op5_source_mixing,
        op6_quality_classifier,
        op7_sharding,
        op8_line_dedup,
        op9_minhash_near_dedup,
        op10_decontamination,
    )
}

ORACLES: dict[str, str] = {
    "op4_url_filters": url_lists.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
}
