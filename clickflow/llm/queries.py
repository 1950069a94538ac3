"""The registered queries of the corpus operators: one per operator over its whole table."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clickflow.llm import (
    balanced_shards,
    best_fit_packing,
    domain_mixing,
    exact_dedup,
    line_dedup,
    ngram_join,
    quality_rules,
    secret_scan,
    simhash_dedup,
    source_divergence,
    substring_dedup,
    token_counts,
    vector_codes,
)
from clickflow.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).drop("in_history")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, placed = best_fit_packing.pack(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "piece", F.col("start_at").alias("start"), "length", "ids_crc32", "sequence_id", "offset"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(documents(spark, sf_dir))
    sha = F.sha2(F.col("base_spans").cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", sha.alias("base_sha256"), "spans", "n_unread")


def op6_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards.balanced_shards(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(documents(spark, sf_dir), with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(documents(spark, sf_dir))


def op10_domain_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = domain_mixing.mix_domains(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixed.drop("version")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(documents(spark, sf_dir))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_best_fit_packing,
        op3_token_counts,
        op4_line_dedup,
        op5_secret_scan,
        op6_balanced_shards,
        op7_substring_dedup,
        op8_ngram_join,
        op9_quality_rules,
        op10_domain_mixing,
        op11_vector_codes,
        op12_source_divergence,
        op13_simhash_dedup,
        pipeline,
    )
}
