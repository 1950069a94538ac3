"""Corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

``STAGES`` lists (name, function).  A function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.  All but the
last return the columns of ``documents``, whole rows of what their predecessor kept.

Defined results: a null text counts as empty, and the quality rules reject it, as they reject any text of
fewer than 50 words.  A null doc_id is a row like any other: of equal texts one with an id stays before one without,
and of a group of near duplicates the smallest id.  Of rows repeated as they are one stays; rows that share an id
but not a text are told apart by the text.  Ties go to the smallest id.  Labels without a document, or with nulls, aren't
used; without any label the mixing keeps all.  Columns beyond those of ``documents`` travel with their row, whatever
their names, up to the packing, which returns its own columns.  Long texts are taken whole by every stage.
An empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import best_fit_packing, domain_mixing, exact_dedup, ngram_join, quality_rules
from clickflow.llm.common import documents, saved


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.passing(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return exact_dedup.kept_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return ngram_join.one_per_component(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay at the rates that bring the domains to their target weights."""
    return domain_mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of a document and its place in a sequence."""
    _, placed = best_fit_packing.pack(docs)
    return placed.select(
        "doc_id", "piece", F.col("start_at").alias("start"), "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: The packing's token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
