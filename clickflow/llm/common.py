"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.config import work_dir

#: White space of the text contracts: blank and the five ASCII control blanks.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def saved(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet in the shared work folder and read it back.

    This cuts the lineage: a lost executor re-reads the table, and branches that
    follow scan only the columns they use.
    """
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as a long and ``text`` with null read as empty; other columns only if named."""
    return docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        *[docs[c] for c in more],
    )


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def chunks_for(rows: int, per_chunk: int) -> int:
    return max(1, -(-rows // per_chunk))


def gapless_rank(df: DataFrame, key: str, order: list[Column], spread: list[Column], chunks: int, out: str) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, as column ``out``.

    A window over a whole key would put a hot key into one task.  Rows are dealt to
    ``chunks`` by a hash of ``spread``; rows are numbered inside (key, chunk), and the
    sizes of the chunks before are added.  One shuffle of ``df``: the table of chunk sizes
    meets the window's own partitioning, in a merge join, as it grows with the table.
    """
    dealt = df.withColumn("__chunk", F.pmod(F.xxhash64(*spread), F.lit(chunks)).cast("int"))
    before = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        dealt.groupBy(key, "__chunk")
        .agg(F.count("*").alias("__n"))
        .select(
            F.col(key).alias("__key"),
            F.col("__chunk").alias("__c"),
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
        )
    )
    inside = Window.partitionBy(key, "__chunk").orderBy(*order)
    numbered = dealt.withColumn("__row", F.row_number().over(inside))
    joined = numbered.join(base.hint("merge"), (F.col(key) == F.col("__key")) & (F.col("__chunk") == F.col("__c")))
    return joined.withColumn(out, (F.col("__base") + F.col("__row") - 1).cast("bigint")).drop(
        "__chunk", "__key", "__c", "__base", "__row"
    )
