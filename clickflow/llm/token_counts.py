"""Token counts: an exact histogram of encoded lengths, and what follows from it.

Every document is encoded whole, in Arrow batches.  The documents are aggregated by
their length in tokens (partial counts inside each task first), and running sums over
the histogram answer, for every context limit, how many documents and tokens reach
it and how many tokens are left when longer documents are cut there.

The histogram has at most as many rows as there are different lengths, so its running
sums take two steps: sums inside blocks of lengths, then over the block totals.

Defined results: a null or empty text has no tokens and counts as a document of length
0; repeated rows count each time; an empty table gives no rows; further columns are
not read.
"""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import id_text, saved
from clickflow.llm.tokens import VOCABULARY, token_ids

LENGTHS_PER_BLOCK = 1024


def document_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(token_ids(x.as_py(), vocabulary)) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return id_text(docs).mapInArrow(count, "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs: the exact histogram, written once."""
    return saved(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "length-histogram")


def length_report(hist: DataFrame) -> DataFrame:
    """For each length that occurs, taken as a context limit: the exact suffix sums.

    docs_from, tokens_from: documents of at least this length and their tokens;
    truncated_tokens: all tokens when every document is cut at this limit;
    docs_to: documents no longer than it, and quantile, their share of all.
    """
    block = F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK)
    h = hist.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), block.alias("block"))
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    totals = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # one row per LENGTHS_PER_BLOCK lengths: a window without a key over the totals stays small
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    after = totals.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
        F.sum("d").over(everything).alias("d_all"),
        F.sum("t").over(everything).alias("t_all"),
    )
    s = h.join(after, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("d_after")).alias("docs_from"),
        (F.sum("tokens").over(inside) + F.col("t_after")).alias("tokens_from"),
        "d_all",
        "t_all",
    )
    below = F.col("t_all") - F.col("tokens_from")
    to = F.col("d_all") - F.col("docs_from") + F.col("n_docs")
    return s.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (below + F.col("docs_from") * F.col("n_tokens")).alias("truncated_tokens"),
        to.alias("docs_to"),
        (to / F.col("d_all")).alias("quantile"),
        F.col("t_all").alias("total_tokens"),
    )


def totals_at(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Truncated totals for any limits, also those that no document has as its length."""
    limit = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("limit")
    per = hist.select(limit, "n_tokens", "n_docs")
    return per.groupBy("limit").agg(
        F.sum(F.least("limit", "n_tokens") * F.col("n_docs")).alias("truncated_tokens"),
        F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
    )


def length_at_quantile(hist: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least this share of the documents doesn't exceed."""
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    reached = length_report(hist).select(share, "n_tokens", "quantile").filter("quantile >= share")
    return reached.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    return length_report(histogram(document_lengths(docs, vocabulary)))
