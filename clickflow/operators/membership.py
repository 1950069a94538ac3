"""J-9 / X2 for a long list: a Bloom filter before the exact anti join.

A list too long to broadcast would send the whole log through a shuffle to find the few rows that
are on it.  Here the list is first aggregated to a bit array of fixed size, and the log
is split by it while it is scanned: rows whose key is surely not on the list stay where they are, and only those
that may be go to the anti join.  A Bloom filter errs to one side only, so the result is
exact whatever its size; a list that overfills it sends more rows to the join.

All steps are built-in functions: the bits are set with ``bit_or`` per 64-bit word, and the words, at most
``bits / 64`` of them, become one array that every task tests with ``getbit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23
HASHES = 4


def _positions(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(hashes)]


def bloom_words(keys: DataFrame, column: str, bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """One row: ``words``, the filter of the column's values as an array of ``bits / 64`` longs."""
    if bits % 64:
        raise ValueError("bits must be a multiple of 64")
    at = keys.select(F.explode(F.array(*_positions(F.col(column), bits, hashes))).alias("at"))
    mask = F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))"))
    filled = at.groupBy(F.shiftright("at", 6).alias("word")).agg(mask.alias("mask"))
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    dense = every.join(filled, "word", "left").select(F.struct("word", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask")).alias("w"))
    return dense.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["mask"]).alias("words"))


def might_contain(words: Column, key: Column, bits: int = BITS, hashes: int = HASHES) -> Column:
    """False only for keys that are not in the filter."""
    found = F.lit(True)
    for at in _positions(key, bits, hashes):
        word = F.element_at(words, (F.shiftright(at, 6) + 1).cast("int"))
        found = found & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return found


def split_by_filter(rows: DataFrame, listed: DataFrame, key: str, bits: int = BITS, hashes: int = HASHES) -> tuple[DataFrame, DataFrame]:
    """(rows that may be on the list, rows that surely are not)."""
    words = bloom_words(listed, key, bits, hashes).scalar()
    may = might_contain(words, F.col(key), bits, hashes)
    return rows.filter(may), rows.filter(~may)


def anti_join_long(rows: DataFrame, listed: DataFrame, key: str, bits: int = BITS, hashes: int = HASHES) -> DataFrame:
    """Rows whose ``key`` is not in ``listed``; a NULL key is on no list."""
    suspects, clear = split_by_filter(rows, listed, key, bits, hashes)
    return clear.unionByName(suspects.join(listed.select(key).distinct(), key, "left_anti").select(*rows.columns))
