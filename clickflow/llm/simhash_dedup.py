"""Near duplicates by SimHash fingerprints, found through pigeonhole blocks.

A fingerprint has 64 bits: bit i is set if more than half of the text's 3-word shingles have
it set in their XXH64.  Texts whose fingerprints differ in at most two bits are linked.

* Distinct fingerprints are one node each, however many documents have one.
* Blocks: the 64 bits are four blocks of 16.  Two differing bits spoil at most two blocks, so
  linked fingerprints agree in two whole blocks at least: each is filed under its six pairs of
  blocks, 32 bits a key, and only fingerprints under one key are compared.
* A key with at most ``SMALL`` fingerprints is one list, verified by Hamming distance.  A
  larger one (fingerprints of one template, or chance at a great size) is split by the same
  principle once more: its 32 free bits are eight blocks of four, of which linked fingerprints agree in six.
  Under such a key only eight bits are free, so no list is ever longer than 256, whatever
  the data, and nothing is capped.
* Keys that hold a large share of all fingerprints are at most ``6 * HOT_SHARE`` by counting;
  that list is broadcast, so that they are split before any shuffle by key.
* A list returns a star per component of its own, never its pairs.  Stars are joined by
  :func:`clickflow.llm.components.components`.

Defined results: a null text, and one without words, has fingerprint zero and is linked like
any other; fewer than three words make one shingle; a null doc_id takes part and gets its
component's smallest id, which is null if there is none; repeated rows each give a row; an
empty table gives no rows; texts are read whole, long ones a slice at a time; further
columns aren't read.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import or_
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from clickflow.llm import textbytes as tb
from clickflow.llm.common import id_text, saved
from clickflow.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 64
DIFFER = 2
SMALL = 256
HOT_SHARE = 4096
BATCH_BYTES = 2 << 20
#: Shingles whose bits are counted at once, and fingerprints compared at once.
SLICE = 1 << 16
COMPARED = 1 << 14

_ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# -- fingerprints ----------------------------------------------------------------------
def _bit_counts(digests: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often each bit is set in each run of digests that begins at ``first``; runs aren't empty."""
    bits = np.unpackbits(digests.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, first, axis=0, dtype=np.int32)


def fingerprints(column: pa.Array) -> np.ndarray:
    """The fingerprint of every text of a column without nulls."""
    raw, at = tb.packed(column)
    starts, ends = tb.word_bounds(raw, at)
    first = np.searchsorted(starts, at)
    n_words = np.diff(first)
    counts = np.zeros((len(n_words), BITS), np.int64)
    n_grams = np.where(n_words > 0, np.maximum(n_words - SHINGLE + 1, 1), 0)
    # words with one blank between them: every shingle is a stretch of this
    low = raw.tobytes().translate(_ASCII_LOWER)
    line = b" ".join([low[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    sizes = ends - starts
    to = np.cumsum(sizes + 1) - 1
    begin = to - sizes
    owner = np.repeat(np.arange(len(n_words)), n_grams)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_grams) - n_grams, n_grams)
    head = first[owner] + nth
    tail = head + np.minimum(n_words[owner], SHINGLE) - 1
    for i in range(0, len(owner), SLICE):
        a, b = begin[head[i : i + SLICE]].tolist(), to[tail[i : i + SLICE]].tolist()
        digests = np.array([xxh64_intdigest(line[x:y], SEED) for x, y in zip(a, b)], np.uint64)
        docs, begins = np.unique(owner[i : i + SLICE], return_index=True)
        counts[docs] += _bit_counts(digests, begins)
    set_bits = (2 * counts > n_grams[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in tb.slices(whole, "text", BATCH_BYTES):
            found = pa.array(fingerprints(batch.column("text")).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "fp"])


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long) of every document."""
    return id_text(docs).mapInArrow(_fingerprint_rows, "doc_id long, fp long")


# -- blocks ----------------------------------------------------------------------------
def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(blocks: list[int], free: int) -> list[int]:
    """The masks that leave out ``free`` of the blocks (each a mask itself)."""
    every = reduce(or_, blocks)
    return [every & ~reduce(or_, out) for out in combinations(blocks, free)]


def _block_masks(width: int) -> list[int]:
    return [((1 << width) - 1) << at for at in range(0, BITS, width)]


#: Two of four blocks of 16 bits.
COARSE = _masks(_block_masks(16), DIFFER)


def finer(coarse: int) -> list[int]:
    """The masks that split a key of ``coarse``: its bits and six of the eight blocks of four in the rest."""
    return [coarse | m for m in _masks([b for b in _block_masks(4) if not b & coarse], DIFFER)]


def _keys(fp: Column, masks: list[int]) -> Column:
    return F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), fp.bitwiseAND(F.lit(_signed(m))).alias("value")) for m in masks])


def _compared(fp: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """For each fingerprint the smallest index it is joined to through links inside its bucket.

    ``bucket`` is sorted.  Fingerprints are laid beside those 1, 2, ... places on."""
    n = len(fp)
    label = np.arange(n)
    left, right = [], []
    for step in range(1, n):
        i = np.flatnonzero(bucket[step:] == bucket[:-step])
        if not len(i):
            break
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= DIFFER]
        left.append(i)
        right.append(i + step)
    if not left:
        return label
    i, j = np.concatenate(left), np.concatenate(right)
    while True:
        least = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of fingerprints -> links (u, v), one fewer than members for each component of a list."""
    for batch in batches:
        lists = batch.column("fps")
        sizes = lists.value_lengths().to_numpy()
        values = lists.flatten().to_numpy().view(np.uint64)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        start = 0
        while start < len(sizes):  # whole lists, about COMPARED fingerprints at once
            end = max(start + 1, int(np.searchsorted(cuts, cuts[start] + COMPARED, side="right")) - 1)
            fp = values[cuts[start] : cuts[end]]
            label = _compared(fp, np.repeat(np.arange(start, end), sizes[start:end]))
            joined = np.flatnonzero(label != np.arange(len(label)))
            ends = fp[joined].view(np.int64), fp[label[joined]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["u", "v"])
            start = end


def _listed(filed: DataFrame) -> DataFrame:
    """Fingerprints filed under (mask, value) -> the verified links of each key; no key has many."""
    lists = filed.groupBy("mask", "value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return lists.select("fps").mapInArrow(_stars, "u long, v long")


def _split(filed: DataFrame) -> DataFrame:
    """Rows of coarse keys, filed under the finer keys."""
    fp = F.col("fp")
    finest = reduce(
        lambda rest, m: F.when(F.col("mask") == F.lit(_signed(m)), _keys(fp, finer(m))).otherwise(rest),
        COARSE[1:],
        _keys(fp, finer(COARSE[0])),
    )
    return filed.select("fp", F.explode(finest).alias("k")).select("k.mask", "k.value", "fp")


def links(prints: DataFrame, small: int = SMALL, hot_share: int = HOT_SHARE) -> DataFrame:
    """Links (u, v) among distinct fingerprints ``fp``: what they join is what distances of two bits or fewer join."""
    key = ["mask", "value"]
    filed = prints.select("fp", F.explode(_keys(F.col("fp"), COARSE)).alias("k")).select("k.mask", "k.value", "fp")
    sizes = saved(filed.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "block-sizes")
    n = prints.count()
    # at most len(COARSE) * hot_share keys, since each fingerprint is filed under len(COARSE)
    hot = F.broadcast(sizes.filter(F.col("n") > F.lit(max(small, n // hot_share))).select(*key))
    cold = filed.join(hot, key, "left_anti").join(sizes, key)
    large = cold.filter(F.col("n") > small).select(*key, "fp").unionByName(filed.join(hot, key, "left_semi").select(*key, "fp"))
    found = _listed(cold.filter(F.col("n") <= small)).unionByName(_listed(_split(large)))
    return saved(found.distinct(), "fingerprint-links")


def simhash_dedup(docs: DataFrame, small: int = SMALL, hot_share: int = HOT_SHARE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = saved(fingerprinted(docs), "fingerprints")
    prints = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(prints, small, hot_share), "fingerprint-components")
    member = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    member = saved(member, "fingerprint-members")
    names = member.groupBy("root").agg(F.min("first").alias("component_id"))
    # written, so that the join has two plain shuffles, whose hot partitions Spark splits
    named = saved(member.join(names, "root").select("fp", "component_id"), "fingerprint-names")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")
