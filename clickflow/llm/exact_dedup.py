"""Exact dedup by a minimal perfect hash over the distinct digests of a history.

A text's digest is the SHA-256 of its UTF-8 bytes after deleting all white space of
``[\\x20\\x09-\\x0D]``.  The index is one row per part of the digest space.  A part holds a
minimal perfect hash (levels of bit fields; a key's number is the rank of its bit) and
one slot per digest with the full 32 bytes, the winner's doc_id and the group's size.
A document is answered by its slot: if the slot's bytes are its digest it is a member,
else the history never held the text, and it is grouped with the other nonmembers,
over which an index of their own is built.

Defined results: a null text counts as empty; empty texts are one group; a null doc_id
loses ties; rows repeated with the same doc_id and text are one group of which one row
is kept; an empty table gives no rows; further columns of the input are not read, so
their names cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import SPACE_CLASS, id_text, saved
from clickflow.llm.textbytes import U64, mix

DIGESTS_PER_PART = 2048
MOST_PARTS = 65536
ROWS_PER_LOOKUP = 4096
#: Rows that a copy of a part must answer for each digest it holds.
ROWS_PER_DIGEST = 4
#: Bits a level offers for each key that is still without a place.
GAMMA = 2.0
#: Stands for a null doc_id, beside a flag that tells it from an id of this value.
NO_ID = -(1 << 63)

INDEX_SCHEMA = (
    "part int, n_rows long, levels array<binary>, digests binary, winners binary, named binary, lengths binary, sizes binary"
)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id (never null), named (false for a null id), n_cp (code points of the original text) and the digest of the
    normalised text."""
    d = id_text(docs)
    return d.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("named"),
        F.length("text").alias("n_cp"),
        F.unhex(F.sha2(F.regexp_replace("text", f"{SPACE_CLASS}+", "").cast("binary"), 256)).alias("digest"),
    )


def fold(d: DataFrame) -> DataFrame:
    """One row per digest with its winner: most code points, then smallest doc_id.

    The aggregate combines inside each task first, so a group of copies of any size
    reaches its task as one row per task."""
    # the complement turns the order of ids round, for every 64-bit id
    best = F.max(F.struct(F.col("n_cp"), F.col("named"), F.bitwise_not("doc_id").alias("turned")))
    return (
        d.groupBy("digest")
        .agg(best.alias("best"), F.count("*").alias("size"))
        .select("digest", F.bitwise_not("best.turned").alias("winner"), "best.named", F.col("best.n_cp").alias("n_cp"), "size")
    )


def _words(raw: np.ndarray) -> np.ndarray:
    return raw.reshape(-1, 32).view("<u8").reshape(-1, 4)


def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = U64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix(keys[:, level % 4] + seed) % U64(bits)).astype(np.int64)


def build_levels(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit fields of a minimal perfect hash over distinct keys, and each key's number."""
    levels, number, left, before = [], np.empty(len(keys), np.int64), np.arange(len(keys)), 0
    while len(left):
        bits = max(64, 64 * math.ceil(GAMMA * len(left) / 64))
        place = _place(keys[left], len(levels), bits)
        alone = np.bincount(place, minlength=bits) == 1
        got = alone[place]
        number[left[got]] = before + np.cumsum(alone)[place[got]] - 1
        before += int(alone.sum())
        levels.append(alone)
        left = left[~got]
    return levels, number


def slot_numbers(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot of each key: right for members, any slot or -1 for others."""
    number, left, before = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for k, alone in enumerate(levels):
        place = _place(keys[left], k, len(alone))
        got = alone[place]
        number[left[got]] = before + np.cumsum(alone)[place[got]] - 1
        before += int(alone.sum())
        left = left[~got]
    return number


def _build_part(group: pd.DataFrame) -> pd.DataFrame:
    keys = _words(np.frombuffer(b"".join(group["digest"]), np.uint8))
    levels, number = build_levels(keys)
    order = np.argsort(number)
    return pd.DataFrame(
        {
            "part": [int(group["part"].iloc[0])],
            "n_rows": [int(group["size"].sum())],
            "levels": [[np.packbits(x).tobytes() for x in levels]],
            "digests": [keys[order].tobytes()],
            "winners": [group["winner"].to_numpy(np.int64)[order].tobytes()],
            "named": [group["named"].to_numpy(np.uint8)[order].tobytes()],
            "lengths": [group["n_cp"].to_numpy(np.int64)[order].tobytes()],
            "sizes": [group["size"].to_numpy(np.int64)[order].tobytes()],
        }
    )


def build_index(folded: DataFrame) -> DataFrame:
    """The index table over distinct digests, from the columns of :func:`fold`."""
    n = folded.count()
    parts = min(MOST_PARTS, max(1, -(-n // DIGESTS_PER_PART)))
    dealt = folded.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int"))
    index = saved(dealt.groupBy("part").applyInPandas(_build_part, INDEX_SCHEMA), "digest-index")
    return index.withColumn("parts", F.lit(parts))


def _look_up(docs: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    n = len(docs)
    winner, size, member = np.full(n, NO_ID, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    named, wins = np.zeros(n, bool), np.zeros(n, bool)
    if n and len(index):
        row = index.iloc[0]
        levels = [np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in row["levels"]]
        held = _words(np.frombuffer(row["digests"], np.uint8))
        keys = _words(np.frombuffer(b"".join(docs["digest"]), np.uint8))
        slot = slot_numbers(levels, keys)
        member = (slot >= 0) & (held[slot] == keys).all(axis=1)  # the byte check
        winner[member] = np.frombuffer(row["winners"], np.int64)[slot[member]]
        named[member] = np.frombuffer(row["named"], np.uint8)[slot[member]]
        size[member] = np.frombuffer(row["sizes"], np.int64)[slot[member]]
        length = np.frombuffer(row["lengths"], np.int64)[slot[member]]
        same = (winner == docs["doc_id"].to_numpy(np.int64)) & (named == docs["named"].to_numpy(bool))
        wins[member] = same[member] & (length == docs["n_cp"].to_numpy()[member])
    wins &= ~docs.duplicated(["doc_id", "named", "digest", "n_cp"]).to_numpy()  # of repeated rows one
    return docs[["doc_id", "named", "n_cp", "digest"]].assign(
        member=member, keep_id=winner, keep_named=named, group_size=size, wins=wins
    )


LOOKUP_SCHEMA = (
    "doc_id long, named boolean, n_cp int, digest binary, member boolean, keep_id long, keep_named boolean,"
    " group_size long, wins boolean"
)


def fan_out() -> Column:
    """To how many salts a part of the index is copied."""
    n_digests = F.octet_length("digests") / 32
    rows = F.greatest(F.lit(ROWS_PER_LOOKUP), ROWS_PER_DIGEST * n_digests)
    return F.greatest(F.lit(1), F.ceil(F.col("n_rows") / rows)).cast("int")


def look_up(d: DataFrame, index: DataFrame) -> DataFrame:
    """Answer every row of ``d`` by its slot of the index.

    A part with a hot digest, with far more rows than digests, goes to more than one task: it is copied to salts and its
    documents are dealt over them.  A salt has ROWS_PER_LOOKUP rows and ROWS_PER_DIGEST times the part's digests at
    least, so copies of the index stay in proportion to the rows.  The table
    of fan-outs is broadcast; it has MOST_PARTS rows of two numbers at most.
    """
    fan = fan_out()
    fans = index.select(F.col("part").alias("p"), fan.alias("fan"), "parts")
    parts = F.lit((index.select(F.max("parts")).first() or [1])[0] or 1)
    dealt = (
        d.withColumn("part", F.pmod(F.xxhash64("digest"), parts).cast("int"))
        .join(F.broadcast(fans.select("p", "fan")), F.col("part") == F.col("p"), "left")
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_cp"), F.coalesce("fan", F.lit(1))).cast("int"))
        .select("doc_id", "named", "n_cp", "digest", "part", "salt")
    )
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), fan - 1))).drop("parts")
    grouped = dealt.groupBy("part", "salt").cogroup(copies.groupBy("part", "salt"))
    return grouped.applyInPandas(_look_up, LOOKUP_SCHEMA)


def exact_dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, in_history.

    ``history`` is an index of :func:`build_index`.  Its members are repeats: they are
    dropped and point to the historical winner, group_size being the history's count.
    Without a history the documents themselves are the history: the index is built over
    their distinct digests and every document is looked up in it.
    """
    d = saved(digests(docs), "digests")
    if history is None:
        return _result(look_up(d, build_index(saved(fold(d), "digest-winners"))), False)
    seen = saved(look_up(d, history), "digest-lookups")
    fresh = seen.filter(~F.col("member")).select("doc_id", "named", "n_cp", "digest")
    own = look_up(fresh, build_index(saved(fold(fresh), "digest-winners")))
    return _result(seen.filter("member"), True).unionByName(_result(own, False))


def _result(found: DataFrame, in_history: bool) -> DataFrame:
    wins = F.lit(False) if in_history else F.col("wins")
    return found.select(
        F.when(F.col("named"), F.col("doc_id")).alias("doc_id"),
        F.when(F.col("keep_named"), F.col("keep_id")).alias("keep_id"),
        "group_size",
        wins.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.lit(in_history).alias("in_history"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, whole and with their own columns only."""
    no_id = F.lit(NO_ID)
    keep = exact_dedup(docs).filter("kept")
    keep = keep.select(F.coalesce("doc_id", no_id).alias("id"), F.unhex("text_sha256").alias("sha"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs["doc_id"].cast("bigint"), no_id).alias("id"),
        F.unhex(F.sha2(F.regexp_replace(text, f"{SPACE_CLASS}+", "").cast("binary"), 256)).alias("sha"),
        F.length(text).alias("n"),
    )
    first = Window.partitionBy("id", "sha").orderBy(F.col("n").desc())
    return (
        rows.join(keep, ["id", "sha"])
        .withColumn("nth", F.row_number().over(first))
        .filter("nth = 1")
        .select("row.*")
    )
