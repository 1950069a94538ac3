"""Best-fit decreasing packing of documents into sequences of a fixed number of tokens.

Best-fit decreasing takes the pieces from long to short and puts each into the fullest open
sequence that still has room.  Where it puts a piece depends on nothing but lengths, so
the plan is made for the histogram of lengths, which has at most ``capacity`` rows however
many documents there are: open sequences with the same room are kept as ranges of
sequence numbers, a segment tree over the remaining room finds the tightest room that
fits in logarithmic time, and all pieces that best-fit would put there one after
another are placed in one step.  The outcome is best-fit decreasing over all pieces.

A plan is a list of rules: pieces ``rank_from`` to ``rank_to`` of a length go to the
sequences from ``first`` on, ``per`` to a sequence, from place ``at``.  A range is at most
halved in room by each rule, so there are no more than about capacity * log2(capacity)
of them: they are sent to the tasks as they are.  The rank of a piece among all pieces of its
length comes from :func:`gapless_rank`, which splits a hot length over chunks.

Defined results: a null or empty text is the one token 0; a text longer than the
capacity is cut into pieces of which only the first may be shorter; repeated rows are packed
each time; a null doc_id is packed like any other; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import chunks_for, gapless_rank, id_text, saved
from clickflow.llm.tokens import VOCABULARY, token_ids

CAPACITY = 2048
END_ID = 0
ROWS_PER_CHUNK = 4096
PIECES_SCHEMA = "doc_id long, piece int, start_at long, length long, tokens binary"


class TightestRoom:
    """A segment tree over remaining rooms 0..capacity: which rooms have open sequences."""

    def __init__(self, capacity: int):
        self.base = 1 << (capacity + 1).bit_length()
        self.open = np.zeros(2 * self.base, bool)

    def set(self, room: int, is_open: bool) -> None:
        i = self.base + room
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def at_least(self, room: int) -> int | None:
        """The smallest open room that is no smaller than ``room``."""
        i = self.base + room
        if self.open[i]:
            return room
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.base
            i //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rules (length, rank_from, rank_to, first, per, at) in order of length and rank, and the number of sequences."""
    tree, ranges, rules, sequences = TightestRoom(capacity), defaultdict(list), [], 0

    def opened(first: int, end: int, room: int) -> None:
        if end > first and room:
            ranges[room].append((first, end))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            room = tree.at_least(length)
            if room is None:  # only new sequences are left for this length
                per = capacity // length
                need = -(-(n - rank) // per)
                first, end, room, last = sequences, sequences + need, capacity, True
                sequences = end
            else:
                first, end = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
                per, last = room // length, False
            full = min(end - first, (n - rank) // per)
            over = min(n - rank - full * per, per) if first + full < end else 0
            rules.append((length, rank, rank + full * per + over, first, per, capacity - room))
            opened(first, first + full, room - per * length)
            if over:
                opened(first + full, first + full + 1, room - over * length)
            if not last:
                opened(first + full + bool(over), end, room)
            rank += full * per + over
    found = np.array(rules, np.int64).reshape(-1, 6)
    return found[np.lexsort((found[:, 1], found[:, 0]))], sequences


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; the first takes what doesn't fill a whole one."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def tokenize_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start_at, length and the ids as little-endian unsigned 32-bit numbers."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "piece", "start_at", "length", "tokens"]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.append(token_ids(text.as_py(), vocabulary), np.uint32(END_ID)).astype("<u4")
                for piece, (start, length) in enumerate(cut_pieces(len(ids), capacity)):
                    values = (doc, piece, start, length, ids[start : start + length].tobytes())
                    for col, value in zip(cols, values):
                        col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return id_text(docs).mapInArrow(pieces, PIECES_SCHEMA)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row of ``pieces`` (with ``length``) its ``sequence_id`` and ``offset``.

    Keep ``pieces`` thin: its rows are dealt out once by length."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rules, _ = plan(counts, capacity)
    step = np.int64(1) << 50  # ranks stay below it
    keys = rules[:, 0] * step + rules[:, 1]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            rule = rules[np.searchsorted(keys, length * step + rank, side="right") - 1] if len(rules) else rules
            nth = rank - rule[:, 1]
            sequence = rule[:, 3] + nth // np.maximum(rule[:, 4], 1)
            offset = rule[:, 5] + nth % np.maximum(rule[:, 4], 1) * length
            kept = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "rank"]
            names = [x for x in batch.schema.names if x != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    order = [F.col(c) for c in pieces.columns if c != "length"]
    ranked = gapless_rank(pieces, "length", order, order, chunks_for(sum(counts.values()), ROWS_PER_CHUNK), "rank")
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(put, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The table of pieces with their tokens, and where each goes: doc_id, piece, start_at,
    length, ids_crc32, sequence_id, offset."""
    pieces = saved(tokenize_pieces(docs, capacity, vocabulary), "token-pieces")
    thin = saved(
        pieces.select("doc_id", "piece", "start_at", "length", F.crc32("tokens").alias("ids_crc32")), "piece-lengths"
    )
    return pieces, place(thin, capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and the ids of its pieces in order."""
    keys = ["doc_id", "piece", "start_at", "length", "ids_crc32"]
    p = pieces.withColumn("ids_crc32", F.crc32("tokens")).dropDuplicates(keys)
    both = placed.join(p, [placed[k].eqNullSafe(p[k]) for k in keys]).select("sequence_id", "offset", "tokens")
    parts = F.sort_array(F.collect_list(F.struct("offset", "tokens")))
    joined = F.aggregate(F.col("parts.tokens"), F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))
    return both.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("tokens"))
