"""Substring dedup over bytes: remove what a 50-byte match in an earlier document covers.

A byte goes if it lies in a 50-byte string that also starts in a document with a smaller doc_id.

* Documents are packed into batches of a few MB, written once as a table bucketed by batch, so
  that answers can be joined to the text without moving the text.
* Every window of 50 bytes is known by the smallest hash of the 19-byte strings inside it (its
  anchor); equal windows have equal anchors.  Consecutive windows with one anchor are one
  stretch of 50 to 81 bytes.  Round 1: batches send their distinct anchors to buckets of the
  hash space and learn which of them another document has too.  An anchor in a third of all
  documents costs each batch one entry.
* Round 2: batches send their distinct stretches around such anchors, with the smallest
  document that has it.  An anchor with a single stretch is settled by equality, and a stretch
  without a window whose hash comes again can't match.  Over the others a bucket builds a
  run-length index (:mod:`run_index`) and streams the stretches through it: for each of
  their windows it gives the smallest document that has it.
* Answers return to the batches, one bit a window; the batch marks and cuts its documents.

Strings are judged on the input, so nothing depends on the order of the work.  Stretches of a
batch that agree in a 64-bit hash count as equal.

Defined results: a null text counts as empty; a text below 50 bytes loses nothing; a null doc_id
ranks last and loses what any document with an id has; rows that share a doc_id don't remove
from each other; an empty table gives no rows; further columns aren't read.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.config import work_dir
from clickflow.llm import textbytes as tb
from clickflow.llm.common import id_text, saved
from clickflow.llm.run_index import RunIndex
from clickflow.llm.textbytes import U64, mix

MATCH = 50
GRAM = 19
WINDOWS = MATCH - GRAM + 1  # windows that one anchor position can serve: 32, a bit each
BATCH_BYTES = 4 << 20
CHUNK = 1 << 16
BUCKETS_PER_PARTITION = 4
MOST_TABLE_BUCKETS = 65536  # Spark allows a table 100,000
LAST = (1 << 63) - 1  # a null doc_id

BATCH_SQL = "batch long, ids binary, lengths binary, body binary"
BATCH = pa.schema([("batch", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()), ("body", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of doc_id and text -> rows of about BATCH_BYTES each; a longer text has its own."""
    base, held, size, n = TaskContext.get().partitionId() << 32, [], 0, 0

    def row():
        ids = np.concatenate([x[0] for x in held])
        lengths = np.concatenate([x[1] for x in held])
        values = [base + n, ids.tobytes(), lengths.tobytes(), b"".join(x[2] for x in held)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BATCH)], schema=BATCH)

    for whole in batches:
        for part in tb.slices(whole, "text", BATCH_BYTES):
            buf, at = tb.packed(part.column("text"))
            held.append((part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(at), buf.tobytes()))
            size += len(buf) + 16 * part.num_rows
            if size >= BATCH_BYTES:
                yield row()
                held, size, n = [], 0, n + 1
    if held:
        yield row()


def _gram_minima(buf: np.ndarray) -> np.ndarray:
    """For each position the smallest hash of the grams that start in the window of 50 bytes there."""
    n = len(buf)
    out = np.empty(n, U64)
    padded = np.concatenate([buf, np.zeros(MATCH + 16, np.uint8)])
    for start in range(0, n, CHUNK):
        k = min(CHUNK, n - start) + WINDOWS - 1
        piece = padded[start : start + k + GRAM]
        eight = np.lib.stride_tricks.as_strided(piece, (len(piece) - 7, 8), (1, 1)).copy().view("<u8").ravel()
        h = eight[:k] * U64(0x9E3779B97F4A7C15)
        h ^= eight[8 : k + 8] * U64(0xC2B2AE3D27D4EB4F)
        h ^= h >> U64(29)
        h += eight[GRAM - 8 : k + GRAM - 8] * U64(0x165667B19E3779F9)
        h ^= h >> U64(32)
        h *= U64(0xBF58476D1CE4E5B9)
        h ^= h >> U64(29)
        step = 1
        while step < WINDOWS:
            h = np.minimum(h[: len(h) - step], h[step:])
            step *= 2
        out[start : start + k - WINDOWS + 1] = h[: k - WINDOWS + 1]
    return out


class Stretches:
    """The stretches of a batch: where each starts, its number of windows, its document, its anchor."""

    def __init__(self, body: bytes, lengths: np.ndarray):
        self.buf = np.frombuffer(body, np.uint8)
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        n = len(self.buf)
        closed = np.zeros(n + 1, np.int32)  # positions where no window of the document starts
        np.add.at(closed, np.maximum(self.at[1:] - MATCH + 1, self.at[:-1]), 1)
        np.add.at(closed, self.at[1:], -1)
        valid = np.cumsum(closed[:n]) == 0
        least = _gram_minima(self.buf)
        begins = valid.copy()
        begins[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
        start = np.flatnonzero(begins)
        stops = valid.copy()
        stops[:-1] &= (least[1:] != least[:-1]) | ~valid[1:]
        windows = np.flatnonzero(stops) + 1 - start
        long = np.flatnonzero(windows > WINDOWS)
        if len(long):  # a gram that comes again and again: cut to pieces of at most WINDOWS windows
            pieces = -(-windows // WINDOWS)
            first = np.repeat(start, pieces)
            nth = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            windows = np.minimum(np.repeat(windows, pieces) - nth * WINDOWS, WINDOWS)
            start = first + nth * WINDOWS
        self.start, self.windows, self.anchor = start, windows, mix(least[start]) if len(start) else np.zeros(0, U64)
        self.doc = np.searchsorted(self.at, start, side="right") - 1


def _anchors(s: Stretches, ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors by (bucket, hash), whether several documents of the batch have it, and each stretch's anchor."""
    distinct, inverse = np.unique(s.anchor, return_inverse=True)
    doc = ids[s.doc]
    low, high = np.full(len(distinct), LAST), np.full(len(distinct), -LAST - 1)
    np.minimum.at(low, inverse, doc)
    np.maximum.at(high, inverse, doc)
    order = np.argsort(distinct % U64(buckets), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], (low != high)[order], place[inverse]


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, :6] = six
    return eight.view("<u8").ravel()


def _bucket_rows(distinct: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    bucket = (distinct % U64(buckets)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), slice(cuts[b], cuts[b + 1])


def _binary(values: list) -> pa.Array:
    return pa.array(values, pa.binary())


def _ask_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, ids, lengths, body in zip(*(batch.column(i) for i in range(4))):
                ids, lengths = np.frombuffer(ids.as_py(), np.int64), np.frombuffer(lengths.as_py(), np.int64)
                distinct, several, _ = _anchors(Stretches(body.as_py(), lengths), ids, buckets)
                rows = [
                    (b, name.as_py(), _six(distinct[part] // U64(buckets)), np.packbits(several[part]).tobytes())
                    for b, part in _bucket_rows(distinct, buckets)
                ]
                if rows:
                    b, names, hashes, bits = zip(*rows)
                    arrays = [pa.array(b, pa.int32()), pa.array(names, pa.int64()), _binary(list(hashes)), _binary(list(bits))]
                    yield pa.RecordBatch.from_arrays(arrays, ["bucket", "batch", "hashes", "several"])

    return run


def _answer_anchors(table: pa.Table) -> pa.Table:
    """One bucket: for each batch, one bit for each anchor: another document has it too."""
    names = table["batch"].to_pylist()
    hashes = [_from_six(x) for x in table["hashes"].to_pylist()]
    several = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)).astype(bool)
        for x, h in zip(table["several"].to_pylist(), hashes)
    ]
    every, inside = np.concatenate(hashes), np.concatenate(several)
    order = np.argsort(every)
    same = every[order[1:]] == every[order[:-1]]
    twice = np.zeros(len(every), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    wanted, done, rows = twice | inside, 0, []
    # a batch's own flag speaks for its anchor alone; where two batches have it, twice is set for both
    for h in hashes:
        rows.append(np.packbits(wanted[done : done + len(h)]).tobytes())
        done += len(h)
    return pa.table(
        {"batch": pa.array(names, pa.int64()), "bucket": table["bucket"].combine_chunks(), "bits": _binary(rows)}
    )


ASK_SQL = "bucket int, batch long, kind int, n long, sizes binary, ids binary, hashes binary, marks binary, body binary"
ASK = pa.schema(
    [("bucket", pa.int32()), ("batch", pa.int64()), ("kind", pa.int32()), ("n", pa.int64())]
    + [(c, pa.binary()) for c in ("sizes", "ids", "hashes", "marks", "body")]
)


def _ask_stretches(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, ids, lengths, body, answers in zip(*(batch.column(i) for i in range(5))):
                ids, lengths = np.frombuffer(ids.as_py(), np.int64), np.frombuffer(lengths.as_py(), np.int64)
                s = Stretches(body.as_py(), lengths)
                distinct, _, inverse = _anchors(s, ids, buckets)
                bits = {x["bucket"]: x["bits"] for x in answers.as_py() or []}
                wanted = np.zeros(len(distinct), bool)
                for b, part in _bucket_rows(distinct, buckets):
                    wanted[part] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=part.stop - part.start).astype(bool)
                mine = np.flatnonzero(wanted[inverse])
                if not len(mine):
                    continue
                yield _stretch_rows(name.as_py(), s, ids, mine, distinct, inverse, buckets)

    return run


def _stretch_rows(name: int, s: Stretches, ids, mine, distinct, inverse, buckets) -> pa.RecordBatch:
    start, windows, anchor = s.start[mine], s.windows[mine], inverse[mine]
    size = windows + MATCH - 1
    mark = tb.range_hash(tb.prefix(s.buf, tb.BYTE_VALUES), start, start + size)
    # distinct stretches in the order of (bucket, anchor, hash)
    order = np.lexsort((mark, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order[1:]] != anchor[order[:-1]]) | (mark[order[1:]] != mark[order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    one = order[new]
    n = len(one)
    low = np.full(n, LAST)
    np.minimum.at(low, number, ids[s.doc[mine]])
    bucket = (distinct[anchor[one]] % U64(buckets)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    total = np.cumsum(size[one])
    from_ = np.arange(total[-1]) + np.repeat(start[one] - (total - size[one]), size[one])
    bodies = s.buf[from_]
    ends = np.concatenate([[0], total])
    rows: list[list] = [[] for _ in ASK]

    def add(*values):
        for col, value in zip(rows, values):
            col.append(value)

    for b in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[b], cuts[b + 1])
        keys = distinct[anchor[one[part]]] // U64(buckets)
        add(
            int(b), name, 0, part.stop - part.start,
            size[one[part]].astype(np.uint8).tobytes(), low[part].tobytes(), _six(keys), None,
            pa.compress(bodies[ends[part.start] : ends[part.stop]], "zstd", asbytes=True),
        )
    # the batch's own list: where each stretch lies, for when the answers come
    by_start = np.argsort(start)
    add(
        name % buckets, name, 1, len(mine),
        windows[by_start].astype(np.uint8).tobytes(), low.tobytes(),
        np.diff(start[by_start], prepend=0).astype(np.uint32).tobytes(), number[by_start].astype(np.uint32).tobytes(), None,
    )
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, ASK)], schema=ASK)


def _joined(buf: np.ndarray, at: np.ndarray, size: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the strings, one after another, and where each begins."""
    total = np.cumsum(size[rows])
    take = np.arange(total[-1]) + np.repeat(at[rows] - (total - size[rows]), size[rows])
    return buf[take], np.concatenate([[0], total])


def _may_match(strings: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which strings have a window whose hash another window has too."""
    windows = np.diff(ends) - MATCH + 1
    total = np.cumsum(windows)
    start = np.arange(total[-1]) + np.repeat(ends[:-1] - (total - windows), windows)
    key = tb.range_hash(tb.prefix(strings, tb.BYTE_VALUES), start, start + MATCH)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.logical_or.reduceat(twice, total - windows)


def _answer_stretches(table: pa.Table) -> pa.Table:
    """One bucket: a mask for every stretch sent, with a bit for each window an earlier document has."""
    lists = table.filter(pc.equal(table["kind"], 1))
    asked = table.filter(pc.equal(table["kind"], 0))
    if not asked.num_rows:
        return lists
    sizes = [np.frombuffer(x, np.uint8).astype(np.int64) for x in asked["sizes"].to_pylist()]
    size = np.concatenate(sizes)
    low = np.concatenate([np.frombuffer(x, np.int64) for x in asked["ids"].to_pylist()])
    anchor = np.concatenate([_from_six(x) for x in asked["hashes"].to_pylist()])
    bodies = [pa.decompress(x, int(n.sum()), "zstd", asbytes=True) for x, n in zip(asked["body"].to_pylist(), sizes)]
    buf = np.frombuffer(b"".join(bodies), np.uint8)
    at = np.concatenate([[0], np.cumsum(size)])
    mark = tb.range_hash(tb.prefix(buf, tb.BYTE_VALUES), at[:-1], at[1:])
    order = np.lexsort((mark, anchor))
    new_anchor = np.ones(len(order), bool)
    new_anchor[1:] = anchor[order[1:]] != anchor[order[:-1]]
    new = new_anchor.copy()
    new[1:] |= mark[order[1:]] != mark[order[:-1]]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    one = order[new]  # a row of each distinct stretch
    least = np.minimum.reduceat(low[order], np.flatnonzero(new))
    group = np.cumsum(new_anchor[new]) - 1  # its anchor
    variants = np.bincount(group)[group]
    # settled by equality: the smallest document that has the stretch has all of its windows
    owners = np.full((len(one), WINDOWS), LAST)
    windows = size[one] - MATCH + 1
    in_it = np.arange(WINDOWS) < windows[:, None]
    owners[in_it] = np.repeat(least, windows)
    # stretches that share no window's hash with another can't match: the index is for the rest
    many = np.flatnonzero(variants > 1)
    if len(many):
        many = many[_may_match(*_joined(buf, at, size, one[many]))]
    if len(many):
        many = many[np.argsort(least[many], kind="stable")]
        strings, ends = _joined(buf, at, size, one[many])
        index = RunIndex(strings, ends, least[many], MATCH)
        owners[many] = index.least_owners(np.diff(ends), WINDOWS)
    bits = (owners[number] < low[:, None]) & in_it[number]
    masks = (bits.astype(np.uint32) << np.arange(WINDOWS, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)
    done, out = 0, []
    for x in sizes:
        out.append(masks[done : done + len(x)].tobytes())
        done += len(x)
    nothing = pa.nulls(asked.num_rows, pa.binary())
    answered = pa.Table.from_arrays(
        [asked["bucket"], asked["batch"], asked["kind"], asked["n"], nothing, nothing, nothing, _binary(out), nothing], schema=ASK
    )
    return pa.concat_tables([lists, answered])


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
    + [("removed", pa.binary()), ("kept", pa.binary())]
)
RESULT_SQL = "doc_id long, n_bytes long, n_removed long, n_spans long, removed binary, kept binary"


def _covered(s_at: np.ndarray, n: int, ids: np.ndarray, answers: list[dict]) -> np.ndarray:
    """Which bytes of a batch go."""
    edge = np.zeros(n + 1, np.int32)
    own = next((x for x in answers if x["kind"] == 1), None)
    if own is not None:
        masks = [x for x in answers if x["kind"] == 0]
        masks.sort(key=lambda x: x["bucket"])
        mask = np.concatenate([np.frombuffer(x["marks"], np.uint32) for x in masks])
        start = np.cumsum(np.frombuffer(own["hashes"], np.uint32).astype(np.int64))
        windows = np.frombuffer(own["sizes"], np.uint8).astype(np.int64)
        number = np.frombuffer(own["marks"], np.uint32)
        low = np.frombuffer(own["ids"], np.int64)
        doc = ids[np.searchsorted(s_at, start, side="right") - 1]
        whole = np.uint32(0xFFFFFFFF)
        bits = np.where(doc > low[number], whole, mask[number])  # a smaller document of the batch has all of it
        hits = [start[(w < windows) & ((bits >> np.uint32(w)) & np.uint32(1)).astype(bool)] + w for w in range(WINDOWS)]
        hit = np.concatenate(hits)
        edge += np.bincount(hit, minlength=n + 1).astype(np.int32)
        edge -= np.bincount(hit + MATCH, minlength=n + 1).astype(np.int32)
    return np.cumsum(edge[:n]) > 0


def _finish(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lengths, body, answers in zip(*(batch.column(i) for i in range(4))):
                ids, lengths = np.frombuffer(ids.as_py(), np.int64), np.frombuffer(lengths.as_py(), np.int64)
                body = body.as_py()
                buf = np.frombuffer(body, np.uint8)
                at = np.concatenate([[0], np.cumsum(lengths)])
                gone = _covered(at, len(buf), ids, answers.as_py() or [])
                opens = gone.copy()
                edge = np.zeros(len(buf) + 1, bool)
                edge[at] = True
                opens[1:] &= ~gone[:-1] | edge[1:-1]
                closes = gone.copy()
                closes[:-1] &= ~gone[1:] | edge[1:-1]
                first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
                cuts = np.searchsorted(first, at)
                n_removed = tb.per_row(gone, at)
                spans, kept = [], []
                for i in range(len(ids)):
                    a, b = int(at[i]), int(at[i + 1])
                    if n_removed[i]:
                        here = slice(cuts[i], cuts[i + 1])
                        spans.append(np.stack([first[here] - a, last[here] - a], 1).astype("<i8").tobytes())
                        text = buf[a:b][~gone[a:b]].tobytes()
                    else:
                        spans.append(b"")
                        text = body[a:b]
                    kept.append(text if with_text else hashlib.sha256(text).digest())
                arrays = [
                    pa.array(ids, mask=ids == LAST), pa.array(lengths), pa.array(n_removed), pa.array(np.diff(cuts)),
                    _binary(spans), _binary(kept),
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=RESULT)

    return run


def substring_dedup(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, removed (start and end of each
    removed run as little-endian 64-bit numbers) and kept, the remaining bytes (or, without
    ``with_text``, their SHA-256)."""
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"byte_batches_{uuid.uuid4().hex}"
    d = id_text(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), "text")
    writer = d.mapInArrow(_pack, BATCH_SQL).write.format("parquet").option("compression", "zstd")
    writer.option("path", work_dir(spark, name)).bucketBy(min(buckets, MOST_TABLE_BUCKETS), "batch").saveAsTable(name)
    table = spark.table(name)

    asked = table.mapInArrow(_ask_anchors(buckets), "bucket int, batch long, hashes binary, several binary")
    told = asked.groupBy("bucket").applyInArrow(_answer_anchors, "batch long, bucket int, bits binary")
    told = told.groupBy("batch").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    with_answers = table.join(told, "batch").select("batch", "ids", "lengths", "body", "answers")

    stretches = with_answers.mapInArrow(_ask_stretches(buckets), ASK_SQL)
    answers = saved(stretches.groupBy("bucket").applyInArrow(_answer_stretches, ASK_SQL), "stretch-answers")
    per_batch = answers.groupBy("batch").agg(
        F.collect_list(F.struct("bucket", "kind", "sizes", "ids", "hashes", "marks")).alias("answers")
    )
    complete = table.join(per_batch, "batch", "left").select("ids", "lengths", "body", "answers")
    result = saved(complete.mapInArrow(_finish(with_text), RESULT_SQL), "substring-dedup")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return result
