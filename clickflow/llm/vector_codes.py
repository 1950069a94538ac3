"""Product codes for vectors, with codebooks made by active-entry Lloyd rounds.

A vector is cut into ``parts`` equal pieces.  Each piece has a codebook of its own, and is
replaced by the index of the nearest entry (squared distance; of equal ones the lower index).
Codebooks start as the pieces of the smallest vec_ids; a round assigns every piece and
replaces each entry by the floor of its pieces' mean.  All numbers are integers and exact.

* Active entries: a piece keeps its index and its exact distance.  After a round some entries
  have moved.  A piece whose entry stayed fixed was nearest to it among all fixed entries, and
  still is, so it is compared with the moved entries only, against the stored distance; a moved
  entry wins if it is nearer, or as near with a lower index.  Pieces whose entry moved rescan the
  whole codebook.  When no entry moves the rest of the rounds change nothing and are left out.
* A round is one pass: a task reads vectors with their state, writes the new state, and adds
  sums and counts of its pieces per entry as a few rows of the same table.  Only these sums,
  entries times components, are added up and come to the driver.  The state is a written
  table, so a lost executor repeats its share of one round; the table before it is then removed.
* No shuffle of vectors but the one that adds the errors of a label, whose sums are made
  inside each task first; the join back to a hot label is one that Spark splits.

Defined results: a vector that is null, or holds a null or non-finite component, is dropped, and so
is one whose length isn't that of the smallest kept vec_id or no positive multiple of
``parts`` (it has no code); a null vec_id ranks last and keeps its row; rows with one vec_id
each give a row, ordered by their components when the codebooks start; fewer rows than entries give smaller codebooks;
components beyond 2**50 count as 2**50 (below that any size is exact); an error beyond 64 bits is
null, and so is the label_error of its label; an empty table gives no rows; further columns
aren't read.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.config import remove_dir, work_dir
from clickflow.llm import textbytes as tb
from clickflow.llm.common import saved

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 62
MOST_LONG = (1 << 63) - 1
#: Vectors compared at once.
ROWS = 8192

Codebooks = list[list[list[int]]]  # part, entry, position


def kept_vectors(table: DataFrame, parts: int = PARTS) -> DataFrame:
    """vec_id, label and x (doubles) of the rows whose vector can be coded."""
    x = table["embedding"].cast("array<double>")
    whole = table.select(table["vec_id"].cast("bigint").alias("vec_id"), table["label"], x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return whole.filter(F.col("x").isNotNull() & finite & (F.size("x") > 0) & (F.size("x") % parts == 0))


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(x * scale), -float(LARGEST), float(LARGEST)).astype(np.int64)


# -- one round inside a task -----------------------------------------------------------
def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of x to each entry: floats below 2**53, else Python integers."""
    most = max(int(np.abs(x).max(initial=0)), max((abs(int(v)) for v in entries.ravel()), default=0))
    if x.shape[1] * (2 * most) ** 2 < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    gap = x.astype(object)[:, None, :] - entries.astype(object)
    return (gap * gap).sum(2)


def assign(x: np.ndarray, code: np.ndarray, dist: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and distances of one part's pieces after ``moved`` of its entries changed.

    ``dist`` is the exact distance to entry ``code``, or negative where it isn't known."""
    code, dist = code.copy(), dist.astype(object if dist.dtype == object else np.float64)
    stale = moved[code] | (dist < 0)
    if stale.any():
        d = distances(x[stale], entries)
        best = np.argmin(d, axis=1)  # the first of equal ones
        code[stale] = best
        dist = dist.astype(object) if d.dtype == object else dist
        dist[stale] = d[np.arange(len(d)), best]
    fixed, active = np.flatnonzero(~stale), np.flatnonzero(moved)
    if len(fixed) and len(active):
        d = distances(x[fixed], entries[active])
        best = np.argmin(d, axis=1)
        near, index = d[np.arange(len(d)), best], active[best]
        better = (near < dist[fixed]) | ((near == dist[fixed]) & (index < code[fixed]))
        dist = dist.astype(object) if d.dtype == object else dist
        code[fixed[better]], dist[fixed[better]] = index[better], near[better]
    return code, dist


def _large(x: np.ndarray) -> np.ndarray:
    """Rows whose distances floats can't hold: they are handled apart from the others."""
    bound = int((1 << 25) / max(1, x.shape[2]) ** 0.5)
    return np.abs(x).max(axis=(1, 2)) > bound


def _rows_assigned(x: np.ndarray, code: np.ndarray, dist: np.ndarray, books: list[np.ndarray], moved: list[np.ndarray]):
    """code, dist and error (None: beyond a long) of some vectors; dist is -1 where a float isn't exact."""
    new_code, new_dist = code.copy(), np.full(dist.shape, -1, np.int64)
    errors = np.zeros(len(x), np.int64)
    for part, (entries, changed) in enumerate(zip(books, moved)):
        c, d = assign(x[:, part], code[:, part], dist[:, part], entries, changed)
        new_code[:, part] = c
        small = d < 1 << 53
        new_dist[small, part] = d[small].astype(np.int64)
        if d.dtype == object:
            errors = errors.astype(object) + np.array([int(v) for v in d], object)
        else:  # each below 2**53
            errors = errors + d.astype(np.int64)
    return new_code, new_dist, errors if errors.dtype != object else [e if e <= MOST_LONG else None for e in errors]


def _rows_as_binary(x: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    flat = np.ascontiguousarray(x).reshape(len(x), -1)
    width = flat.shape[1] * flat.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _sums(x: np.ndarray, code: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts (part, entry) and sums (part, entry, position) of pieces by their index, as Python integers."""
    n, parts, width = x.shape
    counts = np.zeros((parts, entries), np.int64)
    sums = np.zeros((parts, entries, width), object)
    small = int(np.abs(x).max(initial=0)) * n < 1 << 53
    for part in range(parts):
        counts[part] = np.bincount(code[:, part], minlength=entries)
        for at in range(width):
            if small:
                column = np.bincount(code[:, part], x[:, part, at].astype(np.float64), entries).astype(np.int64)
                sums[part, :, at] += column.astype(object)
            else:
                np.add.at(sums[part, :, at], code[:, part], x[:, part, at].astype(object))
    return counts, sums


def _state_type(label: T.DataType) -> T.StructType:
    kinds = [("vec_id", T.LongType()), ("label", label), ("q", T.BinaryType()), ("code", T.BinaryType())]
    kinds += [("dist", T.BinaryType()), ("error", T.LongType()), ("slot", T.IntegerType())]
    return T.StructType([T.StructField(k, t) for k, t in kinds + [("n", T.LongType()), ("total", T.DecimalType(38, 0))]])


def _round(books: Codebooks, moved: list[list[bool]], scale: int | None):
    """Rows (vec_id, label, x or state) -> rows with new state, and a task's sums: slot counts (part, entry, position)
    in that order, n its pieces, total the sum of that component.  ``scale``: the rows hold x, not state."""
    parts, entries, width = len(books), len(books[0]), len(books[0][0])
    tables = [np.array(b, object) for b in books]
    tables = [t.astype(np.int64) if all(abs(v) <= LARGEST for v in t.ravel()) else t for t in tables]
    changed = [np.array(m, bool) for m in moved]

    def state(batch: pa.RecordBatch):
        if scale is not None:
            column = batch.column("x")
            x = integers(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, width), scale)
            return x, np.zeros((len(x), parts), np.int64), np.full((len(x), parts), -1, np.int64)
        raw = [tb.packed(batch.column(c))[0] for c in ("q", "code", "dist")]
        x = np.frombuffer(raw[0].tobytes(), "<i8").reshape(-1, parts, width)
        return x, raw[1].reshape(-1, parts).astype(np.int64), np.frombuffer(raw[2].tobytes(), "<i8").reshape(-1, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), object)
        label = None
        for whole in batches:
            label = whole.column("label").type
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                x, code, dist = state(batch)
                new_code, new_dist = np.zeros_like(code), np.zeros_like(dist)
                errors = np.zeros(len(x), object)
                large = _large(x)
                for rows in (np.flatnonzero(~large), np.flatnonzero(large)):
                    if len(rows):
                        c, d, e = _rows_assigned(x[rows], code[rows], dist[rows], tables, changed)
                        new_code[rows], new_dist[rows], errors[rows] = c, d, e
                n, total = _sums(x, new_code, entries)
                counts += n
                sums += total
                size = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"),
                        batch.column("label"),
                        _rows_as_binary(x.astype("<i8")),
                        _rows_as_binary(new_code.astype(np.uint8)),
                        _rows_as_binary(new_dist.astype("<i8")),
                        pa.array(errors.tolist(), pa.int64()),
                        pa.nulls(size, pa.int32()),
                        pa.nulls(size, pa.int64()),
                        pa.nulls(size, pa.decimal128(38, 0)),
                    ],
                    names,
                )
        if label is None:
            return
        size = sums.size
        binary = pa.nulls(size, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(size, pa.int64()),
                pa.nulls(size, label),
                *[binary] * 3,
                pa.nulls(size, pa.int64()),
                pa.array(np.arange(size), pa.int32()),
                pa.array(np.repeat(counts.ravel(), width)),
                pa.array([Decimal(int(v)) for v in sums.ravel()], pa.decimal128(38, 0)),
            ],
            names,
        )

    names = ["vec_id", "label", "q", "code", "dist", "error", "slot", "n", "total"]
    return run


# -- rounds ----------------------------------------------------------------------------
def _updated(state: DataFrame, books: Codebooks) -> tuple[Codebooks, list[list[bool]]]:
    """New codebooks from the tasks' sums, and which entries moved."""
    sums = state.filter("slot is not null").groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    entries, width = len(books[0]), len(books[0][0])
    new = [[list(e) for e in book] for book in books]
    for r in sums.collect():  # parts * entries * width rows
        part, rest = divmod(r.slot, entries * width)
        entry, at = divmod(rest, width)
        if r.n:
            new[part][entry][at] = int(r.total) // r.n
    return new, [[a != b for a, b in zip(x, y)] for x, y in zip(new, books)]


def codebooks_text(books: Codebooks) -> str:
    return ",".join(str(v) for book in books for entry in book for v in entry)


def coded_vectors(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame | None, Codebooks]:
    """(vec_id, label, code as bytes, error) of every kept row, and the final codebooks; None if no row is kept."""
    if entries > 256:
        raise ValueError("a code has one byte a part: 256 entries at most")
    kept = kept_vectors(table, parts)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    if not first:
        return None, []
    size = len(first[0].x)
    width = size // parts
    kept = kept.filter(F.size("x") == size)
    if any(len(r.x) != size for r in first):
        first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    start = integers(np.array([r.x for r in first]), scale).reshape(-1, parts, width)
    books: Codebooks = [[[int(v) for v in e] for e in start[:, part]] for part in range(parts)]
    moved = [[True] * len(start) for _ in range(parts)]
    kind = _state_type(table.schema["label"].dataType)
    spark = table.sparkSession
    state, before = kept, None
    for nth in range(rounds + 1):
        path = work_dir(spark, "vector-state")
        found = state.mapInArrow(_round(books, moved, None if nth else scale), kind)
        found.write.option("compression", "zstd").parquet(path)
        if before:
            remove_dir(spark, before)
        whole, before = spark.read.schema(kind).parquet(path), path
        state = whole.filter("slot is null").select("vec_id", "label", "q", "code", "dist")
        if nth == rounds:
            break
        books, moved = _updated(whole, books)
        if not any(map(any, moved)):
            break  # every later round would end as this one
    return whole.filter("slot is null").select("vec_id", "label", "code", "error"), books


def vector_codes(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: vec_id, code (two hex digits a part), error, label_error, codebooks_sha256."""
    rows, books = coded_vectors(table, parts, entries, rounds, scale)
    if rows is None:
        return table.sparkSession.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        )
    known = F.count("error") == F.count("*")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = rows.groupBy("label").agg(F.when(known, total.try_cast("bigint")).alias("label_error"))
    sums = saved(sums.withColumnRenamed("label", "of"), "label-errors")
    sha = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return rows.join(sums, rows["label"].eqNullSafe(sums["of"]), "left").select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(sha).alias("codebooks_sha256"),
    )
