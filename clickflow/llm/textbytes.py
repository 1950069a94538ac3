"""Vectorised views of Arrow text batches: bytes, words, lines and rolling hashes.

Every function works on one batch inside a task.  Hashes are 64 bits; equal strings
always hash alike, and different ones meet with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NEWLINE = 0x0A


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_fold = np.arange(256)
_fold[65:91] += 32
LOWER_VALUES = BYTE_VALUES[_fold]

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        inverse = pow(BASE, -1, 1 << 64)
        for name, b in (("up", BASE), ("down", inverse)):
            steps = np.full(n, b, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each row starts (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return buf, at - at[0]


def slices(batch: pa.RecordBatch, text: str, most: int = 2 << 20):
    """Cut a batch into runs of rows of about ``most`` bytes of text; a longer single row stands alone."""
    _, at = packed(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(at, at[start] + most, side="right")) - 1
        end = min(batch.num_rows, max(start + 1, end))
        yield batch.slice(start, end - start)
        start = end


def prefix(buf: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums for :func:`range_hash`."""
    up, down = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, U64)
    np.cumsum(values[buf] * up[: len(buf)], out=sums[1:])
    return sums, down


def range_hash(state: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of bytes start to end, wherever they lie."""
    sums, down = state
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_bounds(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a word never crosses rows."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[at] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def row_of(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(at, starts, side="right") - 1


def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words of one sequence of word hashes, by its first word."""
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), U64)
    for i in range(k):
        out = out * U64(0xC2B2AE3D27D4EB4F) + words[i : i + len(out)]
    return mix(out)
