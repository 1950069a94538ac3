"""Quality rules as a short-circuit cascade.

A rule looks at one or two counts of a text and rejects it or lets it pass; a text is kept
if no rule rejects it, so the verdict doesn't depend on the order.  The order decides the
work: a rejected text is not looked at again.  A bounded sample (SAMPLE_ROWS texts of at most
SAMPLE_BYTES, from the first partitions that have them) gives each rule's seconds and
rejections, and the rules run by rejections per second, highest first.  Counts and verdicts
cover every document.

All counting is vectorised over the bytes of an Arrow batch; nothing is shuffled, and a
batch is cut to a few MB, so a task's memory doesn't depend on the table.

Defined results: a null or empty text has no words and fails the base rule of 50 words;
repeated rows are judged alike; an empty table gives no rows; long texts are counted
whole; a null doc_id is carried through; further columns aren't read by the report and
are passed on untouched by the filter, whatever their names.
"""

from __future__ import annotations

import time
from functools import cached_property
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm import textbytes as tb
from clickflow.llm.common import id_text

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
REPEAT_WINDOW = 3
SAMPLE_ROWS = 512
SAMPLE_BYTES = 1 << 16


class Counts:
    """Counts of every text of a batch, each made when it is first asked for."""

    def __init__(self, column: pa.Array):
        self.buf, self.at = tb.packed(column)

    @cached_property
    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        return tb.word_bounds(self.buf, self.at)

    @cached_property
    def word_rows(self) -> np.ndarray:
        """Where each text's words begin in the list of words."""
        return np.searchsorted(self.bounds[0], self.at)

    @cached_property
    def hash_state(self):
        return tb.prefix(self.buf, tb.BYTE_VALUES)

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_rows)

    @cached_property
    def word_chars(self) -> np.ndarray:
        """Code points in words: bytes that aren't white space and don't continue a character."""
        return tb.per_row(~tb.SPACE[self.buf] & ((self.buf & 0xC0) != 0x80), self.at)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return tb.per_row(SYMBOLS[self.buf], self.at)

    @cached_property
    def n_capitals(self) -> np.ndarray:
        return tb.per_row((self.buf >= 65) & (self.buf <= 90), self.at)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them that equal an earlier line of their text."""
        if not len(self.buf):
            return np.zeros(len(self.at) - 1, np.int64), np.zeros(len(self.at) - 1, np.int64)
        ends = np.flatnonzero(self.buf == tb.NEWLINE)
        starts = np.unique(np.concatenate([self.at[:-1], ends + 1]))
        starts = starts[starts < len(self.buf)]
        stops = np.append(starts[1:], len(self.buf))
        row = tb.row_of(starts, self.at)
        stops = np.where((stops > starts) & (self.buf[np.maximum(stops - 1, 0)] == tb.NEWLINE), stops - 1, stops)
        first = self.bounds[0]
        worded = np.searchsorted(first, stops) > np.searchsorted(first, starts)
        starts, stops, row = starts[worded], stops[worded], row[worded]
        key = tb.mix(tb.range_hash(self.hash_state, starts, stops) + row.astype(tb.U64) * tb.U64(tb.BASE))
        _, once = np.unique(key, return_index=True)
        n = len(self.at) - 1
        total = np.bincount(row, minlength=n)
        return total, total - np.bincount(row[once], minlength=n)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in windows of three words that the text has twice or more."""
        starts, ends = self.bounds
        row = np.repeat(np.arange(len(self.at) - 1), self.n_words)
        words = tb.range_hash(self.hash_state, starts, ends)
        window = tb.shingle_hashes(words, REPEAT_WINDOW)
        inside = row[: len(window)] == row[len(row) - len(window) :]
        at = np.flatnonzero(inside)
        key = tb.mix(window[at] + row[at].astype(tb.U64) * tb.U64(tb.BASE))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(len(words) + REPEAT_WINDOW, bool)
        for i in range(REPEAT_WINDOW):
            covered[at[twice] + i] = True
        return tb.per_row(covered[: len(words)], self.word_rows)


class Rule:
    """A named test that returns which texts it rejects."""

    def __init__(self, name: str, rejects: Callable[[Counts], np.ndarray]):
        self.name, self.rejects = name, rejects


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", lambda c: c.n_words < 50),
        Rule("repeated_words", lambda c: 100 * c.n_repeat_words > 50 * c.n_words),
    ]


def more_rules() -> list[Rule]:
    """Limits far outside what running text or tables of words reach."""
    return [
        Rule("symbols", lambda c: 100 * c.n_symbols > 30 * c.n_words),
        Rule("repeated_lines", lambda c: 100 * c.lines[1] > 40 * c.lines[0]),
        Rule("capitals", lambda c: 100 * c.n_capitals > 40 * c.word_chars),
        Rule("word_length", lambda c: (c.word_chars < 2 * c.n_words) | (c.word_chars > 15 * c.n_words)),
    ]


def default_rules() -> list[Rule]:
    return base_rules() + more_rules()


def _text_column(batch: pa.RecordBatch) -> pa.Array:
    text = batch.column(batch.schema.get_field_index("text"))
    return text.cast(pa.large_string()).fill_null("")


def estimate(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Each rule's seconds and rejections on the sample, which is small enough for the driver."""
    short = id_text(docs).filter(F.octet_length("text") <= SAMPLE_BYTES).select("text")
    column, out = pa.array([r.text for r in short.limit(sample_rows).collect()], pa.large_string()), []
    for rule in rules:  # fresh counts: what a rule costs if it is the first to need them
        t = time.perf_counter()
        rejected = int(rule.rejects(Counts(column)).sum())
        out.append({"rule": rule.name, "seconds": time.perf_counter() - t, "rejected": rejected, "seen": len(column)})
    return out


def cascade_order(told: list[dict], rules: Sequence[Rule]) -> list[Rule]:
    """Rules by rejections per second, highest first; ties and unseen rules keep their order."""
    rate = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in told}
    return sorted(rules, key=lambda rule: -rate.get(rule.name, 0.0))


def run_cascade(column: pa.Array, rules: Sequence[Rule], counts: Counts | None = None) -> np.ndarray:
    """Which texts of a batch pass all rules; each rule sees only what the earlier ones let pass."""
    alive = np.arange(len(column))
    counts = counts or Counts(column)
    for rule in rules:
        if not len(alive):
            break
        rejected = rule.rejects(counts)
        if rejected.any():
            alive = alive[~rejected]
            counts = Counts(column.take(pa.array(alive)))
    kept = np.zeros(len(column), bool)
    kept[alive] = True
    return kept


def passing(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that every rule lets pass, whole and without a shuffle."""
    rules = default_rules() if rules is None else list(rules)
    rules = cascade_order(estimate(docs, rules), rules)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = _text_column(whole)
            text_only = pa.RecordBatch.from_arrays([column], ["text"])
            done = 0
            for part in tb.slices(text_only, "text"):
                kept = run_cascade(part.column(0), rules)
                yield whole.slice(done, part.num_rows).filter(pa.array(kept))
                done += part.num_rows

    return docs.mapInArrow(keep, docs.schema)


def quality_report(docs: DataFrame, more: Sequence[Rule] | None = None) -> DataFrame:
    """One row per document: its counts, base_failed and kept.

    The counts are asked for of every text, so the base verdict comes from them; texts
    that pass it go through the cascade of further rules."""
    more = more_rules() if more is None else list(more)
    more = cascade_order(estimate(docs, more), more)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole, "text"):
                column = batch.column("text").cast(pa.large_string())
                c = Counts(column)
                failed = (c.n_words < 50) | (100 * c.n_repeat_words > 50 * c.n_words)
                passed = np.flatnonzero(~failed)
                kept = np.zeros(len(column), bool)
                kept[passed] = run_cascade(column.take(pa.array(passed)), more)
                longs = (c.n_words, c.word_chars, c.n_symbols, c.lines[1], c.n_repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in longs], pa.array(failed), pa.array(kept)],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
                )

    return id_text(docs).mapInArrow(
        report,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean",
    )
