"""Substring dedup by hashing lines or paragraphs over the whole corpus.

A unit is a stretch between line ends (or between blank lines).  Its digest is the
128-bit MD5 of its text, lower-cased and with white space folded to single blanks.
Digests are grouped over all documents; the occurrence that ranks first (smallest
doc_id, then position) stays and every other one is removed, with the offsets in
code points that it had in the original text.

Every unit with a character that isn't white space counts (``least_chars`` of 1).  A passage that was
copied into a longer line shares no whole line with its source, so a unit of two sentences or more also
gives its sentences of at least ``least_sentence`` normalised characters: a sentence ends at white space
after ``.``, ``!`` or ``?``.  Lines and sentences share one space of digests, and the same rule holds for both.  What lies in
a removed unit goes with it and isn't told again.

Hot units: the first occurrence is found by an aggregate that combines inside each task,
and the join back is a plain equality join, whose hot partitions Spark splits.

Defined results: a null text counts as empty; an empty text has no units; a null doc_id
ranks last; documents that share a doc_id are told apart by a hash of their text; rows
repeated with doc_id and text are one document for the ranking, so none of their copies
loses what another keeps; an empty table gives no rows; long texts are handled whole;
further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import id_text, saved

LEAST_CHARS = 1
#: A sentence of a passage; shorter ones are common phrases.
LEAST_SENTENCE = 50
LAST = (1 << 63) - 1
SENTENCE_END = re.compile(r"[.!?]\s+")
SEPARATORS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n\s*\n")}
UNIT_SCHEMA = "doc_id long, version long, start_at int, end_at int, digest binary"


def cut(text: str, unit: str = "line") -> list[tuple[int, int]]:
    """Start and end of every unit of a text, separators left out."""
    spans, at = [], 0
    for m in SEPARATORS[unit].finditer(text):
        spans.append((at, m.start()))
        at = m.end()
    spans.append((at, len(text)))
    return spans


def sentences(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Start and end of every sentence of a unit, white space after it left out; none if there is but one."""
    spans, at = [], start
    for m in SENTENCE_END.finditer(text, start, end):
        spans.append((at, m.end()))
        at = m.end()
    spans = [(a, a + len(text[a:b].rstrip())) for a, b in [*spans, (at, end)]]
    spans = [(a, b) for a, b in spans if text[a:b].strip()]
    return spans if len(spans) > 1 else []


def norm_of(text: str) -> str:
    return " ".join(text.lower().split())


def units_of(text: str, unit: str, least_chars: int, least_sentence: int | None) -> Iterator[tuple[int, int, str]]:
    """Start, end and normalised text of every unit that counts."""
    for a, b in cut(text, unit):
        norm = norm_of(text[a:b])
        if norm and len(norm) >= least_chars:
            yield a, b, norm
        if least_sentence is not None and len(norm) > least_sentence:
            for c, d in sentences(text, a, b):
                norm = norm_of(text[c:d])
                if len(norm) >= least_sentence:
                    yield c, d, norm


def versioned(docs: DataFrame) -> DataFrame:
    """doc_id (null: ranks last), version (tells texts under one doc_id apart), text."""
    d = id_text(docs)
    return d.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), F.xxhash64("text").alias("version"), "text")


def text_units(
    docs: DataFrame, unit: str = "line", least_chars: int = LEAST_CHARS, least_sentence: int | None = LEAST_SENTENCE
) -> DataFrame:
    """Every unit that counts: doc_id, version, start_at, end_at, digest."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for doc, version, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for a, b, norm in units_of(text, unit, least_chars, least_sentence):
                    digest = hashlib.md5(norm.encode()).digest()
                    for col, value in zip(cols, (doc, version, a, b, digest)):
                        col.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "version", "start_at", "end_at", "digest"])

    return versioned(docs).mapInArrow(units, UNIT_SCHEMA)


def removed_units(units: DataFrame) -> DataFrame:
    """The units that an earlier-ranked occurrence makes redundant."""
    here = F.struct("doc_id", "version", "start_at")
    repeated = (
        units.groupBy("digest")
        .agg(F.min(here).alias("first"), F.max(here).alias("last"))
        .filter("first != last")
        .select("digest", "first")
    )
    # written, so that the join has two plain shuffles, whose hot partitions Spark splits
    return units.join(saved(repeated, "repeated-units"), "digest").filter(here != F.col("first"))


def _outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that lie in no other one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or b > out[-1][1]:
            out.append((a, b))
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; the line end, or the blanks, after a removed unit go with it."""
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
        while text[at : at + 1].isspace() and text[at] != "\n":
            at += 1
        if text[at : at + 1] == "\n" and (a == 0 or text[a - 1] == "\n"):
            at += 1
    kept.append(text[at:])
    return "".join(kept)


def line_dedup(
    docs: DataFrame, unit: str = "line", least_chars: int = LEAST_CHARS, least_sentence: int | None = LEAST_SENTENCE
) -> DataFrame:
    """One row per document: doc_id, n_units, n_removed, removed_chars, removed (start:end
    of each removed unit in the original text, comma-joined) and kept_text.  Without
    ``least_sentence`` only whole lines or paragraphs are units."""
    units = saved(text_units(docs, unit, least_chars, least_sentence), "text-units")
    span = F.struct(F.col("start_at").alias("a"), F.col("end_at").alias("b"))
    # distinct: rows repeated with doc_id and text give their units twice
    gone = removed_units(units).select("doc_id", "version", "start_at", "end_at").distinct()
    per_doc = gone.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(span)).alias("spans"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                spans = _outermost([(s["a"], s["b"]) for s in spans or []])
                rows.append(
                    {
                        "doc_id": None if doc == LAST else doc,
                        "n_units": sum(1 for _ in units_of(text, unit, least_chars, least_sentence)),
                        "n_removed": len(spans),
                        "removed_chars": sum(b - a for a, b in spans),
                        "removed": ",".join(f"{a}:{b}" for a, b in spans),
                        "kept_text": _without(text, spans),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, RESULT)

    joined = versioned(docs).join(per_doc, ["doc_id", "version"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        finish, "doc_id long, n_units long, n_removed long, removed_chars long, removed string, kept_text string"
    )


RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_units", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed_chars", pa.int64()),
        ("removed", pa.string()),
        ("kept_text", pa.string()),
    ]
)
