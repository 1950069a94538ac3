"""Audit of how the sources of a language differ in their words, over a quadtree of counts.

For each language: a matrix with a row per source and a column per kept term, whose cells
hold how often the term occurs there.  Each source gives every term a smoothed share ``p``;
two shares differ by ``f(p, q) = floor((p - q)**2 / (p + q))``.  Pairs of sources are told by
the sum of f over all kept terms, and each source by its terms that exceed the language most.

* Counting: a task adds up its documents per (language, source, term) before anything is sent, so a hot
  source or a frequent word is a row a task.
* Tiles: columns are dealt to strips and rows to bands by a hash, so that a tile has about
  ``SIDE`` of either, however many terms and sources there are.  Two bands of one strip are one
  task: it gets the cells of both, returns a partial sum a pair, and partial sums are added.
* K-squared quadtree: a tile's nonzero cells in Morton order; a node of a level is a prefix of
  their codes, and only nodes that hold a cell exist.  Columns stand in the order of how often the language
  uses them, so the rare ones leave large empty quadrants.
* Joint traversal: pairs of nodes of the two bands over the same columns go down together.
  Where both are empty every pair of their rows has the same f, that of two counts of zero: the quadrant adds
  its width to a difference array and is not entered.  Other pairs go on to leaves of
  ``LEAF`` by ``LEAF`` cells, which are priced cell by cell for all pairs of their rows.
* The terms of a source are the nonzero cells of its own band, priced against the language;
  a task returns its best ones for each source, and the best of those are ranked.

All numbers are exact: shares are made by long division in 64 bits, so that counts may be large.

Defined results: null text, lang and source count as ''; a source without kept terms takes part
with counts of zero; a language without kept terms gives pairs of value 0 and no terms; a
language with one source gives no pairs; repeated rows count each time; doc_id is not read, so
ids may be null or repeated; an empty table gives no rows; texts are read whole, long ones a
window at a time; further columns aren't read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import saved

#: A term is a stretch of letters A-Z, a-z and bytes beyond ASCII: everything else becomes a blank.
_SEEN = [b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)]
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in _SEEN)
LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Rows and columns that a tile is meant to have.
SIDE = 512
LEAF = 8
#: Node pairs that go down together.
FRONTIER = 4096
#: (source, term) counts a task holds before it sends them on; characters of a text read at once.
HELD_COUNTS = 1 << 19
WINDOW = 1 << 20


# -- counts ----------------------------------------------------------------------------
def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a list for each window of it; a window ends where no term runs on."""
    text = text.translate(TERM_BYTES)
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > WINDOW:
            gap = text.find(b" ", at + WINDOW)
            end = gap if gap >= 0 else end
        yield text[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uses: dict[tuple[str, str], Counter] = defaultdict(Counter)
    held: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def flush() -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(5)]
        for (lang, source), found in uses.items():
            cols[0] += [lang] * (len(found) + 1)
            cols[1] += [source] * (len(found) + 1)
            cols[2] += [b"", *found]  # the source occurs, with or without terms
            cols[3] += [0, *found.values()]
            cols[4] += [0, *(held[lang, source][t] for t in found)]
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        uses.clear()
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], ["lang", "source", "term", "n", "docs"]
        )

    size = 0
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary()).to_pylist()
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            group = uses[lang, source]
            before, seen = len(group), set()
            for found in terms(text):
                group.update(found)
                seen.update(found)
            held[lang, source].update(seen)
            size += len(group) - before + 1
            if size >= HELD_COUNTS:
                yield flush()
                size = 0
    yield flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); term '' for every group that occurs."""
    empty = F.lit("")
    cols = [F.coalesce(docs[c].cast("string"), empty).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*cols).mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    key = ["lang", "source", "term"]
    # tasks have added up their own documents: a partial aggregate before the shuffle would find little to add
    sums = found.repartition(*key).groupBy(*key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return sums.withColumn("term", F.col("term").cast("string"))


# -- shares ----------------------------------------------------------------------------
def share(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + 2) / whole), for n + 2 <= whole < 2**59."""
    quotient, rest = np.divmod(n + 2, whole)
    for _ in range(9):  # a digit of SCALE at a time
        digit, rest = np.divmod(rest * 10, whole)
        quotient = quotient * 10 + digit
    return quotient + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


# -- quadtree --------------------------------------------------------------------------
def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of x with a gap after each."""
    x = x.astype(np.int64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << shift)) & mask
    return x


class Quadtree:
    """The nonzero cells of a square of side ``LEAF << height``: which quadrants hold any, and the cells of each leaf."""

    def __init__(self, row: np.ndarray, col: np.ndarray, n: np.ndarray, height: int):
        leaf = (_spread(row // LEAF) << 1) | _spread(col // LEAF)
        codes, at = np.unique(leaf, return_inverse=True)
        #: levels[k]: codes of the quadrants of side LEAF << (height - k) that hold a cell
        self.levels = [np.unique(codes >> (2 * (height - k))) for k in range(height + 1)]
        #: counts of every leaf that exists, and of an empty one at the end
        self.leaves = np.zeros((len(codes) + 1, LEAF, LEAF), np.int64)
        self.leaves[at, row % LEAF, col % LEAF] = n

    def find(self, level: int, code: np.ndarray) -> np.ndarray:
        """Where a quadrant stands in its level; the level's length if it's empty."""
        here = self.levels[level]
        at = np.searchsorted(here, code)
        there = at < len(here)
        there[there] = here[at[there]] == code[there]
        return np.where(there, at, len(here))


def joint_sums(
    a: Quadtree, b: Quadtree, whole_a: np.ndarray, whole_b: np.ndarray, columns: int, height: int, same: bool
) -> np.ndarray:
    """Sum of f over the columns, for every row of ``a`` with every row of ``b``.

    ``whole_*``: the rows' denominators.  ``same``: both are one band, and of two different
    blocks of rows only the first with the second is done."""
    rows_a, rows_b = len(whole_a), len(whole_b)
    room = LEAF << height
    total = np.zeros((room, room), np.int64)
    empty = np.zeros((room + 1, room + 1), np.int64)  # difference array of columns that both leave empty
    nothing = np.zeros(1, np.int64)
    denominators = [np.ones(room, np.int64) << 40, np.ones(room, np.int64) << 40]
    denominators[0][:rows_a], denominators[1][:rows_b] = whole_a, whole_b
    cells = np.arange(LEAF)
    todo = [(0, nothing, nothing, nothing)] if columns else []
    while todo:
        level, ra, rb, c = todo.pop()
        ia = a.find(level, (_spread(ra) << 1) | _spread(c))
        ib = b.find(level, (_spread(rb) << 1) | _spread(c))
        none_a, none_b = len(a.levels[level]), len(b.levels[level])
        side = LEAF << (height - level)
        void = (ia == none_a) & (ib == none_b)
        if void.any():
            top, left = ra[void] * side, rb[void] * side
            width = np.clip(columns - c[void] * side, 0, side)
            np.add.at(empty, (top, left), width)
            np.add.at(empty, (top + side, left), -width)
            np.add.at(empty, (top, left + side), -width)
            np.add.at(empty, (top + side, left + side), width)
        go = ~void
        ra, rb, c, ia, ib = ra[go], rb[go], c[go], ia[go], ib[go]
        if not len(c):
            continue
        if level == height:
            row_a, row_b = ra[:, None] * LEAF + cells, rb[:, None] * LEAF + cells
            p = share(a.leaves[ia], denominators[0][row_a][:, :, None])
            q = share(b.leaves[ib], denominators[1][row_b][:, :, None])
            priced = price(p[:, :, None, :], q[:, None, :, :])
            priced *= (c[:, None] * LEAF + cells < columns)[:, None, None, :]
            np.add.at(total, (row_a[:, :, None], row_b[:, None, :]), priced.sum(-1))
            continue
        # the eight pairs of children over the same half of the columns
        bits = np.arange(8)
        ra = (ra[:, None] * 2 + (bits >> 2)).ravel()
        rb = (rb[:, None] * 2 + (bits >> 1 & 1)).ravel()
        c = (c[:, None] * 2 + (bits & 1)).ravel()
        half = side // 2
        inside = (ra * half < rows_a) & (rb * half < rows_b) & (c * half < columns)
        if same:
            inside &= ra <= rb
        ra, rb, c = ra[inside], rb[inside], c[inside]
        for i in range(0, len(c), FRONTIER):
            part = slice(i, i + FRONTIER)
            todo.append((level + 1, ra[part], rb[part], c[part]))
    zero = np.zeros(1, np.int64)
    zero_price = price(share(zero, whole_a)[:, None], share(zero, whole_b)[None, :]) if columns else 0
    widths = empty.cumsum(0).cumsum(1)[:rows_a, :rows_b]
    return total[:rows_a, :rows_b] + widths * zero_price


PARTIAL = "lang string, source string, part string, item string, value long"


def _tile_values(top: int):
    """Two bands of one strip -> partial sums of their pairs of sources, and the best terms of each source."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        lang, low, high = tile["lang"].iloc[0], tile["low"].iloc[0], tile["high"].iloc[0]
        cell = tile[tile["term"].notna()]
        used = cell.drop_duplicates("term").sort_values(["used", "term"], ascending=[False, True])
        column = pd.Series(np.arange(len(used)), index=used["term"].to_numpy())
        columns = int(tile["columns"].iloc[0])
        bands = {}
        most = max(columns, 1)
        for band in {low, high}:
            rows = tile[(tile["band"] == band) & tile["term"].isna()].sort_values("source")
            bands[band] = rows["source"].to_numpy(), rows["whole"].to_numpy(np.int64)
            most = max(most, len(rows))
        height = max(0, int(np.ceil(np.log2(-(-most // LEAF)))))
        trees, placed = {}, {}
        for band, (names, _) in bands.items():
            own = cell[cell["band"] == band]
            row = pd.Series(np.arange(len(names)), index=names)[own["source"]].to_numpy(np.int64)
            col = column[own["term"]].to_numpy(np.int64)
            placed[band] = own, row
            trees[band] = Quadtree(row, col, own["n"].to_numpy(np.int64), height)
        (names_a, whole_a), (names_b, whole_b) = bands[low], bands[high]
        sums = joint_sums(trees[low], trees[high], whole_a, whole_b, columns, height, low == high)
        i, j = np.triu_indices(len(names_a), 1) if low == high else map(np.ravel, np.indices(sums.shape))
        out = [pd.DataFrame({"source": names_a[i], "part": "pair", "item": names_b[j], "value": sums[i, j]})]
        if low == high and len(placed[low][0]):
            own, row = placed[low]
            p = share(own["n"].to_numpy(np.int64), whole_a[row])
            q = share(own["used"].to_numpy(np.int64), own["lang_whole"].to_numpy(np.int64))
            best = own.assign(part="term", item=own["term"], value=price(p, q))[p > q]
            best = best.sort_values(["source", "value", "term"], ascending=[True, False, True]).groupby("source").head(top)
            out.append(best[["source", "part", "item", "value"]])
        both = pd.concat(out)
        both.insert(0, "lang", lang)
        return both

    return run


def _dealt(column: str, parts: str):
    return F.pmod(F.xxhash64(column), F.col(parts)).cast("int")


def partial_values(counts: DataFrame, least_docs: int, top: int, side: int) -> DataFrame:
    """The partial sums and best terms of every tile, from :func:`term_counts`."""
    kept = counts.filter("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("used"))
    kept = saved(kept.filter(F.col("docs") >= least_docs).select("lang", "term", "used"), "kept-terms")
    cells = saved(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "term-cells")
    groups = counts.filter("term = ''").select("lang", "source")
    uses = cells.groupBy("lang", "source").agg(F.sum("n").alias("uses"))
    groups = groups.join(uses, ["lang", "source"], "left").select("lang", "source", F.coalesce("uses", F.lit(0)).alias("uses"))
    parts = lambda n: F.greatest(F.ceil(n / side), F.lit(1)).cast("long")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("used").alias("used"))
    langs = langs.join(sizes, "lang", "left").select(
        "lang",
        (F.coalesce("used", F.lit(0)) + 2 * F.coalesce("terms", F.lit(0))).alias("lang_whole"),
        F.coalesce("terms", F.lit(0)).alias("terms"),
        parts(F.col("sources")).alias("bands"),
        parts(F.coalesce("terms", F.lit(0))).alias("strips"),
    )
    langs = saved(langs, "term-languages")
    strip_sizes = kept.join(langs, "lang").groupBy("lang", _dealt("term", "strips").alias("strip")).agg(F.count("*").alias("columns"))
    each_strip = langs.select("lang", F.explode(F.sequence(F.lit(0), (F.col("strips") - 1).cast("int"))).alias("strip"))
    strips = each_strip.join(strip_sizes, ["lang", "strip"], "left")
    strips = saved(strips.select("lang", "strip", F.coalesce("columns", F.lit(0)).alias("columns")), "term-strips")

    in_tile = cells.join(langs, "lang").select(
        "lang", "source", "term", "n", "used", "lang_whole", F.lit(0).cast("long").alias("whole"),
        "bands", _dealt("term", "strips").alias("strip"), _dealt("source", "bands").alias("band"),
    )
    # every strip has the rows of all sources: a source without cells there has counts of zero
    rows = groups.join(langs, "lang").join(each_strip, "lang").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("used"), "lang_whole", (F.col("uses") + 2 * F.col("terms")).alias("whole"),
        "bands", "strip", _dealt("source", "bands").alias("band"),
    )
    with_columns = in_tile.unionByName(rows).join(strips, ["lang", "strip"])
    other = F.explode(F.sequence(F.lit(0), (F.col("bands") - 1).cast("int"))).alias("other")
    met = with_columns.select("*", other).select(
        "lang", "strip", F.least("band", "other").alias("low"), F.greatest("band", "other").alias("high"),
        "band", "source", "term", "n", "used", "lang_whole", "whole", "columns",
    )
    return met.groupBy("lang", "strip", "low", "high").applyInPandas(_tile_values(top), PARTIAL)


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, side: int = SIDE) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources, and the ``top`` terms of each source."""
    counts = saved(term_counts(docs), "term-counts")
    found = saved(partial_values(counts, least_docs, top, side), "tile-values")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = saved(pairs, "source-pairs")
    both = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    order = ["lang", "source", "part", "item", "value", "rank"]
    by_pair = both.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(ranked))
    by_term = found.filter("part = 'term'").withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return by_pair.select(*order).unionByName(by_term.select(*order))
