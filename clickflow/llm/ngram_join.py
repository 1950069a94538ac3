"""Set similarity self-join on word shingles: partition the universe, look up segments, verify.

Sets are the distinct 5-word shingles of a text.  Two sets link when their Jaccard
similarity is 0.8 or more, which bounds the size of their symmetric difference:
|a ^ b| <= (|a| + |b|) / 9.

* Size bands: band k holds the sizes from edge k to the next edge, half as large again.
  Linked sets lie in one band or in two next to each other, so a set takes part in the scheme
  of its band and, if it is small enough for that, in the scheme of the band below.
* Universe partition: scheme k hashes every shingle to one of m segments.  With a difference
  of at most H, at least m - H segments of two linked sets are equal.  A segment's signature is
  the sum of its shingles' hashes, so a deletion's signature is a subtraction.
* Allocation by cost: a scheme either looks up whole segments (threshold 0, needs m > H) or
  segments with their one-deletion neighbourhoods (threshold 1, needs 2 m > H); the cheaper
  one by its number of signatures and of chance hits is taken.  Under threshold 0 a set of
  size s may leave out its m - H(s) - 1 costliest segments: those whose signatures the most
  sets hold, in one order for the whole corpus.  The cheapest equal segment of a linked
  pair is then left out by neither, since more than m - H - 1 equal ones are costlier.
  Empty segments and boilerplate go this way, without a cap on anything.
* Signatures travel in packed blobs, a blob per batch and bucket of the signature space, and equal
  sets of a batch once.  The number of buckets follows the bytes of the texts, so that a bucket, which one task holds
  whole, doesn't grow with them; there are as many as shuffle partitions at least.  A bucket returns the signatures that at least two different sets
  hold.  Equal sets are one class from then on.
* Verification is exact, on whole shingle sets.  First each class meets one other: of every
  signature the class that shares the largest part of its segments leads, and a class takes the
  leader of the most of its signatures.  What links is one component.  Pairs inside a
  component need no check, so a large group of copies costs a pair a copy.
* A signature may still join different components: loose copies, texts that share much of a
  common passage.  Their universe is partitioned as finely as it goes, a shingle to a segment.
  Linked sets have 80 of 100 shingles of either in common, so each may leave out all but the
  rarest fifth of its own.  Classes that share one of these are a family, and families of several
  components are verified in blocks: tasks of two blocks of bounded size count common
  shingles by a matrix product, and return one link for two components.  No pair is a row.

Words are stretches without white space; A-Z are lower-cased.  Shingles are known by 64-bit
hashes.

Defined results: a null text, and a text without words, has an empty set, links with nothing and
is its own component; fewer than five words make one shingle; repeated rows are one class;
a null doc_id takes part and gets its component's smallest id, which is null if there is none;
an empty table gives no rows; long texts are taken whole; further columns aren't read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm import textbytes as tb
from clickflow.llm.common import chunks_for, id_text, saved
from clickflow.llm.components import components
from clickflow.llm.textbytes import U64, mix

SHINGLE = 5
NUM, DEN = 80, 100
NO_ID = -(1 << 63)
LAST = (1 << 63) - 1
#: Text that a bucket of the signature space is for.
BYTES_PER_BUCKET = 8 << 20
BATCH_BYTES = 2 << 20
#: What a chance hit costs, in signatures sent.
HIT_COST = 16.0
#: Segments beyond the bound that a scheme has, as a share of it: room to leave costly ones out.
SPARE = 0.15
SHINGLES_PER_BLOCK = 1 << 17
MATRIX_COLUMNS = 4096


def _edges(most: int = 1 << 40) -> np.ndarray:
    edges = [1]
    while edges[-1] < most:
        edges.append(max(edges[-1] + 1, edges[-1] * 3 // 2))
    return np.array(edges, np.int64)


EDGES = _edges()


def most_difference(a, b):
    """The largest symmetric difference of linked sets of sizes a and b (or less)."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def _schemes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each band: segments, threshold, and the largest size that takes part from the band above."""
    last = EDGES[1:] - 1
    reach = last * DEN // NUM
    bound = most_difference(last, reach)
    exact = bound + 1 + np.ceil(SPARE * bound).astype(np.int64)
    near = bound // 2 + 1
    size = (EDGES[:-1] + last) / 2
    exact_cost = exact + HIT_COST * exact * np.exp(-size / exact)
    near_cost = near + size + HIT_COST * near * (1 + size / near) * np.exp(-size / near)
    threshold = (near_cost < exact_cost).astype(np.int64)
    return np.where(threshold == 1, near, exact), threshold, reach


SEGMENTS, THRESHOLD, REACH = _schemes()


def band_of(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, sizes, side="right") - 1


def can_leave_out(size, scheme):
    """How many of its costliest segments a set may leave out in a scheme."""
    top = EDGES[scheme + 1] - 1
    own = size <= top
    partner = np.where(own, size * DEN // NUM, top)
    spare = SEGMENTS[scheme] - most_difference(size, partner) - 1
    return np.where(THRESHOLD[scheme] == 1, 0, np.maximum(spare, 0))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, one after another, and where each text's begin."""
    buf, at = tb.packed(column)
    starts, ends = tb.word_bounds(buf, at)
    words = tb.range_hash(tb.prefix(buf, tb.LOWER_VALUES), starts, ends)
    first = np.searchsorted(starts, at)
    n_words = np.diff(first)
    row = np.repeat(np.arange(len(n_words)), n_words)
    grams = tb.shingle_hashes(words, SHINGLE)
    whole = row[: len(grams)] == row[len(row) - len(grams) :]
    hashes, owner = grams[whole], row[: len(grams)][whole]
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):  # the whole sequence is the one shingle
        value = np.zeros(len(short), U64)
        for i in range(SHINGLE - 1):
            has = n_words[short] > i
            value[has] = mix(value[has] * U64(0xC2B2AE3D27D4EB4F) + words[first[short[has]] + i] + U64(i + 1))
        hashes, owner = np.concatenate([hashes, value]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    _, once = np.unique(mix(hashes + owner.astype(U64) * U64(tb.BASE)), return_index=True)
    once.sort()
    return hashes[once], np.searchsorted(owner[once], np.arange(len(n_words) + 1))


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values by group, modulo 2**64."""
    low = np.bincount(group, (values & U64(0xFFFFFFFF)).astype(np.float64), n).astype(U64)
    high = np.bincount(group, (values >> U64(32)).astype(np.float64), n).astype(U64)
    return low + (high << U64(32))


def set_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit key for every set; equal sets have equal keys."""
    n = len(at) - 1
    sizes = np.diff(at)
    owner = np.repeat(np.arange(n), sizes)
    return mix(_sums(owner, mix(hashes ^ U64(0x5BF03635D0C7A3A1)), n) + sizes.astype(U64) * U64(tb.BASE)).view(np.int64)


def signatures(hashes: np.ndarray, at: np.ndarray, sets: np.ndarray, scheme: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the entries (set, scheme), and each one's entry."""
    sizes = np.diff(at)[sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    begin = np.cumsum(sizes) - sizes
    value = hashes[np.arange(len(owner)) + np.repeat(at[sets] - begin, sizes)]
    segments = SEGMENTS[scheme]
    base = np.cumsum(segments) - segments
    total = int(segments.sum())
    spot = mix(value ^ (scheme[owner].astype(U64) + U64(1)) * U64(0x9FB21C651E98DF25)) % segments[owner].astype(U64)
    cell = base[owner] + spot.astype(np.int64)
    part = mix(value * U64(0xA0761D6478BD642F) + U64(1))
    sums, counts = _sums(cell, part, total), np.bincount(cell, minlength=total)
    entry = np.repeat(np.arange(len(sets)), segments)
    place = (np.arange(total) - base[entry]).astype(U64) * U64(0xE7037ED1A0B428DB) + scheme[entry].astype(U64)

    def sign(sums, counts, place):
        return mix(mix(sums + counts.astype(U64) * U64(tb.BASE)) + place * U64(0x8EBC6AF09C88C6E3))

    found, entries = [sign(sums, counts, place)], [entry]
    near = THRESHOLD[scheme][owner] == 1
    if near.any():
        c = cell[near]
        found.append(sign(sums[c] - part[near], counts[c] - 1, place[c]))
        entries.append(owner[near])
    return np.concatenate(found), np.concatenate(entries)


def _six(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    eight = np.zeros((len(six), 8), np.uint8)
    eight[:, :6] = six
    return eight.view("<u8").ravel()


POSTED = pa.schema(
    [("bucket", pa.int32()), ("doc_id", pa.int64()), ("version", pa.int64()), ("n", pa.int64()), ("key", pa.int64())]
    + [(x, pa.binary()) for x in ("keys", "sizes", "schemes", "sigs", "entries")]
)
POSTED_SQL = (
    "bucket int, doc_id long, version long, n long, key long,"
    " keys binary, sizes binary, schemes binary, sigs binary, entries binary"
)
FOUND = pa.schema(
    [("kind", pa.int32()), ("doc_id", pa.int64()), ("version", pa.int64()), ("n", pa.int64()), ("key", pa.int64())]
    + [("scheme", pa.int32()), ("sig", pa.int64()), ("held", pa.int64())]
)
FOUND_SQL = "kind int, doc_id long, version long, n long, key long, scheme int, sig long, held long"


def _post(buckets: int):
    """Documents -> a row for each document, and packed signatures for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole, "text", BATCH_BYTES):
                hashes, at = shingle_sets(batch.column("text"))
                sizes, keys = np.diff(at), set_keys(hashes, at)
                none = pa.nulls(batch.num_rows, pa.binary())
                ids = batch.column("doc_id").fill_null(0).to_numpy().view(U64)  # not by class: one may hold most rows
                spread = (mix(ids) % U64(buckets)).astype(np.int32)
                own = pa.array(sizes), pa.array(keys, mask=sizes == 0)
                doc_rows = [pa.array(spread), batch.column("doc_id"), batch.column("version"), *own]
                yield pa.RecordBatch.from_arrays([*doc_rows, none, none, none, none, none], schema=POSTED)
                _, once = np.unique(keys, return_index=True)
                once = once[sizes[once] > 0]
                band = band_of(sizes[once])
                below = (band > 0) & (sizes[once] <= REACH[np.maximum(band - 1, 0)])
                sets = np.concatenate([once, once[below]])
                scheme = np.concatenate([band, band[below] - 1])
                if not len(sets):
                    continue
                sig, entry = signatures(hashes, at, sets, scheme)
                bucket = (sig % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                here_are, first = np.unique(bucket[order], return_index=True)
                rows: list[list] = [[] for _ in range(6)]
                for b, here in zip(here_are, np.split(order, first[1:])):
                    used, local = np.unique(entry[here], return_inverse=True)
                    blobs = (
                        keys[sets[used]].tobytes(),
                        sizes[sets[used]].tobytes(),
                        scheme[used].astype(np.int32).tobytes(),
                        _six(sig[here] // U64(buckets)),
                        local.astype(np.uint32).tobytes(),
                    )
                    for col, value in zip(rows, (int(b), *blobs)):
                        col.append(value)
                empty = pa.nulls(len(rows[0]), pa.int64())
                blob_cols = [pa.array(x, pa.binary()) for x in rows[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), empty, empty, empty, empty, *blob_cols], schema=POSTED)

    return run


def _shared(buckets: int):
    """One bucket: pass document rows on, and return the signatures that different sets share."""

    def run(table: pa.Table) -> pa.Table:
        docs = table.filter(pa.compute.is_null(table["sigs"]))
        n = docs.num_rows
        zero = pa.array(np.zeros(n, np.int32))
        doc_part = pa.Table.from_arrays(
            [zero, docs["doc_id"], docs["version"], docs["n"], docs["key"], zero, pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, np.int64))],
            schema=FOUND,
        )
        blobs = table.filter(pa.compute.is_valid(table["sigs"]))
        if not blobs.num_rows:
            return doc_part
        bucket = blobs["bucket"][0].as_py()
        sig, owner, keys, sizes, schemes, n_owners = [], [], [], [], [], 0
        for raw in zip(*(blobs[c].to_pylist() for c in ("keys", "sizes", "schemes", "sigs", "entries"))):
            keys.append(np.frombuffer(raw[0], np.int64))
            sizes.append(np.frombuffer(raw[1], np.int64))
            schemes.append(np.frombuffer(raw[2], np.int32))
            sig.append(_from_six(raw[3]))
            owner.append(np.frombuffer(raw[4], np.uint32).astype(np.int64) + n_owners)
            n_owners += len(keys[-1])
        sig, owner = np.concatenate(sig), np.concatenate(owner)
        keys, sizes, schemes = np.concatenate(keys), np.concatenate(sizes), np.concatenate(schemes)
        order = np.argsort(sig)
        sig, owner = sig[order], owner[order]
        same = sig[1:] == sig[:-1]
        twice = np.zeros(len(sig), bool)
        twice[1:] |= same
        twice[:-1] |= same
        sig, owner = sig[twice], owner[twice]
        order = np.lexsort((keys[owner], sig))
        sig, owner = sig[order], owner[order]
        key = keys[owner]
        new_sig = np.ones(len(sig), bool)
        new_sig[1:] = sig[1:] != sig[:-1]
        fresh = new_sig.copy()
        fresh[1:] |= key[1:] != key[:-1]  # a set counts once, however many batches sent it
        sig, owner, key, new_sig = sig[fresh], owner[fresh], key[fresh], new_sig[fresh]
        group = np.cumsum(new_sig) - 1
        held = np.bincount(group)[group] if len(group) else group
        many = held >= 2
        sig, owner, key, held = sig[many], owner[many], key[many], held[many]
        full = (sig * U64(buckets) + U64(bucket)).view(np.int64)
        shared = pa.Table.from_arrays(
            [
                pa.array(np.ones(len(sig), np.int32)),
                pa.nulls(len(sig), pa.int64()),
                pa.nulls(len(sig), pa.int64()),
                pa.array(sizes[owner]),
                pa.array(key),
                pa.array(schemes[owner]),
                pa.array(full),
                pa.array(held.astype(np.int64)),
            ],
            schema=FOUND,
        )
        return pa.concat_tables([doc_part, shared])

    return run


def postings(docs: DataFrame) -> DataFrame:
    """kind 0: doc_id, version (a hash of the text), n, key of every document.  kind 1: n, key, scheme, sig and held, the number of
    different sets that hold it, of every signature that more than one holds.  Written once."""
    texts = id_text(docs).withColumn("version", F.xxhash64("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, chunks_for(size, BYTES_PER_BUCKET))
    posted = texts.mapInArrow(_post(buckets), POSTED_SQL)
    return saved(posted.groupBy("bucket").applyInArrow(_shared(buckets), FOUND_SQL), "shingle-postings")


def kept_postings(found: DataFrame) -> DataFrame:
    """Signatures without those that each set may leave out: key, sig, and share, how many
    thousandths of the set's segments other sets hold too."""
    own = Window.partitionBy("key", "scheme")
    ranked = found.filter("kind = 1").select(
        "key",
        "sig",
        _can_leave_out_sql().alias("spare"),
        F.row_number().over(own.orderBy(F.col("held").desc(), "sig")).alias("nth"),
        (1000 * F.count("*").over(own) / _by_scheme(SEGMENTS)).cast("int").alias("share"),
    )
    return ranked.filter("nth > spare").select("key", "sig", "share")


def _by_scheme(values: np.ndarray):
    """A constant of the method, by the column scheme."""
    return F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("scheme") + 1)


def _can_leave_out_sql():
    """:func:`can_leave_out` for the columns n and scheme."""
    top, segments, threshold = (_by_scheme(x) for x in (EDGES[1:] - 1, SEGMENTS, THRESHOLD))
    partner = F.when(F.col("n") <= top, F.floor(F.col("n") * DEN / NUM)).otherwise(top)
    spare = segments - F.floor((F.col("n") + partner) * (DEN - NUM) / (DEN + NUM)) - 1
    return F.when(threshold == 1, F.lit(0)).otherwise(F.greatest(spare, F.lit(0)))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sorted shingle hashes of the wanted classes: wanted has key and doc_id (any of its documents)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tb.slices(whole, "text", BATCH_BYTES):
                hashes, at = shingle_sets(batch.column("text"))
                keys = set_keys(hashes, at)
                mine = np.flatnonzero(keys == batch.column("key").to_numpy())
                raw = [np.sort(hashes[at[i] : at[i + 1]]).astype("<u8").tobytes() for i in mine]
                yield pa.RecordBatch.from_arrays([pa.array(keys[mine]), pa.array(raw, pa.binary())], ["key", "hashes"])

    d = id_text(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
    w = wanted.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "key")
    texts = w.join(d, "doc_id").select("key", "text")
    return texts.mapInArrow(run, "key long, hashes binary").dropDuplicates(["key"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough, checked on whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                x, y = np.frombuffer(a.as_py(), "<u8"), np.frombuffer(b.as_py(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                links.append(DEN * both >= NUM * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(links, pa.bool_()))

    # the smaller class of a pair is the hub of many: its set goes out last, by a join that Spark can split
    first = pairs.join(sets.select(F.col("key").alias("v"), F.col("hashes").alias("b")), "v")
    both = first.join(sets.select(F.col("key").alias("u"), F.col("hashes").alias("a")), "u")
    size = lambda c: F.octet_length(c)
    near = (DEN * size("a") >= NUM * size("b")) & (DEN * size("b") >= NUM * size("a"))
    return both.filter(near).select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def rare_shingles(own: DataFrame) -> DataFrame:
    """For classes with their ``hashes``: shingle, key of the shingles that another of them has too and
    that the class may not leave out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = tb.packed(batch.column("hashes"))
            sizes = np.diff(at) // 8
            each = [pa.array(np.repeat(batch.column("key").to_numpy(), sizes)), pa.array(np.repeat(sizes, sizes))]
            each.append(pa.array(np.frombuffer(values.tobytes(), np.int64)))
            for start in range(0, len(each[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([x.slice(start, 1 << 16) for x in each], ["key", "n", "shingle"])

    shingles = saved(own.select("key", "hashes").mapInArrow(run, "key long, n long, shingle long"), "open-shingles")
    held = shingles.groupBy("shingle").agg(F.count("*").alias("held"))
    held = saved(held.filter("held > 1"), "held-shingles")
    costliest = Window.partitionBy("key").orderBy(F.col("held").desc(), "shingle")
    ranked = shingles.join(held, "shingle").withColumn("nth", F.row_number().over(costliest))
    return ranked.filter(F.col("nth") > F.ceil(F.col("n") * NUM / DEN) - 1).select("shingle", "key")


def families(rare: DataFrame) -> DataFrame:
    """key, family: classes that share rare shingles, directly or through others."""
    first = saved(rare.groupBy("shingle").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1"), "firsts")
    edges = rare.join(first, "shingle").select(F.col("key").alias("u"), F.col("first").alias("v"))
    found = components(edges, "families")
    alone = found.select(F.col("root").alias("node"), "root").distinct()
    return found.union(alone).select(F.col("node").alias("key"), F.col("root").alias("family"))


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``a`` has in common with each of ``b``."""
    every = np.concatenate([*a, *b])
    owner = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    _, column, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = counts > 1
    column, owner = (np.cumsum(shared) - 1)[column[shared[column]]], owner[shared[column]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, int(shared.sum()), MATRIX_COLUMNS):
        part = slice(*np.searchsorted(column, [start, start + MATRIX_COLUMNS]))
        cells = np.zeros((len(a) + len(b), MATRIX_COLUMNS), np.float32)
        cells[owner[part], column[part] - start] = 1
        out += cells[: len(a)] @ cells[len(a) :].T
    return out.astype(np.int64)


def _block_links(table: pa.Table) -> pa.Table:
    """Two blocks of a family: a link for each two components that have similar sets in them."""
    block = table["block"].to_numpy()
    root = table["root"].to_numpy()
    sets = [np.frombuffer(x, "<u8") for x in table["hashes"].to_pylist()]
    left = np.flatnonzero(block == table["low"][0].as_py())
    right = np.flatnonzero(block == table["high"][0].as_py())
    found = []
    if len(left) and len(right):
        sizes = np.array([len(x) for x in sets])
        both = common_counts([sets[i] for i in left], [sets[i] for i in right])
        total = sizes[left][:, None] + sizes[right] - both
        x, y = np.nonzero((DEN * both >= NUM * total) & (root[left][:, None] != root[right]))
        if len(x):
            ends = np.stack([root[left[x]], root[right[y]]], 1)
            found = np.unique(np.sort(ends, axis=1), axis=0)
    ends = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"u": pa.array(ends[:, 0]), "v": pa.array(ends[:, 1])})


def family_links(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Links (u, v) between components (roots) of the members that have similar sets."""
    own = saved(sets.join(members, "key"), "open-sets")
    found = families(saved(rare_shingles(own), "rare-shingles"))
    placed = own.join(found, "key").withColumn("n", F.octet_length("hashes") / 8)
    size = placed.groupBy("family").agg(
        F.min("root").alias("r0"), F.max("root").alias("r1"), F.ceil(F.sum("n") / SHINGLES_PER_BLOCK).cast("int").alias("blocks")
    )
    size = saved(size.filter("r0 < r1").select("family", "blocks"), "family-sizes")
    dealt = placed.join(size, "family").select(
        "family", "blocks", F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("block"), "root", "hashes"
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = dealt.select("family", "block", "root", "hashes", other).select(
        "family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "root", "hashes"
    )
    links = tasks.groupBy("family", "low", "high").applyInArrow(_block_links, "u long, v long")
    return saved(links.distinct(), "more-links")


def ngram_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, version, n, key of their class) and the component of each linked class (node, root)."""
    found = postings(docs)
    rows = found.filter("kind = 0").select("doc_id", "version", "n", "key")
    classes = rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    kept = saved(kept_postings(found), "kept-postings")
    lead = F.max(F.struct("share", "key"))["key"]
    leaders = kept.groupBy("sig").agg(lead.alias("leader"), F.count("*").alias("n")).filter("n > 1")
    leaders = saved(leaders.select("sig", "leader"), "leaders")
    met = kept.join(leaders, "sig")
    member = met.select("key").distinct()
    wanted = classes.join(member, "key", "left_semi")
    sets = saved(sets_of(docs, wanted), "shingle-sets")
    votes = met.filter("key != leader").groupBy("key", "leader").agg(F.count("*").alias("shared"))
    best = votes.groupBy("key").agg(F.max(F.struct(F.col("shared"), F.col("leader"))).alias("b"))
    pairs = best.select(F.col("key").alias("v"), F.col("b.leader").alias("u"))
    links = saved(verified(pairs, sets), "first-links")
    roots = components(links, "first-components")
    # the classes of signatures that still hold different components
    placed = kept.join(roots, kept["key"] == roots["node"], "left").select(
        "sig", "key", F.coalesce("root", "key").alias("root")
    )
    mixed = placed.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = saved(mixed.filter("low < high").select("sig"), "mixed-signatures")
    open_ = placed.join(mixed, "sig").select("key", "root").distinct()
    more = family_links(sets, saved(open_, "open-classes"))
    return rows, components(links.unionByName(more), "components")


def _labelled(docs: DataFrame) -> DataFrame:
    rows, roots = ngram_links(docs)
    return rows.join(roots, rows["key"] == roots["node"], "left").select(
        "doc_id", "version", "n", "key", F.coalesce("root", "key").alias("label")
    )


def ngram_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    labelled = _labelled(docs)
    names = labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    # written, so that the join has two plain shuffles, whose hot partitions Spark splits
    out = labelled.join(saved(names, "component-names"), "label", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, whole: of each component the one with the smallest doc_id
    (of equal ids one text, of repeated rows one); every text without words."""
    here = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.col("version"))
    labelled = _labelled(docs).select("label", here.alias("here"))
    first = labelled.filter("label is not null").groupBy("label").agg(F.min("here").alias("here")).select("here.*")
    wordless = labelled.filter("label is null").select("here.*").distinct()
    keep = first.union(wordless).withColumn("keep", F.lit(True))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs["doc_id"].cast("bigint"), F.lit(LAST)).alias("id"),
        F.xxhash64(text).alias("version"),
    )
    nth = F.row_number().over(Window.partitionBy("id", "version").orderBy(F.lit(0)))
    return rows.join(keep, ["id", "version"]).withColumn("nth", nth).filter("nth = 1").select("row.*")
