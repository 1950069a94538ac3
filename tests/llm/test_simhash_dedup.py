import random

from clickflow.llm import simhash_dedup as S
from clickflow.llm.common import documents
from tests.llm import brute
from tests.llm.conftest import SF01

WHOLE = (1 << 64) - 1


def test_matches_brute_force(spark, frame, odd_rows):
    docs = documents(spark, SF01)
    for df, rows in ((frame(odd_rows), odd_rows), (docs, [(r.doc_id, r.text) for r in docs.collect()])):
        prints = {doc: brute.fingerprint(text) for doc, text in rows}
        got = S.simhash_dedup(df).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.fingerprint for r in got} == {doc: f"{fp:016x}" for doc, fp in prints.items()}
        assert {r.doc_id: r.component_id for r in got} == brute.linked(prints)


def test_shingle_hashes_are_those_of_spark(spark):
    """One shingle a text, so its fingerprint is its hash."""
    texts = ["one two", "ä b é", "x ", "y\tz\n\U0001f600", "w" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashes = df.selectExpr("doc_id", "lower(hex(xxhash64(array_join(split(trim(text), '[\\\\x20\\\\x09\\\\x0A]+'), ' '))))")
    assert {r.doc_id: r.fingerprint for r in S.simhash_dedup(df).collect()} == {a: b.zfill(16) for a, b in hashes.collect()}


def test_long_text_is_read_in_slices(frame, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 7)
    r = random.Random(3)
    rows = [(i, " ".join(r.choice("abcd") * r.randint(1, 3) for _ in range(n))) for i, n in enumerate((50, 0, 1, 30, 2, 9))]
    import pyarrow as pa

    got = S.fingerprints(pa.array([t for _, t in rows]))
    assert got.tolist() == [brute.fingerprint(t) for _, t in rows]


def _joined(spark, prints, **how):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    links = S.links(df, **how).collect()
    for link in links:
        x, y = root(link.u & WHOLE), root(link.v & WHOLE)
        parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}, links


def test_hot_keys_are_split_and_lose_no_link(spark):
    """Fingerprints around one template share their keys; lists stay short and no pairs are returned."""
    r = random.Random(1)
    base = r.getrandbits(64)
    prints = {r.getrandbits(64) for _ in range(100)}
    for _ in range(900):
        x = base
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randint(0, 63)
        prints.add(x)
    want = brute.linked({p: p for p in prints})
    for how in ({}, {"small": 4}, {"small": 4, "hot_share": 16}):
        got, links = _joined(spark, prints, **how)
        assert got == want
        assert len(links) <= 28 * len(prints)


def test_every_finer_key_leaves_eight_bits():
    for coarse in S.COARSE:
        masks = S.finer(coarse)
        assert len(set(masks)) == 28 and all(m & coarse == coarse and m.bit_count() == 56 for m in masks)


def test_null_ids_repeated_rows_and_empty_tables(frame, no_id_rows):
    got = S.simhash_dedup(frame(no_id_rows)).collect()
    assert len(got) == len(no_id_rows)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {None}
    both = [r.component_id for r in got if r.fingerprint == f"{brute.fingerprint(no_id_rows[0][1]):016x}"]
    assert both == [5] * 4
    assert S.simhash_dedup(frame([])).collect() == []
