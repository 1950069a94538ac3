import random

import numpy as np
import pyarrow as pa
import pytest

from clickflow.llm import ngram_join as J
from clickflow.llm.common import documents
from clickflow.llm.components import components
from tests.llm import brute
from tests.llm.conftest import SF01


def rows_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_documents_match_brute_force(spark, frame, odd_rows):
    docs = documents(spark, SF01)
    assert rows_of(J.ngram_components(docs)) == brute.near([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(J.ngram_components(frame(odd_rows))) == brute.near(odd_rows)


@pytest.mark.parametrize("seed", range(3))
def test_pairs_around_the_limit(frame, seed):
    """Texts of all small sizes with a few words changed: similarities from 0.6 to 1."""
    r = random.Random(seed)
    rows = []
    for n in list(range(1, 40)) + [60, 100, 200]:
        base = [f"w{n}x{i}" for i in range(n)]
        for _ in range(5):
            words = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                i = r.randrange(len(words))
                r.choice([lambda: words.insert(i, "new"), lambda: words.pop(i), lambda: words.__setitem__(i, "odd")])()
                words = words or ["left"]
            rows.append((len(rows), " ".join(words)))
    boiler = " ".join(f"common{i}" for i in range(60))
    rows += [(len(rows) + i, boiler + " " + " ".join(f"own{i}y{j}" for j in range(70))) for i in range(60)]
    assert rows_of(J.ngram_components(frame(rows))) == brute.near(rows)


@pytest.mark.parametrize("per_block", [1 << 17, 600])
def test_loose_copies_of_one_text(frame, monkeypatch, per_block):
    """Copies with up to eight changed words: some link to each other only through a few others."""
    monkeypatch.setattr(J, "SHINGLES_PER_BLOCK", per_block)
    r = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in r.sample(range(150), r.randint(1, 8)):
            words[at] = f"x{r.randint(0, 60)}"
        rows.append((i, " ".join(words)))
    want = brute.near(rows)
    assert 1 < len({c for _, c in want.values()}) < 120
    assert rows_of(J.ngram_components(frame(rows))) == want


def test_common_counts():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 300, n).astype(np.uint64)) for n in (0, 1, 50, 200, 250)]
    want = [[len(np.intersect1d(a, b)) for b in sets[1:]] for a in sets]
    assert J.common_counts(sets, sets[1:]).tolist() == want


def test_every_linked_pair_shares_a_kept_signature():
    """The bound itself: change as many shingles as a link allows, and look at the segments."""
    r = np.random.default_rng(4)
    for n in [1, 2, 3, 4, 5, 6, 8, 9, 12, 13, 18, 19, 27, 50, 100, 333, 1000]:
        for _ in range(20):
            a = np.unique(r.integers(0, 1 << 62, n, dtype=np.uint64))
            b = a.copy()
            m = int(r.integers(int(n * 0.8), int(n / 0.8) + 1))
            keep = -(-80 * (len(a) + m) // 180)
            if keep > min(len(a), m) or m < 1:
                continue
            b = np.concatenate([r.permutation(a)[:keep], r.integers(0, 1 << 62, m - keep, dtype=np.uint64)])
            hashes, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            bands = J.band_of(np.diff(at))
            k = bands.min()
            assert bands.max() <= k + 1 and (bands == k).any()
            if bands.max() > k:
                assert np.diff(at).max() <= J.REACH[k]
            sig, entry = J.signatures(hashes, at, np.array([0, 1]), np.array([k, k]))
            both = set(sig[entry == 0].tolist()) & set(sig[entry == 1].tolist())
            spare = max(int(J.can_leave_out(len(x), k)) for x in (a, b))
            assert len(both) > spare


def test_one_deletion_is_used_where_it_is_cheaper():
    assert set(J.THRESHOLD.tolist()) == {0, 1}
    assert (J.SEGMENTS[J.THRESHOLD == 0] > J.most_difference(J.EDGES[1:] - 1, J.REACH)[J.THRESHOLD == 0]).all()
    assert (2 * J.SEGMENTS > J.most_difference(J.EDGES[1:] - 1, J.REACH)).all()


def test_sql_and_python_leave_out_alike(spark):
    sizes = [int(x) for x in np.unique(np.geomspace(1, 10**6, 300).astype(int))]
    rows = []
    for n in sizes:
        k = int(J.band_of(np.array([n]))[0])
        rows += [(n, k)] + ([(n, k - 1)] if k and n <= J.REACH[k - 1] else [])
    df = spark.createDataFrame(rows, "n long, scheme int").select("n", "scheme", J._can_leave_out_sql().alias("spare"))
    for r in df.collect():
        assert r.spare == int(J.can_leave_out(np.int64(r.n), r.scheme))


def test_sets_are_those_of_the_contract():
    texts = ["", " ", "a", "A b", "a B c d e f", "x " * 20, "é É ß"]
    hashes, at = J.shingle_sets(pa.array(texts))
    assert np.diff(at).tolist() == [len(brute.shingles(t)) for t in texts]
    keys = J.set_keys(*J.shingle_sets(pa.array(["A B", "a b", "a b ", "b a"])))
    assert keys[0] == keys[1] == keys[2] != keys[3]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_null_ids_repeated_rows_and_empty_tables(frame, no_id_rows):
    got = J.ngram_components(frame(no_id_rows)).collect()
    assert len(got) == len(no_id_rows)
    linked = [r for r in got if r.n_shingles >= 50]
    assert all(r.component_id == 5 for r in linked) and len(linked) == 5
    assert J.ngram_components(frame([])).collect() == []


def test_one_per_component_keeps_whole_rows(frame, odd_rows, no_id_rows):
    docs = frame(odd_rows)
    kept = J.one_per_component(docs)
    assert kept.schema == docs.schema
    want = {d for d, (_, c) in brute.near(odd_rows).items() if d == c}
    assert {r.doc_id: r.text for r in kept.collect()} == {d: t for d, t in odd_rows if d in want}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in J.one_per_component(frame(no_id_rows)).collect()) == [
        (False, 5), (False, 5), (True, 0),
    ]
    assert J.one_per_component(frame([])).count() == 0
