import numpy as np
import pytest

from clickflow.llm import exact_dedup as X
from clickflow.llm.common import documents
from tests.llm import brute
from tests.llm.conftest import SF01


def rows_of(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_matches_brute_force(spark, frame, odd_rows):
    got = X.exact_dedup(frame(odd_rows))
    assert rows_of(got) == brute.exact(odd_rows)
    docs = documents(spark, SF01)
    assert rows_of(X.exact_dedup(docs)) == brute.exact([(r.doc_id, r.text) for r in docs.collect()])


def test_history_members_are_dropped_and_the_rest_grouped(frame, odd_rows):
    history = X.build_index(X.fold(X.digests(frame(odd_rows))))
    new = [(100, odd_rows[3][1]), (101, "brand new"), (102, "brandnew"), (103, ""), (104, "more")]
    got = {r.doc_id: r for r in X.exact_dedup(frame(new), history).collect()}
    assert (got[100].keep_id, got[100].kept, got[100].in_history) == (5, False, True)  # the longest original of the group
    assert (got[103].keep_id, got[103].group_size, got[103].in_history) == (2, 3, True)
    assert (got[101].keep_id, got[101].kept, got[101].group_size, got[101].in_history) == (101, True, 2, False)
    assert not got[102].kept and got[104].kept


def test_perfect_hash_is_minimal_and_checked_by_bytes():
    r = np.random.default_rng(1)
    keys = r.integers(0, 1 << 63, (5000, 4), dtype=np.uint64)
    levels, number = X.build_levels(keys)
    assert sorted(number) == list(range(5000))
    assert (X.slot_numbers(levels, keys) == number).all()
    other = r.integers(0, 1 << 63, (100, 4), dtype=np.uint64)
    slot = X.slot_numbers(levels, other)
    assert ((slot >= -1) & (slot < 5000)).all()


def test_hot_group_is_dealt_over_salts(frame, monkeypatch):
    monkeypatch.setattr(X, "ROWS_PER_LOOKUP", 8)
    monkeypatch.setattr(X, "DIGESTS_PER_PART", 4)
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(120)]
    assert rows_of(X.exact_dedup(frame(rows))) == brute.exact(rows)


def test_null_ids_repeated_rows_and_empty_tables(frame, no_id_rows):
    got = X.exact_dedup(frame(no_id_rows)).collect()
    assert len(got) == len(no_id_rows)
    kept = [r for r in got if r.kept]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 5), (False, 5), (True, 0), (True, 0)]
    assert X.exact_dedup(frame([])).collect() == []


def test_kept_documents_are_whole_rows(frame, odd_rows, no_id_rows):
    docs = frame(odd_rows)
    kept = X.kept_documents(docs)
    assert kept.schema == docs.schema
    want = {d for d, v in brute.exact(odd_rows).items() if v[2]}
    assert {r.doc_id: r.text for r in kept.collect()} == {d: t for d, t in odd_rows if d in want}
    assert X.kept_documents(frame(no_id_rows)).count() == 4
    assert X.kept_documents(frame([])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 65])
def test_small_tables_of_keys(n):
    keys = np.arange(4 * n, dtype=np.uint64).reshape(n, 4)
    levels, number = X.build_levels(keys)
    assert sorted(number) == list(range(n))


def test_extreme_and_null_ids_are_told_apart(frame):
    least, most = -(1 << 63), (1 << 63) - 1
    rows = [(least, "a b"), (None, "ab"), (most, "a  b"), (least, "x"), (None, "y"), (most - 1, "y"), (None, "z"), ((1 << 53) + 1, "w")]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in X.exact_dedup(frame(rows)).collect()), key=str)
    want = [(least, most, 3, False), (None, most, 3, False), (most, most, 3, True), (least, least, 1, True)]
    want += [(None, most - 1, 2, False), (most - 1, most - 1, 2, True), (None, None, 1, True), ((1 << 53) + 1, (1 << 53) + 1, 1, True)]
    assert got == sorted(want, key=str)


def test_copies_of_the_index_stay_in_proportion(spark, frame, monkeypatch):
    """Many distinct texts in one part: it goes to one task; a hot digest spreads its part."""
    monkeypatch.setattr(X, "ROWS_PER_LOOKUP", 8)
    monkeypatch.setattr(X, "MOST_PARTS", 1)
    for rows, fan in (([(i, f"text {i}") for i in range(300)], 1), ([(i, "hot") for i in range(300)], 38)):
        docs = frame(rows)
        index = X.build_index(X.fold(X.digests(docs)))
        assert [r.fan for r in index.select(X.fan_out().alias("fan")).collect()] == [fan]
        got = {r.doc_id: (r.keep_id, r.group_size) for r in X.exact_dedup(docs).collect()}
        assert got == {i: x[:2] for i, x in brute.exact(rows).items()}
