import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickflow.llm import balanced_shards as B
from clickflow.llm.common import documents
from tests.llm import brute
from tests.llm.conftest import SF01


def check(df, rows, shards=24):
    got = df.collect()
    assert len(got) == len(rows)
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots, where = defaultdict(list), defaultdict(set)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        where[r.size, r.text_crc32].add(r.shard)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert all(len(s) == 1 for s in where.values())  # equal texts stay together
    sums, groups = Counter(), Counter()
    for r in got:
        sums[r.shard] += r.size
        groups[r.size, r.text_crc32] += r.size
    return [sums[s] for s in range(shards)], groups


def test_near_equal_bytes_on_documents(spark):
    docs = documents(spark, SF01)
    sums, groups = check(B.balanced_shards(docs), [(r.doc_id, r.text) for r in docs.collect()])
    assert max(sums) - min(sums) <= max(64, min(groups.values()))


@pytest.mark.parametrize("per_block,fan", [(8192, 512), (16, 3)])
def test_tree_of_blocks(spark, frame, monkeypatch, per_block, fan):
    monkeypatch.setattr(B, "GROUPS_PER_BLOCK", per_block)
    monkeypatch.setattr(B, "FAN_IN", fan)
    monkeypatch.setattr(B, "ROWS_PER_CHUNK", 10)
    rows = [(i, "x" * (i * 37 % 400) + str(i // 2)) for i in range(400)]
    sums, _ = check(B.balanced_shards(frame(rows), 5), rows, 5)
    assert max(sums) - min(sums) <= 60


def test_odd_rows(frame, odd_rows, no_id_rows, monkeypatch):
    check(B.balanced_shards(frame(odd_rows)), odd_rows)
    check(B.balanced_shards(frame(no_id_rows)), no_id_rows)
    assert B.balanced_shards(frame([])).collect() == []


def test_differencing_beats_dealing_by_size():
    r = np.random.default_rng(3)
    sizes = r.integers(1, 10_000, 500)
    sums, went = B.difference(np.stack([np.append(s, np.zeros(7, np.int64)) for s in sizes]))
    again = np.zeros(8, np.int64)
    np.add.at(again, went[:, 0], sizes)
    assert (again == sums).all()
    greedy = [0] * 8
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += int(s)
    assert sums.max() - sums.min() < max(greedy) - min(greedy)


@pytest.mark.parametrize("shards", [2, 3, 8])
def test_differencing_equals_the_plain_method(shards):
    r = np.random.default_rng(shards)
    for n in (1, 2, 7, 60):
        sizes = [int(x) for x in r.integers(1, 50, n)]  # with ties
        sums, _ = B.difference(np.stack([np.append(s, np.zeros(shards - 1, np.int64)) for s in sizes]))
        assert sorted(sums.tolist()) == brute.differencing(sizes, shards)


def test_one_block_of_groups_is_the_plain_method(spark, frame):
    rows = [(i, "y" * (i * 53 % 701) + str(i)) for i in range(120)]
    sums, _ = check(B.balanced_shards(frame(rows), 4), rows, 4)
    spread = brute.differencing([len(t) + 8 for _, t in rows], 4)
    assert max(sums) - min(sums) <= max(spread) - min(spread) + 8
