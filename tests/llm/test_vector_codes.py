import hashlib
import math
import random

import numpy as np
import pytest

from clickflow.llm import vector_codes as V
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<double>, label int, code string, q int, n int, x int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", 1, 2, 3) for i, v, label in rows], SCHEMA)


def _vectors(n, size=16, spread=1.0, seed=1):
    r = random.Random(seed)
    centres = [[r.gauss(0, spread) for _ in range(size)] for _ in range(20)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i * 3 % n, [x + r.gauss(0, spread / 5) for x in c], None if i % 3 == 0 else i % 2))
    return rows


def _check(got, rows, **how):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [(i, [math.floor(x * 4096) for x in v]) for i, v, _ in order]
    codes, errors, books = brute.lloyd(ints, **how)
    sums = {}
    for (_, _, label), e in zip(order, errors):
        sums[label] = sums.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    want = [(i, c, e, sums[label], sha) for (i, _, label), c, e in zip(order, codes, errors)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("n", [300, 16, 5, 1])
def test_matches_plain_lloyd(spark, n):
    rows = _vectors(n)
    _check(V.vector_codes(_frame(spark, rows)).collect(), rows)


def test_other_parameters(spark):
    rows = _vectors(120, size=12)
    got = V.vector_codes(_frame(spark, rows).repartition(3), parts=3, entries=5, rounds=20)
    _check(got.collect(), rows, parts=3, entries=5, rounds=20)


def test_ties_go_to_the_lower_index(spark):
    """Components of few values: many equal distances, equal entries and repeated rows."""
    r = random.Random(9)
    rows = [(i // 2, [r.choice((0.0, 1.0, -1.0)) / 4096 for _ in range(16)], 1) for i in range(200)]
    rows += rows[:40]
    _check(V.vector_codes(_frame(spark, rows)).collect(), rows)


def test_large_components_are_exact(spark):
    rows = _vectors(60, spread=1e3) + [(1000 + i, [(-1.0) ** j * 3e4 * i for j in range(16)], 7) for i in range(6)]
    _check(V.vector_codes(_frame(spark, rows)).collect(), rows)


def test_components_beyond_the_bound(spark):
    rows = _vectors(31) + [(500, [1e300, -1e300] * 8, 3), (501, [0.0] * 16, 3)]
    got = {r.vec_id: r for r in V.vector_codes(_frame(spark, rows)).collect()}
    assert len(got) == 33 and all(len(r.code) == 16 for r in got.values())
    assert all(r.label_error is None for r in got.values() if r.error is None)


def test_dropped_rows_null_ids_and_empty_table(spark):
    rows = [(i, v, label) for i, v, label in _vectors(40)]
    odd = [(-1, None, 0), (-2, [1.0, None] * 8, 0), (-3, [float("nan")] * 16, 0), (-4, [float("inf")] * 16, 0)]
    odd += [(-5, [], 0), (-6, [1.0] * 7, 0), (900, [1.0] * 24, 0)]
    nameless = [(None, [0.25] * 16, None), (None, [0.125] * 16, None)]
    got = V.vector_codes(_frame(spark, rows + odd + nameless)).collect()
    _check(got, rows + nameless)
    assert V.vector_codes(_frame(spark, odd[:6])).collect() == []
    assert V.vector_codes(_frame(spark, [])).collect() == []


def test_fixed_pieces_meet_moved_entries_only(monkeypatch):
    r = np.random.default_rng(3)
    x, entries = r.integers(-50, 50, (200, 4)), r.integers(-50, 50, (16, 4))
    nobody = np.full(200, -1, np.int64)
    code, dist = V.assign(x, np.zeros(200, np.int64), nobody, entries, np.ones(16, bool))
    moved = np.zeros(16, bool)
    moved[[2, 9]] = True
    entries[moved] += r.integers(-30, 30, (2, 4))
    asked = []
    monkeypatch.setattr(V, "distances", lambda a, b, f=V.distances: asked.append((len(a), len(b))) or f(a, b))
    new_code, new_dist = V.assign(x, code, dist, entries, moved)
    every = ((x[:, None] - entries) ** 2).sum(2)
    assert (new_code == every.argmin(1)).all() and (new_dist == every.min(1)).all()
    stale = int(moved[code].sum())
    assert asked == [(stale, 16), (200 - stale, 2)]
