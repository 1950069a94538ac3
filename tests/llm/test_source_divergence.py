import random
import re

import numpy as np
import pytest

from clickflow.llm import source_divergence as S
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, used int, band int, part string"


def _frame(spark, rows):
    return spark.createDataFrame([(1, t, lang, s, "x", 1, 2, 3, "y") for lang, s, t in rows], SCHEMA)


def _rows(sources=23, docs=400, words=90, seed=4):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 5))) for _ in range(words)]
    out = []
    for i in range(docs):
        source = f"s{min(r.randrange(sources), r.randrange(sources))}"
        own = vocabulary[len(source) + int(source[1:]) % 5 :: 3]
        text = " ".join(r.choice(r.choice((vocabulary, own))) for _ in range(r.randint(0, 30)))
        out.append(("en" if i % 3 else "fr", source, text.title() if i % 5 else text))
    out += [("de", "only", "wort"), ("it", "a", "x"), ("it", "b", None), ("en", "bare", ""), (None, None, None)]
    out += [(None, "s1", " ".join(["Tie tie"] * 3) + f" w{i % 2} \U0001f600 1_2") for i in range(24)]
    return out + out[:30]  # repeated rows


@pytest.mark.parametrize("side", [512, 8, 3])
def test_matches_brute_force(spark, side):
    rows = _rows()
    got = S.source_divergence(_frame(spark, rows), side=side).collect()
    assert sorted(tuple(r) for r in got) == brute.divergence(rows)


def test_no_kept_terms_and_empty_table(spark):
    rows = [("it", "a", "uno due"), ("it", "b", None), ("it", "b", "tre")]
    got = sorted(tuple(r) for r in S.source_divergence(_frame(spark, rows)).collect())
    assert got == [("it", "a", "pair", "b", 0, 1), ("it", "b", "pair", "a", 0, 1)]
    assert S.source_divergence(_frame(spark, [])).collect() == []


def test_long_texts_are_read_in_windows(monkeypatch):
    text = "Alpha beta, gammaÉ1delta\u00a0\u2003x " * 50 + "x" * 200 + " end"
    whole = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(brute.LOWER))
    for window in (1, 7, 64):
        monkeypatch.setattr(S, "WINDOW", window)
        assert [t.decode() for part in S.terms(text.encode()) for t in part] == whole
    assert list(S.terms(b"")) == []


def test_shares_are_exact_for_large_counts():
    n = np.array([0, 5, 10**15, 3 * 10**16], np.int64)
    whole = np.array([7, 11, 10**16 + 3, 3 * 10**16 + 2], np.int64)
    want = [1 + 10**9 * (int(a) + 2) // int(b) for a, b in zip(n, whole)]
    assert S.share(n, whole).tolist() == want


def test_quadtree_prices_empty_quadrants_without_entering_them(monkeypatch):
    """A sparse tile: few leaves are priced cell by cell, and sums equal those over all cells."""
    r = np.random.default_rng(2)
    rows, columns, height = 40, 300, 6
    cells = np.unique(r.integers(0, rows * columns, 60))
    row, col = cells // columns, cells % columns
    n = r.integers(1, 9, len(cells))
    dense = np.zeros((rows, columns), np.int64)
    dense[row, col] = n
    whole = dense.sum(1) + 2 * columns
    tree = S.Quadtree(row, col, n, height)
    priced = []
    monkeypatch.setattr(S, "price", lambda p, q, f=S.price: priced.append(np.broadcast(p, q).size) or f(p, q))
    got = S.joint_sums(tree, tree, whole, whole, columns, height, True)
    p = S.share(dense, whole[:, None])
    gap, both = p[:, None] - p, p[:, None] + p
    upper = np.triu_indices(rows, 1)
    assert (got[upper] == (gap * gap // both).sum(-1)[upper]).all()
    # 60 cells lie in at most 60 leaves, each met by the at most 5 blocks of rows of the other side
    assert sum(priced) < 60 * 5 * 2 * S.LEAF**3 + rows * rows < rows * rows * columns
