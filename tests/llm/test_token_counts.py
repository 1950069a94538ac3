from collections import Counter

import pytest

from clickflow.llm import token_counts as T
from clickflow.llm.common import documents
from clickflow.llm.tokens import slow_encoder
from tests.llm.conftest import SF001


def lengths_of(rows):
    slow = slow_encoder()
    return [len(slow.encode(t or "", add_special_tokens=False).ids) for _, t in rows]


def check(df, rows):
    lengths = lengths_of(rows)
    want = {}
    for n, k in Counter(lengths).items():
        reach = [x for x in lengths if x >= n]
        to = sum(x <= n for x in lengths)
        want[n] = (k, len(reach), sum(reach), sum(min(x, n) for x in lengths), to, sum(lengths))
    got = {
        r.n_tokens: (r.n_docs, r.docs_from, r.tokens_from, r.truncated_tokens, r.docs_to, r.total_tokens)
        for r in df.collect()
    }
    assert got == want


def test_report_matches_brute_force(spark, frame, odd_rows, no_id_rows, monkeypatch):
    monkeypatch.setattr(T, "LENGTHS_PER_BLOCK", 64)
    check(T.token_counts(frame(odd_rows)), odd_rows)
    check(T.token_counts(frame(no_id_rows)), no_id_rows)
    docs = documents(spark, SF001)
    check(T.token_counts(docs), [(r.doc_id, r.text) for r in docs.collect()])
    assert T.token_counts(frame([])).collect() == []


def test_limits_and_quantiles(frame, odd_rows):
    lengths = sorted(lengths_of(odd_rows))
    hist = T.histogram(T.document_lengths(frame(odd_rows)))
    for r in T.totals_at(hist, [0, 1, 100, 10**6]).collect():
        assert r.truncated_tokens == sum(min(x, r.limit) for x in lengths)
        assert r.docs_cut == sum(x > r.limit for x in lengths)
    got = {r.share: r.n_tokens for r in T.length_at_quantile(hist, [0.1, 0.5, 1.0]).collect()}
    for share, n in got.items():
        assert n == next(x for i, x in enumerate(lengths) if (i + 1) / len(lengths) >= share and x >= n)
        assert sum(x <= n for x in lengths) / len(lengths) >= share > sum(x < n for x in lengths) / len(lengths)


@pytest.mark.parametrize("text", ["", "a", "a b"])
def test_one_document(frame, text):
    check(T.token_counts(frame([(1, text)])), [(1, text)])
