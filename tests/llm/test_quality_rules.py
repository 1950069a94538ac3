import numpy as np
import pyarrow as pa

from clickflow.llm import quality_rules as Q
from clickflow.llm.common import documents
from tests.llm import brute
from tests.llm.conftest import SF01


def check(df, rows):
    texts = dict(rows)
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        mine = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert mine == brute.quality(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


def test_report_matches_brute_force(spark, frame, odd_rows):
    docs = documents(spark, SF01)
    check(Q.quality_report(docs), [(r.doc_id, r.text) for r in docs.collect()])
    check(Q.quality_report(frame(odd_rows)), odd_rows)


def test_order_changes_work_and_not_verdicts(frame, odd_rows):
    column = pa.array([t or "" for _, t in odd_rows])
    rules = Q.default_rules()
    first = Q.run_cascade(column, rules)
    for k in range(len(rules)):
        assert (Q.run_cascade(column, rules[k:] + rules[:k][::-1]) == first).all()
    told = Q.estimate(frame(odd_rows), rules)
    assert {r["rule"] for r in told} == {r.name for r in rules}
    order = Q.cascade_order(told, rules)
    rate = {r["rule"]: r["rejected"] / r["seconds"] for r in told}
    assert [rate[r.name] for r in order] == sorted(rate.values(), reverse=True)


def test_later_rules_see_only_what_is_left():
    seen = []

    def spy(c):
        seen.append(len(c.n_words))
        return c.n_words < 0

    column = pa.array(["a", "b c", "word " * 60])
    kept = Q.run_cascade(column, [Q.base_rules()[0], Q.Rule("spy", spy)])
    assert seen == [1] and kept.tolist() == [False, False, True]


def test_labelled_documents(spark):
    """Held against labels: nearly all clean documents of 50 words or more stay, junk goes."""
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = {r.doc_id: r for r in Q.quality_report(documents(spark, SF01)).collect()}
    clean = [got[d] for d, x in labels.items() if x.quality == 1 and not got[d].base_failed]
    junk = [got[d] for d, x in labels.items() if x.quality == 0]
    assert np.mean([r.kept for r in clean]) > 0.99
    assert np.mean([not r.kept for r in junk]) > 0.9


def test_passing_keeps_whole_rows(spark, frame, odd_rows, no_id_rows):
    docs = frame(odd_rows)
    kept = Q.passing(docs)
    assert kept.schema == docs.schema
    want = {r.doc_id for r in Q.quality_report(docs).collect() if r.kept}
    assert {r.doc_id: r.text for r in kept.collect()} == {d: t for d, t in odd_rows if d in want}
    assert Q.passing(frame(no_id_rows)).count() == 5
    assert Q.passing(frame([])).count() == 0 and Q.quality_report(frame([])).collect() == []
