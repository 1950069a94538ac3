from collections import Counter

import corpus_pipeline as C
from clickflow.llm import domain_mixing, quality_rules
from clickflow.llm.common import documents
from tests.llm import brute
from tests.llm.conftest import SF01
from tests.llm.test_best_fit_packing import check_pieces


def test_each_stage_against_brute_force(spark):
    docs = documents(spark, SF01)
    names = [n for n, _ in C.STAGES]
    assert len(names) == 5 and C.ORACLE_SQL is None
    columns, states = docs.columns, [docs]
    for _, stage in C.STAGES:
        states.append(C.saved(stage(spark, states[-1], SF01), "stage"))
    for s in states[1:-1]:
        assert s.columns == columns and s.schema == docs.schema
    rows = [[(r.doc_id, r.text) for r in s.collect()] for s in states[:-1]]
    rules = {r.doc_id for r in quality_rules.quality_report(docs).collect() if r.kept}
    assert {d for d, _ in rows[1]} == rules
    assert {d for d, _ in rows[2]} == {d for d, v in brute.exact(rows[1]).items() if v[2]}
    assert {d for d, _ in rows[3]} == {d for d, (_, c) in brute.near(rows[2]).items() if d == c}
    assert set(rows[4]) <= set(rows[3]) and len(rows[4]) > 0.8 * len(rows[3])
    check_pieces(states[5].withColumnRenamed("start", "start_at"), rows[4])


def test_run_applies_all_stages(spark):
    out = C.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


def test_stages_on_an_empty_table(spark, frame, odd_rows):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    assert domain_mixing.mixed_documents(frame([]), labels).count() == 0
    docs = frame([])
    for _, stage in C.STAGES:
        docs = C.saved(stage(spark, docs, SF01), "stage")
    assert docs.count() == 0


def test_stages_on_odd_rows(spark, frame, odd_rows, no_id_rows):
    """Null ids and texts, repeated rows, ties, a very long text and clashing column names, through every stage in turn."""
    long = [(r + 500, (t or "") + " " + " ".join(f"w{i % 97}x{r}" for i in range(80))) for r, t in odd_rows]
    docs = frame(odd_rows + no_id_rows + long + long[3:6] + [(None, long[4][1])])
    schema, before = docs.schema, Counter(map(str, docs.collect()))
    for name, stage in C.STAGES[:-1]:
        docs = C.saved(stage(spark, docs, SF01), "odd-stage")
        assert docs.schema.names == schema.names, name
        after = Counter(map(str, docs.collect()))
        assert not after - before, name  # whole rows of the predecessor, none more often
        assert after, name
        if name == "exact dedup":
            texts = ["".join((r.text or "").split()) for r in docs.collect()]
            assert len(set(texts)) == len(texts)
        before = after
    pieces = C.saved(C.STAGES[-1][1](spark, docs, SF01), "odd-pieces").collect()
    assert sum(r.piece == 0 for r in pieces) == docs.count()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
