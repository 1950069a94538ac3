import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import domain_mixing as M
from clickflow.llm.common import documents
from tests.llm.conftest import SF01

SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def mixed(spark):
    docs, labels = documents(spark, SF01), spark.read.parquet(f"{SF01}/labels.parquet")
    return M.mix_domains(docs, labels).cache(), M.label_domains(labels)


def test_rates_meet_the_targets(mixed):
    rows = mixed[0].collect()
    total = sum(r.n_tokens for r in rows)
    assert min(r.rate for r in rows) >= 0
    names = rows[0].posteriors.keys()
    weights = {d: M.TARGETS[d] for d in names}
    for d in names:
        got = sum(r.rate * r.n_tokens * r.posteriors[d] for r in rows)
        goal = total * weights[d] / sum(weights.values())
        assert abs(got - goal) <= 1.001 * M.CLOSE * goal
        assert abs(rows[0].reached_shares[d] - got / sum(r.rate * r.n_tokens for r in rows)) < 1e-6
    assert all(abs(sum(r.posteriors.values()) - 1) < 1e-9 for r in rows)


def test_held_out_accuracy(spark):
    docs, labels = documents(spark, SF1), spark.read.parquet(f"{SF1}/labels.parquet")
    domains = M.label_domains(labels)
    held = F.pmod(F.xxhash64("label_id"), F.lit(4)) == 0
    scored, names = M.score(docs, labels.filter(~(F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(4)) == 0)))
    best = F.array_max(F.array(*[F.struct(F.col(f"p{i}").alias("p"), F.lit(d).alias("d")) for i, d in enumerate(names)]))
    right = scored.join(domains.filter(held), F.col("doc_id") == F.col("label_id"))
    told = right.agg(F.avg((best["d"] == F.col("domain")).cast("double")), F.count("*")).first()
    assert told[1] > 500 and told[0] > 0.9


def test_plan_is_native(spark, frame, odd_rows):
    labels = spark.createDataFrame([(3, 1, 0), (11, 1, 0), (15, 0, 0), (16, 0, 0), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(odd_rows)
    out = M.mix_domains(docs, labels)
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert out.count() == len(odd_rows)
    assert {tuple(sorted(r.posteriors)) for r in out.collect()} == {("q0t0", "q1t0")}


def test_unreachable_and_missing_targets(spark, frame, odd_rows, no_id_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = M.mix_domains(frame(odd_rows), none).collect()
    assert {r.domain for r in out} == {"all"} and all(abs(r.rate - 1) < 1e-3 for r in out)
    labels = spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int")
    assert M.mix_domains(frame(no_id_rows), labels).count() == len(no_id_rows)
    assert M.mix_domains(frame([]), labels).collect() == []
    # a domain that should vanish: rates stay nonnegative and its share falls
    both = spark.createDataFrame([(3, 1, 0), (4, 1, 0), (15, 0, 0), (16, 0, 0)], "doc_id long, quality int, toxic int")
    rows = M.mix_domains(frame(odd_rows), both, {"q1t0": 1.0}).collect()
    assert min(r.rate for r in rows) >= 0
    junk = [r for r in rows if r.doc_id in (15, 16)]
    assert all(r.rate < 0.1 for r in junk)


def test_mixed_documents_keep_whole_rows_and_clean_ones(spark, frame, odd_rows):
    docs, labels = documents(spark, SF01), spark.read.parquet(f"{SF01}/labels.parquet")
    out = M.mixed_documents(docs, labels)
    assert out.schema == docs.schema
    kept = {r.doc_id for r in out.collect()}
    names = {r.label_id: r.domain for r in M.label_domains(labels).collect()}
    share = lambda d: sum(x in kept for x, n in names.items() if n == d) / sum(n == d for n in names.values())
    assert share("q1t0") > 0.95 and share("q1t1") < 0.6 and share("q0t0") < 0.6
    assert M.mixed_documents(frame([]), labels).count() == 0
    assert M.mixed_documents(frame(odd_rows), labels).columns == frame(odd_rows).columns


def _scored(spark, groups):
    """(how many, tokens, posteriors) -> a scored frame of that many documents each."""
    n = len(groups[0][2])
    rows = [(i, k * 10_000 + i, t, *p) for k, (many, t, p) in enumerate(groups) for i in range(many)]
    return spark.createDataFrame(rows, "doc_id long, version long, n_tokens long, " + ", ".join(f"p{i} double" for i in range(n))).coalesce(1).cache()


def _drawn(spark, frame, monkeypatch, groups, names):
    monkeypatch.setattr(M, "score", lambda docs, labels: (_scored(spark, groups), names))
    return M.draw_documents(frame([]), None)[1]


def test_the_draw_delivers_the_weights_it_reports(spark, frame, monkeypatch):
    names = ["q0t0", "q1t0", "q1t1"]
    # clean documents in excess of the targets: they stay, although the toxic ones can't reach theirs
    shares = _drawn(spark, frame, monkeypatch, [(3960, 100, (0.0, 1.0, 0.0)), (40, 100, (0.0, 0.0, 1.0))], names)
    assert shares["q1t0"] == 0.99 and shares["q1t1"] == 0.01 and shares["q0t0"] == 0.0
    # too few of them: they stay and the others are thinned to their weights
    groups = [(3000, 100, (0.0, 1.0, 0.0)), (1500, 100, (1.0, 0.0, 0.0)), (1500, 100, (0.0, 0.0, 1.0))]
    shares = _drawn(spark, frame, monkeypatch, groups, names)
    assert all(abs(shares[d] - w) < 0.006 for d, w in zip(names, M.weights(names, M.TARGETS)))


def test_mixing_stage_delivers_the_targets(spark, caplog):
    docs, labels = documents(spark, SF1), spark.read.parquet(f"{SF1}/labels.parquet")
    with caplog.at_level("WARNING", logger=M.__name__):
        M.mixed_documents(docs, labels)
    told = {p.split()[0]: float(p.split()[1]) for p in caplog.messages[-1].split(": ", 1)[1].split(", ")}
    assert all(abs(told[d] - w) < 0.1 * w + 0.001 for d, w in M.TARGETS.items())


def _plain_fit(groups, goal, steps):
    """Brute force: projected gradient with a fixed small step, document by document."""
    t = np.array([g[1] for g in groups for _ in range(g[0])], float)
    p = np.array([g[2] for g in groups for _ in range(g[0])])
    x, held = np.ones(len(t)), t @ p
    goal = np.array(goal) * t.sum()
    for _ in range(steps):
        x = np.maximum(0, x - p @ ((x * t) @ p - goal).__truediv__(held))
    return (x * t) @ p / ((x * t) @ p).sum()


def _overlapping(far):
    """Posteriors that overlap: the smaller domains have no document of their own."""
    r = random.Random(3)
    us = [0.4 + (far - 0.4) * r.random() for _ in range(400)] + [far] * 4
    return [(5, 50 + i % 60, (u, (1 - u) * 0.9, (1 - u) * 0.1)) for i, u in enumerate(us)]


def test_overlapping_domains_reach_small_targets(spark):
    names, targets = ["a", "b", "c"], {"a": 0.95, "b": 0.045, "c": 0.005}
    groups = _overlapping(0.999)
    rated, shares = M.fit_rates(_scored(spark, groups), names, targets)
    assert all(abs(shares[d] - w) <= 0.002 * w for d, w in targets.items())
    plain = _plain_fit(groups, [0.95, 0.045, 0.005], 6000)
    assert all(abs(shares[d] - x) <= 0.02 * x for d, x in zip(names, plain))
    assert rated.agg(F.min("rate")).first()[0] >= 0


def test_targets_out_of_reach_end_at_the_nearest_mix(spark):
    groups = _overlapping(0.9)
    rated, shares = M.fit_rates(_scored(spark, groups), ["a", "b", "c"], {"a": 0.99, "b": 0.009, "c": 0.001})
    assert 0.85 < shares["a"] <= 0.9 + 1e-9
    assert rated.agg(F.min("rate")).first()[0] >= 0
