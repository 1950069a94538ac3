"""Soft-membership mixing: rates for documents whose expected domain tokens match targets.

1. A classifier learns the domains from a labelled table.  Its features are densities of a text
   (symbols, capitals, exclamation marks, digits, repeated words) and the hits of one word list
   a domain, learned from a bounded sample of labelled documents (LEXICON_DOCS).  Means and
   variances of the features are aggregated over all labelled documents, which gives
   every document its posterior for each domain (Gaussian naive Bayes).
2. With posteriors p and token counts t, rates x >= 0 are fitted by projected gradient on
   sum_d (sum_i x_i t_i p_id - T_d)^2.  A step moves the rates along the posteriors and cuts them at zero.
   Its lengths are scaled by the curvature, the D x D sums of t p_d p_e over documents of positive
   rate, so domains that overlap don't slow it down; where the cut spoils such a step it is shortened, or
   a plain gradient step scaled by what the corpus holds of each domain is taken.  A step needs one aggregate of
   D + D (D + 1) / 2 sums over the documents; only these reach the driver.  Steps go on until each
   domain is within ``CLOSE`` of its own target, or none brings the sums nearer (a target out of reach); the shares
   that were reached are returned.

Everything is DataFrame expressions: no Python runs on the executors.  Tokens are words here
(stretches without white space), which built-in functions can count.

Defined results: a null or empty text has no tokens; its posteriors are those of its features,
and it moves no target; documents that repeat get equal rates; a null or unlabelled
doc_id is scored like any other; label rows with null labels or without a document are not used;
an id labelled twice counts twice; without any usable label there is one domain "all" and
every rate comes from its one target; an empty table gives no rows; further columns aren't read.
"""

from __future__ import annotations

import logging
import math
import re
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import SPACE_CLASS, saved

LOG = logging.getLogger(__name__)
LEXICON_DOCS = 4000
LEXICON_WORDS = 32
LEXICON_LEAST = 8
#: A word of a domain's list is in at least this share of its documents.
LEXICON_SHARE = 0.04
STEPS_PER_TABLE = 8
#: Of each domain's own target; of all tokens where that is zero.
CLOSE = 1e-3
CLOSE_TO_NONE = 1e-6
#: A step that lowers the error by less than this share is none.
LEAST_GAIN = 1e-3
LEAST_VARIANCE = 1e-4
#: Target weights of the domains (quality and toxicity of a label); those that occur are used.
TARGETS = {"q1t0": 0.95, "q0t0": 0.03, "q1t1": 0.015, "q0t1": 0.005}


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id, domain from the label columns."""
    name = F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))
    return labels.select(F.col("doc_id").cast("bigint").alias("label_id"), name.alias("domain")).dropna()


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), text.alias("text"))


def learn_lexicons(docs: DataFrame, domains: DataFrame, n_docs: int = LEXICON_DOCS) -> dict[str, list[str]]:
    """For each domain the words that mark it most, from at most ``n_docs`` labelled documents."""
    some = domains.orderBy(F.xxhash64("label_id", "domain")).limit(n_docs)
    # at most n_docs rows of an id and a short name
    marked = _texts(docs).join(F.broadcast(some), F.col("doc_id") == F.col("label_id"))
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]{3,})"), 1)))
    marked = saved(marked.select("doc_id", "domain", "text"), "lexicon-sample")
    sizes = {r["domain"]: r["n"] for r in marked.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return {d: [] for d in sizes}
    names, total = sorted(sizes), sum(sizes.values())
    seen = marked.select("domain", word.alias("word")).groupBy("word")
    counts = seen.agg(*[F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(names)])
    everywhere = reduce(lambda a, b: a + b, [F.col(f"n{i}") for i in range(len(names))])
    counts = saved(counts.filter(everywhere >= LEXICON_LEAST), "lexicon-counts")
    words = {}
    for i, d in enumerate(names):
        own = F.col(f"n{i}") / sizes[d]
        # as if one more document had it: a small rest proves little
        other = (everywhere - F.col(f"n{i}") + 1) / (total - sizes[d] + 2)
        best = counts.filter((F.col(f"n{i}") >= LEXICON_LEAST) & (own >= LEXICON_SHARE) & (own > 4 * other))
        words[d] = [r["word"] for r in best.orderBy((own - other).desc(), "word").limit(LEXICON_WORDS).collect()]
    return words


def features(docs: DataFrame, lexicons: dict[str, list[str]]) -> tuple[DataFrame, list[str]]:
    """doc_id, version (a hash of the text), n_tokens and the features f0, f1, ..."""
    d = _texts(docs)
    words = F.split("text", f"{SPACE_CLASS}+")
    d = d.select("doc_id", "text", F.filter(words, lambda w: w != "").alias("words"))
    n = F.greatest(F.size("words"), F.lit(1))
    per_word = [
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")) / n,
        F.regexp_count("text", F.lit(r"[A-Z]")) / n,
        F.regexp_count("text", F.lit(r"!")) / n,
        F.regexp_count("text", F.lit(r"[0-9]")) / n,
        F.lit(1.0) - F.size(F.array_distinct("words")) / n,
    ]
    for words_of in lexicons.values():
        if words_of:
            pattern = r"(?<![\p{L}])(?:" + "|".join(re.escape(w) for w in words_of) + r")(?![\p{L}])"
            per_word.append(F.lit(20.0) * F.regexp_count(F.lower("text"), F.lit(pattern)) / n)
    names = [f"f{i}" for i in range(len(per_word))]
    # log(1 + 10 x): rare signals count, heavy tails don't
    cols = [F.log1p(F.lit(10.0) * f).alias(name) for f, name in zip(per_word, names)]
    return d.select("doc_id", F.xxhash64("text").alias("version"), F.size("words").cast("long").alias("n_tokens"), *cols), names


def learn_domains(feats: DataFrame, names: list[str], domains: DataFrame) -> list[dict]:
    """One record per domain: how many labelled documents, and mean and variance of each feature."""
    labelled = feats.join(domains, F.col("doc_id") == F.col("label_id"))
    told = labelled.groupBy("domain").agg(
        F.count("*").alias("n"),
        *[F.avg(f).alias(f"m_{f}") for f in names],
        *[F.var_pop(f).alias(f"v_{f}") for f in names],
    )
    return sorted((r.asDict() for r in told.collect()), key=lambda r: r["domain"])  # one row per domain


def posteriors(model: list[dict], names: list[str]) -> list[Column]:
    """The posterior of each domain as an expression over the features."""
    if not model:
        return [F.lit(1.0)]
    total = sum(r["n"] for r in model)
    scores = []
    for r in model:
        score = F.lit(math.log(r["n"] / total))
        for f in names:
            v = max(r[f"v_{f}"], LEAST_VARIANCE)
            score = score - (F.col(f) - r[f"m_{f}"]) * (F.col(f) - r[f"m_{f}"]) / (2 * v) - 0.5 * math.log(v)
        scores.append(score)
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    weights = [F.exp(s - top) for s in scores]
    return [w / reduce(lambda a, b: a + b, weights) for w in weights]


def score(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """doc_id, version, n_tokens and one posterior p0, p1, ... for each of the returned domains; written once."""
    domains = label_domains(labels)
    feats, names = features(docs, learn_lexicons(docs, domains))
    feats = saved(feats, "domain-features")
    model = learn_domains(feats, names, domains)
    cols = [p.alias(f"p{i}") for i, p in enumerate(posteriors(model, names))]
    scored = saved(feats.select("doc_id", "version", "n_tokens", *cols), "domain-posteriors")
    return scored, [r["domain"] for r in model] or ["all"]


def domain_tokens(scored: DataFrame, n_domains: int, rate: Column | None = None) -> list[float]:
    """The expected tokens of each domain when every document is taken ``rate`` times (once if None)."""
    times = F.col("n_tokens").cast("double") * (F.lit(1.0) if rate is None else rate)
    row = scored.agg(*[F.coalesce(F.sum(times * F.col(f"p{i}")), F.lit(0.0)).alias(f"s{i}") for i in range(n_domains)]).first()
    return [float(x) for x in row]


def weights(names: list[str], targets: dict[str, float]) -> list[float]:
    """The target weights of the domains that occur, with sum 1; equal ones if none of them has a target."""
    wanted = [max(targets.get(d, 0.0), 0.0) for d in names]
    if not any(wanted):
        wanted = [1.0] * len(names)
    return [w / sum(wanted) for w in wanted]


def _measured(frame: DataFrame, n_domains: int, rate: Column) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at these rates, and the curvature over documents of positive rate."""
    ps = [F.col(f"p{i}") for i in range(n_domains)]
    t = F.col("n_tokens").cast("double")
    on = F.when(rate > 0, t).otherwise(F.lit(0.0))
    pairs = [(d, e) for d in range(n_domains) for e in range(d, n_domains)]
    sums = [t * rate * p for p in ps] + [on * ps[d] * ps[e] for d, e in pairs]
    row = frame.agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(f"s{i}") for i, x in enumerate(sums)]).first()
    curve = np.zeros((n_domains, n_domains))
    for (d, e), x in zip(pairs, row[n_domains:]):
        curve[d, e] = curve[e, d] = x
    return np.array(row[:n_domains], float), curve


def fit_rates(
    scored: DataFrame, names: list[str], targets: dict[str, float], total: float | None = None
) -> tuple[DataFrame, dict[str, float]]:
    """``scored`` with a column ``rate``: nonnegative, expected tokens of each domain near its target; and
    the share of the expected tokens that each domain reached.

    ``targets`` are weights, ``total`` the tokens to reach (all tokens of the corpus if None)."""
    n = len(names)
    ps = [F.col(f"p{i}") for i in range(n)]
    held = np.array(domain_tokens(scored, n))
    total = float(held.sum()) if total is None else total
    goal = total * np.array(weights(names, targets))
    allowed = np.where(goal > 0, CLOSE * goal, CLOSE_TO_NONE * max(total, 1.0))
    error = lambda got: float((((got - goal) / allowed) ** 2).sum())
    frame = scored.withColumn("rate", F.lit(1.0))
    rate: Column = F.col("rate")
    got, curve = _measured(frame, n, rate)
    steps = 0
    while (np.abs(got - goal) > allowed).any():
        scaled = np.linalg.lstsq(curve, got - goal, rcond=None)[0]
        plain = np.divide(got - goal, held, out=np.zeros(n), where=held > 0)
        for slopes in (a * s for s in (scaled, plain) for a in (1.0, 0.5, 0.25, 0.125)):
            moved = reduce(lambda a, b: a + b, [F.lit(float(s)) * p for s, p in zip(slopes, ps)])
            tried = F.greatest(F.lit(0.0), rate - moved)
            reached, bend = _measured(frame, n, tried)
            if error(reached) <= error(got) * (1 - LEAST_GAIN):
                break
        else:
            break  # out of reach
        rate, got, curve, steps = tried, reached, bend, steps + 1
        if steps % STEPS_PER_TABLE == 0:
            frame = saved(frame.withColumn("rate", rate), "domain-rates")
            rate = F.col("rate")
    whole = float(got.sum()) or 1.0
    return frame.withColumn("rate", rate), {d: float(x) / whole for d, x in zip(names, got)}


def mix_domains(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """One row per document: doc_id, version, n_tokens, posteriors (by domain), domain, rate, and in every row
    reached_shares, each domain's share of the expected tokens."""
    scored, names = score(docs, labels)
    rated, reached = fit_rates(scored, names, targets or TARGETS)
    shares = F.create_map(*[F.lit(x) for pair in reached.items() for x in pair])
    entries = [x for i, d in enumerate(names) for x in (F.lit(d), F.col(f"p{i}"))]
    best = F.array_max(F.array(*[F.struct(F.col(f"p{i}").alias("p"), F.lit(d).alias("d")) for i, d in enumerate(names)]))
    return rated.select("doc_id", "version", "n_tokens", F.create_map(*entries).alias("posteriors"), best["d"].alias("domain"), "rate", shares.alias("reached_shares"))


def draw_documents(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None
) -> tuple[DataFrame, dict[str, float]]:
    """The rows of ``docs`` in one pass over the mix, and each domain's expected share of their tokens.

    The rates are fitted for the total at which the expected rate of the domain of the largest
    weight (the clean one) is one and the others are thinned to their weights.  A domain that
    holds less than its weight asks for stays whole.  A row stays with probability min(1, rate);
    the draw is a hash of doc_id and text, so it is the same in every run.  The shares are
    those of the rows that stay, so they show what a rate above one leaves open."""
    targets = targets or TARGETS
    scored, names = score(docs, labels)
    wanted, held = weights(names, targets), domain_tokens(scored, len(names))
    clean = wanted.index(max(wanted))
    rated, _ = fit_rates(scored, names, targets, held[clean] / wanted[clean] or None)
    draw = F.pmod(F.xxhash64("doc_id", "version", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    drawn = saved(rated.filter(draw < F.col("rate")).drop("rate"), "drawn-documents")
    tokens = domain_tokens(drawn, len(names))
    shares = {d: x / (sum(tokens) or 1.0) for d, x in zip(names, tokens)}
    none = F.lit(-(1 << 63))
    stay = drawn.select(F.coalesce("doc_id", none).alias("id"), "version").distinct()
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs["doc_id"].cast("bigint"), none).alias("id"),
        F.xxhash64(text).alias("version"),
    )
    return rows.join(stay, ["id", "version"], "left_semi").select("row.*"), shares


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows that ``draw_documents`` keeps; the delivered shares go to the log beside the targets."""
    rows, shares = draw_documents(docs, labels, targets)
    wanted = dict(zip(shares, weights(list(shares), targets or TARGETS)))
    LOG.warning("mixed domains: %s", ", ".join(f"{d} {x:.4f} (target {wanted[d]:.4f})" for d, x in shares.items()))
    return rows
