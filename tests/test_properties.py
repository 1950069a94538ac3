"""Property tests: Spark column helpers against small Python models of the
reference's Java string semantics (many generated cases in one DataFrame each)."""

from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickflow.functions import scalars as S


def java_split(s: str, sep: str) -> list[str]:
    """``String.split`` with a literal separator: trailing empty strings dropped."""
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts else ([] if s else [""])


def model_get(s, field):
    if s is None:
        return None
    for seg in java_split(s, "|"):
        kv = java_split(seg, "=")
        if len(kv) == 2 and kv[0] == field:
            return kv[1]
    return None


def model_set(s, field, value):
    if s is None:
        return None
    segs = java_split(s, "|")
    for i, seg in enumerate(segs):
        name = java_split(seg, "=")[0] if java_split(seg, "=") else ""
        if name == field:
            segs[i] = f"{field}={value}"
            break
    return "|".join(segs)


def model_trim(s):
    if s.startswith(","):
        s = s[1:]
    if s.endswith(","):
        s = s[:-1]
    return s


def model_ratio(n, d):
    if d == 0:
        return None
    q = Fraction(n, d) * 100
    return float((q + Fraction(1, 2)).__floor__()) / 100


alphabet = st.sampled_from(list("ab=|,1"))
kv_text = st.text(alphabet=alphabet, max_size=14)


@settings(max_examples=5, deadline=None)
@given(st.lists(kv_text, min_size=60, max_size=60))
def test_kv_codec_matches_java_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "s string")
    rows = df.select(
        "s", S.kv_get("s", "a").alias("g"), S.kv_set("s", "a", F.lit("9")).alias("p")
    ).collect()
    for r in rows:
        assert r["g"] == model_get(r["s"], "a"), r
        assert r["p"] == model_set(r["s"], "a", "9"), r


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(",ab1")), max_size=6), min_size=40, max_size=40))
def test_trim_comma_and_pad_match_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for r in df.select("s", S.trim_comma("s").alias("t"), S.zero_pad2("s").alias("z")).collect():
        assert r["t"] == model_trim(r["s"])
        assert r["z"] == (r["s"] if len(r["s"]) == 2 else "0" + r["s"])


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=80, max_size=80))
def test_ratio_is_exact_half_up(spark, pairs):
    pairs = [(n, d) for n, d in pairs] + [(k, 200) for k in range(0, 201, 7)] + [(5, 0)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for r in df.select("n", "d", S.ratio("n", "d").alias("r")).collect():
        assert r["r"] == model_ratio(r["n"], r["d"]), r
