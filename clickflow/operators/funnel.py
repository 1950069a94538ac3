"""One-step page conversion along a target page flow.

Consecutive page pairs per session come from ``lag`` over time order (ties broken
by page_id, D16).  A plain per-session window would put one hot session in one
task, so the window is split into (session, time chunk) groups: inside a chunk
``lag`` runs as usual, and the first row of a chunk takes the last page of the
session's previous non-empty chunk, from a partial aggregate per chunk and a small
window over chunks.  The result is exact; only the chunk size bounds a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.scalars import ratio
from clickflow.params import FunnelParams

START_KEY = "^start"


def flow_pairs(flow) -> list[str]:
    """F16: ``a_b`` keys of consecutive flow pages."""
    return [f"{flow[i - 1]}_{flow[i]}" for i in range(1, len(flow))]


def previous_page(actions: DataFrame, chunk: str | None = "hour") -> DataFrame:
    """The session's actions in time order, each with the page viewed just
    before it.

    Identical actions (same session, time and page) sit next to each other in
    that order, so they are first collapsed by a partial aggregate into one row
    with their count ``n`` — a burst of copies never reaches a window as a group.
    ``prev_page_id`` is the page before the first copy; the other ``n - 1`` copies
    each follow a copy of the same page.

    ``chunk`` is a ``date_trunc`` unit ('day', 'hour', 'minute', ...) that splits a
    session's ordering work into independent (session, chunk) groups; ``None`` uses
    one window per session.  With chunks the result is the union of
    * every row but the first of its chunk, with ``lag`` inside the chunk, and
    * the first row of each chunk (``min`` of (time, page) per chunk, a partial
      aggregate), whose predecessor is the previous chunk's last page (``max``),
      found by ``lag`` over the session's chunks — one small row per chunk.
    No join and no per-session sort of all rows.
    """
    d = actions.groupBy("session_id", "action_time", "page_id").agg(F.count(F.lit(1)).alias("n"))
    if chunk is None:
        w = Window.partitionBy("session_id").orderBy("action_time", "page_id")
        return d.withColumn("prev_page_id", F.lag("page_id").over(w))

    d = d.withColumn("chunk", F.date_trunc(chunk, F.col("action_time")))
    w = Window.partitionBy("session_id", "chunk").orderBy("action_time", "page_id")
    inner = (
        d.withColumn("rn", F.row_number().over(w))
        .withColumn("prev_page_id", F.lag("page_id").over(w))
        .filter(F.col("rn") > 1)
        .select("session_id", "action_time", "page_id", "n", "prev_page_id")
    )
    ends = d.groupBy("session_id", "chunk").agg(
        F.min(F.struct("action_time", "page_id", "n")).alias("first"),
        F.max(F.struct("action_time", "page_id")).alias("last"),
    )
    cw = Window.partitionBy("session_id").orderBy("chunk")
    firsts = ends.select(
        "session_id",
        F.col("first.action_time").alias("action_time"),
        F.col("first.page_id").alias("page_id"),
        F.col("first.n").alias("n"),
        F.lag(F.col("last.page_id")).over(cw).alias("prev_page_id"),
    )
    return inner.unionByName(firsts)


def _split(a: str, b: str):
    return F.concat_ws("_", F.col(a).cast("string"), F.col(b).cast("string"))


def page_splits(actions: DataFrame, flow, chunk: str | None = "hour") -> DataFrame:
    """The (previous page, page) splits that are a consecutive pair of the flow, one row
    per distinct action with ``n``, how many actions it stands for.  Copies of an action
    contribute ``n - 1`` self-splits (``p_p``) when ``p_p`` is itself a flow pair."""
    pairs = flow_pairs(flow)
    p = previous_page(actions, chunk)
    first = p.filter(F.col("prev_page_id").isNotNull()).select(
        "session_id", "action_time", _split("prev_page_id", "page_id").alias("page_split"), F.lit(1).cast("bigint").alias("n")
    )
    out = first.filter(F.col("page_split").isin(pairs))
    self_pairs = [sp for sp in dict.fromkeys(pairs) if sp.split("_")[0] == sp.split("_")[1]]
    if self_pairs:
        rep = p.filter((F.col("n") > 1) & _split("page_id", "page_id").isin(self_pairs)).select(
            "session_id", "action_time", _split("page_id", "page_id").alias("page_split"), (F.col("n") - 1).alias("n")
        )
        both = out.unionByName(rep)
        out = both.groupBy("session_id", "action_time", "page_split").agg(F.sum("n").cast("bigint").alias("n"))
    return out


def page_split_pv(splits: DataFrame) -> DataFrame:
    """Matched splits per key."""
    return splits.groupBy("page_split").agg(F.sum("n").cast("bigint").alias("split_pv"))


def start_page_pv(actions: DataFrame, flow) -> DataFrame:
    """P12 + A13: actions on the first flow page (a one-row aggregate)."""
    return actions.filter(F.col("page_id") == F.lit(int(flow[0]))).agg(
        F.count(F.lit(1)).alias("start_page_pv")
    )


def flow_positions(flow) -> list[tuple[int, str, str]]:
    """(position, split, denominator key) per flow step, a repeated split keeping
    only its last position (D7).  Derived from the parameter alone."""
    pairs = flow_pairs(flow)
    rows = [(i + 1, sp, START_KEY if i == 0 else pairs[i - 1]) for i, sp in enumerate(pairs)]
    last = {sp: pos for pos, sp, _ in rows}
    return [r for r in rows if last[r[1]] == r[0]]


def page_convert_rate(actions: DataFrame, params: FunnelParams, chunk: str | None = "hour") -> DataFrame:
    """W5 (D7): per flow split: PV, previous PV and the rate ``pv / previous``.

    The first split divides by the start-page PV, split ``i`` by the PV of split
    ``i - 1``.  A missing PV is 0; the rate is NULL when the denominator is 0.

    One pass: every (collapsed) action is tagged with its matched split and whether
    it is on the start page, and a single partial aggregate counts all of them,
    weighted by the copy count (one row per task reaches the final merge).  The per-step rows are then laid out from that
    one row with ``inline``, sized by the flow parameter, not by the data.
    """
    flow = params.flow
    pairs = flow_pairs(flow)
    keys = list(dict.fromkeys(pairs))
    p = previous_page(actions, chunk)
    split, self_split = _split("prev_page_id", "page_id"), _split("page_id", "page_id")

    def pv(k: str):
        # the first copy follows prev_page_id, the other n - 1 copies follow the same page
        first = F.when(F.col("prev_page_id").isNotNull() & (split == F.lit(k)), F.lit(1)).otherwise(F.lit(0))
        rest = F.when(self_split == F.lit(k), F.col("n") - 1).otherwise(F.lit(0))
        return F.coalesce(F.sum(first + rest), F.lit(0)).cast("bigint")

    counts = p.agg(
        F.coalesce(F.sum(F.when(F.col("page_id") == F.lit(int(flow[0])), F.col("n"))), F.lit(0))
        .cast("bigint")
        .alias("c0"),
        *[pv(k).alias(f"c{i + 1}") for i, k in enumerate(keys)],
    )
    col_of = {START_KEY: "c0", **{k: f"c{i + 1}" for i, k in enumerate(keys)}}
    positions = flow_positions(flow)
    if not positions:  # a one-page flow has no step
        empty = F.struct(F.lit(0).alias("position"), F.lit("").alias("page_split"),
                         F.col("c0").alias("split_pv"), F.col("c0").alias("prev_pv"))
        rates = counts.select(F.inline(F.array(empty))).filter(F.lit(False))
        return rates.withColumn("convert_rate", ratio(F.col("split_pv"), F.col("prev_pv")))
    steps = F.array(
        *[
            F.struct(
                F.lit(pos).alias("position"),
                F.lit(sp).alias("page_split"),
                F.col(col_of[sp]).alias("split_pv"),
                F.col(col_of[den]).alias("prev_pv"),
            )
            for pos, sp, den in positions
        ]
    )
    return counts.select(F.inline(steps)).withColumn("convert_rate", ratio(F.col("split_pv"), F.col("prev_pv")))


def encode_convert_rate(rates: DataFrame) -> DataFrame:
    """one row ``a_b=rate|b_c=rate`` in flow order (NULL rate prints ``null``)."""
    text = F.concat(F.col("page_split"), F.lit("="), F.coalesce(F.col("convert_rate").cast("string"), F.lit("null")))
    items = F.array_sort(F.collect_list(F.struct(F.col("position"), text.alias("t"))))
    return rates.agg(F.array_join(F.transform(items, lambda x: x["t"]), "|").alias("convert_rate"))
