"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes from indivisible groups.

All rows of one text are one group and stay together.  A partial partition is a vector of
shard sums; combining two lays the largest sums of one on the smallest of the other, and
the pair with the largest spread is combined first.  The work is a tree: groups are dealt
to blocks, each block is differenced to one partial partition in its own task, and
those partial partitions are differenced again, ``FAN_IN`` at a time, until one is left.
The choices made on the way are read backwards, level by level, to give each group its
shard.  No task sees more than a block, whatever the number of groups.

A group larger than a fair share can't be split, so its shard is as large as it is.

Defined results: a null text has no bytes and shares the group of empty texts; every row
counts its UTF-8 bytes plus 8; repeated rows count each time and stay together; a null
doc_id is numbered like any other; an empty table gives no rows; further columns are
not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import chunks_for, gapless_rank, id_text, saved

SHARDS = 24
GROUPS_PER_BLOCK = 8192
FAN_IN = 512
ROWS_PER_CHUNK = 4096
ROW_BYTES = 8


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows of ``sums``) into one.

    Returns its sums and, for each input, where each of its subsets went."""
    n, k = sums.shape
    nodes: list[np.ndarray] = list(sums)
    parents: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    heap = [(-int(s.max() - s.min()), i) for i, s in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        down, up = np.argsort(-nodes[a], kind="stable"), np.argsort(nodes[b], kind="stable")
        both = nodes[a][down] + nodes[b][up]
        parents.append((a, b, down, up))
        nodes[a] = nodes[b] = None  # type: ignore[call-overload]
        heapq.heappush(heap, (-int(both.max() - both.min()), len(nodes)))
        nodes.append(both)
    went = np.empty((n + len(parents), k), np.int16)
    went[-1] = np.arange(k)
    for i in range(len(parents) - 1, -1, -1):
        a, b, down, up = parents[i]
        went[a, down] = went[n + i]
        went[b, up] = went[n + i]
    return nodes[heap[0][1]], went[:n]


def _level_schema(id_type: str) -> str:
    return f"block long, id {id_type}, sums array<long>, went array<short>"


def _differenced(shards: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")  # the same order in every run
        total, went = difference(np.stack([np.asarray(x, np.int64) for x in group["sums"]]))
        out = pd.DataFrame({"block": group["block"].to_numpy(), "id": group["id"].to_numpy()})
        out["sums"] = [total.tolist()] + [None] * (len(out) - 1)  # the block's result, once
        out["went"] = [x.tolist() for x in went]
        return out

    return run


def shard_labels(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``id`` and ``bytes`` of indivisible groups -> ``id``, ``shard``."""
    id_type = dict(groups.dtypes)["id"]
    n = groups.count()
    blocks = chunks_for(n, GROUPS_PER_BLOCK)
    single = F.concat(F.array(F.col("bytes").cast("long")), F.array_repeat(F.lit(0).cast("long"), shards - 1))
    level = groups.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", single.alias("sums"))
    levels = []
    while True:
        done = saved(level.groupBy("block").applyInPandas(_differenced(shards), _level_schema(id_type)), "differencing")
        levels.append(done)
        if blocks == 1:
            break
        blocks = chunks_for(blocks, FAN_IN)
        merged = done.filter("sums is not null").select(F.col("block").alias("id"), "sums")
        level = merged.select(F.pmod("id", F.lit(blocks)).alias("block"), "id", "sums")
        id_type = "long"
    # backwards: where a block's subsets went, then where its members' subsets went
    labels = levels[-1].select("id", "went")
    for done in reversed(levels[:-1]):
        above = labels.select(F.col("id").alias("block"), F.col("went").alias("above"))
        down = F.transform("went", lambda x: F.element_at("above", (x + 1).cast("int")))
        labels = done.select("block", "id", "went").join(above, "block").select("id", down.alias("went"))
    return labels.select("id", F.element_at("went", 1).cast("int").alias("shard"))


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    d = id_text(docs)
    raw = F.col("text").cast("binary")
    rows = saved(
        d.select(
            "doc_id",
            (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"),
            F.crc32(raw).alias("text_crc32"),
            F.unhex(F.sha2(raw, 256)).alias("group"),
        ),
        "sized-rows",
    )
    groups = saved(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "sized-groups")
    labels = shard_labels(groups.select(F.col("group").alias("id"), "bytes"), shards)
    placed = rows.join(labels.withColumnRenamed("id", "group"), "group").drop("group")
    placed = saved(placed, "sharded-rows")
    order = [F.col("doc_id"), F.col("text_crc32")]
    spread = [F.col("doc_id"), F.col("text_crc32")]
    chunks = chunks_for(placed.count(), ROWS_PER_CHUNK)
    return gapless_rank(placed, "shard", order, spread, chunks, "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
