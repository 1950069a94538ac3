"""Result-table write semantics (K1-K7) as DataFrame operations.

The reference writes rows to MySQL with insert / add-upsert / replace-upsert /
delete-groups-then-insert statements.  Here each one is a pure function from
(target state, updates) to the new state, so any table format can store it: plain
parquet as below, or a ``MERGE INTO`` on a table format that has one.

:class:`BatchTable` stores the upserts of a stream (D14): partitions keyed by batch, and a merge of
those partitions that changed.
"""

from __future__ import annotations

import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def materialize(df: DataFrame, name: str = "intermediate", made: list[str] | None = None) -> DataFrame:
    """Write an intermediate once as a parquet table in the cluster's shared work
    folder (``spark.checkpoint.dir``) and read it back.

    This cuts the lineage (a lost executor re-reads the table instead of
    recomputing the pipeline).  Unlike an RDD checkpoint the table is columnar,
    so each later branch scans only the columns it needs.  The folder goes when the
    driver ends; ``made`` collects it for callers that remove it earlier.
    """
    from clickflow.config import work_dir

    path = work_dir(df.sparkSession, name)
    if made is not None:
        made.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def with_task_id(df: DataFrame, task_id: int) -> DataFrame:
    """K1: results are stored with the task id as the first column."""
    return df.select(F.lit(task_id).cast("bigint").alias("task_id"), *df.columns)


def jdbc_options(table: str, url: str, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """The writer options for one result table of a database."""
    return {**(properties or {}), "url": url, "dbtable": table}


def append(
    df: DataFrame, target: str, task_id: int | None = None, fmt: str = "parquet", mode: str = "append", **options: str
) -> str:
    """K1/K2/K3/K9: append rows to a table: a path, or with ``fmt="jdbc"`` a table name (``url`` in
    the options).  ``mode="overwrite"`` stores a new state in place of the old one (K4-K7); files are written
    beside the old ones first and take their place when they are whole, so the new state may be made from the old
    one and a failed write leaves that as it was.  (:class:`BatchTable` stores upserts without rewriting what didn't change.)

    Executors write their own partitions; nothing is collected to the driver.
    """
    out = with_task_id(df, task_id) if task_id is not None else df
    if mode == "overwrite" and fmt != "jdbc":
        return _replace_folder(out, target, fmt, options)
    w = out.write.mode(mode).format(fmt)
    if fmt == "jdbc":
        options = dict(options)
        w.options(**jdbc_options(target, options.pop("url"), options)).save()
    else:
        w.options(**options).save(target)
    return target


def _replace_folder(df: DataFrame, target: str, fmt: str, options: Mapping[str, str]) -> str:
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    new = f"{target.rstrip('/')}.new-{uuid.uuid4().hex[:12]}"
    fs = path(target).getFileSystem(conf)
    try:
        df.write.format(fmt).options(**options).save(new)
    except Exception:
        fs.delete(path(new), True)
        raise
    fs.delete(path(target), True)
    if not fs.rename(path(new), path(target)):
        raise OSError(f"the new state is whole but could not be moved: {new}")
    return target


def upsert_add(target: DataFrame, updates: DataFrame, keys: Sequence[str], value: str = "click_count") -> DataFrame:
    """K4: existing key → ``value + update``, new key → inserted.

    A union plus one aggregate: partial sums per task, so a hot key is combined
    map-side.
    """
    cols = [*keys, value]
    return (
        target.select(*cols)
        .unionByName(updates.select(*cols))
        .groupBy(*keys)
        .agg(F.sum(value).cast("bigint").alias(value))
    )


def by_key(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ``keys`` in which a NULL key part equals NULL, as in a group by."""
    named = right.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(named, on, how)


def upsert_replace(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K5: existing key → row replaced by the update, new key → inserted.

    One aggregate over both sides, in which a NULL key part is a value like any other;
    an update wins over a target row."""
    cols = target.columns
    others = [c for c in cols if c not in keys]
    rows = target.select(*cols, F.lit(0).alias("_side")).unionByName(updates.select(*cols, F.lit(1).alias("_side")))
    best = F.max_by(F.struct(*others), F.col("_side")).alias("_row")
    return rows.groupBy(*keys).agg(best).select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in cols])


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], value: str = "click_count", mode: str = "add"
) -> DataFrame:
    """K4/K5 by ``mode`` (``'add'`` or ``'replace'``)."""
    if mode == "add":
        return upsert_add(target, updates, keys, value)
    if mode == "replace":
        return upsert_replace(target, updates, keys)
    raise ValueError(f"unknown upsert mode {mode!r}")


def upsert_split(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """K6: (rows to insert, rows to update) by key existence in ``target``."""
    return by_key(updates, target, keys, "left_anti"), by_key(updates, target, keys, "left_semi")


def replace_groups(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7 (+A18): drop every target group whose key occurs in ``updates``, then add all updates."""
    cols = target.columns
    return by_key(target, updates, keys, "left_anti").select(*cols).unionByName(updates.select(*cols))


class BatchTable:
    """Stream sink whose cost follows the change.

    Rows belong to parts: ``part`` is an SQL expression over the keys, such as a date or a hash of
    a key.  Under ``path``:

    * ``delta/_batch=<b>/_part=<p>``: the rows that micro-batch ``b`` changed.  A replayed batch
      overwrites its own folder, so it counts once.
    * ``base/_part=<p>/_batch=<b>``: the merged state of one part.  Every ``merge_every`` batches the
      parts touched since their last merge get a new one, by one write with dynamic
      partition overwrite; a part that no batch touched is neither read nor written.

    Files are sorted by part and ``sort``, so that a filter on those columns skips row groups.

    The state of a part is its newest base with the later deltas.  A merge reads only what is older than
    itself, so it can fail and be replayed at any point.  Afterwards the base before the
    newest one stays for a replay, and deltas that every part has merged go.

    ``mode`` decides the merge: ``'add'`` sums ``value`` per key (K4), ``'replace'`` keeps the
    newest row per key (K5), ``'replace_groups'`` the newest batch's rows of each group (K7),
    ``'set'`` distinct rows.
    """

    MODES = ("add", "replace", "replace_groups", "set")
    TASKS_PER_PART = 16

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str] = (),
        mode: str = "replace",
        value: str = "click_count",
        part: str = "'all'",
        merge_every: int = 20,
        sort: Sequence[str] = (),
    ):
        if mode not in self.MODES:
            raise ValueError(f"unknown mode {mode!r}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.columns = [f.name for f in schema.fields]
        self.keys = list(keys) or self.columns
        self.mode = mode
        self.value = value
        self.part = part
        self.merge_every = merge_every
        self.sort = list(sort)
        stored = [T.StructField("_part", T.StringType()), T.StructField("_batch", T.LongType())]
        self._stored = T.StructType([*schema.fields, *stored])

    # -- folders: names only, rows never come to the driver --------------------
    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(conf)

    def _children(self, folder: str, key: str) -> list[str]:
        """Values of the ``key=value`` folders in a folder, as they are written there."""
        path, fs = self._fs()
        if not fs.exists(path(folder)):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(path(folder))]
        return sorted(n[len(key) + 1 :] for n in names if n.startswith(f"{key}="))

    def _delta(self, batch: int) -> str:
        return f"{self.path}/delta/_batch={batch}"

    def batches(self) -> list[int]:
        """Micro-batches whose rows are stored whole."""
        path, fs = self._fs()
        found = (int(b) for b in self._children(f"{self.path}/delta", "_batch"))
        return sorted(b for b in found if fs.exists(path(f"{self._delta(b)}/_SUCCESS")))

    def touched(self, batch: int) -> set[str]:
        """The parts that a micro-batch changed."""
        return set(self._children(self._delta(batch), "_part"))

    def bases(self, parts: set[str] | None = None) -> dict[str, list[int]]:
        """The merges of each part, oldest first."""
        base = f"{self.path}/base"
        names = [p for p in self._children(base, "_part") if parts is None or p in parts]
        return {p: sorted(map(int, self._children(f"{base}/_part={p}", "_batch"))) for p in names}

    def _write(self, df: DataFrame, path: str, by: Sequence[str], **options: str) -> None:
        # few files a part: adaptive execution merges small shares and splits large ones; without it (a stateful
        # stream's batch) a hot part still goes to TASKS_PER_PART tasks
        share = F.pmod(F.xxhash64(*self.columns), F.lit(self.TASKS_PER_PART))
        dealt = df.withColumn("_share", share).hint("rebalance", *by, "_share").drop("_share")
        dealt.sortWithinPartitions(*by, *self.sort).write.mode("overwrite").options(**options).partitionBy(*by).parquet(path)

    # -- rows ------------------------------------------------------------------
    def _rows(self, as_of: int | None, parts: set[str] | None, below: int | None = None) -> DataFrame:
        """Stored rows that make up the state: of each part its newest base and what came later."""
        newest: dict[str, int] = {}
        for name, merges in self.bases(parts).items():
            fit = [b for b in merges if (as_of is None or b <= as_of) and (below is None or b < below)]
            if fit:
                newest[name] = fit[-1]
        base = [f"{self.path}/base/_part={p}/_batch={b}" for p, b in newest.items()]
        delta = []
        for b in self.batches():
            if as_of is None or b <= as_of:
                mine = self.touched(b) if parts is None else self.touched(b) & parts
                delta += [f"{self._delta(b)}/_part={p}" for p in mine if b > newest.get(p, -1)]
        rows = None
        for kind, paths in (("base", base), ("delta", delta)):
            if paths:
                read = self.spark.read.schema(self._stored).option("basePath", f"{self.path}/{kind}")
                found = read.parquet(*sorted(paths)).select(*self.columns, "_part", "_batch")
                rows = found if rows is None else rows.unionByName(found)
        return self.spark.createDataFrame([], self._stored) if rows is None else rows

    def _merged(self, rows: DataFrame, *also: str) -> DataFrame:
        """One state from stored rows; ``also``: columns that the keys decide."""
        keys = [*self.keys, *also]
        if self.mode == "add":
            return rows.groupBy(*keys).agg(F.sum(self.value).cast("bigint").alias(self.value))
        if self.mode == "set":
            return rows.select(*self.columns, *also).distinct()
        if self.mode == "replace":
            others = [c for c in self.columns if c not in self.keys]
            latest = F.max_by(F.struct(*others), F.col("_batch")).alias("_row")
            return rows.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_row.{c}") for c in others])
        newest = F.max("_batch").over(Window.partitionBy(*self.keys))
        return rows.withColumn("_newest", newest).filter(F.col("_batch") == F.col("_newest")).select(*self.columns, *also)

    # -- API -------------------------------------------------------------------
    def changes(self, batch_id: int) -> DataFrame:
        """The rows that micro-batch ``batch_id`` wrote."""
        return self.spark.read.schema(self._stored).parquet(self._delta(batch_id)).select(*self.columns)

    def read(
        self, as_of: int | None = None, keys: DataFrame | None = None, touched_by: int | None = None, where: str = "true"
    ) -> DataFrame:
        """State after micro-batch ``as_of`` (all batches when None).

        ``touched_by`` opens only the parts that this batch changed; ``where``, over key columns, reaches the
        scan (files are sorted by ``sort``); ``keys`` restricts the state to those key rows before merging."""
        rows = self._rows(as_of, None if touched_by is None else self.touched(touched_by)).filter(where)
        if keys is not None:  # any subset of the columns, e.g. the groups a batch touched
            rows = by_key(rows, keys, keys.columns, "left_semi")
        return self._merged(rows).select(*self.columns)

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Record micro-batch ``batch_id``'s changes (idempotent); every ``merge_every`` batches
        merge the parts touched since."""
        name = F.coalesce(F.expr(self.part).cast("string"), F.lit("-"))
        self._write(changes.select(*self.columns).withColumn("_part", name), self._delta(batch_id), ["_part"])
        if self.merge_every and (batch_id + 1) % self.merge_every == 0:
            self.merge(batch_id)

    def merge(self, batch_id: int) -> None:
        """New bases, as of micro-batch ``batch_id``, for the parts that have deltas beyond their last one."""
        deltas = {b: self.touched(b) for b in self.batches() if b <= batch_id}
        every = set().union(*deltas.values())
        before = self.bases(every)
        last = {p: max((b for b in before.get(p, ()) if b < batch_id), default=-1) for p in every}
        parts = {p for b, names in deltas.items() for p in names if b > last[p]}
        if not parts:
            return
        state = self._merged(self._rows(batch_id, parts, below=batch_id), "_part").withColumn("_batch", F.lit(batch_id))
        self._write(state, f"{self.path}/base", ["_part", "_batch"], partitionOverwriteMode="dynamic")
        self._retire(batch_id, deltas, before, last)

    def _retire(self, batch_id: int, deltas: dict[int, set[str]], before: dict[str, list[int]], last: dict[str, int]) -> None:
        """Delete what neither a read nor a replay of ``batch_id`` needs."""
        path, fs = self._fs()
        for p, merges in before.items():
            for b in merges:
                if b < last[p]:
                    fs.delete(path(f"{self.path}/base/_part={p}/_batch={b}"), True)
        for b, names in deltas.items():
            if all(last[p] >= b for p in names):
                fs.delete(path(self._delta(b)), True)
