"""Run registered queries in Spark and their SQL in DuckDB; compare row multisets.

Usage: ``python tests/oracle_compare.py [sf_dir] [name ...]`` (prints one line per
query).  Also imported by ``tests/test_oracle.py``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return float(f"{f:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalize(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return names, out


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    s_names, s_rows = normalize(df.columns, rows)
    res = {"name": name, "spark_rows": len(rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    d_names, d_rows = normalize(d_cols, d_rows)
    res["duck_rows"] = len(d_rows)
    if s_names != d_names:
        res["status"] = f"SCHEMA spark={s_names} duck={d_names}"
    elif len(s_rows) != len(d_rows):
        res["status"] = "ROWCOUNT"
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        res["status"] = f"VALUES first diffs={diff}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    from pyspark.sql import SparkSession

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs = E.queries()
    sql = E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        try:
            r = compare(spark, sf_dir, name, qs[name], sql.get(name), con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
