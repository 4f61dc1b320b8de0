"""Spark query vs DuckDB twin: row count, column names and an
order-insensitive hash of the values (doubles rounded), like the driver."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def digest(cols: list[str], rows) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> dict:
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    ok = (len(s_rows) == len(d_rows) and sorted(s_cols) == sorted(d_cols)
          and digest(s_cols, s_rows) == digest(d_cols, d_rows))
    return {"name": name, "ok": ok, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
            "spark_cols": s_cols, "duck_cols": d_cols, "sec": round(ts, 2)}


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from recsift.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8)
    con = duck(sf)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for name in sorted(q):
        if only and name not in only:
            continue
        if name not in o:
            t = time.time()
            n = q[name](spark, sf).count()
            print(f"{name:26s} rows-only {n} rows {time.time() - t:.1f}s", flush=True)
            continue
        try:
            r = compare(spark, name, q[name], o[name], sf, con)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:26s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        bad += not r["ok"]
        print(f"{name:26s} {'OK ' if r['ok'] else 'BAD'} {r['spark_rows']}/{r['duck_rows']} "
              f"{r['sec']}s" + ("" if r["ok"] else f" {r['spark_cols']} {r['duck_cols']}"), flush=True)
    print("mismatches:", bad)
