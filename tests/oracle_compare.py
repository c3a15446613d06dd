"""Run a registered Spark query and its DuckDB oracle; compare results as
multisets of rows with columns matched by name.

CLI: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("f", None if math.isnan(v) else v)
    if isinstance(v, decimal.Decimal):
        return ("f", float(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None))
    if isinstance(v, dt.date):
        return ("d", v)
    if v is None:
        return ("n", None)
    return ("s", str(v))


def _key(row):
    return tuple((t, "" if x is None else repr(x)) for t, x in row)


def compare(spark, con, name: str, sf_dir: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    t2 = time.time()
    out = {"query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2)}
    if sorted(s_cols) != sorted(d_cols):
        out.update(ok=False, why=f"columns differ: spark={s_cols} oracle={d_cols}")
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if a == b:
        out["ok"] = True
        return out
    diff_a = [r for r in a if r not in set(b)][:3]
    diff_b = [r for r in b if r not in set(a)][:3]
    out.update(ok=False, why=f"values differ; spark-only {diff_a} oracle-only {diff_b}", columns=order)
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tenderlake.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print({"query": name, "rows_only": n})
            continue
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls[name])
        except Exception as e:  # report and continue with the next query
            r = {"query": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r.get("ok")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
