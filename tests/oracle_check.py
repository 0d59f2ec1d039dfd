"""Run registered queries and their SQL side by side and compare every value exactly."""

from __future__ import annotations

import datetime as dt
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v + 0.0) if v != 0 else "0.0"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return repr(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def check(query, spark, sf, con) -> tuple[bool, str]:
    t0 = time.time()
    df = query.run(spark, sf)
    got = df.collect()
    t1 = time.time()
    sql = query.oracle()
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {t1 - t0:.1f}s"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    gc, gr = table(df.columns, [tuple(r) for r in got])
    wc, wr = table(names, want)
    if gc != wc:
        return False, f"columns {gc} != {wc}"
    negzero = sum(1 for r in want for v in r if isinstance(v, float) and v == 0 and math.copysign(1, v) < 0)
    note = f" NEGZERO={negzero}" if negzero else ""
    if gr != wr:
        diff = [(a, b) for a, b in zip(gr, wr) if a != b]
        cols = [gc[i] for i in range(len(gc)) if diff and any(a[i] != b[i] for a, b in diff)]
        return False, f"rows {len(gr)} vs {len(wr)}; {len(diff)} differ in {cols}; first {diff[:1]}"
    return True, f"{len(gr)} rows, {t1 - t0:.1f}s{note}"
