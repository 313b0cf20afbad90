"""Run a registered query in Spark and its oracle SQL in DuckDB and compare
row count, column names and the multiset of rows (exact values)."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from custlens.sources.tables import DRIVER_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], sorted(cols)


def compare(spark, con, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    s, sc = rows_of(scols, srows)
    d, dc = rows_of(dcols, drows)
    out = {"spark_rows": len(s), "oracle_rows": len(d), "cols_match": sc == dc}
    if sc != dc:
        out["cols_only_spark"] = sorted(set(sc) - set(dc))
        out["cols_only_oracle"] = sorted(set(dc) - set(sc))
        return out
    cs, cd = Counter(s), Counter(d)
    out["values_match"] = cs == cd
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        diffs = []
        for a, b in zip(sorted(only_s, key=str), sorted(only_d, key=str)):
            diffs.append({sc[i]: (a[i], b[i]) for i in range(len(sc)) if a[i] != b[i]})
        out["diff_examples"] = diffs
    return out
