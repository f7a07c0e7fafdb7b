"""Runs queries in Spark and DuckDB and compares rows."""

from __future__ import annotations

import glob
import os
import time


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    def plain(v):
        return round(v, 9) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, d, queries, oracle, only=None):
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{d}/*.parquet"):
        name = os.path.basename(p)[: -len(".parquet")]
        con.sql(f"create view {name} as select * from read_parquet('{p + '/*' if os.path.isdir(p) else p}')")
    out = {}
    for k, f in queries.items():
        if only and k not in only:
            continue
        at = time.time()
        try:
            df = f(spark, d)
            got = rows_of(df.columns, df.collect())
            if k in oracle:
                r = con.sql(oracle[k])
                want = rows_of(r.columns, r.fetchall())
                ok = sorted(df.columns) == sorted(r.columns) and got == want
                out[k] = "ok" if ok else f"DIFF {len(got)} {len(want)} {sorted(df.columns)} {sorted(r.columns)} {[x for x in got if x not in set(want)][:2]} {[x for x in want if x not in set(got)][:2]}"
            else:
                out[k] = f"rows {len(got)}"
        except Exception as e:  # noqa: BLE001
            out[k] = "ERROR " + str(e)[:400]
        out[k] += f" ({time.time() - at:.1f} s)"
    return out
