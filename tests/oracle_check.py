"""Side-by-side check of a registered Spark query against its DuckDB SQL.

Compares column names, row count and the multiset of rows (floats compared
after rounding to 6 places; NaN / NULL treated alike).
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabrisk.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 5)
        return 0.0 if r == 0 else r
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, queries: dict, oracle: dict) -> tuple[bool, str]:
    sdf = queries[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    res = con.execute(oracle[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    if len(s_rows) != len(o_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(o_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(s_rows)} rows"


if __name__ == "__main__":
    import time

    from tabrisk.plans.catalog import ORACLE, QUERIES
    from tabrisk.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(ORACLE)
    spark = local_session(8)
    fails = 0
    for n in names:
        t = time.time()
        try:
            ok, msg = compare(spark, n, sf, QUERIES, ORACLE)
        except Exception as e:  # report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        fails += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n} ({time.time() - t:.1f}s): {msg}", flush=True)
    print(f"{len(names) - fails}/{len(names)} passed")
