"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import zlib

import duckdb

SF = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"


def rows(sf: str, sql: str) -> list[tuple]:
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con.execute(sql).fetchall()


def crc(i) -> int:
    return zlib.crc32(str(i).encode())


def closure(nodes, linked) -> dict:
    """Smallest node reachable from each node over pairs ``linked``."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in linked:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}
