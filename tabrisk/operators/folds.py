"""Stratified split (W9) and repeated stratified folds.

Row order comes from a seeded hash of integer keys, so assignment
does not depend on partitioning or on the engine. A split needs no ranks: the
hash up to which a class's quota reaches comes from a few counts, after which
the split is a comparison. Folds take the rank of each row inside its class
from :func:`order.hashed_positions`, so a class holding a third of the rows is
still spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import hand_on, keep_rows
from .order import PLACE_BITS, hashed_positions, positions

#: Bits of :func:`exprs.seeded_hash`.
HASH_BITS = 32


def class_quotas(counts: list[tuple[object, int]], fraction: float) -> dict:
    """Largest-remainder allocation of ceil(fraction * n) draws over classes
    (ties in the remainder go to the class that sorts first)."""
    n = sum(c for _, c in counts)
    draws = math.ceil(fraction * n)
    exact = [(k, c * draws / n) for k, c in counts]
    base = {k: int(math.floor(x)) for k, x in exact}
    left = draws - sum(base.values())
    order = sorted(exact, key=lambda kx: (-(kx[1] - math.floor(kx[1])), str(kx[0])))
    for k, _ in order[:left]:
        base[k] += 1
    return base


def stratified_split(df: DataFrame, class_col: str, hash_keys: Sequence[str], tie_keys: Sequence[str],
                     test_fraction: float = 0.2, seed: int = 42, out_col: str = "split") -> DataFrame:
    """Exact per-class test quota; the first ``quota`` rows of each class in
    seeded-hash order are 'test', the rest 'train'. The rows are written once with their hash."""
    rows = keep_rows(df.withColumn("_h", X.seeded_hash(hash_keys, seed)))
    cuts = quota_cuts(rows.select(F.col(class_col).alias("c"), F.col("_h").alias("h")), test_fraction)
    below = F.lit(False)
    for c, (v, t, n) in cuts.items():
        below = below | ((F.col(class_col) == F.lit(c)) & ((F.col("_h") <= F.lit(v)) if t == n else (F.col("_h") < F.lit(v))))
    split = F.when(below, F.lit("test")).otherwise(F.lit("train")).alias(out_col)
    # rows of one hash that the quota reaches only a part of: ranked by the tie keys
    torn = {c: (v, t) for c, (v, t, n) in cuts.items() if 0 < t < n}
    if not torn:
        return hand_on(rows, rows.select(*df.columns, split))
    tied = F.lit(False)
    for c, (v, _) in torn.items():
        tied = tied | (F.col(class_col).eqNullSafe(F.lit(c)) & (F.col("_h") == F.lit(v)))
    few = positions(rows.where(tied), ["_h", *tie_keys], [class_col], "_rk")
    left = X.map_values(class_col, {c: t for c, (_, t) in torn.items()}).cast("long")
    few = few.select(*df.columns, F.when(F.col("_rk") < left, F.lit("test")).otherwise(F.lit("train")).alias(out_col))
    return hand_on(rows, rows.where(~tied).select(*df.columns, split).unionByName(few))


def quota_cuts(hashed: DataFrame, fraction: float) -> dict:
    """class -> (v, t, n): a class's quota takes its rows with a hash below v and t of the n rows with hash v.

    ``hashed`` has a class ``c`` and a hash ``h`` below 2**32. One pass counts by the leading bits, further ones only the
    places in which quotas end, by the bits that follow; each returns at most ``2**PLACE_BITS`` counts a class.
    """
    shift = HASH_BITS - PLACE_BITS
    counts = hashed.groupBy("c", F.shiftright("h", shift).alias("d")).count().collect()
    sizes: dict = {}
    for r in counts:
        sizes[r["c"]] = sizes.get(r["c"], 0) + r["count"]
    left = {c: q for c, q in class_quotas(list(sizes.items()), fraction).items() if q > 0 and c is not None}
    at, n = {c: 0 for c in left}, {}
    while True:
        for c in left:
            for d, m in sorted((r["d"], r["count"]) for r in counts if r["c"] == c):
                if left[c] <= m:
                    break
                left[c] -= m
            at[c], n[c] = d, m
        if not shift or not left:
            return {c: (at[c], left[c], n[c]) for c in left}
        of = F.lit(False)
        for c, d in at.items():
            of = of | ((F.col("c") == F.lit(c)) & (F.shiftright("h", shift) == F.lit(d)))
        shift = 0 if max(n.values()) <= 1 << PLACE_BITS else max(0, shift - PLACE_BITS)
        counts = hashed.where(of).groupBy("c", F.shiftright("h", shift).alias("d")).count().collect()


def stratified_folds(df: DataFrame, class_col: str, hash_keys: Sequence[str], tie_keys: Sequence[str],
                     k: int = 5, repeats: int = 1, seed: int = 42) -> DataFrame:
    """``fold`` = rank inside class (seeded-hash order, one order per repeat) mod k.

    Every fold gets floor or ceil of n_c / k rows of each class. Output has one
    row per (input row, repeat) with ``repeat`` and ``fold``. The rows are written once with their hashes.
    """
    out = None
    rows = keep_rows(df.withColumns({f"_h{r}": X.seeded_hash(hash_keys, seed + 1000003 * r) for r in range(repeats)}))
    for r in range(repeats):
        ranked = hashed_positions(rows.select(*df.columns, f"_h{r}"), f"_h{r}", HASH_BITS, tie_keys, [class_col], "_rk")
        part = ranked.select(*df.columns, F.lit(r).alias("repeat"), F.pmod(F.col("_rk"), F.lit(k)).cast("int").alias("fold"))
        out = part if out is None else out.unionByName(part)
    return hand_on(rows, out)


def fold_long(folds: DataFrame, k: int) -> DataFrame:
    """Fold-long table: each row once per (repeat, fold_id) with its role.

    A row is 'val' in its own fold and 'train' in the other k-1 folds, so all
    folds' statistics come out of one grouped aggregation filtered on role.
    """
    ids = F.array(*[F.lit(i) for i in range(k)])
    return folds.select("*", F.explode(ids).alias("fold_id")).withColumn(
        "role", F.when(F.col("fold_id") == F.col("fold"), F.lit("val")).otherwise(F.lit("train"))
    ).withColumn("fold_key", F.col("repeat") * F.lit(k) + F.col("fold_id"))


def fold_sizes(folds: DataFrame, class_col: str) -> DataFrame:
    return folds.groupBy("repeat", "fold", class_col).agg(F.count(F.lit(1)).alias("n"))
