"""Row and column draws per tree (W15) and GOSS weights (W14), without copying rows.

Every draw is the MD5 of a seed and keys, so it is the same in SQL and for any
partitioning. Samples without replacement are the rows with the smallest hashes:
the cut between drawn and not drawn is found by radix selection (a few counts of
at most ``2**DIGIT`` groups), after which a draw is a comparison in an
expression. Bootstrap draws are multiplicities: integer weights of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order import hashed_positions

#: Bits of a hash, and of the part of it that one counting pass tells apart.
BITS, DIGIT = 60, 15
#: Rows of one group up to which the cut is taken from the sorted values themselves.
FEW = 20_000
#: Draws of one task, and trees up to which a position's draws are counted in a column a tree.
DRAWS_A_TASK, FEW_TREES = 4_000_000, 16


def wide_hash(keys: Sequence[str | Column], seed: int, *more: int) -> Column:
    """A number below 2**60 from the MD5 of the seed, further integers and integer key columns."""
    parts = [F.lit(str(int(x))) for x in (seed, *more)] + [(F.col(k) if isinstance(k, str) else k).cast("long").cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def wide_hash_sql(keys: Sequence[str], seed: int, *more: int) -> str:
    """The same hash as SQL text."""
    parts = [f"'{int(x)}'" for x in (seed, *more)] + [f"CAST(CAST({k} AS BIGINT) AS VARCHAR)" for k in keys]
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15) AS BIGINT)"


def cut(df: DataFrame, value: Column, m: int) -> tuple[int, int]:
    """(v, t): the ``m`` smallest of ``value`` (longs in [0, 2**60)) are those below v and t of those equal to it."""
    if m <= 0:
        return 0, 0
    part, low, shift, left = df.select(value.alias("v")).where("v is not null"), 0, BITS, m
    while shift:
        shift -= DIGIT
        counts = sorted((r["d"], r["count"]) for r in part.groupBy(F.shiftright("v", shift).alias("d")).count().collect())
        for digit, n in counts:
            if left <= n:
                break
            left -= n
        else:  # fewer rows than asked for: all of them
            return 1 << BITS, 0
        low = digit << shift
        part = part.where(F.col("v").between(low, low + (1 << shift) - 1))
        if n <= FEW:
            values = sorted(r["v"] for r in part.collect())
            v = values[left - 1]
            return v, left - sum(x < v for x in values)
    return low, left


def subsample(df: DataFrame, keys: Sequence[str], share: float, seed: int, round_: int = 0, n: int | None = None) -> Column:
    """Whether a row is among the max(1, floor(share * n)) drawn for a round. ``keys`` (integers) tell rows apart."""
    if share >= 1:
        return F.lit(True)
    n = df.count() if n is None else n
    h = wide_hash(keys, seed, round_)
    v, t = cut(df, h, max(1, int(n * share)))
    return h <= F.lit(v) if t else h < F.lit(v)


def columns_drawn(n: int, share: float, seed: int, tree: int) -> list[int]:
    """The max(1, floor(share * n)) column numbers drawn for a tree, ascending (smallest MD5 of seed, tree and number)."""
    m = n if share >= 1 else max(1, int(n * share))
    rank = sorted(range(n), key=lambda c: (hashlib.md5(f"{seed}|{tree}|{c}".encode()).hexdigest(), c))
    return sorted(rank[:m])


def bootstrap(df: DataFrame, keys: Sequence[str], trees: int, seed: int, out: str = "weights") -> DataFrame:
    """``df`` with an array of ``trees`` multiplicities: how often each of n draws with replacement took the row.

    Draw j of tree t takes position MD5(seed, t, j) modulo n of the rows in order
    of their hash; draws are counted by position and joined to the rows, so the
    multiplicities of a tree add up to n exactly.
    """
    n = df.count()
    if not n:
        return df.withColumn(out, F.array().cast("array<int>"))
    placed = hashed_positions(df.withColumn("_h", wide_hash(keys, seed)), "_h", BITS, keys, [], "_pos")
    # tasks of a few million draws, each draw shuffled once: both counts find theirs in place by position, and so does the join
    draws = df.sparkSession.range(0, n * trees, 1, max(df.sparkSession.sparkContext.defaultParallelism, -(-n * trees // DRAWS_A_TASK)))
    draws = draws.select((F.col("id") / F.lit(n)).cast("long").alias("t"), (F.col("id") % n).alias("j"))
    at = wide_hash(["t", "j"], seed) % n
    draws = draws.select(F.col("t").cast("int").alias("t"), at.alias("_pos")).repartition("_pos")
    if trees <= FEW_TREES:
        by_row = draws.groupBy("_pos").agg(*[F.count_if(F.col("t") == t).cast("int").alias(f"_c{t}") for t in range(trees)])
        return placed.join(by_row, "_pos", "left").withColumn(out, F.array(*[F.coalesce(F.col(f"_c{t}"), F.lit(0)) for t in range(trees)])).drop("_h", "_pos", *[f"_c{t}" for t in range(trees)])
    counts = draws.groupBy("_pos", "t").agg(F.count(F.lit(1)).cast("int").alias("c"))
    by_row = counts.groupBy("_pos").agg(F.map_from_entries(F.collect_list(F.struct("t", "c"))).alias("_c"))
    weights = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.coalesce(F.try_element_at(F.col("_c"), t), F.lit(0)))
    return placed.join(by_row, "_pos", "left").withColumn(out, F.coalesce(F.when(F.col("_c").isNotNull(), weights), F.array_repeat(F.lit(0), trees))).drop("_h", "_pos", "_c")


def goss_weight(df: DataFrame, abs_grad: Column, keys: Sequence[str], top_rate: float, other_rate: float, seed: int, round_: int = 0) -> Column:
    """W14 as an expression: 1 for the top share by gradient, rest / drawn for those drawn from the rest, 0 for the others.

    Gradients that agree to 2**-40 of the largest count as equal; ties go to the
    smaller hash. ``keys`` (integers) tell rows apart.
    """
    return goss_weight_hashed(df, abs_grad, wide_hash(keys, seed, round_), wide_hash(keys, seed + 1, round_), top_rate, other_rate)


def goss_weight_hashed(df: DataFrame, abs_grad: Column, h: Column, h2: Column, top_rate: float, other_rate: float) -> Column:
    """:func:`goss_weight` with the two hashes given: every count evaluates all three, so they had better be columns of written rows."""
    s = df.agg(F.count(F.lit(1)).alias("n"), F.max(abs_grad).alias("m")).first()
    n, scale = s["n"], float(1 << 40) / (s["m"] or 1.0)
    n_top, n_other = int(top_rate * n), int(other_rate * n)
    small_first = (F.lit(1 << 40) - F.round(abs_grad * scale)).cast("long")
    v, t = cut(df, small_first, n_top)
    top = small_first < F.lit(v)
    if t:
        hv, ht = cut(df.where(small_first == F.lit(v)), h, t)
        top = top | ((small_first == F.lit(v)) & ((h <= F.lit(hv)) if ht else (h < F.lit(hv))))
    dv, dt = cut(df.where(~top), h2, n_other)
    drawn = (h2 <= F.lit(dv)) if dt else (h2 < F.lit(dv))
    amp = (n - n_top) / min(n_other, n - n_top) if n_other and n > n_top else 1.0
    return F.when(top, 1.0).when(drawn, float(amp)).otherwise(0.0)
