"""Leaderboards, winners and result-table operators.

These run on metric tables (one row per model / config / fold), which are
small; the windows below partition by the natural grouping key where one
exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(cols: Sequence[str]) -> list[Column]:
    return [F.desc(c) for c in cols]


def leaderboard(df: DataFrame, sort_desc: Sequence[str], tie_cols: Sequence[str], top_k: int | None = None,
                group_cols: Sequence[str] = ()) -> DataFrame:
    """Rank 1..n by the sort keys (desc), ties broken by ``tie_cols`` asc; mark top-k."""
    w = Window.partitionBy(*group_cols).orderBy(*_desc(sort_desc), *tie_cols)
    out = df.withColumn("rank", F.row_number().over(w))
    if top_k is not None:
        out = out.withColumn("is_top", (F.col("rank") <= top_k).cast("int"))
    return out


def first_per_group(df: DataFrame, group_cols: Sequence[str], sort_desc: Sequence[str], tie_cols: Sequence[str]) -> DataFrame:
    """Best row per group after a multi-key sort."""
    w = Window.partitionBy(*group_cols).orderBy(*_desc(sort_desc), *tie_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_last(df: DataFrame, key_cols: Sequence[str], order_col: str) -> DataFrame:
    """Drop duplicates keeping the last row in ``order_col`` order (unique per key).

    ``max_by`` is map-side combined, so a key holding a third of the rows is
    reduced inside every partition before the shuffle (a keyed window would
    sort that key in one task)."""
    rest = [c for c in df.columns if c not in key_cols]
    agg = df.groupBy(*key_cols).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_last"))
    return agg.select(*key_cols, *[F.col(f"_last.{c}").alias(c) for c in rest])


def duplicated_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def best_candidate(df: DataFrame, keys_desc: Sequence[str], keys_asc: Sequence[str], tie_cols: Sequence[str]) -> DataFrame:
    """Single best row: lexicographic desc on ``keys_desc`` then asc on ``keys_asc``."""
    return df.orderBy(*_desc(keys_desc), *keys_asc, *tie_cols).limit(1)


def top_n(df: DataFrame, col: str, n: int, tie_cols: Sequence[str]) -> DataFrame:
    """N largest rows (TakeOrdered, no global sort)."""
    return df.orderBy(F.desc(col), *tie_cols).limit(n)


def pivot_mean(df: DataFrame, row: str, col: str, value: str, col_values: Sequence | None = None) -> DataFrame:
    """Pivot table of means."""
    g = df.groupBy(row)
    g = g.pivot(col, list(col_values)) if col_values is not None else g.pivot(col)
    return g.agg(F.avg(value))


def best_worst_exact(df: DataFrame, group_cols: Sequence[str], label_col: str, value: str) -> DataFrame:
    """A16 with deterministic ties: best = max value then smallest label; worst = min value then smallest label."""
    group_cols = list(group_cols)
    wb = Window.partitionBy(*group_cols).orderBy(F.desc(value), label_col)
    ww = Window.partitionBy(*group_cols).orderBy(F.asc(value), label_col)
    d = df.select(*group_cols, label_col, value).withColumn("_b", F.row_number().over(wb)).withColumn(
        "_w", F.row_number().over(ww)
    )
    return d.groupBy(*group_cols).agg(
        F.max(F.when(F.col("_b") == 1, F.col(label_col))).alias("best"),
        F.max(value).alias("best_value"),
        F.max(F.when(F.col("_w") == 1, F.col(label_col))).alias("worst"),
        F.min(value).alias("worst_value"),
    ).withColumn("value_range", F.col("best_value") - F.col("worst_value")).withColumn(
        "impact_pct", F.when(F.col("worst_value") != 0, (F.col("best_value") - F.col("worst_value")) * 100.0 / F.col("worst_value"))
    )


def delta_vs_baseline(df: DataFrame, group_cols: Sequence[str], variant_col: str, baseline: str, value: str) -> DataFrame:
    """Delta and relative improvement % against the baseline row of each group (window, no cross join)."""
    w = Window.partitionBy(*group_cols)
    base = F.max(F.when(F.col(variant_col) == F.lit(baseline), F.col(value))).over(w)
    return df.withColumn("baseline_value", base).withColumn("delta", F.col(value) - F.col("baseline_value")).withColumn(
        "improvement_pct", F.when(F.col("baseline_value") != 0, F.col("delta") * 100.0 / F.col("baseline_value"))
    ).withColumn("beats_baseline", (F.col("delta") > 0).cast("int"))


def replace_rows(old: DataFrame, new: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Replace old-run rows by new ones with the same keys (anti-join + union)."""
    return old.join(new.select(*key_cols).distinct(), list(key_cols), "left_anti").unionByName(new)


def missing_expected(expected: DataFrame, available: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Expected keys not available."""
    return expected.join(available.select(*key_cols).distinct(), list(key_cols), "left_anti")


def row_alignment(raw: DataFrame, prepared: DataFrame, key_cols: Sequence[str], class_col: str) -> DataFrame:
    """Rows only in the raw table, only in the prepared one, or in both, and how many of these differ in class.

    Each side is counted by key first, so repeated keys cost one row a partition;
    a key with more rows on one side gives its surplus to that side.
    """
    keys = list(key_cols)

    def counted(df: DataFrame, n: str, c: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.array_sort(F.collect_set(class_col)).alias(c))

    a = counted(raw, "na", "ca")
    b = counted(prepared, "nb", "cb").select(*[F.col(k).alias(f"_r_{k}") for k in keys], "nb", "cb")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    j = a.join(b, cond, "full").select(F.coalesce("na", F.lit(0)).alias("na"), F.coalesce("nb", F.lit(0)).alias("nb"), "ca", "cb")
    both = F.least("na", "nb")
    side = F.explode(F.array(
        F.struct(F.lit("matched").alias("side"), both.alias("n"), F.when((both > 0) & (F.col("ca") != F.col("cb")), both).otherwise(F.lit(0).cast("long")).alias("d")),
        F.struct(F.lit("only_raw").alias("side"), (F.col("na") - both).alias("n"), F.lit(0).cast("long").alias("d")),
        F.struct(F.lit("only_prepared").alias("side"), (F.col("nb") - both).alias("n"), F.lit(0).cast("long").alias("d")),
    ))
    out = j.select(side.alias("x")).groupBy("x.side").agg(F.sum("x.n").alias("n"), F.sum("x.d").alias("n_class_differs"))
    return out.where(F.col("n") > 0)
