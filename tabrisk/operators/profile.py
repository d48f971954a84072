"""Profiling aggregates (A3-A18). Each is one or two aggregations whose result
is small (per column / per group); nothing is collected row-wise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from ..session import cut_lineage
from .order import exact_quantiles, join_small, ranked_counts, to_long


def missing_report(df: DataFrame, cols: Sequence[str], only_missing: bool = True) -> DataFrame:
    """A3: missing count and percentage per column (one pass), sorted desc."""
    n = F.count(F.lit(1))
    agg = df.agg(n.alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot(["_n"], list(cols), "feature", "n_missing")
    long = long.select("feature", "n_missing", (F.col("n_missing") * 100.0 / F.col("_n")).alias("pct_missing"))
    if only_missing:
        long = long.where(F.col("n_missing") > 0)
    return long


def missing_rate_by(df: DataFrame, group_col: str, cols: Sequence[str], min_rate: float | None = None) -> DataFrame:
    """A4: missing rate per (group, feature); optional HAVING rate > min_rate."""
    agg = df.groupBy(group_col).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    long = agg.unpivot([group_col], list(cols), "feature", "missing_rate")
    if min_rate is not None:
        long = long.where(F.col("missing_rate") > F.lit(min_rate))
    return long


def describe(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """A5: count, mean, sample std, min, exact quartiles, max per (group, feature)."""
    group_cols = list(group_cols)
    long = to_long(df, cols, group_cols)
    moments = long.groupBy(*group_cols, "feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], group_cols).drop("n")
    return moments.join(q, [*group_cols, "feature"])


def skewness(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """A6 + P29: bias-corrected sample skewness (pandas / DuckDB definition)
    from Spark's population skewness: G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    group_cols = list(group_cols)
    long = to_long(df, cols, group_cols)
    agg = long.groupBy(*group_cols, "feature").agg(F.count("value").alias("n"), F.skewness("value").alias("g1"))
    sk = F.when(F.col("n") > 2, F.col("g1") * F.sqrt(F.col("n") * (F.col("n") - 1)) / (F.col("n") - 2))
    return agg.select(*group_cols, "feature", sk.alias("skew")).withColumn("severity", X.skew_severity("skew"))


def skew_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and max absolute skew of a table."""
    s = skewness(df, cols)
    return s.agg(F.avg(F.abs("skew")).alias("mean_abs_skew"), F.max(F.abs("skew")).alias("max_abs_skew"))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson matrix (upper triangle incl. diagonal) in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}||{b}") for a, b in pairs])
    long = agg.unpivot([], [f"{a}||{b}" for a, b in pairs], "pair", "corr")
    parts = F.split("pair", r"\|\|")
    return long.select(parts[0].alias("col_a"), parts[1].alias("col_b"), "corr")


def target_correlation(df: DataFrame, cols: Sequence[str], target: str, flag: float = C.CORR_FLAG) -> DataFrame:
    """Correlation of each feature with the target, ranked by absolute value."""
    agg = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    long = agg.unpivot([], list(cols), "feature", "corr")
    w = Window.orderBy(F.desc(F.abs("corr")), "feature")
    return long.select(
        "feature", "corr", F.abs("corr").alias("abs_corr"), (F.abs("corr") > flag).cast("int").alias("strong"),
        F.row_number().over(w).alias("rank"),
    )


def spearman_target(df: DataFrame, cols: Sequence[str], target: str, top: int = 10) -> DataFrame:
    """Spearman rho of each feature with the target on pairwise-complete rows, its two-sided p-value, its place by
    absolute rho (ties by name) and whether that is among the first ``top``.

    Rows are counted once by (column, value, target); average ranks (W1b) of
    values and targets come from that table, and rho is the Pearson correlation
    of the ranks weighted by its counts, so no row meets a rank table. ``t_stat``
    has n-2 degrees of freedom.
    """
    long = to_long(df.select(*cols, F.col(target).cast("double").alias("_y")).where(F.col("_y").isNotNull()), cols, ["_y"])
    counts = cut_lineage(long.groupBy("feature", "value", "_y").agg(F.count(F.lit(1)).alias("cnt")))

    def centred(col: str, out: str) -> DataFrame:
        """Average rank less its mean (n + 1) / 2, per feature and distinct value."""
        r = ranked_counts(counts.groupBy("feature", col).agg(F.sum("cnt").alias("cnt")), col, ["feature"])
        return r.select("feature", col, (F.col("before") + (F.col("cnt") - F.col("n")) / 2.0).alias(out))

    r = join_small(join_small(counts, cut_lineage(centred("value", "rx")), ["feature", "value"]), cut_lineage(centred("_y", "ry")), ["feature", "_y"])
    rx, ry, w = F.col("rx"), F.col("ry"), F.col("cnt")
    out = r.groupBy("feature").agg(
        (F.sum(w * rx * ry) / F.sqrt(F.sum(w * rx * rx) * F.sum(w * ry * ry))).alias("rho"), F.sum(w).alias("n")
    )
    t = F.col("rho") * F.sqrt((F.col("n") - 2) / (1.0 - F.col("rho") * F.col("rho")))
    out = cut_lineage(out.withColumn("t_stat", t).withColumn("abs_rho", F.abs("rho")))  # a row a feature
    p = X.student_t_two_sided(F.col("t_stat"), F.col("n") - 2)
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("abs_rho"), "feature"))
    return out.withColumn("p_value", p).withColumn("place", place).withColumn("in_top", (F.col("place") <= top).cast("int"))


def crosstab(df: DataFrame, row: str, colname: str, normalize: str = "index") -> DataFrame:
    """Long-form crosstab with counts and row- or column-normalised shares."""
    counts = df.groupBy(row, colname).agg(F.count(F.lit(1)).alias("n"))
    key = row if normalize == "index" else colname
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(key)))


def cardinality(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """A10: distinct count and missing count per categorical column (one pass)."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    aggs = []
    for c in cols:
        aggs += [distinct(F.col(c)).alias(f"{c}__d"), F.count_if(F.col(c).isNull()).alias(f"{c}__m")]
    agg = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__d").alias("n_distinct"), F.col(f"{c}__m").alias("n_missing"))
        for c in cols
    ])).alias("s")
    return agg.select(rows).select("s.*")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: value counts of every categorical column (NULL counted as a value)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select("s.*")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def tukey_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, fences, outlier count and share per column."""
    q = exact_quantiles(df, cols, [0.25, 0.75]).withColumnRenamed("q_0_25", "q1").withColumnRenamed("q_0_75", "q3")
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("lower", F.col("q1") - k * F.col("iqr")).withColumn("upper", F.col("q3") + k * F.col("iqr"))
    long = to_long(df, cols)
    flagged = join_small(long, q.select("feature", "lower", "upper"), ["feature"])
    out = flagged.groupBy("feature").agg(
        F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("n_outliers"),
        F.count(F.lit(1)).alias("n_valid"),
    )
    return q.join(out, "feature").withColumn("outlier_share", F.col("n_outliers") / F.col("n_valid"))


def outlier_class_mix(df: DataFrame, cols: Sequence[str], class_col: str, k: float = 1.5) -> DataFrame:
    """Class distribution among the Tukey outliers of each column."""
    q = exact_quantiles(df, cols, [0.25, 0.75])
    q = q.select("feature", (F.col("q_0_25") - k * (F.col("q_0_75") - F.col("q_0_25"))).alias("lower"),
                 (F.col("q_0_75") + k * (F.col("q_0_75") - F.col("q_0_25"))).alias("upper"))
    long = join_small(to_long(df, cols, [class_col]), q, ["feature"])
    out = long.where((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
    counts = out.groupBy("feature", class_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("feature")))


def grouped_stats(df: DataFrame, cols: Sequence[str], group_col: str) -> DataFrame:
    """Mean, exact median, sample std, min, max per (group, feature)."""
    long = to_long(df, cols, [group_col])
    m = long.groupBy(group_col, "feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    med = exact_quantiles(df, cols, [0.5], [group_col]).select(group_col, "feature", F.col("q_0_5").alias("median"))
    return m.join(med, [group_col, "feature"])


def bin_share_by_class(df: DataFrame, bin_col: str, class_col: str) -> DataFrame:
    """Share of each bin inside each class."""
    counts = df.groupBy(class_col, bin_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(class_col)))


def histogram(df: DataFrame, col: str, bins: int = 50, group_cols: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram between the global min and max (numpy edges;
    the maximum falls into the last bin)."""
    group_cols = list(group_cols)
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).collect()[0]
    lo, hi = mm["lo"], mm["hi"]
    width = (hi - lo) / bins if hi is not None and hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    out = df.where(F.col(col).isNotNull()).groupBy(*group_cols, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("bin_lo", F.lit(lo) + F.col("bin") * F.lit(width)).withColumn(
        "bin_hi", F.lit(lo) + (F.col("bin") + 1) * F.lit(width)
    )


def boxplot_stats(df: DataFrame, col: str, group_col: str, k: float = 1.5) -> DataFrame:
    """Quartiles, median and whiskers (most extreme values inside the fences) per group."""
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], [group_col])
    q = q.withColumn("lf", F.col("q_0_25") - k * (F.col("q_0_75") - F.col("q_0_25"))).withColumn(
        "uf", F.col("q_0_75") + k * (F.col("q_0_75") - F.col("q_0_25"))
    )
    j = join_small(df.select(group_col, col).where(F.col(col).isNotNull()), q.select(group_col, "lf", "uf"), [group_col])
    inside = (F.col(col) >= F.col("lf")) & (F.col(col) <= F.col("uf"))
    wh = j.groupBy(group_col).agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_fliers"),
    )
    return q.drop("lf", "uf").join(wh, group_col)
