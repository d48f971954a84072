"""Fitted encoders and scalers.

Fit results are small tables keyed by (group, feature, value): ordinal codes
are exact positions of the distinct fitted values, joined back on the value;
nothing collects a category list into one row except one-hot, whose output
columns must be known to the driver anyway.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from ..session import cut_lineage
from .order import exact_quantiles, join_small, local_df, materialize_small, positions



def fit_ordinal(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """T3 fit: categories sorted ascending -> 0..k-1, per (group, feature).

    Codes are exact positions in the distinct (group, feature, value) table,
    from a range-partitioned ranking."""
    group_cols = list(group_cols)
    long = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("s")).select(*group_cols, "s.*").where(F.col("value").isNotNull()).distinct()
    return codes_from_values(long, group_cols)


def codes_from_values(long: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Codes 0..k-1 of the sorted distinct values of a (group..., feature, value) table."""
    group_cols = list(group_cols)
    long = long.select(*group_cols, "feature", "value").distinct()
    return materialize_small(positions(long, ["value"], [*group_cols, "feature"], "code"))


def apply_ordinal(df: DataFrame, codes: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = (),
                  unknown: int = -1, suffix: str = "") -> DataFrame:
    """T3 transform: value -> code as double; unseen or NULL -> ``unknown``."""
    group_cols = list(group_cols)
    out = df
    for c in cols:
        m = codes.where(F.col("feature") == c).select(*group_cols, F.col("value").alias(c), F.col("code").alias(f"_code_{c}"))
        out = join_small(out, m, [*group_cols, c], "left")
        out = out.withColumn(c + suffix, F.coalesce(F.col(f"_code_{c}"), F.lit(unknown)).cast("double")).drop(f"_code_{c}")
    return out


def ordinal_with_order(df: DataFrame, col: str, order: Sequence[str] = C.SOIL_ORDER, unknown: int = -1) -> DataFrame:
    """T4: given category order, unseen -> -1."""
    code = X.map_values(col, {v: i for i, v in enumerate(order)}, unknown)
    return df.withColumn(col, code.cast("double"))


#: Categories of one column that become columns of their own.
MAX_CATEGORIES = 1_000


def fit_onehot(df: DataFrame, cols: Sequence[str], most: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """T5 fit: sorted categories per column (the output column list lives on the driver).

    A column with more than ``most`` categories is refused before they are
    collected; :func:`hash_categories` takes such columns.
    """
    codes = fit_ordinal(df, cols)
    sizes = {r["feature"]: r["n"] for r in codes.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a column
    if many := {c: n for c, n in sizes.items() if n > most}:
        raise ValueError(f"too many categories for columns of their own (at most {most}): {many}")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in codes.orderBy("feature", "code").collect():
        out[r["feature"]].append(r["value"])
    return out


def apply_onehot(df: DataFrame, categories: dict[str, list[str]], drop_source: bool = True) -> DataFrame:
    """T5 transform: ``<col>_<value>`` indicator columns; unseen -> all zeros."""
    new = []
    for c, vals in categories.items():
        for v in vals:
            new.append(F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}"))
    out = df.select("*", *new)
    return out.drop(*categories.keys()) if drop_source else out


def hash_categories(df: DataFrame, cols: Sequence[str], size: int = 1 << 18, out: str = "hashed") -> DataFrame:
    """T5 for any number of categories: a sparse vector of ``size`` places, a one where a column's value hashes to."""
    from pyspark.ml.feature import FeatureHasher

    return FeatureHasher(inputCols=list(cols), outputCol=out, numFeatures=size, categoricalCols=list(cols)).transform(df)


def fit_robust(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """T8 fit: exact median and IQR per column; zero range -> 1."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], group_cols)
    iqr = F.col("q_0_75") - F.col("q_0_25")
    return materialize_small(q.select(*group_cols, "feature", F.col("q_0_5").alias("center"),
                                      F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias("scale")))


def apply_robust(df: DataFrame, params: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """T8 transform: (x - median) / IQR with the fitted parameters."""
    group_cols = list(group_cols)
    if not group_cols:
        got = {r["feature"]: (r["center"], r["scale"]) for r in params.collect()}
        return df.select(*[((F.col(c) - F.lit(got[c][0])) / F.lit(got[c][1])).alias(c) if c in got else F.col(c)
                           for c in df.columns])
    out = df
    for c in cols:
        p = params.where(F.col("feature") == c).select(*group_cols, F.col("center").alias("_ce"), F.col("scale").alias("_sc"))
        out = join_small(out, p, group_cols).withColumn(c, (F.col(c) - F.col("_ce")) / F.col("_sc")).drop("_ce", "_sc")
    return out


def fit_yeo_johnson(df: DataFrame, cols: Sequence[str], grid: int = 17, tol: float = 1e-7) -> dict[str, float]:
    """Maximum-likelihood lambda per column, without bounds on lambda.

    The likelihood depends on the (value -> count) table of a column only, which
    is checkpointed once. Each pass is one aggregation over it, for a grid of
    lambdas of every column at once: while the best lambda lies at an end of its
    grid the grid moves on and doubles; then it shrinks around the best one until
    its step is under ``tol``. Variances are taken about the image of the
    column's mean, so no digits cancel. Columns without spread get 1 (identity).
    """
    from .order import to_long

    counts = cut_lineage(to_long(df, cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt")))
    x, w = F.col("value"), F.col("cnt")
    base = {r["feature"]: r for r in counts.groupBy("feature").agg(
        F.sum(w).alias("n"), (F.sum(x * w) / F.sum(w)).alias("mean"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.sum(w * F.signum(x) * F.log1p(F.abs(x))).alias("slog"),
    ).collect()}  # one row a column
    out = {c: 1.0 for c in cols}
    spans = {c: (-2.0, 2.0) for c in cols if c in base and base[c]["lo"] < base[c]["hi"]}
    while spans:
        lams = {c: [a + i * (b - a) / (grid - 1) for i in range(grid)] for c, (a, b) in spans.items()}
        # the grid is a table of columns x grid rows: one simple expression, compiled once for all passes
        points = local_df(df.sparkSession, [(c, i, v, _yj(base[c]["mean"], v)) for c, vs in lams.items() for i, v in enumerate(vs)],
                          "feature string, i int, lam double, mid double")
        d = X.yeo_johnson(x, F.col("lam")) - F.col("mid")
        rows = counts.join(F.broadcast(points), "feature").groupBy("feature", "i").agg(F.sum(w * d).alias("s"), F.sum(w * d * d).alias("q")).collect()
        sums = {(r["feature"], r["i"]): (r["s"], r["q"]) for r in rows}
        for c, v in lams.items():
            n = base[c]["n"]
            var = [(sums[c, i][1] - sums[c, i][0] ** 2 / n) / n for i in range(grid)]
            ll = [-n / 2.0 * math.log(s) + (lam - 1.0) * base[c]["slog"] if s > 0 and math.isfinite(s) else -math.inf for s, lam in zip(var, v)]
            k = max(range(grid), key=lambda i: ll[i])
            step = v[1] - v[0]
            if k in (0, grid - 1) and step > 0.05 and math.isfinite(ll[k]):
                width = v[-1] - v[0]
                spans[c] = (v[k] - 2 * width, v[k] + step) if k == 0 else (v[k] - step, v[k] + 2 * width)
            elif step < tol or not math.isfinite(ll[k]):
                out[c] = v[k]
                del spans[c]
            else:
                spans[c] = (v[k] - step, v[k] + step)
    return out


def _yj(x: float, lam: float) -> float:
    """Yeo-Johnson of one number; infinite where it overflows (such a lambda is never the best)."""
    sign, t, k = (1.0, math.log1p(x), lam) if x >= 0 else (-1.0, math.log1p(-x), 2.0 - lam)
    if abs(k) < 1e-12:
        return sign * t
    return sign * math.inf if k * t > 700 else sign * math.expm1(k * t) / k


def fit_skew_transforms(df: DataFrame, cols: Sequence[str], threshold: float = C.SKEW_THRESHOLD) -> dict[str, float | None]:
    """Lambda for every column whose |bias-corrected skew| >= threshold, else None."""
    from .profile import skewness

    sk = {r["feature"]: r["skew"] for r in skewness(df, cols).collect()}
    skewed = [c for c in cols if sk.get(c) is not None and abs(sk[c]) >= threshold]
    lams = fit_yeo_johnson(df, skewed) if skewed else {}
    return {c: lams.get(c) for c in cols}


def apply_skew_transforms(df: DataFrame, lambdas: dict[str, float | None]) -> DataFrame:
    out = df
    for c, lam in lambdas.items():
        if lam is not None:
            out = out.withColumn(c, X.yeo_johnson(c, lam))
    return out
