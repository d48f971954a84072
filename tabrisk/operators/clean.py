"""Cleaning with fitted statistics (P3-P9) and the common fit/transform flow.

Fitted statistics live in a *parameter DataFrame*: one row per group (for
example per CV fold), so that the statistics of every fold come out of one
aggregation and no validation row can reach them. ``attach_params`` puts them
next to the rows: literals when there is one group, a broadcast join on the
group key (row count checked) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from ..session import drop_rows, keep_rows
from .order import (exact_quantiles, join_small, local_df, materialize_small, quantile_name, quantiles_from_counts,
                    reduced_counts, to_long)


def med(c: str) -> str:
    return f"med__{c}"


def apply_sentinel(df: DataFrame, col: str = "elevation_m", sentinel: float = C.ELEVATION_SENTINEL) -> DataFrame:
    """P3."""
    return df.withColumn(col, X.null_sentinel(col, sentinel))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to double, unparsable -> NULL."""
    return df.select(*[X.to_double(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def attach_params(rows: DataFrame, params: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Bring fitted parameters next to the rows they apply to."""
    group_cols = list(group_cols)
    if not group_cols:
        got = params.limit(2).collect()
        if len(got) != 1:
            raise ValueError("an ungrouped parameter table must have exactly one row")
        row = got[0].asDict()
        return rows.select("*", *[F.lit(v).alias(k) for k, v in row.items()])
    return join_small(rows, params, group_cols)


def drop_params(df: DataFrame, params: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in params.columns if c not in group_cols])


def fit_medians(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """A1 medians per group as one parameter row per group."""
    keys = list(group_cols)
    q = exact_quantiles(df, cols, [0.5], keys)
    if keys:
        return _wide(q, keys, {"q_0_5": med}, cols)
    return _wide(q.withColumn("_all", F.lit(0)), ["_all"], {"q_0_5": med}, cols).drop("_all")


def _wide(q: DataFrame, group_cols: list[str], rename: dict, columns: Sequence[str]) -> DataFrame:
    """(group, feature, q_*) rows -> one row per group with a column per statistic.

    ``q`` holds groups x features rows; it is pivoted on the driver."""
    from pyspark.sql import types as T

    rows = q.collect()
    out: dict = {}
    for r in rows:
        key = tuple(r[g] for g in group_cols)
        d = out.setdefault(key, {})
        for qcol, namer in rename.items():
            d[namer(r["feature"])] = r[qcol]
    names = [namer(c) for namer in rename.values() for c in columns]
    fields = [q.schema[g] for g in group_cols] + [T.StructField(n, T.DoubleType()) for n in names]
    data = [(*key, *[d.get(n) for n in names]) for key, d in out.items()]
    return local_df(q.sparkSession, data, T.StructType(fields))


def fit_common(df: DataFrame, cfg: C.PrepConfig | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """T1 fit: medians of the numeric columns, p10 of elevation (G4), p95 of the
    median-imputed proximity (clip). Input rows carry raw columns; the sentinel
    is applied here. Returns the parameter table (one row per group).

    Every statistic, including the quantile of the imputed column (non-null
    counts + the NULL count placed at the median), comes from counts of values:
    without groups from :func:`order.reduced_counts`, else from one pass that
    counts by (group, feature, value), NULLs included."""
    cfg = cfg or C.PrepConfig()
    user_groups = list(group_cols)
    if not user_groups:
        raw = apply_sentinel(df.select(*C.NUMERIC_COLS))
        nn, empty = reduced_counts(raw, C.NUMERIC_COLS, _PROBS, imputed=(_CLIPPED, cfg.clip_upper_q))
        filled = [(0, empty[None, _CLIPPED])]
        return _params_from_counts(nn.withColumn("_all", F.lit(0)), filled, "_all", cfg).drop("_all")
    raw = apply_sentinel(df.select(*user_groups, *C.NUMERIC_COLS))
    long = to_long(raw, C.NUMERIC_COLS, user_groups, drop_nulls=False)
    counts = materialize_small(long.groupBy(*user_groups, "feature", "value").agg(F.count(F.lit(1)).alias("cnt")))
    nn = counts.where(F.col("value").isNotNull())
    q = quantiles_from_counts(nn, [*user_groups, "feature"], _PROBS)
    params = _wide(q, user_groups, {"q_0_5": med}, C.NUMERIC_COLS)
    elev = _wide(q.where(F.col("feature") == "elevation_m"), user_groups, {"q_0_1": lambda c: "elev_low"}, ["elevation_m"])
    nulls = counts.where(F.col("value").isNull() & (F.col("feature") == _CLIPPED)).select(*user_groups, "cnt")
    filled = params.select(*user_groups, F.lit(_CLIPPED).alias("feature"), F.col(med(_CLIPPED)).alias("value")).join(nulls, user_groups)
    imputed = nn.where(F.col("feature") == _CLIPPED).unionByName(filled)
    imputed = imputed.groupBy(*user_groups, "feature", "value").agg(F.sum("cnt").alias("cnt"))
    q95 = quantiles_from_counts(imputed, [*user_groups, "feature"], [cfg.clip_upper_q])
    clip = _wide(q95, user_groups, {quantile_name(cfg.clip_upper_q): lambda c: "clip_upper"}, [_CLIPPED])
    return materialize_small(params.join(elev, user_groups, "left").join(clip, user_groups, "left"))


#: The column that is clipped, and the quantiles that medians and the low elevation are taken from.
_CLIPPED, _PROBS = "storm_drain_proximity_m", [0.5, C.ELEV_LOW_QUANTILE]


def _params_from_counts(nn: DataFrame, nulls: Sequence[tuple[int, int]], key: str, cfg: C.PrepConfig) -> DataFrame:
    """The parameter row of each ``key`` from its (feature, value, cnt) rows and its (key, number of NULLs of the clipped column)."""
    nn = keep_rows(nn)
    q = quantiles_from_counts(nn, [key, "feature"], _PROBS)
    params = _wide(q, [key], {"q_0_5": med}, C.NUMERIC_COLS)
    elev = _wide(q.where(F.col("feature") == "elevation_m"), [key], {"q_0_1": lambda c: "elev_low"}, ["elevation_m"])
    # imputed values = non-null ones and the nulls at the median
    empty = local_df(nn.sparkSession, [r for r in nulls if r[1]], f"{key} int, cnt long")
    filled = params.select(key, F.lit(_CLIPPED).alias("feature"), F.col(med(_CLIPPED)).alias("value")).join(empty, key)
    imputed = nn.where(F.col("feature") == _CLIPPED).unionByName(filled)
    imputed = imputed.groupBy(key, "feature", "value").agg(F.sum("cnt").alias("cnt"))
    q95 = quantiles_from_counts(imputed, [key, "feature"], [cfg.clip_upper_q])
    clip = _wide(q95, [key], {quantile_name(cfg.clip_upper_q): lambda c: "clip_upper"}, [_CLIPPED])
    drop_rows(nn)
    return materialize_small(params.join(elev, [key], "left").join(clip, [key], "left"))


def fit_common_folds(df: DataFrame, fold_col: str, k: int, cfg: C.PrepConfig | None = None) -> DataFrame:
    """T1 fit for every fold of a k-fold assignment in one pass over the rows.

    Same parameters as ``fit_common`` on each fold's training rows, but rows
    are never copied per fold: each fold's training counts are total - own
    (:func:`order.reduced_counts`). Output keyed by ``fold_col``."""
    cfg = cfg or C.PrepConfig()
    raw = apply_sentinel(df.select(F.col(fold_col).cast("int").alias(fold_col), *C.NUMERIC_COLS))
    train, nulls = reduced_counts(raw, C.NUMERIC_COLS, _PROBS, fold_col, k, imputed=(_CLIPPED, cfg.clip_upper_q))
    return _params_from_counts(train, [(f, nulls[f, _CLIPPED]) for f in range(k)], fold_col, cfg)


def impute(df: DataFrame, numeric_cols=C.NUMERIC_COLS, categorical_cols=C.CATEGORICAL_COLS,
           fill: str = C.UNKNOWN_CATEGORY) -> DataFrame:
    """P7 + P8: numeric NULL -> fitted median (column ``med__<c>`` present), categorical -> 'Unknown'."""
    out = df
    for c in numeric_cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(med(c)).cast("double")))
    for c in categorical_cols:
        if c in df.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(fill)))
    return out


def clip_proximity(df: DataFrame, col: str = "storm_drain_proximity_m") -> DataFrame:
    """Upper clip at the fitted quantile; the lower bound (own minimum) has no effect."""
    return df.withColumn(col, X.clip_upper(col, F.col("clip_upper")))
