"""Whole preparations (T1, T2, T9, T11) as fit / transform pairs.

``fit_*`` returns a small fitted-state object (parameter DataFrames keyed by
the optional group columns, e.g. ``fold_key``); ``transform_*`` applies it to
any rows carrying the same group columns. Fitting on the fold-long table with
``group_cols=["fold_key"]`` fits every fold in the same aggregations.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean, encode, features, labels


@dataclass
class TreePrep:
    params: DataFrame
    codes: DataFrame
    cfg: C.PrepConfig
    group_cols: list = field(default_factory=list)

    @property
    def feature_cols(self) -> list[str]:
        eng = [C.CORE_GROUP_COLS[g] for g in ("G1", "G2", "G3", "G4") if g in self.cfg.fe_groups]
        return C.NUMERIC_COLS + eng + C.CATEGORICAL_COLS


def _labelled(df: DataFrame) -> DataFrame:
    return df if C.LABEL_COL not in df.columns and C.TARGET_COL in df.columns else labels.with_risk_class(df)


def common_transform(df: DataFrame, params: DataFrame, cfg: C.PrepConfig, group_cols: Sequence[str] = ()) -> DataFrame:
    """T1 transform: target, sentinel, features, impute, clip. Rows without the label string keep the class that they have."""
    d = _labelled(df)
    d = clean.apply_sentinel(d)
    d = clean.attach_params(d, params, group_cols)
    d = features.core_features(d, cfg.fe_groups)
    d = clean.impute(d)
    d = clean.clip_proximity(d)
    return clean.drop_params(d, params, group_cols)


def fit_tree(df: DataFrame, cfg: C.PrepConfig | None = None, group_cols: Sequence[str] = ()) -> TreePrep:
    """T2 fit: common statistics + ordinal codes of the 'Unknown'-filled categoricals."""
    cfg = cfg or C.PrepConfig()
    group_cols = list(group_cols)
    params = clean.fit_common(df, cfg, group_cols)
    filled = df.select(*group_cols, *[F.coalesce(F.col(c), F.lit(C.UNKNOWN_CATEGORY)).alias(c) for c in C.CATEGORICAL_COLS])
    codes = encode.fit_ordinal(filled, C.CATEGORICAL_COLS, group_cols)
    return TreePrep(params, codes, cfg, group_cols)


def fit_tree_folds(df: DataFrame, fold_col: str, k: int, cfg: C.PrepConfig | None = None) -> dict[int, TreePrep]:
    """T2 fit for all k folds from one pass over the rows (no per-fold row copies):
    numeric statistics via ``clean.fit_common_folds``; category codes from the
    training-side (total - own fold) category counts."""
    from ..operators.order import fold_train_counts, materialize_small

    cfg = cfg or C.PrepConfig()
    params = clean.fit_common_folds(df, fold_col, k, cfg)
    long = df.select(F.col(fold_col).cast("int").alias(fold_col), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(C.UNKNOWN_CATEGORY)).alias("value"))
        for c in C.CATEGORICAL_COLS
    ])).alias("s")).select(fold_col, "s.*")
    counts = long.groupBy(fold_col, "feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    train = materialize_small(fold_train_counts(counts, fold_col, k, ["feature"]))
    codes = encode.codes_from_values(train, [fold_col])
    return {
        f: TreePrep(params.where(F.col(fold_col) == f).drop(fold_col), codes.where(F.col(fold_col) == f).drop(fold_col), cfg)
        for f in range(k)
    }


def transform_tree(df: DataFrame, prep: TreePrep, keep: Sequence[str] = ()) -> DataFrame:
    """T2 transform: numeric + engineered + ordinal codes + metadata (+ ``keep`` columns)."""
    d = common_transform(df, prep.params, prep.cfg, prep.group_cols)
    d = encode.apply_ordinal(d, prep.codes, C.CATEGORICAL_COLS, prep.group_cols)
    meta = ["risk_class", "risk_class_encoded", "latitude", "longitude"]
    cols = list(dict.fromkeys([*keep, *prep.group_cols, *prep.feature_cols, *meta]))
    return d.select(*cols)


@dataclass
class LinearPrep:
    params: DataFrame
    lambdas: dict
    onehot: dict
    codes: DataFrame | None
    scale: DataFrame | None
    cfg: C.PrepConfig
    feature_cols: list


def fit_linear(df: DataFrame, cfg: C.PrepConfig | None = None) -> LinearPrep:
    """T9 fit: T1, Yeo-Johnson on skewed columns (T7), soil order (T4), one-hot (T5)
    or ordinal (T3) for the other categoricals, robust scaler (T8)."""
    cfg = cfg or C.PrepConfig()
    from ..session import drop_rows, keep_rows

    params = clean.fit_common(df, cfg)
    # several fitting passes follow (skew, lambdas, categories, scaler): the rows are written once
    common = keep_rows(common_transform(df, params, cfg))
    prep = fit_linear_common(common, params, cfg)
    drop_rows(common)
    return prep


def _made(share: Callable[[tuple, Callable], object] | None, key: tuple, make: Callable):
    return share(key, make) if share else make()


def fit_linear_common(common: DataFrame, params: DataFrame, cfg: C.PrepConfig, share: Callable[[tuple, Callable], object] | None = None) -> LinearPrep:
    """T9 fit after T1: ``common`` has the fitting rows as :func:`common_transform` returns them, materialised.

    ``share(key, make)`` gives the value made before for the same rows and key, or makes it: lambdas, categories and
    codes of a column depend on the rows alone, so preparations with other steps or features may share them.
    """
    lambdas = {}
    if cfg.use_skew:
        eng_skew = [c for c in C.ENGINEERED_SKEW_COLS if c in common.columns]
        for cols in ([C.BASE_SKEW_COLS, eng_skew] if share else [C.BASE_SKEW_COLS + eng_skew]):
            if cols:
                lambdas |= _made(share, ("skew", tuple(cols), cfg.skew_threshold), lambda cols=cols: encode.fit_skew_transforms(common, cols, cfg.skew_threshold))
    d = encode.apply_skew_transforms(common, lambdas)
    d = encode.ordinal_with_order(d, "soil_group")
    onehot, codes = {}, None
    if cfg.use_ohe:
        onehot = _made(share, ("onehot",), lambda: encode.fit_onehot(common, C.OHE_COLS))
        d = encode.apply_onehot(d, onehot)
        cat_cols = ["soil_group"] + [f"{c}_{v}" for c, vs in onehot.items() for v in vs]
    else:
        codes = _made(share, ("codes",), lambda: encode.fit_ordinal(common, C.OHE_COLS))
        d = encode.apply_ordinal(d, codes, C.OHE_COLS)
        cat_cols = ["soil_group"] + C.OHE_COLS
    eng = [C.CORE_GROUP_COLS[g] for g in ("G1", "G2", "G3", "G4") if g in cfg.fe_groups]
    feature_cols = C.NUMERIC_COLS + eng + cat_cols
    scale = encode.fit_robust(d, feature_cols) if cfg.use_scale else None
    return LinearPrep(params, lambdas, onehot, codes, scale, cfg, feature_cols)


def transform_linear(df: DataFrame, prep: LinearPrep, keep: Sequence[str] = ()) -> DataFrame:
    return transform_linear_common(common_transform(df, prep.params, prep.cfg), prep, keep)


def transform_linear_common(common: DataFrame, prep: LinearPrep, keep: Sequence[str] = ()) -> DataFrame:
    """T9 transform after T1."""
    d = encode.apply_skew_transforms(common, prep.lambdas)
    d = encode.ordinal_with_order(d, "soil_group")
    if prep.cfg.use_ohe:
        d = encode.apply_onehot(d, prep.onehot)
    else:
        d = encode.apply_ordinal(d, prep.codes, C.OHE_COLS)
    if prep.scale is not None:
        d = encode.apply_robust(d, prep.scale, prep.feature_cols)
    meta = ["risk_class", "risk_class_encoded", "latitude", "longitude"]
    return d.select(*list(dict.fromkeys([*keep, *prep.feature_cols, *meta])))


def domain_transform(df: DataFrame, params: DataFrame) -> DataFrame:
    """T11 row part: domain groups G1-G3, G5, G6 on median-imputed rows (fitted medians)."""
    d = _labelled(df)
    d = clean.apply_sentinel(d)
    d = clean.attach_params(d, params)
    d = clean.impute(d, categorical_cols=[])
    d = clean.drop_params(d, params)
    return features.domain_row_features(d)
