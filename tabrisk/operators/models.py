"""Models as distributed jobs (M1-M11) behind one registry.

Tree ensembles and the linear SVM are pyspark.ml estimators; the ordinal
regressions (linear, ridge, Huber) are solved from one aggregation of
weighted cross products per iteration (A31), shared by all that are fitted on
the same rows, and thresholded by W16; lasso uses
MLlib's elastic-net solver. Every model is fitted from a DataFrame with named
feature columns, a label and an optional weight column, and returns a
``prediction`` (int class) column on any DataFrame.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import linear


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


@dataclass
class Fitted:
    """A fitted model: ``predict`` adds the class, ``save`` writes what :func:`load_fitted` needs to a folder."""

    name: str
    predict: Callable[[DataFrame], DataFrame]
    info: dict
    save: Callable[[str], None] | None = None


def load_fitted(spark, path: str) -> Fitted:
    """A saved model; ``info`` has its feature columns and parameters."""
    info = json.loads(spark.read.json(f"{path}/info").first()["info"])
    if info["kind"] == "mllib":
        from pyspark.ml.util import DefaultParamsReader

        model = DefaultParamsReader.loadParamsInstance(f"{path}/model", spark.sparkContext)
        return Fitted(info["name"], _mllib_predict(model, info["features"]), info)
    if info["kind"] == "ordinal":
        return Fitted(info["name"], _ordinal_predict(info), info)
    if info["kind"] == "dummy":
        return Fitted(info["name"], _dummy_predict(info), info)
    if info["kind"] == "booster":
        from .boosting import Booster

        return Fitted(info["name"], Booster.load(spark, f"{path}/model").predict, info)
    if info["kind"] == "forest":
        from .forest import Forest

        return Fitted(info["name"], Forest.load(spark, f"{path}/model").predict, info)
    raise ValueError(f"unknown model kind: {info['kind']}")


def _saver(spark, info: dict, model=None) -> Callable[[str], None]:
    def save(path: str) -> None:
        if model is not None:
            model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame([(json.dumps(info, sort_keys=True),)], "info string").coalesce(1).write.mode("overwrite").json(f"{path}/info")

    return save


def _mllib_predict(model, features: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    def predict(df: DataFrame) -> DataFrame:
        out = model.transform(assemble(df, features))
        return out.withColumn("prediction", F.col("prediction").cast("int")).drop("features", "rawPrediction", "probability")

    return predict


def _ordinal_predict(info: dict) -> Callable[[DataFrame], DataFrame]:
    score = F.lit(info["intercept"]) + sum((F.lit(w) * F.col(c) for w, c in zip(info["coef"], info["features"])), F.lit(0.0))
    return lambda df: df.withColumn("prediction", X.threshold_classes(score, info["t1"], info["t2"]))


def _mllib(estimator_factory):
    def fit(train: DataFrame, features, label, weight, params) -> Fitted:
        est = estimator_factory(params)
        est = est.setFeaturesCol("features").setLabelCol(label)
        if weight is not None:
            if not est.hasParam("weightCol"):
                raise TypeError(f"{type(est).__name__} does not support row weights")
            est = est.setWeightCol(weight)
        model = est.fit(assemble(train, features))

        info = {"kind": "mllib", "name": type(est).__name__, "features": list(features), "params": params}
        return Fitted(type(est).__name__, _mllib_predict(model, features), info, _saver(train.sparkSession, info, model))

    return fit


def _dt(p):
    return DecisionTreeClassifier(impurity=p.get("criterion", "gini"), maxDepth=p.get("max_depth", 5),
                                  minInstancesPerNode=p.get("min_samples_leaf", 1), maxBins=p.get("max_bins", 64),
                                  seed=p.get("seed", 42))


def _rf(p):
    return RandomForestClassifier(numTrees=p.get("n_estimators", 50), maxDepth=p.get("max_depth", 8),
                                  featureSubsetStrategy=p.get("max_features", "sqrt"),
                                  subsamplingRate=p.get("subsample", 1.0), bootstrap=True, seed=p.get("seed", 42))


def _gbt_ovr(p):
    base = GBTClassifier(maxIter=p.get("n_estimators", 30), maxDepth=p.get("max_depth", 4),
                         stepSize=p.get("learning_rate", 0.1), subsamplingRate=p.get("subsample", 1.0), seed=p.get("seed", 42))
    return OneVsRest(classifier=base, parallelism=p.get("parallelism", 3))


def _svc_ovr(p):
    base = LinearSVC(regParam=p.get("reg", 0.01), maxIter=p.get("max_iter", 50), standardization=True)
    return OneVsRest(classifier=base, parallelism=p.get("parallelism", 3))


def _ordinal(kind: str):
    """Linear score fitted to the class code, then two thresholds chosen by W16."""
    return lambda train, features, label, weight, params: fit_ordinals(train, features, label, weight, [(kind, params)])[0]


def _solved(train: DataFrame, feats: list[str], label: str, weight: str | None, specs: Sequence[tuple[str, dict]]) -> list[tuple[float, np.ndarray]]:
    """Intercept and coefficients of each (kind, params). Least squares come from one pass of cross products for all of them
    (the ridge penalty is added to the matrix), Huber from one pass an iteration for all widths, lasso from MLlib."""
    out: list = [None] * len(specs)
    rows = train.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(feats)], F.col(label).cast("double").alias("_y"),
                        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"))
    if any(kind != "lasso" for kind, _ in specs):
        sums = linear.cross_products(rows, [(0.0, np.zeros(len(feats)), None)])[0]
        for i, (kind, p) in enumerate(specs):
            if kind != "lasso":
                out[i] = linear.solve_cross(sums, p.get("alpha", 0.0) if kind == "ridge" else 0.0)
    left = {i: p.get("iterations", 8) for i, (kind, p) in enumerate(specs) if kind == "huber"}
    while left := {i: n for i, n in left.items() if n > 0}:
        sums = linear.cross_products(rows, [(*out[i], specs[i][1].get("delta", 1.0)) for i in left])
        for i, s in zip(left, sums):
            out[i] = linear.solve_cross(s)
        left = {i: n - 1 for i, n in left.items()}
    for i, (kind, p) in enumerate(specs):
        if kind == "lasso":
            lr = LinearRegression(regParam=p.get("alpha", 0.01) / 2.0, elasticNetParam=1.0, standardization=False,
                                  featuresCol="features", labelCol=label, maxIter=p.get("max_iter", 100))
            if weight:
                lr = lr.setWeightCol(weight)
            m = lr.fit(assemble(train, feats))
            out[i] = (float(m.intercept), np.array(m.coefficients.toArray()))
    return out


def fit_ordinals(train: DataFrame, features: Sequence[str], label: str, weight: str | None, specs: Sequence[tuple[str, dict]]) -> list[Fitted]:
    """Ordinal regressions (kind, params) on the same rows; the passes over the rows are shared."""
    if unknown := {kind for kind, _ in specs} - {"linear", "ridge", "huber", "lasso"}:
        raise ValueError(sorted(unknown)[0])
    feats = list(features)
    solved = _solved(train, feats, label, weight, specs)
    scores = [F.lit(float(b)) + sum((F.lit(float(wi)) * F.col(c) for wi, c in zip(w, feats)), F.lit(0.0)) for b, w in solved]
    found = linear.threshold_searches(train, scores, label, weight)
    out = []
    for (kind, params), (b, w), (t1, t2) in zip(specs, solved, found):
        sparse = int(np.sum(np.abs(w) < 1e-4))
        info = {"kind": "ordinal", "name": kind, "features": feats, "intercept": float(b), "coef": [float(x) for x in w], "t1": t1, "t2": t2,
                "n_zero_coef": sparse, "params": params}
        out.append(Fitted(kind, _ordinal_predict(info), info, _saver(train.sparkSession, info)))
    return out


def _dummy(train: DataFrame, features, label, weight, params) -> Fitted:
    """M1: no features are used. ``strategy``: most_frequent or prior (the majority class, the lowest on ties;
    ``info`` has the class shares), or stratified (classes drawn by their shares with the seeded hash of ``key_cols``)."""
    counts = {int(r[label]): r["count"] for r in train.groupBy(label).count().collect()}  # one row a class
    total, major = sum(counts.values()), min(counts, key=lambda c: (-counts[c], c))
    strategy = params.get("strategy", "most_frequent")
    info = {"kind": "dummy", "name": "dummy", "features": [], "majority": major, "prior": {str(c): n / total for c, n in sorted(counts.items())}, "params": params}
    if strategy not in ("most_frequent", "prior", "stratified"):
        raise ValueError(f"unknown dummy strategy: {strategy}")
    return Fitted("dummy", _dummy_predict(info), info, _saver(train.sparkSession, info))


def _dummy_predict(info: dict) -> Callable[[DataFrame], DataFrame]:
    """The majority class, or with the stratified strategy the class whose part of the shares' sum the row's hash falls in."""
    if info["params"].get("strategy") != "stratified":
        return lambda df: df.withColumn("prediction", F.lit(int(info["majority"])))
    u = X.seeded_hash(info["params"]["key_cols"], info["params"].get("seed", 42)) / F.lit(float(X.HASH_SIZE))
    edges, at = [], 0.0
    for c, share in sorted((int(c), share) for c, share in info["prior"].items()):
        at += share
        edges.append((at, c))
    pick = F.lit(edges[-1][1])
    for edge, c in reversed(edges[:-1]):
        pick = F.when(u < edge, F.lit(c)).otherwise(pick)
    return lambda df: df.withColumn("prediction", pick.cast("int"))


# Registry key -> fit function (case-insensitive lookup).
REGISTRY: dict[str, Callable] = {
    "dummy": _dummy,
    "decision_tree": _mllib(_dt),
    "random_forest": _mllib(_rf),
    "gbt_ovr": _mllib(_gbt_ovr),
    "linear_svc_ovr": _mllib(_svc_ovr),
    "linear_ordinal": _ordinal("linear"),
    "ridge_ordinal": _ordinal("ridge"),
    "huber_ordinal": _ordinal("huber"),
    "lasso_ordinal": _ordinal("lasso"),
}

# Parameter spaces for random search.
PARAM_SPACES: dict[str, dict[str, list]] = {
    "dummy": {},
    "decision_tree": {"max_depth": [3, 5, 8, 10], "min_samples_leaf": [1, 5, 20], "criterion": ["gini", "entropy"]},
    "random_forest": {"n_estimators": [20, 50], "max_depth": [6, 8, 12], "max_features": ["sqrt", "log2"]},
    "gbt_ovr": {"n_estimators": [20, 40], "max_depth": [3, 4, 5], "learning_rate": [0.05, 0.1]},
    "linear_svc_ovr": {"reg": [0.001, 0.01, 0.1]},
    "linear_ordinal": {},
    "ridge_ordinal": {"alpha": [0.01, 0.1, 1.0, 10.0]},
    "huber_ordinal": {"delta": [0.5, 1.0, 1.5, 3.0]},
    "lasso_ordinal": {"alpha": [0.001, 0.01, 0.1]},
}


def get_model(key: str) -> Callable:
    k = key.strip().lower()
    if k not in REGISTRY:
        raise KeyError(f"unknown model '{key}'; known: {sorted(REGISTRY)}")
    return REGISTRY[k]


def fit_model(key: str, train: DataFrame, features: Sequence[str], label: str, weight: str | None = None,
              params: dict | None = None) -> Fitted:
    return get_model(key)(train, list(features), label, weight, params or {})


#: Registry keys of the ordinal regressions, which :func:`fit_models` fits together.
ORDINAL = {f"{kind}_ordinal": kind for kind in ("linear", "ridge", "huber", "lasso")}


def fit_models(specs: Sequence[tuple[str, dict]], train: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> list[Fitted]:
    """:func:`fit_model` for several (key, params) on the same rows."""
    if len(specs) > 1 and all(key in ORDINAL for key, _ in specs):
        return fit_ordinals(train, features, label, weight, [(ORDINAL[key], params) for key, params in specs])
    return [fit_model(key, train, features, label, weight, params) for key, params in specs]


# ------------------------------------------- trees grown by this library ---
def _no_bound(depth) -> int:
    """A depth limit; None and negative numbers mean none."""
    return 1_000_000 if depth is None or depth < 0 else int(depth)


def _boosted(preset: dict):
    """M5: the booster (M4) under a preset; ``class_weight="balanced"`` weighs classes unless the caller gives weights.

    ``params`` may name ``key_cols`` (integer columns that tell rows apart; needed for sampling and GOSS)
    and give the bin ``edges`` of the training rows, if several models share them.
    """

    def fit(train: DataFrame, features, label, weight, params) -> Fitted:
        from . import boosting, metrics

        p = {**preset, **params}
        keys, balanced, edges = p.pop("key_cols", ()), p.pop("class_weight", None) == "balanced", p.pop("edges", None)
        p["max_depth"] = _no_bound(p.get("max_depth", 6))
        if balanced and weight is None:
            train, weight = train.join(F.broadcast(metrics.balanced_weights(train, label).select(label, F.col("weight").alias("_balanced"))), label), "_balanced"
        booster = boosting.fit(train, features, label, boosting.Params(**p), weight=weight, keys=keys, edges=edges)
        info = {"kind": "booster", "name": "booster", "features": list(features), "params": {**p, "key_cols": list(keys)}}
        spark = train.sparkSession

        def save(path: str) -> None:
            booster.save(spark, f"{path}/model")
            _saver(spark, info)(path)

        return Fitted("booster", booster.predict, info, save)

    return fit


def _grown(preset: dict):
    """M2 / M3: exact trees grown in Spark (one, or a voting forest on bootstrap draws)."""

    def fit(train: DataFrame, features, label, weight, params) -> Fitted:
        from . import forest

        if weight is not None:
            raise TypeError("exact trees do not support row weights")
        p = {**preset, **params}
        keys = p.pop("key_cols", ())
        model = forest.fit(train, features, label, forest.Params(**p), keys=keys)
        info = {"kind": "forest", "name": "forest", "features": list(features), "params": {**p, "key_cols": list(keys)}}
        spark = train.sparkSession

        def save(path: str) -> None:
            model.save(spark, f"{path}/model")
            _saver(spark, info)(path)

        return Fitted("forest", model.predict, info, save)

    return fit


_LGBM = {"n_estimators": 300, "learning_rate": 0.05, "num_leaves": 63, "max_depth": None, "min_child_samples": 20, "class_weight": "balanced"}
#: M5: presets of the booster by name (fixed values).
PRESETS: dict[str, dict] = {
    "lgbm": {**_LGBM, "reg_lambda": 0.0},
    "hgb": {**_LGBM, "reg_lambda": 0.0},
    "xgb": {"n_estimators": 300, "learning_rate": 0.1, "max_depth": 6, "num_leaves": 64, "min_child_samples": 1, "reg_lambda": 1.0},
    "lgbm_scratch": {},
    "xgb_scratch": {},
    "xgb_scratch_goss": {"use_goss": True},
    "xgb_scratch_efb": {"use_efb": True},
    "xgb_scratch_goss_efb": {"use_goss": True, "use_efb": True},
    "histgb_goss": {"use_goss": True},
    "histgb_efb": {"use_efb": True},
    "histgb_goss_efb": {"use_goss": True, "use_efb": True},
}
REGISTRY |= {k: _boosted(v) for k, v in PRESETS.items()}
REGISTRY |= {
    "decision_tree_exact": _grown({}),
    "rf_scratch": _grown({"n_estimators": 50, "bootstrap": True}),
    "xgbrf": _grown({"n_estimators": 300, "max_depth": 8, "bootstrap": True, "max_features": 0.8}),
}
_SCRATCH_SPACE = {
    "n_estimators": [50, 100, 150], "learning_rate": [0.05, 0.1, 0.2], "max_depth": [3, 4, 5], "num_leaves": [15, 31], "min_child_samples": [20, 30, 50],
    "reg_lambda": [0.1, 1.0, 5.0, 10.0], "reg_alpha": [0.0, 0.1, 0.5, 1.0], "min_split_gain": [0.0, 0.01, 0.1], "subsample": [0.8, 1.0], "colsample_bytree": [0.8, 1.0],
}
PARAM_SPACES |= {k: _SCRATCH_SPACE for k in PRESETS}
PARAM_SPACES |= {
    "decision_tree_exact": {"max_depth": [3, 5, 10, 15, 20, None], "min_samples_split": [2, 5, 10, 20, 50], "min_samples_leaf": [1, 2, 5, 10, 20], "criterion": ["gini", "entropy"]},
    "rf_scratch": {
        "n_estimators": [20, 50, 80, 120], "max_depth": [None, 8, 15, 25, 35], "min_samples_split": [2, 4, 6, 8, 10, 15], "min_samples_leaf": [1, 2, 3, 4, 5, 10],
        "criterion": ["gini", "entropy"], "max_features": ["sqrt", "log2", 0.5, 0.7, 1.0], "bootstrap": [True, False],
    },
}
