"""Cross-validation, tuning and ablation flows.

Scoring uses one grouped confusion aggregation for every (config, model,
repeat, fold, role) at once: a fold's model scores its validation and its
training rows. For rules that are not fitted, the training side of a fold is
the sum of the other folds, so nothing is expanded k times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from ..operators import metrics
from ..operators.order import materialize_small

# Baseline rule models: (t1, t2) thresholds on rainfall intensity (P25).
RULE_MODELS = {
    "rain_20_50": (20.0, 50.0),
    "rain_25_90": (25.0, 90.0),
    "rain_30_60": (30.0, 60.0),
    "rain_40_80": (40.0, 80.0),
}


def rule_predictions(folds: DataFrame, score: str, label: str, models: dict = RULE_MODELS) -> DataFrame:
    """Score every row with every rule model (models exploded from a literal array)."""
    arr = F.array(*[F.struct(F.lit(k).alias("model"), F.lit(a).alias("t1"), F.lit(b).alias("t2")) for k, (a, b) in models.items()])
    d = folds.select("*", F.explode(arr).alias("_m")).select("*", "_m.model", "_m.t1", "_m.t2").drop("_m")
    return d.withColumn("prediction", X.threshold_classes(score, F.col("t1"), F.col("t2"))).withColumnRenamed(label, "label")


def cv_fold_metrics(preds: DataFrame, key_cols: Sequence[str] = ("model",), repeat_col: str = "repeat",
                    fold_col: str = "fold", weight: str | None = None) -> DataFrame:
    """Validation and train metrics per (keys, repeat, fold) from one confusion aggregation.

    ``weight`` names a column that says how many predictions a row stands for (:func:`fold_counts`).

    Predictions of fitted models carry ``role`` ('val' or 'train'): each fold's own
    model scores both its parts. Without ``role`` the rows are those of rules that
    nothing was fitted for; then the train part of a fold is all folds of its
    repeat but its own, which needs no row twice.
    """
    keys = [*key_cols, repeat_col, fold_col]
    if "role" in preds.columns:
        cm = metrics.confusion(preds, "label", "prediction", group_cols=[*keys, "role"], weight=weight)
        cm_val, cm_tr = (cm.where(F.col("role") == r).drop("role") for r in ("val", "train"))
    else:
        cm_val = metrics.confusion(preds, "label", "prediction", group_cols=keys, weight=weight)
        w = Window.partitionBy(*key_cols, repeat_col, "label", "prediction")
        cm_tr = cm_val.withColumn("n", F.sum("n").over(w) - F.col("n"))
    val = metrics.summary(cm_val, keys)
    tr = metrics.summary(cm_tr, keys).select(*keys, F.col("f2_macro").alias("train_f2_macro"))
    return val.join(tr, keys)


def cv_summary(fold_metrics: DataFrame, key_cols: Sequence[str] = ("model",)) -> DataFrame:
    """A22 + P28: mean / population std over folds, train-CV gap, overfit flag."""
    s = metrics.fold_summary(fold_metrics, key_cols, ("f2_macro", "f1_weighted", "recall_high", "train_f2_macro"))
    s = s.withColumn("gap", F.round(F.col("train_f2_macro_mean") - F.col("f2_macro_mean"), 4))
    return s.withColumn("overfit", X.overfit_flag("gap")).withColumn("overfit_risk", X.overfit_risk("gap"))


def per_class_cv(preds: DataFrame, key_cols: Sequence[str] = ("model",), repeat_col: str = "repeat",
                 fold_col: str = "fold") -> DataFrame:
    """Per-class precision / recall / F1 averaged over folds."""
    keys = [*key_cols, repeat_col, fold_col]
    pc = metrics.per_class(metrics.confusion(preds, "label", "prediction", group_cols=keys), keys)
    return pc.groupBy(*key_cols, "label").agg(
        F.round(F.avg("precision"), 4).alias("precision_mean"),
        F.round(F.avg("recall"), 4).alias("recall_mean"),
        F.round(F.avg("f1"), 4).alias("f1_mean"),
    )


def fold_predictions(part: DataFrame, fitted, fold: int, name: str) -> DataFrame:
    """Both parts of a fold scored by the fold's own model: model, repeat, fold, role, label, prediction."""
    role = F.when(F.col("fold") == fold, F.lit("val")).otherwise(F.lit("train"))
    scored = fitted.predict(part.withColumn("role", role))
    return scored.select(F.lit(name).alias("model"), "repeat", F.lit(fold).alias("fold"), "role", F.col("risk_class_encoded").alias("label"), "prediction")


def fold_counts(part: DataFrame, fitted, fold: int, name: str) -> DataFrame:
    """:func:`fold_predictions` counted (``n``): every row is scored once and none is written."""
    p = fold_predictions(part, fitted, fold, name)
    return materialize_small(p.groupBy(*p.columns).agg(F.count(F.lit(1)).alias("n")))


def fold_counts_of(part: DataFrame, fitted: Sequence, fold: int, names: Sequence[str], key: str) -> DataFrame:
    """:func:`fold_counts` of several models, numbered in ``key``: every row is read once and scored by all of them."""
    d = part.withColumn("role", F.when(F.col("fold") == fold, F.lit("val")).otherwise(F.lit("train")))
    for i, m in enumerate(fitted):
        d = m.predict(d).withColumnRenamed("prediction", f"_p{i}")
    preds = [f"_p{i}" for i in range(len(fitted))]
    counts = d.groupBy("repeat", "role", F.col("risk_class_encoded").alias("label"), *preds).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias(key), F.lit(x).alias("model"), F.col(p).alias("prediction")) for i, (x, p) in enumerate(zip(names, preds))]))
    long = counts.select("repeat", "role", "label", "n", each.alias("_e"))
    return materialize_small(long.groupBy(f"_e.{key}", "_e.model", "repeat", F.lit(fold).alias("fold"), "role", "label", "_e.prediction").agg(F.sum("n").alias("n")))


def candidates(space: dict[str, list], n_iter: int, seed: int) -> list[dict]:
    """Seeded random search over parameter lists; empty space -> one default candidate."""
    import random

    if not space:
        return [{}]
    rng = random.Random(seed)
    keys = sorted(space)
    out, seen = [], set()
    total = 1
    for k in keys:
        total *= len(space[k])
    while len(out) < min(n_iter, total):
        cand = tuple((k, rng.choice(space[k])) for k in keys)
        if cand not in seen:
            seen.add(cand)
            out.append(dict(cand))
    return out


def run_concurrently(spark: SparkSession, tasks: Sequence[Callable[[], object]], threads: int = 4) -> list:
    """Results of ``tasks`` (functions that start Spark jobs) in their own order, at most ``threads`` at a time.

    Each thread inherits the caller's job group and local properties and puts its
    jobs into a pool of its own, which a fair scheduler then shares out. The first
    error, in task order, is raised after all have ended.
    """
    if threads < 1:
        raise ValueError("at least one thread")
    if threads == 1 or len(tasks) < 2:
        return [t() for t in tasks]

    def one(i: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{i % threads}")
        return tasks[i]()

    with ThreadPoolExecutor(threads) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(one), i) for i in range(len(tasks))]
        wait(futures)
    return [f.result() for f in futures]


def winner(summary: DataFrame, key_col: str = "model") -> DataFrame:
    """Best candidate by (mean F2, mean F1w, mean High recall) desc, then std F2 asc."""
    return summary.orderBy(
        F.desc("f2_macro_mean"), F.desc("f1_weighted_mean"), F.desc("recall_high_mean"), F.asc("f2_macro_std"), key_col
    ).limit(1)


def experiment_table(summary: DataFrame, experiment: str, **tags: str) -> DataFrame:
    """Long-format experiment record rows (tags added as constant columns)."""
    extra = {"experiment": experiment, **tags}
    return summary.select(*[F.lit(v).alias(k) for k, v in extra.items() if k not in summary.columns], "*")


def class_weight_column(df: DataFrame, label: str, strategy: str, weights: dict | None = None) -> DataFrame:
    """Add ``weight`` for the imbalance strategy (none / balanced / weighted)."""
    if strategy == "none":
        return df.withColumn("weight", F.lit(1.0))
    if strategy == "balanced":
        bw = metrics.balanced_weights(df, label).select(label, "weight")
        # one row per class: a fixed, tiny broadcast
        return df.join(F.broadcast(bw), label, "left")
    if strategy == "weighted":
        w = weights or C.DEFAULT_CLASS_WEIGHTS
        if any(float(v) <= 0 for v in w.values()):
            raise ValueError("class weights must be positive")
        return df.withColumn("weight", X.class_weight(label, w))
    if strategy == "smote":
        raise ValueError("smote rebalances rows; use operators.balance.smote")
    raise ValueError(f"unknown imbalance strategy: {strategy}")
