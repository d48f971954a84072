"""Classification metrics as aggregations.

All metrics derive from one grouped confusion aggregation
``groupBy(group..., label, prediction).agg(sum(weight))``: any number of folds,
models or configurations are scored in the same pass, and only the small
confusion table is windowed afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", labels: Sequence[int] = (0, 1, 2),
              group_cols: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Full (label x prediction) grid per group, zeros included."""
    group_cols = list(group_cols)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    counts = df.groupBy(*group_cols, F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.sum(w).alias("n")
    )
    lab = F.array(*[F.lit(int(x)) for x in labels])
    grid_src = counts.select(*group_cols).distinct() if group_cols else df.sparkSession.range(1).select()
    grid = grid_src.select(*group_cols, F.explode(lab).alias("label")).select(
        *group_cols, "label", F.explode(lab).alias("prediction")
    )
    out = grid.join(counts, [*group_cols, "label", "prediction"], "left").fillna(0.0, ["n"])
    return out


def confusion_normalised(cm: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Row-normalised confusion matrix (share of each true class)."""
    w = Window.partitionBy(*group_cols, "label")
    tot = F.sum("n").over(w)
    return cm.withColumn("share", F.when(tot > 0, F.col("n") / tot).otherwise(F.lit(0.0)))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def fbeta(p, r, beta: float):
    b2 = beta * beta
    return F.when((p + r) > 0, (1 + b2) * p * r / (b2 * p + r)).otherwise(F.lit(0.0))


def per_class(cm: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1, F2 and support per class; zero division -> 0."""
    group_cols = list(group_cols)
    tp = cm.where(F.col("label") == F.col("prediction")).select(*group_cols, F.col("label").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(*group_cols, F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    pp = cm.groupBy(*group_cols, F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    j = tp.join(sup, [*group_cols, "cls"]).join(pp, [*group_cols, "cls"])
    p = _safe_div(F.col("tp"), F.col("predicted"))
    r = _safe_div(F.col("tp"), F.col("support"))
    return j.select(
        *group_cols, F.col("cls").alias("label"), p.alias("precision"), r.alias("recall"),
        fbeta(p, r, 1.0).alias("f1"), fbeta(p, r, 2.0).alias("f2"), F.col("support"),
    )


def summary(cm: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro precision / recall / F1 / F2, weighted F1 / F2, per-class recalls."""
    group_cols = list(group_cols)
    pc = per_class(cm, group_cols)
    tot = F.sum("support")
    agg = pc.groupBy(*group_cols).agg(
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        F.avg("f2").alias("f2_macro"),
        _safe_div(F.sum(F.col("f1") * F.col("support")), tot).alias("f1_weighted"),
        _safe_div(F.sum(F.col("f2") * F.col("support")), tot).alias("f2_weighted"),
        *[F.max(F.when(F.col("label") == code, F.col("recall"))).alias(f"recall_{name.lower()}")
          for name, code in C.CLASS_TO_CODE.items()],
        # weighted recall = correct / total = accuracy
        _safe_div(F.sum(F.col("recall") * F.col("support")), tot).alias("accuracy"),
    )
    return agg


def fold_summary(metrics: DataFrame, key_cols: Sequence[str], cols: Sequence[str] = ("f2_macro", "f1_weighted")) -> DataFrame:
    """Mean and population std over folds (folds as rows), rounded to 4 places."""
    aggs = []
    for c in cols:
        aggs += [F.round(F.avg(c), 4).alias(f"{c}_mean"), F.round(F.stddev_pop(c), 4).alias(f"{c}_std")]
    return metrics.groupBy(*key_cols).agg(*aggs, F.count(F.lit(1)).alias("n_folds"))


def balanced_weights(df: DataFrame, label: str = "label", group_cols: Sequence[str] = ()) -> DataFrame:
    """N / (k * n_c) per class (per group)."""
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols, label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy(*group_cols)
    return counts.select(
        *group_cols, label, "n_c",
        (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("weight"),
    )


def log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15, class_weights: dict | None = None,
             group_cols: Sequence[str] = ()) -> DataFrame:
    """Multiclass log loss of a probability array; optional class weights."""
    p = F.greatest(F.least(F.element_at(F.col(prob), F.col(label) + 1), F.lit(1 - eps)), F.lit(eps))
    w = F.lit(1.0) if class_weights is None else X.class_weight(label, class_weights)
    return df.groupBy(*group_cols).agg((F.sum(-F.log(p) * w) / F.sum(w)).alias("log_loss"))


def focal_loss(df: DataFrame, label: str, prob: str, alpha: float = C.FOCAL_ALPHA, gamma: float = C.FOCAL_GAMMA,
               eps: float = 1e-15, group_cols: Sequence[str] = ()) -> DataFrame:
    """Mean focal loss -alpha (1-p)^gamma log p of the true-class probability."""
    p = F.greatest(F.least(F.element_at(F.col(prob), F.col(label) + 1), F.lit(1 - eps)), F.lit(eps))
    return df.groupBy(*group_cols).agg(F.avg(-alpha * F.pow(1 - p, gamma) * F.log(p)).alias("focal_loss"))


def binary_log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15) -> DataFrame:
    """Binary log loss; and MSE of the probability."""
    p = F.greatest(F.least(F.col(prob), F.lit(1 - eps)), F.lit(eps))
    y = F.col(label).cast("double")
    return df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
                  F.avg((y - F.col(prob)) * (y - F.col(prob))).alias("mse"))


def initial_scores(df: DataFrame, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Log prior per class (softmax init), its share, and logit of the class rate (binary init)."""
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols, label).agg(F.count(F.lit(1)).alias("n_c"))
    share = F.col("n_c") / F.sum("n_c").over(Window.partitionBy(*group_cols))
    return counts.select(
        *group_cols, label, "n_c", share.alias("prior"), F.log(share).alias("log_prior"),
        F.log(share / (1 - share)).alias("logit"),
    )


def impurity(df: DataFrame, label: str, group_cols: Sequence[str]) -> DataFrame:
    """Gini and entropy impurity per group, majority class (lowest code on ties)."""
    group_cols = list(group_cols)
    counts = df.groupBy(*group_cols, label).agg(F.count(F.lit(1)).alias("n_c"))
    p = F.col("n_c") / F.sum("n_c").over(Window.partitionBy(*group_cols))
    shares = counts.withColumn("p", p)
    return shares.groupBy(*group_cols).agg(
        F.sum("n_c").alias("n"),
        (1 - F.sum(F.col("p") * F.col("p"))).alias("gini"),
        (-F.sum(F.col("p") * F.log2("p"))).alias("entropy"),
        F.min_by(F.col(label), F.struct(-F.col("n_c"), F.col(label))).alias("majority"),
    )
