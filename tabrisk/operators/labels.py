"""Labels: class derivation (P1, P2), validation, distribution (A2), tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from .order import local_df


def with_risk_class(
    df: DataFrame,
    label_col: str = C.LABEL_COL,
    rules=C.LABEL_RULES,
    default: str = C.DEFAULT_CLASS,
    mapping: dict = C.CLASS_TO_CODE,
) -> DataFrame:
    """Add ``risk_class`` and ``risk_class_encoded`` from the multi-label string."""
    return df.withColumn(C.TARGET_COL, X.assign_class(label_col, rules, default)).withColumn(
        "risk_class_encoded", X.encode_class(C.TARGET_COL, mapping)
    )


def unknown_classes(df: DataFrame, class_col: str = C.TARGET_COL, mapping: dict = C.CLASS_TO_CODE) -> list[str]:
    """Classes present in ``df`` but absent from the mapping (distinct, so small)."""
    known = local_df(df.sparkSession, [(k,) for k in mapping], f"{class_col} string")
    bad = df.select(class_col).where(F.col(class_col).isNotNull()).distinct().join(known, class_col, "left_anti")
    return sorted(r[0] for r in bad.collect())


def validate_classes(df: DataFrame, class_col: str = C.TARGET_COL, mapping: dict = C.CLASS_TO_CODE) -> None:
    bad = unknown_classes(df, class_col, mapping)
    if bad:
        raise ValueError(f"Unknown risk classes: {bad}")


def class_distribution(
    df: DataFrame, class_col: str = C.TARGET_COL, group_cols: list[str] | None = None
) -> DataFrame:
    """A2: count, share and imbalance ratio (max/min count) per class, per group.

    The aggregation is map-side combined, so the shuffle carries one row per
    (partition, group, class); the window then runs on that tiny result.
    """
    group_cols = list(group_cols or [])
    counts = df.groupBy(*group_cols, class_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*group_cols)
    return counts.select(
        *group_cols,
        class_col,
        "n",
        (F.col("n") / F.sum("n").over(w)).alias("share"),
        (F.max("n").over(w) / F.min("n").over(w)).alias("imbalance_ratio"),
    )


def token_frequency(df: DataFrame, label_col: str = C.LABEL_COL, drop_events: bool = True) -> DataFrame:
    """Frequency of trimmed tokens; event-date tokens (P22) removed or flagged."""
    toks = df.select(F.explode(X.label_tokens(label_col)).alias("token")).where(F.col("token") != "")
    toks = toks.withColumn("is_event", X.is_event_token("token"))
    if drop_events:
        toks = toks.where(~F.col("is_event"))
    return toks.groupBy("token", "is_event").agg(F.count(F.lit(1)).alias("n"))
