"""One nested JSON document a run, with metrics, classes and confusion matrix of each model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics

_CLASS = "struct<label:int,precision:double,recall:double,f1:double,f2:double,support:double>"
SCHEMA = f"run string, models map<string,struct<metrics:map<string,double>,classes:array<{_CLASS}>,matrix:array<array<double>>>>"


def nested_report(preds: DataFrame, model_col: str, label: str, pred: str, run: str, labels: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """One row (run, models): for each model its metrics by name, per-class rows and confusion matrix (rows are true classes).

    Predictions are counted once; what is gathered per model has a row for each
    pair of classes, and what is gathered into the document a row for each model.
    """
    cm = metrics.confusion(preds, label, pred, labels, [model_col])
    line = cm.groupBy(model_col, "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("prediction", "n"))), lambda x: x["n"]).alias("line"))
    matrix = line.groupBy(model_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("label", "line"))), lambda x: x["line"]).alias("matrix"))
    per = metrics.per_class(cm, [model_col]).withColumn("label", F.col("label").cast("int"))
    classes = per.groupBy(model_col).agg(F.array_sort(F.collect_list(F.struct("label", "precision", "recall", "f1", "f2", "support"))).alias("classes"))
    s = metrics.summary(cm, [model_col])
    named = F.map_from_arrays(F.array(*[F.lit(c) for c in s.columns if c != model_col]), F.array(*[F.col(c).cast("double") for c in s.columns if c != model_col]))
    whole = s.select(model_col, named.alias("metrics")).join(classes, model_col).join(matrix, model_col)
    entry = F.struct(F.col(model_col).cast("string").alias("k"), F.struct("metrics", "classes", "matrix").alias("v"))
    return whole.agg(F.map_from_entries(F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))).alias("models")).select(F.lit(run).alias("run"), "models")


def write_report(report: DataFrame, path: str) -> str:
    """The document as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The document as it was written: run and models."""
    return spark.read.schema(SCHEMA).json(path)


def report_rows(report: DataFrame) -> DataFrame:
    """A row for each model and class: its numbers, the model's metrics and its line of the matrix."""
    m = report.select("run", F.explode("models").alias("model", "m")).select("run", "model", "m.metrics", F.col("m.matrix").alias("matrix"), F.posexplode("m.classes").alias("i", "c"))
    return m.select("run", "model", "c.*", "metrics", F.get("matrix", F.col("i")).alias("line"))
