"""The library's preparation, models and scores as ``pyspark.ml`` stages.

``TreePreparation`` and ``RiskClassifier`` are estimators and ``FBetaEvaluator`` an
evaluator, so that ``Pipeline``, ``CrossValidator`` and ``ParamGridBuilder`` take
them. Inside a cross-validation a pipeline fits its preparation anew on the
training rows of every fold. All of them can be written and read.
"""

from __future__ import annotations

import os

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .operators import metrics, models
from .plans import prepare
from .sources import io as sio


class _Shared(Params):
    labelCol = Param(Params._dummy(), "labelCol", "column of the class codes", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the predicted class codes", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="risk_class_encoded", predictionCol="prediction")

    def _given(self, kwargs: dict):
        """Sets the arguments that are not None."""
        for name, value in kwargs.items():
            if value is not None:
                self._set(**{name: value})
        return self


# ------------------------------------------------------------ preparation ---
class _PreparationParams(_Shared):
    feGroups = Param(Params._dummy(), "feGroups", "engineered feature groups", TypeConverters.toListString)
    keepCols = Param(Params._dummy(), "keepCols", "further columns that stay", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._setDefault(feGroups=list(C.PrepConfig().fe_groups), keepCols=[])


class TreePreparation(Estimator, _PreparationParams, DefaultParamsReadable, DefaultParamsWritable):
    """The preparation for trees, fitted on whatever rows ``fit`` is given."""

    def __init__(self, feGroups: list[str] | None = None, keepCols: list[str] | None = None):
        super().__init__()
        self._given({"feGroups": feGroups, "keepCols": keepCols})

    def featureCols(self) -> list[str]:
        return prepare.TreePrep(None, None, C.PrepConfig(fe_groups=self.getOrDefault(self.feGroups))).feature_cols

    def _fit(self, dataset: DataFrame) -> TreePreparationModel:
        prep = prepare.fit_tree(dataset, C.PrepConfig(fe_groups=self.getOrDefault(self.feGroups)))
        return self._copyValues(TreePreparationModel(prep))


class TreePreparationModel(Model, _PreparationParams, MLReadable, MLWritable):
    def __init__(self, prep: prepare.TreePrep | None = None):
        super().__init__()
        self.prep = prep

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return prepare.transform_tree(dataset, self.prep, [c for c in self.getOrDefault(self.keepCols) if c in dataset.columns])

    def write(self) -> MLWriter:
        return _Writer(self, lambda path: sio.save_params({"params": self.prep.params, "codes": self.prep.codes}, {"fe_groups": list(self.prep.cfg.fe_groups)}, path))

    @classmethod
    def read(cls) -> MLReader:
        def load(spark: SparkSession, path: str) -> TreePreparationModel:
            tables, meta = sio.load_params(spark, path, ["params", "codes"], {})
            return TreePreparationModel(prepare.TreePrep(tables["params"], tables["codes"], C.PrepConfig(fe_groups=meta["fe_groups"])))

        return _Reader(cls, load)


# ------------------------------------------------------------------ models ---
class _ClassifierParams(_Shared):
    modelKey = Param(Params._dummy(), "modelKey", "key of the model registry", TypeConverters.toString)
    featureCols = Param(Params._dummy(), "featureCols", "columns of the features", TypeConverters.toListString)
    weightCol = Param(Params._dummy(), "weightCol", "column of row weights (empty: none)", TypeConverters.toString)
    modelParams = Param(Params._dummy(), "modelParams", "the model's own parameters, by name", TypeConverters.identity)

    def __init__(self):
        super().__init__()
        self._setDefault(modelKey="decision_tree", featureCols=[], weightCol="", modelParams={})


class RiskClassifier(Estimator, _ClassifierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Any model of the registry by its key."""

    def __init__(self, modelKey: str | None = None, featureCols: list[str] | None = None, labelCol: str | None = None, weightCol: str | None = None, modelParams: dict | None = None):
        super().__init__()
        self._given({"modelKey": modelKey, "featureCols": featureCols, "labelCol": labelCol, "weightCol": weightCol, "modelParams": modelParams})

    def paramDistributions(self) -> dict[str, list]:
        """The lists that a random search draws this model's parameters from."""
        return models.PARAM_SPACES.get(self.getOrDefault(self.modelKey).strip().lower(), {})

    def _fit(self, dataset: DataFrame) -> RiskClassifierModel:
        features = self.getOrDefault(self.featureCols)
        if not features:
            raise ValueError("featureCols is empty")
        fitted = models.fit_model(self.getOrDefault(self.modelKey), dataset, features, self.getOrDefault(self.labelCol), self.getOrDefault(self.weightCol) or None, self.getOrDefault(self.modelParams))
        return self._copyValues(RiskClassifierModel(fitted))


class RiskClassifierModel(Model, _ClassifierParams, MLReadable, MLWritable):
    def __init__(self, fitted: models.Fitted | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.getOrDefault(self.predictionCol)
        scored = self.fitted.predict(dataset.drop("prediction"))
        return scored if out == "prediction" else scored.withColumnRenamed("prediction", out)

    def write(self) -> MLWriter:
        if self.fitted.save is None:
            raise ValueError(f"{self.fitted.name} can't be saved")
        return _Writer(self, self.fitted.save)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls, lambda spark, path: RiskClassifierModel(models.load_fitted(spark, path)))


# ------------------------------------------------------------------ scores ---
class FBetaEvaluator(Evaluator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """a column of the metric summary (A21), macro F2 by default; larger is better."""

    metricName = Param(Params._dummy(), "metricName", "column of the metric summary", TypeConverters.toString)

    def __init__(self, metricName: str | None = None, labelCol: str | None = None, predictionCol: str | None = None):
        super().__init__()
        self._setDefault(metricName="f2_macro")
        self._given({"metricName": metricName, "labelCol": labelCol, "predictionCol": predictionCol})

    def _evaluate(self, dataset: DataFrame) -> float:
        cm = metrics.confusion(dataset, self.getOrDefault(self.labelCol), self.getOrDefault(self.predictionCol))
        name = self.getOrDefault(self.metricName)
        s = metrics.summary(cm)
        if name not in s.columns:
            raise ValueError(f"unknown metric: {name}")
        return float(s.select(F.coalesce(F.col(name), F.lit(0.0))).first()[0])

    def isLargerBetter(self) -> bool:
        return True


# ------------------------------------------------------------- persistence ---
class _Writer(MLWriter):
    """A stage's parameters beside what ``save_data`` writes."""

    def __init__(self, stage: Params, save_data):
        super().__init__()
        self.stage, self.save_data = stage, save_data

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, SparkSession.active())
        self.save_data(os.path.join(path, "data"))


class _Reader(MLReader):
    def __init__(self, cls, load_data):
        super().__init__()
        self.cls, self.load_data = cls, load_data

    def load(self, path: str):
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.load_data(spark, os.path.join(path, "data"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
