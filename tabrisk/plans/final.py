"""Final evaluation behind a gate.

A pipeline artefact is a folder with the fitted preparation, the fitted model and
the metadata that ties them together. The test rows are only scored by an artefact
that is complete and fits the run: anything missing or different refuses the test.
"""

from __future__ import annotations

import os

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from ..operators import metrics, models
from ..sources import io as sio
from . import prepare

SCHEMA_VERSION = 1


def save_pipeline(prep: prepare.TreePrep, fitted: models.Fitted, path: str, **metadata) -> str:
    """Preparation tables, model and metadata to a shared folder."""
    if fitted.save is None:
        raise ValueError(f"{fitted.name} can't be saved")
    meta = {"artifact_schema_version": SCHEMA_VERSION, "target_mapping": C.CLASS_TO_CODE, "fe_groups": list(prep.cfg.fe_groups), "feature_cols": list(prep.feature_cols), "model": fitted.name, **metadata}
    sio.save_params({"params": prep.params, "codes": prep.codes}, meta, os.path.join(path, "preparation"))
    fitted.save(os.path.join(path, "model"))
    return path


def load_pipeline(spark: SparkSession, path: str, expect: dict | None = None) -> tuple[prepare.TreePrep, models.Fitted, dict]:
    """What :func:`save_pipeline` wrote; ValueError if a part is missing or contradicts ``expect`` or another part."""
    want = {"artifact_schema_version": SCHEMA_VERSION, "target_mapping": C.CLASS_TO_CODE, **(expect or {})}
    try:
        tables, meta = sio.load_params(spark, os.path.join(path, "preparation"), ["params", "codes"], want)
        fitted = models.load_fitted(spark, os.path.join(path, "model"))
    except PySparkException as e:
        raise ValueError(f"incomplete artefact {path}: {str(e).splitlines()[0][:200]}") from e
    prep = prepare.TreePrep(tables["params"], tables["codes"], C.PrepConfig(fe_groups=meta["fe_groups"]))
    if fitted.info["features"] and list(fitted.info["features"]) != list(prep.feature_cols):
        raise ValueError("the model was fitted on other features than the preparation gives")
    return prep, fitted, meta


def evaluate_on_test(spark: SparkSession, path: str, test: DataFrame, expect: dict | None = None) -> DataFrame:
    """Test metrics, only if the artefact passes :func:`load_pipeline`."""
    prep, fitted, _ = load_pipeline(spark, path, expect)
    scored = fitted.predict(prepare.transform_tree(test, prep))
    return metrics.summary(metrics.confusion(scored, "risk_class_encoded", "prediction"))
