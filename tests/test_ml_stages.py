"""The pyspark.ml stages, the nested report, bounded one-hot and concurrent fits."""

import math
import threading
import time

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import functions as F

from tabrisk.functions import exprs as X
from tabrisk.ml import FBetaEvaluator, RiskClassifier, RiskClassifierModel, TreePreparation, TreePreparationModel
from tabrisk.operators import encode, metrics
from tabrisk.plans import ablation, experiment
from tabrisk.plans.catalog import KEY_LIST, rule_predictions, seg_labelled
from tabrisk.sources import report

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return seg_labelled(spark, SMOKE).limit(1500).cache()


def test_pipeline_round_trip(spark, rows, tmp_path):
    prep = TreePreparation(feGroups=["G1"], keepCols=["segment_id"])
    pipe = Pipeline(stages=[prep, RiskClassifier("decision_tree", prep.featureCols(), modelParams={"max_depth": 4})])
    model = pipe.fit(rows)
    want = sorted(tuple(r) for r in model.transform(rows).select("segment_id", "prediction").collect())
    assert len(want) == 1500 and {p for _, p in want} <= {0, 1, 2}
    model.write().overwrite().save(str(tmp_path / "model"))
    back = PipelineModel.load(str(tmp_path / "model"))
    assert isinstance(back.stages[0], TreePreparationModel) and isinstance(back.stages[1], RiskClassifierModel)
    assert sorted(tuple(r) for r in back.transform(rows).select("segment_id", "prediction").collect()) == want
    pipe.write().overwrite().save(str(tmp_path / "pipe"))
    again = Pipeline.load(str(tmp_path / "pipe"))
    assert again.getStages()[1].getOrDefault("modelParams") == {"max_depth": 4}
    assert sorted(tuple(r) for r in again.fit(rows).transform(rows).select("segment_id", "prediction").collect()) == want


def test_cross_validator_takes_own_models(spark, rows, tmp_path):
    prep = TreePreparation(feGroups=[])
    risk = RiskClassifier("ridge_ordinal", prep.featureCols())
    grid = ParamGridBuilder().addGrid(risk.modelParams, [{"alpha": 0.1}, {"alpha": 1000.0}]).build()
    cv = CrossValidator(estimator=Pipeline(stages=[prep, risk]), estimatorParamMaps=grid, evaluator=FBetaEvaluator(), numFolds=2, seed=3, parallelism=2)
    fitted = cv.fit(rows)
    assert len(fitted.avgMetrics) == 2 and all(0 < m < 1 for m in fitted.avgMetrics) and fitted.avgMetrics[0] != fitted.avgMetrics[1]
    fitted.write().overwrite().save(str(tmp_path / "cv"))
    back = CrossValidatorModel.load(str(tmp_path / "cv"))
    a, b = (m.transform(rows).groupBy("prediction").count().collect() for m in (fitted, back))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_booster_as_a_stage(spark, rows, tmp_path):
    prep = TreePreparation(feGroups=[])
    d = prep.fit(rows).transform(rows).cache()
    m = RiskClassifier("xgb_scratch_efb", prep.featureCols(), modelParams={"n_estimators": 2, "num_leaves": 4, "max_bin": 16}).fit(d)
    m.write().overwrite().save(str(tmp_path / "b"))
    back = RiskClassifierModel.load(str(tmp_path / "b"))
    assert back.uid == m.uid and FBetaEvaluator().evaluate(back.transform(d)) == FBetaEvaluator().evaluate(m.transform(d)) > 0.3
    assert "reg_alpha" in RiskClassifier("lgbm").paramDistributions() and RiskClassifier("dummy").paramDistributions() == {}


def test_evaluator_and_errors(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 2), (2, 0)], "risk_class_encoded int, prediction int")
    s = metrics.summary(metrics.confusion(df, "risk_class_encoded", "prediction")).first()
    for name in ("f2_macro", "f1_weighted", "accuracy", "recall_high"):
        assert FBetaEvaluator(name).evaluate(df) == pytest.approx(s[name])
    assert FBetaEvaluator().isLargerBetter()
    with pytest.raises(ValueError, match="unknown metric"):
        FBetaEvaluator("no").evaluate(df)
    with pytest.raises(ValueError, match="featureCols"):
        RiskClassifier("decision_tree").fit(df)
    with pytest.raises(KeyError):
        RiskClassifier("none", ["prediction"]).fit(df)


def test_nested_report(spark, tmp_path):
    preds = spark.createDataFrame([("b", 0, 0), ("b", 0, 2), ("b", 1, 1), ("a", 2, 2)], "model string, y int, p int")
    r = report.nested_report(preds, "model", "y", "p", "run 1")
    path = report.write_report(r, str(tmp_path / "r"))
    back = report.read_report(spark, path).collect()
    assert len(back) == 1 and back[0].run == "run 1" and list(back[0].models) == ["a", "b"]
    b = back[0].models["b"]
    assert b.matrix == [[1, 0, 1], [0, 1, 0], [0, 0, 0]] and b.metrics["accuracy"] == pytest.approx(2 / 3)
    assert [(c.label, c.precision, c.recall, c.support) for c in b.classes] == [(0, 1.0, 0.5, 2.0), (1, 1.0, 1.0, 1.0), (2, 0.0, 0.0, 0.0)]
    assert report.report_rows(report.read_report(spark, path)).count() == 6
    assert rule_predictions(spark, SMOKE).count() > 0


def test_onehot_refuses_unbounded_categories(spark):
    df = spark.range(50).select(F.concat(F.lit("c"), F.col("id")).alias("c"), (F.col("id") % 3).cast("string").alias("d"))
    with pytest.raises(ValueError, match="too many categories.*'c': 50"):
        encode.fit_onehot(df, ["c", "d"], most=10)
    assert encode.fit_onehot(df, ["d"], most=10) == {"d": ["0", "1", "2"]}
    hashed = encode.hash_categories(df, ["c", "d"], 1 << 12).select("hashed").collect()
    assert all(r.hashed.size == 1 << 12 and 1 <= r.hashed.numNonzeros() <= 2 for r in hashed)


def test_concurrent_fits_keep_order_and_raise(spark):
    running, most, lock = 0, 0, threading.Lock()

    def task(i):
        def run():
            nonlocal running, most
            with lock:
                running += 1
                most = max(most, running)
            time.sleep(0.05 * (5 - i % 5))
            n = spark.range(i * 10).count()
            with lock:
                running -= 1
            return n

        return run

    assert experiment.run_concurrently(spark, [task(i) for i in range(10)], 4) == [i * 10 for i in range(10)]
    assert 1 < most <= 4
    assert experiment.run_concurrently(spark, [task(i) for i in range(3)], 1) == [0, 10, 20]
    with pytest.raises(ZeroDivisionError):
        experiment.run_concurrently(spark, [lambda: 1, lambda: 1 // 0], 2)
    with pytest.raises(ValueError):
        experiment.run_concurrently(spark, [], 0)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "fits")
    try:
        assert experiment.run_concurrently(spark, [lambda: spark.sparkContext.getLocalProperty("spark.jobGroup.id")] * 3, 2) == ["fits"] * 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_grid_is_the_same_with_one_and_many_threads(spark, rows, tmp_path):
    folds = rows.withColumn("repeat", F.lit(0)).withColumn("fold", (F.abs(F.hash("segment_id")) % 2).cast("int")).cache()
    configs = [*ablation.feature_configs(params={"max_depth": 3})[:2], ablation.Config("bad", "nothing")]
    tables = [sorted(map(str, ablation.run_grid(folds, 2, configs, KEY_LIST, "e", threads=t, batch_path=str(tmp_path / f"b{t}")).collect())) for t in (1, 3)]
    assert tables[0] == tables[1] and len(tables[0]) == 3 and any("KeyError" in r for r in tables[0])
    batch = spark.read.parquet(str(tmp_path / "b3"))
    assert {r.batch_group for r in batch.collect()} == {"baseline", "G1"}
    ablation.write_batch(batch.where("batch_group = 'G1'").drop("batch_group").withColumn("n_features", F.lit(-1)), str(tmp_path / "b3"), "G1")
    assert {r.batch_group: r.n_features for r in spark.read.parquet(str(tmp_path / "b3")).collect()}["G1"] == -1
    with pytest.raises(ValueError, match="missing keys"):
        ablation.required_keys([{"name": "x", "model": "dummy"}])


def t_tail(t, v, steps=400_000):
    """Two-sided tail by the density's integral in a bounded variable."""
    u = (np.arange(steps) + 0.5) / steps * math.atan(abs(t) / math.sqrt(v))
    area = np.cos(u) ** (v - 1)
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(math.pi)
    return 1 - 2 * c * area.mean() * math.atan(abs(t) / math.sqrt(v))


def test_student_tail(spark):
    cases = [(t, v) for t in (0.0, 0.1, -1.0, 1.96, 2.5, 4.0) for v in (1, 2, 5, 30, 1000, 60_000)]
    df = spark.createDataFrame([(float(t), v) for t, v in cases], "t double, v long")
    for r in df.withColumn("p", X.student_t_two_sided(F.col("t"), F.col("v"))).collect():
        assert abs(r.p - t_tail(r.t, r.v)) < 1e-9, r
    known = spark.createDataFrame([(1.0, 1, 0.5), (math.sqrt(2), 2, 1 - math.sqrt(0.5)), (12.706204736174694, 1, 0.05), (2.0422724563012373, 30, 0.05)], "t double, v long, p double")
    for r in known.withColumn("q", X.student_t_two_sided(F.col("t"), F.col("v"))).collect():
        assert abs(r.p - r.q) < 1e-9
    odd = spark.createDataFrame([(None, 5), (1.0, 0), (float("inf"), 5)], "t double, v long")
    assert [r.p for r in odd.select(X.student_t_two_sided(F.col("t"), F.col("v")).alias("p")).collect()] == [None, None, 0.0]
