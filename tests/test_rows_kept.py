"""Rows written once (keep_rows), splits from counts, ranks by hash places, preparations shared by configs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrisk import session
from tabrisk.functions import exprs as X
from tabrisk.operators import folds, linear, order
from tabrisk.plans import ablation, experiment, prepare

KEYS = ["a", "b"]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "cls string, a long, b long, x double").repartition(3)


def test_kept_rows_are_compressed_columns_and_go_when_dropped(spark):
    d = spark.range(20_000).select("id", F.lit("a text that repeats").alias("t"), F.array(F.lit(1.5), F.lit(None)).alias("v"))
    kept = session.keep_rows(d)
    path = session._kept[kept]
    assert sum(f.stat().st_size for f in os.scandir(path.removeprefix("file:"))) < 200_000  # serialised rows: 1.6 MB
    assert kept.columns == d.columns and kept.exceptAll(d).isEmpty() and d.exceptAll(kept).isEmpty()
    assert "ReadSchema: struct<id:bigint>" in kept.select("id")._jdf.queryExecution().toString()
    other = session.hand_on(kept, kept.where("id < 5"))
    session.drop_rows(kept, None)
    assert os.path.exists(path.removeprefix("file:"))
    session.drop_rows(other)
    assert not os.path.exists(path.removeprefix("file:"))


def test_rows_that_parquet_cannot_hold_are_kept_too(spark):
    d = spark.range(3).select("id", F.lit(None).alias("nothing"))
    assert sorted(r["id"] for r in session.keep_rows(d).collect()) == [0, 1, 2]


def _ranked_split(df, keys, ties, fraction):
    counts = [(r[0], r[1]) for r in df.groupBy("cls").count().collect()]
    quota = X.map_values("cls", folds.class_quotas(counts, fraction)).cast("long")
    ranked = order.positions(df.withColumn("_h", X.seeded_hash(keys, 42)), ["_h", *ties], ["cls"], "_rk")
    return ranked.withColumn("split", F.when(F.col("_rk") < quota, "test").otherwise("train")).drop("_h", "_rk")


@pytest.mark.parametrize("case", ["distinct", "repeated", "one key"])
def test_split_from_counts_is_the_split_by_rank(spark, case):
    rng = np.random.default_rng(5)
    key = {"distinct": lambda i: (i, i % 7), "repeated": lambda i: (i // 40, None), "one key": lambda i: (None, None)}[case]
    d = _rows(spark, [("uvw"[min(2, int(c))], *key(i), float(i)) for i, c in enumerate(rng.integers(0, 5, 700))])
    want, got = _ranked_split(d, KEYS, [*KEYS, "x"], 0.2), folds.stratified_split(d, "cls", KEYS, [*KEYS, "x"], 0.2)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_split_ranks_only_rows_of_a_torn_hash(spark, monkeypatch):
    monkeypatch.setattr(folds, "positions", lambda *a: pytest.fail("no rows need a rank"))
    d = _rows(spark, [("u", i, 1, 0.0) for i in range(100)])
    assert folds.stratified_split(d, "cls", KEYS, KEYS, 0.2).where("split = 'test'").count() == 20


@pytest.mark.parametrize("bits,hashed", [(32, lambda: X.seeded_hash(["a"], 1)), (4, lambda: F.pmod("a", F.lit(16)))])
def test_hashed_positions_are_positions(spark, bits, hashed):
    d = _rows(spark, [(None if i % 3 == 0 else "u", i % 90, i % 5, float(i)) for i in range(400)]).withColumn("_h", hashed())
    want = order.positions(d, ["_h", "a", "x"], ["cls"])
    got = order.hashed_positions(d, "_h", bits, ["a", "x"], ["cls"])
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("cands", [linear.linspace_candidates(-1.0, 1.0, 5), [0.5, 0.5, 0.5], [-0.0], [float("-inf"), 0.0]])
def test_candidates_below_counts_each_candidate(spark, cands):
    scores = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 0.5, -1.0, 1.0, 0.49, -7.0]
    d = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, s double")
    plain = F.size(F.filter(F.array(*[F.lit(c) for c in cands]), lambda c: c <= F.col("s")))
    want = {r["i"]: r["n"] for r in d.select("i", plain.alias("n")).collect()}
    got = {r["i"]: r["n"] for r in linear.candidates_below(d, "s", cands, "n").collect()}
    assert got == {i: max(n, 0) for i, n in want.items()}


def test_fold_counts_give_the_metrics_of_the_rows(spark):
    class Model:
        predict = staticmethod(lambda d: d.withColumn("prediction", F.pmod("i", F.lit(3)).cast("int")))

    part = spark.range(300).select(F.col("id").alias("i"), F.lit(0).alias("repeat"), F.pmod("id", F.lit(2)).cast("int").alias("fold"), F.pmod(F.floor(F.col("id") / 7), F.lit(3)).cast("int").alias("risk_class_encoded"))
    plain = experiment.cv_fold_metrics(experiment.fold_predictions(part, Model, 1, "m")).collect()
    counts = experiment.fold_counts(part, Model, 1, "m")
    assert counts.count() <= 18
    assert experiment.cv_fold_metrics(counts, weight="n").collect() == plain


def test_configs_with_one_preparation_share_it(spark, monkeypatch):
    fits = []
    real = prepare.fit_linear_common
    monkeypatch.setattr(prepare, "fit_linear_common", lambda *a: fits.append(1) or real(*a))
    from tabrisk.plans import catalog

    dealt = catalog._ablation_folds(spark, "/root/testdata/sf0.001", 2)
    cfgs = [c for c in ablation.loss_configs() if c.model == "ridge_ordinal"]
    out = ablation.run_grid(dealt, 2, cfgs, catalog.KEY_LIST, "losses")
    assert len(cfgs) == 3 and len(fits) == 2  # one a fold
    assert {r["status"] for r in out.collect()} == {"ok"} and dealt not in ablation._shared


def test_ordinal_models_of_one_preparation_are_fitted_together(spark, monkeypatch):
    from tabrisk.plans import catalog

    passes = []
    for name in ("cross_products", "threshold_searches"):
        monkeypatch.setattr(linear, name, lambda *a, real=getattr(linear, name), name=name: passes.append(name) or real(*a))
    dealt = catalog._ablation_folds(spark, "/root/testdata/sf0.001", 2)
    cfgs = [c for c in ablation.loss_configs() if c.model != "lasso_ordinal"]
    together = ablation.run_grid(dealt, 2, cfgs, catalog.KEY_LIST, "losses").collect()
    assert [r["config"] for r in together] == [c.name for c in cfgs] and {r["status"] for r in together} == {"ok"}
    assert passes.count("cross_products") == 2 * 9 and passes.count("threshold_searches") == 2  # a fold: one pass, one a Huber iteration; not one a config
    alone = ablation.run_grid(dealt, 2, [cfgs[2], ablation.Config("bad", "nothing")], catalog.KEY_LIST, "losses").where("status = 'ok'").collect()
    assert alone == [together[2]]


def test_cross_products_and_threshold_searches_match_plain_ones(spark):
    rng = np.random.default_rng(3)
    x, w = rng.normal(size=(200, 2)), rng.integers(1, 4, 200)
    y = np.clip(np.round(x[:, 0] + 1 + rng.normal(scale=0.5, size=200)), 0, 2).astype(int)
    d = spark.createDataFrame([(float(a), float(b), int(c), float(v)) for (a, b), c, v in zip(x, y, w)], "a double, b double, y int, w double").repartition(5)
    z = np.column_stack([np.ones(200), x, y])
    r = np.abs(y - (0.5 + x @ np.array([1.0, 0.1])))
    got = linear.cross_products(d.select("a", "b", F.col("y").cast("double"), "w"), [(0.0, np.zeros(2), None), (0.5, np.array([1.0, 0.1]), 0.3)])
    assert np.allclose(got[0], (z * w[:, None]).T @ z) and np.allclose(got[1], (z * (w * np.where(r <= 0.3, 1.0, 0.3 / r))[:, None]).T @ z)
    for alpha in (0.0, 0.5):
        b, c = linear.solve_cross(got[0], alpha)
        b0, c0 = linear.solve_ridge(linear.normal_sums(d, ["a", "b"], "y", "w"), 2, alpha)
        assert np.isclose(b, b0) and np.allclose(c, c0)
    scores = [F.col("a"), F.col("b") - F.col("a"), F.when(F.col("a") > -1, F.col("a") * 2.0), F.lit(1.0), F.when(F.col("b") > 1, F.lit(float("nan"))).otherwise(F.col("b"))]
    for weight in (None, "w"):
        want = [linear.threshold_search(d.withColumn("s", s), "s", "y", weight).first() for s in scores]
        for some in (scores[:4], scores):
            assert [repr(t) for t in linear.threshold_searches(d, some, "y", weight)] == [repr((t["t1"], t["t2"])) for t in want[: len(some)]]
    for bad in (float("nan"), None):
        with pytest.raises(ValueError, match="missing"):
            linear.cross_products(d.select("a", F.when(F.col("b") > 1, F.lit(bad)).otherwise(F.col("b")), F.col("y").cast("double"), "w"), [(0.0, np.zeros(2), None)])
