"""Quantiles from counts of ranges: the same as those of all values, and hardly any value is counted one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrisk import config as C
from tabrisk.operators import clean, order
from tabrisk.plans import prepare

PROBS = [0, 0.1, 0.25, 0.5, 0.9, 1]


@pytest.fixture()
def few_cells(monkeypatch):
    monkeypatch.setattr(order, "CELLS", 8)
    monkeypatch.setattr(order, "DRAWN", 50)


@pytest.fixture()
def odd(spark):
    rng = np.random.default_rng(1)
    rows = [
        (i % 3, None if rng.random() < 0.2 else float(rng.integers(0, 5)), None if rng.random() < 0.1 else float(rng.normal()),
         float("inf") if i == 3 else float("nan") if i == 5 else -0.0 if i % 7 else float(i), None, 3)
        for i in range(900)
    ]
    return spark.createDataFrame(rows, "fold int, a double, b double, c double, d double, e int").repartition(5)


def test_quantiles_are_those_of_all_values(odd, few_cells):
    cols = list("abcde")
    got = sorted(str(tuple(r)) for r in order.exact_quantiles(odd, cols, PROBS).collect())
    want = sorted(str(tuple(r[1:])) for r in order.exact_quantiles(odd.withColumn("g", F.lit(1)), cols, PROBS, ["g"]).collect())
    assert got == want


def test_few_values_are_counted_one_by_one(spark):
    d = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    counts, nulls = order.reduced_counts(d, ["x"], [0.5])
    r = counts.agg(F.count("value").alias("rows"), F.sum("cnt").alias("n")).first()
    assert r["n"] == 200_000 and r["rows"] < 5_000 and nulls == {(None, "x"): 0}


@pytest.mark.parametrize("q", [0.5, 0.95, 0.99])
def test_fold_parameters(odd, few_cells, q):
    d = odd.select("fold", *[F.col(a).alias(b) for a, b in zip(["a", "b", "b2", "c", "e"], C.NUMERIC_COLS) if a != "b2"],
                   F.when(F.col("b") > 0, F.col("b")).alias("storm_drain_proximity_m"))
    cfg = C.PrepConfig(clip_upper_q=q)
    got = {r["fold"]: tuple(r[1:]) for r in clean.fit_common_folds(d, "fold", 3, cfg).collect()}
    for f in range(3):
        tr = d.where(F.col("fold") != f)
        one = tuple(clean.fit_common(tr, cfg).first())
        by_group = tuple(clean.fit_common(tr.withColumn("g", F.lit(1)), cfg, ["g"]).first())[1:]
        assert str(got[f]) == str(one) == str(by_group)


def test_rows_keep_the_class_they_have(spark):
    d = _rows(spark)
    params = clean.fit_common(d)
    with_labels = prepare.common_transform(d, params, C.PrepConfig())
    without = prepare.common_transform(prepare._labelled(d).drop(C.LABEL_COL), params, C.PrepConfig())
    assert sorted(map(str, with_labels.drop(C.LABEL_COL).select(sorted(without.columns)).collect())) == sorted(map(str, without.select(sorted(without.columns)).collect()))


def _rows(spark):
    return spark.range(40).select(
        *[(F.col("id") * (i + 2) % 11).cast("double").alias(c) for i, c in enumerate(C.NUMERIC_COLS)],
        *[F.concat(F.lit("v"), F.col("id") % 3).alias(c) for c in C.CATEGORICAL_COLS],
        F.when(F.col("id") % 4 == 0, "ponding_hotspot").when(F.col("id") % 4 == 1, " low_lying ").alias(C.LABEL_COL),
    )
