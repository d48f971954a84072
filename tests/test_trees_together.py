"""Decision trees grown together: the trees of MLlib, from one set of jobs for all configurations."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabrisk.operators import dtree, models
from tabrisk.plans import ablation

FEATS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    n = 3000
    a, b, c = rng.normal(size=n), rng.integers(0, 5, n).astype(float), np.round(rng.exponential(size=n), 2) * (rng.random(n) < 0.7)
    y = ((a + 0.5 * b + rng.normal(scale=0.4, size=n) > 1).astype(int) + (c > 1.2)).astype(int)
    data = [(float(a[i]), float(b[i]), float(c[i]), 4.0, int(y[i]), int(i % 3), 0, [1.0, 2.5, 0.5][y[i]]) for i in range(n)]
    return spark.createDataFrame(data, "a double, b double, c double, d double, y int, fold int, repeat int, w double").cache()


SPECS = [
    (FEATS, None, {"max_depth": 6}), (FEATS, None, {"max_depth": 8, "min_samples_leaf": 20, "criterion": "entropy"}), (["b", "c"], None, {"max_depth": 3}),
    (FEATS, "w", {"max_depth": 5, "max_bins": 16}), (["d"], None, {"max_depth": 3}), (FEATS, None, {"max_depth": 0}),
]


def test_same_trees_as_mllib(spark, rows, monkeypatch):
    monkeypatch.setattr(dtree, "CELLS", 5000)  # several jobs a level
    train = rows.where("fold <> 0")
    grown = dtree.fit_many(train, "y", [dtree.Spec(*s) for s in SPECS])
    counts = dtree.fold_counts(rows, grown, 0, [f"m{i}" for i in range(len(SPECS))], "y", "k")
    for i, (feats, weight, params) in enumerate(SPECS):
        m = models.fit_model("decision_tree", train, feats, "y", weight, params)
        want = m.predict(rows).groupBy(F.when(F.col("fold") == 0, "val").otherwise("train").alias("role"), F.col("y").alias("label"), "prediction").count().collect()
        got = counts.where(F.col("k") == i).collect()
        assert sorted((r["role"], r["label"], r["prediction"], r["n"]) for r in got) == sorted(map(tuple, want)), i


def test_all_configs_share_the_jobs(spark, rows):
    """As many counting jobs as the deepest tree has levels, whatever the number of trees."""
    def jobs(specs):
        seen = []
        real = dtree._counts
        dtree._counts = lambda *a: (seen.append(1), real(*a))[1]
        try:
            dtree.fit_many(rows, "y", [dtree.Spec(*s) for s in specs])
        finally:
            dtree._counts = real
        return len(seen)

    assert jobs(SPECS[:1] * 5) == jobs(SPECS[:1]) <= 6
    cfgs = ablation.feature_configs(params={"max_depth": 6})
    assert ablation._together(cfgs) == [list(range(len(cfgs)))]
    assert ablation._together(ablation.imbalance_configs()) == [[0, 2, 3, 4, 5], [1]]
    assert len(ablation._together(ablation.clip_configs())) == 3


def test_refuses_what_mllib_refuses(spark, rows):
    for bad in (rows.withColumn("y", F.when(F.col("a") > 0, F.col("y"))), rows.withColumn("a", F.when(F.col("a") > 0, F.col("a"))), rows.withColumn("w", -F.col("w"))):
        with pytest.raises((PySparkException, ValueError)):  # what a grid keeps a row for
            dtree.fit_many(bad, "y", [dtree.Spec(FEATS, "w", {})])


def test_thresholds():
    ones = np.ones(6)
    assert dtree.thresholds(np.array([1.0, 1, 2, 2, 3, 3]), ones, 6.0, 64).tolist() == [1.5, 2.5]
    assert dtree.thresholds(np.array([0.0, 0, 2, 2, 3, 3]), ones, 6.0, 64).tolist() == [1.0, 2.5]  # zeros are what is left
    assert dtree.thresholds(np.full(6, 4.0), ones, 6.0, 64).tolist() == []
    assert dtree.thresholds(np.arange(1.0, 101), np.ones(100), 100.0, 4).tolist() == [25.5, 50.5, 75.5]


def test_histograms_over_batches(monkeypatch):
    """Rows are added up many at a time, over several batches, to the sums of a count by hand."""
    import pyarrow as pa

    from tabrisk.operators import boosting, treetable

    rng = np.random.default_rng(3)
    n, width, bins = 500, 3, 8
    x, g, h, w = rng.integers(0, bins, (n, width)), rng.normal(size=(n, 2)), rng.random((n, 2)), rng.integers(0, 3, n).astype(float)
    tree = [treetable.Node(0, n, col=1, feature="b", threshold=3.0, left=1, right=2), treetable.Node(1, 0), treetable.Node(1, 0)]
    slots = [{0: 0}, {2: 1, 1: 2}]
    lists = lambda m, t: pa.array(m.tolist(), pa.list_(t))
    batches = [pa.RecordBatch.from_arrays([lists(x[a : a + 60], pa.int32()), lists(g[a : a + 60], pa.float64()), lists(h[a : a + 60], pa.float64()), pa.array(w[a : a + 60])], ["x", "g", "h", "w"]) for a in range(0, n, 60)]
    want = np.zeros((3, 3, width, bins))
    for r in range(n):
        for k, slot in ((0, 0), (1, 2 if x[r, 1] <= 3 else 1)):
            if w[r] > 0:
                for c in range(width):
                    want[:, slot, c, x[r, c]] += (g[r, k] * w[r], h[r, k] * w[r], 1)
    for size in (1, 100, 10_000):
        monkeypatch.setattr(boosting, "ROWS", size)
        flat = [treetable.arrays([treetable.Node(0, n)]), treetable.arrays(tree)]
        out = pa.Table.from_batches(boosting._adder(flat, slots, 3, width, bins)(iter(batches)))
        got = np.zeros((3, want[0].size))
        got[:, out["cell"].to_numpy()] = [out[c].to_numpy() for c in "ghn"]
        np.testing.assert_allclose(got, want.reshape(3, -1), atol=1e-9)


def test_leaf_values_in_arrow(spark):
    """Leaf values come from Arrow arrays, without an object a row."""
    from tabrisk.operators import treetable

    tree = [treetable.Node(0, 3, col=1, feature="b", threshold=3.0, left=1, right=2), treetable.Node(1, 2, -1.0), treetable.Node(1, 1, 2.0)]
    d = spark.createDataFrame([([0, 2],), ([5, 3],), ([1, 4],)], "x array<int>").coalesce(1)
    out = d.select(treetable.leaf_values(F.col("x"), 2, [tree, tree[1:2]]).alias("v"))
    assert sorted(r["v"] for r in out.collect()) == [[-1.0, -1.0], [-1.0, -1.0], [2.0, -1.0]]
    assert "pandas" not in str(type(treetable.leaf_values)) and not hasattr(treetable, "pd")


def test_preparations_share_their_fits(spark, monkeypatch):
    """Lambdas, categories and codes are fitted once a fold for all preparations that need them, and are those of a fit alone."""
    from tabrisk import config as C
    from tabrisk.operators import encode
    from tabrisk.plans import prepare

    base = [C.PrepConfig(fe_groups=[], use_skew=k, use_scale=False, use_ohe=o) for k, o in ((True, False), (True, True), (False, True), (False, False))]
    rng = np.random.default_rng(1)
    cols = [*C.NUMERIC_COLS, *C.ENGINEERED_SKEW_COLS]
    data = [(*(float(v) for v in rng.exponential(size=len(cols)) ** 3), "ABCD"[i % 4], *(f"v{(i + j) % 3}" for j in range(len(C.OHE_COLS)))) for i in range(200)]
    common = spark.createDataFrame(data, ", ".join([*(f"{c} double" for c in cols), "soil_group string", *(f"{c} string" for c in C.OHE_COLS)])).cache()
    calls, made = {"skew": 0, "onehot": 0, "ordinal": 0}, {}
    for name, f in (("skew", "fit_skew_transforms"), ("onehot", "fit_onehot"), ("ordinal", "fit_ordinal")):
        real = getattr(encode, f)
        monkeypatch.setattr(encode, f, lambda *a, real=real, name=name, **k: (calls.__setitem__(name, calls[name] + 1), real(*a, **k))[1])

    def share(key, make):
        if key not in made:
            made[key] = make()
        return made[key]

    plain = common.drop(*C.ENGINEERED_SKEW_COLS)
    shared = [prepare.fit_linear_common(plain, None, c, share) for c in base] + [prepare.fit_linear_common(common, None, base[1], share)]
    assert calls == {"skew": 2, "onehot": 1, "ordinal": 2}  # the engineered columns on their own; fit_onehot takes codes
    alone = [prepare.fit_linear_common(plain, None, c) for c in base] + [prepare.fit_linear_common(common, None, base[1])]
    for a, b in zip(shared, alone):
        assert (a.lambdas, a.onehot, a.feature_cols) == (b.lambdas, b.onehot, b.feature_cols)
        assert sorted(a.codes.collect() if a.codes else []) == sorted(b.codes.collect() if b.codes else [])
