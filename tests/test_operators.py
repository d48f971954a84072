"""Operator invariants and edge cases on hand-made frames (FIXTURES.md section 8)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrisk import config as C
from tabrisk.functions import exprs as X
from tabrisk.operators import balance, clean, encode, features, folds, labels, linear, metrics, models, order, profile, ranking, trees
from tabrisk.plans import ablation, experiment


def test_assign_class_edge_cases(spark):
    rows = [(None,), ("",), ("   ",), (" low_lying | monitor",), ("event_2024-01-02",), ("sparse_drainage|ponding_hotspot",),
            ("monitor|extreme_rain_history ",), ("low_lyingx",)]
    df = spark.createDataFrame(rows, "risk_labels string")
    got = [r[0] for r in labels.with_risk_class(df).select("risk_class").collect()]
    assert got == ["Low", "Low", "Low", "Medium", "Low", "High", "High", "Low"]


def test_unknown_class_raises(spark):
    df = spark.createDataFrame([("Low",), ("Extreme",)], "risk_class string")
    with pytest.raises(ValueError):
        labels.validate_classes(df)


def test_clip_keeps_null_and_bins_right_closed(spark):
    df = spark.createDataFrame([(None,), (5.0,), (20.0,), (20.5,), (99.0,)], "elevation_m double")
    out = df.select(X.clip_upper("elevation_m", 50.0).alias("c"), X.right_closed_bins("elevation_m", C.ELEVATION_BIN_EDGES, C.ELEVATION_BIN_LABELS).alias("b")).collect()
    assert out[0]["c"] is None and out[0]["b"] is None
    assert [r["b"] for r in out[1:]] == ["<=5", "5-20", "20-50", ">50"]
    assert out[4]["c"] == 50.0


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_exact_quantiles_match_numpy(spark, partitions):
    rng = np.random.default_rng(0)
    vals = np.round(rng.gamma(2.0, 3.0, 3000), 1)  # many ties
    vals[::7] = np.nan
    df = spark.createDataFrame(pd.DataFrame({"g": rng.integers(0, 3, 3000), "x": vals}))
    df = df.withColumn("x", F.when(F.isnan("x"), None).otherwise(F.col("x")))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g").cast("string")))  # a NULL group too
    probs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    q = order.exact_quantiles(df, ["x"], probs, ["g"]).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    pdf = df.toPandas()
    assert {r["g"] for r in q} == {None, "1", "2"}
    for r in q:
        ref = np.nanpercentile(pdf[pdf.g.isna() if r["g"] is None else pdf.g == r["g"]].x.astype(float), [p * 100 for p in probs])
        got = [r[order.quantile_name(p)] for p in probs]
        assert np.allclose(got, ref, rtol=0, atol=1e-9)


def test_positions_range_path_equals_row_number(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 500), "v": rng.integers(0, 5, 500), "k": np.arange(500)})
    df = spark.createDataFrame(pdf)
    got = order.prefix_sums(df, ["v", "k"], ["g"], partitions=7).toPandas().sort_values("k")
    exp = pdf.sort_values(["g", "v", "k"]).groupby("g").cumcount().sort_index()
    assert (got["pos"].to_numpy() == exp.to_numpy()).all()


def test_skewness_bias_corrected(spark):
    x = [1.0, 2.0, 2.0, 3.0, 10.0, 11.0, 40.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = profile.skewness(df, ["x"]).collect()[0]["skew"]
    assert math.isclose(got, pd.Series(x).skew(), rel_tol=1e-12)


def test_class_quotas_largest_remainder():
    q = folds.class_quotas([("Low", 1994), ("Medium", 574), ("High", 395)], 0.2)
    assert sum(q.values()) == math.ceil(0.2 * 2963)
    assert q == {"Low": 399, "Medium": 115, "High": 79}


def test_folds_balanced_and_disjoint(spark):
    rows = [(i, i % 7, "A" if i % 3 else "B") for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, j long, c string")
    fo = folds.stratified_folds(df, "c", ["k", "j"], ["k"], k=5, repeats=2, seed=7).toPandas()
    for (_, cls), g in fo.groupby(["repeat", "c"]):
        sizes = g.groupby("fold").size()
        assert sizes.max() - sizes.min() <= 1
    assert fo.groupby(["repeat", "k"]).size().max() == 1


def test_fold_params_ignore_validation_rows(spark):
    rows = [(i, float(i % 50), float(i % 13), float(i % 7) + 1, 5.0 + i % 11, [2, 5, 10][i % 3]) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, elevation_m double, drainage_density_km_per_km2 double, storm_drain_proximity_m double, historical_rainfall_intensity_mm_hr double, return_period_years int")
    df = df.withColumn("c", F.lit("A"))
    fo = folds.stratified_folds(df, "c", ["k"], ["k"], k=3, repeats=1)
    fl = folds.fold_long(fo, 3)
    p1 = clean.fit_common(fl.where(F.col("role") == "train"), group_cols=["fold_key"]).orderBy("fold_key").collect()
    val_of_0 = fl.where((F.col("fold_key") == 0) & (F.col("role") == "val"))
    changed = fl.withColumn("elevation_m", F.when((F.col("fold_key") != 0) & (F.col("fold") == 0), F.lit(1e9)).otherwise(F.col("elevation_m")))
    p2 = clean.fit_common(changed.where(F.col("role") == "train"), group_cols=["fold_key"]).orderBy("fold_key").collect()
    assert val_of_0.count() > 0
    assert p1[0] == p2[0]  # fold 0's statistics only see its training rows
    assert p1[1] != p2[1]


def test_metrics_formulas(spark):
    cm = [[373, 16, 10], [4, 108, 3], [1, 4, 74]]
    rows = [(i, j) for i in range(3) for j in range(3) for _ in range(cm[i][j])]
    df = spark.createDataFrame(rows, "label int, prediction int")
    s = metrics.summary(metrics.confusion(df)).collect()[0]
    m = np.array(cm, dtype=float)
    rec = np.diag(m) / m.sum(1)
    prec = np.diag(m) / m.sum(0)
    f2 = 5 * prec * rec / (4 * prec + rec)
    f1 = 2 * prec * rec / (prec + rec)
    assert math.isclose(s["f2_macro"], f2.mean(), rel_tol=1e-12)
    assert math.isclose(s["f1_weighted"], (f1 * m.sum(1)).sum() / m.sum(), rel_tol=1e-12)
    assert math.isclose(s["recall_high"], rec[2], rel_tol=1e-12)


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    pc = {r["label"]: r for r in metrics.per_class(metrics.confusion(df)).collect()}
    assert pc[2]["precision"] == 0.0 and pc[2]["recall"] == 0.0 and pc[1]["f1"] == 0.0


def test_interp_rank_matches_numpy(spark):
    tr = [1.0, 2.0, 2.0, 2.0, 5.0, 7.0, 7.0, 9.0]
    te = [0.5, 1.0, 1.5, 2.0, 3.0, 7.0, 8.0, 9.0, 12.0]
    t = spark.createDataFrame([(v,) for v in tr], "x double")
    n = spark.createDataFrame([(i, v) for i, v in enumerate(te)], "i long, x double")
    got = features.interp_percent_rank(t, n, "x", "p").orderBy("i").collect()
    ref = np.interp(te, np.sort(tr), np.linspace(0, 1, len(tr)))
    assert np.allclose([r["p"] for r in got], ref, atol=1e-12)


def test_train_percent_rank_distinct_positions(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([3, 1, 3, 2, 3])], "k long, x double")
    got = {r["k"]: r["p"] for r in features.train_percent_rank(df, "x", ["k"], "p").collect()}
    assert got == {1: 0.0, 3: 0.25, 0: 0.5, 2: 0.75, 4: 1.0}


def test_knn_exact_against_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(120, 4))
    cls = rng.integers(0, 2, 120)
    df = spark.createDataFrame([(i, int(c), [float(x) for x in p]) for i, (c, p) in enumerate(zip(cls, pts))], "id long, c int, v array<double>")
    got = balance.knn_within_class(df, "id", "v", "c", 3).collect()
    for r in got:
        same = [j for j in range(120) if cls[j] == cls[r["id"]] and j != r["id"]]
        d = sorted((float(np.linalg.norm(pts[j] - pts[r["id"]])), j) for j in same)
        assert d[r["nn_rank"]][1] == r["nn_id"]
    assert len(got) == 120 * 3


@pytest.mark.parametrize("dims, block", [(2, 16), (64, 50)])
def test_knn_in_blocks_with_ties_copies_and_a_small_class(spark, dims, block):
    rng = np.random.default_rng(dims)
    pts = np.round(rng.normal(size=(300, dims)), 1 if dims == 2 else 3)
    pts[::10] = pts[0]  # copies
    cls = ["a" if i % 3 else None for i in range(300)]
    cls[5] = cls[8] = "tiny"
    df = spark.createDataFrame([(i, c, [float(x) for x in p]) for i, (c, p) in enumerate(zip(cls, pts))], "id long, c string, v array<double>")
    got = {}
    for r in balance.knn_within_class(df.where("c is not null"), "id", "v", "c", 4, block=block).collect():
        got.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"], r["dist"]))
    for i in range(300):
        if cls[i] is not None:
            want = sorted((float(np.sqrt(((pts[j] - pts[i]) ** 2).sum())), j) for j in range(300) if cls[j] == cls[i] and j != i)[:4]
            assert [x[1] for x in sorted(got[i])] == [j for _, j in want]
            assert np.allclose([x[2] for x in sorted(got[i])], [d for d, _ in want], atol=1e-9)


def test_knn_looks_at_few_rows_in_a_plane_whatever_their_spread_along_it(spark):
    """A narrow band across the diagonal: all rows have the same projection, which left every block in reach of every other."""
    n, block = 2000, 50
    rng = np.random.default_rng(3)
    t = rng.random(n)
    pts = np.stack([t, -t], 1) + rng.normal(scale=1e-4, size=(n, 2))
    df = spark.createDataFrame([(i, 0, [float(a) for a in p]) for i, p in enumerate(pts)], "id long, c int, v array<double>")
    seen = []
    nearest = balance._nearest

    def counted(q_ids, q, p_ids, p, k):
        seen.append(len(q) * len(p))
        return nearest(q_ids, q, p_ids, p, k)

    trees = balance._thresholds(pts, block)
    place = balance._place(pts, trees)
    assert len(set(place)) >= n / block and max(np.bincount(place)) <= block
    leaves = balance._Leaves(np.arange(n), pts, block)
    assert sorted(np.concatenate(leaves.rows)) == list(range(n))
    balance._nearest = counted
    try:
        dist, ids = balance._empty(n, 3)
        for rows in leaves.rows:
            d, i = balance._empty(len(rows), 3)
            balance._search(rows, pts[rows], leaves, 3, d, i, np.full(len(rows), np.inf))
            dist[rows], ids[rows] = d, i
    finally:
        balance._nearest = nearest
    assert sum(seen) < n * block * 3  # one leaf a row and part of its neighbours, not n * n
    got = {(r["id"], r["nn_rank"]): (r["nn_id"], r["dist"]) for r in balance.knn_within_class(df, "id", "v", "c", 3, block=200, leaf=50).collect()}
    for i in range(0, n, 37):
        want = sorted((float(np.sqrt(((pts[j] - pts[i]) ** 2).sum())), j) for j in range(n) if j != i)[:3]
        assert [got[i, r][0] for r in range(3)] == [j for _, j in want] == ids[i].tolist()


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(4)
    rows = [(i, 0 if i < 40 else 1, [float(x) for x in rng.normal(size=3)]) for i in range(52)]
    df = spark.createDataFrame(rows, "id long, c int, v array<double>")
    out = balance.smote(df, "id", "v", "c", k=5).toPandas()
    assert out.groupby("c").size().to_dict() == {0: 40, 1: 40}
    base = {r[0]: np.array(r[2]) for r in rows}
    for _, r in out[out.is_synthetic == 1].iterrows():
        x = base[r["id"]]
        y = np.array(r["v"])
        # synthetic point lies on a segment from its base row towards a same-class row
        others = [np.array(v) for i, c, v in rows if c == 1 and i != r["id"]]
        assert any(np.allclose(np.cross(y - x, o - x), 0, atol=1e-9) for o in others)


def test_smote_needs_two_rows(spark):
    df = spark.createDataFrame([(1, 0, [0.0]), (2, 1, [1.0]), (3, 1, [2.0])], "id long, c int, v array<double>")
    with pytest.raises(ValueError):
        balance.smote(df, "id", "v", "c")


def test_yeo_johnson_matches_formula(spark):
    xs = [-3.0, -0.5, 0.0, 0.7, 4.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for lam in (0.0, 0.5, 2.0, -1.0):
        got = [r[0] for r in df.select(X.yeo_johnson("x", lam)).collect()]
        exp = [encode._yj(x, lam) for x in xs]
        assert np.allclose(got, exp)


def test_threshold_search_brute_force(spark):
    rng = np.random.default_rng(5)
    s = rng.normal(size=300)
    y = np.clip(np.round(s + rng.normal(scale=0.7, size=300) + 1), 0, 2).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    got = linear.threshold_search(df, "s", "y", num=12).collect()[0]
    cands = linear.linspace_candidates(float(s.min()), float(s.max()), 12)
    best, arg = -1, None
    for i, t1 in enumerate(cands):
        for j, t2 in enumerate(cands):
            if t1 >= t2:
                continue
            p = np.where(s >= t2, 2, np.where(s >= t1, 1, 0))
            f = []
            for k in range(3):
                tp = ((p == k) & (y == k)).sum()
                pr = tp / (p == k).sum() if (p == k).sum() else 0.0
                rc = tp / (y == k).sum() if (y == k).sum() else 0.0
                f.append(5 * pr * rc / (4 * pr + rc) if pr + rc else 0.0)
            if np.mean(f) > best:
                best, arg = np.mean(f), (t1, t2)
    assert math.isclose(got["f2_macro"], best, rel_tol=1e-9)
    assert (got["t1"], got["t2"]) == arg


def test_histogram_split_brute_force(spark):
    rng = np.random.default_rng(6)
    b = rng.integers(0, 6, 400)
    g = rng.normal(size=400) + (b > 2)
    df = spark.createDataFrame([(int(x), float(y), 1.0, 0) for x, y in zip(b, g)], "f_bin int, g double, h double, cls int")
    got = trees.histogram_best_split(df, ["f_bin"], min_child_samples=10).collect()[0]
    best = (-1, None)
    for t in range(6):
        L, R = g[b <= t], g[b > t]
        if len(L) < 10 or len(R) < 10:
            continue
        gain = 0.5 * (L.sum() ** 2 / (len(L) + 1) + R.sum() ** 2 / (len(R) + 1) - g.sum() ** 2 / (len(g) + 1))
        if gain > best[0]:
            best = (gain, t)
    assert got["bin"] == best[1] and math.isclose(got["gain"], best[0], rel_tol=1e-9)


def test_model_registry_unknown_key():
    from tabrisk.operators import models

    with pytest.raises(KeyError):
        models.get_model("catboost")
    assert models.get_model("Decision_Tree") is models.REGISTRY["decision_tree"]


def test_boosting_loss_decreases(spark):
    from tabrisk.operators import trees

    rng = np.random.default_rng(8)
    x = rng.integers(0, 8, 600)
    y = np.where(x < 3, 0, np.where(x < 6, 1, 2))
    y[rng.random(600) < 0.1] = 0
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)], "x_bin int, y int")
    _, losses, _, _ = trees.boost_trees(df, ["x_bin"], "y", 3, rounds=4, learning_rate=0.5, max_depth=1)
    assert all(b < a for a, b in zip(losses, losses[1:]))


def test_experiment_candidates_seeded():
    from tabrisk.plans import experiment

    a = experiment.candidates({"d": [1, 2, 3], "m": [1, 5]}, 4, 42)
    assert a == experiment.candidates({"d": [1, 2, 3], "m": [1, 5]}, 4, 42)
    assert len(a) == 4 and len({tuple(sorted(c.items())) for c in a}) == 4
    assert experiment.candidates({}, 5, 1) == [{}]


def test_fold_params_without_row_copies_equal_fold_long(spark):
    rng = np.random.default_rng(9)
    n = 900
    pdf = pd.DataFrame({
        "k": np.arange(n), "elevation_m": np.round(rng.gamma(2, 20, n), 1), "drainage_density_km_per_km2": rng.integers(1, 9, n) * 1.0,
        "storm_drain_proximity_m": np.round(rng.gamma(3, 50, n), 2), "historical_rainfall_intensity_mm_hr": rng.integers(5, 90, n) * 1.0,
        "return_period_years": rng.choice([2, 5, 10, 25], n)})
    pdf.loc[::11, "storm_drain_proximity_m"] = np.nan
    pdf.loc[::17, "elevation_m"] = -3.0
    df = spark.createDataFrame(pdf).withColumn("storm_drain_proximity_m", F.when(F.isnan("storm_drain_proximity_m"), None).otherwise(F.col("storm_drain_proximity_m")))
    df = df.withColumn("c", F.lit("A"))
    fo = folds.stratified_folds(df, "c", ["k"], ["k"], k=4, repeats=1, seed=3)
    long_fit = clean.fit_common(folds.fold_long(fo, 4).where(F.col("role") == "train"), group_cols=["fold_key"])
    a = {r["fold_key"]: r.asDict() for r in long_fit.collect()}
    b = {r["fold"]: r.asDict() for r in clean.fit_common_folds(fo, "fold", 4).collect()}
    for f in range(4):
        for key in [c for c in a[f] if c != "fold_key"]:
            assert math.isclose(a[f][key], b[f][key], rel_tol=1e-12), (f, key)


def test_boosted_trees_predict_matches_training_scores(spark):
    from tabrisk.operators import trees

    rng = np.random.default_rng(10)
    a, b = rng.integers(0, 6, 800), rng.integers(0, 6, 800)
    y = np.where((a < 2) & (b < 3), 2, np.where(a + b < 6, 1, 0))
    df = spark.createDataFrame([(i, int(x), int(z), int(t)) for i, (x, z, t) in enumerate(zip(a, b, y))], "k long, a_bin int, b_bin int, y int")
    fitted, losses, scored, init = trees.boost_trees(df, ["a_bin", "b_bin"], "y", 3, rounds=4, learning_rate=0.5, max_depth=2,
                                                     min_child_samples=5)
    assert all(q < p for p, q in zip(losses, losses[1:]))
    sc = scored.toPandas()
    arg = np.argmax(sc[["_f0", "_f1", "_f2"]].to_numpy(), axis=1)
    pred = trees.predict_trees(df, fitted, 3, init, 0.5).toPandas()
    assert (pred.sort_values("k")["prediction"].to_numpy() == arg[np.argsort(sc.index.to_numpy())]).all() or \
        (np.sort(pred["prediction"].to_numpy()) == np.sort(arg)).all()
    assert (pred["prediction"].to_numpy() == pred["y"].to_numpy()).mean() > 0.9


def test_positions_move_and_sort_the_rows_once(spark):
    rows = [(None if i % 5 == 0 else "a" if i % 2 else "b", None if i % 7 == 0 else float(i % 11), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v double, k int").repartition(3)
    for n in (1, 8, 64):
        out = order.positions(df, [F.desc("v"), "k"], ["g"], "pos", total_col="n", partitions=n)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Window [") == 2 and plan.count("Exchange hashpartitioning") == 2  # those of the partitions' sizes; one more each, of all rows, before
        got = out.collect()
        assert out.columns == ["g", "v", "k", "pos", "n"] and len(got) == 500
        for g in (None, "a", "b"):
            part = sorted((r for r in got if r["g"] == g), key=lambda r: (r["v"] is None, -(r["v"] or 0.0), r["k"]))
            assert [r["pos"] for r in part] == list(range(len(part))) and {r["n"] for r in part} == {len(part)}


def test_boosting_sums_up_in_the_tasks_and_writes_no_row_a_class(spark, monkeypatch):
    from tabrisk import session
    from tabrisk.operators import trees

    rng = np.random.default_rng(12)
    a, b, y = rng.integers(0, 5, 700), rng.integers(0, 4, 700), rng.integers(0, 3, 700)
    y = np.where(a < 2, 0, np.where(b < 2, 1, y))
    df = spark.createDataFrame([(None if i % 50 == 0 else int(p), int(q), int(t)) for i, (p, q, t) in enumerate(zip(a, b, y))], "a_bin int, b_bin int, y int")
    written = []
    keep = session.keep_rows
    monkeypatch.setattr(session, "keep_rows", lambda d: written.append(d.columns) or keep(d))
    fitted, losses, scored, init = trees.boost_trees(df, ["a_bin", "b_bin"], "y", 3, rounds=2, learning_rate=0.5, max_depth=2, min_child_samples=5)
    assert not written  # a row for each class and round before
    # the first trees from plain sums; a NULL bin counts as the lowest in a split and its rows go right
    x = np.stack([np.where(np.arange(700) % 50 == 0, -1, a), b], 1)
    p = np.bincount(y, minlength=3) / 700
    assert np.isclose(losses[0], -np.log(p[y]).mean())
    for c in range(3):
        g, h = p[c] - (y == c), np.full(700, p[c] * (1 - p[c]))
        s = lambda on: g[on].sum() ** 2 / (h[on].sum() + 1.0)
        best = max(((round(0.5 * (s(x[:, f] <= v) + s(x[:, f] > v) - s(x[:, f] > -9)), 9), -f, -v) for f in (0, 1) for v in sorted(set(x[:, f]))[:-1] if (x[:, f] <= v).sum() >= 5))
        _, _, splits, leaves = fitted[c]
        assert splits[0] == (["a_bin", "b_bin"][-best[1]], -best[2])
        node = np.zeros(700, int)
        for i in (0, 1, 2):
            if i in splits:
                f, v = splits[i]
                f = ["a_bin", "b_bin"].index(f)
                left = (x[:, f] >= 0) & (x[:, f] <= v)
                node = np.where(node == i, np.where(left, 2 * i + 1, 2 * i + 2), node)
        assert {i: round(-g[node == i].sum() / (h[node == i].sum() + 1.0), 9) for i in set(node.tolist())} == {i: round(v, 9) for i, v in leaves.items()}


def test_null_groups_values_and_a_hot_key_keep_their_rows(spark):
    rows = [(None if i % 5 == 0 else "a", None if i % 7 == 0 else (1.0 if i % 3 else float(i)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, k int")
    for n in (1, 8, 64):
        got = order.prefix_sums(df, ["v", "k"], ["g"], partitions=n, total_col="n").collect()
        assert len(got) == 400
        for g in (None, "a"):
            part = sorted((r for r in got if r["g"] == g), key=lambda r: (r["v"] is not None, r["v"] or 0.0, r["k"]))
            assert [r["pos"] for r in part] == list(range(len(part))) and {r["n"] for r in part} == {len(part)}
    ranked = {(r["g"], r["v"]): (r["before"], r["n"]) for r in order.value_counts_ranked(df, "v", ["g"]).collect()}
    for g in (None, "a"):
        vals = [v for x, v, _ in rows if x == g]
        for v in set(vals):
            less = sum(w is not None and (v is None or w < v) for w in vals)
            assert ranked[g, v] == (less, len(vals))


def test_repeats_of_the_folds_are_independent(spark):
    df = spark.range(20_000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("cls"))
    f = folds.stratified_folds(df, "cls", ["id"], ["id"], k=5, repeats=2, seed=3)
    a, b = (f.where(F.col("repeat") == r).select("id", "cls", F.col("fold").alias(f"f{r}")) for r in (0, 1))
    cells = {(r["cls"], r["f0"], r["f1"]): r["count"] for r in a.join(b, ["id", "cls"]).groupBy("cls", "f0", "f1").count().collect()}
    assert len(cells) == 75
    for (cls, _, _), n in cells.items():
        mean = sum(v for (c, _, _), v in cells.items() if c == cls) / 25
        assert abs(n - mean) < 5 * math.sqrt(mean)


def test_smote_draws_are_spread(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=3)], 0) for i in range(1500)] + [(2000 + i, [float(x) for x in rng.normal(size=3)], 1) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label int")
    base = {r[0]: np.array(r[1]) for r in rows if r[2] == 1}
    out = [r for r in balance.smote(df, "id", "vec", "label").collect() if r["is_synthetic"]]
    assert len(out) == 1460
    us, ranks = [], []
    for r in out:
        x, p = base[r["id"]], np.array(r["vec"])
        near = sorted((np.linalg.norm(x - q), i) for i, q in base.items() if i != r["id"])[:5]
        fits = [(k, np.dot(p - x, base[i] - x) / np.dot(base[i] - x, base[i] - x)) for k, (_, i) in enumerate(near)]
        k, u = min(fits, key=lambda f: np.linalg.norm(x + f[1] * (base[near[f[0]][1]] - x) - p))
        us.append(u)
        ranks.append(k)
    assert 0.45 < np.mean(us) < 0.55 and np.std(us) > 0.25
    assert min(ranks.count(k) for k in range(5)) > 1460 / 5 * 0.75


def test_goss_takes_exact_counts(spark):
    df = spark.range(5_000).select("id", F.pmod(F.col("id"), F.lit(4)).cast("double").alias("g"))
    s = trees.goss_sample(df, "g", ["id"], 0.2, 0.1, 7, X.seeded_hash).collect()
    assert sorted([r["goss_weight"] for r in s]) == [1.0] * 1000 + [8.0] * 500
    assert all(r["g"] == 3.0 for r in s if r["goss_weight"] == 1.0) and len({r["id"] for r in s}) == 1500


def test_bundles_are_coloured_by_conflict_count():
    conf = [("a", "b", 0.001), ("a", "c", 0.001), ("a", "d", 0.001), ("e", "f", 0.9)]
    assert trees.bundle_features(conf, list("abcdef"), 0.0) == [["a", "e"], ["b", "c", "d", "f"]]


def test_yeo_johnson_fit_has_no_bounds(spark):
    rng = np.random.default_rng(5)
    x = 100.0 + rng.normal(size=400) * 5.0
    x = np.sign(x) * np.abs(x) ** 0.12  # best lambda far above two
    df = spark.createDataFrame(pd.DataFrame({"x": x, "flat": 1.0}))
    got = encode.fit_yeo_johnson(df, ["x", "flat"])

    def llf(lam):
        y = np.expm1(lam * np.log1p(x)) / lam
        return -len(x) / 2 * np.log(y.var()) + (lam - 1) * np.log1p(x).sum()

    assert got["flat"] == 1.0 and got["x"] > 2.5
    assert llf(got["x"]) >= max(llf(got["x"] + d) for d in (-1e-3, 1e-3, -0.1, 0.1))


def test_train_metrics_come_from_the_folds_own_model(spark):
    rows = [("m", 0, f, role, y, p) for f in (0, 1) for role, y, p in [("train", 0, 0), ("train", 1, 1), ("train", 2, 2), ("val", 0, 1), ("val", 1, 1), ("val", 2, 0)]]
    preds = spark.createDataFrame(rows, "model string, repeat int, fold int, role string, label int, prediction int")
    r = experiment.cv_summary(experiment.cv_fold_metrics(preds)).collect()[0]
    assert r["train_f2_macro_mean"] == 1.0 and r["f2_macro_mean"] < 0.5 and r["gap"] > 0.5 and r["overfit"] == 1


def test_row_alignment_counts_each_side(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z"), (5, "q")], "k int, c string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (None, "w"), (9, "x")], "k int, c string")
    got = {r["side"]: (r["n"], r["n_class_differs"]) for r in ranking.row_alignment(a, b, ["k"], "c").collect()}
    assert got == {"matched": (3, 1), "only_raw": (2, 0), "only_prepared": (1, 0)}


def test_rebalance_smote_adds_rows_of_training_features_only(spark):
    rng = np.random.default_rng(2)
    rows = [(float(x), float(y), int(i % 4 == 0)) for i, (x, y) in enumerate(rng.normal(size=(80, 2)))]
    df = spark.createDataFrame(rows, f"a double, b double, {ablation.LABEL} int")
    out, weight = ablation.rebalance(df, ["a", "b"], "smote")
    assert weight is None and out.columns == ["a", "b", ablation.LABEL]
    assert {r[0]: r[1] for r in out.groupBy(ablation.LABEL).count().collect()} == {0: 60, 1: 60}
    assert ablation.rebalance(df, ["a"], "none") == (df, None)
    assert ablation.rebalance(df, ["a"], "weighted", {0: 1.0, 1: 3.0})[1] == "weight"


def test_a_failing_config_is_recorded_and_the_others_go_on(spark, monkeypatch):
    def fake(folds, k, cfg, keys):
        if cfg.name == "bad":
            raise ValueError("no such thing")
        return spark.createDataFrame([(cfg.name, cfg.model, 0.5, "ok")], "config string, model string, f2_macro_mean double, status string")

    monkeypatch.setattr(ablation, "run_cv", fake)
    cfgs = [ablation.Config("good"), ablation.Config("bad")]
    got = {r["config"]: (r["f2_macro_mean"], r["status"]) for r in ablation.run_grid(spark.range(1), 2, cfgs, [], "e").collect()}
    assert got == {"good": (0.5, "ok"), "bad": (None, "ValueError: no such thing")}
    with pytest.raises(ValueError, match="no such thing"):
        ablation.run_grid(spark.range(1), 2, cfgs[1:], [], "e")


def test_artefact_gate_and_manifest(spark):
    from tabrisk.plans import catalog, final
    from tabrisk.sources import io as sio

    rows = [(float(i % 7), float(i % 5), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    for key in ("decision_tree", "ridge_ordinal", "dummy"):
        fitted = models.fit_model(key, df, ["a", "b"], "y", params={})
        path = sio.scratch_path(spark, "model")
        fitted.save(path)
        again = models.load_fitted(spark, path)
        assert [r["prediction"] for r in again.predict(df).collect()] == [r["prediction"] for r in fitted.predict(df).collect()]
    got = catalog.QUERIES["final_evaluation_gated"](spark, "/root/testdata/sf0.001").collect()[0]
    assert got["stage"] == "fitted" and got["f2_macro"] > 0.5
    with pytest.raises(ValueError, match="incomplete artefact"):
        final.evaluate_on_test(spark, sio.scratch_path(spark, "nothing"), df)
    raw = catalog.seg_labelled(spark, "/root/testdata/sf0.001")
    prep = catalog.prepare.fit_tree(raw)
    whole = sio.scratch_path(spark, "whole")
    final.save_pipeline(prep, models.fit_model("dummy", prepare_rows(raw, prep), prep.feature_cols, "risk_class_encoded"), whole, seed=1)
    with pytest.raises(ValueError, match="incompatible"):
        final.load_pipeline(spark, whole, {"seed": 2})
    manifest = sio.scratch_path(spark, "manifest")
    for stage in ("tuned", "fitted"):
        sio.append_manifest(spark, manifest, "m", {"stage": stage})
    sio.append_manifest(spark, manifest, "n", {"stage": "tuned"})
    assert {k: v["stage"] for k, v in sio.read_manifest(spark, manifest).items()} == {"m": "fitted", "n": "tuned"}


def prepare_rows(raw, prep):
    from tabrisk.plans import prepare

    return prepare.transform_tree(raw, prep)


def test_dummy_strategies(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, 1).otherwise(0).alias("y"))
    prior = models.fit_model("dummy", df, [], "y", params={"strategy": "prior"})
    assert prior.info["prior"] == {"0": 0.75, "1": 0.25} and {r["prediction"] for r in prior.predict(df).collect()} == {0}
    drawn = models.fit_model("dummy", df, [], "y", params={"strategy": "stratified", "key_cols": ["id"]}).predict(df)
    assert abs(drawn.where("prediction = 1").count() - 1000) < 150
    with pytest.raises(ValueError):
        models.fit_model("dummy", df, [], "y", params={"strategy": "other"})
