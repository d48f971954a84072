"""Booster, forest and draws against plain numpy versions."""

import hashlib
import itertools
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrisk.operators import boosting, forest, sampling, treetable, trees

FEATURES = ["a", "b", "c", "d"]


def table(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(2), rng.integers(0, 5, n), rng.exponential(size=n).round(1), rng.integers(0, 2, n)]).astype(float)
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] + x[:, 2] > 3.5)).astype(int)
    flip = rng.random(n) < 0.1
    y[flip] = rng.integers(0, 3, flip.sum())
    return x, y


def frame(spark, x, y, label="y"):
    return spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, " + label + " double")


# ------------------------------------------------------------- plain booster ---
def sig(v):
    return float(f"{v:.10g}")


def soft(g, a):
    return np.sign(g) * max(abs(g) - a, 0.0)


def plain_tree(xb, g, h, p, bins, allowed):
    """Leaf-wise growth over row numbers, every leaf looked at again at every step."""

    def split(rows):
        best = (-np.inf,)
        score = lambda a, b: soft(a, p.reg_alpha) ** 2 / (b + p.reg_lambda)
        for f in allowed:
            for b in range(bins[f] - 1):
                left = rows[xb[rows, f] <= b]
                right = rows[xb[rows, f] > b]
                if min(len(left), len(right)) < p.min_child_samples:
                    continue
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[right].sum(), h[right].sum()
                gain = sig(0.5 * (score(gl, hl) + score(gr, hr) - score(gl + gr, hl + hr)))
                if gain > best[0] and gain > p.min_split_gain:
                    best = (gain, f, b, left, right)
        return best

    leaves, splits = [(np.flatnonzero(h >= 0), 0)], []
    while len(leaves) < p.num_leaves:
        found = [split(r) if d < p.max_depth and len(r) >= 2 * p.min_child_samples else (-np.inf,) for r, d in leaves]
        k = int(np.argmax([f[0] for f in found]))
        if found[k][0] == -np.inf:
            break
        gain, f, b, left, right = found[k]
        d = leaves.pop(k)[1]
        splits.append((f, b, gain, len(left) + len(right)))
        leaves += [(left, d + 1), (right, d + 1)]
    value = np.zeros(len(xb))
    for rows, _ in leaves:
        e = soft(g[rows].sum(), p.reg_alpha)
        value[rows] = -e / (h[rows].sum() + p.reg_lambda) if e else 0.0
    return splits, value


def softmax(s):
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def binned(x, edges, names=FEATURES):
    return np.column_stack([np.searchsorted(edges[f][1:-1], x[:, i], side="right") for i, f in enumerate(names)])


@pytest.mark.parametrize("kw", [{}, {"num_leaves": 5, "reg_alpha": 2.0, "min_split_gain": 0.5}, {"max_depth": 2, "reg_lambda": 5.0}, {"colsample_bytree": 0.5}])
def test_leafwise_softmax_equals_brute_force(spark, kw):
    x, y = table()
    df = frame(spark, x, y)
    p = boosting.Params(**{"n_estimators": 3, "learning_rate": 0.3, "num_leaves": 9, "min_child_samples": 15, "max_bin": 16, "max_depth": 4, **kw})
    m = boosting.fit(df, FEATURES, "y", p)
    edges = m.columns.edges
    xb, bins = binned(x, edges), [max(1, len(edges[f])) for f in FEATURES]
    counts = np.bincount(y, minlength=3) + 1e-8
    s = np.tile(np.log(counts / counts.sum()), (len(x), 1))
    for r in range(3):
        q = softmax(s)
        allowed = sampling.columns_drawn(4, p.colsample_bytree, p.seed, r)
        for k in range(3):
            splits, value = plain_tree(xb, q[:, k] - (y == k), q[:, k] * (1 - q[:, k]), p, bins, allowed)
            tree = m.rounds[r][k]
            inner = [n for n in tree if n.feature]
            assert sorted((FEATURES.index(n.feature), int(n.threshold), n.n) for n in inner) == sorted((f, b, n) for f, b, _, n in splits)
            assert np.allclose(sorted(n.gain for n in inner), sorted(g for _, _, g, _ in splits), rtol=1e-8)
            s[:, k] += p.learning_rate * value
        loss = -np.log(np.clip(softmax(s)[np.arange(len(y)), y], 1e-8, 1)).mean()
        assert abs(m.losses[r] - loss) < 1e-9
    got = np.array([r.scores for r in m.score(df).orderBy("id").collect()])
    assert np.allclose(got, s)
    part = np.array([r.scores for r in m.score(df, num_iteration=1).orderBy("id").collect()])
    assert not np.allclose(part, s) and np.allclose(np.array([r.scores for r in m.score(df, num_iteration=0).collect()]), m.start)
    assert [r.prediction for r in m.predict(df).orderBy("id").collect()] == s.argmax(1).tolist()
    # only the smaller child is counted
    assert all(2 * w["rows_counted"] <= w["rows_of_split_nodes"] for w in m.work)


@pytest.mark.parametrize("objective", ["binary", "mse"])
def test_one_score_objectives_and_early_stopping(spark, objective):
    x, y = table(400)
    target = (y > 0).astype(float) if objective == "binary" else x[:, 0] * 2 + x[:, 2]
    df, valid = frame(spark, x[:300], target[:300]), frame(spark, x[300:], target[300:])
    p = boosting.Params(objective=objective, n_estimators=12, learning_rate=0.8, num_leaves=12, min_child_samples=5, max_bin=32, early_stopping_rounds=2, reg_lambda=0.1)
    m = boosting.fit(df, FEATURES, "y", p, valid=valid)
    assert all(b < a for a, b in zip(m.losses, m.losses[1:]))
    best = int(np.argmin(m.val_losses))
    assert m.best_iteration == best + 1
    assert len(m.rounds) == len(m.val_losses) == (best + 3 if best + 3 <= 12 else 12)
    xb, bins = binned(x[:300], m.columns.edges), [max(1, len(m.columns.edges[f])) for f in FEATURES]
    t = target[:300]
    s = np.full(300, np.log(t.mean() / (1 - t.mean())) if objective == "binary" else t.mean())
    for r in range(len(m.rounds)):
        q = 1 / (1 + np.exp(-s))
        g, h = (q - t, q * (1 - q)) if objective == "binary" else (s - t, np.ones(300))
        s = s + 0.8 * plain_tree(xb, g, h, p, bins, range(4))[1]
    loss = ((s - t) ** 2).mean() if objective == "mse" else -(t * np.log(1 / (1 + np.exp(-s))) + (1 - t) * np.log(1 - 1 / (1 + np.exp(-s)))).mean()
    assert abs(loss - m.losses[-1]) < 1e-8
    pred = [r.prediction for r in m.predict(df).orderBy("id").collect()]
    assert pred == (s >= 0).astype(int).tolist() if objective == "binary" else np.allclose(pred, s)


def test_goss_inside_the_rounds(spark):
    x, y = table(500)
    df = frame(spark, x, y)
    p = boosting.Params(n_estimators=2, num_leaves=4, min_child_samples=5, max_bin=16, use_goss=True, top_rate=0.2, other_rate=0.1)
    m = boosting.fit(df, FEATURES, "y", p, keys=["id"])
    assert [t[0].n for r in m.rounds for t in r] == [150] * 6  # the rows drawn
    g = df.withColumn("g", F.abs(F.col("a")))
    w = g.withColumn("w", sampling.goss_weight(g, F.col("g"), ["id"], 0.2, 0.1, 5)).where("w > 0")
    old = trees.goss_sample(g, "g", ["id"], 0.2, 0.1, 5, lambda k, s: sampling.wide_hash(k, s))
    assert {r.w: r["count"] for r in w.groupBy("w").count().collect()} == {r.goss_weight: r["count"] for r in old.groupBy("goss_weight").count().collect()} == {1.0: 100, 8.0: 50}
    want = sorted(abs(v) for v in x[:, 0])[-100:]
    assert sorted(r.g for r in w.where("w = 1").collect()) == want
    # the drawn rows' weights enter the sums: the root's value is that of the weighted rows
    q = np.exp(m.start)
    size = np.abs(q[None, :] - np.eye(3)[y]).mean(1)
    d = df.withColumn("s", F.element_at(F.array(*[F.lit(float(size[y == k][0])) for k in range(3)]), F.col("y").cast("int") + 1))
    drawn = {r.id: r.w for r in d.withColumn("w", sampling.goss_weight(d, F.col("s"), ["id"], 0.2, 0.1, 42, 0)).where("w > 0").collect()}
    rows, ws = np.array(list(drawn)), np.array(list(drawn.values()))
    gk, hk = (q[0] - (y[rows] == 0)) * ws, q[0] * (1 - q[0]) * ws
    root_children = [n for n in m.rounds[0][0] if n.depth == 1]
    inner = m.rounds[0][0][0]
    left = x[rows, FEATURES.index(inner.feature)] < inner.cut
    assert [n.n for n in root_children] == [left.sum(), (~left).sum()]
    if root_children[0].feature is None:
        assert abs(root_children[0].value + gk[left].sum() / (hk[left].sum() + 1)) < 1e-9


def test_bundles_give_the_same_trees(spark):
    rng = np.random.default_rng(5)
    n = 800
    kind = rng.integers(0, 6, n)
    num = rng.normal(size=n).round(2)
    y = ((kind % 3) + (num > 0.5)) % 3
    names = [f"is_{k}" for k in range(6)] + ["num"]
    df = spark.createDataFrame([(i, *[float(k == kind[i]) for k in range(6)], float(num[i]), int(y[i])) for i in range(n)], "id long, " + ", ".join(f"{c} double" for c in names) + ", y int")
    edges = boosting.value_edges(df, names, 16)
    assert edges["is_0"] == [0.0, 1.0, 1.0]
    kw = dict(n_estimators=2, num_leaves=8, min_child_samples=5, max_bin=16)
    a = boosting.fit(df, names, "y", boosting.Params(**kw), edges=edges)
    b = boosting.fit(df, names, "y", boosting.Params(**kw, use_efb=True), edges=edges)
    assert len(b.columns.bundles) == 2 and sorted(map(len, b.columns.bundles)) == [1, 6]
    assert sum(b.columns.bins) < sum(a.columns.bins)  # fewer histogram rows
    strip = lambda m: [[(n.depth, n.n, n.feature, n.cut, round(n.gain, 8), round(n.value, 9)) for n in t] for r in m.rounds for t in r]
    assert strip(a) == strip(b) and np.allclose(a.losses, b.losses)
    assert {r.id: r.prediction for r in a.predict(df).collect()} == {r.id: r.prediction for r in b.predict(df).collect()}
    # conflicts: the first feature out of its lowest bin counts, the column stays within its bins
    both = df.withColumn("is_1", F.lit(1.0))
    top = b.columns.binned(both).agg(F.max(F.array_max("_x"))).first()[0]
    assert top < max(b.columns.bins)


def test_saved_booster_and_importances(spark, tmp_path):
    x, y = table(300)
    df = frame(spark, x, y)
    m = boosting.fit(df, FEATURES, "y", boosting.Params(n_estimators=2, num_leaves=5, max_bin=16, use_goss=True), keys=["id"])
    m.save(spark, str(tmp_path / "m"))
    back = boosting.Booster.load(spark, str(tmp_path / "m"))
    assert back.rounds == m.rounds and back.params == m.params and back.columns == m.columns
    import duckdb

    path = str(tmp_path / "m/nodes/*.parquet")
    want = duckdb.sql(f"SELECT feature, count(*) AS n_splits, sum(gain) AS total_gain FROM read_parquet('{path}') WHERE feature IS NOT NULL GROUP BY feature").fetchall()
    got = [tuple(r) for r in treetable.importances(m.table(spark)).collect()]
    assert {f: (n, round(g, 9)) for f, n, g in got} == {f: (n, round(g, 9)) for f, n, g in want}
    assert sum(n for _, n, _ in got) == sum(1 for r in m.rounds for t in r for n in t if n.feature)


def test_booster_edges(spark):
    x, y = table(60)
    df = frame(spark, x, y)
    none = boosting.fit(df, FEATURES, "y", boosting.Params(n_estimators=2, min_child_samples=100))
    assert all(len(t) == 1 for r in none.rounds for t in r)  # no split allowed: stumps without one
    one = boosting.fit(df.withColumn("y", F.lit(0.0)), FEATURES, "y", boosting.Params(n_estimators=1, min_child_samples=5))
    assert {r.prediction for r in one.predict(df).collect()} == {0}
    gaps = df.withColumn("a", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("a"))).withColumn("y", F.when(F.col("id") == 5, None).otherwise(F.col("y")))
    m = boosting.fit(gaps, FEATURES, "y", boosting.Params(n_estimators=1, min_child_samples=5))
    assert m.rounds[0][0][0].n == 59 and m.predict(gaps).where("prediction is null").count() == 0
    with pytest.raises(ValueError, match="objective"):
        boosting.fit(df, FEATURES, "y", boosting.Params(objective="x"))
    with pytest.raises(ValueError, match="key"):
        boosting.fit(df, FEATURES, "y", boosting.Params(subsample=0.5))


# -------------------------------------------------------------------- draws ---
def md5(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def test_draws_are_exact(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    drawn = df.where(sampling.subsample(df, ["k"], 0.37, 42, 3)).collect()
    assert sorted(r.k for r in drawn) == sorted(sorted(range(1000), key=lambda k: md5(42, 3, k))[:370])
    assert df.where(sampling.subsample(df, ["k"], 0.0001, 1)).count() == 1 and df.where(sampling.subsample(df, ["k"], 1.0, 1)).count() == 1000
    order = sorted(range(1000), key=lambda k: md5(7, k))
    want = np.zeros((1000, 3), int)
    for t in range(3):
        for j in range(1000):
            want[order[md5(7, t, j) % 1000], t] += 1
    got = {r.k: r.weights for r in sampling.bootstrap(df.repartition(7), ["k"], 3, 7).collect()}
    assert [got[k] for k in range(1000)] == want.tolist() and want.sum(0).tolist() == [1000] * 3
    assert sampling.bootstrap(df.limit(0), ["k"], 3, 7).count() == 0


def test_bootstrap_moves_each_draw_once(spark, monkeypatch):
    df = spark.range(300).select(F.col("id").alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    w = sampling.bootstrap(df, ["k"], 3, 7)
    # rows by place and by position, draws by position; the draws were shuffled by position and tree too
    plan = w._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 3
    few = {r.k: r.weights for r in w.collect()}
    monkeypatch.setattr(sampling, "FEW_TREES", 0)
    monkeypatch.setattr(sampling, "DRAWS_A_TASK", 100)
    many = {r.k: r.weights for r in sampling.bootstrap(df, ["k"], 3, 7).collect()}
    assert few == many and [sum(x) for x in zip(*few.values())] == [300] * 3


def test_cut_with_ties_and_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 1 << 60, 500), np.full(300, 12345), rng.integers(0, 50, 200)])
    df = spark.createDataFrame([(int(v),) for v in values], "v long")
    for few in (20_000, 0):
        monkeypatch.setattr(sampling, "FEW", few)
        for m in (0, 1, 100, 250, 499, 700, 1000, 2000):
            v, t = sampling.cut(df, F.col("v"), m)
            below = int((values < v).sum())
            assert below + t == min(m, 1000), (few, m)
            assert t <= (values == v).sum()


# --------------------------------------------------------- plain exact trees ---
def plain_exact(x, y, p, columns, depth=0):
    def imp(v):
        q = [np.sum(v == c) / len(v) for c in range(3)]
        if p.criterion == "gini":
            s = 0.0
            for z in q:
                s += z * z
            return 1.0 - s
        return sum(-z * np.log2(z) if z > 0 else 0.0 for z in q)

    leaf = int(np.argmax(np.bincount(y, minlength=3)))
    if (p.max_depth is not None and depth >= p.max_depth) or len(set(y.tolist())) == 1 or len(y) < p.min_samples_split:
        return leaf
    best = (np.inf,)
    for f in columns:
        for t in np.unique(x[:, f]):
            left = x[:, f] <= t
            if left.sum() < p.min_samples_leaf or (~left).sum() < max(1, p.min_samples_leaf):
                continue
            i = (left.sum() / len(y)) * imp(y[left]) + ((~left).sum() / len(y)) * imp(y[~left])
            if i < best[0]:
                best = (i, f, float(t), left)
    if best[0] == np.inf:
        return leaf
    _, f, t, left = best
    return (f, t, plain_exact(x[left], y[left], p, columns, depth + 1), plain_exact(x[~left], y[~left], p, columns, depth + 1))


def as_nested(tree, i=0):
    n = tree[i]
    return int(n.value) if n.feature is None else (n.col, n.threshold, as_nested(tree, n.left), as_nested(tree, n.right))


@pytest.mark.parametrize("kw", [{"max_depth": 4}, {"criterion": "entropy", "min_samples_leaf": 7, "max_depth": 5}, {"min_samples_split": 60}])
def test_exact_tree_equals_brute_force(spark, kw):
    x, y = table(300)
    p = forest.Params(**kw)
    m = forest.fit(frame(spark, x, y), FEATURES, "y", p)
    assert as_nested(m.trees[0]) == plain_exact(x, y, p, range(4))


def test_forest_equals_brute_force_given_the_draws(spark, tmp_path):
    x, y = table(250)
    df = frame(spark, x, y)
    p = forest.Params(n_estimators=5, max_depth=4, max_features="sqrt", bootstrap=True, min_samples_leaf=2)
    m = forest.fit(df, FEATURES, "y", p, keys=["id"])
    w = np.array([r.weights for r in sampling.bootstrap(df, ["id"], 5, p.seed).orderBy("id").collect()])
    votes = []
    for t in range(5):
        assert len(m.subsets[t]) == 2
        rows = np.repeat(np.arange(250), w[:, t])
        tree = plain_exact(x[rows], y[rows], p, m.subsets[t])
        assert as_nested(m.trees[t]) == tree

        def walk(r, node):
            while isinstance(node, tuple):
                node = node[2] if r[node[0]] <= node[1] else node[3]
            return node

        votes.append([walk(r, tree) for r in x])
    want = [int(np.argmax(np.bincount(v, minlength=3))) for v in np.array(votes).T]
    assert [r.prediction for r in m.predict(df).orderBy("id").collect()] == want
    m.save(spark, str(tmp_path / "f"))
    back = forest.Forest.load(spark, str(tmp_path / "f"))
    assert back.trees == m.trees and [r.prediction for r in back.predict(df).orderBy("id").collect()] == want


def test_forest_edges(spark):
    x, y = table(120)
    df = frame(spark, x, y)
    assert [forest.features_per_tree(9, v) for v in (None, "all", "sqrt", "log2", 0.5, 1.0, 3, 50)] == [9, 9, 3, 3, 4, 9, 3, 9]
    one = forest.fit(df.withColumn("y", F.lit(1)), FEATURES, "y")
    assert len(one.trees[0]) == 1 and {r.prediction for r in one.predict(df).collect()} == {1}
    gaps = df.withColumn("a", F.when(F.col("id") % 4 == 0, float("nan")).when(F.col("id") % 4 == 1, None).otherwise(F.col("a")))
    m = forest.fit(gaps, FEATURES, "y", forest.Params(max_depth=3))
    top = x.copy()
    top[np.arange(120) % 4 < 2, 0] = np.inf
    assert as_nested(m.trees[0]) == plain_exact(top, y, forest.Params(max_depth=3), range(4))
    b = forest.fit(df, FEATURES, "y", forest.Params(max_depth=3, max_bins=8))
    raised = np.column_stack([[next(e for e in b.edges[f] if e >= v) for v in x[:, i]] for i, f in enumerate(FEATURES)])
    assert as_nested(b.trees[0]) == plain_exact(raised, y, forest.Params(max_depth=3), range(4))
    with pytest.raises(ValueError, match="key"):
        forest.fit(df, FEATURES, "y", forest.Params(bootstrap=True))


def test_growth_does_not_depend_on_partitions(spark):
    x, y = table(300)
    p = boosting.Params(n_estimators=1, num_leaves=7, max_bin=16, min_child_samples=5)
    a, b = (boosting.fit(frame(spark, x, y).repartition(k), FEATURES, "y", p) for k in (1, 9))
    for s, t in itertools.zip_longest(a.rounds[0], b.rounds[0]):
        assert [(n.feature, n.threshold, n.n) for n in s] == [(n.feature, n.threshold, n.n) for n in t]


def test_presets_save_and_load(spark, tmp_path):
    from tabrisk.operators import models

    x, y = table(200)
    df = frame(spark, x, y).withColumn("y", F.col("y").cast("int"))
    for key, params in (("lgbm", {}), ("XGB_Scratch_GOSS_EFB", {}), ("histgb_efb", {}), ("decision_tree_exact", {"max_depth": 3}), ("rf_scratch", {"max_depth": 3})):
        own = {} if "tree" in key else {"n_estimators": 2, "key_cols": ["id"]}
        f = models.fit_model(key, df, FEATURES, "y", params={**params, **own})
        f.save(str(tmp_path / key))
        back = models.load_fitted(spark, str(tmp_path / key))
        want = [r.prediction for r in f.predict(df).orderBy("id").collect()]
        assert [r.prediction for r in back.predict(df).orderBy("id").collect()] == want and set(want) <= {0, 1, 2}
        assert "prediction" in f.predict(df.drop("y")).columns
    with pytest.raises(TypeError):
        models.fit_model("rf_scratch", df.withColumn("w", F.lit(1.0)), FEATURES, "y", "w")
    with pytest.raises(KeyError):
        models.get_model("nothing")


def test_saved_dummy_draws_the_same_classes(spark, tmp_path):
    from tabrisk.operators import models

    x, y = table(300)
    df = frame(spark, x, y).withColumn("y", F.col("y").cast("int"))
    f = models.fit_model("dummy", df, FEATURES, "y", params={"strategy": "stratified", "key_cols": ["id"]})
    f.save(str(tmp_path / "d"))
    want = [r.prediction for r in f.predict(df).orderBy("id").collect()]
    assert [r.prediction for r in models.load_fitted(spark, str(tmp_path / "d")).predict(df).orderBy("id").collect()] == want
    share = np.bincount(want, minlength=3) / 300
    assert np.abs(share - np.bincount(y, minlength=3) / 300).max() < 0.1 and len(set(want)) == 3


def test_a_drawn_round_reads_the_drawn_rows_alone(spark, monkeypatch):
    x, y = table(300)
    read, real = [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda rows, *a: read.append(rows.count()) or real(rows, *a))
    p = boosting.Params(n_estimators=2, num_leaves=4, min_child_samples=5, max_bin=16)
    boosting.fit(frame(spark, x, y), FEATURES, "y", replace(p, use_goss=True), keys=["id"])
    boosting.fit(frame(spark, x, y), FEATURES, "y", replace(p, subsample=0.5), keys=["id"])
    assert read == [90, 90, 150, 150]
