import numpy as np
import pytest

from tabrisk.llm import hnsw

VEC = "vec_id long, embedding array<float>"


def brute(rows, k=20, every=20, measure="inner_product"):
    """[(query, rank, vec_id)] with every pair compared."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)})
    out = []
    for q in sorted({i for i, _ in good if i % every == 0}):
        best = {}
        for i, a in ((i, np.array(v, float)) for i, v in good if i == q):
            for j, v in good:
                b = np.array(v, float)
                if j != q and len(a) == len(b):
                    s = sum(x * y for x, y in zip(a.tolist(), b.tolist()))
                    s = s / (np.linalg.norm(a) * np.linalg.norm(b)) if measure == "cosine" else s
                    best[j] = max(best.get(j, -np.inf), s)
        out += [(q, r + 1, j) for r, (j, _) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return out


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id) for r in df.collect())


def clustered(n=3000, dims=24, seed=3):
    """Singles, a third of near copies of one vector, and vectors of very different lengths."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[: n // 3] = x[0] + 0.05 * rng.normal(size=(n // 3, dims))
    x *= rng.choice([0.5, 1.0, 3.0], (n, 1))
    order = rng.permutation(n)
    return [(int(i), [float(c) for c in np.float32(x[k])]) for i, k in enumerate(order)]


@pytest.mark.parametrize("measure", ["inner_product", "cosine"])
def test_recall_over_shards(spark, measure):
    rows = clustered()
    df = spark.createDataFrame(rows, VEC)
    got = found(hnsw.nearest(df, measure=measure, shard_rows=1000, ef=128))
    want = brute(rows, measure=measure)
    assert len(got) == len(want)
    share = len({(q, j) for q, _, j in got} & {(q, j) for q, _, j in want}) / len(want)
    assert share >= 0.95, share


def test_exact_scores_and_order(spark):
    rows = clustered(600)
    vec = dict(rows)
    for r in hnsw.nearest(spark.createDataFrame(rows, VEC), shard_rows=200).collect():
        total = 0.0
        for a, b in zip(vec[r.query_id], vec[r.vec_id]):
            total += float(np.float32(a)) * float(np.float32(b))
        assert r.score == total
    assert found(hnsw.nearest(spark.createDataFrame(rows, VEC), shard_rows=200)) == brute([(i, [float(np.float32(c)) for c in v]) for i, v in rows])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)]
    rows += [(100 + i, [1.0, 1.0]) for i in range(50)]  # more copies than a result shows
    rows += [(20, [0.0, 0.0]), (40, None), (140, []), (160, [nan, 1.0]), (180, [inf, 1.0]), (200, [None, 1.0]), (220, [0.0, 0.0]), (None, [9.0, 9.0])]
    rows += [(240, [1.0, 2.0, 3.0]), (241, [3.0, 2.0, 1.0]), (60, [1.0, 2.0]), (60, [1.0, 2.0]), (60, [2.0, 1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VEC + ", node long, ids string")
    assert found(hnsw.nearest(df, shard_rows=16)) == brute(rows)
    assert hnsw.nearest(df.where("vec_id = 20 and embedding[0] = 0")).collect() == []
    assert hnsw.nearest(df.limit(0)).collect() == []
    assert found(hnsw.nearest(spark.createDataFrame([(0, [1.0]), (1, [2.0])], VEC))) == [(0, 1, 1)]


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame(clustered(500), VEC)
    assert found(hnsw.nearest(df.repartition(1), shard_rows=100, ef=32)) == found(hnsw.nearest(df.repartition(13), shard_rows=100, ef=32))


def test_graph_layers_are_prefixes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    level = np.sort(rng.integers(0, 3, 900))[::-1]
    layers = hnsw.build(x, level, 8, 32)
    assert [len(l) for l in layers] == [(level >= k).sum() for k in range(3)]
    for links in layers:
        assert links.max() < len(links)
        own = np.arange(len(links))[:, None]
        assert not (links == own).any()
        for row in links:
            on = row[row >= 0]
            assert len(on) == len(set(on.tolist())) and len(on)
    # every vertex can be reached from the first
    seen, todo = {0}, [0]
    while todo:
        for j in layers[0][todo.pop()].tolist():
            if j >= 0 and j not in seen:
                seen.add(j)
                todo.append(j)
    assert len(seen) == 900
