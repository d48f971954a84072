import numpy as np
from llm_brute import closure

from tabrisk.llm import itq
from tabrisk.llm.queries import QUERIES

VEC = "vec_id long, embedding array<float>"


def brute(rows, threshold=0.95):
    """{id: (n_links, component, kept)} with every pair compared."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links, n = [], dict.fromkeys([i for i, _ in rows if i is not None], 0)
    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    top = closure(list(n), links)
    return {i: (n[i], top[i], top[i] == i) for i in n}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def planted(seed=2, groups=(300, 40, 5, 2), dims=64, singles=800):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dims) for _ in range(singles)]
    for size in groups:
        c = rng.normal(size=dims)
        out += [c + rng.normal(size=dims) * 0.16 for _ in range(size)]  # cosines spread around the threshold
    order = rng.permutation(len(out))
    return [(int(i), [float(x) for x in np.float32(out[k])]) for i, k in enumerate(order)]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert result(QUERIES["op3_itq_embeddings"](spark, sf)) == brute(rows)


def test_recall_and_precision_at_the_threshold(spark):
    rows = planted()
    df = spark.createDataFrame(rows, VEC)
    want = brute(rows)
    for tile in (1024, 64):
        got = result(itq.near_duplicates(df, tile=tile))
        links = sum(n for n, _, _ in want.values())
        assert links > 1000
        assert all(got[i][0] <= want[i][0] for i in want)
        assert sum(n for n, _, _ in got.values()) / links >= 0.99  # measured: all of them


def test_edge_rows(spark):
    a, b = [1.0, 0.0, 0.5, 0.2], [1.0, 0.01, 0.5, 0.2]
    rows = [(5, a), (3, b), (9, None), (8, []), (7, [0.0] * 4), (6, [1.0, None, 0.0, 0.0]), (4, [float("nan")] * 4), (2, [float("inf"), 1.0, 0.0, 0.0]), (12, a), (12, a), (None, a), (20, [1e-30, 0.0, 5e-31, 2e-31]), (21, [-x for x in a]), (22, a[:3]), (23, [1e30, 0.0, 5e29, 2e29])]
    df = spark.createDataFrame(rows, VEC).selectExpr("*", "1 as node", "2 as n", "'x' as e", "3 as cell")
    got = itq.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute([r for i, r in enumerate(rows) if i != 9])
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want | {None: (0, None, False)}
    assert itq.near_duplicates(spark.createDataFrame([], VEC)).count() == 0
    assert result(itq.near_duplicates(spark.createDataFrame([(1, None)], VEC))) == {1: (0, 1, True)}


def test_copies_are_counted_without_pairs(spark):
    rng = np.random.default_rng(4)
    v = [[float(x) for x in np.float32(rng.normal(size=16))] for _ in range(3)]
    rows = [(i, v[i % 3]) for i in range(3000)]
    got = result(itq.near_duplicates(spark.createDataFrame(rows, VEC)))
    assert got == {i: (999, i % 3, i < 3) for i in range(3000)}


def common_part(dims, common=0.8, pairs=300, singles=1500, seed=9):
    """Unit vectors whose mean cosine is ``common``; isolated pairs of cosine 0.95 to 0.97."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    z = unit(rng.normal(size=(singles + pairs, dims)))
    near = 1 - (1 - rng.uniform(0.952, 0.97, size=(pairs, 1))) / (1 - common)
    w = rng.normal(size=(pairs, dims))
    w = unit(w - (w * z[:pairs]).sum(1, keepdims=True) * z[:pairs])
    z = np.concatenate([z, near * z[:pairs] + np.sqrt(1 - near**2) * w])
    top = unit(rng.normal(size=(1, dims)))
    return np.float32(unit(np.sqrt(common) * top + np.sqrt(1 - common) * z))


def test_recall_with_a_large_common_part(spark):
    for dims in (64, 256):
        x = common_part(dims)
        cos = np.float64(x) @ np.float64(x).T
        assert 0.78 < cos.mean() < 0.82
        df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], VEC)
        got = result(itq.near_duplicates(df))
        want = (cos >= 0.95).sum(1) - 1
        assert want.sum() >= 500
        assert all(got[i][0] <= n for i, n in enumerate(want))
        assert sum(n for n, _, _ in got.values()) / want.sum() >= 0.98
