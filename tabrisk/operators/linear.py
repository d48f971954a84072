"""Linear / ordinal-regression building blocks.

The data pass is one aggregation of weighted cross products (d x d numbers for
d features); the d x d solve happens on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import ship_package


def normal_sums(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> DataFrame:
    """Sum w, sum w x_i, sum w y, sum w y^2, sum w x_i x_j (i <= j), sum w x_i y in one pass.

    Long output (term, i, j, value); i/j = -1 stands for the constant / label."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    y = F.col(label).cast("double")
    xs = [F.col(c).cast("double") for c in features]
    terms = [("sw", -1, -1, w), ("swy", -1, -1, w * y), ("swyy", -1, -1, w * y * y)]
    for i, xi in enumerate(xs):
        terms.append(("swx", i, -1, w * xi))
        terms.append(("swxy", i, -1, w * xi * y))
        for j in range(i, len(xs)):
            terms.append(("swxx", i, j, w * xi * xs[j]))
    agg = df.agg(*[F.sum(e).alias(f"{t}:{i}:{j}") for t, i, j, e in terms])
    long = agg.unpivot([], [f"{t}:{i}:{j}" for t, i, j, _ in terms], "key", "value")
    parts = F.split("key", ":")
    return long.select(parts[0].alias("term"), parts[1].cast("int").alias("i"), parts[2].cast("int").alias("j"), "value")


def solve_ridge(sums: DataFrame, d: int, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """Weighted least squares with intercept; ``alpha`` * ||w||^2 added to the
    weighted mean squared error (intercept not penalised). Returns (b, w)."""
    rows = sums.collect()  # (d+1)(d+2)/2 + 2d + 3 numbers
    sw = swy = 0.0
    swx = np.zeros(d)
    swxy = np.zeros(d)
    swxx = np.zeros((d, d))
    for r in rows:
        t, i, j, v = r["term"], r["i"], r["j"], r["value"] or 0.0
        if t == "sw":
            sw = v
        elif t == "swy":
            swy = v
        elif t == "swx":
            swx[i] = v
        elif t == "swxy":
            swxy[i] = v
        elif t == "swxx":
            swxx[i, j] = swxx[j, i] = v
    mx, my = swx / sw, swy / sw
    cov = swxx / sw - np.outer(mx, mx)
    cxy = swxy / sw - mx * my
    # least squares: collinear features (e.g. duplicated one-hot blocks) get the minimum-norm solution
    w = np.linalg.lstsq(cov + alpha * np.eye(d), cxy, rcond=None)[0] if d else np.zeros(0)
    b = my - float(mx @ w)
    return float(b), w


def _numbers(b: pa.RecordBatch) -> np.ndarray:
    """The columns of a batch as the columns of a matrix; a missing value is NaN."""
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])


def _cross_adder(models: list[tuple[float, np.ndarray, float | None]]):
    """Rows (features, label, weight) to (model, cell, value): the task's weighted cross products of 1, features and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            m = _numbers(b)
            x, y, w = m[:, :-2], m[:, -2], m[:, -1]
            z = np.column_stack([np.ones(len(m)), m[:, :-1]])
            total = np.zeros((len(models), z.shape[1] ** 2)) if total is None else total
            for i, (at, coef, delta) in enumerate(models):
                wi = w
                if delta is not None:
                    r = np.abs(y - (at + x @ coef))
                    wi = w * np.where(r <= delta, 1.0, delta / np.maximum(r, delta))
                total[i] += ((z * wi[:, None]).T @ z).ravel()
        if total is not None:
            cells = np.tile(np.arange(total.shape[1]), len(models))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(models)), total.shape[1])), pa.array(cells), pa.array(total.ravel())], ["model", "cell", "value"])

    return run


def cross_products(rows: DataFrame, models: Sequence[tuple[float, np.ndarray, float | None]]) -> np.ndarray:
    """A31 for several weightings in one pass over ``rows`` (features, label, weight): a (d + 2) x (d + 2) matrix each.

    A model (b, w, delta) multiplies a row's weight by its Huber weight at that
    score; without ``delta`` the weight stays as it is. Missing or infinite values are refused."""
    ship_package(rows.sparkSession)
    d = len(rows.columns)
    sums = rows.mapInArrow(_cross_adder(list(models)), "model bigint, cell bigint, value double")
    got = sums.groupBy("model", "cell").agg(F.sum("value").alias("value")).toArrow()  # (d + 2)^2 numbers a model
    out = np.zeros((len(models), d * d))
    out[got["model"].to_numpy(), got["cell"].to_numpy()] = got["value"].to_numpy()
    if not np.isfinite(out).all() or not out[:, 0].all():
        raise ValueError("no rows, or a missing or infinite feature, label or weight")
    return out.reshape(len(models), d, d)


def solve_cross(s: np.ndarray, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """:func:`solve_ridge` from a matrix of :func:`cross_products`."""
    sw, mean = s[0, 0], s[0, 1:-1] / s[0, 0]
    my = s[0, -1] / sw
    cov, cxy = s[1:-1, 1:-1] / sw - np.outer(mean, mean), s[1:-1, -1] / sw - mean * my
    w = np.linalg.lstsq(cov + alpha * np.eye(len(mean)), cxy, rcond=None)[0] if len(mean) else np.zeros(0)
    return float(my - mean @ w), w


def linspace_candidates(lo: float, hi: float, num: int = 50) -> list[float]:
    """numpy.linspace(lo, hi, num): lo + i * step, last value exactly hi."""
    if num == 1:
        return [lo]
    step = (hi - lo) / (num - 1)
    out = [lo + i * step for i in range(num)]
    out[-1] = hi
    return out


def candidates_below(df: DataFrame, score: str, cands: Sequence[float], out: str) -> DataFrame:
    """``df`` with the number of candidates <= score (0 for a missing score): one binary search a row."""
    edges = sorted({c + 0.0 for c in cands})  # + 0.0: no negative zeros, which a search tells from zero
    if not np.isfinite(edges).all():
        return df.withColumn(out, F.size(F.filter(F.array(*[F.lit(c) for c in cands]), lambda c: c <= F.col(score))))
    search = Bucketizer(splits=[-np.inf, *edges, np.inf], inputCol="_at", outputCol="_edges", handleInvalid="keep")
    found = search.transform(df.withColumn("_at", F.col(score).cast("double") + F.lit(0.0)))
    # distinct edges at or below -> candidates at or below; the last place is NaN's, above all
    below = [sum(c <= e for c in cands) for e in edges]
    counts = F.array(*[F.lit(n) for n in (0, *below, len(cands))])
    return found.withColumn(out, F.coalesce(F.get(counts, F.col("_edges").cast("int")), F.lit(0))).drop("_at", "_edges")


def threshold_search(df: DataFrame, score: str, label: str, weight: str | None = None, num: int = 50,
                     beta: float = 2.0) -> DataFrame:
    """Best (t1 < t2) among ``num`` linspace candidates between min and max
    score by weighted macro F-beta; first best in (t1, t2) order wins.

    Rows are reduced to (label, bucket) weight sums, bucket = number of
    candidates <= score; every candidate pair is then scored on that small
    (3 x (num+1)) table, so the pair grid never touches the rows."""
    mm = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).collect()[0]
    cands = linspace_candidates(float(mm["lo"]), float(mm["hi"]), num)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    buckets = candidates_below(df.select(F.col(label).cast("int").alias("y"), w.alias("w"), F.col(score).alias("_s")), "_s", cands, "bucket")
    hist = buckets.groupBy("y", "bucket").agg(F.sum("w").alias("w"))
    # every (t1 < t2) candidate pair for each of the <= 3 x (num + 1) histogram rows
    scored = hist.select("y", "bucket", "w", F.explode(F.sequence(F.lit(0), F.lit(num - 2))).alias("i")).select(
        "y", "bucket", "w", "i", F.explode(F.sequence(F.col("i") + 1, F.lit(num - 1))).alias("j")
    )
    pred = F.when(F.col("bucket") >= F.col("j") + 1, 2).when(F.col("bucket") >= F.col("i") + 1, 1).otherwise(0)
    cm = scored.groupBy("i", "j", "y", pred.alias("p")).agg(F.sum("w").alias("n"))
    tp = cm.groupBy("i", "j").agg(*[
        F.sum(F.when((F.col("y") == k) & (F.col("p") == k), F.col("n")).otherwise(0.0)).alias(f"tp{k}") for k in range(3)
    ], *[F.sum(F.when(F.col("y") == k, F.col("n")).otherwise(0.0)).alias(f"s{k}") for k in range(3)],
        *[F.sum(F.when(F.col("p") == k, F.col("n")).otherwise(0.0)).alias(f"q{k}") for k in range(3)])
    b2 = beta * beta
    fs = []
    for k in range(3):
        p = F.when(F.col(f"q{k}") > 0, F.col(f"tp{k}") / F.col(f"q{k}")).otherwise(0.0)
        r = F.when(F.col(f"s{k}") > 0, F.col(f"tp{k}") / F.col(f"s{k}")).otherwise(0.0)
        fs.append(F.when((p + r) > 0, (1 + b2) * p * r / (b2 * p + r)).otherwise(0.0))
    res = tp.select("i", "j", ((fs[0] + fs[1] + fs[2]) / 3.0).alias("score"))
    best = res.orderBy(F.desc("score"), "i", "j").limit(1)
    c_arr = F.array(*[F.lit(c) for c in cands])
    return best.select(
        F.element_at(c_arr, F.col("i") + 1).alias("t1"), F.element_at(c_arr, F.col("j") + 1).alias("t2"),
        F.col("score").alias("f2_macro"),
    )


def _bucket_adder(cands: list[list[float]]):
    """Rows (label, weight, scores) to (model, y, bucket, w) sums of the task; a label that is no class counts as y = 3."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(cands[0]) + 1
        total, on = np.zeros((len(cands), 4 * size)), False
        for b in batches:
            if not b.num_rows:
                continue
            m, on = _numbers(b), True
            y = np.where((m[:, 0] >= 0) & (m[:, 0] <= 2), m[:, 0], 3).astype(np.int64)
            for i, c in enumerate(cands):
                total[i] += np.bincount(y * size + np.searchsorted(c, m[:, 2 + i], "right"), weights=m[:, 1], minlength=4 * size)
        if on:
            cells = np.tile(np.arange(4 * size), len(cands))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(cands)), 4 * size)), pa.array(cells), pa.array(total.ravel())], ["model", "cell", "w"])

    return run


def best_thresholds(hist: np.ndarray, beta: float = 2.0) -> tuple[int, int]:
    """W16 on a (label, bucket) table of weight sums: the first best candidate numbers i < j by macro F-beta over classes 0-2."""
    num = hist.shape[1] - 1
    i, j = np.triu_indices(num, 1)
    below = np.cumsum(hist, axis=1)  # weight of buckets 0..b
    parts = [below[:, i], below[:, j] - below[:, i], below[:, -1:] - below[:, j]]  # predicted 0, 1, 2
    b2, total = beta * beta, 0.0
    for k in range(3):
        tp, q, s = parts[k][k], parts[k].sum(0), below[k, -1]
        p = np.divide(tp, q, out=np.zeros(len(i)), where=q > 0)
        r = tp / s if s > 0 else np.zeros(len(i))
        total = total + np.divide((1 + b2) * p * r, b2 * p + r, out=np.zeros(len(i)), where=(p + r) > 0)
    best = int(np.argmax(total / 3.0))
    return int(i[best]), int(j[best])


def threshold_searches(df: DataFrame, scores: Sequence[Column], label: str, weight: str | None = None, num: int = 50) -> list[tuple[float, float]]:
    """:func:`threshold_search` for several scores of the same rows in two passes, one for their ranges and one for their buckets."""
    ship_package(df.sparkSession)
    names = [f"_s{i}" for i in range(len(scores))]
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    d = df.select(F.col(label).cast("int").cast("double").alias("_y"), F.coalesce(w, F.lit(0.0)).alias("_w"), *[s.cast("double").alias(n) for s, n in zip(scores, names)])
    mm = d.agg(*[f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max)]).first()
    cands = [linspace_candidates(float(mm[f"min{n}"]), float(mm[f"max{n}"]), num) for n in names]
    if not np.isfinite(cands).all():
        each = [threshold_search(d, n, "_y", "_w", num).first() for n in names]
        return [(float(t["t1"]), float(t["t2"])) for t in each]
    known = [F.coalesce(F.col(n), F.lit(float("-inf"))).alias(n) for n in names]  # a missing score is below all candidates
    sums = d.select("_y", "_w", *known).mapInArrow(_bucket_adder(cands), "model bigint, cell bigint, w double")
    got = sums.groupBy("model", "cell").agg(F.sum("w").alias("w")).toArrow()
    hist = np.zeros((len(scores), 4 * (num + 1)))
    hist[got["model"].to_numpy(), got["cell"].to_numpy()] = got["w"].to_numpy()
    at = [best_thresholds(h.reshape(4, num + 1)) for h in hist]
    return [(c[i], c[j]) for c, (i, j) in zip(cands, at)]


def apply_thresholds(df: DataFrame, score: str, t1: float, t2: float, out_col: str = "prediction") -> DataFrame:
    """P25."""
    return df.withColumn(out_col, X.threshold_classes(score, t1, t2))
