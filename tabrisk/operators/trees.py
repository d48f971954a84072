"""Tree building blocks as aggregations (W11-W14, A27, A28, T13) and MLlib tree models (M2-M5).

Split finding never sorts rows: rows are reduced to histograms
``groupBy(node, class, feature, bin)`` with map-side partial sums, and the
small histogram table is scanned with running-sum windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import exact_quantiles, to_long


def quantile_bin_edges(df: DataFrame, cols: Sequence[str], max_bin: int = 32) -> dict[str, list[float]]:
    """Unique exact percentiles at linspace(0, 100, max_bin + 1) per feature.

    Output is features x (max_bin + 1) numbers, held by the driver to build the
    bucketizer."""
    probs = [i / max_bin for i in range(max_bin + 1)]
    q = exact_quantiles(df, cols, probs, long_form=True)
    edges: dict[str, list[float]] = {c: [] for c in cols}
    for r in q.collect():
        edges[r["feature"]].append(r["q"])
    return {c: sorted(set(v)) for c, v in edges.items()}


def bin_features(df: DataFrame, edges: dict[str, list[float]], suffix: str = "_bin") -> DataFrame:
    """Bin index = number of inner edges <= x (``searchsorted(edges[1:-1], x, 'right')``).

    Bucketizer (JVM, binary search) with splits -inf, inner edges, +inf is
    left-closed, which is exactly that count."""
    cols = list(edges)
    # a feature with no inner edge keeps every value in bin 0 (Bucketizer needs three splits)
    splits = [[float("-inf"), *(e[1:-1] or [1.7976931348623157e308]), float("inf")] for e in (edges[c] for c in cols)]
    b = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[c + suffix for c in cols], handleInvalid="keep")
    out = b.transform(df)
    return out.select(*[F.col(c) for c in df.columns], *[F.col(c + suffix).cast("int").alias(c + suffix) for c in cols])


def _score(G, H, reg_lambda: float, reg_alpha: float):
    if reg_alpha > 0:
        g = F.when(G == 0, F.lit(0.0)).otherwise(F.greatest(F.abs(G) - reg_alpha, F.lit(0.0)) * F.signum(G))
    else:
        g = G
    return g * g / (H + F.lit(reg_lambda))


def histogram_best_split(
    binned: DataFrame,
    feature_bins: Sequence[str],
    grad: str = "g",
    hess: str = "h",
    group_cols: Sequence[str] = ("cls",),
    reg_lambda: float = 1.0,
    reg_alpha: float = 0.0,
    min_child_samples: int = 20,
    min_split_gain: float = 0.0,
) -> DataFrame:
    """Best split per group (node / class) from gradient histograms.

    gain = 0.5 (S(G_L, H_L) + S(G_R, H_R) - S(G, H)), S = soft-threshold(G)^2 / (H + lambda);
    both children need ``min_child_samples`` rows and gain > ``min_split_gain``;
    ties go to the first feature, then the lowest bin. Left = bin <= split bin.
    """
    group_cols = list(group_cols)
    long = binned.select(*group_cols, grad, hess, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("bin"), F.lit(i).alias("fidx")) for i, c in enumerate(feature_bins)
    ])).alias("s")).select(*group_cols, grad, hess, "s.*")
    hist = long.groupBy(*group_cols, "fidx", "feature", "bin").agg(
        F.sum(grad).alias("G_b"), F.sum(hess).alias("H_b"), F.count(F.lit(1)).alias("n_b")
    )
    wcum = Window.partitionBy(*group_cols, "fidx").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    wall = Window.partitionBy(*group_cols, "fidx")
    h = hist.select(
        *group_cols, "fidx", "feature", "bin",
        F.sum("G_b").over(wcum).alias("G_L"), F.sum("H_b").over(wcum).alias("H_L"), F.sum("n_b").over(wcum).alias("n_L"),
        F.sum("G_b").over(wall).alias("G"), F.sum("H_b").over(wall).alias("H"), F.sum("n_b").over(wall).alias("n"),
    )
    h = h.withColumn("G_R", F.col("G") - F.col("G_L")).withColumn("H_R", F.col("H") - F.col("H_L")).withColumn(
        "n_R", F.col("n") - F.col("n_L")
    )
    gain = 0.5 * (
        _score(F.col("G_L"), F.col("H_L"), reg_lambda, reg_alpha)
        + _score(F.col("G_R"), F.col("H_R"), reg_lambda, reg_alpha)
        - _score(F.col("G_L") + F.col("G_R"), F.col("H_L") + F.col("H_R"), reg_lambda, reg_alpha)
    )
    cand = h.withColumn("gain", gain).where(
        (F.col("n_L") >= min_child_samples) & (F.col("n_R") >= min_child_samples) & (F.col("gain") > min_split_gain)
    )
    w = Window.partitionBy(*group_cols).orderBy(F.desc("gain"), "fidx", "bin")
    return cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(
        *group_cols, "feature", "bin", "gain", "n_L", "n_R"
    )


def exhaustive_best_split(df: DataFrame, features: Sequence[str], label: str, group_cols: Sequence[str] = (),
                          criterion: str = "gini", min_samples_leaf: int = 1) -> DataFrame:
    """Best threshold over all distinct values (left = x <= t) by weighted Gini / entropy.

    Counts per (feature, value, class) -> running class counts per feature ->
    weighted child impurity; the lowest wins, ties -> first feature, lowest t.
    """
    group_cols = list(group_cols)
    long = to_long(df.select(*group_cols, *features, F.col(label).alias("_y")), features, [*group_cols, "_y"])
    long = long.withColumn("fidx", F.array_position(F.array(*[F.lit(c) for c in features]), F.col("feature")))
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]  # class labels: small
    cnt = long.groupBy(*group_cols, "fidx", "feature", "value").agg(
        *[F.count_if(F.col("_y") == c).alias(f"c{i}") for i, c in enumerate(classes)]
    )
    k = len(classes)
    # running class counts over the distinct values of each feature: exact prefix
    # sums over ranges, so one feature's values are never ordered in a single task
    from .order import prefix_sums_multi

    run = prefix_sums_multi(cnt, ["value"], [*group_cols, "fidx"], {f"b{i}": f"c{i}" for i in range(k)}, totals={f"t{i}": f"b{i}" for i in range(k)})
    cum = run.select(
        *group_cols, "fidx", "feature", F.col("value").alias("threshold"),
        *[(F.col(f"b{i}") + F.col(f"c{i}")).alias(f"l{i}") for i in range(k)],
        *[F.col(f"t{i}") for i in range(k)],
    )
    nl = sum((F.col(f"l{i}") for i in range(k)), F.lit(0))
    nt = sum((F.col(f"t{i}") for i in range(k)), F.lit(0))
    cum = cum.withColumn("n_L", nl).withColumn("n", nt).withColumn("n_R", F.col("n") - F.col("n_L"))

    def imp(prefix_counts, size):
        if criterion == "gini":
            s = F.lit(0.0)
            for c in prefix_counts:
                s = s + (c / size) * (c / size)
            return F.lit(1.0) - s
        e = F.lit(0.0)
        for c in prefix_counts:
            p = c / size
            e = e - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))
        return e

    left = [F.col(f"l{i}") for i in range(k)]
    right = [F.col(f"t{i}") - F.col(f"l{i}") for i in range(k)]
    weighted = (F.col("n_L") / F.col("n")) * imp(left, F.col("n_L")) + (F.col("n_R") / F.col("n")) * imp(right, F.col("n_R"))
    cand = cum.where((F.col("n_L") >= min_samples_leaf) & (F.col("n_R") >= min_samples_leaf)).withColumn("impurity", weighted)
    w = Window.partitionBy(*group_cols).orderBy("impurity", "fidx", "threshold")
    return cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(
        *group_cols, "feature", "threshold", "impurity", "n_L", "n_R"
    )


def conflict_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of rows where both features are non-zero, for every pair (one aggregation)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if((F.col(a) != 0) & (F.col(b) != 0)).alias(f"{a}||{b}") for a, b in pairs
    ])
    long = agg.unpivot(["_n"], [f"{a}||{b}" for a, b in pairs], "pair", "n_both")
    parts = F.split("pair", r"\|\|")
    return long.select(parts[0].alias("col_a"), parts[1].alias("col_b"), (F.col("n_both") / F.col("_n")).alias("conflict_rate"))


def bundle_features(conflicts: list[tuple[str, str, float]], cols: Sequence[str], max_conflict: float = 0.0) -> list[list[str]]:
    """T13 greedy step on the small d x d conflict table: features in the order of
    how many others they conflict with (rate above ``max_conflict``), each put into
    the first bundle none of whose members it conflicts with."""
    clash = {frozenset((a, b)) for a, b, r in conflicts if r > max_conflict}
    degree = {c: sum(frozenset((c, o)) in clash for o in cols if o != c) for c in cols}
    bundles: list[list[str]] = []
    for c in sorted(cols, key=lambda x: (-degree[x], list(cols).index(x))):
        for bnd in bundles:
            if not any(frozenset((c, o)) in clash for o in bnd):
                bnd.append(c)
                break
        else:
            bundles.append([c])
    return bundles


def merge_bundle(df: DataFrame, bundle: Sequence[str], bins: dict[str, int], out_col: str) -> DataFrame:
    """T13 merge: first non-zero bin of the bundle, offset by the bin counts of the
    features before it (offsets on bin indices, so ranges never overlap)."""
    expr = F.lit(0)
    offset = 0
    parts = []
    for c in bundle:
        parts.append(F.when(F.col(c) != 0, F.col(c) + F.lit(offset)))
        offset += bins[c]
    expr = F.coalesce(*parts, F.lit(0)) if parts else expr
    return df.withColumn(out_col, expr)


def goss_sample(df: DataFrame, grad_abs: str, key_cols: Sequence[str], top_rate: float, other_rate: float, seed: int,
                hash_fn) -> DataFrame:
    """Keep the top ``top_rate`` share of rows by |gradient| (exact count,
    ties broken by a seeded hash), draw exactly ``other_rate`` of all rows from
    the rest in seeded-hash order, and weight the drawn ones by rest / drawn."""
    from .order import positions

    n = df.count()
    n_top, n_other = int(top_rate * n), int(other_rate * n)
    ranked = positions(df.withColumn("_h", hash_fn(list(key_cols), seed)), [F.desc(grad_abs), "_h", *key_cols], [], "_pos")
    big = F.col("_pos") < F.lit(n_top)
    # the rest in another hash order: its first n_other rows, exactly
    drawn = positions(ranked.where(~big).withColumn("_u", hash_fn(list(key_cols), seed + 1)), ["_u", *key_cols], [], "_draw")
    w = (n - n_top) / n_other if n_other else 1.0
    picked = ranked.where(big).withColumn("goss_weight", F.lit(1.0))
    sampled = drawn.where(F.col("_draw") < F.lit(n_other)).drop("_u", "_draw").withColumn("goss_weight", F.lit(float(w)))
    return picked.unionByName(sampled).drop("_h", "_pos")


def _node_expr(splits: dict, node: int = 0):
    """Node id reached by a row: nested CASE over the chosen (node -> feature, bin) splits."""
    if node not in splits:
        return F.lit(node)
    f, b = splits[node]
    return F.when(F.col(f) <= b, _node_expr(splits, 2 * node + 1)).otherwise(_node_expr(splits, 2 * node + 2))


def _value_expr(splits: dict, leaves: dict, node: int = 0):
    """Leaf value of a row: the same nested CASE ending in the fitted leaf weights."""
    if node not in splits:
        return F.lit(float(leaves.get(node, 0.0)))
    f, b = splits[node]
    return F.when(F.col(f) <= b, _value_expr(splits, leaves, 2 * node + 1)).otherwise(_value_expr(splits, leaves, 2 * node + 2))


def _go_left(x: np.ndarray, cut: int | None) -> np.ndarray:
    """Rows (places in the bins, 0 for NULL) that a split sends left, as :func:`_node_expr` does: those with a bin up to the cut."""
    return np.zeros(len(x), bool) if cut is None else (x > 0) & (x <= cut)


def _bin_sums(names: Sequence[str], label: str, n_classes: int, low: int, width: int, splits: dict, wanted: dict):
    """Rows (bins, label, scores) to the task's sums of gradient, Hessian and rows by ((class, node), feature, bin); the last cell has the loss.

    ``splits`` has for each class {node: (feature number, cut)}, ``wanted`` the number of each (class, node) to be summed up.
    """
    n_cells = len(wanted) * len(names) * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, n_cells + 1))
        for b in batches:
            if not b.num_rows:
                continue
            x = [(b.column(c).cast(pa.int64()).fill_null(low - 1).to_numpy(zero_copy_only=False) - (low - 1)) for c in names]
            y = b.column(label).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            f = np.stack([b.column(f"_f{c}").to_numpy(zero_copy_only=False) for c in range(n_classes)], 1)
            e = np.exp(f - f.max(1, keepdims=True))
            prob = e / e.sum(1, keepdims=True)
            known = np.flatnonzero(y >= 0)
            total[0, -1] += -np.log(np.maximum(prob[known, y[known]], 1e-15)).sum()
            total[2, -1] += len(known)
            for c in range(n_classes):
                node = np.zeros(b.num_rows, np.int64)
                for i, (feature, cut) in sorted(splits[c].items()):
                    on = np.flatnonzero(node == i)
                    node[on] = np.where(_go_left(x[feature][on], cut), 2 * i + 1, 2 * i + 2)
                slot = np.full(2 * max([0, *splits[c]]) + 3, -1)
                for (k, i), at in wanted.items():
                    if k == c:
                        slot[i] = at
                at = slot[node]
                on = np.flatnonzero(at >= 0)
                if not len(on):
                    continue
                g = np.where(y >= 0, prob[:, c] - (y == c), 0.0)[on]
                h = (prob[:, c] * (1.0 - prob[:, c]))[on]
                for i in range(len(names)):
                    cell = (at[on] * len(names) + i) * width + x[i][on]
                    for t, v in enumerate((g, h, None)):
                        total[t, :-1] += np.bincount(cell, weights=v, minlength=n_cells)
        on = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(on), *(pa.array(t[on]) for t in total)], ["cell", "g", "h", "n"])

    return run


def _best_of_bins(h: np.ndarray, reg_lambda: float, reg_alpha: float, min_child_samples: int, min_split_gain: float) -> tuple[int, int] | None:
    """W12 on a (feature, bin, 3) histogram: (feature number, place of the bin), ties to the first feature, then the lowest bin."""
    left = np.cumsum(h, axis=1)
    total = left[:, -1:]
    right = total - left

    def score(s):
        g = np.sign(s[..., 0]) * np.maximum(np.abs(s[..., 0]) - reg_alpha, 0.0) if reg_alpha > 0 else s[..., 0]
        return g * g / (s[..., 1] + reg_lambda)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (score(left) + score(right) - score(total))
        unit = 10.0 ** (9 - np.floor(np.log10(np.abs(gain))))  # ten digits: sums added up in another order compare alike
        gain = np.where(np.isfinite(unit) & (gain != 0), np.round(gain * unit) / unit, gain)
    ok = (h[..., 2] > 0) & (left[..., 2] >= min_child_samples) & (right[..., 2] >= min_child_samples) & (gain > min_split_gain)
    if not ok.any():
        return None
    f, b = np.unravel_index(np.argmax(np.where(ok, gain, -np.inf)), gain.shape)
    return int(f), int(b)


def boost_trees(binned: DataFrame, feature_bins: Sequence[str], label: str, n_classes: int, rounds: int = 10,
                learning_rate: float = 0.3, max_depth: int = 2, reg_lambda: float = 1.0, reg_alpha: float = 0.0,
                min_child_samples: int = 20, min_split_gain: float = 0.0, checkpoint_every: int = 3):
    """M4: softmax gradient boosting, one tree per class per round, grown level by level.

    Every level of all classes' trees is ONE pass over the rows: each task adds up its
    histograms by (class, node, feature, bin) and only these are shuffled. The first
    level's pass also gives the round's loss, the leaves' sums are those of the last histograms. The
    chosen splits are a small table on the driver and become nested CASE
    expressions for scoring (no join back). Scores are
    written out every ``checkpoint_every`` rounds to cut lineage, in place of those before.
    Returns (trees, per-round training log loss, scored rows, initial scores);
    a tree is (round, class, splits {node: (feature, bin)}, leaves {node: value})."""
    from ..session import drop_rows, keep_rows, ship_package

    ship_package(binned.sparkSession)
    names, width_of = list(feature_bins), F.array(*[F.col(c).cast("long") for c in feature_bins])
    sizes = binned.groupBy(label).agg(F.count(F.lit(1)).alias("count"), F.min(F.array_min(width_of)).alias("lo"), F.max(F.array_max(width_of)).alias("hi")).collect()  # one row per class
    counts = {r[label]: r["count"] for r in sizes}
    low = min([r["lo"] for r in sizes if r["lo"] is not None], default=0)
    width = max([r["hi"] for r in sizes if r["hi"] is not None], default=0) - low + 2  # place 0 is that of NULL
    n = sum(counts.values())
    init = [float(np.log(counts.get(c, 0) / n)) if counts.get(c, 0) else -30.0 for c in range(n_classes)]
    d = binned.select(*names, label, *[F.lit(init[c]).alias(f"_f{c}") for c in range(n_classes)])
    trees_out, losses, kept = [], [], None

    def leaf_w(G, H):
        Ge = max(0.0, abs(G) - reg_alpha) * np.sign(G) if reg_alpha > 0 else G
        return float(-Ge / (H + reg_lambda))

    def sums(splits, nodes):
        """(class, node) -> its (feature, bin, 3) histogram, and the loss."""
        wanted = {x: i for i, x in enumerate(nodes)}
        run = _bin_sums(names, label, n_classes, low, width, splits, wanted)
        part = d.select(*names, label, *[f"_f{c}" for c in range(n_classes)]).mapInArrow(run, "cell bigint, g double, h double, n double")
        got = part.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
        h = np.zeros((len(nodes) * len(names) * width + 1, 3))
        for i, c in enumerate("ghn"):
            h[got["cell"].to_numpy(), i] = got[c].to_numpy()
        loss = h[-1, 0] / h[-1, 2] if h[-1, 2] else None
        return dict(zip(nodes, h[:-1].reshape(len(nodes), len(names), width, 3))), loss

    for r in range(rounds):
        cuts: list[dict] = [{} for _ in range(n_classes)]
        hist, nodes = {}, [(c, 0) for c in range(n_classes)]
        for level in range(max(1, max_depth)):
            got, loss = sums(cuts, nodes)
            hist |= got
            if not level:
                losses.append(loss)
            best = {x: _best_of_bins(hist[x], reg_lambda, reg_alpha, min_child_samples, min_split_gain) for x in nodes} if max_depth else {}
            new = [x for x in nodes if best.get(x)]
            for c, i in new:
                f, b = best[c, i]
                cuts[c][i] = (f, b or None)
            nodes = [(c, child) for c, i in new for child in (2 * i + 1, 2 * i + 2)]
            if not nodes:
                break
        leaves: list[dict] = [{} for _ in range(n_classes)]
        for (c, i), h in hist.items():
            if i not in cuts[c]:
                if h[0, :, 2].sum():
                    leaves[c][i] = leaf_w(*h[0].sum(0)[:2])
                continue
            f, cut = cuts[c][i]
            to_left = _go_left(np.arange(width), cut)
            for child, on in ((2 * i + 1, to_left), (2 * i + 2, ~to_left)):
                if (c, child) not in hist and h[f, on, 2].sum():
                    leaves[c][child] = leaf_w(*h[f, on].sum(0)[:2])
        splits = [{i: (names[f], None if cut is None else cut + low - 1) for i, (f, cut) in cuts[c].items()} for c in range(n_classes)]
        for c in range(n_classes):
            trees_out.append((r, c, splits[c], leaves[c]))
        d = d.select(*names, label, *[(F.col(f"_f{c}") + F.lit(learning_rate) * _value_expr(splits[c], leaves[c])).alias(f"_f{c}")
                                      for c in range(n_classes)])
        if (r + 1) % checkpoint_every == 0:
            d = keep_rows(d)
            drop_rows(kept)
            kept = d
    return trees_out, losses, d, init


def predict_trees(df: DataFrame, trees_list, n_classes: int, init: list[float], learning_rate: float) -> DataFrame:
    """Class scores as nested CASE expressions of the fitted trees; argmax class (ties -> lowest)."""
    scores = [F.lit(init[c]) for c in range(n_classes)]
    for (_, c, splits, leaves) in trees_list:
        scores[c] = scores[c] + F.lit(learning_rate) * _value_expr(splits, leaves)
    arr = F.array(*scores)
    return df.withColumn("prediction", (F.array_position(arr, F.array_max(arr)) - 1).cast("int"))
