"""M2 and M3 grown in Spark: exact decision trees and forests of them.

All open nodes of all trees at one depth are split by one job: rows, weighted by
their bootstrap multiplicities (W15) and restricted to each tree's feature
subset, are counted by (tree and node, feature, value, class); prefix sums over
the values give both sides of every threshold (W13), and the smallest weighted
impurity wins: ties go to the first feature, then the lowest threshold. A root
that holds all rows is spread over tasks like any other group.

Thresholds are all distinct values; with ``max_bins`` values are first raised to
the next of that many quantiles, which bounds the counts on large tables.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_rows, keep_rows, ship_package
from . import sampling, treetable
from .order import prefix_sums_multi
from .treetable import Node, Tree
from .trees import quantile_bin_edges


@dataclass(frozen=True)
class Params:
    n_estimators: int = 1
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    criterion: str = "gini"
    max_features: str | float | int | None = None
    bootstrap: bool = False
    max_bins: int | None = None
    seed: int = 42


def features_per_tree(n: int, wish: str | float | int | None) -> int:
    """How many of ``n`` features a tree sees: all, their square root, binary logarithm, a share or a number."""
    if wish in (None, "all") or (isinstance(wish, float) and wish == 1.0):
        return n
    if wish == "sqrt":
        return max(1, int(np.sqrt(n)))
    if wish == "log2":
        return max(1, int(np.log2(n)))
    if isinstance(wish, str):
        raise ValueError(f"unknown number of features: {wish}")
    return max(1, min(n, int(wish * n) if isinstance(wish, float) else int(wish)))


def impurity(counts: list[Column], size: Column, criterion: str) -> Column:
    """A27 of one side from its class counts."""
    p = [c / size for c in counts]
    if criterion == "gini":
        return F.lit(1.0) - sum((x * x for x in p), F.lit(0.0))
    if criterion != "entropy":
        raise ValueError(f"unknown criterion: {criterion}")
    return sum((F.when(x > 0, -x * F.log2(x)).otherwise(0.0) for x in p), F.lit(0.0))


def _best_splits(counts: DataFrame, classes: int, p: Params) -> dict[int, dict]:
    """The best split of each slot from counts (slot, fidx, value, c0..): one row a slot comes back."""
    run = prefix_sums_multi(counts, ["value"], ["slot", "fidx"], {f"b{k}": f"c{k}" for k in range(classes)}, totals={f"t{k}": f"b{k}" for k in range(classes)})
    left = [(F.col(f"b{k}") + F.col(f"c{k}")).cast("double") for k in range(classes)]
    cum = run.select("slot", "fidx", F.col("value").alias("threshold"), *[x.alias(f"l{k}") for k, x in enumerate(left)], *[(F.col(f"t{k}") - x).alias(f"r{k}") for k, x in enumerate(left)])
    side = lambda s: [F.col(f"{s}{k}") for k in range(classes)]
    cum = cum.withColumn("nl", sum(side("l"), F.lit(0.0))).withColumn("nr", sum(side("r"), F.lit(0.0)))
    cum = cum.where((F.col("nl") >= p.min_samples_leaf) & (F.col("nr") >= p.min_samples_leaf) & (F.col("nl") > 0) & (F.col("nr") > 0))
    n = F.col("nl") + F.col("nr")
    both = (F.col("nl") / n) * impurity(side("l"), F.col("nl"), p.criterion) + (F.col("nr") / n) * impurity(side("r"), F.col("nr"), p.criterion)
    best = cum.withColumn("impurity", both).groupBy("slot").agg(F.min(F.struct("impurity", "fidx", "threshold", *[c for s in "lr" for c in (f"{s}{k}" for k in range(classes))])).alias("s"))
    return {r["slot"]: r["s"].asDict() for r in best.collect()}


@dataclass
class Forest:
    params: Params
    features: list[str]
    classes: int
    subsets: list[list[int]]
    trees: list[Tree] = field(default_factory=list)
    edges: dict[str, list[float]] | None = None

    def votes(self, df: DataFrame, out: str = "votes") -> DataFrame:
        """``df`` with the class that each tree names."""
        ship_package(df.sparkSession)
        x = inputs(self.features)
        return df.withColumn(out, F.transform(treetable.leaf_values(x, len(self.features), self.trees), lambda v: v.cast("int")))

    def predict(self, df: DataFrame) -> DataFrame:
        """M3: the class that most trees name, the lowest on ties."""
        d = self.votes(df, "_votes_")
        n = F.array(*[F.size(F.filter("_votes_", (lambda k: lambda v: v == k)(k))) for k in range(self.classes)])
        return d.withColumn("prediction", (F.array_position(n, F.array_max(n)) - 1).cast("int")).drop("_votes_")

    def table(self, spark) -> DataFrame:
        return treetable.to_table(spark, [(t, 0, tree) for t, tree in enumerate(self.trees)])

    def save(self, spark, path: str) -> None:
        """The node table (Parquet) and a JSON document with everything else."""
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        info = {"params": asdict(self.params), "features": self.features, "classes": self.classes, "subsets": self.subsets, "edges": self.edges}
        spark.createDataFrame([(json.dumps(info, sort_keys=True),)], "info string").coalesce(1).write.mode("overwrite").json(f"{path}/forest")

    @staticmethod
    def load(spark, path: str) -> Forest:
        info = json.loads(spark.read.json(f"{path}/forest").first()["info"])
        trees = [tree for _, _, tree in treetable.from_table(spark.read.parquet(f"{path}/nodes"))]
        return Forest(Params(**info["params"]), info["features"], info["classes"], info["subsets"], trees, info["edges"])


def inputs(features: Sequence[str]) -> Column:
    """The features as an array of numbers; a missing value counts above all others."""
    top = F.lit(float("inf"))
    return F.array(*[F.nanvl(F.coalesce(F.col(f"`{c}`").cast("double"), top), top) for c in features])


def fit(train: DataFrame, features: Sequence[str], label: str, params: Params = Params(), keys: Sequence[str] = (), classes: int | None = None) -> Forest:
    """Trees on classes 0..K-1. ``keys`` (integer columns that tell rows apart) are needed for a bootstrap; rows without a label are left out."""
    p, spark, features = params, train.sparkSession, list(features)
    if p.bootstrap and not keys:
        raise ValueError("a bootstrap needs key columns")
    ship_package(spark)
    train = train.where(F.col(label).isNotNull())
    if classes is None:
        classes = int(train.agg(F.max(F.col(label).cast("int"))).first()[0] or 0) + 1
    n, many = len(features), p.n_estimators
    m = features_per_tree(n, p.max_features)
    subsets = [sampling.columns_drawn(n, m / n + 1e-9, p.seed, t) for t in range(many)]
    model = Forest(p, features, classes, subsets)
    x = inputs(features)
    if p.max_bins:
        model.edges = quantile_bin_edges(train, features, p.max_bins)
        raised = [F.coalesce(F.get(F.filter(F.array(*map(F.lit, model.edges[c])), (lambda i: lambda e: e >= x[i])(i)), F.lit(0)), F.lit(float("inf"))) for i, c in enumerate(features)]
        x = F.array(*raised)
    rows = train.select(x.alias("_x"), F.col(label).cast("int").alias("_y"), *[F.col(k).cast("long").alias(f"_key_{i}") for i, k in enumerate(keys)])
    own = [f"_key_{i}" for i in range(len(keys))]
    rows = sampling.bootstrap(rows, own, many, p.seed, "_w") if p.bootstrap else rows.withColumn("_w", F.array_repeat(F.lit(1), many))
    rows = keep_rows(rows.select("_x", "_y", "_w"))
    of_class = [F.when(F.col("_y") == k, F.col("e.w")).otherwise(0) for k in range(classes)]
    top = rows.select("_y", F.posexplode("_w").alias("t", "w")).groupBy("t").agg(*[F.sum(F.when(F.col("_y") == k, F.col("w")).otherwise(0)).alias(f"c{k}") for k in range(classes)])
    counts = {(r["t"], 0): [r[f"c{k}"] for k in range(classes)] for r in top.collect()}
    trees: list[Tree] = [[_node(0, counts[t, 0])] if (t, 0) in counts else [Node(0, 0)] for t in range(many)]
    open_ = [(t, 0) for t, _ in sorted(counts)]
    while open_ := [(t, i) for t, i in open_ if _may_split(trees[t][i].depth, counts[t, i], p)]:
        slot = {at: s for s, at in enumerate(open_)}
        slots = [np.full(len(trees[t]), -1) for t in range(many)]
        for (t, i), s in slot.items():
            slots[t][i] = s
        at = treetable.leaf_values(F.col("_x"), n, [[Node(**{**vars(x_), "value": float(slots[t][i])}) for i, x_ in enumerate(tree)] for t, tree in enumerate(trees)])
        each = F.filter(F.transform(F.arrays_zip(at.alias("s"), F.col("_w").alias("w")), lambda z, t: F.struct(z["s"].cast("int").alias("slot"), z["w"].alias("w"), t.alias("t"))), lambda z: (z["slot"] >= 0) & (z["w"] > 0))
        sub = F.array(*[F.array(*map(F.lit, s)) for s in subsets])
        long = rows.select("_x", "_y", F.explode(each).alias("e")).select("_x", "_y", "e", F.explode(F.get(sub, F.col("e.t"))).alias("fidx"))
        cells = long.groupBy(F.col("e.slot").alias("slot"), "fidx", F.get(F.col("_x"), F.col("fidx")).alias("value")).agg(*[F.sum(c).alias(f"c{k}") for k, c in enumerate(of_class)])
        best, new = _best_splits(cells, classes, p), []
        for (t, i), s in slot.items():
            if s not in best:
                continue
            b, tree = best[s], trees[t]
            node = tree[i]
            node.feature, node.col, node.threshold, node.cut = features[b["fidx"]], b["fidx"], b["threshold"], b["threshold"]
            node.gain = _impurity(counts[t, i], p.criterion) - b["impurity"]
            node.left, node.right = len(tree), len(tree) + 1
            for side in "lr":
                counts[t, len(tree)] = [int(b[f"{side}{k}"]) for k in range(classes)]
                new.append((t, len(tree)))
                tree.append(_node(node.depth + 1, counts[t, len(tree)]))
        open_ = new
    drop_rows(rows)
    model.trees = trees
    return model


def _node(depth: int, counts: list[int]) -> Node:
    """A leaf that names the most frequent class, the lowest on ties."""
    return Node(depth, int(sum(counts)), float(int(np.argmax(counts))))


def _may_split(depth: int, counts: list[int], p: Params) -> bool:
    return (p.max_depth is None or depth < p.max_depth) and sum(c > 0 for c in counts) > 1 and sum(counts) >= p.min_samples_split


def _impurity(counts: list[int], criterion: str) -> float:
    q = np.array([c for c in counts if c], float) / sum(counts)
    return float(1 - (q * q).sum()) if criterion == "gini" else float(-(q * np.log2(q)).sum())
