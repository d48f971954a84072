"""M4: gradient boosted trees on histograms, grown leaf by leaf, as Spark jobs.

Rows hold their bins (one number a column) and scores; everything that grows
with the rows stays in Spark. A job routes the rows through the trees of the
round, adds the gradients of the rows in asked-for nodes up per (node, column,
bin) in each task and sums the tasks' histograms; their size is set by nodes,
columns and bins alone, and they come to the driver, which picks the splits.

Growth is best first: the leaf with the largest gain is split next until
``num_leaves``. Only the smaller child of a split is ever counted, the other is
its parent less it. One job serves all classes' trees and looks ahead: it counts
for the leaves that may still be split, so a tree takes about as many jobs as it
is deep. Looking ahead changes no result.

Sampling (W15), GOSS (W14) and bundles of exclusive features (T13) work inside
the rounds: draws are weights in the histograms, bundles are columns whose bins
are taken apart again before splits are compared, so conflict-free bundles give
the trees that the features themselves give.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import drop_rows, keep_rows, ship_package
from . import sampling, trees, treetable
from .treetable import Node, Tree

#: Numbers of one histogram job (nodes x columns x bins); more nodes go into further jobs.
HISTOGRAM_CELLS = 4_000_000
#: Leaves of a tree that a job may at least look ahead for.
AHEAD = 8
#: Rows that a task adds up at a time.
ROWS = 32_768


@dataclass(frozen=True)
class Params:
    objective: str = "softmax"
    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = 6
    num_leaves: int = 31
    min_child_samples: int = 20
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    min_split_gain: float = 0.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    max_bin: int = 255
    use_goss: bool = False
    top_rate: float = 0.2
    other_rate: float = 0.1
    use_efb: bool = False
    max_conflict_rate: float = 0.0
    early_stopping_rounds: int | None = None
    seed: int = 42


# ---------------------------------------------------------------- losses ---
class Softmax:
    """Cross entropy over classes 0..K-1."""

    def outputs(self, classes: int) -> int:
        return classes

    def start(self, df: DataFrame, label: str, classes: int) -> list[float]:
        r = df.agg(*[F.count_if(F.col(label) == k).alias(f"n{k}") for k in range(classes)]).first()
        n = [x + 1e-8 for x in r]
        return [float(np.log(x / sum(n))) for x in n]

    def _shares(self, s: list[Column]) -> list[Column]:
        m = F.greatest(*s) if len(s) > 1 else s[0]
        e = [F.exp(x - m) for x in s]
        total = sum(e[1:], e[0])
        return [x / total for x in e]

    def gradients(self, s: list[Column], y: Column) -> tuple[list[Column], list[Column]]:
        p = self._shares(s)
        return [x - (y == k).cast("double") for k, x in enumerate(p)], [x * (1.0 - x) for x in p]

    def loss(self, s: list[Column], y: Column) -> Column:
        p = F.element_at(F.array(*self._shares(s)), y.cast("int") + 1)
        return -F.log(F.least(F.greatest(p, F.lit(1e-8)), F.lit(1.0)))

    def prediction(self, s: list[Column]) -> Column:
        a = F.array(*s)
        return (F.array_position(a, F.array_max(a)) - 1).cast("int")

    def probabilities(self, s: list[Column]) -> Column:
        return F.array(*self._shares(s))


class Binary:
    """Cross entropy of a 0/1 label with one score."""

    def outputs(self, classes: int) -> int:
        return 1

    def start(self, df: DataFrame, label: str, classes: int) -> list[float]:
        p = min(max(float(df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0), 1e-6), 1 - 1e-6)
        return [float(np.log(p / (1 - p)))]

    def _p(self, s: list[Column]) -> Column:
        return 1.0 / (1.0 + F.exp(-F.least(F.greatest(s[0], F.lit(-35.0)), F.lit(35.0))))

    def gradients(self, s, y):
        p = self._p(s)
        return [p - y], [p * (1.0 - p)]

    def loss(self, s, y):
        p = F.least(F.greatest(self._p(s), F.lit(1e-8)), F.lit(1 - 1e-8))
        return -(y * F.log(p) + (1.0 - y) * F.log(1.0 - p))

    def prediction(self, s):
        return (self._p(s) >= 0.5).cast("int")

    def probabilities(self, s):
        return F.array(1.0 - self._p(s), self._p(s))


class SquaredError:
    """Squared error of a number."""

    def outputs(self, classes: int) -> int:
        return 1

    def start(self, df, label, classes):
        return [float(df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)]

    def gradients(self, s, y):
        return [s[0] - y], [F.lit(1.0)]

    def loss(self, s, y):
        return (s[0] - y) * (s[0] - y)

    def prediction(self, s):
        return s[0]

    def probabilities(self, s):
        raise ValueError("a regression has no class probabilities")


LOSSES = {"softmax": Softmax, "multiclass": Softmax, "binary": Binary, "mse": SquaredError, "regression": SquaredError}


# --------------------------------------------------------------- columns ---
@dataclass
class Columns:
    """How features become binned columns: bin edges, and the features of each column with where their bins lie in it.

    ``parts`` has for each feature (column, low, high): values in (low, high] of
    the column are its bins 1.. plus low; (None, None) if the column is the feature.
    """

    features: list[str]
    edges: dict[str, list[float]]
    bundles: list[list[str]]
    parts: dict[str, tuple[int, int | None, int | None]] = field(init=False)
    bins: list[int] = field(init=False)

    def __post_init__(self):
        self.parts, self.bins = {}, []
        for c, bundle in enumerate(self.bundles):
            if len(bundle) == 1:
                self.parts[bundle[0]] = (c, None, None)
                self.bins.append(self._bins(bundle[0]))
                continue
            at = 0
            for f in bundle:
                width = self._bins(f) - 1
                self.parts[f] = (c, at, at + width)
                at += width
            self.bins.append(at + 1)

    def _bins(self, feature: str) -> int:
        """Bins of a feature; the last one is that of missing values."""
        return max(2, len(self.edges[feature]))

    def binned(self, df: DataFrame, out: str = "_x") -> DataFrame:
        """``df`` with the array of column bins; in a bundle the first feature that is not in its lowest bin counts."""
        b = trees.bin_features(df, self.edges, "_bin_")
        of = {f: F.least(F.col(f"{f}_bin_"), F.lit(self._bins(f) - 1)) for f in self.features}
        cols = []
        for bundle in self.bundles:
            if len(bundle) == 1:
                cols.append(of[bundle[0]])
            else:
                cols.append(F.coalesce(*[F.when(of[f] > 0, of[f] + F.lit(self.parts[f][1])) for f in bundle], F.lit(0)))
        return b.select(*df.columns, F.array(*[c.cast("int") for c in cols]).alias(out))

    def by_feature(self, h: np.ndarray) -> np.ndarray:
        """A node's histogram (column, bin, 3) as (feature, bin, 3): the lowest bin of a bundled feature is the node less its other bins."""
        out = np.zeros((len(self.features), max(map(self._bins, self.features)), 3))
        total = h[0].sum(0)
        for i, f in enumerate(self.features):
            c, low, high = self.parts[f]
            if low is None:
                n = self.bins[c]
                out[i, :n] = h[c, :n]
            else:
                out[i, 1 : high - low + 1] = h[c, low + 1 : high + 1]
                out[i, 0] = total - out[i].sum(0)
        return out


def value_edges(df: DataFrame, cols: Sequence[str], max_bin: int) -> dict[str, list[float]]:
    """W11 edges, but a bin for each value where a feature has at most ``max_bin`` of them (two-valued features can then be split)."""
    few = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    small = [c for c in cols if few[c] <= 2 * max_bin]
    values = df.agg(*[F.array_sort(F.collect_set(F.col(c).cast("double"))).alias(c) for c in small]).first() if small else {}
    edges = {c: [values[c][0], *values[c][1:], values[c][-1]] for c in small if 0 < len(values[c]) <= max_bin}
    rest = [c for c in cols if c not in edges]
    return {**edges, **(trees.quantile_bin_edges(df, rest, max_bin) if rest else {})}


def plan_columns(df: DataFrame, features: Sequence[str], p: Params, edges: dict[str, list[float]] | None = None) -> Columns:
    """Edges by W11 unless given; with EFB, bundles of features that hardly ever leave their lowest bins together."""
    edges = edges or trees.quantile_bin_edges(df, list(features), p.max_bin)
    bundles = [[f] for f in features]
    if p.use_efb:
        b = trees.bin_features(df.select(*features), edges, "_bin_")
        conflicts = trees.conflict_matrix(b, [f"{f}_bin_" for f in features])
        found = trees.bundle_features([tuple(r) for r in conflicts.collect()], [f"{f}_bin_" for f in features], p.max_conflict_rate)
        bundles = [[f[: -len("_bin_")] for f in x] for x in found]
    return Columns(list(features), edges, bundles)


# ------------------------------------------------------------ histograms ---
def _adder(flat: list, slots: list[dict[int, int]], n_slots: int, width: int, bins: int):
    """Rows (x, g, h, w) to (slot, col, bin, g, h, n) sums of the task."""

    size = n_slots * width * bins

    def add(held: list, total: np.ndarray) -> None:
        x, g, h, w = (np.concatenate(a) for a in zip(*held))
        by_column = np.ascontiguousarray(x.T, dtype=np.int64)
        for k, wanted in enumerate(slots):
            if not wanted:
                continue
            slot = np.full(len(flat[k][0]), -1)
            slot[list(wanted)] = list(wanted.values())
            at = slot[treetable.route(x, flat[k])]
            rows = np.flatnonzero((at >= 0) & (w > 0))
            if not len(rows):
                continue
            # the slots of a class lie side by side, so a column's sums take no more room than they have
            low, some = min(wanted.values()), max(wanted.values()) - min(wanted.values()) + 1
            base, every = (at[rows] - low) * bins, len(rows) == len(x)
            sums = (g[rows, k] * w[rows], h[rows, k] * w[rows], None)
            for c in range(width):
                cell = base + (by_column[c] if every else by_column[c][rows])
                for i, v in enumerate(sums):
                    total[i, low : low + some, c] += np.bincount(cell, weights=v, minlength=some * bins).reshape(some, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = None, [], 0
        for b in batches:
            if not b.num_rows:
                continue
            total = np.zeros((3, n_slots, width, bins)) if total is None else total
            held.append((*(b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for i in range(3)), b.column(3).to_numpy(zero_copy_only=False)))
            n += b.num_rows
            if n >= ROWS:
                add(held, total)
                held, n = [], 0
        if held:
            add(held, total)
        if total is not None:
            total = total.reshape(3, size)
            on = np.flatnonzero(total[2])
            yield pa.RecordBatch.from_arrays([pa.array(on), *(pa.array(t[on]) for t in total)], ["cell", "g", "h", "n"])

    return run


def histograms(rows: DataFrame, grown: list[Tree], wanted: list[tuple[int, int]], columns: Columns) -> list[np.ndarray]:
    """For each (class, node) of ``wanted`` its (column, bin, 3) sums of gradient, Hessian and rows over ``rows`` (_x, _g, _h, _w)."""
    width, bins = len(columns.bundles), max(columns.bins)
    flat, out = [treetable.arrays(t) for t in grown], []
    step = max(1, HISTOGRAM_CELLS // (width * bins))
    for a in range(0, len(wanted), step):
        part = wanted[a : a + step]
        slots: list[dict[int, int]] = [{} for _ in grown]
        for i, (k, node) in enumerate(part):
            slots[k][node] = i
        sums = rows.select("_x", "_g", "_h", "_w").mapInArrow(_adder(flat, slots, len(part), width, bins), "cell bigint, g double, h double, n double")
        got = sums.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
        h = np.zeros((len(part) * width * bins, 3))
        at = got["cell"].to_numpy()
        for i, c in enumerate("ghn"):
            h[at, i] = got[c].to_numpy()
        out += list(h.reshape(len(part), width, bins, 3))
    return out


# ---------------------------------------------------------------- growth ---
def _significant(x: np.ndarray, digits: int = 10) -> np.ndarray:
    """Rounded to ``digits`` significant digits, so that sums added up in another order compare alike."""
    with np.errstate(divide="ignore", invalid="ignore"):
        unit = 10.0 ** (digits - 1 - np.floor(np.log10(np.abs(x))))
        return np.where((x == 0) | ~np.isfinite(x) | ~np.isfinite(unit), x, np.round(x * unit) / unit)


def _soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_split(h: np.ndarray, allowed: Sequence[int], p: Params) -> tuple[float, int, int, np.ndarray] | None:
    """W12 on a (feature, bin, 3) histogram: (gain, feature, bin, sums of the left child); ties go to the first feature, then the lowest bin."""
    left = np.cumsum(h, axis=1)[:, :-1]
    total = h.sum(1)[:, None]
    right = total - left
    score = lambda s: _soft(s[..., 0], p.reg_alpha) ** 2 / (s[..., 1] + p.reg_lambda)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _significant(0.5 * (score(left) + score(right) - score(total)))
    ok = np.zeros(gain.shape, bool)
    ok[list(allowed)] = True
    ok &= (left[..., 2] >= p.min_child_samples) & (right[..., 2] >= p.min_child_samples) & (gain > p.min_split_gain)
    if not ok.any():
        return None
    f, b = np.unravel_index(np.argmax(np.where(ok, gain, -np.inf)), gain.shape)
    return float(gain[f, b]), int(f), int(b), left[f, b]


def _leaf(s: np.ndarray, p: Params) -> float:
    g = float(_soft(s[0], p.reg_alpha))
    return -g / (float(s[1]) + p.reg_lambda) if g else 0.0


class _Growing:
    """One class's tree of the round: nodes with their sums, splits known so far and children made ahead of need."""

    def __init__(self, p: Params, columns: Columns, allowed: list[int], h: np.ndarray):
        self.p, self.columns, self.allowed = p, columns, allowed
        self.nodes: Tree = []
        self.sums: list[np.ndarray] = []
        self.hist: list[np.ndarray | None] = []
        self.split: list[tuple | None] = []
        self.add(0, h)

    def add(self, depth: int, h: np.ndarray) -> int:
        s = h[0].sum(0)
        best = None
        if depth < self.p.max_depth and s[2] >= 2 * self.p.min_child_samples:
            best = best_split(self.columns.by_feature(h), self.allowed, self.p)
        self.nodes.append(Node(depth, int(round(s[2])), _leaf(s, self.p)))
        self.sums.append(s)
        self.hist.append(h if best else None)
        self.split.append(best)
        return len(self.nodes) - 1

    def play(self) -> tuple[list[int], list[int]]:
        """Best-first growth as far as the children known reach: nodes split, and those whose children it may need next."""
        leaves, chosen = [0], []
        while len(leaves) < self.p.num_leaves:
            can = [i for i in leaves if self.split[i]]
            if not can:
                return chosen, []
            best = max(can, key=lambda i: self.split[i][0])  # the first of the largest
            if self.nodes[best].left < 0:
                ahead = sorted((i for i in can if self.nodes[i].left < 0), key=lambda i: -self.split[i][0])
                return chosen, ahead[: max(AHEAD, self.p.num_leaves - len(leaves))]
            chosen.append(best)
            leaves.remove(best)
            leaves += [self.nodes[best].left, self.nodes[best].right]
        return chosen, []

    def open(self, i: int) -> int:
        """Splits node ``i`` with children that are still to be counted; the smaller one's number."""
        gain, f, b, left = self.split[i]
        name = self.columns.features[f]
        col, low, high = self.columns.parts[name]
        x, edges = self.nodes[i], self.columns.edges[name]
        x.feature, x.col, x.low, x.high, x.threshold, x.gain = name, col, low, high, float(b), gain
        x.cut = float(edges[b + 1]) if b + 1 < len(edges) else None
        x.left, x.right = len(self.nodes), len(self.nodes) + 1
        n_left = left[2]
        for n in (n_left, self.sums[i][2] - n_left):
            self.nodes.append(Node(x.depth + 1, int(round(n))))
            self.sums.append(np.zeros(3))
            self.hist.append(None)
            self.split.append(None)
        return x.left if 2 * n_left <= self.sums[i][2] else x.right

    def close(self, i: int, small: int, h: np.ndarray) -> None:
        """Both children's sums and splits, from the smaller one's histogram and the parent's."""
        x = self.nodes[i]
        rest = self.hist[i] - h
        rest[..., 2] = np.round(rest[..., 2])
        rest[rest[..., 2] == 0] = 0.0  # empty cells are exactly empty
        for child, own in ((x.left, h if small == x.left else rest), (x.right, h if small == x.right else rest)):
            s = own[0].sum(0)
            best = None
            if x.depth + 1 < self.p.max_depth and s[2] >= 2 * self.p.min_child_samples:
                best = best_split(self.columns.by_feature(own), self.allowed, self.p)
            self.sums[child], self.split[child], self.hist[child] = s, best, own if best else None
            self.nodes[child].value = _leaf(s, self.p)
        self.hist[i] = None

    def tree(self) -> Tree:
        """The tree of the nodes that were chosen, numbered in the order in which they came to be."""
        chosen = set(self.play()[0])
        keep = [0] + [c for i in self.play()[0] for c in (self.nodes[i].left, self.nodes[i].right)]
        number = {i: k for k, i in enumerate(keep)}
        out = []
        for i in keep:
            x = self.nodes[i]
            if i in chosen:
                out.append(Node(x.depth, x.n, x.value, x.feature, x.col, x.low, x.high, x.threshold, x.cut, number[x.left], number[x.right], x.gain))
            else:
                out.append(Node(x.depth, x.n, x.value))
        return out


def grow(rows: DataFrame, outputs: int, columns: Columns, allowed: list[int], p: Params) -> tuple[list[Tree], dict]:
    """One tree an output from ``rows`` (_x, _g, _h, _w), and what it took: jobs, rows of the nodes split, rows counted for their children."""
    took = {"jobs": 1, "rows_of_split_nodes": 0, "rows_counted": 0}
    roots = histograms(rows, [[Node(0, 0)] for _ in range(outputs)], [(k, 0) for k in range(outputs)], columns)
    growing = [_Growing(p, columns, allowed, h) for h in roots]
    while True:
        asked = [(k, i, t.open(i)) for k, t in enumerate(growing) for i in t.play()[1]]
        if not asked:
            break
        got = histograms(rows, [t.nodes for t in growing], [(k, small) for k, _, small in asked], columns)
        took["jobs"] += 1
        for (k, i, small), h in zip(asked, got):
            growing[k].close(i, small, h)
            took["rows_of_split_nodes"] += growing[k].nodes[i].n
            took["rows_counted"] += growing[k].nodes[small].n
    return [t.tree() for t in growing], took


# ----------------------------------------------------------------- model ---
@dataclass
class Booster:
    params: Params
    columns: Columns
    outputs: int
    start: list[float]
    rounds: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    val_losses: list[float] = field(default_factory=list)
    best_iteration: int = 0
    work: list[dict] = field(default_factory=list)

    def _loss(self):
        return LOSSES[self.params.objective]()

    def score(self, df: DataFrame, num_iteration: int | None = None, out: str = "scores") -> DataFrame:
        """``df`` with the raw scores (an array) after the first ``num_iteration`` rounds (all)."""
        ship_package(df.sparkSession)
        some = self.rounds if num_iteration is None else self.rounds[:num_iteration]
        b = self.columns.binned(df, "_x_")
        start, rate, k = self.start, self.params.learning_rate, self.outputs
        if not some:
            return b.withColumn(out, F.array(*[F.lit(float(x)) for x in start])).drop("_x_")
        values = treetable.leaf_values(F.col("_x_"), len(self.columns.bundles), [t for r in some for t in r])
        b = b.withColumn("_leaf_", values)
        every = F.sequence(F.lit(0), F.lit(k * len(some) - 1))
        sums = [F.aggregate(F.filter(every, (lambda c: lambda i: i % k == c)(c)), F.lit(0.0), lambda s, i: s + F.col("_leaf_")[i]) for c in range(k)]
        total = [F.lit(float(start[c])) + F.lit(rate) * x for c, x in enumerate(sums)]
        return b.withColumn(out, F.array(*total)).drop("_x_", "_leaf_")

    def predict(self, df: DataFrame, num_iteration: int | None = None) -> DataFrame:
        d = self.score(df, num_iteration, "_s_")
        return d.withColumn("prediction", self._loss().prediction([F.col("_s_")[i] for i in range(self.outputs)])).drop("_s_")

    def predict_proba(self, df: DataFrame, num_iteration: int | None = None, out: str = "probability") -> DataFrame:
        d = self.score(df, num_iteration, "_s_")
        return d.withColumn(out, self._loss().probabilities([F.col("_s_")[i] for i in range(self.outputs)])).drop("_s_")

    def table(self, spark) -> DataFrame:
        return treetable.to_table(spark, [(r, k, t) for r, trees_ in enumerate(self.rounds) for k, t in enumerate(trees_)])

    def info(self) -> dict:
        return {
            "params": asdict(self.params), "features": self.columns.features, "edges": self.columns.edges, "bundles": self.columns.bundles, "outputs": self.outputs,
            "start": self.start, "losses": self.losses, "val_losses": self.val_losses, "best_iteration": self.best_iteration,
        }

    def save(self, spark, path: str) -> None:
        """The node table (Parquet) and a JSON document with everything else."""
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        local = spark.createDataFrame([(json.dumps(self.info(), sort_keys=True),)], "info string")
        local.coalesce(1).write.mode("overwrite").json(f"{path}/booster")

    @staticmethod
    def load(spark, path: str) -> Booster:
        info = json.loads(spark.read.json(f"{path}/booster").first()["info"])
        b = Booster(Params(**info["params"]), Columns(info["features"], info["edges"], info["bundles"]), info["outputs"], info["start"], [], info["losses"], info["val_losses"], info["best_iteration"])
        b.rounds = [[] for _ in info["losses"]]
        for r, _, tree in treetable.from_table(spark.read.parquet(f"{path}/nodes")):
            b.rounds[r].append(tree)
        return b


def fit(train: DataFrame, features: Sequence[str], label: str, params: Params = Params(), valid: DataFrame | None = None,
        weight: str | None = None, keys: Sequence[str] = (), classes: int | None = None, edges: dict[str, list[float]] | None = None) -> Booster:
    """Boosting rounds until ``n_estimators``, or until the loss of ``valid`` has not fallen for ``early_stopping_rounds`` rounds.

    Labels are 0..K-1 (softmax), 0/1 (binary) or numbers (mse). ``weight``
    multiplies gradients and Hessians. ``keys`` (integer columns that tell rows
    apart) are needed for row sampling and GOSS. Rows without a label are left
    out; a missing feature value counts above all others.
    """
    p, spark = params, train.sparkSession
    if p.objective not in LOSSES:
        raise ValueError(f"unknown objective: {p.objective}")
    if (p.use_goss or p.subsample < 1) and not keys:
        raise ValueError("row sampling needs key columns")
    ship_package(spark)
    loss, features = LOSSES[p.objective](), list(features)
    train = train.where(F.col(label).isNotNull())
    if classes is None:
        classes = int(train.agg(F.max(F.col(label).cast("int"))).first()[0] or 0) + 1 if isinstance(loss, Softmax) else 1
    outputs = loss.outputs(classes)
    columns = plan_columns(train, features, p, edges)
    start = loss.start(train, label, classes)
    model = Booster(p, columns, outputs, start, best_iteration=p.n_estimators)
    first = F.array(*[F.lit(float(x)) for x in start])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)

    def rows_of(df: DataFrame) -> DataFrame:
        d = columns.binned(df.select(*dict.fromkeys([*features, label, *([weight] if weight else []), *keys])), "_x")
        return d.select("_x", F.col(label).cast("double").alias("_y"), w.alias("_rw"), *[F.col(k).cast("long").alias(f"_key_{i}") for i, k in enumerate(keys)], first.alias("_s"))

    score = [F.col("_s")[i] for i in range(outputs)]
    y, own_keys = F.col("_y"), [f"_key_{i}" for i in range(len(keys))]
    d = keep_rows(rows_of(train))
    v = keep_rows(rows_of(valid.where(F.col(label).isNotNull()))) if valid is not None else None
    n, best, since = d.count(), np.inf, 0
    for r in range(p.n_estimators):
        g, h = loss.gradients(score, y)
        allowed = sampling.columns_drawn(len(features), p.colsample_bytree, p.seed, r)
        rows = d.select("_x", F.array(*g).alias("_g"), F.array(*h).alias("_h"), "_rw", *own_keys)
        if p.use_goss:
            # gradients and hashes are worked out once a round: the counts of the draw read them as columns
            size = sum((F.abs(x) for x in g[1:]), F.abs(g[0])) / float(outputs)
            hashes = [sampling.wide_hash(own_keys, p.seed + i, r).alias(f"_u{i}") for i in range(2)]
            full = keep_rows(d.select("_x", F.array(*g).alias("_g"), F.array(*h).alias("_h"), "_rw", size.alias("_size"), *hashes))
            drawn = sampling.goss_weight_hashed(full, F.col("_size"), F.col("_u0"), F.col("_u1"), p.top_rate, p.other_rate)
            rows = full
        else:
            full, drawn = None, F.when(sampling.subsample(d, own_keys, p.subsample, p.seed, r, n), 1.0).otherwise(0.0)
        rows = rows.select("_x", "_g", "_h", (F.col("_rw") * drawn).alias("_w"))
        if p.use_goss or p.subsample < 1:
            rows = keep_rows(rows.where("_w > 0"))  # the jobs of the round read the rows drawn alone
        drop_rows(full)
        grown, took = grow(rows, outputs, columns, allowed, p)
        drop_rows(rows)
        model.rounds.append(grown)
        model.work.append(took)
        d, mean = _moved(d, grown, columns, p.learning_rate, loss.loss(score, y))
        model.losses.append(mean)
        if v is not None:
            v, mean = _moved(v, grown, columns, p.learning_rate, loss.loss(score, y))
            model.val_losses.append(mean)
            if model.val_losses[-1] < best:
                best, since, model.best_iteration = model.val_losses[-1], 0, r + 1
            else:
                since += 1
            if p.early_stopping_rounds is not None and since >= p.early_stopping_rounds:
                break
    drop_rows(d, v)
    return model


def _moved(d: DataFrame, grown: list[Tree], columns: Columns, rate: float, value: Column) -> tuple[DataFrame, float]:
    """The rows with the round's trees added to their scores, written to the shared folder in place of those before, and the mean of ``value`` over them."""
    leaf = treetable.leaf_values(F.col("_x"), len(columns.bundles), grown)
    new = F.zip_with("_s", leaf, lambda s, x: s + F.lit(rate) * x)
    seen = Observation()
    out = keep_rows(d.withColumn("_s", new).observe(seen, F.avg(value).alias("mean")))  # taken while they are written
    drop_rows(d)
    return out, float(seen.get["mean"] or 0.0)
