"""Fitted trees as a table of nodes, and scoring with it.

A tree is a list of nodes (node 0 is the root). Inner nodes test one column: the
row goes left if the column's value, decoded if the column is a bundle of
features, is at most the threshold. As a DataFrame each node is a row, from
which importances, persistence and scoring follow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .order import local_df

SCHEMA = (
    "tree int, cls int, node int, depth int, feature string, col int, low double, high double, threshold double, "
    "cut double, left_node int, right_node int, gain double, n long, value double"
)


@dataclass
class Node:
    """``low`` < value <= ``high`` marks the feature's part of a bundle (None: the column is the feature itself); ``cut`` is the threshold in the feature's own unit."""

    depth: int
    n: int
    value: float = 0.0
    feature: str | None = None
    col: int = -1
    low: float | None = None
    high: float | None = None
    threshold: float = 0.0
    cut: float | None = None
    left: int = -1
    right: int = -1
    gain: float = 0.0


Tree = list[Node]


def arrays(tree: Tree) -> tuple[np.ndarray, ...]:
    """Column, low, high, threshold, left, right and value of the nodes as arrays."""
    low = [-np.inf if x.low is None else x.low for x in tree]
    high = [np.inf if x.high is None else x.high for x in tree]
    plain = np.array([x.low is None for x in tree])
    return (
        np.array([x.col for x in tree]), np.array(low), np.array(high), plain, np.array([x.threshold for x in tree]),
        np.array([x.left for x in tree]), np.array([x.right for x in tree]), np.array([x.value for x in tree], float),
    )


def route(x: np.ndarray, flat: tuple[np.ndarray, ...]) -> np.ndarray:
    """The node that each row of ``x`` ends in."""
    col, low, high, plain, threshold, left, right, _ = flat
    at, bundled = np.zeros(len(x), np.int64), not plain.all()
    live = np.flatnonzero(col[at] >= 0)
    while len(live):
        n = at[live]
        v = x[live, col[n]]
        if bundled:
            v = np.where(plain[n], v, np.where((v > low[n]) & (v <= high[n]), v - low[n], 0))
        at[live] = np.where(v <= threshold[n], left[n], right[n])
        live = live[col[at[live]] >= 0]
    return at


def leaf_values(x: Column, width: int, trees: Sequence[Tree]) -> Column:
    """Array with the value that each tree gives the row, from the array column ``x`` of ``width`` column values (batches in Arrow)."""
    flat = [arrays(t) for t in trees]

    @F.arrow_udf("array<double>")
    def values(lists: pa.Array) -> pa.Array:
        m = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)
        out = np.empty((len(m), len(flat)))
        for k, f in enumerate(flat):
            out[:, k] = f[-1][route(m, f)]
        ends = np.arange(len(m) + 1, dtype=np.int32) * np.int32(len(flat))
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return values(x)


def to_table(spark: SparkSession, trees: Sequence[tuple[int, int, Tree]]) -> DataFrame:
    """(tree, class, nodes) as one row a node; its size is that of the model."""
    rows = [
        (t, c, i, x.depth, x.feature, x.col, x.low, x.high, float(x.threshold), x.cut, x.left, x.right, float(x.gain), int(x.n), float(x.value))
        for t, c, tree in trees for i, x in enumerate(tree)
    ]
    return local_df(spark, rows, SCHEMA)


def from_table(table: DataFrame) -> list[tuple[int, int, Tree]]:
    """The trees of a node table, by tree and class."""
    out: dict[tuple[int, int], Tree] = {}
    for r in table.orderBy("tree", "cls", "node").collect():
        node = Node(r["depth"], r["n"], r["value"], r["feature"], r["col"], r["low"], r["high"], r["threshold"], r["cut"], r["left_node"], r["right_node"], r["gain"])
        out.setdefault((r["tree"], r["cls"]), []).append(node)
    return [(t, c, tree) for (t, c), tree in out.items()]


def importances(table: DataFrame) -> DataFrame:
    """How often each feature splits a node, and its total gain."""
    inner = table.where("feature is not null")
    return inner.groupBy("feature").agg(F.count(F.lit(1)).alias("n_splits"), F.sum("gain").alias("total_gain"))
