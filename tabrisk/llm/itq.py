"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

1. Equal vectors are one vertex with a weight.
2. A rotation for balanced binary codes is learned on a bounded sample
   (``SAMPLE`` vectors, chosen by hash); every vector gets a code of up to 64 bits.
3. The radius is ``RADIUS`` bits, or more where pairs at the threshold simulated
   on the sample differ in more (vectors with a large common part); the code is
   cut into ``TABLES`` substrings, or more for a larger radius. A vector is filed in each table
   under its substring and all its one-bit neighbours, so codes whose
   substrings differ in up to two bits meet. Pairs that meet and differ in up
   to the radius overall make candidate groups (a spanning forest for each
   bucket, then connected components): no list of pairs is made.
4. Candidate groups are reranked with the original vectors in double
   precision, in tiles of ``TILE`` vectors: tiles of a large group go to
   different tasks, and each gives link counts and a spanning forest of the
   links. Every link that is reported has been computed exactly.

The search can miss a link only if no substring of two codes is within two bits
or the codes differ in more bits than the radius, and the two are not in one
group by way of others; tests measure the recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .components import components
from .simhash import _FOUND, _tile_pairs, _verify, tile_pairs

THRESHOLD = 0.95
SAMPLE = 8_192
BITS = 64
TABLES = 4
RADIUS = 12
#: Share of the pairs at the threshold, simulated on the sample, whose codes have to lie within the radius.
WITHIN = 0.98
ROUNDS = 40
#: Vectors of a group that are compared at a time.
TILE = 1_024
CODE_TILE = 8_192


def learn(x: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (principal directions times the learned rotation) for unit vectors ``x``."""
    mean = x.mean(0)
    k = min(bits, x.shape[1])
    w = np.linalg.eigh((x - mean).T @ (x - mean))[1][:, ::-1][:, :k]
    v = (x - mean) @ w
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(k, k)))[0]
    for _ in range(rounds):
        u, _, wt = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ wt).T
    return mean, w @ r


def encode(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """Codes as unsigned 64-bit integers, the first bit lowest."""
    on = (x - mean) @ proj >= 0
    return (on.astype(np.uint64) << np.arange(proj.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64)


def reach(x: np.ndarray, mean: np.ndarray, proj: np.ndarray, threshold: float, seed: int = 12) -> int:
    """Bits in which the codes of two vectors at cosine ``threshold`` differ, at ``WITHIN`` of the unit vectors ``x``.

    The codes see the angle of the centred vectors, which for the same cosine is
    wider the more the vectors have in common. Each vector gets a partner at the
    threshold in the direction of a difference between two others, and one in any
    direction; the larger figure counts.
    """
    if len(x) < 2 or not 0 < threshold < 1:
        return 0
    rng, out = np.random.default_rng(seed), 0
    for u in (x[rng.permutation(len(x))] - x[rng.permutation(len(x))], rng.normal(size=x.shape)):
        u = u - (u * x).sum(1, keepdims=True) * x
        size = np.linalg.norm(u, axis=1)
        on = size > 1e-9
        if on.any():
            y = threshold * x[on] + np.sqrt(1 - threshold**2) * u[on] / size[on, None]
            out = max(out, int(np.ceil(np.quantile(np.bitwise_count(encode(x[on], mean, proj) ^ encode(y, mean, proj)), WITHIN))))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of floats as rows in double precision, shorter ones padded with zeros."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum([0, *(len(v) for v in column)])
    if len(column) and (np.diff(ends) == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width))
    for i in range(len(column)):
        out[i, : ends[i + 1] - ends[i]] = flat[ends[i] : ends[i + 1]]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True, initial=1e-300)  # first to a scale whose squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coder(shared, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, proj = shared.value
        for b in batches:
            code = encode(_unit(_matrix(b.column("embedding"), width)), mean, proj) if b.num_rows else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(code.view(np.int64))], ["node", "fp"])

    return run


def _table_keys(bits: int, tables: int):
    """Codes to (key, code): the table's number and its substring with at most one bit flipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = [bits * i // tables for i in range(tables + 1)]
        for b in batches:
            code = b.column(0).to_numpy(zero_copy_only=False)
            u = code.view(np.uint64)
            for t, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                sub = ((u >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)
                for flip in [0, *(1 << j for j in range(hi - lo))]:
                    yield pa.RecordBatch.from_arrays([pa.array(((sub ^ flip) | (t << 24)).astype(np.int32)), pa.array(code)], ["key", "fp"])

    return run


def _rerank(threshold: float, width: int):
    """Sorted (cell, i, j, tile, node, weight, dim, embedding) rows to link counts and forests of each tile pair."""

    def links(nodes, weights, x, dims, own):
        """``own``: which rows belong to the first tile; all of them when a tile meets itself."""
        a, b = (np.arange(len(nodes)),) * 2 if own.all() else (np.flatnonzero(own), np.flatnonzero(~own))
        near = (x[a] @ x[b].T >= threshold) & (dims[a][:, None] == dims[b][None, :])
        if own.all():
            np.fill_diagonal(near, False)
        n = np.zeros(len(nodes), np.int64)
        n[a] += near @ weights[b]
        if not own.all():
            n[b] += near.T @ weights[a]
        tied = np.zeros((len(nodes),) * 2, bool)
        tied[np.ix_(a, b)] = near
        tied |= tied.T
        left, right, rest = [], [], np.ones(len(nodes), bool)
        for s in range(len(nodes)):
            if not rest[s]:
                continue
            rest[s], todo = False, [s]
            while todo:
                i = todo.pop()
                new = np.flatnonzero(tied[i] & rest)
                rest[new] = False
                left += [i] * len(new)
                right += new.tolist()
                todo += new.tolist()
        k = len(left)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([nodes, nodes[left]])), pa.array(np.concatenate([n, np.zeros(k, np.int64)])), pa.array([None] * len(nodes) + nodes[right].tolist(), pa.int64())], ["node", "n", "other"])

    def one(rows):
        node, weight, dim, emb, first = (np.concatenate(c) for c in zip(*rows))
        if len(node) > 1 and first.any():
            yield from links(node, weight, _unit(emb), dim, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            keys = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "i", "j")], 1)
            cut = np.r_[0, np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1, len(keys)] if len(keys) else np.zeros(0, np.int64)
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in ("node", "weight", "dim")] + [_matrix(b.column("embedding"), width), b.column("tile").to_numpy(zero_copy_only=False) == b.column("i").to_numpy(zero_copy_only=False)]
            for s, e in zip(cut, cut[1:]):
                key = tuple(keys[s])
                if key != now and held:
                    yield from one(held)
                    held = []
                now = key
                held.append([c[s:e] for c in cols])
        if held:
            yield from one(held)

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, sample: int = SAMPLE, tables: int = TABLES, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, and so do vectors of different lengths and rows with a
    null id (whose component is null and which are not kept). Rows that repeat
    an id and its vector are one vector and each gets its row; an id with
    several vectors has the links of all of them. An empty table stays empty.
    ``radius`` and ``tables`` are the least values; the sample may ask for more.
    """
    kind = vectors.select(F.col(f"`{embedding}`")).schema[0].dataType.simpleString()
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast(kind if kind == "array<float>" else "array<double>").alias("e"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & (F.size("e") > 0) & finite & F.exists("e", lambda v: v != 0), F.lit(False))
    good = rows.where(usable).distinct()
    reps = cut_lineage(good.groupBy("e").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight")).select("node", "weight", F.size("e").alias("dim"), F.col("e").alias("embedding")))
    width = reps.agg(F.max("dim")).first()[0] or 1

    # only hashes in the part of the range that holds about four times the sample are put in order
    place = F.shiftrightunsigned(F.xxhash64("node"), 11) / float(1 << 53)
    few = reps.where(place < F.lit(4.0 * sample / max(1, reps.count()))).orderBy(F.xxhash64("node"), "node").limit(sample).select("embedding").toArrow()
    x = _unit(_matrix(pa.concat_arrays(few.column(0).chunks) if few.num_rows else pa.array([], pa.list_(pa.float64())), width)) if few.num_rows else np.eye(width)
    mean, proj = learn(x)
    bits = proj.shape[1]
    radius = max(radius, reach(x, mean, proj, threshold)) if few.num_rows else radius
    tables = max(tables, -(-radius // 3))  # a table finds two bits, so these find all codes closer than the radius
    shared = vectors.sparkSession.sparkContext.broadcast((mean, proj))
    codes = cut_lineage(reps.select("node", "embedding").mapInArrow(_coder(shared, width), "node bigint, fp bigint"))

    keyed = codes.select("fp").distinct().mapInArrow(_table_keys(bits, min(tables, bits)), "key int, fp bigint").repartition(F.col("key")).sortWithinPartitions("key", "fp")
    found = cut_lineage(keyed.mapInArrow(_verify(radius, CODE_TILE), _FOUND).where("members is not null or a is not null"))
    more = tile_pairs(found).mapInArrow(_tile_pairs(radius), "a bigint, b bigint")
    cells = components(found.where("a is not null").select("a", "b").unionByName(more)).select(F.col("node").alias("fp"), F.col("root"))
    of = cut_lineage(codes.join(cells, "fp", "left").select("node", F.coalesce("root", "fp").alias("cell")))

    sizes = of.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    v = of.join(sizes, "cell").join(reps, "node").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    v = v.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("cell", F.least("tile", "o").alias("i"), F.greatest("tile", "o").alias("j"), "tile", "node", "weight", "dim", "embedding")
    v = v.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    got = cut_lineage(v.mapInArrow(_rerank(threshold, width), "node bigint, n bigint, other bigint"))
    counts = got.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(got.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))

    named = good.join(reps.select("node", "weight", F.col("embedding").alias("e")), "e").select("id", "node", "weight")
    per = named.join(counts, "node", "left").join(roots, "node", "left")
    per = per.groupBy("id").agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.min(F.coalesce("root", "node")).alias("component_id"))
    out = rows.select("id").join(per, "id", "left")
    comp = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(comp == F.col("id"), F.lit(False)).alias("kept"))
