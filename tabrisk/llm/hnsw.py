"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

1. Equal vectors are one vertex with its smallest ids (as many as a result can
   show of them), so copies neither fill neighbour lists nor are lost.
2. Vertices are dealt by hash to shards of about ``SHARD`` vertices; each shard
   builds its own graph in one task. A vertex has a level drawn from its hash;
   layer l holds the vertices of level l and above. With the vertices numbered
   from the highest level down, a layer is a prefix of them and its neighbour
   lists are one flat array of (vertices x slots), -1 where a slot is free.
3. Layers are built from the top down by inserting batches: a beam search in the
   graph so far (all vertices of a batch in step, in matrix products) gives the
   candidates, those of them that lie in different directions become neighbours,
   and full neighbour lists are thinned out in the same way.
4. The index is a written table, one row a shard. Queries go to every shard in
   blocks and find their nearest by the same beam search, layer by layer;
   the candidates are scored again from the original vectors in double precision
   and the results of the shards are merged.

For the inner product, vectors get one more component that brings all of a shard
to the same length (queries have 0 there): order by inner product is then order
by distance, which the graph needs. For the cosine, vectors are scaled to unit length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

K = 20
#: Vertices of a shard: bounds the memory of a task that builds or searches a graph.
SHARD = 16_384
#: Neighbours of a vertex in the upper layers; the ground layer has twice as many slots.
M = 16
#: Candidates that the beam keeps while a vertex is inserted, and while a query is answered.
EF_BUILD = 96
EF_SEARCH = 256
#: Vertices inserted, and queries answered, in step.
BATCH = 256
#: Beam entries whose neighbours are read in one step.
WIDTH = 4
#: Queries that one task has at a time for a shard.
QUERY_BLOCK = 16_384
#: Salts that a vector with many copies is spread over.
SALTS = 32

_NONE = np.float32(-np.inf)


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, ef: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` best vertices found for each row of ``q`` from the vertices in ``start`` (a row each, -1: none), best first: ids (-1: none), scores.

    Best-first search in step: the ``width`` best entries of each beam that have
    not been read yet give their neighbours to it, until every entry has been read.
    """
    rows, ef = len(q), min(ef, len(links))
    seen = np.zeros((rows, len(links) + 1), bool)
    seen[:, -1] = True  # where free slots (-1) point
    ids, score = np.full((rows, ef), -1, np.int32), np.full((rows, ef), _NONE, np.float32)
    read = np.ones((rows, ef), bool)
    live, new = np.arange(rows), start
    while len(live):
        new = np.sort(new, axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        new[seen[live[:, None], new]] = -1
        r, c = np.nonzero(new >= 0)
        at = new[r, c]
        seen[live[r], at] = True
        s = np.full(new.shape, _NONE, np.float32)
        s[r, c] = np.einsum("ij,ij->i", q[live[r]], x[at])
        if new.shape[1] > ef:
            best = np.argpartition(-s, ef - 1, axis=1)[:, :ef]
            new, s = np.take_along_axis(new, best, 1), np.take_along_axis(s, best, 1)
        all_s = np.concatenate([score[live], s], 1)
        order = np.argsort(-all_s, axis=1, kind="stable")[:, :ef]
        score[live] = np.take_along_axis(all_s, order, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], new], 1), order, 1)
        read[live] = np.take_along_axis(np.concatenate([read[live], s == _NONE], 1), order, 1)
        open_ = ~read[live]
        live, open_ = live[open_.any(1)], open_[open_.any(1)]
        if not len(live):
            break
        pick = np.argsort(~open_, axis=1, kind="stable")[:, :width]
        on = np.take_along_axis(open_, pick, 1)
        front = np.where(on, ids[live[:, None], pick], -1)
        read[live[:, None], pick] = True
        new = np.where(front[:, :, None] >= 0, links[front], -1).reshape(len(live), -1)
    return ids, score


def spread(x: np.ndarray, ids: np.ndarray, score: np.ndarray, m: int) -> np.ndarray:
    """Of each row's candidates (best first, -1: none) the ``m`` that become neighbours, -1 where there are fewer.

    A candidate that is nearer to a neighbour taken before than to the vertex
    itself is passed over; places that stay free go to those passed over, best first.
    """
    v = x[ids]
    between = v @ v.transpose(0, 2, 1)
    taken, closest = np.zeros(ids.shape, bool), np.full(ids.shape, _NONE, np.float32)
    count = np.zeros(len(ids), np.int64)
    for j in range(ids.shape[1]):
        ok = (ids[:, j] >= 0) & (count < m) & (closest[:, j] < score[:, j])
        taken[ok, j] = True
        count += ok
        closest[ok] = np.maximum(closest[ok], between[ok, j])
    rank = np.where(taken, 0, np.where(ids >= 0, 1, 2))
    pick = np.argsort(rank, axis=1, kind="stable")[:, :m]
    return np.take_along_axis(ids, pick, 1)


def _insert(x: np.ndarray, links: np.ndarray, a: int, b: int, start: np.ndarray, m: int, ef: int) -> None:
    """Vertices a..b-1 get neighbours among 0..b-1 and are made neighbours of theirs, in place. The first ``a`` are in already."""
    q, slots = x[a:b], links.shape[1]
    ids, score = beam(x, links[:a], q, start, ef) if a else (np.zeros((b, 0), np.int32), np.zeros((b, 0), np.float32))
    mates = q @ q.T
    np.fill_diagonal(mates, _NONE)
    pool = np.concatenate([ids, np.where(mates == _NONE, -1, np.arange(a, b, dtype=np.int32)[None, :])], 1)
    s = np.concatenate([score, mates], 1)
    best = np.argsort(-s, axis=1, kind="stable")[:, :ef]
    mine = spread(x, np.take_along_axis(pool, best, 1), np.take_along_axis(s, best, 1), m)
    links[a:b, : mine.shape[1]] = mine
    # the other way: the new vertices come to the lists of their neighbours
    r, c = np.nonzero(mine >= 0)
    to, frm = mine[r, c], (a + r).astype(np.int32)
    known = (links[to] == frm[:, None]).any(1)
    to, frm = to[~known], frm[~known]
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    if not len(to):
        return
    who, first, n = np.unique(to, return_index=True, return_counts=True)
    extra = np.full((len(who), n.max()), -1, np.int32)
    extra[np.repeat(np.arange(len(who)), n), np.arange(len(to)) - np.repeat(first, n)] = frm
    have = (links[who] >= 0).sum(1)
    room = have + n <= slots
    # lists with room take them as they are
    fill = room[np.repeat(np.arange(len(who)), n)]
    at = np.repeat(have, n) + np.arange(len(to)) - np.repeat(first, n)
    links[to[fill], at[fill]] = frm[fill]
    full = np.flatnonzero(~room)
    for k in range(0, len(full), BATCH):
        w = who[full[k : k + BATCH]]
        pool = np.concatenate([links[w], extra[full[k : k + BATCH]]], 1)
        s = np.where(pool >= 0, np.einsum("id,ijd->ij", x[w], x[pool]), _NONE)
        best = np.argsort(-s, axis=1, kind="stable")[:, : 2 * slots]
        links[w] = spread(x, np.take_along_axis(pool, best, 1), np.take_along_axis(s, best, 1), slots)


def build(x: np.ndarray, level: np.ndarray, m: int = M, ef: int = EF_BUILD) -> list[np.ndarray]:
    """The layers' flat neighbour arrays, ground layer first. ``level`` must not rise along the rows of ``x`` (float32, all of one length)."""
    layers: list[np.ndarray] = []
    for l in range(int(level[0]) if len(level) else 0, -1, -1):
        n = int((level >= l).sum())
        links = np.full((n, m if l else 2 * m), -1, np.int32)
        a = 0
        while a < n:
            b = min(n, a + max(1, min(BATCH, a)))
            _insert(x[:n], links, a, b, _descend(x, layers, x[a:b], a), m, ef)
            a = b
        layers.insert(0, links)
    return layers


def _descend(x: np.ndarray, upper: list[np.ndarray], q: np.ndarray, inserted: int) -> np.ndarray:
    """Where to enter the layer below ``upper`` (its layers, the lowest first): the best few of the layer above that are in it already."""
    start = np.zeros((len(q), 1), np.int32)
    for links in reversed(upper):
        start, _ = beam(x, links, q, start, 8)
    start = np.where(start < inserted, start, -1)
    return np.concatenate([start, np.zeros((len(q), 1), np.int32)], 1)


def search(x: np.ndarray, layers: list[np.ndarray], q: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
    """The ``ef`` best vertices found for each query, best first, -1 where there are fewer. A shard no larger than the beam is looked at whole."""
    out = np.full((len(q), ef), -1, np.int32)
    for a in range(0, len(q) if layers else 0, BATCH):
        part = q[a : a + BATCH]
        start = _descend(x, layers[1:], part, len(x)) if len(x) > ef else np.tile(np.arange(len(x), dtype=np.int32), (len(part), 1))
        ids, _ = beam(x, layers[0], part, start, ef)
        out[a : a + BATCH, : ids.shape[1]] = ids
    return out


def _rows(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of one length as rows in double precision."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _even(x: np.ndarray, scale: bool = True) -> np.ndarray:
    """Rows scaled so that their squares neither overflow nor vanish: each to unit length, or all by the longest."""
    x = x / np.abs(x).max(1, keepdims=True, initial=1e-300) if scale else x / np.abs(x).max(initial=1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True) if scale else x / np.linalg.norm(x, axis=1).max(initial=1e-300)


def _vertices_for_graph(x: np.ndarray, measure: str) -> np.ndarray:
    if measure == "cosine":
        return _even(x).astype(np.float32)
    x = _even(x, scale=False)
    return np.concatenate([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1, keepdims=True)))], 1).astype(np.float32)


def _queries_for_graph(q: np.ndarray, measure: str) -> np.ndarray:
    q = _even(q).astype(np.float32)
    return q if measure == "cosine" else np.concatenate([q, np.zeros((len(q), 1), np.float32)], 1)


def exact_scores(x: np.ndarray, q: np.ndarray, measure: str) -> np.ndarray:
    """The measure of rows of ``x`` with those of ``q`` in double precision, component by component from the first."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * q[:, j]
    if measure == "cosine":
        total /= np.linalg.norm(x, axis=1) * np.linalg.norm(q, axis=1)
    return total


_INDEX = "shard int, dim int, vectors binary, ids binary, ends binary, layers array<binary>"


def _indexer(m: int, ef: int, measure: str):
    def one(t: pa.Table) -> pa.Table:
        shard, dim = t["shard"][0].as_py(), t["dim"][0].as_py()
        t = t.sort_by([("level", "descending"), ("node", "ascending")])
        x, ids = _rows(t["embedding"], dim), t["ids"].combine_chunks()
        layers = build(_vertices_for_graph(x, measure), t["level"].to_numpy(), m, ef)
        ends = np.cumsum(ids.value_lengths().to_numpy(), dtype=np.int64)
        row = {"shard": shard, "dim": dim, "vectors": x.tobytes(), "ids": ids.flatten().to_numpy().astype(np.int64).tobytes(), "ends": ends.tobytes(), "layers": [l.tobytes() for l in layers]}
        return pa.Table.from_pylist([row], pa.schema([("shard", pa.int32()), ("dim", pa.int32()), ("vectors", pa.binary()), ("ids", pa.binary()), ("ends", pa.binary()), ("layers", pa.list_(pa.binary()))]))

    return one


def index(vertices: DataFrame, shard_rows: int = SHARD, m: int = M, ef: int = EF_BUILD, measure: str = "inner_product") -> tuple[DataFrame, int]:
    """The written index of ``vertices`` (node, ids, dim, embedding), a row for each shard and vector length, and the number of shards."""
    shards = max(1, -(-vertices.count() // shard_rows))
    u = (F.shiftrightunsigned(F.xxhash64("node", F.lit(1)), 11) + 0.5) / float(1 << 53)
    level = F.floor(-F.log(u) / float(np.log(m))).cast("int")
    dealt = vertices.select("*", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"), level.alias("level"))
    return cut_lineage(dealt.groupBy("shard", "dim").applyInArrow(_indexer(m, ef, measure), _INDEX)), shards


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _searcher(k: int, m: int, ef: int, measure: str):
    """Shards and queries of one block to the ``k`` best ids of each query in each shard."""

    def shard(row: dict, q: np.ndarray, own: np.ndarray) -> pa.Table:
        x = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
        ids, ends = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64)
        first = np.concatenate([[0], ends[:-1]])
        layers = [np.frombuffer(b, np.int32).reshape(-1, 2 * m if i == 0 else m) for i, b in enumerate(row["layers"])]
        graph, out = _vertices_for_graph(x, measure), []
        for a in range(0, len(q), BATCH):
            part = q[a : a + BATCH]
            got = search(graph, layers, _queries_for_graph(part, measure), max(ef, k + 1))
            r, c = np.nonzero(got >= 0)
            at = got[r, c]
            s = exact_scores(x[at], part[r], measure)
            table = np.full(got.shape, -np.inf)
            table[r, c] = s
            if table.shape[1] > k + 1:  # each vertex has an id at least, and one may be the query's own
                on = s >= np.partition(table, -(k + 1), axis=1)[r, -(k + 1)]
                r, at, s = r[on], at[on], s[on]
            n = ends[at] - first[at]
            r, s = np.repeat(r, n), np.repeat(s, n)
            vec = ids[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at], n)]
            on = vec != own[a + r]
            r, s, vec = r[on], s[on], vec[on]
            order = np.lexsort((vec, -s, r))
            r, s, vec = r[order], s[order], vec[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            on = place < k
            out.append(pa.Table.from_arrays([pa.array(own[a + r[on]]), pa.array(vec[on]), pa.array(s[on])], schema=_FOUND))
        return pa.concat_tables(out)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [_FOUND.empty_table()]
        for row in left.to_pylist() if right.num_rows else []:
            t = right.filter(pa.compute.equal(right["dim"], row["dim"]))
            if t.num_rows:
                parts.append(shard(row, _rows(t["embedding"], row["dim"]), t["id"].to_numpy()))
        return pa.concat_tables(parts)

    return run


def usable_vectors(vectors: DataFrame, id_col: str, embedding: str) -> DataFrame:
    """Distinct rows (id, embedding, dim) whose vector is neither null, empty or zero nor holds null or non-finite components."""
    kind = vectors.select(F.col(f"`{embedding}`")).schema[0].dataType.simpleString()
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast(kind if kind == "array<float>" else "array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    ok = F.col("id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0)
    return rows.where(F.coalesce(ok, F.lit(False))).distinct().withColumn("dim", F.size("embedding"))


def nearest(vectors: DataFrame, id_col: str = "vec_id", embedding: str = "embedding", every: int = 20, k: int = K, measure: str = "inner_product", shard_rows: int = SHARD, m: int = M, ef_build: int = EF_BUILD, ef: int = EF_SEARCH) -> DataFrame:
    """The ``k`` nearest found (query_id, rank, vec_id, score) for each row whose id ``every`` divides, among all other rows.

    ``measure``: inner_product or cosine, the larger the nearer; ties go to the
    smaller id. Vectors that are null, empty or zero or hold null or non-finite
    components take no part, nor do rows with a null id; vectors of different
    lengths do not meet. Rows that repeat an id and its vector are one; an id
    with several vectors takes part with each and counts with its best score. A
    query has fewer results only where there are fewer candidates. An empty
    table, or one without queries, gives an empty result.
    """
    if measure not in ("inner_product", "cosine"):
        raise ValueError(f"unknown measure: {measure}")
    good = cut_lineage(usable_vectors(vectors, id_col, embedding))
    # no result shows more than k + 1 copies of a vector; the many copies of one are thinned out in salted parts first
    first = Window.partitionBy("embedding", "salt").orderBy("id")
    few = good.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    ids = F.slice(F.array_sort(F.collect_list("id")), 1, k + 1)
    vertices = few.groupBy("embedding").agg(ids.alias("ids")).select(F.element_at("ids", 1).alias("node"), "ids", F.size("embedding").alias("dim"), "embedding")
    shards_table, shards = index(cut_lineage(vertices), shard_rows, m, ef_build, measure)

    queries = good.where(F.pmod("id", F.lit(every)) == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    each = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    left = shards_table.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = left.groupBy("shard", "block").cogroup(each.groupBy("shard", "block")).applyInArrow(_searcher(k, m, ef, measure), "query_id bigint, vec_id bigint, score double")
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
