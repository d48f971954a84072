"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: ASCII-lowered words split at ASCII white space, 4-word shingles
with repeats (fewer words: the whole sequence; none: fingerprint 0), XXH64 with
seed 42; a bit is 1 if it is set in over half the hashes.

Search: the 64 bits are cut into three segments, each a word of the perfect
binary Golay code (23, 12, 7). The keys of a segment are the indices of all
codewords within distance 4 (one, or six when the nearest is at distance 3), so
that two segments with at most two differing bits share a key. With at most
four errors over three segments, two of the segments have at most two errors
together: each pair of segments gives compound keys of 24 bits and one of them
is shared. Rows meet by key, are verified by XOR and bit count, and each bucket
gives a spanning forest of its links, never all its pairs.

A bucket of more than ``TILE`` fingerprints is cut into tiles; every two tiles
are a key of their own, so their comparisons are spread over the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_KEY, append, broadcast_if_small, cut_lineage, with_row_key
from .components import components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: Widths of the segments of a fingerprint, from the low bits up; each is padded with zeros to 23 bits.
SEGMENTS = (22, 21, 21)
#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0xC75
#: Fingerprints of a bucket that one task compares at a time.
TILE = 8192
#: Shingles hashed at a time; bounds the memory of very long texts.
BLOCK = 32_768


def _lanes() -> np.ndarray:
    """For each byte a 64-bit word whose eight lanes hold the byte's bits (lowest bit in the lowest lane)."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return (bits.astype(np.uint64) << (8 * np.arange(8, dtype=np.uint64))).sum(1, dtype=np.uint64)


def _bit_counts(h: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set: lane sums of at most 255 rows, then wide sums."""
    rows = lanes[h.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(rows, np.arange(0, len(rows), 255), axis=0)
    return sums.view(np.uint8).reshape(len(sums), 64).sum(0, dtype=np.int64)


def _fingerprinter(size: int = SHINGLE, seed: int = SEED):
    lanes, h64 = _lanes(), xxhash.xxh64_intdigest
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)

    def one(text: bytes | None) -> int:
        words = (text or b"").lower().split()
        if not words:
            return 0
        if len(words) <= size:
            return h64(b" ".join(words), seed)
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        n = len(words) - size + 1
        starts = np.concatenate(([0], ends[: n - 1] + 1))
        counts = np.zeros(64, np.int64)
        for k in range(0, n, BLOCK):
            a, b = starts[k : k + BLOCK].tolist(), ends[size - 1 + k : size - 1 + k + BLOCK].tolist()
            counts += _bit_counts(np.array([h64(joined[x:y], seed) for x, y in zip(a, b)], np.uint64), lanes)
        return int(weights[counts * 2 > n].sum(dtype=np.uint64))

    def batch(texts: list) -> list[pa.Array]:
        return [pa.array(np.array([one(t) for t in texts], np.uint64).view(np.int64))]

    return batch


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``keep`` and ``fp`` (the 64 bits as a signed long) for each row. Null text counts as empty."""
    return append(docs, keep, text, "fp bigint", lambda: _fingerprinter(shingle, seed))


def _golay_table() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the error patterns of weight four at most that have it, and how many there are."""
    found: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            found[int(_syndrome(np.array([e]))[0])].append(e)
    most = max(map(len, found))
    return np.array([x + [0] * (most - len(x)) for x in found], np.int64), np.array(list(map(len, found)))


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator polynomial."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where((r >> bit) & 1, r ^ (GOLAY << (bit - 11)), r)
    return r


def segment_keys(words: np.ndarray, tab: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices (12 bits) within distance four of each 23-bit word, and which of the columns hold one."""
    s = _syndrome(words)
    return (words[:, None] ^ tab[s]) >> 11, np.arange(tab.shape[1])[None, :] < n[s][:, None]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tab, n = _golay_table()
    for b in batches:
        all_fp = b.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(all_fp), 20_000):
            fp = all_fp[at : at + 20_000]
            u, low, segs = fp.view(np.uint64), 0, []
            for width in SEGMENTS:
                segs.append(segment_keys(((u >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64), tab, n))
                low += width
            for p, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
                (ki, oi), (kj, oj) = segs[i], segs[j]
                key = (p << 24) | (ki[:, :, None] << 12) | kj[:, None, :]
                ok = oi[:, :, None] & oj[:, None, :]
                yield pa.RecordBatch.from_arrays([pa.array(key[ok].astype(np.int32)), pa.array(np.repeat(fp, ok.sum((1, 2))))], ["key", "fp"])


def forest(a: np.ndarray, b: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``a``, or within the union of ``a`` and ``b``: breadth first, each found value leaves the rest."""
    rest = a if b is None else np.concatenate([a, b])
    left, right = [], []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            near = np.bitwise_count((rest ^ x).view(np.uint64)) <= bits
            if near.any():
                new, rest = rest[near], rest[~near]
                left.append(np.full(len(new), x))
                right.append(new)
                todo.extend(new)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


_FOUND = "a bigint, b bigint, key int, tile int, members binary"


def _verify(bits: int, tile: int):
    """Sorted (key, fp) rows to verified links; buckets above ``tile`` also give their tiles for the second pass."""

    def links(a, b):
        k = len(a)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], ["a", "b", "key", "tile", "members"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int32), np.zeros(0, np.int64)
        tiles = 0  # of the bucket that ``key`` starts with, already given out

        def runs(key, fp):
            """Whole buckets: short ones by comparing shifted rows, long ones by a forest."""
            if len(key) < 2:
                return
            cut = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.r_[0, cut], np.r_[cut, len(key)]
            short = np.repeat(ends - starts <= 8, ends - starts)
            la, lb = [], []
            for d in range(1, 8):
                if len(key) <= d:
                    break
                same = (key[:-d] == key[d:]) & short[d:]
                i = np.flatnonzero(same)
                i = i[np.bitwise_count((fp[i] ^ fp[i + d]).view(np.uint64)) <= bits]
                la.append(fp[i])
                lb.append(fp[i + d])
            for k in np.flatnonzero(ends - starts > 8):
                x, y = forest(fp[starts[k] : ends[k]], None, bits)
                la.append(x)
                lb.append(y)
            if la and sum(map(len, la)):
                pairs = np.unique(np.stack([np.concatenate(la), np.concatenate(lb)], 1), axis=0)
                yield links(pairs[:, 0], pairs[:, 1])

        def tile_row(k, at, members):
            return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([k], pa.int32()), pa.array([at], pa.int32()), pa.array([members.tobytes()], pa.binary())], ["a", "b", "key", "tile", "members"])

        def flush(key, fp, tiles):
            """The rest of a bucket whose earlier tiles went out already."""
            yield links(*forest(fp, None, bits))
            yield tile_row(int(key[0]), tiles, fp)

        for b in batches:
            key = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False)])
            while len(key):
                end = int(np.searchsorted(key, key[0], "right"))
                if tiles and end < len(key):
                    yield from flush(key[:end], fp[:end], tiles)
                    key, fp, tiles = key[end:], fp[end:], 0
                    continue
                if end >= 2 * tile:  # a hot bucket: give out one tile now
                    yield from flush(key[:tile], fp[:tile], tiles)
                    key, fp, tiles = key[tile:], fp[tile:], tiles + 1
                    continue
                if tiles or end == len(key):
                    break  # its last rows may still come
                # whole buckets up to the last key; a long one among them is taken apart by the branches above
                change = np.flatnonzero(np.diff(key)) + 1
                sizes = np.diff(np.r_[0, change])
                big = np.flatnonzero(sizes >= 2 * tile)
                stop = int(np.r_[0, change][big[0]]) if len(big) else int(change[-1])
                yield from runs(key[:stop], fp[:stop])
                key, fp = key[stop:], fp[stop:]
        if len(key) and tiles:
            yield from flush(key, fp, tiles)
        else:
            yield from runs(key, fp)

    return run


def _tile_pairs(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                u, v = forest(np.unique(np.frombuffer(x + y, np.int64)), None, bits)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["a", "b"])

    return run


def links(distinct: DataFrame, bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) at ``bits`` or fewer differing bits: enough of them to connect every group.

    ``bits`` is at most four, which the Golay segments guarantee to find.
    """
    if not 0 <= bits <= 4:
        raise ValueError("the segments find up to four differing bits")
    found = distinct.select("fp").mapInArrow(_keys, "key int, fp bigint").repartition(F.col("key")).sortWithinPartitions("key", "fp")
    found = cut_lineage(found.mapInArrow(_verify(bits, tile), _FOUND).where("members is not null or a is not null"))
    return found.where("a is not null").select("a", "b").unionByName(tile_pairs(found).mapInArrow(_tile_pairs(bits), "a bigint, b bigint"))


def tile_pairs(found: DataFrame) -> DataFrame:
    """Every two tiles (members, members2) of a bucket, each pair a key of its own: the pairs of a hot bucket are spread over tasks."""
    tiles = found.where("members is not null").select("key", "tile", "members")
    sized = tiles.join(tiles.groupBy("key").agg(F.max("tile").alias("last")), "key")
    each = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last")))).where("other <> tile")
    left = each.where("tile < other").select("key", F.col("tile").alias("i"), F.col("other").alias("j"), "members")
    right = each.where("tile > other").select("key", F.col("other").alias("i"), F.col("tile").alias("j"), F.col("members").alias("members2"))
    return left.join(right, ["key", "i", "j"]).select("members", "members2")


def groups(fps: DataFrame, id_col: str, bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(fp, root, component_id) for materialised ``fps`` rows: a group's smallest fingerprint and its smallest id."""
    least = cut_lineage(fps.groupBy("fp").agg(F.min(id_col).alias("low")))
    roots = components(links(least, bits, tile)).select(F.col("node").alias("fp"), "root")
    of = least.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    return of.join(of.groupBy("root").agg(F.min("low").alias("component_id")), "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS, seed: int = SEED, tile: int = TILE) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (the smallest id reachable by links).

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows are returned each; rows with a null id are returned too and
    never name a group (component_id is null when a group has no id at all).
    An empty table gives an empty result.
    """
    fps = cut_lineage(fingerprints(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), ["_id"], "_text", shingle, seed))
    out = fps.join(groups(fps, "_id", bits, tile), "fp")
    return out.select(F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all columns) with one row left of each group: that of the smallest id; of repeated or null ids, the first row."""
    rows = with_row_key(docs)
    fps = cut_lineage(fingerprints(rows.select(*ROW_KEY, F.col(id_col).alias("_id"), F.col(text).alias("_text")), [*ROW_KEY, "_id"], "_text", shingle))
    of = fps.join(groups(fps, "_id", bits), "fp")
    first = of.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("z"), "_id", *ROW_KEY)).alias("x")).select(*[F.col(f"x.{c}").alias(c) for c in ROW_KEY])
    gone = cut_lineage(of.select(*ROW_KEY).join(first, ROW_KEY, "left_anti"))
    return rows.join(broadcast_if_small(gone), ROW_KEY, "left_anti").drop(*ROW_KEY)
