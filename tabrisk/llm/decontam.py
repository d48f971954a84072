"""Benchmark decontamination by spaced-seed hashing.

Fixed masks keep five of up to nine neighbouring words and ignore the others,
so a copied passage is found although some of its words were replaced. Hashes
of the test items are joined with those of the training texts; each joined pair
names a diagonal (position in the text less position in the item), along which
the words are compared: a window of ``WINDOW`` words (or the whole item if it
is shorter) with at least 0.8 equal words confirms the overlap.

Masks go by the length of an item (``masks_of``): with those of its length every
way of replacing the words that the similarity allows leaves one mask whole.
Items of fewer than five words have one mask, all of their words.

Training hashes first pass a bit table of fixed size (half a megabyte whatever
the inputs) with two slots for each test hash; it can let hashes through that no
item has, never hold one back, so the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut_lineage, release

#: Word positions that a mask compares, from its first (five words each).
MASKS = ((0, 1, 2, 3, 4), (0, 1, 3, 4, 6), (0, 2, 3, 5, 6), (0, 1, 4, 6, 8))
WINDOW = 13
SIMILARITY = 0.8
FILTER_BITS = 22
#: Rows of the items' hash table (about 60 bytes each) up to which every task gets it; beyond, both sides are shuffled and hot hashes dealt over ``SALTS`` keys.
BROADCAST_SEEDS = 300_000
SALTS = 16
CACHE_WORDS = 250_000
#: ASCII characters other than letters and digits part words (bytes of longer characters never do).
_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@cache
def masks_of(words: int, similarity: float = SIMILARITY) -> tuple[tuple[int, ...], ...]:
    """The masks for items of that many words: however the words that may differ in a window lie, one mask misses them all at some place.

    ``MASKS`` that fit, and where they leave a pattern uncovered the masks of as
    many words (five if that many must be equal) that cover most of the rest, first
    ones first. Longer items than a window need no more than a window does.
    """
    n = min(words, WINDOW)
    differ = next(k for k in range(n, -1, -1) if (n - k) / n >= similarity - 1e-9) if n else 0
    size = min(len(MASKS[0]), n - differ)
    if size <= 0:
        return ()
    missed = lambda m, left: {p for p in left if all(any(q + x in p for x in m) for q in range(n - m[-1]))}
    left = {frozenset(p) for p in combinations(range(n), differ)}
    chosen = [m for m in MASKS if m[-1] < n] if size == len(MASKS[0]) else []
    for m in chosen:
        left = missed(m, left)
    others = [(0, *rest) for rest in combinations(range(1, n), size - 1)]
    while left:
        chosen.append(min(others, key=lambda m: (len(missed(m, left)), m)))
        left = missed(chosen[-1], left)
    return tuple(chosen)


def _name(mask: tuple[int, ...]) -> int:
    """A number for a mask: the bits of its places."""
    return sum(1 << x for x in mask)


def _word_hasher():
    cache: dict[bytes, int] = {}

    def words(text: str | None) -> np.ndarray:
        """64-bit hashes of the words of a text: lower case, ASCII punctuation dropped."""
        nonlocal cache
        parts = (text or "").lower().encode("utf-8", "replace").translate(_SPACES).split()
        try:
            return np.fromiter(map(cache.__getitem__, parts), np.uint64, len(parts))
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache = {}
            for w in parts:
                if w not in cache:
                    cache[w] = xxhash.xxh64_intdigest(w)
            return np.fromiter(map(cache.__getitem__, parts), np.uint64, len(parts))

    return words


def seeds(tokens: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The hash at each position where the mask fits."""
    n = len(tokens) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k, at in enumerate(mask):
        h = (h ^ tokens[at : at + n]) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        h ^= h >> np.uint64(29)
    return h


def _may_hold(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Positions of the hashes whose two slots (top bits, and those below them) are both set."""
    top = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    p = np.flatnonzero((table[top >> 3] >> (top & 7).astype(np.uint8)) & 1)
    low = ((h[p] >> np.uint64(64 - 2 * FILTER_BITS)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
    return p[((table[low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(bool)]


def _item_seeds(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_hasher()
        for b in batches:
            for uid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = words(text)
                for mask in masks_of(len(t), similarity):
                    h = seeds(t, mask)
                    yield pa.RecordBatch.from_arrays([pa.array([uid] * len(h), b.schema.field(0).type), pa.array([_name(mask)] * len(h), pa.int32()), pa.array(np.arange(len(h), dtype=np.int32)), pa.array(h.view(np.int64))], ["item", "mask", "q", "h"])

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _word_hasher()
    for b in batches:
        t = [words(x).tobytes() for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(t, pa.binary())], ["item", "item_words"])


_REGION = "start int, words binary, hits array<struct<mask:int,p:int,h:bigint>>"


def _regions(shared, masks: list[tuple[int, ...]]):
    """Texts to the regions around filter hits: one row a region, with its words and its hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table, reach = _word_hasher(), np.frombuffer(shared.value, np.uint8), max((m[-1] for m in masks), default=0)
        kind = pa.list_(pa.struct([("mask", pa.int32()), ("p", pa.int32()), ("h", pa.int64())]))
        for b in batches:
            out: list[tuple] = []
            for uid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = words(text)
                found = []
                for mask in masks:
                    h = seeds(t, mask)
                    p = _may_hold(table, h)
                    if len(p):
                        found.append((np.full(len(p), _name(mask)), p, h[p]))
                if not found:
                    continue
                m, p, h = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(p, kind="stable")
                m, p, h = m[order], p[order], h[order]
                for part in np.split(np.arange(len(p)), np.flatnonzero(np.diff(p) > 2 * WINDOW) + 1):
                    start = max(0, int(p[part[0]]) - WINDOW)
                    end = int(p[part[-1]]) + reach + 1 + WINDOW
                    hits = [{"mask": int(m[i]), "p": int(p[i]), "h": int(h[i : i + 1].view(np.int64)[0])} for i in part]
                    out.append((uid, start, t[start:end].tobytes(), hits))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], kind)], ["uid", "start", "words", "hits"])
        del words
        release()

    return run


def equal_share(text: np.ndarray, item: np.ndarray, shift: int, window: int = WINDOW) -> tuple[float, int]:
    """The largest share of equal words in a window along a diagonal, and all equal words on it.

    ``shift`` is the position in ``text`` of the item's first word (may be negative).
    """
    w = min(window, len(item))
    lo, hi = max(0, -shift), min(len(item), len(text) - shift)
    same = np.zeros(len(item), np.int64)
    if hi > lo:
        same[lo:hi] = item[lo:hi] == text[lo + shift : hi + shift]
    run = np.cumsum(np.concatenate(([0], same)))
    return float((run[w:] - run[:-w]).max()) / w, int(same.sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        got = [equal_share(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), d - s) for x, y, d, s in zip(cols["words"], cols["item_words"], cols["diag"], cols["start"])]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64())], ["uid", "item", "share", "equal"])


def overlaps(texts: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Confirmed overlaps (uid, item, share, equal) of ``texts`` (uid, text) with ``items`` (item, text).

    An item of fewer than five words matches texts that hold all of it, word for
    word; null and empty items and items without a word match nothing, nor do null
    or empty texts. Ids may be of any type, repeat or be null (items with a null id
    match nothing).
    """
    uid, item = texts.select("uid").schema[0].dataType.simpleString(), items.select("item").schema[0].dataType.simpleString()
    items = items.select("item", "text").where("item is not null")
    tests = cut_lineage(items.mapInArrow(_item_seeds(similarity), f"item {item}, mask int, q int, h bigint"))
    names = {r["mask"] for r in tests.select("mask").distinct().collect()}  # a few masks for each length up to WINDOW
    masks = [tuple(i for i in range(WINDOW) if name >> i & 1) for name in sorted(names)]
    both = F.array(F.shiftrightunsigned("h", 64 - FILTER_BITS), F.shiftrightunsigned("h", 64 - 2 * FILTER_BITS).bitwiseAND((1 << FILTER_BITS) - 1))
    slots = tests.select(F.explode(both.cast("array<int>")).alias("s")).distinct()
    packed = slots.groupBy(F.shiftright("s", 3).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, s % 8)")).alias("v"))
    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)  # at most so many rows come back, whatever the inputs
    rows = packed.toPandas()
    table[rows["byte"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64)
    shared = texts.sparkSession.sparkContext.broadcast(table.tobytes())
    found = texts.select("uid", "text").mapInArrow(_regions(shared, masks), f"uid {uid}, {_REGION}")
    regions = cut_lineage(found).withColumn("rid", F.monotonically_increasing_id())  # checkpoint files fix the partitions
    hits = regions.select("rid", F.explode("hits").alias("x")).select("rid", "x.*")
    # a hash that many texts hold is no key of a shuffle while the items' hashes can be sent out; beyond, it is dealt over salted keys
    few = tests.count() <= BROADCAST_SEEDS
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("rid", "p"), F.lit(1 if few else SALTS)))
    spread = tests.withColumn("salt", F.explode(F.expr(f"sequence(0L, {0 if few else SALTS - 1}L)")))
    pairs = salted.join(F.broadcast(spread) if few else spread, ["mask", "h", "salt"]).select("rid", "item", (F.col("p") - F.col("q")).alias("diag")).distinct()
    words = items.mapInArrow(_item_words, f"item {item}, item_words binary")
    full = pairs.join(regions.select("uid", "rid", "start", "words"), "rid").join(words, "item")
    checked = full.select("uid", "item", "words", "item_words", "diag", "start").mapInArrow(_verify, f"uid {uid}, item {item}, share double, equal bigint")
    return checked.where(F.col("share") >= similarity - 1e-9)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per document id with an overlap: id, n_items, item_ids (sorted), best_share, equal_words (on its best diagonal).

    Repeated rows of a document, and rows with a null id, give one row
    together. Extra columns play no part; empty tables give an empty result.
    """
    texts = docs.select(F.col(id_col).alias("uid"), F.col(text).alias("text"))
    found = overlaps(texts, items.select(F.col(item_id).alias("item"), F.col(text).alias("text")))
    pairs = found.groupBy("uid", "item").agg(F.max("share").alias("share"), F.max("equal").alias("equal"))
    out = pairs.groupBy("uid").agg(F.count("item").alias("n_items"), F.array_sort(F.collect_set("item")).alias("item_ids"), F.max("share").alias("best_share"), F.max("equal").alias("equal_words"))
    return out.withColumnRenamed("uid", id_col)


def drop_contaminated(docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) without a confirmed overlap.

    The verdict depends on the text alone, so rows are named by its MD5.
    """
    named = docs.select(F.md5(F.col(text)).alias("uid"), F.col(text).alias("text"))
    found = overlaps(named, items.select(F.col(item_id).alias("item"), F.col(text).alias("text")))
    gone = cut_lineage(found.select("uid").distinct())
    return docs.join(broadcast_if_small(gone.withColumnRenamed("uid", "_md5"), 200_000), F.md5(docs[text]) == F.col("_md5"), "left_anti")
