"""Importance resampling of documents towards a target's distribution of hashed word runs.

Features of a text are its runs of one and two words; a feature's bucket is the
CRC-32 of its bytes modulo ``BUCKETS``. Buckets are counted over all documents
and over the target's texts; a bucket's gain is the log ratio of the two smoothed
shares, a document's weight the mean gain of its features. Gumbel noise keyed by
the document's id is added and the highest scores are drawn, which is drawing
without replacement in proportion to the exponential of the weights.

CRCs are computed in matrices: the distinct features of a block of text are
grouped by length, each group is a two-dimensional array of bytes, and one table
look-up a column moves all its CRCs on by a byte. Features longer than ``LONG``
bytes are cut into rows of that length (the rest first), whose CRCs are folded together by the
operator that appends ``LONG`` zero bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import positions
from .common import cut_lineage

BUCKETS = 10_000
SEED = 7
#: Percentage of the eligible documents that are drawn, and the words that make a document eligible.
RATE = 25
MIN_WORDS = 20
#: Reversed polynomial of the CRC-32 of zlib and Ethernet (fixed value).
POLYNOMIAL = 0xEDB88320
#: Bytes of text that are taken apart at a time, and bytes of a CRC matrix; they bound the memory of very long texts.
BLOCK = 1 << 22
MATRIX = 1 << 23
LONG = 1_024
CACHE_WORDS = 300_000

#: Letters to lower case, ASCII characters other than letters and digits to blanks (bytes of longer characters never are).
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1)
    return t


_TABLE = _table()


def _columns(rows: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of each row, column by column."""
    for col in np.ascontiguousarray(rows.T):
        crc = _TABLE[(crc ^ col) & 0xFF] ^ (crc >> np.uint32(8))
    return crc


def _zeros(n: int) -> np.ndarray:
    """What ``n`` zero bytes make of each byte of a register: four tables of 256, whose values for the bytes are added (xor)."""
    start = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    return _columns(np.zeros((1024, n), np.uint8), start).reshape(4, 256)


def _append(crc: np.uint32, tables: np.ndarray) -> np.uint32:
    return tables[0, crc & 0xFF] ^ tables[1, (crc >> 8) & 0xFF] ^ tables[2, (crc >> 16) & 0xFF] ^ tables[3, crc >> 24]


def crc32s(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """zlib's CRC-32 of each slice of ``buffer``: slices of one length are one matrix."""
    out = np.zeros(len(starts), np.uint32)
    length = ends - starts
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        n = int(length[group[0]])
        if n > LONG:
            for i in group:
                out[i] = _long_crc(buffer[starts[i] : ends[i]])
            continue
        rows = np.lib.stride_tricks.sliding_window_view(buffer, n) if n else None
        step = max(1, MATRIX // max(n, 1))
        for k in range(0, len(group), step):
            part = group[k : k + step]
            ones = np.full(len(part), 0xFFFFFFFF, np.uint32)
            out[part] = ~(_columns(rows[starts[part]], ones) if n else ones)
    return out


def _long_crc(data: np.ndarray) -> int:
    tables, head = _zeros(LONG), len(data) % LONG
    crc = _columns(data[None, :head], np.full(1, 0xFFFFFFFF, np.uint32))[0]
    rows = data[head:].reshape(-1, LONG)
    for a in range(0, len(rows), MATRIX // LONG):
        for own in _columns(rows[a : a + MATRIX // LONG], np.zeros(min(len(rows) - a, MATRIX // LONG), np.uint32)):
            crc = _append(crc, tables) ^ own
    return ~np.uint32(crc)


class _Numbers(dict):
    """Numbers for words, in the order in which they first come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Hasher:
    """Buckets of the features of texts; words keep their numbers and buckets over the blocks of a task."""

    def __init__(self, buckets: int):
        self.buckets, self.number = buckets, _Numbers()
        self.word_buckets = np.zeros(0, np.int64)

    def features(self, docs: list[int], words: list[list[bytes]], counted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(document, bucket) of every feature; the first ``counted`` words of a list were counted in the block before."""
        if len(self.number) > CACHE_WORDS:
            self.number, self.word_buckets = _Numbers(), np.zeros(0, np.int64)
        flat = [w for ws in words for w in ws]
        sizes = np.array([len(ws) for ws in words])
        known = len(self.number)
        ids = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        buffer = np.frombuffer(b" ".join(flat), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        if len(self.number) > known:
            at = np.flatnonzero(ids >= known)
            at = at[np.unique(ids[at], return_index=True)[1]]
            self.word_buckets = np.concatenate([self.word_buckets, (crc32s(buffer, starts[at], ends[at]) % self.buckets).astype(np.int64)])
        doc = np.repeat(np.array(docs), sizes)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place = np.arange(len(flat)) - np.repeat(first, sizes)
        single = np.flatnonzero(place >= np.repeat(np.array(counted), sizes))
        pair = np.flatnonzero(place > 0) - 1
        distinct, at, back = np.unique((ids[pair] << 32) | ids[pair + 1], return_index=True, return_inverse=True)
        pairs = (crc32s(buffer, starts[pair[at]], ends[pair[at] + 1]) % self.buckets).astype(np.int64) if len(distinct) else np.zeros(0, np.int64)
        return np.concatenate([doc[single], doc[pair]]), np.concatenate([self.word_buckets[ids[single]], pairs[back]])


def _blocks(texts: Iterator[bytes]) -> Iterator[tuple[list[int], list[list[bytes]], list[int]]]:
    """Words of texts in blocks of about ``BLOCK`` bytes; a longer text continues in the next block with its last word again."""
    docs, words, counted, size = [], [], [], 0
    for k, text in enumerate(texts):
        at, last = 0, []
        while at < len(text):
            stop = len(text)
            if stop - at > BLOCK - size:
                cut = text.find(b" ", at + max(BLOCK - size, 1))
                stop = len(text) if cut < 0 else cut
            ws = last + text[at:stop].split()
            if len(ws) > len(last):
                docs.append(k)
                words.append(ws)
                counted.append(len(last))
                size += stop - at
                last = ws[-1:]
            at = stop
            if size >= BLOCK:
                yield docs, words, counted
                docs, words, counted, size = [], [], [], 0
    if docs:
        yield docs, words, counted


def _plain(texts: list) -> list[bytes]:
    return [(t or b"").translate(_WORDS) for t in texts]


def _counter(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = _Hasher(buckets), np.zeros(buckets, np.int64)
        for b in batches:
            for block in _blocks(_plain(b.column(0).to_pylist())):
                total += np.bincount(hasher.features(*block)[1], minlength=buckets)
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on.astype(np.int32)), pa.array(total[on])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows: at most ``buckets`` rows a task are added up, and as many come back."""
    rows = texts.select(F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(_counter(buckets), "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    got = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the target's share to the source's, with one more feature in each bucket."""
    n = len(source)
    return np.floor(1000 * np.log((target + 1.0) * (source.sum() + float(n)) / ((source + 1.0) * (target.sum() + float(n))))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_words, n_features and weight (the floored mean gain; 0 without features) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, hasher = shared.value, _Hasher(len(shared.value))
        for b in batches:
            n_words, n, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for block in _blocks(_plain(b.column(1).to_pylist())):
                doc, bucket = hasher.features(*block)
                np.add.at(n_words, block[0], [len(w) - c for w, c in zip(block[1], block[2])])
                n += np.bincount(doc, minlength=b.num_rows)
                np.add.at(total, doc, gain[bucket])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words), pa.array(n), pa.array(weight)], ["id", "n_words", "n_features", "weight"])

    return src.mapInArrow(run, f"id {src.schema[0].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def noise(key, seed: int = SEED):
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of seed and id (a null id: nothing after the colon)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS, rate: int = RATE, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank (1, 2, 3... of the drawn ones, null for the others).

    Null and empty texts have no features and weight 0. Rows with the same id
    have the same noise; each is ranked by itself, after equal ones in any order.
    A null id comes last among equal scores. Empty documents give an empty
    result; without target texts all of the target's shares are equal. Other
    columns play no part.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    w = weights(docs, gain, id_col, text)
    scored = cut_lineage(w.withColumn("score", (F.col("weight") + noise(F.col("id"), seed)).cast("long")))
    eligible = scored.where(F.col("n_words") >= min_words)
    draw = rate * eligible.count() // 100
    ranked = positions(eligible, [F.desc("score"), F.asc_nulls_last("id"), "n_features"], [], "pos")
    out = ranked.withColumn("rank", F.when(F.col("pos") < draw, F.col("pos") + 1)).drop("pos")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return out.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
