"""Byte-level BPE encoding and decoding by overlapping chunks.

Long texts are cut into chunks that overlap. Chunks are pre-tokenised in
parallel, each from its own first character, so a chunk's first boundaries may
be wrong; from the first boundary that it shares with its predecessor on, both
agree. The text is stitched there: each piece runs from one such boundary to
the next and is encoded on its own, and ids are put together in order. Where
two chunks share no boundary in their overlap (a run without any), their
pieces are joined and encoded as one, so the result never depends on the cuts.
Texts of one chunk have nothing to stitch and are not moved.

Only boundaries between a character that is not white space and white space are
used for stitching: there no look-ahead of the pattern reaches across, and a
piece alone splits as it does within its text.

Pre-tokens are BPE-merged by tiktoken (one call a distinct pre-token, cached up
to ``CACHE_TOKENS``). The pattern's ``\\p{L}``, ``\\p{N}``, ``\\s`` and ``\\S``
are spelled out as the ranges that tiktoken itself recognises, so both split
alike whatever Unicode version Python has. Decoding looks up each id's bytes
and joins them.
"""

from __future__ import annotations

import base64
import copy
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW_KEY, append, with_row_key

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK = 32_768
OVERLAP = 1_024
CACHE_TOKENS = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its id a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _class_ranges(cls: str) -> list[tuple[int, int]]:
    """The code points that tiktoken's pattern engine counts to a class, as ranges."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    enc = tiktoken.Encoding("class", pat_str=cls, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    got = np.array([ord(c) for c in enc.decode_bytes(enc.encode_ordinary(every)).decode()])
    cut = np.flatnonzero(np.diff(got) != 1)
    return list(zip(got[np.r_[0, cut + 1]].tolist(), got[np.r_[cut, len(got) - 1]].tolist()))


def compile_pattern(pattern: str) -> Callable[[str], re.Pattern]:
    """A function that gives the compiled pattern for a text: classes up to U+FFFF only where the text has no more (much faster)."""
    ranges = {c: _class_ranges(c) for c in (r"\p{L}", r"\p{N}", r"\s") if c in pattern or c == r"\s"}

    def build(top: int) -> re.Pattern:
        spelled = {c: "".join(f"\\U{a:08x}-\\U{min(b, top):08x}" for a, b in r if a <= top) for c, r in ranges.items()}
        out, inside, i = [], False, 0
        while i < len(pattern):
            cls = next((c for c in spelled if pattern.startswith(c, i)), None)
            if cls:
                out.append(spelled[cls] if inside else f"[{spelled[cls]}]")
                i += len(cls)
            elif pattern.startswith(r"\S", i) and not inside:
                out.append(f"[^{spelled[chr(92) + 's']}]")
                i += 2
            else:
                step = 2 if pattern[i] == "\\" else 1
                inside = (inside or pattern[i] == "[") and pattern[i] != "]"
                out.append(pattern[i : i + step])
                i += step
        return re.compile("".join(out))

    low, full, beyond = build(0xFFFF), build(0x10FFFF), re.compile("[\U00010000-\U0010ffff]")
    return lambda text: full if not text.isascii() and beyond.search(text) else low


class Codec:
    """Encodes and decodes with one vocabulary; made once a process from the file's path."""

    _made: dict[tuple, Codec] = {}

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.single = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.pattern = compile_pattern(pattern)
        self.cache: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        """The process's codec of that file (Python workers are used again by later tasks), with a cache of its own that goes with the task."""
        if (path, pattern) not in cls._made:
            cls._made = {(path, pattern): cls(path, pattern)}
        codec = copy.copy(cls._made[path, pattern])
        codec.cache = {}
        return codec

    def split(self, text: str) -> list[str]:
        return self.pattern(text).findall(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.split(text)
        try:
            return b"".join(map(self.cache.__getitem__, parts))
        except KeyError:
            pass
        if len(self.cache) > CACHE_TOKENS:
            self.cache.clear()
        cache, single, out = self.cache, self.single, []
        for p in parts:
            ids = cache.get(p)
            if ids is None:
                ids = array("I", single(p.encode())).tobytes()
                if len(p) <= 64:
                    cache[p] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def stitch_points(text: str, pattern: re.Pattern, lo: int, hi: int) -> list[int]:
    """Boundaries of a chunk's pre-tokens in [lo, hi) at which a text may be cut (see above); the chunk's two ends don't count."""
    return [e for m in pattern.finditer(text) if lo <= (e := m.end()) < hi and e < len(text) and not text[e - 1].isspace() and text[e].isspace()]


def _digests(path: str, pattern: str, with_ids: bool):
    codec = Codec.of(path, pattern)

    def batch(texts: list) -> list[pa.Array]:
        n, ids_hash, back_hash, all_ids = [], [], [], []
        for t in texts:
            ids = codec.encode((t or b"").decode("utf-8", "replace"))
            n.append(len(ids) // 4)
            ids_hash.append(hashlib.sha256(ids).hexdigest())
            back_hash.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            if with_ids:
                all_ids.append(ids)
        return [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(back_hash, pa.string()), *([pa.array(all_ids, pa.binary())] if with_ids else [])]

    return batch


def _points(path: str, pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)
        for b in batches:
            head, tail = [], []
            for k, t in zip(b.column("k").to_pylist(), b.column("part").to_pylist()):
                at = k * chunk
                points = stitch_points(t, codec.pattern(t), 0, chunk + overlap)
                head.append([at + p for p in points if p < overlap])
                tail.append([at + p for p in points if p >= chunk])
            names = [n for n in b.schema.names if n != "part"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), b.column("part"), pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64()))], [*names, "part", "head", "tail"])

    return run


def _encode_pieces(path: str, pattern: str):
    codec = Codec.of(path, pattern)

    def batch(texts: list) -> list[pa.Array]:
        ids = [codec.encode(t.decode("utf-8", "replace")) for t in texts]
        return [pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary())]

    return batch


def pieces(long: DataFrame, key: list[str], text: str, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """The stitched pieces (key, piece, text) of texts longer than a chunk, in order of ``piece``."""
    if not 0 < overlap < chunk:
        raise ValueError("the overlap must be shorter than a chunk")
    n = F.ceil(F.length(text) / chunk).cast("int")
    cut = long.select(*key, F.explode(F.sequence(F.lit(0), n - 1)).alias("k"), F.col(text).alias("_t")).select(*key, "k", F.col("_t").substr(F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("part"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    marked = cut.repartition(*[F.col(c) for c in [*key, "k"]]).mapInArrow(_points(path, pattern, chunk, overlap), f"{types}, head array<bigint>, tail array<bigint>")
    w = Window.partitionBy(*key).orderBy("k")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(w)))
    seams = marked.withColumn("from", F.when(F.col("k") == 0, F.lit(0)).otherwise(shared))
    seams = seams.withColumn("to", F.lead("from").over(w)).withColumn("last", F.lead("k").over(w).isNull())
    seams = seams.withColumn("piece", F.max(F.when(F.col("from").isNotNull(), F.col("k"))).over(w))
    start = F.coalesce("from", F.col("k") * chunk) - F.col("k") * chunk
    end = F.when(F.col("last"), F.length("part")).otherwise(F.coalesce("to", (F.col("k") + 1) * chunk) - F.col("k") * chunk)
    own = seams.select(*key, "piece", "k", F.col("part").substr((start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")).alias("s"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "s"))), lambda x: x["s"]), "")
    return own.groupBy(*key, "piece").agg(joined.alias("text"))


def _together(name: str):
    """Binary values of sorted structs joined in order."""
    return F.unhex(F.array_join(F.transform(F.col("p"), lambda x: F.hex(x[name])), ""))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", with_ids: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row a document: id, n_tokens, ids_sha256, decoded_sha256; ``with_ids`` adds ``ids`` (little-endian 32-bit integers).

    Null texts count as empty (no tokens). Repeated rows and null ids are kept
    as they are; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    is_long = F.coalesce(F.length("_text") > chunk, F.lit(False))
    more = ", ids binary" if with_ids else ""
    short = append(rows.where(~is_long), ["_id"], "_text", f"n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}", lambda: _digests(path, pattern, with_ids))
    long = with_row_key(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("_text"))).where(is_long)
    cut = pieces(long, [*ROW_KEY, "_id"], "_text", path, pattern, chunk, overlap)
    done = append(cut, [*ROW_KEY, "_id", "piece"], "text", "ids binary, back binary", lambda: _encode_pieces(path, pattern))
    whole = done.groupBy(*ROW_KEY, "_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids", "back"))).alias("p")).select("_id", _together("ids").alias("ids"), _together("back").alias("back"))
    long_out = whole.select("_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("back", 256).alias("decoded_sha256"), *(["ids"] if with_ids else []))
    return short.unionByName(long_out).withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The text of each row's ids (bytes that are not UTF-8 become replacement marks; null ids give an empty text)."""

    def make():
        codec = Codec.of(path, pattern)
        return lambda values: [pa.array([codec.decode(v or b"").decode("utf-8", "replace") for v in values], pa.string())]

    return append(encoded, [id_col], ids, "text string", make)
