"""Fill-in-middle transformation with a piece table.

A document is a list of descriptors (buffer, start, end) over buffers that never
change: its UTF-8 bytes and the sentinels'. Cutting splits the text's descriptor
in three at unit ends drawn from a keyed hash of the document's id; a form
(``psm`` or ``spm``) is an arrangement of the pieces among sentinels. Nothing is
copied until the output is written, and hashes are fed piece by piece.

Restoring makes the output the buffer, cuts it at its sentinels, drops them and
applies the inverse arrangement. Texts that hold a sentinel, and empty ones, stay
plain, so that an output has each sentinel once or none of them.

A row depends on its own text and id alone: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sentinels before the prefix, the suffix and the middle (fixed values).
SENTINELS = (b"<P>", b"<S>", b"<M>")
#: Order of the parts (0 prefix, 1 suffix, 2 middle) in each form, each after its sentinel.
FORMS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
SEED = 7
#: Percentages of documents that are rearranged, and of those, that take the form spm.
RATE = 100
SPM_RATE = 50
#: Order of the parts in a text.
_TEXT_ORDER = (0, 2, 1)


class Pieces:
    """Descriptors (buffer, start, end) over immutable buffers."""

    def __init__(self, buffers: list[bytes], spans: list[tuple[int, int, int]]):
        self.buffers, self.spans = [memoryview(b) for b in buffers], spans

    def split(self, piece: int, *at: int) -> None:
        """Cuts a descriptor at offsets of its buffer, in order."""
        b, start, end = self.spans[piece]
        edges = [start, *at, end]
        self.spans[piece : piece + 1] = [(b, x, y) for x, y in zip(edges, edges[1:])]

    def arranged(self, order: list[int]) -> Pieces:
        out = Pieces([], [self.spans[i] for i in order])
        out.buffers = self.buffers
        return out

    def slices(self) -> Iterator[memoryview]:
        return (self.buffers[b][x:y] for b, x, y in self.spans)

    def sha256(self) -> str:
        h = hashlib.sha256()
        for s in self.slices():
            h.update(s)
        return h.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.slices())


def _chars(b) -> int:
    """Code points of UTF-8 bytes: all bytes but those that continue one."""
    a = np.frombuffer(b, np.uint8)
    return int(len(a) - ((a & 0xC0) == 0x80).sum())


def unit_ends(text: bytes, unit: str = "line") -> np.ndarray:
    """Offsets where the units end: after each newline and at the end of the text, or after each code point."""
    a = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(a == 10) + 1 if unit == "line" else np.flatnonzero((a & 0xC0) != 0x80)[1:]
    return ends if len(ends) and ends[-1] == len(a) or not len(a) else np.append(ends, len(a))


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits from the SHA-256 of seed and id (a null id: nothing after the colon)."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i : i + 8], 16) for i in range(0, 32, 8)]


def arrange(text: bytes, doc_id, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, unit: str = "line") -> tuple[Pieces, str, int, int | None, int | None]:
    """The document's pieces in output order, form, number of units, code points of prefix and of middle (None if plain)."""
    ends = unit_ends(text, unit)
    n, (h1, h2, h3, h4) = len(ends), draws(doc_id, seed)
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= rate:
        return Pieces([text], [(0, 0, len(text))]), "plain", n, None, None
    offset = lambda k: int(ends[k - 1]) if k else 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p = Pieces([text, *SENTINELS], [(0, 0, len(text)), *((i + 1, 0, len(s)) for i, s in enumerate(SENTINELS))])
    p.split(0, offset(a), offset(b))
    prefix, middle, _ = list(p.slices())[:3]
    form = "spm" if h4 % 100 < spm_rate else "psm"
    place = {part: i for i, part in enumerate(_TEXT_ORDER)}
    order = [x for part in FORMS[form] for x in (3 + part, place[part])]
    return p.arranged(order), form, n, _chars(prefix), _chars(middle)


def rebuilt(output: bytes, form: str | None) -> Pieces:
    """The text's pieces from an output and its form."""
    p = Pieces([output], [(0, 0, len(output))])
    if form not in FORMS:
        return p
    at = [(output.index(SENTINELS[part]), len(SENTINELS[part])) for part in FORMS[form]]
    p.split(0, *(x for start, size in at for x in (start, start + size)))
    # pieces: nothing, sentinel, part, sentinel, part, sentinel, part
    return p.arranged([2 + 2 * FORMS[form].index(part) for part in _TEXT_ORDER])


def _with(df: DataFrame, inputs: list, fields: str, row, replaced: str | None = None) -> DataFrame:
    """``df`` with columns computed row by row in Arrow batches from ``inputs``; the column ``replaced`` goes."""
    kept = [c for c in df.columns if c != replaced]
    free = max(map(len, df.columns)) * "_"  # longer than any column's name
    names = [f"{free}_{i}" for i in range(len(inputs))]
    src = df.select(*[F.col(f"`{c}`") for c in kept], *[x.alias(n) for x, n in zip(inputs, names)])
    made = [x.split() for x in fields.split(",")]
    clash = {name for name, _ in made} & set(kept)
    if clash:
        raise ValueError(f"columns that the result needs are there already: {sorted(clash)}")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[: len(kept)])
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    n_in, n_kept, arrow = len(inputs), len(kept), [pa.field(name, types[kind]) for name, kind in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [row(*x) for x in zip(*(b.column(n_kept + i).to_pylist() for i in range(n_in)))]
            cols = [pa.array([g[i] for g in got], f.type) for i, f in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([*b.columns[:n_kept], *cols], [*b.schema.names[:n_kept], *(f.name for f in arrow)])

    return src.mapInArrow(run, ", ".join(x for x in (schema, fields) if x))


def transform(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, unit: str = "line") -> DataFrame:
    """``docs`` with ``text`` replaced by: n (units), form, prefix_chars, middle_chars, output, output_sha256.

    Null and empty texts are plain, with an empty output. Units are lines (a
    newline ends one and belongs to it) or, with ``unit="char"``, code points.
    Rows that repeat an id draw the same numbers, and so do rows without one
    (drawn as from an empty id). Other columns stay; one with the name of a new
    column is refused. An empty table stays empty.
    """

    def row(doc_id, body):
        p, form, n, prefix, middle = arrange(body or b"", doc_id, seed, rate, spm_rate, unit)
        return n, form, prefix, middle, p.bytes(), p.sha256()

    out = _with(docs, [F.col(f"`{id_col}`"), F.col(f"`{text}`").cast("binary")], "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary, output_sha256 string", row, text)
    return out.withColumn("output", F.col("output").cast("string"))


def restore(arranged: DataFrame, output: str = "output", form: str = "form", with_text: bool = True) -> DataFrame:
    """``arranged`` with ``output`` replaced by restored (the text, unless not asked for) and restored_sha256. A null output counts as empty, a null form as plain."""

    def row(out, kind):
        p = rebuilt(out or b"", kind)
        return (*((p.bytes(),) if with_text else ()), p.sha256())

    out = _with(arranged, [F.col(f"`{output}`").cast("binary"), F.col(f"`{form}`")], ("restored binary, " if with_text else "") + "restored_sha256 string", row, output)
    return out.withColumn("restored", F.col("restored").cast("string")) if with_text else out
