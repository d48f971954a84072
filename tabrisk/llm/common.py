"""Helpers shared by the training-data operators.

Row identity: tables may repeat a doc_id or hold null ids, so operators that
have to come back to "the same row" use ``with_row_key``. It does not depend on
how a scan is split, which may differ from one scan to the next.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources.tables import read_table

__all__ = ["ROW_KEY", "append", "broadcast_if_small", "crc_mod", "cut_lineage", "ensure_checkpoint_dir", "prepare", "read_table", "release", "slices", "table", "with_row_key"]

#: A side of single-long rows up to this many rows (about 16 MB hashed) may be broadcast.
BROADCAST_ROWS = 500_000


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder, and this package for the Python workers, once an application (they may not share the driver's path)."""
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).parents[1]
        with zipfile.ZipFile(Path(tempfile.mkdtemp(prefix="tabrisk-")) / "tabrisk_package.zip", "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(z.filename)
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return read_table(spark, sf_dir, name)


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key's decimal text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % F.lit(n)


ROW_KEY = ["_row_key_file", "_row_key_row"]


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds ``ROW_KEY``: a key of each row that every later scan repeats.

    Frames read straight from Parquet take the file's path (hashed) and the
    row's place in it; any other frame is checkpointed first and its rows are
    numbered, since checkpoint files fix the partitions.
    """
    try:
        return df.select(*[F.col(f"`{c}`") for c in df.columns], F.xxhash64("_metadata.file_path").alias(ROW_KEY[0]), F.col("_metadata.row_index").alias(ROW_KEY[1]))
    except AnalysisException:
        return cut_lineage(df).withColumns({ROW_KEY[0]: F.lit(0).cast("long"), ROW_KEY[1]: F.monotonically_increasing_id()})


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a materialised narrow table after counting it; larger ones are left to a shuffle join."""
    return F.broadcast(df) if df.count() <= limit else df


#: Rows of an Arrow batch that are Python objects at a time.
SLICE = 1_000


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``SLICE`` rows."""
    return (batch.slice(a, SLICE) for a in range(0, batch.num_rows, SLICE))


def release() -> None:
    """Give memory that a task no longer uses back to the system: Python workers live on and take tasks of other kinds."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it has
        pass


def append(df: DataFrame, keep: list[str], source: str, fields: str, make: Callable[[], Callable]) -> DataFrame:
    """Columns computed from ``source`` batch by batch in Arrow, beside the columns in ``keep``.

    ``make()`` runs once a task and returns a function from a list of bytes
    (None for null) to a list of Arrow arrays, one for each of ``fields``.
    Rows are neither moved nor dropped, so ids may repeat or be null.
    """
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(source).cast("binary").alias("_src"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    names = [x.strip().split(" ")[0] for x in fields.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for b in slices(whole):
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *fn(b.column(b.num_columns - 1).to_pylist())], [*b.schema.names[:-1], *names])
        del fn
        release()

    return src.mapInArrow(run, f"{kept}, {fields}")
