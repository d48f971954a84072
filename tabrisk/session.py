"""Session helpers: local sessions for tests / bench, and checkpoint placement."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabrisk") -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TABRISK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must come from the session configuration (a shared
    file system). Only a local-mode session without one gets a fresh scratch
    folder, as tests do.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="run-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_kept: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _holds_void(t: T.DataType) -> bool:
    """Whether a type is void or holds one, which Parquet has no place for."""
    if isinstance(t, T.StructType):
        return any(_holds_void(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _holds_void(t.elementType)
    return _holds_void(t.keyType) or _holds_void(t.valueType) if isinstance(t, T.MapType) else isinstance(t, T.NullType)


def keep_rows(df: DataFrame) -> DataFrame:
    """The rows of a table that several passes read, written once as Parquet into the reliable checkpoint folder.

    Unlike a checkpoint's serialised rows they are compressed, and a later pass reads only the columns it needs.
    Neither the order of the rows nor their partitions are kept. :func:`drop_rows` removes them.
    """
    if _holds_void(df.schema) or len({c.lower() for c in df.columns}) < len(df.columns):
        return cut_lineage(df)
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), f"rows-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _kept[out] = path
    return out


def hand_on(kept: DataFrame, df: DataFrame) -> DataFrame:
    """``df``, computed from the rows of ``kept``: whoever drops ``df`` drops those rows."""
    if path := _kept.pop(kept, None):
        _kept[df] = path
    return df


def drop_rows(*dfs: DataFrame | None) -> None:
    """Removes the files of frames that :func:`keep_rows` returned, once nothing reads them any more."""
    for df in dfs:
        if df is not None and (path := _kept.pop(df, None)):
            sc = df.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application (they may not share the driver's path)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).parent
    with zipfile.ZipFile(Path(tempfile.mkdtemp(prefix="tabrisk-")) / "tabrisk_library.zip", "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(z.filename)
    _shipped.add(sc.applicationId)
