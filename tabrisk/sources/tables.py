"""Readers for the parquet tables and CSV inputs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Schema of the raw segment file (CSV with header), as the reference reads it.
RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["segment_id", "city_name", "admin_ward", "catchment_id"]]
    + [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in C.NUMERIC_COLS]
    + [T.StructField(c, T.StringType()) for c in C.CATEGORICAL_COLS]
    + [T.StructField(C.LABEL_COL, T.StringType())]
)


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header and an explicit schema (no inference pass).

    NaN literals are normalised to NULL once, at ingestion, so that every later
    aggregate treats missing values the same way.
    """
    df = spark.read.schema(schema or RAW_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
