"""The corpus pipeline: raw documents to deduplicated, clean, pseudonymous and encoded ones.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabrisk.llm import bpe, decontam, langid, pii, simhash
from tabrisk.llm.common import ensure_checkpoint_dir, prepare, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with no language that holds half of their words, go."""
    prepare(spark)
    return langid.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest doc_id."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data get pseudonyms of their own format; n_chars keeps the text's length, which they keep too, but for short numbers in IP addresses and the like."""
    return pii.replace(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids themselves."""
    prepare(spark)
    return bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("pii_pseudonyms", pseudonymise),
    ("byte_bpe", encode),
]

#: Model fitting, SimHash groups and BPE have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is kept in the shared checkpoint folder."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
