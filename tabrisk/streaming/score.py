"""Scoring a stream with a fitted preparation and model (T14 on Structured Streaming).

The reference has no streaming operator; raw-row prediction is stateless, so
the same transform runs on a streaming DataFrame: fitted parameters are
literals, category codes are a static table (stream-static join), and the
model is a column expression or an MLlib transformer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.models import Fitted
from ..plans.prepare import TreePrep, transform_tree


def score_stream(stream: DataFrame, prep: TreePrep, model: Fitted, keep: list[str] | None = None) -> DataFrame:
    """Append-mode predictions for every incoming raw row."""
    prepared = transform_tree(stream, prep, keep=keep or [])
    return model.predict(prepared)


def run_available(spark: SparkSession, scored: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Process everything available now into Parquet (exactly-once file sink), then
    return the written rows as a batch DataFrame."""
    q = (scored.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
