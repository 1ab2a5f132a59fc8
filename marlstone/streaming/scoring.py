"""Scoring of a stream of points with a fitted model: stateless, so each micro-batch is the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marlstone.operators.kmeans import Fit


def score_stream(stream: DataFrame, model: Fit) -> DataFrame:
    """stream (id, features) with prediction and distance; Euclidean models only, for their heads are all they need."""
    if model.kind != "euclidean":
        raise ValueError("a stream has no column means to centre by")
    return model.predict(stream)


def to_parquet(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the scored rows to Parquet files; every row of the source once."""
    return scored.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
