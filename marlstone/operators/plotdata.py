"""Tables behind the plots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def cluster_scatter(labelled: DataFrame, i: int = 0, j: int = 1) -> DataFrame:
    """id, x, y, cluster: the first two features."""
    f = F.col("features")
    return labelled.select("id", f[i].alias("x"), f[j].alias("y"), F.col("prediction").alias("cluster"))


def pair_scatter(labelled: DataFrame, dims: int) -> DataFrame:
    """id, dim_i, dim_j, x, y, cluster for all pairs of features, each with itself too."""
    f = F.col("features")
    pairs = F.array(*(F.struct(F.lit(i).alias("dim_i"), F.lit(j).alias("dim_j"), f[i].alias("x"), f[j].alias("y")) for i in range(dims) for j in range(dims)))
    return labelled.select("id", F.col("prediction").alias("cluster"), F.explode(pairs).alias("e")).select("id", "e.*", "cluster")


def heads_table(spark: SparkSession, heads: list[list[float]]) -> DataFrame:
    """cluster, cx, cy."""
    return spark.createDataFrame([(i, float(h[0]), float(h[1])) for i, h in enumerate(heads)], "cluster bigint, cx double, cy double")


def metric_line(spark: SparkSession, values: dict[int, float], name: str = "distortion") -> DataFrame:
    """k and a metric."""
    return spark.createDataFrame([(int(k), float(v)) for k, v in values.items()], f"k bigint, `{name}` double")
