"""Synthetic point sets as plans over spark.range; seeded, not bit-equal to other libraries' generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def circle(spark: SparkSession, n: int = 20) -> DataFrame:
    """id, x, y: n points at equal angles, end point excluded."""
    a = F.lit(2.0) * F.pi() * F.col("id") / F.lit(n)
    return spark.range(n).select("id", F.cos(a).alias("x"), F.sin(a).alias("y"))


def blobs(spark: SparkSession, sizes: list[int], centres: list[tuple[float, ...]], stds: float | list[float] = 1.0, seed: int = 42) -> DataFrame:
    """id, x1 .. xd, label: Gaussian clouds, one a centre, in order of the centres."""
    stds = [stds] * len(sizes) if isinstance(stds, (int, float)) else list(stds)
    if not len(sizes) == len(centres) == len(stds):
        raise ValueError("sizes, centres and stds differ in length")
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    label = F.lit(len(sizes) - 1)
    for i in range(len(sizes) - 1, -1, -1):
        label = F.when(F.col("id") < ends[i], F.lit(i)).otherwise(label)
    pick = lambda values: F.element_at(F.array(*(F.lit(float(v)) for v in values)), F.col("label") + 1)
    dims = len(centres[0])
    return spark.range(ends[-1]).withColumn("label", label).select("id", *((pick([c[k] for c in centres]) + pick(stds) * F.randn(seed + k)).alias(f"x{k + 1}") for k in range(dims)), "label")


def moons(spark: SparkSession, n: int = 1000, noise: float = 0.1, seed: int = 42) -> DataFrame:
    """id, x, y, label: two interleaving half circles with noise."""
    upper = (n + 1) // 2
    t = F.when(F.col("id") < upper, F.col("id") / F.lit(max(1, upper - 1))).otherwise((F.col("id") - upper) / F.lit(max(1, n - upper - 1))) * F.pi()
    up = F.col("id") < upper
    x = F.when(up, F.cos(t)).otherwise(1 - F.cos(t)) + noise * F.randn(seed)
    y = F.when(up, F.sin(t)).otherwise(0.5 - F.sin(t)) + noise * F.randn(seed + 1)
    return spark.range(n).select("id", x.alias("x"), y.alias("y"), F.when(up, 0).otherwise(1).alias("label"))
