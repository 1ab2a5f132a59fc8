"""Exact global ranks without a single-partition window: range sort and prefix counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from marlstone.session import materialise, shuffle_width


def ranks(df: DataFrame, by: list[str], order: list[str], name: str = "rank", few: bool = False) -> DataFrame:
    """df with ``name``: position from 0 in the order, inside each group of ``by`` (or of the whole table).

    The rows are sorted by ranges over all tasks and written; the row numbers
    inside the partitions plus the counts of the partitions before are the
    ranks. What is joined back is a row a partition and group that it holds;
    with ``few`` groups it is sent to all tasks and the rows stay where they are.
    Nulls come first; order must tell all rows apart, else ties fall anyhow.
    """
    key = [*by, *order]
    d = df.repartitionByRange(shuffle_width(df.sparkSession), *key).sortWithinPartitions(*key)
    d = materialise(d.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    held = d.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1) if by else W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    base = held.select(*(F.col(c).alias(f"_k_{c}") for c in by), F.col("_part").alias("_p"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"))
    same = F.col("_part") == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return d.join(F.broadcast(base) if few else base, same).withColumn(name, F.col("_at") + F.col("_base")).select(*df.columns, name)


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct values of a column (as it is named) with their position from 0 in order."""
    return ranks(df.select(column).distinct(), [], [column], name)
