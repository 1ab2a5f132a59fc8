"""Shape, column info, describe, null counts, first rows, distinct labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from marlstone.operators.column_profile import ranked_curves


def shape(df: DataFrame) -> DataFrame:
    """n_rows, n_cols in one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


def _long(row: DataFrame, values: dict[str, list], names: list[str]) -> DataFrame:
    each = [F.struct(F.lit(c).alias("column"), *(v.alias(n) for n, v in zip(names, vs))) for c, vs in values.items()]
    return row.select(F.explode(F.array(*each)).alias("e")).select("e.*")


def column_info(df: DataFrame) -> DataFrame:
    """column, dtype, non_null; one pass."""
    row = df.agg(*(F.count(c).alias(c) for c in df.columns))
    return _long(row, {c: [F.lit(t), F.col(c)] for c, t in df.dtypes}, ["dtype", "non_null"])


def null_counts(df: DataFrame) -> DataFrame:
    """column, nulls; one pass."""
    row = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return _long(row, {c: [F.col(c)] for c in df.columns}, ["nulls"])


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, count, mean, std (sample), min, q25, q50, q75 (linear interpolation, exact), max of numeric columns; NaN counts as null.

    Quartiles come from the ranks of the counted values, so that no task holds
    the distinct values of a column.
    """
    cols = columns or [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    clean = df.select(*(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols))
    cells = clean.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("x")) for c in cols))).alias("e")).select("e.*")
    x = F.col("x")
    plain = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = clean.agg(*(f(F.col(c)).alias(f"{c}|{s}") for c in cols for s, f in plain.items()))
    stats = _long(row, {c: [F.col(f"`{c}|{s}`") for s in plain] for c in cols}, list(plain))
    counts = cells.where("x is not null").groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    curves = ranked_curves(counts.select(F.col("column").alias("field"), F.lit(None).cast("string").alias("grp"), F.lit(0).cast("bigint").alias("load"), x.alias("number"), "n"))
    size = curves.groupBy("field").agg(F.sum("n").alias("size"))
    at = lambda r: F.max(F.when((F.col("below") <= r) & (r < F.col("below") + F.col("n")), F.col("number")))
    h = lambda p: F.lit(p) * (F.col("size") - 1)
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    q = curves.join(size, "field").groupBy(F.col("field").alias("_c"), "size").agg(*(at(f(h(p))).alias(f"{k}_{s}") for k, p in probs.items() for s, f in (("l", F.floor), ("u", F.ceil))))
    mid = {k: F.col(f"{k}_l") + (h(p) - F.floor(h(p))) * (F.col(f"{k}_u") - F.col(f"{k}_l")) for k, p in probs.items()}
    return stats.join(q, F.col("column") == F.col("_c"), "left").select("column", "count", "mean", "std", "min", *(v.alias(k) for k, v in mid.items()), "max")


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First n rows by the given order."""
    return df.orderBy(*order).limit(n)


def at_positions(df: DataFrame, key: str, positions: list[int]) -> DataFrame:
    return df.where(F.col(key).isin(positions))


def label_count(df: DataFrame, label: str) -> DataFrame:
    """n_labels: distinct non-null labels; the guard of every score."""
    return df.agg(F.count_distinct(label).alias("n_labels"))


def class_names(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).where(F.col(label).isNotNull()).distinct()
