"""Label codes, scaling and centring, as one-pass aggregates joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marlstone.operators.clean import text_code
from marlstone.operators.rank import ranks
from marlstone.session import materialise


def label_dictionaries(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, code: the distinct texts of each column in binary order from 0; a missing value is the text nan. One pass over df."""
    cells = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), text_code(c).alias("value")) for c in columns))).alias("e")).select("e.*").distinct()
    return ranks(cells, ["column"], ["value"], "code")


def label_dictionary(df: DataFrame, column: str) -> DataFrame:
    """value, code of one column."""
    return label_dictionaries(df, [column]).drop("column")


def label_encode(df: DataFrame, columns: list[str], dictionaries: DataFrame | None = None) -> DataFrame:
    """Each column replaced by its code; the dictionaries are made at once and joined, broadcast by Spark where small."""
    known = materialise(label_dictionaries(df, columns) if dictionaries is None else dictionaries)
    for c in columns:
        d = known.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        df = df.join(d, text_code(c) == F.col(f"_v_{c}"))
    return df.withColumns({c: F.col(f"_c_{c}") for c in columns}).drop(*(f"_{k}_{c}" for k in "vc" for c in columns))


def _with(df: DataFrame, fit: DataFrame, aggs: dict) -> DataFrame:
    row = fit.agg(*(a.alias(n) for n, a in aggs.items()))
    return df.join(F.broadcast(row))  # one row


def standard_scale(df: DataFrame, columns: list[str], fit: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation, fitted on ``fit`` (default: df itself); zero deviation gives 0."""
    aggs = {f"_{s}_{c}": f(F.col(c).cast("double")) for c in columns for s, f in (("m", F.avg), ("s", F.stddev_pop))}
    j = _with(df, fit or df, aggs)
    return j.withColumns({c: F.when(F.col(f"_s_{c}") == 0, F.col(c) * 0.0).otherwise((F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0))) for c in columns}).drop(*aggs)


def minmax_scale(df: DataFrame, columns: list[str], fit: DataFrame | None = None) -> DataFrame:
    """To [0, 1]; a constant column gives 0."""
    aggs = {f"_{s}_{c}": f(F.col(c).cast("double")) for c in columns for s, f in (("l", F.min), ("h", F.max))}
    j = _with(df, fit or df, aggs)
    span = lambda c: F.col(f"_h_{c}") - F.col(f"_l_{c}")
    return j.withColumns({c: F.when(span(c) == 0, F.col(c) * 0.0).otherwise((F.col(c) - F.col(f"_l_{c}")) / F.nullif(span(c), F.lit(0.0))) for c in columns}).drop(*aggs)


def centre(df: DataFrame, columns: list[str]) -> DataFrame:
    aggs = {f"_m_{c}": F.avg(F.col(c).cast("double")) for c in columns}
    return _with(df, df, aggs).withColumns({c: F.col(c) - F.col(f"_m_{c}") for c in columns}).drop(*aggs)
