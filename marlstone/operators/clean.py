"""Renaming, dropping, filling, range filters and derived columns of trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marlstone.functions.scalars import minutes_between, plain_name, real_number

# Right-closed price bins.
PRICE_BINS = ((10.0, "low"), (20.0, "medium"))
PRICE_TOP = "high"
PRICE_ORDER = ("low", "medium", "high")


def rename_columns(df: DataFrame) -> DataFrame:
    """Lower case, spaces as underscores; raises if two names become one."""
    names = [plain_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"names clash after renaming: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop by name; an unknown name is an error."""
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*names)


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """One row: the commonest value, the smallest of a tie; null for a column without values. Values are counted before they meet."""
    n = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return n.agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(column))


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    """Nulls of a column become its mode (a one-row broadcast)."""
    m = mode_value(df, column).withColumnRenamed(column, "_mode")
    return df.join(F.broadcast(m)).withColumn(column, F.coalesce(column, "_mode")).drop("_mode")


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def drop_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def between_open(c: Column, low: float, high: float) -> Column:
    """Strictly inside; null and NaN are outside."""
    return (c > low) & (c < high)


def price_category(c: Column) -> Column:
    """(0,10] low, (10,20] medium, above high; zero, less and null: null."""
    out = F.lit(PRICE_TOP)
    for top, name in reversed(PRICE_BINS):
        out = F.when(c <= top, name).otherwise(out)
    return F.when(c > 0, F.when(F.isnan(c), None).otherwise(out))


def text_code(column: str) -> Column:
    """A column as string; a missing value becomes the text nan."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def clean_trips(trips: DataFrame) -> DataFrame:
    """The trips' pipeline: rename, drop the empty columns, fill, drop null payments, derive, filter, label. Narrow apart from the mode."""
    d = drop_columns(rename_columns(trips), ["ehail_fee", "congestion_surcharge"])
    d = d.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("lpep_pickup_datetime", "lpep_dropoff_datetime")})  # a text that is no time is an error
    d = d.withColumns({c: real_number(c) for c in ("extra", "trip_distance", "fare_amount", "total_amount")})
    d = drop_null_rows(fill_constant(fill_mode(d, "passenger_count"), {"extra": 0.0}), ["payment_type"])
    d = d.withColumns({
        "pickup_hour": F.hour("lpep_pickup_datetime").cast("bigint"),
        "pickup_day_of_week": F.weekday("lpep_pickup_datetime").cast("bigint"),
        "trip_duration": minutes_between("lpep_pickup_datetime", "lpep_dropoff_datetime"),
    })
    d = d.where(between_open(F.col("trip_duration"), 1, 120) & between_open(F.col("trip_distance"), 0, 100) & between_open(F.col("fare_amount"), 0, 500))
    return d.withColumn("price_category", price_category(F.col("total_amount")))
