"""Deterministic splits and folds, keyed by md5 of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marlstone.operators.rank import ranks


def md5_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def class_rank(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """df with ``rank`` (from 1) and ``size`` of its class by md5 order; a class may hold most rows, its ranges are ranked apart. Classes are few: what is joined back is broadcast."""
    d = ranks(df.withColumn("_h", md5_order(key, seed)), [label], ["_h", key], few=True).drop("_h")
    size = d.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("size"))
    return d.join(F.broadcast(size), F.col(label).eqNullSafe(F.col("_l"))).drop("_l").withColumn("rank", F.col("rank") + 1)


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.3, seed: int = 42) -> DataFrame:
    """df with ``is_test``: of each class the first round(share * size) rows by md5 order.

    The last such row of each class is found by counts of the hash's first
    four digits, then among the rows that share them: df is read in place,
    nothing of it is sorted or written. Classes are few.
    """
    h, k, c = F.coalesce(md5_order(key, seed), F.lit("")), F.col(key), F.col(label)  # a missing key comes first
    n = df.groupBy(c.alias("_l"), F.substring(h, 1, 4).alias("_lead")).agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy("_l")
    n = n.withColumns({"_to": F.sum("_n").over(w.orderBy("_lead")), "_want": F.floor(F.sum("_n").over(w) * test_share + 0.5)})
    edge = n.where((F.col("_want") <= F.col("_to")) & (F.col("_want") > F.col("_to") - F.col("_n"))).withColumn("_left", F.col("_want") - F.col("_to") + F.col("_n"))
    same = c.eqNullSafe(F.col("_l")) & (F.substring(h, 1, 4) == F.col("_lead"))
    rows = df.select(key, label).join(F.broadcast(edge), same).groupBy("_l", "_left", h.alias("_last"), k.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_to", F.sum("_n").over(w.orderBy("_last", "_key")))
    last = rows.where((F.col("_left") <= F.col("_to")) & (F.col("_left") > F.col("_to") - F.col("_n"))).select("_l", "_last", "_key", (F.col("_left") < F.col("_to")).alias("_torn")).collect()  # a row a class
    if any(r["_torn"] for r in last):  # rows of one key on both sides
        r = class_rank(df, key, label, seed)
        return r.withColumn("is_test", F.col("rank") <= F.floor(F.col("size") * test_share + 0.5)).drop("rank", "size")
    kind = lambda name: df.schema[name].dataType.simpleString()
    ends = df.sparkSession.createDataFrame([tuple(r)[:3] for r in last], f"_l {kind(label)}, _last string, _key {kind(key)}")
    first = (h < F.col("_last")) | ((h == F.col("_last")) & F.coalesce(k <= F.col("_key"), F.lit(True)))
    return df.join(F.broadcast(ends), c.eqNullSafe(F.col("_l")), "left").withColumn("is_test", F.coalesce(first, F.lit(False))).drop("_l", "_last", "_key")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """df with ``fold`` 0 .. k-1, balanced within one a class."""
    return class_rank(df, key, label, seed).withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(k)).cast("bigint")).drop("rank", "size")


def folds(df: DataFrame, key: str, k: int = 3) -> DataFrame:
    """df with ``fold`` by the hash of the id alone: no shuffle."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("fold", F.pmod(h, F.lit(k)))


def sample_rows(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows without replacement, by md5 order."""
    return df.orderBy(md5_order(key, seed), key).limit(k)
