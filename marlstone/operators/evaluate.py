"""Confusion, report, accuracy, cross-validation and learning curves of (label, prediction)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from marlstone.operators.split import md5_order
from marlstone.session import materialise, scratch


def confusion(df: DataFrame, labels: list[str]) -> DataFrame:
    """label, prediction, n for every pair of the given labels, zeros too (the grid is labels squared)."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels], "label string, prediction string")
    n = df.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, ["label", "prediction"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def report(df: DataFrame, labels: list[str]) -> DataFrame:
    """name, precision, recall, f1, support: a row a label, accuracy, macro avg and weighted avg; 0 where a denominator is 0."""
    c = materialise(confusion(df, labels))  # labels squared rows: the scored rows are read once
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp")
    true = c.groupBy(F.col("label").alias("name")).agg(F.sum("n").alias("support"), hit)
    pred = c.groupBy(F.col("prediction").alias("name")).agg(F.sum("n").alias("guessed"))
    div = lambda a, b: F.when(b == 0, 0.0).otherwise(a / F.nullif(b, F.lit(0)))
    per = true.join(pred, "name").withColumns({"precision": div(F.col("tp"), F.col("guessed")), "recall": div(F.col("tp"), F.col("support"))})
    both = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", F.when(both == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / F.nullif(both, F.lit(0.0))))
    stats = ["precision", "recall", "f1"]
    rows = per.select("name", *stats, "support")
    total = F.sum("support")
    acc = F.sum("tp") / F.nullif(total, F.lit(0))
    summed = per.agg(*(acc.alias(s) for s in stats), total.alias("support")).select(F.lit("accuracy").alias("name"), *stats, "support")
    macro = per.agg(*(F.avg(s).alias(s) for s in stats), total.alias("support")).select(F.lit("macro avg").alias("name"), *stats, "support")
    weighted = per.agg(*((F.sum(F.col(s) * F.col("support")) / F.nullif(total, F.lit(0))).alias(s) for s in stats), total.alias("support")).select(F.lit("weighted avg").alias("name"), *stats, "support")
    return rows.unionByName(summed).unionByName(macro).unionByName(weighted)


def text_colours(confused: DataFrame) -> DataFrame:
    """confused (label, prediction, n) with ``threshold``, half of the largest cell, and whether the cell's text is light on it."""
    top = confused.agg((F.max("n") / 2).alias("threshold"))
    return confused.join(F.broadcast(top)).withColumn("light", F.col("n") > F.col("threshold"))


def formatted(scores: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Numbers as texts with a fixed number of places."""
    return scores.withColumns({c: F.format_string(f"%.{n}f", F.col(c).cast("double")) for c, n in columns.items()})


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))


def cross_validate(df: DataFrame, train: Callable, k: int) -> DataFrame:
    """fold, accuracy of df with a fold column: fitted on the other folds. A fold at a time, so that the disk holds what one of them needs."""
    spark, rows = df.sparkSession, []
    with scratch(spark):
        df = materialise(df)
        for f in range(k):
            with scratch(spark):
                predict = train(df.where(F.col("fold") != f).drop("fold"))
                rows.append((f, accuracy(predict(df.where(F.col("fold") == f).drop("fold"))).first()[0]))
    return spark.createDataFrame(rows, "fold bigint, accuracy double")  # a number a fold


def mean_std(scores: DataFrame, column: str = "accuracy") -> DataFrame:
    """mean and population deviation."""
    return scores.agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def learning_curve(df: DataFrame, train: Callable, k: int = 3, fractions: tuple[float, ...] = tuple((i + 1) / 10 for i in range(10)), seed: int = 42) -> DataFrame:
    """fraction, fold, train_accuracy, test_accuracy of df with a fold column; the training rows are a prefix by hash order."""
    part = F.conv(F.substring(md5_order("id", seed), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rows: list[tuple] = []
    if many := getattr(train, "many", None):
        order = sorted(fractions)  # a bucket: a fold and the fractions that its rows lie under
        level = sum((part >= q).cast("int") for q in order)
        runs = [(q, f) for f in range(k) for q in fractions]
        each = [(f, j) for f in range(k) for j in range(len(order) + 1)]
        fits = np.array([[g != f and j <= order.index(q) for g, j in each] for q, f in runs])
        tests = np.array([[g == f for g, _ in each] for _, f in runs])
        with scratch(df.sparkSession):
            scores = many(df.select("features", "label", (F.col("fold") * (len(order) + 1) + level).cast("int").alias("bucket")), fits, tests)
        rows = [(q, f, a, b) for (q, f), (a, b) in zip(runs, scores)]
        return df.sparkSession.createDataFrame(rows, "fraction double, fold bigint, train_accuracy double, test_accuracy double")
    df = materialise(df)
    for f in range(k):
        for q in fractions:
            fit, test = (F.col("fold") != f) & (part < q), F.col("fold") == f
            predict = train(df.where(fit).drop("fold"))
            hit = (F.col("label") == F.col("prediction")).cast("double")
            scores = predict(df.where(fit | test)).agg(F.avg(F.when(fit, hit)), F.avg(F.when(test, hit))).first()
            rows.append((q, f, *scores))  # a few numbers: a lazy union of all fits is a plan too large for a driver
    return df.sparkSession.createDataFrame(rows, "fraction double, fold bigint, train_accuracy double, test_accuracy double")


def curve_band(curve: DataFrame) -> DataFrame:
    """fraction with mean and population deviation of both accuracies."""
    return curve.groupBy("fraction").agg(*(f(F.col(f"{s}_accuracy")).alias(f"{s}_{n}") for s in ("train", "test") for n, f in (("mean", F.avg), ("std", F.stddev_pop))))
