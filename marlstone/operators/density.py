"""DBSCAN over a neighbour table, one run or a whole grid of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marlstone.operators.classify import nearest
from marlstone.operators.distance import neighbours, stacked
from marlstone.operators.graph import components
from marlstone.operators.hierarchy import spanning_tree
from marlstone.operators.rank import numbered, ranks
from marlstone.session import materialise


def dbscan_runs(pts: DataFrame, edges: DataFrame, grid: list[tuple[float, int]]) -> DataFrame:
    """run, id, prediction for each (eps, min_samples) of the grid, by the same rules as dbscan.

    edges: a neighbour table at the largest eps. Runs with the same eps share
    their neighbours; the components of all runs are found together, a point
    of a run being a node of its own.
    """
    spark = pts.sparkSession
    at = materialise(ranks(pts.select("id"), [], ["id"], "i"))
    n = at.count()
    levels = sorted({e for e, _ in grid})
    runs = spark.createDataFrame([(k, levels.index(e), float(e), m) for k, (e, m) in enumerate(grid)], "run bigint, level int, eps double, least int")  # a row a run
    e = edges.join(at.select("id", "i"), "id").join(at.select(F.col("id").alias("other"), F.col("i").alias("j")), "other").select("i", "j", "distance")
    by_level = e.join(F.broadcast(runs.select("level", "eps").distinct()), F.col("distance") <= F.col("eps")).select("level", "i", "j")
    degree = by_level.groupBy("level", "i").agg(F.count(F.lit(1)).alias("n"))
    core = materialise(degree.join(F.broadcast(runs), "level").where("n >= least").select("run", "level", "i"))
    open_ = by_level.join(F.broadcast(runs.select("run", "level")), "level").join(core.select("run", "i"), ["run", "i"], "left_semi")
    between = open_.join(core.select("run", F.col("i").alias("j")), ["run", "j"], "left_semi")
    node = lambda c: (F.col("run") * F.lit(n) + F.col(c)).cast("bigint")
    comp = components(core.select(node("i").alias("id")), between.select(node("i").alias("id"), node("j").alias("other")))
    comp = comp.select(F.floor(F.col("id") / n).alias("run"), F.pmod("id", F.lit(n)).alias("i"), "component")
    number = ranks(comp.select("run", "component").distinct(), ["run"], ["component"], "cluster")
    cores = materialise(comp.join(number, ["run", "component"]).select("run", "i", "cluster"))
    border = by_level.join(F.broadcast(runs.select("run", "level")), "level").join(cores.select("run", F.col("i").alias("j"), "cluster"), ["run", "j"]).groupBy("run", "i").agg(F.min("cluster").alias("near"))
    every = at.join(F.broadcast(runs.select("run")))
    out = every.join(cores, ["run", "i"], "left").join(border, ["run", "i"], "left")
    return out.select("run", "id", F.coalesce("cluster", "near", F.lit(-1)).cast("bigint").alias("prediction"))


def dbscan(pts: DataFrame, eps: float, min_samples: int, edges: DataFrame | None = None) -> DataFrame:
    """id, prediction: clusters numbered from 0 by their smallest core id, -1 noise.

    A point's neighbours include itself. A border point goes to the
    lowest-numbered cluster among its neighbours. edges: a neighbour table at
    eps or more (id, other, distance), shared by a sweep.
    """
    e = (edges if edges is not None else neighbours(pts, eps)).where(F.col("distance") <= eps)
    core = e.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_samples).select("id")
    core = materialise(core)
    between = e.join(core, "id", "left_semi").join(core.withColumnRenamed("id", "other"), "other", "left_semi")
    comp = components(core, between)
    number = numbered(comp, "component", "cluster")
    cores = comp.join(number, "component").select("id", "cluster")
    border = e.join(cores.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min("cluster").alias("near"))
    out = pts.select("id").join(cores, "id", "left").join(border, "id", "left")
    return out.select("id", F.coalesce("cluster", "near", F.lit(-1)).cast("bigint").alias("prediction"))


# Rows of points whose nearest are looked for in one task, a core distance beyond any eps.
ROWS, FAR = 4096, 1e300


def nearest_points(pts: DataFrame, k: int) -> DataFrame:
    """id, features, others, distances: the k nearest of each point, itself among them, nearest first. A task holds the points."""
    n = max(1, -(-pts.count() // ROWS))
    every = pts.select(F.col("id").alias("id"), F.col("features").alias("features"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_b"))

    def run(own: pd.DataFrame, whole: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame(columns=["id", "features", "others", "distances"])
        ids = whole["id"].to_numpy()
        i, j, d = nearest(stacked(own), stacked(whole), ids, k, np.full(len(own), np.inf))
        by = np.argsort(i, kind="stable")  # k rows a point, nearest first
        wide = len(i) // len(own)
        return own[["id", "features"]].assign(others=list(ids[j[by]].reshape(-1, wide)), distances=list(d[by].reshape(-1, wide)))

    one = pts.select("id", "features", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("_b"))
    return one.repartition(n, "_b").groupBy("_b").cogroup(every.repartition(n, "_b").groupBy("_b")).applyInPandas(run, "id bigint, features array<double>, others array<bigint>, distances array<double>")


def _joined(i: np.ndarray, j: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Components after more edges: top has the smallest row of each row's component."""
    top = top.copy()
    while True:
        a, b = top[i], top[j]
        open_ = a != b
        if not open_.any():
            return top
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := top[top], top):
            top = up


def grid_labels(others: np.ndarray, distances: np.ndarray, edges: tuple[np.ndarray, np.ndarray], tree: np.ndarray, grid: list[tuple[float, int]]) -> np.ndarray:
    """Labels (rows x runs) by dbscan's rules from the nearest of each row, as many as the largest min_samples, and the tree's edges with their lengths."""
    n, k = distances.shape
    out = np.full((n, len(grid)), -1, np.int64)
    row = np.repeat(np.arange(n), k)
    i, j = np.r_[row, edges[0]], np.r_[others.ravel(), edges[1]]
    far = np.r_[distances.ravel(), tree]
    for least in sorted({m for _, m in grid}):
        core_at = distances[:, least - 1] if least <= k else np.full(n, np.inf)
        reach = np.maximum(far, np.maximum(core_at[i], core_at[j]))
        top, last = np.arange(n), -np.inf
        for eps in sorted({e for e, m in grid if m == least}):
            at = (reach > last) & (reach <= eps)
            top, last = _joined(i[at], j[at], top), eps
            core = core_at <= eps
            label = np.full(n, -1, np.int64)
            names, code = np.unique(top[core], return_inverse=True)  # the smallest core row of each
            label[core] = code
            # a point that isn't core has all its neighbours among its nearest
            near = np.where((distances <= eps) & core[others], label[others], n).min(1)
            label = np.where(core | (near == n), label, near)
            for run in (r for r, g in enumerate(grid) if g == (eps, least)):
                out[:, run] = label
    return out


def dbscan_labels(pts: DataFrame, grid: list[tuple[float, int]]) -> DataFrame:
    """id, labels: an array with the prediction of each (eps, min_samples) of the grid, by the same rules as dbscan; no neighbour table, whatever the eps.

    With k the largest min_samples, the k nearest of each point tell whether it
    is core in a run, and which cores are near if it isn't. Two cores within
    eps that are not among each other's k nearest are both core at k, too, so
    the spanning tree of the distances that are no less than either end's k-th
    holds a way between them of edges within eps: the k nearest and that tree
    give the components of all runs.
    """
    k = max(m for _, m in grid)
    near = materialise(nearest_points(pts, k).withColumn("core", F.when(F.size("distances") == k, F.element_at("distances", -1)).otherwise(F.lit(FAR))))
    one = F.lit(0).alias("_all")

    def run(a: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        a = a.sort_values("id")
        ids, place = a["id"].to_numpy(), lambda v: np.searchsorted(ids, v)
        edges = tuple(place(tree[c].to_numpy(np.int64)) for c in ("id", "other"))
        labels = grid_labels(place(np.stack(a["others"].to_numpy())), np.stack(a["distances"].to_numpy()), edges, tree["distance"].to_numpy(float), grid)
        return pd.DataFrame({"id": ids, "labels": list(labels)})

    tree = spanning_tree(near.select("id", "features", "core")).select("*", one)
    return near.select("id", "others", "distances", one).groupBy("_all").cogroup(tree.groupBy("_all")).applyInPandas(run, "id bigint, labels array<bigint>")
