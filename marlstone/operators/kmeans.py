"""K-means with a selectable distance, and MLlib's where its semantics agree."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from marlstone.operators.distance import to_centroids
from marlstone.operators.split import sample_rows

# Fixed value: rounds after which a loop without max_iter counts as endless.
GUARD = 10_000


def init_range(pts: DataFrame, k: int, seed: int = 42, from_zero: bool = False) -> list[list[float]]:
    """k heads at random in the box of the points; from_zero: in a box of the same size at the origin."""
    first = pts.select(F.size("features")).first()
    if first is None:
        raise ValueError("no points")
    d = first[0]
    row = pts.agg(*(F.min(F.col("features")[i]) for i in range(d)), *(F.max(F.col("features")[i]) for i in range(d))).first()
    low, high = np.array(row[:d]), np.array(row[d:])
    box = np.random.default_rng(seed).random((k, d)) * (high - low)
    return (box if from_zero else box + low).tolist()


def init_sample(pts: DataFrame, k: int, seed: int = 42) -> list[list[float]]:
    return [r["features"] for r in sample_rows(pts, "id", k, seed).collect()]


def init_first(pts: DataFrame, k: int) -> list[list[float]]:
    """The k points with the smallest ids."""
    return [r["features"] for r in pts.orderBy("id").limit(k).collect()]


def assign(pts: DataFrame, heads: list[list[float]], kind: str = "euclidean") -> DataFrame:
    """pts with prediction (ties to the lowest head) and distance."""
    d = to_centroids(pts, heads, kind)
    return d.withColumn("distance", F.array_min("distances")).withColumn("prediction", (F.array_position("distances", F.col("distance")) - 1).cast("bigint")).drop("distances")


def step_stats(assigned: DataFrame, heads: list[list[float]]) -> DataFrame:
    """prediction, n, m_j (means), sse_j (squared distance to the head a feature): one groupBy with partial sums."""
    d = len(heads[0])
    at = lambda j: F.element_at(F.array(*(F.lit(float(h[j])) for h in heads)), F.col("prediction").cast("int") + 1)
    aggs = [F.count(F.lit(1)).alias("n")]
    for j in range(d):
        x = F.col("features")[j]
        aggs += [F.avg(x).alias(f"m_{j}"), F.sum((x - at(j)) * (x - at(j))).alias(f"sse_{j}")]
    return assigned.groupBy("prediction").agg(*aggs)


@dataclass
class Fit:
    heads: list[list[float]]
    metric: float
    iterations: int
    kind: str
    trace: list[float] = field(default_factory=list)
    converged: bool = True

    def predict(self, pts: DataFrame) -> DataFrame:
        return assign(pts, self.heads, self.kind)


def fit(pts: DataFrame, k: int, kind: str = "euclidean", init: str | list = "sample", seed: int = 42, max_iter: int | None = None, tol: float = 1e-4, rule: str = "any_feature") -> Fit:
    """Lloyd's loop. Each round is one job whose k rows reach the driver.

    Stops before the update if the summed mean squared distances are under
    tol or as before, or (rule any_feature) one feature's, (rule total) the
    summed SSE changes by less than tol. Empty clusters keep their head and
    have no part in the tests. The metric is the squared Euclidean SSE under
    any distance. With max_iter the loop may end before the rule holds
    (``converged`` is false then); without it, GUARD rounds are an error.
    """
    if isinstance(init, str):
        heads = {"sample": lambda: init_sample(pts, k, seed), "range": lambda: init_range(pts, k, seed), "range0": lambda: init_range(pts, k, seed, True), "first": lambda: init_first(pts, k)}[init]()
    else:
        heads = [list(h) for h in init]
    d = len(heads[0])
    old_sse, old_mean, trace = None, None, []
    done = False
    for n in range(1, (max_iter or GUARD) + 1):
        rows = step_stats(assign(pts, heads, kind), heads).collect()
        sse = np.array([sum(r[f"sse_{j}"] for r in rows) for j in range(d)])
        mean = {r["prediction"]: sum(r[f"sse_{j}"] for j in range(d)) / r["n"] for r in rows}
        trace.append(float(sse.sum()))
        done = sum(mean.values()) < tol
        if old_mean is not None:
            same = mean.keys() == old_mean.keys() and all(abs(mean[c] - old_mean[c]) <= 1e-8 + 1e-5 * abs(old_mean[c]) for c in mean)
            change = np.abs(sse - old_sse)
            done = done or same or (bool((change < tol).any()) if rule == "any_feature" else bool(change.sum() < tol))
        if done:
            break
        old_sse, old_mean = sse, mean
        for r in rows:
            heads[r["prediction"]] = [r[f"m_{j}"] for j in range(d)]
    if not done and max_iter is None:
        raise RuntimeError(f"no end after {GUARD} rounds")
    return Fit(heads, trace[-1], n, kind, trace, done)


def mllib(pts: DataFrame, k: int, seed: int = 42, runs: int = 3) -> tuple[DataFrame, float, list[list[float]]]:
    """Labelled points, inertia and heads of the best of several k-means|| runs."""
    vec = pts.withColumn("_v", array_to_vector("features"))
    best = None
    for r in range(runs):
        m = KMeans(k=k, seed=seed + r, maxIter=300, tol=1e-4, featuresCol="_v").fit(vec)
        if best is None or m.summary.trainingCost < best.summary.trainingCost:
            best = m
    out = best.transform(vec).withColumn("prediction", F.col("prediction").cast("bigint")).drop("_v")
    return out, best.summary.trainingCost, [list(map(float, c)) for c in best.clusterCenters()]
