"""Parameter sweeps: runs scored by silhouette, the first best wins."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone.operators import density, hierarchy, kmeans, mixture
from marlstone.operators.distance import label_scores
from marlstone.session import materialise, release, tidied

SCHEMA = "ord bigint, algorithm string, params map<string,string>, score double"


@dataclass
class Runs:
    """A sweep before it is scored: its parts, when called, give (id, labels) with a label for each of the next runs of the grid."""

    algorithm: str
    grid: list[dict]
    parts: list[Callable[[], DataFrame]]


# Fixed value: parts of sweeps that are worked out at the same time.
WIDTH = 4


def together(work: list[Callable]) -> list:
    """What each of the functions returns; WIDTH of them at a time, so that one task of a part leaves the other cores to the others."""
    with ThreadPoolExecutor(WIDTH) as pool:
        return list(pool.map(lambda f: f(), work))


def scored(sets: list[tuple[DataFrame, list[Runs]]]) -> list[list[DataFrame]]:
    """For each set of points and sweep: ord, algorithm, params, score of each run with more than one label. All runs of a set of points are scored together."""
    work = [(s, part) for s, (_, sweeps) in enumerate(sets) for r in sweeps for part in r.parts]
    spark = sets[0][0].sparkSession
    with tidied(spark):
        done = together([lambda part=part: materialise(part()) for _, part in work])

    def score(s: int) -> dict:
        pts, parts = sets[s][0], None
        for k, one in enumerate(one for (at, _), one in zip(work, done) if at == s):
            one = one.select("id", F.struct(F.lit(k).alias("part"), "labels").alias("p"))
            parts = one if parts is None else parts.unionByName(one)
        held = parts.groupBy("id").agg(F.sort_array(F.collect_list("p")).alias("p"))  # a point's labels: as many as there are runs
        return {r["run"]: r["silhouette"] for r in label_scores(pts, held.select("id", F.flatten(F.transform("p", lambda x: x["labels"])).alias("labels"))).collect()}  # a number a run

    out = []
    with tidied(spark):
        found = together([lambda s=s: score(s) for s in range(len(sets))])
    for (_, sweeps), scores in zip(sets, found):
        at, tables = 0, []
        for r in sweeps:
            tables.append(_table(spark, [(i, r.algorithm, {k: str(v) for k, v in p.items()}, scores[at + i]) for i, p in enumerate(r.grid) if at + i in scores]))
            at += len(r.grid)
        out.append(tables)
    for one in done:
        release(one)
    return out


def _table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def best(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Highest score, the earliest of a tie; per group of ``by``."""
    first = F.max_by(F.struct("ord", "algorithm", "params", "score"), F.struct(F.col("score"), -F.col("ord"))).alias("b")
    return (results.groupBy(*by).agg(first) if by else results.agg(first)).where("b is not null").select(*(by or []), *(f"b.{c}" for c in ("ord", "algorithm", "params", "score") if c not in (by or [])))


def _one(labelled: DataFrame) -> DataFrame:
    return labelled.select("id", F.array(F.col("prediction").cast("bigint")).alias("labels"))


def kmeans_runs(pts: DataFrame, ks: list[int] | range = range(2, 8), seed: int = 42) -> Runs:
    return Runs("kmeans", [{"k": k} for k in ks], [lambda k=k: _one(kmeans.mllib(pts, k, seed, 1)[0]) for k in ks])


def kmeans_sweep(pts: DataFrame, ks: list[int] | range = range(2, 8), seed: int = 42) -> DataFrame:
    return scored([(pts, [kmeans_runs(pts, ks, seed)])])[0][0]


# The default grids of the sweeps.
EPS = tuple(0.1 + 2.9 * i / 9 for i in range(10))
MIN_SAMPLES = tuple(range(5, 26))


def dbscan_runs(pts: DataFrame, eps: Iterable[float] = EPS, min_samples: Iterable[int] = MIN_SAMPLES) -> Runs:
    grid = list(product(eps, min_samples))
    return Runs("dbscan", [{"eps": round(e, 6), "min_samples": m} for e, m in grid], [lambda: density.dbscan_labels(pts, grid)])


def dbscan_sweep(pts: DataFrame, eps: Iterable[float] = EPS, min_samples: Iterable[int] = MIN_SAMPLES) -> DataFrame:
    """The nearest points and one tree serve every run; noise counts as a cluster of the score."""
    return scored([(pts, [dbscan_runs(pts, eps, min_samples)])])[0][0]


def hierarchical_runs(pts: DataFrame, metrics: tuple = ("euclidean", "cityblock", "cosine"), linkages: tuple = ("average", "single"), thresholds: tuple = (10.0, 20.0), n_clusters: int = 2) -> Runs:
    at = [*({"threshold": t} for t in thresholds), {"n_clusters": n_clusters}]
    each = list(product(metrics, linkages))
    return Runs("hierarchical", [{"metric": m, "linkage": k, **c} for m, k in each for c in at], [lambda m=m, k=k: hierarchy.cut_labels(pts, k, m, at) for m, k in each])


def hierarchical_sweep(pts: DataFrame, metrics: tuple = ("euclidean", "cityblock", "cosine"), linkages: tuple = ("average", "single"), thresholds: tuple = (10.0, 20.0), n_clusters: int = 2) -> DataFrame:
    """A metric and linkage is worked out once for all its cuts; the score is Euclidean in any case."""
    return scored([(pts, [hierarchical_runs(pts, metrics, linkages, thresholds, n_clusters)])])[0][0]


def mixture_runs(pts: DataFrame, k: int = 3, seed: int = 42) -> Runs:
    grid = [{"covariance": c} for c in mixture.COVARIANCES]

    def fitted() -> DataFrame:
        labelled = pts.select("id", "features")
        for run, model in enumerate(mixture.fit_all(pts, k, tuple(p["covariance"] for p in grid), seed)):
            labelled = mixture.predict(labelled, model).withColumnRenamed("prediction", f"p{run}").drop("log_density")
        return labelled.select("id", F.array(*(f"p{run}" for run in range(len(grid)))).alias("labels"))

    return Runs("gaussian mixture", grid, [fitted])


def mixture_sweep(pts: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    return scored([(pts, [mixture_runs(pts, k, seed)])])[0][0]


def compare(datasets: dict[str, DataFrame]) -> DataFrame:
    """dataset, algorithm, params, score: the best run of each of the four algorithms on each set of points, by the default grids."""
    sets = [(pts, [f(pts) for f in (mixture_runs, kmeans_runs, hierarchical_runs, dbscan_runs)]) for pts in (materialise(p.select("id", "features")) for p in datasets.values())]
    out = None
    for name, tables in zip(datasets, scored(sets)):
        for table in tables:
            one = best(table).select(F.lit(name).alias("dataset"), "algorithm", "params", "score")
            out = one if out is None else out.unionByName(one)
    return out
