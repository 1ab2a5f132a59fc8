"""Distances to few centroids, and exact all-against-all kernels in blocks.

Points are (id, features array<double>). Kernels over all points replicate
each block to the block pairs it takes part in; a task holds two blocks and
gives sums or hits, never pairs of a whole group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marlstone.session import materialise

KINDS = ("euclidean", "pearson", "cityblock", "cosine")
BLOCK = 2048


def points(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """id, features; rows with a null or NaN feature are left out."""
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(ok).select(F.col(key).alias("id"), F.array(*(F.col(c).cast("double") for c in columns)).alias("features"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def squared(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def mean_vector(pts: DataFrame, column: str = "features") -> list[float]:
    """Column means, one pass."""
    d = pts.select(F.size(column)).first()
    if d is None:
        return []
    return list(pts.agg(*(F.avg(F.col(column)[i]) for i in range(d[0]))).first())


def to_centroids(pts: DataFrame, heads: list[list[float]], kind: str = "euclidean") -> DataFrame:
    """pts with ``distances`` (array by centroid): the heads are literals, so this is a projection.

    pearson: cosine distance after centring points by their column means and
    heads by theirs; a zero norm on either side gives distance 1.
    """
    if kind not in KINDS[:2]:
        raise ValueError(f"unknown distance {kind!r}")
    lit = lambda v: F.array(*(F.lit(float(x)) for x in v))
    f = F.col("features")
    if kind == "euclidean":
        return pts.withColumn("distances", F.array(*(F.sqrt(squared(f, lit(h))) for h in heads)))
    mu = np.asarray(mean_vector(pts))
    h = np.asarray(heads, float)
    h = h - h.mean(0)
    x = F.zip_with(f, lit(mu), lambda a, b: a - b)
    norm = F.sqrt(_dot(F.col("_x"), F.col("_x")))
    each = []
    for row in h:
        den = norm * F.lit(float(np.sqrt((row**2).sum())))
        each.append(1 - F.when(den == 0, 0.0).otherwise(_dot(F.col("_x"), lit(row)) / F.nullif(den, F.lit(0.0))))
    return pts.withColumn("_x", x).withColumn("distances", F.array(*each)).drop("_x")


def distance_table(pts: DataFrame, heads: list[list[float]], kind: str = "euclidean") -> DataFrame:
    """id, cluster, distance."""
    return to_centroids(pts, heads, kind).select("id", F.posexplode("distances").alias("cluster", "distance"))


def matrix(a: np.ndarray, b: np.ndarray, kind: str = "euclidean") -> np.ndarray:
    """Distances of two blocks, by one formula whatever their size; Euclidean ones that the expanded product can't tell from 0 are taken from the differences."""
    if kind == "euclidean":
        aa, bb = (a**2).sum(1)[:, None], (b**2).sum(1)[None]
        d = np.maximum(aa + bb - 2 * a @ b.T, 0)
        i, j = np.nonzero(d <= 1e-7 * (aa + bb))
        d[i, j] = ((a[i] - b[j]) ** 2).sum(1)
        return np.sqrt(d)
    if kind == "cityblock":
        d = np.zeros((len(a), len(b)))
        for x, y in zip(a.T, b.T):
            d += np.abs(x[:, None] - y)
        return d
    if kind == "cosine":
        na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
        return 1 - np.divide(a @ b.T, np.outer(na, nb), out=np.zeros((len(a), len(b))), where=np.outer(na, nb) > 0)
    raise ValueError(f"unknown distance {kind!r}")


def exactly(a: np.ndarray, b: np.ndarray, kind: str = "euclidean") -> np.ndarray:
    """Distances of rows in step, from their differences: the same wherever the rows stand."""
    if kind == "euclidean":
        return np.sqrt(((a - b) ** 2).sum(1))
    if kind == "cityblock":
        return np.abs(a - b).sum(1)
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    return 1 - np.divide((a * b).sum(1), na * nb, out=np.zeros(len(a)), where=na * nb > 0)


def block_pairs(left: DataFrame, right: DataFrame, kernel, schema: str, block: int = BLOCK) -> DataFrame:
    """kernel(left block, right block) over every pair of blocks; blocks by hash of id."""
    left = left.select(*(F.col(c).alias(c) for c in left.columns))
    n_l, n_r = max(1, -(-left.count() // block)), max(1, -(-right.count() // block))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    l_ = left.withColumn("_i", own(n_l)).withColumn("_j", every(n_r))
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # left and right may be one table
    r_ = right.withColumn("_j", own(n_r)).withColumn("_i", every(n_l))
    empty = [x.strip().split()[0] for x in schema.split(",")]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return kernel(a, b) if len(a) and len(b) else pd.DataFrame(columns=empty)

    return l_.groupBy("_i", "_j").cogroup(r_.groupBy("_i", "_j")).applyInPandas(run, schema)


def stacked(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["features"].to_numpy())


def neighbours(pts: DataFrame, eps: float, kind: str = "euclidean", strict: bool = False) -> DataFrame:
    """id, other, distance of points within eps, each point with itself, both directions.

    Up to three dimensions by grid cells (an equi-join of a cell with its
    neighbour cells); above by blocks. Only hits leave a task.
    """
    first = pts.select(F.size("features")).first()
    dims = first[0] if first else 0
    if 0 < dims <= 3 and kind == "euclidean" and eps > 0:
        cell = lambda i, s: (F.floor(F.col("features")[i] / eps) + s).cast("bigint")
        steps = [F.lit(s) for s in (-1, 0, 1)]
        a = pts.select("id", "features", *(cell(i, F.lit(0)).alias(f"c{i}") for i in range(dims)))
        b = pts.select(F.col("id").alias("other"), F.col("features").alias("f2"), *(F.col("features")[i].alias(f"v{i}") for i in range(dims)))
        for i in range(dims):
            b = b.withColumn(f"s{i}", F.explode(F.array(*steps))).withColumn(f"c{i}", (F.floor(F.col(f"v{i}") / eps) + F.col(f"s{i}")).cast("bigint"))
        j = a.join(b, [f"c{i}" for i in range(dims)]).withColumn("distance", F.sqrt(squared(F.col("features"), F.col("f2"))))
        hit = F.col("distance") < eps if strict else F.col("distance") <= eps
        return j.where(hit).select("id", "other", "distance")

    def kernel(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = stacked(a), stacked(b)
        i, j = np.nonzero(matrix(x, y, kind) <= eps + 1e-6 * (1 + abs(eps)))  # the block's formula picks, the differences decide
        d = exactly(x[i], y[j], kind)
        hit = d < eps if strict else d <= eps
        return pd.DataFrame({"id": a["id"].to_numpy()[i[hit]], "other": b["id"].to_numpy()[j[hit]], "distance": d[hit]})

    return block_pairs(pts, pts, kernel, "id bigint, other bigint, distance double")


def silhouette_points(labelled: DataFrame, kind: str = "euclidean") -> DataFrame:
    """id, prediction, s: silhouette of each point of (id, features, prediction); a lone member of a cluster has 0.

    Quadratic by definition: blocks give sums of distances by cluster, which
    are added up; no pair leaves a task.
    """

    def kernel(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        d = matrix(stacked(a), stacked(b), kind)
        out = []
        for c in np.unique(b["prediction"]):
            at = (b["prediction"] == c).to_numpy()
            out.append(pd.DataFrame({"id": a["id"].to_numpy(), "own": a["prediction"].to_numpy(), "cluster": c, "total": d[:, at].sum(1), "n": int(at.sum())}))
        return pd.concat(out)

    sums = block_pairs(labelled, labelled, kernel, "id bigint, own bigint, cluster bigint, total double, n bigint")
    per = sums.groupBy("id", "own", "cluster").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return per.groupBy("id", "own").agg(*_sides()).select("id", F.col("own").alias("prediction"), _point_score())


# Rows of points that a task scores, rows at once, columns at once; labels of a run that is scored over rows that
# no run tells apart; numbers of the matrix that adds such rows up.
ROWS, AT_ONCE, COLUMNS, LABELS, HOT = 4096, 64, 4096, 256, 1 << 22


def _scores(total: np.ndarray, size: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Silhouette of rows from their summed distances to each label (rows x labels); 0 for the lone one of its label."""
    at = np.arange(len(own))
    a = total[at, own] / np.maximum(size[own] - 1, 1)
    mean = total / size
    mean[at, own] = np.inf
    b = mean.min(1)
    top = np.maximum(a, b)
    return np.where((size[own] == 1) | (top == 0), 0.0, (b - a) / np.where(top == 0, 1, top))


def run_scores(x: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Summed silhouettes of some rows of x in each run of labels (all rows x runs); NaN for a run with a single label.

    Runs that part the rows alike are scored once. Rows that no run tells apart
    are added up once for all runs; runs of more than LABELS labels are added
    up alone, for the rows that are not the only ones of their label.
    """
    parts: dict[bytes, int] = {}
    of, codes = np.zeros(labels.shape[1], np.int64), []
    for r in range(labels.shape[1]):
        _, first, code = np.unique(labels[:, r], return_index=True, return_inverse=True)
        code = np.argsort(np.argsort(first))[code].astype(np.int32)
        of[r] = parts.setdefault(code.tobytes(), len(codes))
        if of[r] == len(codes):
            codes.append(code)
    sizes = [np.bincount(c) for c in codes]
    out = np.array([np.nan if len(s) == 1 else 0.0 for s in sizes])
    few = sorted((p for p, s in enumerate(sizes) if 1 < len(s) <= LABELS), key=lambda p: len(sizes[p]))
    many = [(p, np.argsort(codes[p], kind="stable"), np.r_[0, np.cumsum(sizes[p])[:-1]]) for p, s in enumerate(sizes) if len(s) > LABELS]
    atom = np.zeros(len(x), np.int64)
    for p in few:
        atom = np.unique(atom * len(sizes[p]) + codes[p], return_inverse=True)[1]
    order = np.argsort(atom, kind="stable")
    start = np.flatnonzero(np.r_[True, np.diff(atom[order]) > 0])
    back = np.argsort(order)
    y = x[order]
    wide = np.cumsum([len(sizes[p]) for p in few])
    flat = int((wide * len(start) <= HOT).sum())
    hot = np.zeros((len(start), wide[flat - 1] if flat else 0))
    for p, end in zip(few[:flat], wide):
        hot[np.arange(len(start)), end - len(sizes[p]) + codes[p][order[start]]] = 1
    sorts = [(p, np.argsort(codes[p][order[start]], kind="stable")) for p in few[flat:]]
    sorts = [(p, by, np.searchsorted(codes[p][order[start]][by], np.arange(len(sizes[p])))) for p, by in sorts]
    if not few and not many:
        return out[of]
    for i in range(0, len(rows), AT_ONCE):
        at = rows[i : i + AT_ONCE]
        d = np.hstack([matrix(x[at], y[j : j + COLUMNS]) for j in range(0, len(y), COLUMNS)])
        if few:
            atoms = np.add.reduceat(d, start, axis=1) if len(start) < len(y) else d
            total = atoms @ hot
            for p, end in zip(few[:flat], wide):
                out[p] += _scores(total[:, end - len(sizes[p]) : end], sizes[p], codes[p][at]).sum()
            for p, by, first in sorts:
                out[p] += _scores(np.add.reduceat(atoms[:, by], first, axis=1), sizes[p], codes[p][at]).sum()
        for p, by, first in many:
            own = codes[p][at]
            k = np.flatnonzero(sizes[p][own] > 1)
            if len(k):
                out[p] += _scores(np.add.reduceat(d[k][:, back[by]], first, axis=1), sizes[p], own[k]).sum()
    return out[of]


def label_scores(pts: DataFrame, labelled: DataFrame) -> DataFrame:
    """run, silhouette of many labellings of the same points: labelled (id, labels), an array with a label a run; no row for a run with a single label.

    A task holds all points with their labels, a block of which it scores over
    a few rows of distances at a time; a row a run leaves it.
    """
    both = pts.select("id", "features").join(labelled.select("id", F.col("labels").cast("array<int>").alias("labels")), "id")
    both = materialise(both)
    n = max(1, -(-both.count() // ROWS))
    every = both.select(*(F.col(c).alias(c) for c in both.columns), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_b"))  # left and right are one table
    own = both.select("id", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("_b"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("id")
        s = run_scores(stacked(b), np.stack(b["labels"].to_numpy()), np.searchsorted(b["id"].to_numpy(), a["id"].to_numpy()))
        return pd.DataFrame({"run": np.arange(len(s)), "s": s, "n": len(a)})[~np.isnan(s)]

    sums = own.repartition(n, "_b").groupBy("_b").cogroup(every.repartition(n, "_b").groupBy("_b")).applyInPandas(run, "run bigint, s double, n bigint")
    return sums.groupBy("run").agg((F.sum("s") / F.sum("n")).alias("silhouette"))


def silhouettes(pts: DataFrame, runs: DataFrame) -> DataFrame:
    """run, silhouette of label_scores for runs (run, id, prediction) that are numbered from 0, every point in every run."""
    held = runs.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("run", "prediction"))).alias("r"))  # a point's labels: as many as there are runs
    return label_scores(pts, held.select("id", F.transform("r", lambda x: x["prediction"]).alias("labels")))


def _sides() -> list[Column]:
    mine = F.col("cluster") == F.col("own")
    return [
        F.max(F.when(mine, F.col("n"))).alias("size"),
        F.max(F.when(mine & (F.col("n") > 1), F.col("total") / F.nullif(F.col("n") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("b"),
    ]


def _point_score() -> Column:
    top = F.greatest("a", "b")
    return F.when((F.col("size") == 1) | (top == 0), 0.0).otherwise((F.col("b") - F.col("a")) / F.nullif(top, F.lit(0.0))).alias("s")


def silhouette_fast(labelled: DataFrame) -> float:
    """MLlib's linear-time silhouette with squared Euclidean distance: another measure, for sizes the exact one can't reach."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    return ClusteringEvaluator(featuresCol="_v", predictionCol="prediction").evaluate(labelled.withColumn("_v", array_to_vector("features")))


def silhouette(labelled: DataFrame, kind: str = "euclidean") -> DataFrame:
    """silhouette in one row; no row if there are fewer than two labels."""
    s = silhouette_points(labelled, kind)
    return s.agg(F.avg("s").alias("silhouette"), F.count_distinct("prediction").alias("_k")).where("_k > 1").select("silhouette")
