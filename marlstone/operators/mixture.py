"""Gaussian mixtures with full, tied, diagonal or spherical covariance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marlstone.operators import kmeans
from marlstone.operators.distance import stacked
from marlstone.session import materialise

COVARIANCES = ("full", "tied", "diag", "spherical")


@dataclass
class Mixture:
    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray  # k x d x d
    log_likelihood: float
    rounds: int

    def log_parts(self, x: np.ndarray) -> np.ndarray:
        out = []
        for w, m, c in zip(self.weights, self.means, self.covs):
            low = np.linalg.cholesky(c)
            z = np.linalg.solve(low, (x - m).T)
            out.append(np.log(w) - 0.5 * (len(m) * np.log(2 * np.pi) + (z**2).sum(0)) - np.log(np.diag(low)).sum())
        return np.stack(out, 1)

    def log_density(self, x: np.ndarray) -> np.ndarray:
        p = self.log_parts(x)
        top = p.max(1)
        return top + np.log(np.exp(p - top[:, None]).sum(1))


def _moments(pts: DataFrame, responsibilities: list, k: int, d: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """Summed responsibilities, first and second moments and log-likelihood by each of the functions: one row a task."""
    width = k * (1 + d + d * d) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(responsibilities), width))
        for pdf in batches:
            if len(pdf):
                x = stacked(pdf)
                for t, f in zip(total, responsibilities):
                    r, ll = f(x)
                    t += np.concatenate([r.sum(0), (r.T @ x).ravel(), np.einsum("nk,ni,nj->kij", r, x, x).ravel(), [ll]])
        yield pd.DataFrame({"v": [total.ravel()]})

    rows = pts.select("features").mapInPandas(run, "v array<double>").collect()
    total = np.sum([r["v"] for r in rows] or [np.zeros(len(responsibilities) * width)], axis=0).reshape(-1, width)
    return [(t[:k], t[k : k + k * d].reshape(k, d), t[k + k * d : -1].reshape(k, d, d), t[-1]) for t in total]


def _update(n: np.ndarray, s: np.ndarray, q: np.ndarray, cov: str, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.maximum(n, 1e-10)
    d = s.shape[1]
    means = s / n[:, None]
    full = q / n[:, None, None] - np.einsum("ki,kj->kij", means, means)
    if cov == "tied":
        full = np.repeat(((n[:, None, None] * full).sum(0) / n.sum())[None], len(n), 0)
    elif cov == "diag":
        full = np.stack([np.diag(np.diag(c)) for c in full])
    elif cov == "spherical":
        full = np.stack([np.eye(d) * np.trace(c) / d for c in full])
    return n / n.sum(), means, full + ridge * np.eye(d)


def fit(pts: DataFrame, k: int = 3, covariance: str = "full", seed: int = 42, max_iter: int = 50, tol: float = 1e-3, ridge: float = 1e-6) -> Mixture:
    """EM from a k-means start. A round is one pass; the moments (k * d * d numbers a task) are all that moves."""
    return fit_all(pts, k, (covariance,), seed, max_iter, tol, ridge)[0]


def fit_all(pts: DataFrame, k: int = 3, covariances: tuple[str, ...] = COVARIANCES, seed: int = 42, max_iter: int = 50, tol: float = 1e-3, ridge: float = 1e-6) -> list[Mixture]:
    """A fit for each covariance, from one start and in common passes; each ends by its own likelihood."""
    if unknown := set(covariances) - set(COVARIANCES):
        raise ValueError(f"unknown covariance {unknown.pop()!r}")
    heads = np.array(kmeans.fit(pts, k, seed=seed, max_iter=10, rule="total").heads)
    d = heads.shape[1]

    def hard(x: np.ndarray) -> tuple[np.ndarray, float]:
        return np.eye(k)[((x[:, None] - heads[None]) ** 2).sum(2).argmin(1)], 0.0

    first = _moments(pts, [hard], k, d)[0]
    rows = max(first[0].sum(), 1)
    moments, last, models = {c: first for c in covariances}, {c: -np.inf for c in covariances}, {}
    live = list(dict.fromkeys(covariances))
    for r in range(1, max_iter + 1):
        for c in live:
            models[c] = Mixture(*_update(*moments[c][:3], c, ridge), 0.0, r)

        def soft(x: np.ndarray, m: Mixture) -> tuple[np.ndarray, float]:
            p = m.log_parts(x)
            whole = m.log_density(x)
            return np.exp(p - whole[:, None]), float(whole.sum())

        moments = dict(zip(live, _moments(pts, [partial(soft, m=models[c]) for c in live], k, d)))
        for c in list(live):
            models[c].log_likelihood = moments[c][3] / rows
            if abs(models[c].log_likelihood - last[c]) < tol:
                live.remove(c)
            last[c] = models[c].log_likelihood
        if not live:
            break
    return [models[c] for c in covariances]


def predict(pts: DataFrame, model: Mixture) -> DataFrame:
    """pts with prediction and log_density."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pts.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = stacked(pdf)
                yield pdf.assign(prediction=model.log_parts(x).argmax(1), log_density=model.log_density(x))

    return pts.mapInPandas(run, f"{kinds}, prediction bigint, log_density double")


def evaluation_grid(pts: DataFrame, i: int = 0, j: int = 1, steps: int = 100) -> DataFrame:
    """id, features [x, y]: steps by steps points over the box of two features, one beyond on each side."""
    f = F.col("features")
    lo_x, hi_x, lo_y, hi_y = pts.agg(F.min(f[i]) - 1, F.max(f[i]) + 1, F.min(f[j]) - 1, F.max(f[j]) + 1).first()
    at = lambda lo, hi, n: F.lit(lo) + (hi - lo) * n / (steps - 1)
    g = pts.sparkSession.range(steps * steps)
    return g.select("id", F.array(at(lo_x, hi_x, F.pmod("id", F.lit(steps))), at(lo_y, hi_y, F.floor(F.col("id") / steps))).alias("features"))


def pair_contours(pts: DataFrame, dims: int, k: int = 3, covariance: str = "full", seed: int = 42, steps: int = 100) -> DataFrame:
    """dim_i, dim_j, x, y, logp: for every pair of features i < j the density of a mixture fitted to the two alone."""
    out = None
    for i in range(dims):
        for j in range(i + 1, dims):
            two = materialise(pts.select("id", F.array(F.col("features")[i], F.col("features")[j]).alias("features")))
            one = density_grid(two, fit(two, k, covariance, seed), 0, 1, steps).select(F.lit(i).cast("bigint").alias("dim_i"), F.lit(j).cast("bigint").alias("dim_j"), "x", "y", "logp")
            out = one if out is None else out.unionByName(one)
    return out


def density_grid(pts: DataFrame, model: Mixture, i: int = 0, j: int = 1, steps: int = 100) -> DataFrame:
    """x, y, logp of a two-feature mixture."""
    f = F.col("features")
    return predict(evaluation_grid(pts, i, j, steps), model).select(f[0].alias("x"), f[1].alias("y"), F.col("log_density").alias("logp"))
