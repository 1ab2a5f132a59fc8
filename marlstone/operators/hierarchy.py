"""Agglomerative clustering: single linkage by components or by a minimum spanning tree, average linkage in a task that holds the points."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marlstone.operators.classify import halves
from marlstone.operators.distance import exactly, matrix, neighbours, stacked
from marlstone.operators.graph import Forest, components
from marlstone.operators.rank import numbered, ranks
from marlstone.session import materialise

CAP = 5000


def single_threshold(pts: DataFrame, threshold: float, kind: str = "euclidean") -> DataFrame:
    """id, prediction of single linkage cut at a threshold: components of the edges below it, numbered by smallest id. Any size."""
    comp = components(pts, neighbours(pts, threshold, kind, strict=True))
    return comp.join(numbered(comp, "component", "prediction"), "component").select("id", "prediction")


class _Rows:
    """Distances of one row of x to the others, worked out when asked for: memory by the row. core: a distance is at least that of either end."""

    def __init__(self, x: np.ndarray, kind: str = "euclidean", core: np.ndarray | None = None):
        if kind == "cosine":
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
        elif kind not in ("euclidean", "cityblock"):
            raise ValueError(f"unknown distance {kind!r}")
        self.all, self.kind, self.core = x, kind, np.zeros(len(x)) if core is None else core
        self.keep(np.arange(len(x)))

    def __len__(self) -> int:
        return len(self.all)

    def keep(self, rest: np.ndarray) -> None:
        self.columns = np.ascontiguousarray(self.all[rest].T)
        self.one, self.sum = np.empty(len(rest)), np.empty(len(rest))

    def row(self, j: int, rest: np.ndarray) -> np.ndarray:
        """Distances of row j to the rows that are kept; the next call overwrites them."""
        if self.kind == "cosine":
            return 1 - self.all[j] @ self.columns
        for c, v in enumerate(self.all[j]):
            to = self.one if c else self.sum
            np.subtract(self.columns[c], v, out=to)
            np.abs(to, out=to) if self.kind == "cityblock" else np.multiply(to, to, out=to)
            if c:
                np.add(self.sum, to, out=self.sum)
        return self.sum if self.kind == "cityblock" else np.sqrt(self.sum, out=self.sum)


class _Matrix:
    """The same of a distance matrix."""

    def __init__(self, d: np.ndarray):
        self.d, self.core = d, np.zeros(len(d))

    def __len__(self) -> int:
        return len(self.d)

    def keep(self, rest: np.ndarray) -> None:
        pass

    def row(self, j: int, rest: np.ndarray) -> np.ndarray:
        return self.d[j, rest]


def _tree_of(ids: np.ndarray, d: np.ndarray | _Rows) -> list[tuple[int, int, float]]:
    """Minimum spanning tree of a distance matrix or of rows; equal distances by the smaller ids (Prim, a row at a time)."""
    d = _Matrix(d) if isinstance(d, np.ndarray) else d
    n, out, last = len(ids), [], 0
    rest = np.arange(n)
    best, near, floor = np.full(n, np.inf), np.zeros(n, np.int64), d.core.copy()
    floor[0], left = np.inf, n - 1  # a row that is done is infinitely far
    for _ in range(n - 1):
        if left < 0.9 * len(rest):
            at = np.flatnonzero(np.isfinite(floor))
            rest, best, near, floor = rest[at], best[at], near[at], floor[at]
            d.keep(rest)
        row = np.maximum(d.row(last, rest), floor)
        if d.core[last] > 0:
            row = np.maximum(row, d.core[last], out=row)
        closer = np.flatnonzero(row < best)
        best[closer], near[closer] = row[closer], last
        k = int(best.argmin())
        last, from_ = int(rest[k]), int(near[k])
        a, b = sorted((int(ids[from_]), int(ids[last])))
        out.append((a, b, float(best[k])))
        best[k], floor[k], left = np.inf, np.inf, left - 1
    return out


def spanning_tree(pts: DataFrame, kind: str = "euclidean", block: int = 1 << 15, fan: int = 16) -> DataFrame:
    """id, other, distance: a minimum spanning tree of the points, at any number of them. With a column core a distance is at least the core of either end.

    Every pair of blocks gives the tree of its own points (an edge that is the
    largest of a cycle there is in no tree of the whole), then the trees are
    merged as a tree of tasks. Work is quadratic by definition; a task holds
    its points and no distances, what moves is 2 * block edges a pair of
    blocks, and the last merge holds an edge a point.
    """
    n = max(1, -(-pts.count() // block))
    own = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    pts = pts.select("id", "features", *(c for c in pts.columns if c == "core"), own.alias("_b"))
    # every pair of blocks once: a block meets itself through its pairs, or alone if it is the only one
    other = F.explode(F.sequence(F.lit(0), F.lit(n - 1)) if n == 1 else F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda x: x != F.col("_b")))
    pairs = pts.withColumn("_o", other).withColumns({"_i": F.least("_b", "_o"), "_j": F.greatest("_b", "_o")})

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").reset_index(drop=True)
        core = pdf["core"].to_numpy() if "core" in pdf else None
        ids, x = pdf["id"].to_numpy(), stacked(pdf)
        tree = pd.DataFrame(_tree_of(ids, _Rows(x, kind, core)), columns=["id", "other", "distance"])
        if kind == "cosine" and len(tree):  # the product picks, the differences' formula decides
            tree["distance"] = exactly(*(x[np.searchsorted(ids, tree[c].to_numpy(np.int64))] for c in ("id", "other")), kind)
        return tree

    edges = pairs.repartition(max(1, n * (n - 1) // 2), "_i", "_j").groupBy("_i", "_j").applyInPandas(local, "id bigint, other bigint, distance double")

    def kept(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["id", "other"]).sort_values(["distance", "id", "other"])
        forest = Forest()
        keep = [forest.join(a, b) for a, b in zip(pdf["id"].tolist(), pdf["other"].tolist())]
        return pdf[keep]

    parts = max(1, n * (n - 1) // 2)
    edges = edges.withColumn("g", F.pmod(F.xxhash64("id", "other"), F.lit(parts)))
    while parts > 1:
        parts = -(-parts // fan)
        edges = edges.withColumn("g", F.pmod("g", F.lit(parts)))
        edges = edges.groupBy("g").applyInPandas(kept, edges.select("id", "other", "distance", "g").schema)
    return materialise(edges.select("id", "other", "distance"))


def single_clusters(pts: DataFrame, n_clusters: int, kind: str = "euclidean") -> DataFrame:
    """id, prediction of single linkage cut into n_clusters: the tree without its n_clusters - 1 longest edges. Any size."""
    tree = spanning_tree(pts, kind)
    longest = tree.orderBy(F.desc("distance"), F.desc("id"), F.desc("other")).limit(max(0, n_clusters - 1)).select("id", "other")
    comp = components(pts, tree.join(longest, ["id", "other"], "left_anti"))
    return comp.join(numbered(comp, "component", "prediction"), "component").select("id", "prediction")


def merge_list(d: np.ndarray, method: str) -> list[tuple[int, int, float, int]]:
    """Merges (left, right, distance, size) in order of distance; clusters are numbered n, n+1, ... as they arise."""
    return numbered_merges(chained(d.copy(), method, np.ones(len(d))), len(d))


def chained(d: np.ndarray, method: str, size: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (first row, first row, distance) of clusters of the given sizes, in no order; d is overwritten.

    Nearest-neighbour chains over one distance matrix, with the
    Lance-Williams update of average or single linkage.
    """
    n = len(d)
    np.fill_diagonal(d, np.inf)
    alive = np.ones(n, bool)
    raw: list[tuple[int, int, float]] = []
    chain: list[int] = []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            a = chain[-1]
            row = np.where(alive, d[a], np.inf)
            b = int(row.argmin())
            if len(chain) > 1 and row[chain[-2]] <= row[b]:
                b = chain[-2]
            if len(chain) > 1 and b == chain[-2]:
                break
            chain.append(b)
        chain = chain[:-2]
        a, b = min(a, b), max(a, b)
        raw.append((a, b, float(d[a, b])))
        new = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b]) if method == "average" else np.minimum(d[a], d[b])
        d[a], d[:, a] = new, new
        d[a, a] = np.inf
        size[a] += size[b]
        alive[b] = False
    return raw


# Clusters a leaf, point pairs that are worked out at once, clusters that are joined over a matrix.
LEAF, PAIRS, FEW = 256, 1 << 20, 4000


class _Means:
    """Clusters of the rows of x with their mean distances, in memory by the row: a cluster has the number of its first row.

    The distance of the means is at most the mean distance, the root of the
    mean square at least: only pairs between those bounds are added up. Mean
    cosine distances follow from the means of the unit vectors alone.
    """

    def __init__(self, x: np.ndarray, kind: str):
        if kind == "cosine":
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
        elif kind in ("euclidean", "cityblock"):
            x = x - x.mean(0)
        else:
            raise ValueError(f"unknown distance {kind!r}")
        self.x, self.kind, n = x, kind, len(x)
        self.size, self.mean = np.ones(n), x.copy()
        self.spread = np.zeros_like(x)  # mean square about the mean, by column
        if kind == "cosine":
            self.spread[:, :1] = 1 - (x**2).sum(1, keepdims=True)  # a zero vector is at 1 from all
            self.spread = np.maximum(self.spread, 0)
        self.of, self.known = np.arange(n), {}
        self.place()

    def place(self) -> None:
        """Rows in the order of their clusters, after merges."""
        self.order = np.argsort(self.of, kind="stable")
        self.alive = np.flatnonzero(self.of == np.arange(len(self.x)))
        self.start = np.zeros(len(self.x), np.int64)
        self.start[self.alive] = np.searchsorted(self.of[self.order], self.alive)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        """Clusters b go into clusters a."""
        na, nb = self.size[a][:, None], self.size[b][:, None]
        gap = self.mean[a] - self.mean[b]
        self.spread[a] = (na * self.spread[a] + nb * self.spread[b]) / (na + nb) + na * nb / (na + nb) ** 2 * gap**2
        self.mean[a] = (na * self.mean[a] + nb * self.mean[b]) / (na + nb)
        self.size[a] += self.size[b]
        to = np.arange(len(self.x))
        to[b] = a
        self.of = to[self.of]
        gone = {*a.tolist(), *b.tolist()}
        self.known = {k: v for k, v in self.known.items() if k[0] not in gone and k[1] not in gone}
        self.place()

    def exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Mean distances of pairs of clusters, the same either way round."""
        a, b = np.minimum(a, b), np.maximum(a, b)
        if self.kind == "cosine":
            return (((self.mean[a] - self.mean[b]) ** 2).sum(1) + self.spread[a].sum(1) + self.spread[b].sum(1)) / 2
        out, n = np.zeros(len(a)), (self.size[a] * self.size[b]).astype(np.int64)
        for k in np.flatnonzero(n > PAIRS // 16):
            key = (int(a[k]), int(b[k]))
            if key not in self.known:
                self.known[key] = self.total(*key) / n[k]
            out[k] = self.known[key]
        small = np.flatnonzero(n <= PAIRS // 16)
        group = (np.cumsum(n[small]) - 1) // PAIRS if len(small) else small
        for at in np.split(small, np.flatnonzero(np.diff(group)) + 1) if len(small) else []:
            first = np.cumsum(n[at]) - n[at]
            i = np.arange(n[at].sum()) - np.repeat(first, n[at])
            wide = np.repeat(self.size[b[at]].astype(np.int64), n[at])
            p = self.order[np.repeat(self.start[a[at]], n[at]) + i // wide]
            q = self.order[np.repeat(self.start[b[at]], n[at]) + i % wide]
            out[at] = np.add.reduceat(exactly(self.x[p], self.x[q], self.kind), first) / n[at]
        return out

    def total(self, a: int, b: int) -> float:
        x, y = (self.x[self.order[self.start[c] : self.start[c] + int(self.size[c])]] for c in (a, b))
        if self.kind == "cityblock":  # by columns: places in the sorted values and their sums
            out = 0.0
            for c in range(x.shape[1]):
                v = np.sort(y[:, c])
                upto = np.r_[0.0, np.cumsum(v)]
                k = np.searchsorted(v, x[:, c])
                out += float((x[:, c] * (2 * k - len(v)) + upto[-1] - 2 * upto[k]).sum())
            return out
        step = max(1, PAIRS // len(y))
        return sum(float(matrix(x[i : i + step], y).sum()) for i in range(0, len(x), step))

    def between(self) -> np.ndarray:
        """Mean distances of all clusters: one pass over the pairs of rows, which are added up by cluster."""
        k = len(self.alive)
        if self.kind == "cosine":
            m, s = self.mean[self.alive], self.spread[self.alive].sum(1)
            return (matrix(m, m) ** 2 + s[:, None] + s) / 2
        x, first = np.ascontiguousarray(self.x[self.order].T), self.start[self.alive]
        owner = np.repeat(np.arange(k), self.size[self.alive].astype(np.int64))
        out = np.zeros((k, k))
        at, n = 0, len(self.x)
        while at < n:
            c = owner[at]  # columns before this cluster were met from their own rows
            rows = slice(at, at + max(1, PAIRS // 16 // (n - first[c])))
            total = None
            for v in x:
                d = v[rows, None] - v[first[c] :]
                np.abs(d, out=d) if self.kind == "cityblock" else np.multiply(d, d, out=d)
                total = d if total is None else np.add(total, d, out=total)
            total = total if self.kind == "cityblock" else np.sqrt(total, out=total)
            sums = np.add.reduceat(total, first[c:] - first[c], axis=1)
            top = np.flatnonzero(np.r_[True, owner[rows][1:] != owner[rows][:-1]])
            out[owner[rows][top], c:] += np.add.reduceat(sums, top, axis=0)
            at = rows.stop
        out = np.triu(out, 1)
        out += out.T
        out /= self.size[self.alive]
        out /= self.size[self.alive][:, None]
        return out

    def nearest(self, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest other cluster of each, a tie to the lowest, and its distance."""
        leaves = [self.alive[i] for i in halves(self.mean[self.alive], LEAF)[0]]
        low, high = np.stack([self.mean[i].min(0) for i in leaves]), np.stack([self.mean[i].max(0) for i in leaves])
        wanted = np.zeros(len(self.x), bool)
        wanted[need] = True
        near, dist = np.zeros(len(self.x), np.int64), np.full(len(self.x), np.inf)
        block = self.kind == "cityblock"
        for leaf in leaves:
            rows = leaf[wanted[leaf]]
            if not len(rows):
                continue
            m, s = self.mean[rows], self.spread[rows]
            gap = np.maximum(np.maximum(low - m.max(0), m.min(0) - high), 0)
            gap = gap.sum(1) if block else np.sqrt((gap**2).sum(1))
            upper, first, held = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64), []
            order = np.argsort(gap, kind="stable")
            at, most = 0, 1
            while at < len(order) and gap[order[at]] <= upper.max() * (1 + 1e-9):
                other = np.concatenate([leaves[k] for k in order[at : at + most]])
                at, most = at + most, 2
                lower, d = np.zeros((len(rows), len(other))), np.empty((len(rows), len(other)))
                for c in range(m.shape[1]):
                    np.subtract(m[:, c, None], self.mean[other, c], out=d)
                    np.abs(d, out=d) if block else np.multiply(d, d, out=d)
                    lower += d
                if block:  # the mean distance from the mean is at most the deviation, by column
                    over = lower + np.sqrt(s).sum(1)[:, None] + np.sqrt(self.spread[other]).sum(1)
                else:
                    over = np.sqrt(lower + s.sum(1)[:, None] + self.spread[other].sum(1))
                    lower = over if self.kind == "cosine" else np.sqrt(lower)
                over[rows[:, None] == other[None]] = np.inf
                j = over.argmin(1)
                least = over[np.arange(len(rows)), j]
                better = least < upper
                upper[better], first[better] = least[better], other[j[better]]
                i, j = np.nonzero((lower <= upper[:, None] * (1 + 1e-9) + 1e-12) & (over < np.inf))
                held.append((i, other[j], lower[i, j]))
            i, j, lower = (np.concatenate(c) for c in zip(*held))
            d0 = self.exact(rows, first)
            ok = (lower <= d0[i] * (1 + 1e-9) + 1e-12) if self.kind != "cosine" else lower <= upper[i] * (1 + 1e-9) + 1e-12
            i, j = i[ok], j[ok]
            d = self.exact(rows[i], j)
            by = np.lexsort((j, d, i))
            i, j, d = i[by], j[by], d[by]
            top = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            near[rows[i[top]]], dist[rows[i[top]]] = j[top], d[top]
        return near[need], dist[need]


def average_merges(x: np.ndarray, kind: str = "euclidean") -> list[tuple[int, int, float, int]]:
    """merge_list of average linkage for any number of points: over a distance matrix up to CAP of them, else first in rounds.

    In a round all clusters that are each other's nearest are joined: a mean
    is no nearer than the nearer of its parts, so the order doesn't matter, and
    only clusters whose nearest went into another look for a new one. When FEW
    clusters are left, their mean distances are worked out in one pass and
    joined over that matrix. Memory is linear, work at most quadratic.
    """
    if len(x) <= CAP:
        return merge_list(matrix(x, x, kind), "average")
    c, raw = _Means(x, kind), []
    near, dist = np.zeros(len(x), np.int64), np.zeros(len(x))
    need = c.alive
    while len(c.alive) > min(CAP, FEW):
        near[need], dist[need] = c.nearest(need)
        live = c.alive
        a = live[(near[near[live]] == live) & (live < near[live])]
        if not len(a):  # equal but for rounding: the nearest of all
            k = live[dist[live].argmin()]
            near[near[k]] = k
            a = np.array([min(k, near[k])])
        b = near[a]
        raw += zip(a.tolist(), b.tolist(), np.minimum(dist[a], dist[b]).tolist())
        c.merge(a, b)
        moved = np.zeros(len(x), bool)
        moved[a] = moved[b] = True
        need = c.alive[moved[c.alive] | moved[near[c.alive]]]
    rest = chained(c.between(), "average", c.size[c.alive])
    raw += [(int(c.alive[a]), int(c.alive[b]), d) for a, b, d in rest]
    return numbered_merges(raw, len(x))


def numbered_merges(raw: list[tuple[int, int, float]], n: int) -> list[tuple[int, int, float, int]]:
    """Pairs of leaves in any order -> merges in order of distance, with the numbers and sizes of the clusters they join."""
    forest, ident, count = Forest(), list(range(n)), [1] * n
    out = []
    for step, (a, b, dist) in enumerate(sorted(raw, key=lambda m: m[2])):
        x, y = forest.root(a), forest.root(b)
        left, right = sorted((ident[x], ident[y]))
        forest.join(x, y)
        top = forest.root(x)
        count[top] = count[x] + count[y]
        ident[top] = n + step
        out.append((left, right, dist, count[top]))
    return out


def cut(merges: list[tuple[int, int, float, int]], n: int, threshold: float | None = None, n_clusters: int | None = None) -> np.ndarray:
    """Labels of the n leaves, numbered by smallest leaf: merges at or over the threshold, or the last n_clusters - 1, are not done."""
    done = sum(m[2] < threshold for m in merges) if threshold is not None else min(len(merges), max(0, n - n_clusters))
    top = np.arange(n + done)
    for step in range(done - 1, -1, -1):
        top[list(merges[step][:2])] = top[n + step]
    _, first, group = np.unique(top[:n], return_index=True, return_inverse=True)
    return np.argsort(np.argsort(first))[group].astype(np.int64)


def _whole(pts: DataFrame, run, schema: str) -> DataFrame:
    return pts.select("id", "features", F.lit(0).alias("_all")).groupBy("_all").applyInPandas(lambda pdf: run(pdf.sort_values("id").reset_index(drop=True)), schema)


def linkage(pts: DataFrame, method: str = "average", kind: str = "euclidean") -> DataFrame:
    """step, left, right, distance, size: the merge table; leaves are numbered by id order.

    Single linkage takes any number of points: its merges are the edges of the
    spanning tree in order, a task that holds an edge a point. Average linkage
    is a task that holds the points.
    """
    if method == "single":
        leaf = ranks(pts.select("id"), [], ["id"], "i")
        tree = spanning_tree(pts, kind).join(leaf.select("id", "i"), "id").join(leaf.select(F.col("id").alias("other"), F.col("i").alias("j")), "other")

        def order(pdf: pd.DataFrame) -> pd.DataFrame:
            rows = pdf.sort_values(["distance", "i", "j"])[["i", "j", "distance"]].itertuples(index=False, name=None)
            m = pd.DataFrame(numbered_merges(list(rows), len(pdf) + 1), columns=["left", "right", "distance", "size"])
            m.insert(0, "step", range(len(m)))
            return m

        return tree.select("i", "j", "distance", F.lit(0).alias("_all")).groupBy("_all").applyInPandas(order, "step bigint, left bigint, right bigint, distance double, size bigint")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = stacked(pdf)
        m = pd.DataFrame(average_merges(x, kind), columns=["left", "right", "distance", "size"])
        m.insert(0, "step", range(len(m)))
        return m

    return _whole(pts, run, "step bigint, left bigint, right bigint, distance double, size bigint")


def cut_labels(pts: DataFrame, method: str, kind: str, at: list[dict]) -> DataFrame:
    """id, labels: an array with the cluster of each cut ({"threshold": t} or {"n_clusters": n}) of one clustering, worked out once in a task that holds the points, or an edge a point."""

    def cut_all(ids: pd.Series, merges: list) -> pd.DataFrame:
        each = [cut(merges, len(ids), c.get("threshold"), c.get("n_clusters")) for c in at]
        return pd.DataFrame({"id": ids.to_numpy(), "labels": list(np.stack(each, 1))})

    schema = "id bigint, labels array<bigint>"
    if method == "single":

        def run(ids: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
            leaves = ids["id"].sort_values()
            i, j = (np.searchsorted(leaves, tree[c]).tolist() for c in ("id", "other"))
            return cut_all(leaves, numbered_merges(sorted(zip(i, j, tree["distance"].tolist()), key=lambda m: (m[2], m[0], m[1])), len(leaves)))

        one = F.lit(0).alias("_all")
        return pts.select("id", one).groupBy("_all").cogroup(spanning_tree(pts, kind).select("*", one).groupBy("_all")).applyInPandas(run, schema)
    return _whole(pts, lambda pdf: cut_all(pdf["id"], average_merges(stacked(pdf), kind)), schema)


def cuts(pts: DataFrame, method: str, kind: str, at: list[dict]) -> DataFrame:
    """run, id, prediction for each cut of cut_labels."""
    return cut_labels(pts, method, kind, at).select("id", F.posexplode("labels").alias("run", "prediction")).select(F.col("run").cast("bigint").alias("run"), "id", "prediction")


def agglomerative(pts: DataFrame, method: str = "average", kind: str = "euclidean", threshold: float | None = None, n_clusters: int | None = None) -> DataFrame:
    """id, prediction. Single linkage takes any number of points in blocks; average linkage is a task that holds the points."""
    if (threshold is None) == (n_clusters is None):
        raise ValueError("give threshold or n_clusters")
    if method == "single":
        return single_threshold(pts, threshold, kind) if threshold is not None else single_clusters(pts, n_clusters, kind)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = stacked(pdf)
        return pd.DataFrame({"id": pdf["id"], "prediction": cut(average_merges(x, kind), len(pdf), threshold, n_clusters)})

    return _whole(pts, run, "id bigint, prediction bigint")
