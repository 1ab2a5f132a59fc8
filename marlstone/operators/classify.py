"""Classifiers over (id, features array<double>, label): own where semantics differ, MLlib where they agree."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import classification as ml
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marlstone.operators import forest as grown
from marlstone.operators.distance import exactly, stacked
from marlstone.session import materialise, release, row_by_row, tidy

Predict = Callable[[DataFrame], DataFrame]


# Training rows a cell of k-NN, rows a leaf in it, rows a cell of the sample that places the cuts.
CELL, LEAF, PLACED = 50_000, 256, 200
ASKED = 1 << 18  # test rows of a task of k-NN, at least a cell's
MOST = 512 << 20  # bytes of binned training rows that a task of the forest holds


def halves(x: np.ndarray, most: int, depth: int = 64) -> tuple[list[np.ndarray], list]:
    """Row numbers of x in leaves of at most ``most``, halved at the median of the widest column, and the cuts: leaf number or (column, value, left, right)."""
    leaves: list[np.ndarray] = []

    def down(at: np.ndarray, left: int):
        if len(at) > most and left:
            low, high = x[at].min(0), x[at].max(0)
            c = int((high - low).argmax())
            v = float(np.median(x[at, c]))
            v = v if v < high[c] else float(np.nextafter(high[c], -np.inf))  # most rows may have the largest value
            under = x[at, c] <= v
            if under.any() and not under.all():
                return (c, v, down(at[under], left - 1), down(at[~under], left - 1))
        leaves.append(at)
        return len(leaves) - 1

    return leaves, down(np.arange(len(x)), depth)


def cell_of(x: np.ndarray, cuts) -> np.ndarray:
    """Number of the leaf of each row, by the cuts of halves()."""
    out = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), cuts)]
    while todo:
        at, cut = todo.pop()
        if isinstance(cut, int):
            out[at] = cut
        elif len(at):
            under = x[at, cut[0]] <= cut[1]
            todo += [(at[under], cut[2]), (at[~under], cut[3])]
    return out


def _apart(low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances of rows from boxes (rows x boxes)."""
    out = np.zeros((len(x), len(low)))
    for c in range(x.shape[1]):
        v = x[:, c, None]
        out += np.maximum(np.maximum(low[:, c] - v, v - high[:, c]), 0) ** 2
    return out


def nearest(x: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of x, row of y and distance of the k nearest y of each x within its bound, nearest first, ties by ids. Leaves beyond the k-th distance so far are left out."""
    own, _ = halves(y, LEAF)
    low, high = np.stack([y[o].min(0) for o in own]), np.stack([y[o].max(0) for o in own])
    mid = y.mean(0)
    parts = [(y[o] - mid, ((y[o] - mid) ** 2).sum(1)) for o in own]
    found = []
    for rows in halves(x, LEAF)[0]:
        t = x[rows] - mid
        tt = (t**2).sum(1)
        slack = lambda b: b * (1 + 1e-6) + 1e-9 * (1 + tt)  # noqa: E731 - the product picks, the differences decide
        limit = bound[rows] ** 2
        best = np.full((len(rows), k), np.inf)
        box = (np.maximum(np.maximum(low - x[rows].max(0), x[rows].min(0) - high), 0) ** 2).sum(1)
        hits, order = [], np.argsort(box, kind="stable")
        for first in range(0, len(order), 64):
            group = order[first : first + 64]
            if box[group[0]] > slack(limit).max():
                break
            off = _apart(low[group], high[group], x[rows])
            for g, leaf in enumerate(group):
                at = np.flatnonzero(off[:, g] <= slack(limit))
                if not len(at):
                    continue
                z, zz = parts[leaf]
                d = tt[at, None] + zz - 2 * (t[at] @ z.T)
                near = d <= slack(limit)[at, None]
                some = near.any(1)
                if not some.any():
                    continue
                at, d = at[some], d[some]
                best[at] = np.partition(np.hstack([best[at], d]), k - 1, axis=1)[:, :k]
                limit[at] = np.minimum(limit[at], np.maximum(best[at, k - 1], 0))
                i, j = np.nonzero(d <= slack(limit)[at, None])
                hits.append((at[i], own[leaf][j], d[i, j]))
        if hits:
            i, j, d = (np.concatenate(c) for c in zip(*hits))
            ok = d <= slack(limit)[i]
            i, j = rows[i[ok]], j[ok]
            d = exactly(x[i], y[j])
            by = np.lexsort((ids[j], d, i))
            i, j, d = i[by], j[by], d[by]
            start = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            place = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)]))
            keep = place < k
            found.append((i[keep], j[keep], d[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found))


def _packs(batches, names: list[str], code: bool):
    """A row a batch and cell: ids, columns (one after the other) and class numbers as bytes; a shuffle moves a fraction of the rows' own bytes."""
    for pdf in batches:
        for c, g in pdf.groupby("cell"):
            y = g["code"].to_numpy(np.int32).tobytes() if code else b""
            yield pd.DataFrame({"cell": [c], "ids": [g["id"].to_numpy(np.int64).tobytes()], "x": [g[names].to_numpy(float).T.tobytes()], "y": [y]})


def _unpacked(pdf: pd.DataFrame, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (rows x columns), ids and class numbers of packs."""
    ids = [np.frombuffer(b, np.int64) for b in pdf["ids"]]
    x = [np.frombuffer(b).reshape(d, len(i)).T for b, i in zip(pdf["x"], ids)]
    return np.concatenate([np.zeros((0, d)), *x]), np.concatenate([np.zeros(0, np.int64), *ids]), np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(b, np.int32) for b in pdf["y"])])


class Best:
    """The k nearest so far of rows x: distances, ids and class numbers, nearest first, ties by ids."""

    def __init__(self, x: np.ndarray, k: int):
        self.x, self.k = x, k
        self.d, self.ids, self.y = np.full((len(x), k), np.inf), np.full((len(x), k), np.iinfo(np.int64).max), np.full((len(x), k), -1, np.int32)

    def meet(self, at: np.ndarray, x: np.ndarray, ids: np.ndarray, y: np.ndarray) -> None:
        """Rows number ``at`` meet training rows."""
        if not len(at) or not len(x):
            return
        i, j, d = nearest(self.x[at], x, ids, self.k, self.d[at, -1])
        start = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
        rows = at[i[start]]
        own, place = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(i)])), np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)]))
        both = []
        for old, new, none in ((self.d, d, np.inf), (self.ids, ids[j], np.iinfo(np.int64).max), (self.y, y[j], -1)):
            more = np.full((len(rows), self.k), none, old.dtype)
            more[own, place] = new
            both.append(np.hstack([old[rows], more]))
        by = np.lexsort((both[1], both[0]), axis=1)[:, : self.k]
        self.d[rows], self.ids[rows], self.y[rows] = (np.take_along_axis(v, by, 1) for v in both)

    def codes(self, classes: int) -> np.ndarray:
        """Commonest class of each row, the lower of a tie; -1: no neighbour."""
        n = np.stack([(self.y == c).sum(1) for c in range(classes)], 1)
        return np.where(n.any(1), n.argmax(1), -1)


def knn(train: DataFrame, k: int = 5, cell: int = CELL, asked: int = ASKED) -> Predict:
    """Majority of the k nearest (ties in distance to the lower id, in votes to the lower label).

    Exact: the training rows are cut into cells of about ``cell`` rows, the
    cuts placed by a sample. A test row is compared with its own cell first,
    then with the cells whose box is no farther than its k-th distance there.
    For the latter a task takes the test rows of neighbouring cells, ``asked``
    of them at most, and reads through all cells: no row is sent about twice.
    """
    whole = lambda df: df.where(F.forall("features", lambda v: v.isNotNull() & ~F.isnan(v)))
    kind = train.schema["label"].dataType.simpleString()

    def predict(test: DataFrame) -> DataFrame:
        n, d = whole(train).agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
        if not n:
            return test.where(F.lit(False)).withColumn("prediction", F.lit(None).cast(kind))
        n_cells = -(-n // cell)
        sample = []
        if n_cells > 1:
            share = min(1.0, n_cells * PLACED / n)
            sample = [r["features"] for r in whole(train).where(F.pmod(F.xxhash64("id", F.lit("cut")), F.lit(1 << 20)) < share * (1 << 20)).select("features").collect()]  # PLACED rows a cell
        x = np.asarray(sample, float)
        cuts = halves(x, max(1, -(-len(x) // n_cells)))[1] if len(x) else 0

        spark, names = test.sparkSession, [f"f{j}" for j in range(d)]
        wide = [F.col("features")[j].alias(f"f{j}") for j in range(d)]
        labels = sorted((r["label"] for r in train.select("label").distinct().collect()), key=lambda v: (v is not None, v))
        code = F.coalesce(F.array_position(F.array(*(F.lit(v) for v in labels if v is not None)).cast(f"array<{kind}>"), F.col("label")), F.lit(0)).cast("int") - (0 if None in labels else 1)
        pack = "cell bigint, ids binary, x binary, y binary"

        def packed(df: DataFrame, code: Column | None = None) -> DataFrame:
            """Placed in cells and packed in one go: another Python process a task would hold its memory."""

            coded, more = code is not None, [] if code is None else [code.alias("code")]

            def run(batches):
                for pdf in batches:
                    if len(pdf):
                        yield from _packs([pdf.assign(cell=cell_of(pdf[names].to_numpy(float), cuts))], names, coded)

            return whole(df).select(F.coalesce("id", F.lit(-(1 << 63))).alias("id"), *more, *wide).mapInPandas(run, pack)

        fit, ask = packed(train, code), packed(test.where("id is not null"))
        voted = "id bigint, prediction " + kind

        def told(ids: np.ndarray, best: Best) -> pd.DataFrame:
            c = best.codes(len(labels))
            return pd.DataFrame({"id": ids[c >= 0], "prediction": [labels[v] for v in c[c >= 0]]})

        def first(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, Best]:
            (x, ids, _), theirs = _unpacked(a, len(names)), _unpacked(b, len(names))
            best = Best(x, k)
            best.meet(np.arange(len(x)), *theirs)
            return ids, best

        met = lambda fit, f, schema: ask.groupBy("cell").cogroup(fit.groupBy("cell")).applyInPandas(f, schema)
        if n_cells == 1:
            return test.join(met(fit, lambda a, b: told(*first(a, b)), voted), "id")

        def gathered(pdf: pd.DataFrame) -> pd.DataFrame:
            x, ids, y = _unpacked(pdf, len(names))
            parts = [slice(p, p + CELL) for p in range(0, len(x), CELL)]  # a cell of equal rows may be large
            return pd.DataFrame({"cell": pdf["cell"].iloc[0], "ids": [ids[p].tobytes() for p in parts], "x": [x[p].T.tobytes() for p in parts], "y": [y[p].tobytes() for p in parts]})

        def own(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a):
                return pd.DataFrame(columns=["cell", "n", "ids", "x", "y", "d", "others"])
            ids, best = first(a, b)
            parts = [slice(p, p + CELL) for p in range(0, len(ids), CELL)]
            cells = {"ids": ids, "x": best.x, "y": best.y, "d": best.d, "others": best.ids}
            return pd.DataFrame({"cell": a["cell"].iloc[0], "n": [len(ids[p]) for p in parts]} | {c: [(v[p].T if c == "x" else v[p]).tobytes() for p in parts] for c, v in cells.items()})

        fit = materialise(fit.groupBy("cell").applyInPandas(gathered, pack))
        asks = materialise(met(fit, own, "cell bigint, n bigint, ids binary, x binary, y binary, d binary, others binary"))
        tidy(spark)  # the shuffle files of the first look
        held = asks.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()  # a row a cell
        most = min(asked, -(-sum(r["n"] for r in held) // (2 * spark.sparkContext.defaultParallelism)))
        task_of, tasks = {}, [0]
        for r in held:  # neighbouring cells have numbers nearby
            if tasks[-1] and tasks[-1] + r["n"] > most:
                tasks.append(0)
            task_of[r["cell"]] = len(tasks) - 1
            tasks[-1] += r["n"]

        def rest(batches):
            mine, task, waiting = [], None, []
            state: list = []

            def meet(cell, ids, x, y):
                best, _, cells = state
                ids, y = np.frombuffer(ids, np.int64), np.frombuffer(y, np.int32)
                x = np.frombuffer(x).reshape(d, len(ids)).T
                near = _apart(x.min(0)[None], x.max(0)[None], best.x)[:, 0] <= best.d[:, -1] ** 2 * (1 + 1e-6) + 1e-9
                best.meet(np.flatnonzero(near & (cells != cell)), x, ids, y)

            for b in batches:
                for r in b.to_pylist():
                    task = r["task"]
                    if r["n"] is None:
                        row = (r["cell"], r["ids"], r["x"], r["y"])
                        meet(*row) if state else waiting.append(row)
                        continue
                    mine.append(r)
                    if sum(m["n"] for m in mine) == tasks[task]:  # all are here, mostly before any training row
                        x = np.concatenate([np.frombuffer(m["x"]).reshape(d, m["n"]).T for m in mine])
                        best = Best(x, k)
                        for name, at, kind_ in (("d", "d", float), ("ids", "others", np.int64), ("y", "y", np.int32)):
                            setattr(best, name, np.concatenate([np.frombuffer(m[at], kind_).reshape(-1, k) for m in mine]))
                        state += [best, np.concatenate([np.frombuffer(m["ids"], np.int64) for m in mine]), np.repeat([m["cell"] for m in mine], [m["n"] for m in mine])]
                        mine = [{"n": tasks[task]}]
                        for row in waiting:
                            meet(*row)
                        waiting = []
            if state:
                import pyarrow as pa

                yield pa.RecordBatch.from_pandas(told(state[1], state[0]), preserve_index=False)

        of = spark.createDataFrame([*task_of.items()], "cell bigint, of int")
        mine = asks.join(F.broadcast(of), "cell")
        blocks = mine.unionByName(fit, allowMissingColumns=True).coalesce(1).hint("shuffle_replicate_nl")
        each = spark.range(len(tasks), numPartitions=len(tasks)).select(F.col("id").cast("int").alias("task"))
        dealt = blocks.crossJoin(each).where("of is null or of = task").drop("of")
        with row_by_row(spark):
            best = materialise(dealt.mapInArrow(rest, voted))
        release(asks)
        release(fit)
        return test.join(best, "id")

    return predict


def gaussian_nb(train: DataFrame, smoothing: float = 1e-9) -> Predict:
    """Gaussian naive Bayes: moments by class in one groupBy; scoring is a projection over literals."""
    d = train.select(F.size("features")).first()[0]
    x = [F.col("features")[j] for j in range(d)]
    rows = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(f"m{j}") for j, c in enumerate(x)), *(F.var_pop(c).alias(f"v{j}") for j, c in enumerate(x))).orderBy("label").collect()
    top = max(train.agg(*(F.var_pop(c) for c in x)).first())
    total = sum(r["n"] for r in rows)
    each = []
    for r in rows:
        score = F.lit(math.log(r["n"] / total))
        for j, c in enumerate(x):
            v = r[f"v{j}"] + smoothing * top
            score = score - 0.5 * math.log(2 * math.pi * v) - (c - F.lit(r[f"m{j}"])) * (c - F.lit(r[f"m{j}"])) / (2 * v)
        each.append(score)
    names = F.array(*(F.lit(r["label"]) for r in rows))

    def predict(test: DataFrame) -> DataFrame:
        s = test.withColumn("_s", F.array(*each))
        return s.withColumn("prediction", F.element_at(names, F.array_position("_s", F.array_max("_s")).cast("int"))).drop("_s")

    return predict


def _mllib(train: DataFrame, make: Callable[[int], object]) -> Predict:
    index = StringIndexer(inputCol="label", outputCol="_y", stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
    vec = lambda df: index.transform(df.withColumn("_v", array_to_vector("features")))
    model = make(train.count()).fit(vec(train))  # MLlib keeps the rows in its own form; a copy here would fall to the disk
    names = F.array(*(F.lit(x) for x in index.labels))
    drop = ["_y", "_v", "_p", "_raw", "_prob"]

    def predict(test: DataFrame) -> DataFrame:
        p = model.transform(test.withColumn("_v", array_to_vector("features")))
        return p.withColumn("prediction", F.element_at(names, F.col("_p").cast("int") + 1)).drop(*drop)

    return predict


_IO = {"featuresCol": "_v", "labelCol": "_y", "predictionCol": "_p"}
_PROB = {"rawPredictionCol": "_raw", "probabilityCol": "_prob"}


def logistic(train: DataFrame, c: float = 1.0, max_iter: int = 1000) -> Predict:
    """Multinomial, L2 with summed-loss strength c."""
    return _mllib(train, lambda n: ml.LogisticRegression(family="multinomial", maxIter=max_iter, elasticNetParam=0.0, regParam=1 / (c * max(n, 1)), standardization=False, **_IO, **_PROB))


def logistic_ovr(train: DataFrame, c: float = 1.0, max_iter: int = 100) -> Predict:
    """One against the rest, L2; the intercept is not penalised."""
    base = lambda n: ml.LogisticRegression(maxIter=max_iter, elasticNetParam=0.0, regParam=1 / (c * max(n, 1)), standardization=False, featuresCol="_v", rawPredictionCol="_raw")
    return _mllib(train, lambda n: ml.OneVsRest(classifier=base(n), rawPredictionCol="_raw", **_IO))


def _summed(df: DataFrame, part: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of part(features, class numbers, buckets) over batches of (features, code, bucket); a row a partition comes to the driver."""

    def run(batches):
        import pyarrow as pa

        total = None
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                one = part(x, b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

    rows = df.select("features", "code", "bucket").mapInArrow(run, "s array<double>").collect()
    return np.sum([np.asarray(r["s"]) for r in rows], axis=0)


def _ovr_many(df: DataFrame, include: np.ndarray, classes: int, c: float = 1.0, max_iter: int = 100) -> np.ndarray:
    """Weights (fits x classes x features and intercept) of logistic_ovr's objective on many parts of one table, in common passes.

    df: features, code, bucket; include (fits x buckets): which rows a fit has.
    Newton's method on all models at once; a step that raises a model's loss is
    halved. A class that a fit lacks has the intercept -inf.
    """
    d = df.select(F.size("features")).first()[0]
    x = [F.col("features")[j] for j in range(d)]
    m = df.agg(*(F.avg(v) for v in x), *(F.stddev_pop(v) for v in x)).first()
    mean, scale = np.array(m[:d]), np.array([v or 1.0 for v in m[d:]])
    n = np.zeros((include.shape[1], classes))
    for r in df.groupBy("bucket", "code").count().collect():
        n[r["bucket"], r["code"]] = r["count"]
    n = include @ n
    if not n.sum(1).all():
        raise ValueError("a fit has no rows")
    whole = n == n.sum(1, keepdims=True)
    models = [tuple(m) for m in np.argwhere((n > 0) & ~whole)]
    up = np.triu_indices(d + 1)
    penalty = np.r_[1 / (c * scale**2), 0.0]
    w, step, loss = np.zeros((len(models), d + 1)), np.zeros((len(models), d + 1)), np.full(len(models), np.inf)
    grad, curve = np.zeros_like(w), np.zeros((len(models), d + 1, d + 1))
    live = np.arange(len(models))
    for _ in range(max_iter):
        if not len(live):
            break
        at, mine, theirs = w[live] + step[live], np.array([models[k][0] for k in live]), np.array([models[k][1] for k in live])

        def part(x: np.ndarray, code: np.ndarray, bucket: np.ndarray, at=at, mine=mine, theirs=theirs) -> np.ndarray:
            z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
            inside, y = include[mine][:, bucket].T.astype(float), code[:, None] == theirs
            t = z @ at.T
            e = np.exp(-np.abs(t))
            p = np.where(t >= 0, 1.0, e) / (1 + e)
            fall = (inside * (np.maximum(t, 0) - t * y + np.log1p(e))).sum(0)
            return np.hstack([fall[:, None], (inside * (p - y)).T @ z, (inside * p * (1 - p)).T @ (z[:, up[0]] * z[:, up[1]])])

        s = _summed(df, part).reshape(len(live), -1)
        done = []
        for i, k in enumerate(live):
            new = s[i, 0] + 0.5 * (penalty * at[i] ** 2).sum()
            if new <= loss[k] + 1e-9 * abs(new):
                settled = loss[k] - new <= 1e-9 * abs(new)
                w[k], loss[k], grad[k] = at[i], new, s[i, 1 : d + 2] + penalty * at[i]
                h = np.zeros((d + 1, d + 1))
                h[up] = s[i, d + 2 :]
                curve[k] = h + np.triu(h, 1).T + np.diag(penalty + 1e-12 * (1 + np.trace(h)))
                step[k] = -np.linalg.lstsq(curve[k], grad[k], rcond=None)[0]
                if settled:
                    done.append(k)
            else:
                step[k] = step[k] / 2
                if np.abs(step[k]).max() < 1e-9:
                    done.append(k)
        live = np.setdiff1d(live, done)
    out = np.zeros((*n.shape, d + 1))
    out[..., d] = np.where(whole, np.inf, -np.inf)
    for (f, k), v in zip(models, w):
        out[f, k, :d], out[f, k, d] = v[:d] / scale, v[d] - (v[:d] * mean / scale).sum()
    return out


def ovr_scores(df: DataFrame, fits: np.ndarray, tests: np.ndarray, c: float = 1.0, max_iter: int = 100) -> list[tuple[float, float]]:
    """Accuracy of logistic_ovr on its own rows and on its test rows, of many fits: df (features, label, bucket), fits and tests (fits x buckets)."""
    labels = sorted(r["label"] for r in df.select("label").distinct().collect())
    df = materialise(df.select("features", (F.array_position(F.array(*(F.lit(x) for x in labels)), F.col("label")) - 1).cast("int").alias("code"), "bucket"))
    w = _ovr_many(df, fits, len(labels), c, max_iter)

    def part(x: np.ndarray, code: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        out = []
        for f in range(len(w)):
            hit = (x @ w[f, :, :-1].T + w[f, :, -1]).argmax(1) == code
            a, b = fits[f, bucket], tests[f, bucket]
            out.append([hit[a].sum(), a.sum(), hit[b].sum(), b.sum()])
        return np.array(out, float)

    return [(a / b, p / q if q else None) for a, b, p, q in _summed(df, part).reshape(-1, 4).tolist()]


logistic_ovr.many = ovr_scores


def _cuts(train: DataFrame, d: int, bins: int) -> list[np.ndarray]:
    """Cuts of each feature: between all its values if they are no more than ``bins``, else at its quantiles over all rows."""
    x = [F.col("features")[j].cast("double") for j in range(d)]
    at = [k / bins for k in range(1, bins)]
    r = train.agg(*(F.percentile_approx(c, at, F.lit(1000)) for c in x), *(F.approx_count_distinct(c) for c in x)).first()
    few = [j for j in range(d) if r[d + j] <= 1.5 * bins]  # an estimate
    sets = dict(zip(few, train.agg(*(F.collect_set(x[j]) for j in few)).first())) if few else {}
    exact = {j: v for j, v in sets.items() if len(v) <= bins}
    return [grown.cuts_of(np.array(exact.get(j, r[j]) or [], float), bins) for j in range(d)]


def forest(train: DataFrame, trees: int = 100, max_depth: int = 30, seed: int = 42, bins: int = 32, most: int = MOST) -> Predict:
    """Mean class shares of trees on bootstraps, split by Gini impurity over ceil(sqrt(columns)) columns a node, on binned values.

    A task a core holds all rows, a byte a value and nine a row, and grows its
    share of the trees; these score the test rows where they are and go, so the
    driver never holds a tree. Rows of more than ``most`` bytes go to MLlib. A call of
    the returned function grows the trees.
    """
    larger = lambda n: ml.RandomForestClassifier(numTrees=trees, maxDepth=max_depth, maxMemoryInMB=1024, cacheNodeIds=True, featureSubsetStrategy="sqrt", seed=seed, **_IO, **_PROB)
    return _grown(train, trees, max_depth, seed, bins, most, larger)


def tree(train: DataFrame, max_depth: int = 30, seed: int = 42, bins: int = 255, most: int = MOST) -> Predict:
    """One tree on all rows, split by Gini impurity over all columns, on binned values; grown in one task, as those of the forest."""
    larger = lambda n: ml.DecisionTreeClassifier(maxDepth=max_depth, impurity="gini", maxMemoryInMB=1024, seed=seed, **_IO, **_PROB)
    return _grown(train, 1, max_depth, seed, bins, most, larger, single=True)


def _grown(train: DataFrame, trees: int, max_depth: int, seed: int, bins: int, most: int, larger: Callable[[int], object], single: bool = False) -> Predict:
    """forest, or with ``single`` a tree over all rows and columns; ``larger`` is MLlib's for rows of more than ``most`` bytes."""
    train = train.where("label is not null")
    n, d = train.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    if not n:
        raise ValueError("a fit has no rows")
    labels = sorted(r["label"] for r in train.select("label").distinct().collect())
    if n * (d + 9) > most or len(labels) > 255:
        return _mllib(train, larger)
    cuts = _cuts(train, d, bins)

    def packed(df: DataFrame, key: Column, code: Column) -> DataFrame:
        """A row a batch: first key, bins (column by column), keys and class numbers as bytes."""

        def run(batches):
            import pyarrow as pa

            for b in batches:
                if b.num_rows:
                    x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    cells = [grown.binned(x, cuts).tobytes(), b.column(1).to_numpy(zero_copy_only=False).tobytes(), b.column(2).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()]
                    yield pa.RecordBatch.from_arrays([b.column(1).slice(0, 1), *(pa.array([c], pa.binary()) for c in cells)], ["block", "x", "keys", "y"])

        return df.select(F.col("features").cast("array<double>"), key.cast("bigint"), code.cast("int")).mapInArrow(run, "block bigint, x binary, keys binary, y binary")

    def predict(test: DataFrame) -> DataFrame:
        spark = test.sparkSession
        groups = min(trees, spark.sparkContext.defaultParallelism)
        test = materialise(test.withColumn("_row", F.monotonically_increasing_id()))
        names = F.array(*(F.lit(x) for x in labels))
        fits = packed(train, F.xxhash64("id"), F.array_position(names, F.col("label")) - 1).withColumn("asked", F.lit(False))
        blocks = materialise(fits.unionByName(packed(test, F.col("_row"), F.lit(0)).withColumn("asked", F.lit(True))))

        def run(batches):
            import pyarrow as pa

            x, y, keys, at, asked, mine = np.empty((d, n), np.uint8), np.empty(n, np.uint8), np.empty(n, np.uint64), 0, [], None
            for b in batches:
                for r in range(b.num_rows):
                    block, cells, key, code, test_, mine = (c[r].as_py() for c in b.columns)
                    size = len(code)
                    rows = np.frombuffer(cells, np.uint8).reshape(d, size)
                    if test_:
                        asked.append((rows, block, key))
                        continue
                    x[:, at : at + size], y[at : at + size], keys[at : at + size] = rows, np.frombuffer(code, np.uint8), np.frombuffer(key, np.uint64)
                    at += size
            if mine is None or not asked:
                return
            if at != n:
                raise ValueError(f"{at} of {n} rows came")
            p = [np.zeros((rows.shape[1], len(labels)), np.float32) for rows, _, _ in asked]
            for t in range(mine, trees, groups):
                w = np.ones(n, np.uint8) if single else grown.bootstrap(keys, seed, t)
                tree = grown.grow(x, y, w, len(labels), bins, max_depth, np.random.default_rng([seed, t]), d if single else None)
                del w
                for q, (rows, _, _) in zip(p, asked):
                    q += grown.shares(tree, rows)
            for q, (_, block, key) in zip(p, asked):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([key], pa.binary()), pa.array([q.tobytes()], pa.binary())], ["block", "keys", "p"])

        def voted(pdf: pd.DataFrame) -> pd.DataFrame:
            p = sum(np.frombuffer(b, np.float32).astype(float) for b in pdf["p"]).reshape(-1, len(labels))
            return pd.DataFrame({"_row": np.frombuffer(pdf["keys"].dropna().iloc[0], np.int64), "code": np.round(p, 4).argmax(1)})  # the number of tasks decides no tie

        # Each task reads the blocks from their files: a shuffle would hold a copy a task.
        parts = spark.range(groups, numPartitions=groups).select(F.col("id").cast("int").alias("part"))
        dealt = blocks.coalesce(1).hint("shuffle_replicate_nl").crossJoin(parts)
        dealt = dealt.withColumn("keys", F.when(~F.col("asked") | (F.col("part") == 0), F.col("keys")))
        tidy(spark)  # the shuffle files of what comes before
        votes = dealt.select("block", "x", "keys", "y", "asked", "part").mapInArrow(run, "block bigint, keys binary, p binary")
        with row_by_row(spark):
            votes = materialise(votes)
        best = materialise(votes.groupBy("block").applyInPandas(voted, "_row bigint, code bigint"))
        release(blocks)
        return test.join(best, "_row").withColumn("prediction", F.element_at(names, F.col("code").cast("int") + 1)).drop("_row", "code")

    return predict


MODELS = {"knn": knn, "gaussian_nb": gaussian_nb, "logistic": logistic, "tree": tree, "forest": forest}
