"""Percentiles per group with a deterministic rank bound, from summaries that can be combined.

A summary is a set of sorted buffers of equal size k; a buffer of level l
stands for 2**l rows an element. Two buffers of one level collapse into one of
the next by taking every second element of their merged order, first and
second in turn. A collapse moves the rank of any value by at most the weight
of its inputs; the sum of these moves is carried along (``err``), so the bound
is exact for the summary at hand: about log2(n / k) / (2 k) of n.

Summaries are tables: those of a load or a day are written once, kept, and
combined with others later; percentiles are read from any combination. Tasks
merge what their own partition holds, then a tree with a bounded number of
summaries a merge takes over; groups of up to k values never leave the JVM on
the way, they are exact lists.

Defined results in odd cases
- null and NaN values are left out; a group with none of its own has no row;
- groups may be null: a null is a group of its own;
- up to k values a group the percentiles are exact (the value at rank
  ceil(p * n)); equal values keep their number;
- an empty table has no groups; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marlstone.session import materialise

PROBS = (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


GROUP_COST = 150  # values that take the room of an empty summary


class Buffers:
    """Summary of one stream of values."""

    __slots__ = ("k", "n", "err", "pending", "waiting", "levels", "turn")

    def __init__(self, k: int):
        self.k, self.n, self.err = k, 0, 0
        self.pending: list[np.ndarray] = []
        self.waiting = 0
        self.levels: dict[int, np.ndarray] = {}
        self.turn: dict[int, int] = {}

    def add(self, values: np.ndarray) -> None:
        """Values of weight one, in any order."""
        self.n += len(values)
        self._fill(values)

    def _fill(self, values: np.ndarray) -> None:
        self.pending.append(values)
        self.waiting += len(values)
        if self.waiting >= self.k:
            v = np.concatenate(self.pending)
            full = len(v) // self.k * self.k
            for chunk in v[:full].reshape(-1, self.k):
                self.push(0, np.sort(chunk))
            self.pending, self.waiting = ([v[full:]] if full < len(v) else []), len(v) - full

    def push(self, level: int, buffer: np.ndarray) -> None:
        while level in self.levels:
            both = np.sort(np.concatenate([self.levels.pop(level), buffer]), kind="stable")
            turn = self.turn.get(level, 0)
            self.turn[level] = 1 - turn
            buffer = both[turn::2]
            self.err += 1 << level
            level += 1
        self.levels[level] = buffer

    def merge(self, rows: Iterator[tuple[int, np.ndarray, int, int]]) -> None:
        """Rows of other summaries: level (-1: loose values), values, n, err."""
        for level, values, n, err in rows:
            self.n += n
            self.err += err
            if level < 0:
                self._fill(values)
            else:
                self.push(level, values)

    def rows(self) -> list[tuple[int, np.ndarray, int, int]]:
        out = [(lv, b, 0, 0) for lv, b in sorted(self.levels.items())]
        if self.waiting:
            out.append((-1, np.concatenate(self.pending), 0, 0))
        if out:
            out[0] = (*out[0][:2], self.n, self.err)
        return out

    def quantiles(self, probs: tuple[float, ...]) -> list[float]:
        parts = [(b, 1 << lv) for lv, b in self.levels.items()] + [(p, 1) for p in self.pending]
        v = np.concatenate([p for p, _ in parts])
        w = np.concatenate([np.full(len(p), x, np.int64) for p, x in parts])
        o = np.argsort(v, kind="stable")
        up = np.cumsum(w[o])
        at = np.searchsorted(up, [max(1, int(np.ceil(p * self.n - 1e-9))) for p in probs])
        return [float(x) for x in v[o][np.minimum(at, len(v) - 1)]]


def _types(df: DataFrame, cols: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


_SUMMARY = "metric string, level int, vals array<double>, n bigint, err bigint"


class _Held:
    """Summaries by group while a task reads its partition; given out and dropped once they hold ``most`` values, so the state is bounded."""

    def __init__(self, group: list[str], k: int, most: int):
        from pyspark import TaskContext

        self.group, self.k, self.most, self.part = group, k, most, TaskContext.get().partitionId()
        self.held: dict[tuple, Buffers] = {}
        self.load = 0

    def at(self, key: tuple, n: int) -> Buffers:
        b = self.held.get(key)
        if b is None:
            b = self.held[key] = Buffers(self.k)
            self.load += GROUP_COST
        self.load += n
        return b

    def out(self) -> Iterator[pd.DataFrame]:
        rows = [(*g[:-1], self.part, g[-1], lv, v, n, err) for g, b in self.held.items() for lv, v, n, err in b.rows()]
        self.held.clear()
        self.load = 0
        for i in range(0, len(rows), 2048):
            yield pd.DataFrame(rows[i : i + 2048], columns=[*self.group, "part", "metric", "level", "vals", "n", "err"]).astype({g: "object" for g in self.group})

    def full(self) -> bool:
        return self.load > self.most


def _keys(pdf: pd.DataFrame, group: list[str]) -> list[tuple]:
    cols = [[None if x is None or x != x else x for x in pdf[g].tolist()] for g in group]
    return list(zip(*cols))


def summarise(df: DataFrame, group: list[str], values: list[str], k: int = 2048, most: int = 4_000_000) -> DataFrame:
    """group, metric, part, level, vals, n, err: a summary a group, value column and input partition; no shuffle.

    A partition with more than ``most`` values gives several of a group.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Held(group, k, most)
        for pdf in batches:
            if not len(pdf):
                continue
            arrays = {c: pdf[c].to_numpy(np.float64) for c in values}
            sets = list(pdf.groupby(group, dropna=False, sort=False).indices.values())
            keys = _keys(pdf.iloc[[at[0] for at in sets]], group)
            for key, at in zip(keys, sets):
                for c in values:
                    v = arrays[c][at]
                    v = v[~np.isnan(v)]
                    if len(v):
                        state.at((*key, c), len(v)).add(v)
            if state.full():
                yield from state.out()
        yield from state.out()

    return df.select(*group, *(F.col(c).cast("double").alias(c) for c in values)).mapInPandas(run, f"{_types(df, group)}, part int, {_SUMMARY}")


def _premerged(summaries: DataFrame, group: list[str], k: int, most: int) -> DataFrame:
    """The summaries of each partition, merged by group where they stand: no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Held(group, k, most)
        for pdf in batches:
            for key, metric, row in zip(_keys(pdf, group), pdf["metric"], zip(pdf["level"], pdf["vals"], pdf["n"], pdf["err"])):
                state.at((*key, metric), len(row[1])).merge([row])
            if state.full():
                yield from state.out()
        yield from state.out()

    return summaries.select(*group, "metric", "level", "vals", "n", "err").mapInPandas(run, f"{_types(summaries, group)}, part int, {_SUMMARY}")


def combine(summaries: DataFrame, group: list[str], k: int = 2048, fan: int = 32, most: int = 4_000_000, fresh: bool = False) -> DataFrame:
    """One summary a group and metric, merged as a tree: a task merges about ``fan`` summaries of a group at once.

    fresh: straight from summarise, with nothing to merge inside a partition.
    group may leave out columns the summaries have (a day, a load): theirs
    are then combined. Groups of up to k values are put together as lists.
    """
    kinds = _types(summaries, group)
    schema = f"{kinds}, part int, {_SUMMARY}"
    names = [*group, "part", "metric", "level", "vals", "n", "err"]

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        b = Buffers(k)
        pdf = pdf.sort_values(["source", "level"], ascending=[True, False], kind="stable")  # the same order when a task runs again
        b.merge(zip(pdf["level"], pdf["vals"].map(np.asarray), pdf["n"], pdf["err"]))
        head = pdf.iloc[0]
        rows = [(*(head[g] for g in group), head["part"], head["metric"], lv, v, n, err) for lv, v, n, err in b.rows()]
        return pd.DataFrame(rows, columns=names).astype({g: "object" for g in group})

    span = max(1, summaries.rdd.getNumPartitions())
    s = materialise((summaries if fresh else _premerged(summaries, group, k, most)).select(*names))
    total = s.groupBy(*group, "metric").agg(F.sum("n").alias("total"))
    total = total.select(*(F.col(c).alias(f"_{c}") for c in (*group, "metric")), "total")
    same = F.col("metric") == F.col("_metric")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    s = s.join(total, same).select(*names, "total")
    small = s.where(F.col("total") <= k).groupBy(*group, "metric").agg(F.sort_array(F.flatten(F.collect_list("vals"))).alias("vals"), F.sum("n").alias("n"))  # at most k values
    small = small.select(*group, "metric", F.lit(-1).alias("level"), "vals", "n", F.lit(0).cast("bigint").alias("err"))
    big = s.where(F.col("total") > k).drop("total")
    while True:
        big = big.withColumns({"source": F.col("part"), "part": F.floor(F.col("part") / fan).cast("int")})
        big = big.groupBy(*group, "metric", "part").applyInPandas(merge, schema)
        span = -(-span // fan)
        if span <= 1:
            return small.unionByName(big.drop("part"))


def read_quantiles(summaries: DataFrame, group: list[str], probs: tuple[float, ...] = PROBS, k: int = 2048) -> DataFrame:
    """group, metric, n, p5 ... p99, rank_error (largest share of n by which a rank may be off); of combined summaries, one a group."""
    names = [f"p{round(p * 100)}" for p in probs]
    schema = f"{_types(summaries, group)}, metric string, n bigint, {', '.join(f'{x} double' for x in names)}, rank_error double"

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        b = Buffers(k)
        b.merge(zip(pdf["level"], pdf["vals"].map(np.asarray), pdf["n"], pdf["err"]))
        head = pdf.iloc[0]
        row = (*(head[g] for g in group), head["metric"], b.n, *b.quantiles(probs), b.err / b.n)
        return pd.DataFrame([row], columns=[*group, "metric", "n", *names, "rank_error"]).astype({g: "object" for g in group})

    exact = (F.col("level") == -1) & (F.col("n") == F.size("vals"))  # a whole group in one list
    at = lambda p: F.element_at("_v", F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("n") - 1e-9)).cast("int"))
    few = summaries.where(exact).withColumn("_v", F.sort_array("vals")).select(*group, "metric", "n", *(at(p).alias(x) for p, x in zip(probs, names)), F.lit(0.0).alias("rank_error"))
    return few.unionByName(summaries.where(~exact).groupBy(*group, "metric").applyInPandas(read, schema))
