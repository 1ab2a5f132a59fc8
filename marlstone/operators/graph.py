"""Connected components: forests inside the partitions, then label propagation with pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marlstone.session import materialise, release


class Forest:
    """Union-find over any ids; a root is the smallest id of its tree."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (n := up.get(r, r)) != r:
            r = n
        while x != r:
            up[x], x = r, up.get(x, x)
        return r

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True


def _stars(edges: DataFrame) -> DataFrame:
    """Each partition's edges as stars: a row a node, to the smallest node it hangs together with there. A hub keeps one edge a partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest()
        for pdf in batches:
            for a, b in zip(pdf["id"].tolist(), pdf["other"].tolist()):
                forest.join(a, b)
        nodes = list(forest.up)
        yield pd.DataFrame({"id": np.array(nodes, np.int64), "other": np.array([forest.root(x) for x in nodes], np.int64)})

    return edges.mapInPandas(run, "id bigint, other bigint")


def components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """id, component (smallest id of the component).

    nodes: id (whole numbers); edges: id, other (either direction). First each
    partition turns its edges into stars. Then in each round a node takes the
    smallest label among its neighbours and hands it to the node it is labelled
    by, and all take the label of their label, so trees hang together and
    halve; every round is written and none is collected. Minima by node and by
    label are reduced on the map side; the joins are sort-merge joins whose split
    sides are the edges and the nodes, so the session's skew join divides a hub
    or a giant component over tasks.
    """
    e = materialise(_stars(edges.select("id", "other").where("id <> other")).where("id <> other").distinct())
    e = e.unionByName(e.select(F.col("other").alias("id"), F.col("id").alias("other")))
    step = materialise(nodes.select("id", F.col("id").alias("component")).distinct())  # a row a node
    for _ in range(max_rounds):
        label = step.select("id", "component")
        near = e.join(label.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.min("component").alias("near"))
        own = materialise(label.join(near, "id", "left").select("id", "component", F.least("component", F.coalesce("near", "component")).alias("new")))
        handed = own.where("new < component").groupBy("component").agg(F.min("new").alias("hook")).withColumnRenamed("component", "id")
        new = materialise(own.join(handed, "id", "left").select("id", "component", F.least("new", F.coalesce("hook", "new")).alias("new")))
        jump = new.select(F.col("id").alias("new"), F.col("new").alias("root"))
        to = F.least("new", F.coalesce("root", "new"))
        last, step = step, materialise(new.join(jump, "new", "left").select("id", to.alias("component"), (to < F.col("component")).alias("moved")))
        for x in (last, own, new):
            release(x)
        if step.where("moved").isEmpty():
            return step.select("id", "component")
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
