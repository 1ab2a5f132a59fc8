"""Missing values filled from similar records by a Chow-Liu dependency tree.

Nodes are the fields to fill, categorical fields, and what like records show:
the meter's other trips of the same shift, the other records of the same trip,
the source's other trips at the same hour on days nearby. Pair counts of all
nodes come from one pass; the maximum spanning tree of their mutual
information is the model; exact message passing gives the posterior of every
missing node, decoded to the mode or, for a discretised field, to a value of
the likeliest bin: that of the like records if theirs lies in it, else the bin's
median.

Defined results in odd cases
- null, NaN and stand-ins are missing; each missing field of each record gets
  one fill, also for equal records;
- without any like record the tree falls back on the field's own distribution;
  a field without a single real value in the table gets a null fill;
- records without meter or pickup have no shift; ties go to the smaller value;
- no value and no source is outside the model: rare amounts share a bin, rare
  sources a code of the tree, while the like records are found by the source
  and the amount themselves;
- an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marlstone.functions import scalars as S
from marlstone.session import materialise


@dataclass(frozen=True)
class Node:
    """A discrete variable: codes 0 .. size-1, -1 for unknown. values: what the codes stand for."""

    name: str
    size: int
    values: tuple = ()


# ---------------------------------------------------------------- the tree


def pair_counts(coded: DataFrame, nodes: list[Node]) -> dict[tuple[int, int], np.ndarray]:
    """Joint counts of every pair of nodes over the rows where both are known.

    Each task adds up dense tables (their size depends on the nodes only) and
    Spark sums them cell by cell; what reaches the driver is bounded by the
    nodes, not by the rows.
    """
    names, sizes = [n.name for n in nodes], [n.size for n in nodes]
    pairs = [(i, j) for i in range(len(nodes)) for j in range(i + 1, len(nodes))]

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tables = [np.zeros((sizes[i] + 1) * (sizes[j] + 1), np.int64) for i, j in pairs]
        for b in batches:
            x = [np.asarray(b.column(k).to_numpy(zero_copy_only=False)).astype(np.int64) + 1 for k in range(len(names))]
            for t, (i, j) in zip(tables, pairs):
                t += np.bincount(x[i] * (sizes[j] + 1) + x[j], minlength=len(t))
        p = np.concatenate([np.full(np.count_nonzero(t), k) for k, t in enumerate(tables)])
        c = np.concatenate([np.flatnonzero(t) for t in tables])
        n = np.concatenate([t[t > 0] for t in tables])
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(c, pa.int64()), pa.array(n, pa.int64())], names=["p", "c", "n"])

    cells = coded.select(*names).mapInArrow(count, "p bigint, c bigint, n bigint").groupBy("p", "c").agg(F.sum("n").alias("n")).collect()
    out = {pair: np.zeros((sizes[pair[0]] + 1, sizes[pair[1]] + 1)) for pair in pairs}
    for p, c, n in cells:
        out[pairs[p]].flat[c] = n
    return {k: v[1:, 1:] for k, v in out.items()}


def mutual_information(joint: np.ndarray) -> float:
    n = joint.sum()
    if n == 0:
        return 0.0
    p = joint / n
    outer = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
    hit = p > 0
    return float((p[hit] * np.log(p[hit] / outer[hit])).sum())


@dataclass
class Tree:
    """parent[i]: node before i (-1: root); order: parents first; cpt[i]: P(i | parent) as (parent size, size); prior of the root in cpt as (1, size)."""

    parent: list[int]
    order: list[int]
    cpt: list[np.ndarray]


def chow_liu(nodes: list[Node], joints: dict[tuple[int, int], np.ndarray], smooth: float = 0.1) -> Tree:
    """Maximum spanning tree by mutual information (Prim from node 0; ties to the smaller index)."""
    k = len(nodes)
    mi = np.zeros((k, k))
    for (i, j), t in joints.items():
        mi[i, j] = mi[j, i] = mutual_information(t)
    parent, order, left = [-1] * k, [0], set(range(1, k))
    while left:
        _, i, j = max((mi[i, j], -i, -j) for i in order for j in left)
        parent[-j] = -i
        order.append(-j)
        left.discard(-j)
    cpt = []
    for j in range(k):
        i = parent[j]
        if i < 0:
            other = 1 if k > 1 else 0
            t = joints[(0, other)].sum(1)[None, :] if k > 1 else np.ones((1, nodes[0].size))
        else:
            t = joints[(i, j)] if i < j else joints[(j, i)].T
        own = t.sum(0, keepdims=True)
        own = (own + smooth) / (own.sum() + smooth * own.size)
        # a row seen little leans on the node's own distribution
        cpt.append((t + own * smooth * 10) / (t.sum(1, keepdims=True) + smooth * 10))
    return Tree(parent, order, cpt)


def posteriors(tree: Tree, codes: np.ndarray, wanted: list[int]) -> dict[int, np.ndarray]:
    """Sum-product over the tree for a block of rows: codes (rows, nodes), -1 unknown -> P(node | the known nodes)."""
    rows, k = codes.shape
    sizes = [c.shape[1] for c in tree.cpt]
    seen = []
    for i in range(k):
        e = np.ones((rows, sizes[i]))
        known = codes[:, i] >= 0
        e[known] = 0.0
        e[known, codes[known, i]] = 1.0
        seen.append(e)
    up, inward = [None] * k, [e.copy() for e in seen]
    for j in reversed(tree.order[1:]):
        m = inward[j] @ tree.cpt[j].T
        up[j] = m / np.maximum(m.max(1, keepdims=True), 1e-300)
        inward[tree.parent[j]] = inward[tree.parent[j]] * up[j]
    down = [None] * k
    down[tree.order[0]] = np.repeat(tree.cpt[tree.order[0]], rows, 0)
    for j in tree.order[1:]:
        i = tree.parent[j]
        rest = down[i] * inward[i] / np.maximum(up[j], 1e-300)
        d = rest @ tree.cpt[j]
        down[j] = d / np.maximum(d.max(1, keepdims=True), 1e-300)
    out = {}
    for i in wanted:
        b = down[i] * inward[i]
        out[i] = b / np.maximum(b.sum(1, keepdims=True), 1e-300)
    return out


def fill(missing: DataFrame, nodes: list[Node], tree: Tree, targets: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """keep, field, code, fill, probability: one row a missing target of a row; targets: node name -> texts of its codes."""
    names = [n.name for n in nodes]
    at = {t: names.index(t) for t in targets}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes = pdf[names].to_numpy(np.int64)
            post = posteriors(tree, codes, list(at.values()))
            for t, i in at.items():
                lack = codes[:, i] < 0
                if not lack.any():
                    continue
                p = post[i][lack]
                best = p.argmax(1)
                out = pdf.loc[lack, keep].copy()
                texts = targets[t]
                out["field"], out["code"], out["fill"], out["probability"] = t, best, [texts[b] if b < len(texts) else None for b in best], p[np.arange(len(p)), best]
                yield out

    kinds = ", ".join(f"`{k}` {missing.schema[k].dataType.simpleString()}" for k in keep)
    return missing.select(*keep, *(n for n in names if n not in keep)).mapInPandas(run, f"{kinds}, field string, code bigint, fill string, probability double")


# ---------------------------------------------------------------- like records


def _hist(code: Column, size: int) -> list[Column]:
    return [F.count_if(code == k) for k in range(size)]


def _mode_without(counts: list[Column], own: Column) -> Column:
    """Code with the highest count after taking the record's own value out; -1 if nothing is left; ties to the smaller code."""
    rest = [c - F.when(own == k, F.lit(1)).otherwise(F.lit(0)) for k, c in enumerate(counts)]
    top = F.greatest(*rest)
    code = F.lit(-1)
    for k in range(len(rest) - 1, -1, -1):
        code = F.when(rest[k] == top, F.lit(k)).otherwise(code)
    return F.when(top > 0, code).otherwise(F.lit(-1))


@dataclass(frozen=True)
class Bins:
    """Bins of an amount: lower edges in order, and the median of each bin."""

    edges: tuple[float, ...]
    medians: tuple[float, ...]

    def code(self, v: Column) -> Column:
        """Bin of a value; -1 for null."""
        out = F.lit(-1)
        for k, e in enumerate(self.edges):
            out = F.when(v >= e, k).otherwise(out) if k == 0 else F.when(v < e, out).otherwise(k)
        return F.when(v.isNotNull(), out).otherwise(-1).cast("int")


def quantile_bins(counts: list[tuple[float, int]], most: int) -> Bins:
    """At most ``most`` bins of (value, rows): a value with a bin's share of the rows is a bin of its own, the values between share quantile bins."""
    counts = sorted(counts)
    total = sum(n for _, n in counts)
    fair = total / max(1, most // 2)
    groups: list[list[tuple[float, int]]] = []
    load, alone = 0, True
    for v, n in counts:
        own = n >= fair or len(counts) <= most
        if not groups or own or alone or load + n > fair:
            groups.append([])
            load = 0
        groups[-1].append((v, n))
        load, alone = load + n, own
    return Bins(tuple(g[0][0] for g in groups), tuple(_median(g) for g in groups))


def _median(group: list[tuple[float, int]]) -> float:
    half, seen = sum(n for _, n in group) / 2, 0
    for v, n in group:
        seen += n
        if seen >= half:
            return v
    return group[-1][0]


def _like_amounts(t: DataFrame) -> DataFrame:
    """t with ``extra_near``: the amount that the source's other trips of the same hour show on days nearby; null if none does.

    Counts by (source, hour, weekend, day, amount) go to the days within three,
    own day first; the two best of a day (and of all days, for a day without
    any) are enough to leave the record itself out.
    """
    key = ["vendor", "hour", "weekend"]
    seen = t.where("vendor is not null and hour >= 0 and extra is not null").groupBy(*key, "day", "extra").agg(F.count(F.lit(1)).alias("n"))
    seen = materialise(seen)  # a row a source, hour, day and amount
    total = seen.groupBy(*key, "extra").agg(F.sum("n").alias("total"))
    weights = {-3: 1, -2: 1, -1: 5, 0: 13, 1: 5, 2: 1, 3: 1}  # fixed values: own day 8 + 4 + 1, next days 4 + 1, days nearby 1
    spread = F.explode(F.array(*(F.struct(F.lit(d).alias("d"), F.lit(w).alias("w")) for d, w in weights.items())))
    near = seen.withColumn("s", spread).groupBy(*key, F.date_add("day", F.col("s.d")).alias("day"), "extra").agg(F.sum(F.col("n") * F.col("s.w")).alias("w"))
    near = near.join(total, [*key, "extra"])

    def two(df: DataFrame, by: list[str], *order: str) -> DataFrame:
        first = df.withColumn("k", F.row_number().over(W.partitionBy(*by).orderBy(*(F.desc(o) for o in order), "extra"))).where("k <= 2")
        return first.groupBy(*by).agg(*(F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}_{order[0]}{k}") for k in (1, 2) for c in ("extra", order[0])))

    t = t.join(two(near, [*key, "day"], "w", "total"), [*key, "day"], "left").join(two(total, key, "total"), key, "left")
    own = lambda c: F.coalesce(F.col("extra") == F.col(c), F.lit(False))
    left = F.when(own("extra_w1"), F.col("w_w1") - weights[0]).otherwise(F.col("w_w1"))
    best = F.when((left > 0) & (left >= F.coalesce("w_w2", F.lit(0))), F.col("extra_w1")).otherwise(F.col("extra_w2"))
    rest = F.when(own("extra_total1"), F.col("total_total1") - 1).otherwise(F.col("total_total1"))
    any_day = F.when((rest > 0) & (rest >= F.coalesce("total_total2", F.lit(0))), F.col("extra_total1")).otherwise(F.col("extra_total2"))
    return t.withColumn("extra_near", F.coalesce(best, any_day)).drop(*(f"{c}_{o}{k}" for o in ("w", "total") for c in ("extra", o) for k in (1, 2)))


def coded_trips(trips: DataFrame, gap_h: int = 3) -> DataFrame:
    """record_id, vendor, the amounts (extra, extra_twin, extra_near) and a code column for each other node.

    Shift: hours of a meter with trips, without a break of more than gap_h
    hours; found on counts by (meter, hour), so a meter with a third of all rows
    is spread over its hours.
    """
    hour = F.hour("lpep_pickup_datetime")
    pc, pay = S.real_passengers("passenger_count"), F.array(*(F.lit(v) for v in S.PAYMENT_TYPES))
    t = trips.select(
        "record_id", "trip_id", "meter_id", "vendor",
        F.date_trunc("hour", "lpep_pickup_datetime").alias("slot"),
        F.coalesce(pc - 1, F.lit(-1)).cast("int").alias("passenger_count"),
        F.coalesce(F.array_position(pay, S.real_payment("payment_type")) - 1, F.lit(-1)).cast("int").alias("payment_type"),
        F.round(S.real_extra("extra"), 2).alias("extra"),
        F.coalesce(hour, F.lit(-1)).alias("hour"),
        F.coalesce((F.weekday("lpep_pickup_datetime") >= 5).cast("int"), F.lit(-1)).alias("weekend"),
        F.to_date("lpep_pickup_datetime").alias("day"),
    )
    # other records of the same trip stand in the same hour of the same meter
    twin = W.partitionBy("meter_id", "slot", "trip_id")
    other = lambda c: F.when(F.count_if(F.col(c) >= 0).over(twin) > F.when(F.col(c) >= 0, 1).otherwise(0), F.max(c).over(twin))
    t = t.repartition("meter_id", "slot")
    sizes = {"passenger_count": 9, "payment_type": len(S.PAYMENT_TYPES)}
    h = {f: [f"{f}_{k}" for k in range(n)] for f, n in sizes.items()}
    slots = t.where("meter_id is not null and slot is not null").groupBy("meter_id", "slot").agg(*(c.alias(a) for f, n in sizes.items() for c, a in zip(_hist(F.col(f), n), h[f])))
    w = W.partitionBy("meter_id").orderBy("slot")
    broken = F.coalesce(F.col("slot") - F.lag("slot").over(w) > F.make_dt_interval(hours=F.lit(gap_h)), F.lit(True))
    shift = W.partitionBy("meter_id", "shift")
    slots = slots.withColumn("broken", broken.cast("int")).withColumn("shift", F.sum("broken").over(w))
    flat = [a for names in h.values() for a in names]
    slots = slots.select("meter_id", "slot", *(F.sum(a).over(shift).alias(a) for a in flat))
    t = t.withColumns({f"{f}_twin": F.coalesce(other(f), F.lit(-1)) for f in sizes} | {"extra_twin": other("extra")}).join(slots, ["meter_id", "slot"], "left")
    t = t.withColumns({f"{f}_shift": F.coalesce(_mode_without([F.col(a) for a in h[f]], F.col(f)), F.lit(-1)) for f in sizes}).drop(*flat)
    return _like_amounts(t.drop("meter_id", "slot", "trip_id"))


def fill_trips(trips: DataFrame, bins: int = 32, sources: int = 31, pools: int = 8) -> DataFrame:
    """record_id, field, fill, probability for passenger_count, extra and payment_type.

    bins: most bins of extra; amounts have two places and end at 10, so their
    counts are a table of at most 1,001 rows. sources: the commonest sources have
    a code of their own in the tree, the others share ``pools`` codes by hash.
    """
    amounts = trips.select(F.round(S.real_extra("extra"), 2).alias("e")).where("e is not null").groupBy("e").agg(F.count(F.lit(1)).alias("n")).collect()
    cut = quantile_bins([(r["e"], r["n"]) for r in amounts], bins)
    vendors = sorted(r[0] for r in trips.where("vendor is not null").groupBy("vendor").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "vendor").limit(sources).collect())
    alone = F.array_position(F.array(*(F.lit(v) for v in vendors)).cast("array<string>"), F.col("vendor"))
    code = F.when(alone > 0, alone - 1).when(F.col("vendor").isNotNull(), len(vendors) + F.pmod(F.xxhash64("vendor"), F.lit(pools))).otherwise(-1).cast("int")
    values = {f"{c}_v": F.col(c) for c in ("extra_twin", "extra_near")}
    coded = coded_trips(trips).withColumns(values | {c: cut.code(F.col(c)) for c in ("extra", "extra_twin", "extra_near")} | {"vendor": code})
    coded = materialise(coded.drop("day"))  # read by the counts and by the fill
    n_pay, n_ex = len(S.PAYMENT_TYPES), max(1, len(cut.edges))
    nodes = [
        Node("passenger_count", 9), Node("passenger_count_shift", 9), Node("passenger_count_twin", 9),
        Node("payment_type", n_pay), Node("payment_type_shift", n_pay), Node("payment_type_twin", n_pay),
        Node("extra", n_ex), Node("extra_near", n_ex), Node("extra_twin", n_ex),
        Node("vendor", len(vendors) + pools), Node("hour", 24), Node("weekend", 2),
    ]
    joints = pair_counts(coded, nodes)
    tree = chow_liu(nodes, joints)
    seen = lambda i: sum(t.sum() for (a, b), t in joints.items() if i in (a, b)) > 0
    texts = {"passenger_count": [str(k + 1) for k in range(9)], "payment_type": list(S.PAYMENT_TYPES), "extra": [f"{v:.2f}" for v in cut.medians]}
    texts = {k: v if seen([n.name for n in nodes].index(k)) else [] for k, v in texts.items()}
    lacking = coded.where("passenger_count < 0 or payment_type < 0 or extra < 0")
    out = fill(lacking, nodes, tree, texts, ["record_id", *values])
    like = F.lit(None).cast("double")
    for c in ("extra_near_v", "extra_twin_v"):
        like = F.when(cut.code(F.col(c)) == F.col("code"), F.col(c)).otherwise(like)
    amount = F.when((F.col("field") == "extra") & F.col("fill").isNotNull() & like.isNotNull(), F.format_string("%.2f", like))
    return out.select("record_id", "field", F.coalesce(amount, "fill").alias("fill"), "probability")
