"""Column profile of each load, exact at any size.

Values are unpivoted, counted by (column, load, value) and range-sorted by
(column, group, load, value); running counts inside the sorted partitions plus
the prefix counts of the partitions before turn positions into exact ranks. From
the ranks come exact quantiles and distincts, and from the merged cumulative
curves the exact Kolmogorov-Smirnov distance of each load to the rest of its
group.

Defined results in odd cases
- null and NaN count as nulls; a load whose values are all null has no
  quantiles and no distance;
- equal values of a load are one distinct value with their count;
- a null load_id is a load of its own; a load missing from the table of loads
  has a null group and is compared with the other such loads; a load that is the
  only one of its group has no distance;
- a load listed twice counts as listed once;
- an empty table gives an empty profile; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marlstone.session import materialise, shuffle_width


def value_counts(df: DataFrame, load: str, columns: dict[str, dict[str, Column]], group: Column | None = None) -> DataFrame:
    """field, load, text, number, valid, well_formed, n: one row a distinct value of a column in a load.

    columns: name -> {"text": ..., "number": ..., "in_range": ..., "well_formed": ...}
    as expressions. Counts are combined on the map side, so a load with a
    third of all rows costs no more than its distinct values.
    """
    entry = lambda name, e: F.struct(
        F.lit(name).alias("field"), e["text"].cast("string").alias("text"), e["number"].cast("double").alias("number"), F.coalesce(e["in_range"], F.lit(False)).alias("in_range"), F.coalesce(e["well_formed"], F.lit(False)).alias("well_formed")
    )
    cells = df.select(F.col(load).alias("load"), F.explode(F.array(*(entry(k, e) for k, e in columns.items()))).alias("e"))
    return cells.groupBy("e.field", "load", "e.text", "e.number", "e.in_range", "e.well_formed").agg(F.count(F.lit(1)).alias("n"))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which null keys meet null keys; the right side's key columns go."""
    r = right.select(*(F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in right.columns))
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(r[f"_{k}"])
    return left.join(r, cond, how).drop(*(f"_{k}" for k in keys))


_KEYS = ["field", "grp", "load"]


def ranked_curves(counts: DataFrame) -> DataFrame:
    """counts (field, grp, load, number, n) with ``below``: rows of the same field and load with a smaller number, exact.

    One range sort, written. The running count starts at zero in every
    partition; a curve that began in a partition before gets that one's count
    added: at most one curve a partition, so the prefix table is as small as the
    number of partitions.
    """
    width = shuffle_width(counts.sparkSession)
    ordered = counts.select(*_KEYS, "number", "n", F.to_json(F.struct(*_KEYS)).alias("curve"))
    ordered = ordered.repartitionByRange(width, *_KEYS, "number").sortWithinPartitions(*_KEYS, "number")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, last, held = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            curve, n = pdf["curve"].to_numpy(object), pdf["n"].to_numpy(np.int64)
            new = np.r_[curve[0] != last, curve[1:] != curve[:-1]]
            before = np.cumsum(n) - n
            start = np.maximum.accumulate(np.where(new, np.arange(len(n)), -1))
            inner = np.where(start < 0, before + held, before - before[np.maximum(start, 0)])
            last, held = curve[-1], int(inner[-1] + n[-1])
            yield pdf.assign(inner=inner, part=part)

    ordered = materialise(ordered.mapInPandas(run, f"{kinds}, inner bigint, part int"))
    sums = ordered.groupBy("part", "curve").agg(F.sum("n").alias("s"))
    before = W.partitionBy("curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = sums.withColumn("base", F.sum("s").over(before)).where("base is not null").select("part", "curve", "base")
    out = ordered.join(F.broadcast(base), ["part", "curve"], "left")  # at most a row a partition
    return out.select(*_KEYS, "number", "n", (F.col("inner") + F.coalesce("base", F.lit(0))).alias("below"))


def ks_distances(curves: DataFrame) -> DataFrame:
    """field, load, ks: largest gap between a load's cumulative curve and that of its group's other loads.

    curves: field, grp, load, number, n, below. At each number of the group,
    the load's curve is at most one step old; the gaps need looking at only at
    the load's own numbers, just before and just after, because between two
    of them its curve is flat and the others' is monotone.
    """
    at = curves.groupBy("field", "grp", "number").agg(F.sum("n").alias("all_n"))
    # the group's curve is ranked like a load's: all loads of the group as one
    pooled = ranked_curves(at.select("field", "grp", F.lit(0).cast("bigint").alias("load"), "number", F.col("all_n").alias("n")))
    pooled = pooled.select("field", "grp", "number", F.col("n").alias("all_n"), F.col("below").alias("all_below"))
    size = curves.groupBy(*_KEYS).agg(F.sum("n").alias("size"))
    whole = size.groupBy("field", "grp").agg(F.sum("size").alias("whole"))
    j = null_safe(curves, pooled, ["field", "grp", "number"], "inner")
    j = null_safe(j, null_safe(size, whole, ["field", "grp"], "inner"), _KEYS, "inner")
    rest = F.nullif(F.col("whole") - F.col("size"), F.lit(0))
    lo = F.abs(F.col("below") / F.col("size") - (F.col("all_below") - F.col("below")) / rest)
    hi = F.abs((F.col("below") + F.col("n")) / F.col("size") - (F.col("all_below") + F.col("all_n") - F.col("below") - F.col("n")) / rest)
    return j.groupBy("field", "load").agg(F.max(F.greatest(lo, hi)).alias("ks"))


def profile(counts: DataFrame, groups: DataFrame, probs: tuple[float, ...] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """A row a field and load.

    counts: as of value_counts; groups: load, grp (the loads to compare with).
    Columns: field, grp, load, n_rows, n_null, n_distinct, n_out (not in
    range), n_malformed, n_sound (in range and well formed), mean_sound, sum of
    shares' peak (top_share), lo and hi, the exact lower quantiles q_0, q_25 ...
    of the sound numbers and ks.
    """
    c = null_safe(counts, _listed(groups), ["load"])
    there = F.col("text").isNotNull()
    sound = there & F.col("in_range") & F.col("well_formed") & F.col("number").isNotNull()
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    base = c.groupBy("field", "grp", "load").agg(
        F.sum("n").alias("n_rows"),
        total(~there).alias("n_null"),
        F.count_if(there).alias("n_distinct"),
        total(there & ~F.col("in_range")).alias("n_out"),
        total(there & ~F.col("well_formed")).alias("n_malformed"),
        total(sound).alias("n_sound"),
        (F.sum(F.when(sound, F.col("n") * F.col("number"))) / F.sum(F.when(sound, F.col("n")))).alias("mean_sound"),
        F.min(F.when(there, F.col("number"))).alias("lo"),
        F.max(F.when(there, F.col("number"))).alias("hi"),
    )
    numbers = c.where(sound).groupBy("field", "grp", "load", "number").agg(F.sum("n").alias("n"))
    curves = ranked_curves(numbers)
    need = [F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("size"))) for p in probs]
    hit = lambda k: F.when((F.col("below") < k) & (k <= F.col("below") + F.col("n")), F.col("number"))
    sizes = curves.groupBy("field", "load").agg(F.sum("n").alias("size"))
    quants = null_safe(curves, sizes, ["field", "load"], "inner").groupBy("field", "load").agg(*(F.max(hit(k)).alias(f"q_{round(p * 100)}") for p, k in zip(probs, need)), F.max(F.col("n") / F.col("size")).alias("top_share"))
    keys = ["field", "load"]
    return null_safe(null_safe(base, quants, keys), ks_distances(curves), keys)


def _listed(groups: DataFrame) -> DataFrame:
    return groups.groupBy("load").agg(F.min("grp").alias("grp"))


def zone_shares(counts: DataFrame, groups: DataFrame, field: str) -> DataFrame:
    """load, number, share: of the sound values of one field, per number."""
    c = counts.where((F.col("field") == field) & F.col("text").isNotNull() & F.col("in_range") & F.col("well_formed"))
    per = c.groupBy("load", "number").agg(F.sum("n").alias("n"))
    size = per.groupBy("load").agg(F.sum("n").alias("size"))
    per = null_safe(null_safe(per, size, ["load"], "inner"), _listed(groups), ["load"])
    return per.select("load", "grp", "number", (F.col("n") / F.col("size")).alias("share"))


def off_loads(prof: DataFrame, shares: DataFrame, rules: dict[str, dict[str, float]], ks_least: float = 0.05) -> DataFrame:
    """load, field, aspect: loads that differ from the median of their group.

    rules: field -> {aspect: bound}; aspects nulls, range, pattern (points above
    the usual share), distinct (share of the usual distincts a value),
    median, mean (relative shift) and share (points of one number, by
    ``shares`` of zone_shares). A number that a load lacks has share 0 there.

    A shift of the distribution is found by the Kolmogorov-Smirnov distance to
    the group's other loads; the rule then says of which kind it is. A number
    whose share moves by s moves the curve by s / 2 at least, a mean that moves
    by m inside a range of width r moves it by m / r.
    """
    prof, shares = materialise(prof), materialise(shares)  # a row a load and field, and a row a load and number: both are asked several times
    there = F.col("n_rows") - F.col("n_null")
    p = prof.select(
        "field", "grp", "load", "ks",
        (F.col("n_null") / F.col("n_rows")).alias("nulls"),
        (F.col("n_out") / F.nullif(there, F.lit(0))).alias("range"),
        (F.col("n_malformed") / F.nullif(there, F.lit(0))).alias("pattern"),
        (F.col("n_distinct") / F.nullif(there, F.lit(0))).alias("distinct"),
        F.col("q_50").alias("median"), F.col("mean_sound").alias("mean"),
    )
    # a row a load and field
    usual = p.groupBy("field", "grp").agg(*(F.median(x).alias(f"u_{x}") for x in ("nulls", "range", "pattern", "distinct", "median", "mean")))
    q = null_safe(p, usual, ["field", "grp"])
    moved = F.coalesce(F.col("ks") >= ks_least, F.lit(False))
    out = []
    for name, bounds in rules.items():
        for aspect, bound in bounds.items():
            if aspect == "share":
                continue
            v, u = F.col(aspect), F.col(f"u_{aspect}")
            shift = moved & (F.abs(v - u) > bound * F.abs(u))
            cond = {"distinct": v < bound * u, "median": shift, "mean": shift}.get(aspect, v - u > bound)
            label = "distribution" if aspect in ("median", "mean") else aspect
            out.append(F.when((F.col("field") == name) & cond, F.lit(label)))
    found = q.select("load", "field", F.explode(F.array_compact(F.array(*out))).alias("aspect"))
    for name, bounds in rules.items():
        if "share" in bounds:
            loads = p.where((F.col("field") == name) & moved).select("load", "grp")
            n = p.where(F.col("field") == name).groupBy("grp").agg(F.count(F.lit(1)).alias("loads"))
            # the usual share of a number: the median over the group's loads, those without it at 0
            per = null_safe(shares.groupBy("grp", "number").agg(F.sort_array(F.collect_list("share")).alias("s")), n, ["grp"], "inner")
            full = F.concat(F.array_repeat(F.lit(0.0), (F.col("loads") - F.size("s")).cast("int")), F.col("s"))
            mid = lambda a: (F.element_at(a, F.floor((F.size(a) + 1) / 2).cast("int")) + F.element_at(a, F.ceil((F.size(a) + 1) / 2).cast("int"))) / 2
            per = per.select("grp", "number", mid(full).alias("u"))
            over = null_safe(null_safe(shares, per, ["grp", "number"], "inner"), loads.select("load"), ["load"], "left_semi").where(F.abs(F.col("share") - F.col("u")) > bounds["share"]).select("load")
            usual_n = null_safe(loads, per.where(F.col("u") > bounds["share"]), ["grp"], "inner")
            lacking = null_safe(usual_n, shares.select("load", "number"), ["load", "number"], "left_anti").select("load")
            found = found.unionByName(over.unionByName(lacking).select("load", F.lit(name).alias("field"), F.lit("distribution").alias("aspect")))
    return found.distinct()
