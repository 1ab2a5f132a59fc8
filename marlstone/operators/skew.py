"""Per-key results and joins when a few keys hold most rows: fragment-replicate by estimated load.

Keys are bin-packed to tasks by their load. A key above its fair share is cut
into proportionate shards on several tasks; the matching side is replicated
to those shards only. Light keys go through hash buckets, so the plan that
reaches the driver is bounded by the number of tasks, not by the keys.

Defined results in odd cases
- null keys match nothing: they are dropped by the inner join and kept with
  nulls by the left one, spread over all tasks;
- equal rows keep their number; equal rows of the matching side multiply as in
  any join;
- empty tables give empty results; clashing names other than the key must be
  renamed by the caller, else the join raises ValueError.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marlstone.session import materialise, shuffle_width


@dataclass(frozen=True)
class ShardPlan:
    """heavy: key tuple -> tasks of its shards; buckets: task of each bucket of light keys; loads: planned rows a task."""

    tasks: int
    heavy: dict[tuple, list[int]]
    buckets: list[int]
    loads: list[float]


def pack(heavy: list[tuple[tuple, int]], buckets: list[int], tasks: int) -> ShardPlan:
    """Longest-processing-time packing. A heavy key of load n gets ceil(n / fair share) shards on different tasks."""
    total = sum(n for _, n in heavy) + sum(buckets)
    fair = max(1.0, total / tasks)
    items: list[tuple[float, tuple]] = []
    for key, n in heavy:
        shards = min(tasks, -(-n // int(fair)) if n > fair else 1)
        items += [(n / shards, ("key", key))] * shards
    items += [(float(n), ("bucket", i)) for i, n in enumerate(buckets)]
    items.sort(key=lambda x: (-x[0], str(x[1])))
    heap = [(0.0, t) for t in range(tasks)]
    loads, placed, bucket_of = [0.0] * tasks, {}, [0] * len(buckets)
    for load, (kind, what) in items:
        skip = []
        while True:
            now, t = heapq.heappop(heap)
            if kind == "key" and t in placed.get(what, ()):  # shards of a key on different tasks
                skip.append((now, t))
                continue
            break
        for x in skip:
            heapq.heappush(heap, x)
        heapq.heappush(heap, (now + load, t))
        loads[t] = now + load
        if kind == "key":
            placed.setdefault(what, []).append(t)
        else:
            bucket_of[what] = t
    return ShardPlan(tasks, placed, bucket_of, loads)


def key_loads(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows a key, counted with map-side partial sums."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("load"))


def plan_shards(loads: DataFrame, key: list[str], tasks: int, buckets_a_task: int = 8) -> ShardPlan:
    """The driver sees at most 4 * tasks heavy keys and tasks * buckets_a_task sums."""
    n_buckets = tasks * buckets_a_task
    loads = materialise(loads)  # a row a key: the table is counted once for the three questions below
    known = loads.where(" and ".join(f"`{k}` is not null" for k in key))
    total = known.agg(F.sum("load")).first()[0] or 0
    floor = max(1, total / (4 * tasks))
    heavy = [(tuple(r[k] for k in key), r["load"]) for r in known.where(F.col("load") > floor).collect()]
    light = known.where(F.col("load") <= floor).groupBy(_bucket(key, n_buckets).alias("b")).agg(F.sum("load").alias("load")).collect()
    sums = [0] * n_buckets
    for b, n in light:
        sums[b] = n
    return pack(heavy, sums, tasks)


def _bucket(key: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


def task_tokens(spark: SparkSession, tasks: int) -> list[int]:
    """A bigint for each task whose shuffle hash lands in just that partition of ``tasks``."""
    found: dict[int, int] = {}
    size = 64 * tasks + 256
    while len(found) < tasks:
        rows = spark.range(size).groupBy(F.pmod(F.hash("id"), F.lit(tasks)).alias("p")).agg(F.min("id").alias("id")).collect()
        found = {p: i for p, i in rows}
        size *= 4
    return [found[p] for p in range(tasks)]


def fragment_replicate(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner", spread: list[str] | None = None, plan: ShardPlan | None = None) -> DataFrame:
    """Equi-join of left (large, skewed) with right.

    spread: columns that tell the rows of a heavy key apart; their hash picks
    the shard, so a task that runs again picks the same one. Default: all.
    """
    clash = (set(left.columns) & set(right.columns)) - set(key)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    spark = left.sparkSession
    tasks = plan.tasks if plan else shuffle_width(spark)
    plan = plan or plan_shards(key_loads(left, key), key, tasks)
    tokens = task_tokens(spark, plan.tasks)
    bucket_token = F.element_at(F.array(*(F.lit(tokens[t]).cast("bigint") for t in plan.buckets)), _bucket(key, len(plan.buckets)) + 1)
    rows = [(*k, [tokens[t] for t in ts]) for k, ts in plan.heavy.items()]
    kinds = ", ".join(f"`{k}` {left.schema[k].dataType.simpleString()}" for k in key)
    heavy = F.broadcast(spark.createDataFrame(rows, f"{kinds}, _tasks array<bigint>"))  # at most 4 * tasks rows
    salt = F.xxhash64(*(spread or left.columns), F.lit(1))
    lone = F.element_at(F.array(*(F.lit(t).cast("bigint") for t in tokens)), F.pmod(salt, F.lit(plan.tasks)).cast("int") + 1)
    no_key = F.lit(False)
    for k in key:
        no_key = no_key | F.col(k).isNull()
    l_task = F.when(no_key, lone).when(F.col("_tasks").isNotNull(), F.try_element_at("_tasks", F.pmod(salt, F.size("_tasks")).cast("int") + 1)).otherwise(bucket_token)
    lt = left.join(heavy, key, "left").withColumn("_task", l_task).drop("_tasks")
    rt = right.dropna(subset=key).join(heavy, key, "left").withColumn("_task", F.explode(F.coalesce("_tasks", F.array(bucket_token)))).drop("_tasks")
    # both sides hashed by the token alone: the join needs no further shuffle
    return lt.repartition(plan.tasks, "_task").join(rt.repartition(plan.tasks, "_task").hint("shuffle_hash"), ["_task", *key], how).drop("_task")


def per_key(left: DataFrame, right: DataFrame, key: list[str], aggs: list[Column], spread: list[str] | None = None) -> DataFrame:
    """Aggregates of the joined rows per key; each shard aggregates its own rows first (Spark's partial aggregation)."""
    return fragment_replicate(left, right, key, "inner", spread).groupBy(*key).agg(*aggs)
