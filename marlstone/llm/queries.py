"""Queries of the operators for training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone.functions import scalars as S
from marlstone.llm import bpe, leaks, quantiles, subjects
from marlstone.session import materialise
from marlstone.sources.tables import table


_FARES = ["fare_amount", "trip_distance"]


def _fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "trips").select(S.zone_number("pu_location").alias("zone_id"), "load_id", F.to_date("lpep_pickup_datetime").alias("day"), *_FARES)


def p6_load_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that is kept of each load: a summary a zone and column, to be combined with those of any other loads."""
    t = _fares(spark, sf_dir).drop("day")
    return quantiles.combine(quantiles.summarise(t, ["zone_id", "load_id"], _FARES), ["zone_id", "load_id"], fresh=True)


def p6_load_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantiles.read_quantiles(p6_load_summaries(spark, sf_dir), ["zone_id", "load_id"])


def p6_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of all loads, from the loads' written summaries."""
    loads = materialise(p6_load_summaries(spark, sf_dir))
    return quantiles.read_quantiles(quantiles.combine(loads, ["zone_id"]), ["zone_id"])


def p6_combined_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of all days, from the days' written summaries."""
    t = _fares(spark, sf_dir).drop("load_id")
    days = materialise(quantiles.combine(quantiles.summarise(t, ["zone_id", "day"], _FARES), ["zone_id", "day"], fresh=True))
    return quantiles.read_quantiles(quantiles.combine(days, ["zone_id"]), ["zone_id"])


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", bpe.token_ids(F.col("text")).alias("ids"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.classify(*(table(spark, sf_dir, t) for t in ("documents", "subject_labels", "subjects")))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_subjects(spark, sf_dir).where(F.col("posterior") >= 0.5).select("doc_id", "subject")


def queries() -> dict:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


_ZONE_SQL = r"""try_cast(nullif(regexp_extract(pu_location, '^\s*(?:[Zz][Oo][Nn][Ee]-?|[Zz])?\s*0*([0-9]{1,9})(?:\.0+)?\??\s*$', 1), '') as integer)"""


def oracle_sql() -> dict[str, str]:
    # up to k values a group, as in the tables of the correctness check, the summaries are exact
    probs = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    rows = " union all ".join(f"select {_ZONE_SQL} as zone_id, load_id, '{c}' as metric, {c} as v from trips where {c} is not null and not isnan({c})" for c in _FARES)
    cols = ", ".join(f"quantile_disc(v, {p}) as {k}" for k, p in probs.items())
    sql = lambda by: f"select {by}, metric, count(*) as n, {cols}, 0.0::double as rank_error from ({rows}) group by {by}, metric"
    return {"p6_percentiles": sql("zone_id"), "p6_combined_days": sql("zone_id"), "p6_load_percentiles": sql("zone_id, load_id")}
