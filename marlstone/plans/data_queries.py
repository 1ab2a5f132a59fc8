"""Queries of the data-pipeline operators on the trips and raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone.functions import scalars as S
from marlstone.operators import column_profile, drift, impute, skew, spikes
from marlstone.sources.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "trip_files")
    parsed = drift.parse_lines(table(spark, sf_dir, "raw_trips"), files)
    return drift.schema_changes(parsed, files)


def p1_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.conform(drift.parse_lines(table(spark, sf_dir, "raw_trips"), table(spark, sf_dir, "trip_files")))


def p1_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.promote(p1_trips(spark, sf_dir), {"tip_amount": "money", "tolls_amount": "money", "wait_minutes": "int", "battery_pct": "double"})


def p1_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_id, field, kind, values: what the report of changes goes by."""
    return drift.field_kinds(drift.parse_lines(table(spark, sf_dir, "raw_trips"), table(spark, sf_dir, "trip_files")))


PROFILE_RULES = {
    "passenger_count": {"nulls": 0.10, "range": 0.05, "mean": 0.40},
    "total_amount": {"nulls": 0.10, "range": 0.05, "distinct": 0.40, "median": 0.40},
    "pu_location": {"nulls": 0.10, "range": 0.05, "pattern": 0.05, "share": 0.20},
}


def _profile_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from marlstone.session import materialise

    zones = table(spark, sf_dir, "zones").select(F.col("zone_id").alias("zone")).distinct()
    trips = table(spark, sf_dir, "trips").select("load_id", "passenger_count", "total_amount", "pu_location")
    total, pc, pu = S.real_number("total_amount"), F.col("passenger_count"), F.col("pu_location")
    yes = F.lit(True)
    columns = {
        "passenger_count": {"text": pc, "number": pc, "in_range": pc.between(1, 9), "well_formed": yes},
        "total_amount": {"text": total, "number": total, "in_range": total.between(0, 500), "well_formed": yes},
        "pu_location": {"text": pu, "number": S.zone_number(pu), "in_range": yes, "well_formed": S.is_plain_zone(pu)},
    }
    counts = column_profile.value_counts(trips, "load_id", columns)
    # whether a number is a zone is asked of the counted values, not of every row
    known = counts.join(zones, (F.col("field") == "pu_location") & (F.col("number") == F.col("zone")), "left")
    counts = known.withColumn("in_range", F.when(F.col("field") == "pu_location", F.col("zone").isNotNull()).otherwise(F.col("in_range"))).drop("zone")
    groups = table(spark, sf_dir, "trip_loads").select(F.col("load_id").alias("load"), F.col("depot").alias("grp"))
    return materialise(counts), groups


def p2_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, groups = _profile_inputs(spark, sf_dir)
    p = column_profile.profile(counts, groups).drop("grp").withColumnRenamed("load", "load_id")
    return p.withColumns({c: F.round(c, 6) for c in ("mean_sound", "top_share", "ks")})


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, groups = _profile_inputs(spark, sf_dir)
    prof = column_profile.profile(counts, groups)
    shares = column_profile.zone_shares(counts, groups, "pu_location")
    found = column_profile.off_loads(prof, shares, PROFILE_RULES)
    return found.select(F.col("load").alias("load_id"), "field", "aspect")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes.implausible(table(spark, sf_dir, "trips"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.fill_trips(table(spark, sf_dir, "trips")).select("record_id", "field", "fill")


def _zone_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """trips unpivoted to (field, zone_id, record_id, fare), and the zones of both fields."""
    fields = ("pu_location", "do_location")
    t = table(spark, sf_dir, "trips")
    both = F.array(*(F.struct(F.lit(f).alias("field"), S.zone_number(f).alias("zone_id")) for f in fields))
    rows = t.select("record_id", S.real_number("fare_amount").alias("fare"), F.explode(both).alias("e")).select("record_id", "fare", "e.*")
    zones = table(spark, sf_dir, "zones").select("zone_id", "district").dropDuplicates(["zone_id"])
    zones = zones.select("*", F.explode(F.array(*(F.lit(f) for f in fields))).alias("field"))
    return rows, zones


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, zones = _zone_rows(spark, sf_dir)
    rows = rows.drop("fare")
    n = table(spark, sf_dir, "trips").count()
    per_zone = skew.per_key(rows, zones, ["field", "zone_id"], [F.count(F.lit(1)).alias("n")], spread=["record_id"])
    return per_zone.where(F.col("n") > 0.02 * n).select("field", "zone_id")


def p5_zone_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, zones = _zone_rows(spark, sf_dir)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("fare").alias("fares"), F.first("district").alias("district")]
    return skew.per_key(rows, zones, ["field", "zone_id"], aggs, spread=["record_id"]).withColumn("fares", F.round("fares", 2))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


_ZONE_SQL = r"""try_cast(nullif(regexp_extract({c}, '^\s*(?:[Zz][Oo][Nn][Ee]-?|[Zz])?\s*0*([0-9]{{1,9}})(?:\.0+)?\??\s*$', 1), '') as integer)"""
_ZONE_ROWS_SQL = " union all ".join(f"select '{c}' as field, {_ZONE_SQL.format(c=c)} as zone_id, case when isnan(fare_amount) then null else fare_amount end as fare from trips" for c in ("pu_location", "do_location"))


_PROFILE_SQL = f"""
with pu as (select load_id, pu_location as t, {_ZONE_SQL.format(c="pu_location")} as z from trips),
     amount as (select load_id, case when isnan(total_amount) then null else total_amount end as v from trips),
     cells as (
       select load_id, 'passenger_count' as field, cast(passenger_count as varchar) as t, passenger_count::double as x, coalesce(passenger_count between 1 and 9, false) as in_range, true as well from trips
       union all select load_id, 'total_amount', cast(v as varchar), v, coalesce(v between 0 and 500, false), true from amount
       union all select load_id, 'pu_location', t, z::double, coalesce(z in (select zone_id from zones), false), coalesce(regexp_matches(t, '^[1-9][0-9]*$'), false) from pu),
     c as (select cells.*, depot as grp, t is not null and in_range and well and x is not null as sound from cells left join trip_loads using (load_id)),
     base as (
       select field, load_id, count(*) as n_rows, count(*) filter (t is null) as n_null, count(distinct t) as n_distinct, count(*) filter (t is not null and not in_range) as n_out,
         count(*) filter (t is not null and not well) as n_malformed, count(*) filter (sound) as n_sound, round(avg(x) filter (sound), 6) as mean_sound, min(x) filter (t is not null) as lo, max(x) filter (t is not null) as hi,
         quantile_disc(x, 0.0) filter (sound) as q_0, quantile_disc(x, 0.25) filter (sound) as q_25, quantile_disc(x, 0.5) filter (sound) as q_50, quantile_disc(x, 0.75) filter (sound) as q_75, quantile_disc(x, 1.0) filter (sound) as q_100
       from c group by field, load_id),
     n as (select field, grp, load_id, x, count(*) as n from c where sound group by all),
     one as (select *, sum(n) over (partition by field, grp, load_id order by x) as upto, sum(n) over (partition by field, grp, load_id) as size from n),
     every as (select field, grp, x, sum(sum(n)) over (partition by field, grp order by x) as upto, sum(n) as n, sum(sum(n)) over (partition by field, grp) as size from n group by field, grp, x),
     gaps as (
       select o.field, o.load_id, o.n / o.size as part, greatest(abs((o.upto - o.n) / o.size - (e.upto - e.n - o.upto + o.n) / (e.size - o.size)), abs(o.upto / o.size - (e.upto - o.upto) / (e.size - o.size))) as gap
       from one o join every e on o.field = e.field and o.grp is not distinct from e.grp and o.x = e.x),
     far as (select field, load_id, round(max(part), 6) as top_share, round(max(gap), 6) as ks from gaps group by all)
select base.*, far.top_share, far.ks from base left join far on base.field = far.field and base.load_id is not distinct from far.load_id
"""


_SEPARATORS = (",", ";", "|", "\t")
_SPLIT_SQL = "case separator " + " ".join(f"when '{s}' then regexp_extract_all('{s}' || line, '[{s}](\"(?:[^\"]|\"\")*\"|[^{s}]*)', 1)" for s in _SEPARATORS) + " end"
_KINDS_SQL = f"""
with r as (select raw_trips.*, file_format, separator from raw_trips join trip_files using (file_id)),
     heads as (select file_id, list_transform(string_split(line, separator), lambda x: replace(lower(trim(x)), ' ', '_')) as names from r where file_format = 'csv' and line_no = 1),
     split as (select file_id, names, {_SPLIT_SQL} as vals from r join heads using (file_id) where line_no > 1 and trim(line) <> ''),
     cells as (
       select file_id, unnest(names) as field, unnest(vals) as v from split where len(names) = len(vals)
       union all select file_id, unnest(names), null from heads
       union all select file_id, replace(lower(trim(k)), ' ', '_'), json_extract_string(line, '$."' || k || '"') from (select file_id, line, unnest(json_keys(case when json_valid(line) then line end)) as k from r where file_format = 'jsonl' and trim(line) like '{{%}}')),
     plain as (select file_id, field, trim(case when len(v) > 1 and v like '"%"' then replace(substr(v, 2, len(v) - 2), '""', '"') else v end) as v from cells),
     kinds as (select file_id, field, case when v is null or lower(v) in ('', '-', '\\n', 'n/a', 'na', 'nan', 'none', 'null') then null when regexp_full_match(v, '[+-]?[0-9]+') then 'integer'
       when regexp_full_match(v, '[+-]?([0-9]+\\.[0-9]*|\\.[0-9]+)') then 'decimal'
       when regexp_full_match(v, '[0-9]{{4}}[-/][0-9]{{2}}[-/][0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]+)?)?(Z|[+-][0-9:]{{4,6}})?') then 'timestamp' else 'text' end as kind from plain),
     n as (select file_id, field, kind, count(kind) as n from kinds group by all),
     t as (select file_id, field, sum(n)::bigint as "values" from n group by all)
select file_id, field, (select kind from n where n.file_id = t.file_id and n.field = t.field and kind is not null and n.n >= 0.9 * t."values" order by n.n desc limit 1) as kind, "values" from t
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_kinds": _KINDS_SQL,
        "p2_profile": _PROFILE_SQL,
        "p5_found": f"with r as ({_ZONE_ROWS_SQL}) select field, zone_id from r where zone_id in (select zone_id from zones) group by all having count(*) > 0.02 * (select count(*) from trips)",
        "p5_zone_results": f"with r as ({_ZONE_ROWS_SQL}) select field, zone_id, count(*) as n, round(sum(fare), 2) as fares, any_value(district) as district from r join zones using (zone_id) group by all",
    }
