"""Implausible readings, judged by what is normal for their source.

Each source (vendor) is a state-space model: the log speed, the log rate and
the tariff (base, per mile, per minute) walk from day to day, and a day's trips
observe them. Kalman filters run over *summaries* of each day, never over rows,
so a source with a third of all rows costs its number of days. They run forward
only: a day is forecast from the days before it. A reading's innovation is
standardised by the forecast's own variance (state covariance plus the spread
of the source's trips so far); innovations of fare and speed say whether the
three readings agree, and which of them is at fault.

Three passes over the rows give the forecasts, each a small partial
aggregation by source and day:
1. quartiles of a day's log speeds and log rates; a robust local-level filter
   follows them;
2. sums of the trips whose innovations under (1) are inside the gate; the
   tariff's filter follows them;
3. the same sums without the trips whose fare or speed is flagged by (2):
   flagged updates are withheld, and the filter runs again.

Stuck readings are those whose innovation variance has vanished: under a meter's
random walk the innovation is the change since the trip before, and over a
run of trips all of them are zero.

Defined results in odd cases
- a null (or NaN) reading is never a case; the other readings are judged by
  what is left;
- a source's first days, until they hold ``start`` sound trips, have no
  forecast and are judged by the state after them; trips without a pickup by
  the source's last state;
- a source that is null or has no sound trips is judged by the impossible
  values and the runs only;
- of a trip sent again, the first record (by record_id) with a pickup stands
  for it in the runs, and every record that carries the run's value is a case;
  a null trip_id is a trip of its own;
- equal records are all reported; trips of a meter with the same pickup stand
  in order of trip_id; rows without meter or pickup take no part in runs;
- an empty table has no cases; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marlstone.functions.scalars import minutes_between, real_number
from marlstone.session import materialise


@dataclass(frozen=True)
class SpikeRules:
    """gate: largest standardised innovation that agrees; sure: the one that
    bears another reading out; tiny: share of the usual value under which a
    reading is next to nothing; beyond: factor over the forecast from which a
    disagreeing reading is a spike; late_min: minutes past the source's longest
    trips; run: trips of the same value; flat: the rate type with a fixed
    fare; drift: daily deviation of the states' walk, relative; start: sound
    trips of the starting state; block: trips of a meter that one task looks
    at (the result doesn't depend on it)."""

    gate: float = 6.0
    sure: float = 3.0
    tiny: float = 0.03
    beyond: float = 2.5
    late_min: float = 60.0
    run: int = 6
    flat: str = "airport"
    drift: float = 0.01
    start: int = 50
    block: int = 500_000


_NO_DAY = "0001-01-01"  # day of the readings without a pickup


def readings(trips: DataFrame) -> DataFrame:
    return trips.select(
        "record_id", "trip_id", "meter_id", F.col("vendor").alias("source"), F.col("lpep_pickup_datetime").alias("pickup"), F.col("lpep_dropoff_datetime").alias("dropoff"), "rate_type",
        real_number("trip_distance").alias("dist"), real_number("fare_amount").alias("fare"),
    ).withColumns({"dur": minutes_between("pickup", "dropoff"), "day": F.coalesce(F.to_date("pickup"), F.lit(_NO_DAY).cast("date"))})


_SOUND = "dist > 0 and fare > 0 and dur > 0"


def _rough(r: DataFrame, rules: SpikeRules) -> DataFrame:
    """A row a source: usual sizes of the readings, from mergeable quantile sketches."""
    med = lambda x, p=0.5: F.percentile_approx(F.when(F.expr(_SOUND), x), p, 500)
    fares = r.where((F.col("rate_type") == rules.flat) & F.col("fare").isNotNull()).groupBy("source", F.round("fare", 2).alias("fare")).agg(F.count(F.lit(1)).alias("n"))
    flat = fares.groupBy("source").agg(F.min_by("fare", F.struct(-F.col("n"), F.col("fare"))).alias("flat_fare"))
    return r.groupBy("source").agg(
        med(F.ln("dist")).alias("m_dist"),
        med(F.ln("dur")).alias("m_dur"),
        med(F.ln("fare")).alias("m_fare"),
        med(F.col("dur"), 0.995).alias("long_dur"),
    ).join(flat, "source", "left")


def _log_speed() -> Column:
    return F.ln(F.try_divide("dist", "dur"))


def _log_rate() -> Column:
    return F.ln(F.try_divide("fare", "dist"))


def _quartiles(r: DataFrame, rules: SpikeRules) -> DataFrame:
    """source, day, n and the quartiles of its sound trips' log speeds (v) and log rates (w); a row for every day with a trip."""
    sound = F.expr(_SOUND) & ~F.col("rate_type").eqNullSafe(rules.flat)
    four = lambda x: F.percentile_approx(F.when(sound, x), [0.25, 0.5, 0.75], 200)
    return r.where("source is not null").groupBy("source", "day").agg(F.count_if(sound).alias("n"), four(_log_speed()).alias("v"), four(_log_rate()).alias("w"))


_LEVELS = "source string, day date, v double, v_var double, w double, w_var double"


def _day_numbers(pdf: pd.DataFrame) -> np.ndarray:
    return np.array([d.toordinal() for d in pdf["day"]])


def _start(n: np.ndarray, least: int) -> int:
    """Number of first days that hold ``least`` trips."""
    return int(min(np.searchsorted(np.cumsum(n), least) + 1, len(n)))


def follow(days: np.ndarray, n: np.ndarray, mid: np.ndarray, spread: np.ndarray, rules: SpikeRules) -> tuple[np.ndarray, np.ndarray]:
    """Local-level Kalman filter over the days' medians: forecast and innovation variance of a single trip by day.

    mid, spread: NaN on a day without sound trips. A day whose median lies
    beyond the gate is withheld; the walk then widens until a day fits again.
    """
    know = (n > 0) & ~np.isnan(mid)
    level, var = np.full(len(n), np.nan), np.full(len(n), np.nan)
    if not know.any():
        return level, var
    first = _start(np.where(know, n, 0), rules.start)
    open_ = np.flatnonzero(know[:first]) if know[:first].any() else np.flatnonzero(know)[:1]
    order = open_[np.argsort(mid[open_], kind="stable")]
    x = float(mid[order][np.searchsorted(np.cumsum(n[order]), n[order].sum() / 2)])
    s2 = max(float(np.average(spread[open_], weights=n[open_])) ** 2, 1e-4)
    p = 1.57 * s2 / n[open_].sum()
    level[:first], var[:first] = x, p + s2
    missed = 0
    for i in range(first, len(n)):
        p += rules.drift**2 * (days[i] - days[i - 1]) * 4**missed
        level[i], var[i] = x, p + s2
        if not know[i]:
            continue
        noise = 1.57 * s2 / n[i]
        step = mid[i] - x
        if step * step > rules.gate**2 * (p + noise):
            missed += 1
            continue
        missed = 0
        x, p = x + p / (p + noise) * step, p * noise / (p + noise)
        if n[i] >= 8:
            s2 = 0.9 * s2 + 0.1 * max(spread[i] ** 2, 1e-4)
    return level, var


def level_days(pdf: pd.DataFrame, rules: SpikeRules) -> pd.DataFrame:
    """One source's days, in any order -> forecasts of its log speed and log rate."""
    pdf = pdf.sort_values("day").reset_index(drop=True)
    days, n = _day_numbers(pdf), pdf["n"].to_numpy(float)
    out = {"source": pdf["source"], "day": pdf["day"]}
    for c in ("v", "w"):
        q = np.array([[np.nan] * 3 if x is None else x for x in pdf[c]], float)
        out[c], out[f"{c}_var"] = follow(days, n, q[:, 1], (q[:, 2] - q[:, 0]) / 1.349, rules)
    return pd.DataFrame(out)


_SUMS = ("n", "a00", "a01", "a02", "a11", "a12", "a22", "b0", "b1", "b2", "s", "ss")


def _sums(j: DataFrame, kept: Column) -> DataFrame:
    """Sufficient statistics of a source's day over the kept trips: of 1 = z.tariff + e with z = (1, dist, dur) / fare, and of the log speed."""
    z = [F.try_divide(x, F.col("fare")) for x in (F.lit(1.0), F.col("dist"), F.col("dur"))]
    sums = {"n": F.lit(1.0), "s": _log_speed(), "ss": _log_speed() * _log_speed()}
    for i in range(3):
        sums[f"b{i}"] = z[i]
        for k in range(i, 3):
            sums[f"a{i}{k}"] = z[i] * z[k]
    return j.groupBy("source", "day").agg(*(F.coalesce(F.sum(F.when(kept, sums[k])), F.lit(0.0)).alias(k) for k in _SUMS))


_COV = ("p00", "p01", "p02", "p11", "p12", "p22")
_FORECAST = "source string, day date, t0 double, t1 double, t2 double, t_var double, v double, v_var double, " + ", ".join(f"{c} double" for c in _COV)


def kalman_days(pdf: pd.DataFrame, rules: SpikeRules) -> pd.DataFrame:
    """One source's days, in any order -> forecasts with their variances.

    Tariff: information-form filter over the day's sums, state covariance
    p00 .. p22, observation variance t_var from the days before. Speed: local
    level, v_var is the innovation variance of a trip.
    """
    pdf = pdf.sort_values("day").reset_index(drop=True)
    days, n = _day_numbers(pdf), pdf["n"].to_numpy(float)
    A = np.empty((len(pdf), 3, 3))
    for i in range(3):
        for k in range(i, 3):
            A[:, i, k] = A[:, k, i] = pdf[f"a{i}{k}"]
    b, s, ss = pdf[["b0", "b1", "b2"]].to_numpy(float), pdf["s"].to_numpy(float), pdf["ss"].to_numpy(float)
    out = pdf[["source", "day"]].copy()
    for c in _FORECAST.split(", ")[2:]:
        out[c.split()[0]] = np.nan
    m = _start(n, rules.start)
    if n[:m].sum() < 4:
        return out
    rss = lambda x, k: max(float(n[k].sum() - 2 * x @ b[k].sum(0) + x @ A[k].sum(0) @ x), 0.0)
    first = slice(0, m)
    x = np.linalg.lstsq(A[first].sum(0), b[first].sum(0), rcond=1e-9)[0]
    scale = np.maximum(np.abs(x), 1e-3)
    var = max(rss(x, first) / max(n[first].sum() - 3, 1), 1e-4)
    P = np.linalg.inv(A[first].sum(0) / var + np.diag(1 / (4 * scale**2)))
    v = s[first].sum() / n[first].sum()
    v_var = max(ss[first].sum() / n[first].sum() - v * v, 1e-4)
    vp = v_var / n[first].sum()
    rows = np.empty((len(pdf), 12))
    for i in range(len(pdf)):
        if i >= m:
            gap = days[i] - days[i - 1]
            P = P + np.diag((rules.drift * scale) ** 2) * gap
            vp += rules.drift**2 * gap
        rows[i] = [*x, var, v, vp + v_var, P[0, 0], P[0, 1], P[0, 2], P[1, 1], P[1, 2], P[2, 2]]
        if i < m or not n[i]:
            continue
        before, (v_new, weight) = x, (s[i] / n[i], n[i] / (n[i] + 20))
        old = np.linalg.inv(P)
        info = old + A[i] / var
        x = np.linalg.solve(info, old @ x + b[i] / var)
        P = np.linalg.inv(info)
        scale = np.maximum(np.abs(x), 1e-3)
        var = max((1 - 0.1 * weight) * var + 0.1 * weight * rss(before, slice(i, i + 1)) / n[i], 1e-4)
        v_var = max((1 - 0.1 * weight) * v_var + 0.1 * weight * max(ss[i] / n[i] - v_new**2, 0.0), 1e-4)
        gain = vp / (vp + v_var / n[i])
        v, vp = v + gain * (v_new - v), vp * (1 - gain)
    rows[:m] = rows[m - 1]  # the starting days are judged by the state after them
    out.iloc[:, 2:] = rows
    lost = out["day"].map(lambda d: d.toordinal()) == 1
    out.loc[lost, out.columns[2:]] = rows[-1]  # readings without a pickup: the last state
    return out


def _tariff(dist: Column, dur: Column) -> Column:
    return F.col("t0") + F.col("t1") * dist + F.col("t2") * dur


def _fare_innovation(dist: Column, dur: Column, fare: Column) -> Column:
    """Standardised: |1 - tariff / fare| over the root of the forecast's variance."""
    z = [F.try_divide(x, fare) for x in (F.lit(1.0), dist, dur)]
    var = F.col("t_var")
    for i in range(3):
        for k in range(i, 3):
            var = var + (1 if i == k else 2) * F.col(f"p{i}{k}") * z[i] * z[k]
    return F.try_divide(F.abs(1 - F.try_divide(_tariff(dist, dur), fare)), F.sqrt(var))


def _speed_innovation(dist: Column, dur: Column) -> Column:
    return F.try_divide(F.abs(F.ln(F.try_divide(dist, dur)) - F.col("v")), F.sqrt("v_var"))


def forecasts(r: DataFrame, rules: SpikeRules) -> tuple[DataFrame, DataFrame]:
    """The sources' usual sizes, and the forecasts: a row a source and day with a trip."""
    rough = materialise(_rough(r, rules).where("source is not null"))  # a row a source
    sound = r.where("source is not null").withColumn("sound", F.expr(_SOUND) & ~F.col("rate_type").eqNullSafe(rules.flat))
    levels = materialise(_quartiles(r, rules).groupBy("source").applyInPandas(lambda p: level_days(p, rules), _LEVELS))
    j = sound.join(levels, ["source", "day"])
    near = F.col("sound") & (_speed_innovation(F.col("dist"), F.col("dur")) < rules.sure) & (F.abs(_log_rate() - F.col("w")) < rules.sure * F.sqrt("w_var"))
    run = lambda sums: sums.groupBy("source").applyInPandas(lambda p: kalman_days(p, rules), _FORECAST)
    first = materialise(run(_sums(j, near)))
    j = sound.join(first, ["source", "day"])
    clean = F.col("sound") & (_speed_innovation(F.col("dist"), F.col("dur")) < rules.sure) & (_fare_innovation(F.col("dist"), F.col("dur"), F.col("fare")) < rules.sure)
    return rough, materialise(run(_sums(j, clean)))


def judge(r: DataFrame, rough: DataFrame, days: DataFrame, rules: SpikeRules) -> DataFrame:
    """record_id, field of the readings that are impossible or spikes; map-only apart from the joins to the small state tables."""
    j = r.join(rough, "source", "left").join(days, ["source", "day"], "left")
    dist, fare, dur, v = F.col("dist"), F.col("fare"), F.col("dur"), F.col("v")
    flat = F.col("rate_type").eqNullSafe(rules.flat) | (F.col("rate_type").isNull() & (F.col("fare") == F.col("flat_fare")))
    low_d = dist <= F.coalesce(rules.tiny * F.exp("m_dist"), F.lit(0.0))
    low_f = fare <= F.coalesce(rules.tiny * F.exp("m_fare"), F.lit(0.0))
    d_ok = dist.isNotNull() & ~low_d
    f_ok = fare.isNotNull() & ~low_f
    within = lambda d, t, g: F.coalesce((d > 0) & (t > 0) & (_speed_innovation(d, t) < g), F.lit(False))
    fits = lambda d, t: within(d, t, rules.sure)
    # hours over the source's longest trips, unless the distance bears it out
    late = (dur > F.col("long_dur") + rules.late_min) & ~fits(dist, dur)
    bad_t = F.coalesce(late | (dur <= 0), F.lit(False))
    t_ok = dur.isNotNull() & ~bad_t
    tariff = lambda d, t: F.when(flat, F.col("flat_fare")).otherwise(_tariff(d, t))
    pays = F.when(flat, F.abs(1 - F.try_divide("flat_fare", fare)) < 0.03).otherwise(_fare_innovation(dist, dur, fare) < rules.gate)
    # what the other two readings say
    dist_f = F.try_divide(fare - F.col("t0") - F.col("t2") * dur, F.col("t1"))
    dur_f = F.try_divide(fare - F.col("t0") - F.col("t1") * dist, F.col("t2"))
    dist_t = dur * F.exp(v)
    dur_d = dist / F.exp(v)
    off = lambda a, b: F.coalesce(F.greatest(F.try_divide(a, b), F.try_divide(b, a)) > rules.beyond, F.lit(True))
    far = lambda x, m: F.abs(F.ln(x) - F.col(m))
    whole = d_ok & t_ok
    agree = within(dist, dur, rules.gate)
    fare_side = F.when(whole & agree, tariff(dist, dur)).when(d_ok & ~agree & ~t_ok, tariff(dist, dur_d)).when(t_ok & ~d_ok, tariff(dist_t, dur))
    fare_spike = f_ok & fare_side.isNotNull() & off(fare, fare_side) & ~F.coalesce(whole & pays, F.lit(False))
    # speed out of bounds: distance or time is at fault
    odd = whole & v.isNotNull() & ~agree
    by_dist = F.when(flat | ~f_ok, far(dist, "m_dist") >= far(dur, "m_dur")).otherwise(fits(dist_f, dur) | (~fits(dist, dur_f) & (far(dist, "m_dist") >= far(dur, "m_dur"))))
    dist_spike = odd & by_dist & off(dist, dist_t)
    time_spike = odd & ~by_dist & off(dur, dur_d)
    # time unknown: the fare has to bear the distance out
    dist_spike = dist_spike | (d_ok & ~t_ok & f_ok & ~flat & off(tariff(dist, dur_d), fare) & off(dist, F.exp("m_dist")) & (far(dist, "m_dist") > far(fare, "m_fare")))
    fare_spike = fare_spike & ~dist_spike
    hit = F.array_compact(
        F.array(
            F.when(F.coalesce(low_d | dist_spike, F.lit(False)), F.lit("trip_distance")),
            F.when(F.coalesce(low_f | fare_spike, F.lit(False)), F.lit("fare_amount")),
            F.when(F.coalesce(bad_t | time_spike, F.lit(False)), F.lit("lpep_dropoff_datetime")),
        )
    )
    return j.select("record_id", F.explode(hit).alias("field"))


_FIELDS = {"dist": "trip_distance", "fare": "fare_amount", "dropoff": "lpep_dropoff_datetime"}
_ORDER = ["pickup", "trip", "record_id"]


def stuck_runs(r: DataFrame, rules: SpikeRules) -> DataFrame:
    """record_id, field: readings of a run of ``rules.run`` or more trips of one meter whose innovations have vanished.

    A trip counts once, by its first record. Meters are spread by their key in
    one shuffle; the trips of a meter with more than ``block`` rows are first
    spread over their minutes, ranked by the minutes' prefix counts, and looked
    at in blocks of ranks, each with the ``run - 1`` trips beside it. Both ways
    have the same rule and result.
    """
    rows = r.where("meter_id is not null and pickup is not null").select("meter_id", "pickup", "trip_id", "record_id", *_FIELDS)
    # a null trip_id is a trip of its own; the text keeps it apart from all numbers
    rows = rows.withColumn("trip", F.coalesce(F.format_string("t%020d", "trip_id"), F.format_string("r%020d", "record_id")))
    hot = materialise(rows.groupBy("meter_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rules.block).select("meter_id"))  # few: each has more than a block
    none_hot = hot.isEmpty()
    calm = (rows if none_hot else rows.join(hot, "meter_id", "left_anti")).withColumn("seg", F.lit(0).cast("bigint")).repartition("meter_id")
    once = F.row_number().over(W.partitionBy("meter_id", "trip").orderBy("record_id"))  # served by the same shuffle
    first = calm.withColumn("k", once).where("k = 1").drop("k").withColumn("core", F.lit(True))
    found = _carriers(calm, _flag_runs(first, rules))
    if none_hot:
        return found
    h = rows.join(hot, "meter_id", "left_semi")
    first = h.withColumn("k", once).where("k = 1").drop("k").withColumn("slot", F.date_trunc("minute", "pickup"))
    slots = first.groupBy("meter_id", "slot").agg(F.count(F.lit(1)).alias("n"))
    slots = slots.select("meter_id", "slot", (F.sum("n").over(W.partitionBy("meter_id").orderBy("slot")) - F.col("n")).alias("base"))
    first = first.join(slots, ["meter_id", "slot"])
    rank = F.col("base") + F.row_number().over(W.partitionBy("meter_id", "slot").orderBy(*_ORDER)) - 1
    first = first.withColumn("rank", rank).withColumn("own", F.floor(F.col("rank") / rules.block))
    at, halo = F.col("rank") % rules.block, rules.run - 1
    beside = F.array_compact(F.array(F.col("own"), F.when((at < halo) & (F.col("own") > 0), F.col("own") - 1), F.when(at >= rules.block - halo, F.col("own") + 1)))
    first = first.withColumn("seg", F.explode(beside)).withColumn("core", F.col("seg") == F.col("own"))
    return found.unionByName(_carriers(h, _flag_runs(first, rules)))


def _flag_runs(first: DataFrame, rules: SpikeRules) -> DataFrame:
    """Trips of runs, with the value of each field that stands still: one window order for all.

    ``still`` counts the trips up to this one without an innovation, at most run - 1;
    the trip belongs to a run if the still trips behind and ahead make it up.
    """
    w = W.partitionBy("meter_id", "seg").orderBy(*_ORDER)
    need = rules.run
    idx = first.withColumn("i", F.row_number().over(w)).withColumns({f"{f}_new": F.coalesce(F.lag(f).over(w) != F.col(f), F.lit(True)) for f in _FIELDS})
    ahead, behind = w.rowsBetween(1, need), w.rowsBetween(-(need - 1), 0)
    cols = {"more": F.count(F.lit(1)).over(ahead)}
    for f in _FIELDS:
        start = F.when(F.col(f"{f}_new"), F.col("i"))
        cols[f"{f}_back"] = F.max(start).over(behind)
        cols[f"{f}_fwd"] = F.min(start).over(ahead)
    d = idx.withColumns(cols)
    flags, any_ = [], F.lit(False)
    for f in _FIELDS:
        back = F.coalesce(F.col("i") - F.col(f"{f}_back"), F.lit(need - 1))
        fwd = F.coalesce(F.col(f"{f}_fwd") - F.col("i"), F.least(F.col("more"), F.lit(need - 1)) + 1)
        flags.append(F.when(F.col(f).isNotNull() & (back + fwd >= need), F.col(f)).alias(f"{f}_v"))
        any_ = any_ | F.col(f"{f}_v").isNotNull()
    return d.where("core").select(F.col("meter_id").alias("_meter"), F.col("trip").alias("_trip"), *flags).where(any_)


def _carriers(rows: DataFrame, stuck: DataFrame) -> DataFrame:
    """Every record of a stuck trip that carries the run's value."""
    j = rows.join(stuck, (rows["meter_id"] == stuck["_meter"]) & (rows["trip"] == stuck["_trip"]))
    hit = F.array_compact(F.array(*(F.when(F.col(f) == F.col(f"{f}_v"), F.lit(name)) for f, name in _FIELDS.items())))
    return j.select("record_id", F.explode(hit).alias("field"))


def implausible(trips: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """record_id, field (trip_distance, fare_amount, lpep_dropoff_datetime) of every implausible reading, once each."""
    r = readings(trips)
    rough, days = forecasts(r, rules)
    return judge(r, rough, days, rules).unionByName(stuck_runs(r, rules)).distinct()
