"""Operators of the data pipeline on small fixtures with known answers and on odd input."""

from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions import scalars as S
from marlstone.operators import column_profile as C, drift as D, impute as I, skew as K, spikes as P

TRIP = "record_id bigint, trip_id bigint, load_id bigint, meter_id string, vendor string, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, passenger_count int, trip_distance double, rate_type string, payment_type string, fare_amount double, extra double, pu_location string, fill string, seg int"
T0 = datetime(2031, 3, 3, 6)


def trip(i, minutes=0, dist=2.0, fare=None, dur=10.0, meter="m", vendor="v", trip_id=None, pc=1, pay="card", extra=0.5, rate="standard"):
    start = T0 + timedelta(minutes=minutes)
    fare = 3 + 2 * dist + 0.3 * dur if fare is None else fare
    return (i, i if trip_id is None else trip_id, 1, meter, vendor, start, start + timedelta(minutes=dur), pc, dist, rate, pay, fare, extra, "1", "x", 0)


def many(n=400):
    rng = np.random.default_rng(3)
    out = []
    for i in range(n):
        d = float(np.round(np.exp(rng.normal(0.7, 0.5)), 2))
        t = round(d / 0.2 * rng.uniform(0.75, 1.25), 2)
        out.append(trip(i, minutes=i * 60, dist=d, dur=t, fare=round((3 + 2 * d + 0.3 * t) * rng.uniform(0.98, 1.02), 2), meter=f"m{i % 7}"))
    return out


# ---------------------------------------------------------------- scalars


@pytest.mark.parametrize("text,number", [("93", 93), ("Z93", 93), ("zone-93", 93), ("0093", 93), ("93.0", 93), (" 93", 93), ("93?", 93), ("x", None), ("", None), (None, None)])
def test_zone_spellings(spark, text, number):
    assert spark.createDataFrame([(text,)], "z string").select(S.zone_number("z")).first()[0] == number


def test_value_kinds(spark):
    want = {"12": "integer", "1.50": "decimal", "2031-03-04T10:00:00": "timestamp", "2031/03/04 10:00:00": "timestamp", "Z9": "text", "NaN": None, "\\N": None, "": None, "-": None}
    df = spark.createDataFrame([(k,) for k in want], "v string")
    assert {r[0]: r[1] for r in df.select("v", S.value_kind("v")).collect()} == want


# ---------------------------------------------------------------- drift

FILES = "file_id bigint, feed string, file_format string, separator string, delivered_at timestamp_ntz, line string"


def files(spark, *rows):
    return spark.createDataFrame([(i, feed, fmt, sep, T0 + timedelta(days=day), "clash") for i, feed, fmt, sep, day in rows], FILES)


def raw(spark, lines):
    return spark.createDataFrame([(f, n + 1, x) for f, ls in lines.items() for n, x in enumerate(ls)], "file_id bigint, line_no int, line string")


def changes(spark, lines, meta):
    f = files(spark, *meta)
    return {tuple(r) for r in D.schema_changes(D.parse_lines(raw(spark, lines), f), f).collect()}


def test_drift_reports_every_kind_of_change(spark):
    lines = {
        7: ["Trip Ref,Rate Type,Extra,Note", "1,1.0,0.50,a", "2,2.0,1.00,b"],
        3: ["trip_ref;tariff;extra;ehail_fee", "3;standard;50;1.20", "4;outer;100;0.80"],
        5: ["trip_ref;tariff;extra;ehail_fee", "5;;;", "6;;;"],
        9: ['{"trip_ref": 7, "tariff": "standard", "extra": 1.5, "Ehail Fee": null}', '{"trip_ref": 8, "tariff"'],
    }
    meta = [(7, "a", "csv", ",", 0), (3, "a", "csv", ";", 1), (5, "a", "csv", ";", 2), (9, "a", "jsonl", None, 3)]
    assert changes(spark, lines, meta) == {
        (3, "tariff", "renamed"), (3, "tariff", "retyped"), (3, "extra", "retyped"), (3, "ehail_fee", "added"), (3, "note", "removed"), (9, "extra", "retyped"),
    }


def test_drift_finds_unknown_renames_by_shared_trips(spark):
    rows = [(i, f"{i * 3}.5") for i in range(1, 9)]
    lines = {1: ["trip_ref,alpha", *(f"{a},{b}" for a, b in rows)], 2: ["trip_ref,omega,plus", *(f"{a},{b},q" for a, b in rows)]}
    assert changes(spark, lines, [(1, "a", "csv", ",", 0), (2, "a", "csv", ",", 1)]) == {(2, "omega", "renamed"), (2, "plus", "added")}


def test_drift_finds_listed_fields_under_unlisted_names_and_back(spark):
    word = ["standard", "standard", "airport", "standard", "outer", "airport"]
    code = {"standard": "1", "airport": "2", "outer": "3"}
    csv = lambda head, values, at=1: [f"trip_ref,{head}", *(f"{at + i},{v}" for i, v in enumerate(values))]
    fee = ["0.80", "1.20", "1.65", "0.80", "1.20", "0.80"]
    lines = {
        1: csv("rate_type", word),
        2: csv("zug", word),
        3: csv("zug", [code[w] for w in word], 50),
        4: csv("tariff", [code[w] for w in word], 90),  # by the name carried on: no trip is shared
        5: csv("zug", word, 130),
        6: csv("rate_type", [code[w] for w in word]),
        7: csv("rate_type", word),
        8: csv("kind_of_fare", [code[w] for w in word]),  # the codes are learnt from feed b's files
        11: csv("levy", fee),
        12: csv("ehail_fee", [str(round(float(x) * 100)) for x in fee]),
        13: csv("levy", fee, 50),
        14: csv("oddity", ["p", "q", "p", "q", "p", "q"], 50),
    }
    meta = [(i, "a" if i < 6 else "b" if i < 10 else "c", "csv", ",", i) for i in lines]
    assert changes(spark, lines, meta) == {
        (2, "zug", "renamed"), (3, "zug", "retyped"), (4, "tariff", "renamed"), (5, "zug", "renamed"), (5, "zug", "retyped"), (7, "rate_type", "retyped"),
        (8, "kind_of_fare", "renamed"), (8, "kind_of_fare", "retyped"), (12, "ehail_fee", "renamed"), (12, "ehail_fee", "retyped"), (13, "levy", "renamed"), (13, "levy", "retyped"),
        (14, "levy", "removed"), (14, "oddity", "added"),
    }


def test_drift_conforms_rescues_and_promotes(spark):
    lines = {1: ["trip_ref,pickup_zone,congestion_fee,extra,toll_total,vendor", '1,Z007,275,x,$3.05,"a, ""b"""', "2,9,2.75,0.50", "", None], 2: []}
    f = files(spark, (1, "a", "csv", ",", 0), (2, "a", "csv", ",", 1))
    t = D.conform(D.parse_lines(raw(spark, lines), f))
    rows = sorted(t.collect(), key=lambda r: r.line_no)
    assert len(rows) == 4
    assert (rows[0].trip_ref, rows[0].pu_location, rows[0].congestion_surcharge, rows[0].extra, rows[0].vendor) == (1, 7, 2.75, None, 'a, "b"')
    assert '"extra":"x"' in rows[0]._rescued and "_line" in rows[1]._rescued and rows[1].trip_ref is None
    p = D.promote(t, {"tolls_amount": "money"}).where("trip_ref = 1").first()
    assert p.tolls_amount == 3.05 and "toll_total" not in p._rescued and "extra" in p._rescued


def test_drift_reads_money_by_the_kind_of_the_files_field(spark):
    lines = {
        1: ["trip_ref,fare_amount", *(f"{i},{i}.50" for i in range(1, 12)), "12,12"],
        2: ["trip_ref,fare_amount", *(f"{i},{i}50" for i in range(1, 12))],
        3: [*(f'{{"trip_ref": {i}, "fare_amount": {i}.25}}' for i in range(2, 12)), '{"trip_ref": 1, "fare_amount": 1}'],
    }
    f = files(spark, (1, "a", "csv", ",", 0), (2, "a", "csv", ",", 1), (3, "b", "jsonl", None, 1))
    got = {(r.file_id, r.trip_ref): r.fare_amount for r in D.conform(D.parse_lines(raw(spark, lines), f)).collect()}
    assert (got[1, 12], got[1, 2], got[2, 3], got[3, 1], got[3, 4]) == (12.0, 2.5, 3.5, 1.0, 4.25)


def test_drift_finds_renames_by_rescued_values_alone(spark):
    fee = ["0.80", "1.20", "1.65", "0.80", "1.20"]
    lines = {
        1: ["trip_ref,ehail_fee,vendor", *(f"{i},{v},x" for i, v in enumerate(fee))],
        2: ["trip_ref,app_fee,vendor", *(f"{i},{round(float(v) * 100)},x" for i, v in enumerate(fee))],
    }
    f = files(spark, (1, "a", "csv", ",", 0), (2, "a", "csv", ",", 1))
    p = D.parse_lines(raw(spark, lines), f)
    got = {tuple(r) for r in D.schema_changes(p, f, D.DriftRules(aliases={})).collect()}
    assert got == {(2, "app_fee", "renamed"), (2, "app_fee", "retyped")}


def test_drift_learns_a_name_from_the_other_feeds(spark):
    rows = [(i, "pqrs"[i % 4]) for i in range(10)]
    csv = lambda name, at: [f"trip_ref,{name},extra", *(f"{at + i},{v},0.50" for i, v in rows)]
    lines = {1: csv("vendor", 0), 2: csv("zug", 0), 3: csv("vendor", 50), 4: csv("zug", 90), 5: csv("zog", 120)}
    meta = [(1, "a", "csv", ",", 0), (2, "a", "csv", ",", 1), (3, "b", "csv", ",", 0), (4, "b", "csv", ",", 1), (5, "b", "csv", ",", 2)]
    assert changes(spark, lines, meta) == {(2, "zug", "renamed"), (4, "zug", "renamed"), (5, "zug", "removed"), (5, "zog", "added")}


def test_drift_odd_lines(spark):
    lines = {1: ["a,a,trip_ref", "1,2,3", "4", '"x,y",5,6', "7,8,9"], 2: [], 5: ["b,c"], 9: ["no,file"]}
    f = files(spark, (1, "a", "csv", ",", 0), (2, "a", "csv", ",", 1), (5, "a", "csv", ",", 2))
    t = D.conform(D.parse_lines(raw(spark, lines), f))
    got = {(r.file_id, r.line_no): (r.trip_ref, r._rescued) for r in t.collect()}
    assert got == {(1, 2): (3, '{"a":"2"}'), (1, 3): (None, '{"_line":"4"}'), (1, 4): (6, '{"a":"5"}'), (1, 5): (9, '{"a":"8"}'), (9, 1): (None, '{"_line":"no,file"}')}


def test_drift_on_empty_tables(spark):
    f = files(spark).where("false")
    p = D.parse_lines(raw(spark, {1: ["x"]}).where("false"), f)
    assert D.schema_changes(p, f).count() == 0 and D.conform(p).count() == 0


# ---------------------------------------------------------------- profile


def _profile(spark, values):
    df = spark.createDataFrame(values, "load_id bigint, v double, text string")
    v = S.real_number("v")
    counts = C.value_counts(df, "load_id", {"v": {"text": v, "number": v, "in_range": v.between(0, 100), "well_formed": F.lit(True)}})
    groups = df.select(F.col("load_id").alias("load"), F.lit("d").alias("grp")).distinct()
    return counts, groups


def test_profile_is_exact(spark):
    rng = np.random.default_rng(1)
    data = {k: np.round(rng.normal(40 + 5 * k, 8, 300), 1) for k in range(4)}
    counts, groups = _profile(spark, [(k, float(x), "t") for k, xs in data.items() for x in xs] + [(0, None, "t"), (0, float("nan"), "t")])
    got = {r.load: r for r in C.profile(counts, groups).collect()}
    for k, xs in data.items():
        s = np.sort(xs[(xs >= 0) & (xs <= 100)])
        assert got[k].n_distinct == len(set(xs)) and got[k].q_50 == s[int(np.ceil(0.5 * len(s))) - 1] and got[k].q_25 == s[int(np.ceil(0.25 * len(s))) - 1]
        rest = np.sort(np.concatenate([x for j, x in data.items() if j != k]))
        at = np.concatenate([s, rest])
        ks = np.abs(np.searchsorted(s, at, "right") / len(s) - np.searchsorted(rest, at, "right") / len(rest)).max()
        assert got[k].ks == pytest.approx(ks)
    assert got[0].n_null == 2


def test_profile_off_loads(spark):
    rows = [(k, float(x % 20 + 1), "t") for k in range(5) for x in range(200)]
    rows = [(k, None if k == 2 and i % 3 == 0 else v * 3 if k == 4 else v, t) for i, (k, v, t) in enumerate(rows)]
    counts, groups = _profile(spark, rows)
    off = C.off_loads(C.profile(counts, groups), C.zone_shares(counts, groups, "v"), {"v": {"nulls": 0.1, "range": 0.05, "median": 0.4}})
    assert {tuple(r) for r in off.collect()} == {(2, "v", "nulls"), (4, "v", "distribution")}


def test_profile_of_loads_outside_the_table_of_loads(spark):
    rows = [(k, float(x % 20 + 1) * (3 if k is None else 1), "t") for k in (None, 7, 8, 9) for x in range(100)]
    df = spark.createDataFrame(rows, "load_id bigint, v double, text string")
    v = S.real_number("v")
    counts = C.value_counts(df, "load_id", {"v": {"text": v, "number": v, "in_range": v.between(0, 100), "well_formed": F.lit(True)}})
    groups = spark.createDataFrame([(50, "elsewhere")], "load bigint, grp string")
    prof = C.profile(counts, groups)
    got = {r.load: (r.q_50, r.ks) for r in prof.collect()}
    assert {k: q for k, (q, _) in got.items()} == {None: 30.0, 7: 10.0, 8: 10.0, 9: 10.0}
    assert got[None][1] == pytest.approx(0.7) and got[7][1] > 0.2
    off = C.off_loads(prof, C.zone_shares(counts, groups, "v"), {"v": {"median": 0.4, "share": 0.04}})
    assert {tuple(r) for r in off.collect()} == {(None, "v", "distribution")}


@pytest.mark.parametrize("width", ["1", "7"])
def test_ranks_do_not_depend_on_the_partitions(spark, width):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        counts = spark.createDataFrame([("v", "g", k, float(x), 1 + x % 3) for k in range(3) for x in range(50 * (1 + 20 * (k == 1)))], "field string, grp string, load bigint, number double, n bigint")
        got = {(r.load, r.number): r.below for r in C.ranked_curves(counts).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(got) == 1150 and all(b == sum(1 + y % 3 for y in range(int(x))) for (k, x), b in got.items())


def test_profile_all_null_and_empty(spark):
    counts, groups = _profile(spark, [(1, None, "t")])
    r = C.profile(counts, groups).first()
    assert r.n_null == 1 and r.q_50 is None and r.ks is None
    counts, groups = _profile(spark, [(1, 1.0, "t")])
    assert C.profile(counts.where("false"), groups).count() == 0


# ---------------------------------------------------------------- spikes


def found(spark, rows, **rules):
    return {tuple(r) for r in P.implausible(spark.createDataFrame(rows, TRIP), P.SpikeRules(**rules)).collect()}


def test_spikes_name_the_faulty_reading(spark):
    rows = many()
    fix = lambda i, **kw: tuple(kw.get(n, v) for n, v in zip([c.split()[0] for c in TRIP.split(", ")], rows[i]))
    r = rows[50]
    rows[50] = fix(50, trip_distance=r[8] * 40)
    rows[90] = fix(90, fare_amount=rows[90][11] * 12)
    rows[130] = fix(130, lpep_dropoff_datetime=rows[130][5] - timedelta(minutes=5))
    rows[170] = fix(170, lpep_dropoff_datetime=rows[170][6] + timedelta(hours=14))
    rows[210] = fix(210, fare_amount=0.01)
    rows[250] = fix(250, trip_distance=None)
    rows[260] = trip(260, minutes=260 * 60, dist=30.0, dur=150.0, fare=108.0, meter="m9")  # long, dear, consistent
    assert found(spark, rows) == {(50, "trip_distance"), (90, "fare_amount"), (130, "lpep_dropoff_datetime"), (170, "lpep_dropoff_datetime"), (210, "fare_amount")}


@pytest.mark.parametrize("block", [500_000, 8])
def test_spikes_stuck_runs(spark, block):
    rows = [trip(i, minutes=15 * i, dist=1 + i / 10, dur=5 * (1 + i / 10)) for i in range(30)]
    stuck = lambda i: tuple(2.22 if n == 8 else v for n, v in enumerate(rows[i]))
    for i in (*range(3, 9), *range(20, 25)):  # six in a row; five in a row
        rows[i] = stuck(i)
    again = list(rows[4])
    again[0] = 100  # the trip sent again
    assert {x for x in found(spark, [*rows, tuple(again)], block=block, beyond=1e9) if x[1] == "trip_distance"} == {(i, "trip_distance") for i in (3, 4, 5, 6, 7, 8, 100)}


@pytest.mark.parametrize("block", [500_000, 8])
def test_spikes_count_a_trip_sent_again_once(spark, block):
    rows = [trip(i, minutes=15 * i, dist=2.22 if 10 <= i < 15 else 1 + i / 10, dur=20 * (1 + i / 10)) for i in range(30)]
    later = list(rows[12])
    later[0], later[5], later[6] = 100, later[5] + timedelta(minutes=70), later[6] + timedelta(minutes=70)  # five equal trips, one of them again with another pickup
    assert found(spark, [*rows, tuple(later)], block=block, beyond=1e9) == set()
    sixth = [trip(15, minutes=15 * 15, dist=2.22, dur=50.0)]
    got = found(spark, [*rows[:15], *sixth, *rows[16:], tuple(later)], block=block, beyond=1e9)
    assert got == {(i, "trip_distance") for i in (*range(10, 16), 100)}


def test_spikes_of_a_drifting_source_need_the_filter(spark):
    rng = np.random.default_rng(5)
    rows = []
    for day in range(120):
        up = 3.2 ** (day / 119)  # the tariff more than trebles
        for k in range(12):
            d = float(np.round(np.exp(rng.normal(0.7, 0.5)), 2))
            t = round(d / 0.2 * rng.uniform(0.75, 1.25), 2)
            rows.append(trip(len(rows), minutes=1440 * day + 60 * k, dist=d, dur=t, fare=round(up * (3 + 2 * d + 0.3 * t) * rng.uniform(0.98, 1.02), 2), meter=f"m{k}"))
    at = 12 * 117 + 4
    low = list(rows[at])
    low[11] = round(low[11] / 3, 2)  # the fare of the first days
    rows[at] = tuple(low)
    assert found(spark, rows) == {(at, "fare_amount")}
    assert (at, "fare_amount") not in found(spark, rows, drift=0.0)


def test_kalman_looks_back_only():
    rng = np.random.default_rng(2)
    n = 40
    mid, spread, count = rng.normal(0, 0.02, n).cumsum(), np.full(n, 0.1), np.full(n, 30.0)
    whole = P.follow(np.arange(n), count, mid, spread, P.SpikeRules())[0]
    bent = mid.copy()
    bent[25:] += 1.0
    assert np.array_equal(P.follow(np.arange(n), count, bent, spread, P.SpikeRules())[0][:26], whole[:26])


def test_spikes_odd_input(spark):
    odd = [trip(1, vendor=None), trip(2, dist=float("nan")), (3, *[None] * 15), trip(4, dist=-1.0), trip(4, dist=-1.0)]
    assert found(spark, odd) == {(4, "trip_distance")}
    assert P.implausible(spark.createDataFrame([], TRIP)).count() == 0


# ---------------------------------------------------------------- imputation


def test_chow_liu_matches_brute_force():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, 4000)
    data = np.stack([x, (x + (rng.random(4000) < 0.2)) % 3, (x * 2 + (rng.random(4000) < 0.3)) % 4, rng.integers(0, 2, 4000)], 1)
    nodes = [I.Node(f"n{i}", int(data[:, i].max()) + 1) for i in range(4)]
    joints = {(i, j): np.histogram2d(data[:, i], data[:, j], [range(nodes[i].size + 1), range(nodes[j].size + 1)])[0] for i in range(4) for j in range(i + 1, 4)}
    tree = I.chow_liu(nodes, joints)
    codes = np.array([[-1, 1, -1, 0], [-1, 2, 3, -1], [-1, -1, -1, -1]])
    post = I.posteriors(tree, codes, [0, 2])
    import itertools

    for row, c in enumerate(codes):
        p = np.zeros(nodes[0].size)
        for z in itertools.product(*(range(n.size) for n in nodes)):
            if all(v < 0 or v == z[i] for i, v in enumerate(c)):
                w = 1.0
                for i in range(4):
                    w *= tree.cpt[i][0 if tree.parent[i] < 0 else z[tree.parent[i]], z[i]]
                p[z[0]] += w
        assert post[0][row] == pytest.approx(p / p.sum())


def test_imputation_follows_shift_source_and_marks(spark):
    rows = [trip(i, minutes=10 * (i % 20) + 1440 * (i // 20), meter=f"m{i // 20}", pc=(i // 20) % 3 + 1, pay=("card", "cash")[(i // 20) % 2], extra=0.5) for i in range(200)]
    blank = {5: {7: 99}, 25: {10: "n/a"}, 47: {12: float("nan")}, 66: {7: None, 10: " ", 12: -1.0}}
    rows = [tuple(blank.get(i, {}).get(n, v) for n, v in enumerate(r)) for i, r in enumerate(rows)]
    got = {(r.record_id, r.field): r.fill for r in I.fill_trips(spark.createDataFrame(rows, TRIP)).collect()}
    assert got == {(5, "passenger_count"): "1", (25, "payment_type"): "cash", (47, "extra"): "0.50", (66, "passenger_count"): "1", (66, "payment_type"): "cash", (66, "extra"): "0.50"}


def test_imputation_has_no_caps_on_amounts_or_sources(spark):
    # 40 sources with 8 amounts each, 320 in all; two trips of an hour on each of three days
    rows, want = [], {}
    for v in range(40):
        for h in range(8):
            amount = round(0.03 * (8 * v + h), 2)
            for day in range(3):
                for k in range(2):
                    i = len(rows)
                    blank = day == 1 and k == 0
                    rows.append(trip(i, minutes=1440 * day + 60 * h + 7 * k, meter=f"m{v}", vendor=f"v{v:02d}", extra=None if blank else amount))
                    if blank:
                        want[i] = f"{amount:.2f}"
    got = {r.record_id: r.fill for r in I.fill_trips(spark.createDataFrame(rows, TRIP)).where("field = 'extra'").collect()}
    assert got.keys() == want.keys()
    assert sum(got[i] == w for i, w in want.items()) >= 0.97 * len(want)


def test_quantile_bins_hold_every_value_and_decode_to_medians():
    counts = [(round(x / 100, 2), 1 + x % 7) for x in range(1001)] + [(20.0, 5000)]
    b = I.quantile_bins(counts, 32)
    assert len(b.edges) <= 32 and b.edges[0] == 0.0 and 20.0 in b.edges and list(b.edges) == sorted(b.edges)
    for lo, hi, mid in zip(b.edges, [*b.edges[1:], float("inf")], b.medians):
        inside = np.repeat([v for v, n in counts if lo <= v < hi], [n for v, n in counts if lo <= v < hi])
        assert mid == np.sort(inside)[(len(inside) - 1) // 2]


def test_imputation_odd_input(spark):
    assert I.fill_trips(spark.createDataFrame([], TRIP)).count() == 0
    lone = [(1, *[None] * 15), (1, *[None] * 15)]
    assert Counter((r.field, r.fill) for r in I.fill_trips(spark.createDataFrame(lone, TRIP)).collect()) == {(f, None): 2 for f in ("passenger_count", "payment_type", "extra")}


# ---------------------------------------------------------------- skew


def test_skew_join_equals_plain_join(spark):
    rows = [(i, 1 if i % 3 else i % 50, float(i)) for i in range(3000)] + [(9000, None, 1.0)]
    left = spark.createDataFrame(rows, "id bigint, k int, v double")
    right = spark.createDataFrame([(k, f"z{k}") for k in range(60)] + [(1, "again"), (None, "no")], "k int, name string")
    got = K.fragment_replicate(left, right, ["k"], spread=["id"])
    plain = left.join(right, "k")
    assert Counter(map(tuple, got.select("id", "k", "name").collect())) == Counter(map(tuple, plain.select("id", "k", "name").collect()))
    assert K.fragment_replicate(left, right, ["k"], how="left", spread=["id"]).count() == left.join(right, "k", "left").count()
    with pytest.raises(ValueError):
        K.fragment_replicate(left, right.withColumn("v", F.lit(1)), ["k"])


def test_skew_plan_is_balanced():
    plan = K.pack([((1,), 10_000), ((2,), 900)], [100] * 64, 8)
    assert len(plan.heavy[(1,)]) > 4 and len(set(plan.heavy[(1,)])) == len(plan.heavy[(1,)])
    assert max(plan.loads) < 1.3 * sum(plan.loads) / 8


def test_skew_empty(spark):
    left = spark.createDataFrame([], "id bigint, k int")
    right = spark.createDataFrame([], "k int, name string")
    assert K.per_key(left, right, ["k"], [F.count(F.lit(1)).alias("n")]).count() == 0
