"""SQL of the analytics queries, for an independent engine."""

from __future__ import annotations


CUSTOMER = ["trips_per_month", "avg_spend", "balance", "night_share", "tenure_days", "complaints"]
FEATURES = ["passenger_count", "trip_distance", "fare_amount", "extra", "pickup_hour", "pickup_day_of_week", "trip_duration"]
NUMBERS = ["passenger_count", "trip_distance", "fare_amount", "extra", "total_amount"]
CODED = ["vendor", "store_and_fwd_flag", "rate_type", "payment_type", "trip_type", "pu_location", "do_location"]
TRIPS = ["record_id", "trip_id", "load_id", "meter_id", "vendor", "lpep_pickup_datetime", "lpep_dropoff_datetime", "passenger_count", "trip_distance", "rate_type", "store_and_fwd_flag", "pu_location", "do_location", "payment_type", "trip_type", "fare_amount", "extra", "ehail_fee", "congestion_surcharge", "total_amount"]
K = 4
_TYPES = {"record_id": "bigint", "trip_id": "bigint", "load_id": "bigint", "passenger_count": "int", "lpep_pickup_datetime": "timestamp_ntz", "lpep_dropoff_datetime": "timestamp_ntz", **dict.fromkeys(("trip_distance", "fare_amount", "extra", "ehail_fee", "congestion_surcharge", "total_amount"), "double")}

def _real(c: str) -> str:
    return f"case when isnan({c}::double) then null else {c}::double end"


_PRICE = "case when {0} is null or {0} <= 0 or isnan({0}) then null when {0} <= 10 then 'low' when {0} <= 20 then 'medium' else 'high' end"
_CLEAN = f"""m as (select passenger_count as pc from trips where passenger_count is not null group by 1 order by count(*) desc, 1 limit 1),
t as (select record_id, vendor, store_and_fwd_flag, rate_type, payment_type, trip_type, pu_location, do_location, coalesce(passenger_count, (select pc from m))::bigint as passenger_count, coalesce({_real('extra')}, 0.0) as extra,
 {_real('trip_distance')} as trip_distance, {_real('fare_amount')} as fare_amount, {_real('total_amount')} as total_amount,
 hour(lpep_pickup_datetime)::bigint as pickup_hour, (isodow(lpep_pickup_datetime) - 1)::bigint as pickup_day_of_week,
 date_diff('microsecond', lpep_pickup_datetime, lpep_dropoff_datetime) / 6e7::double as trip_duration from trips where payment_type is not null),
c as (select *, {_PRICE.format('total_amount')} as price_category from t where trip_duration > 1 and trip_duration < 120 and trip_distance > 0 and trip_distance < 100 and fare_amount > 0 and fare_amount < 500)"""
_TEXT = "coalesce({0}::varchar, 'nan')"
_CODES = ", ".join(f"k_{c} as (select v, row_number() over (order by v) - 1 as code from (select distinct {_TEXT.format(c)} as v from c))" for c in CODED)
_CODED_JOINS = " ".join(f"join k_{c} on k_{c}.v = {_TEXT.format('c.' + c)}" for c in CODED)
_INPUTS = [f"c.{x}" for x in FEATURES] + [f"k_{c}.code" for c in CODED]
_LABELLED = f"""{_CLEAN}, {_CODES}, l as materialized (select record_id as id, {', '.join(f'{x}::double as f{i}' for i, x in enumerate(_INPUTS))}, price_category as label from c {_CODED_JOINS} where price_category is not null)"""
_RANKED = f"""{_LABELLED}, r as (select *, row_number() over (partition by label order by md5(id::varchar || '|42'), id) as rk, count(*) over (partition by label) as size from l)"""
_SPLIT = f"{_RANKED}, s as (select *, rk <= floor(size * 0.3 + 0.5) as is_test from r)"
_CUSTOMERS = f"cu as (select id, {', '.join(f'coalesce(max({_real(c)}), 0.0) as {c}' for c in CUSTOMER)} from customer_data group by id)"
_PLANE = "p as (select id, x, y from points where x is not null and y is not null and not isnan(x) and not isnan(y))"
_HEADS = f"{_PLANE}, h as (select row_number() over (order by id) - 1 as cluster, x as cx, y as cy from (select * from p order by id limit {K}))"
_ASSIGN = "a as (select id, x, y, cluster, sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) as distance, cx, cy from p, h), b as (select * from a qualify row_number() over (partition by id order by distance, cluster) = 1)"
_VECTORS = "v as (select vec_id as id, embedding::double[] as e, label::bigint as label from embeddings)"
_EDGES = _VECTORS + ", e as (select a.id as id, b.id as other, list_distance(a.e, b.e) as distance from v a, v b where list_distance(a.e, b.e) <= 1.15)"
_REACH = "reach(id, root) as (select id, id from {core} union select e.other, r.root from reach r join {edges} e on e.id = r.id)"


def _nb(train: str, test: str) -> str:
    n = len(_INPUTS)
    moments = ", ".join(f"avg(f{i}) as m{i}, var_pop(f{i}) as v{i}" for i in range(n))
    top = f"(select greatest({', '.join(f'var_pop(f{i})' for i in range(n))}) from {train})"
    score = " ".join(f"- 0.5 * ln(2 * pi() * (v{i} + 1e-9 * top)) - (f{i} - m{i}) * (f{i} - m{i}) / (2 * (v{i} + 1e-9 * top))" for i in range(n))
    return f"""mo as (select label as cls, count(*) as n, {moments}, {top} as top from {train} group by label),
tot as (select sum(n) as total from mo),
sc as (select t.id, t.label, cls, ln(n / total) {score} as score from {test} t, mo, tot),
nb as (select id, label, cls as prediction from sc qualify row_number() over (partition by id order by score desc, cls) = 1)"""


_NB = f"{_SPLIT}, tr as (select * from s where not is_test), te as (select * from s where is_test), {_nb('tr', 'te')}"
_NAMES = ", names(name) as (values ('low'), ('medium'), ('high')), cm as (select a.name as label, b.name as prediction, (select count(*) from nb where nb.label = a.name and nb.prediction = b.name)::bigint as n from names a, names b)"
_CONF = _NB + _NAMES


def _report(base: str = _CONF) -> str:
    div = "case when {1} = 0 then 0.0 else {0} / {1}::double end"
    return f"""with {base}, per as (select n.name, (select sum(n) from cm where label = n.name and prediction = n.name) as tp, (select sum(n) from cm where label = n.name) as support, (select sum(n) from cm where prediction = n.name) as guessed from names n),
pr as (select name, tp, support, {div.format('tp', 'guessed')} as precision, {div.format('tp', 'support')} as recall from per),
pf as (select *, case when precision + recall = 0 then 0.0 else 2 * precision * recall / (precision + recall) end as f1 from pr)
select name, round(precision, 4) as precision, round(recall, 4) as recall, round(f1, 4) as f1, support::bigint as support from pf
union all select 'accuracy', round(sum(tp) / sum(support)::double, 4), round(sum(tp) / sum(support)::double, 4), round(sum(tp) / sum(support)::double, 4), sum(support)::bigint from pf
union all select 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4), sum(support)::bigint from pf
union all select 'weighted avg', round(sum(precision * support) / sum(support), 4), round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4), sum(support)::bigint from pf"""


def _numbered_nb(train: str, test: str, f: str) -> str:
    """The model's steps under names that end in f."""
    nb = _nb(train, test)
    for name in ("mo", "tot", "sc", "nb"):
        nb = nb.replace(f"{name} as (", f"{name}{f} as (").replace(f"from {name} ", f"from {name}{f} ").replace(f", {name}, ", f", {name}{f}, ").replace(f", {name})", f", {name}{f})").replace(f"from {name})", f"from {name}{f})")
    return nb


def _curve(k: int, fractions: tuple[float, ...]) -> str:
    part = "('0x' || substr(md5(id::varchar || '|42'), 1, 8))::bigint / 4294967296.0::double"
    parts, picks = [f"{_RANKED}, fo as (select *, (rk - 1) % {k} as fold, {part} as part from r)"], []
    for f in range(k):
        for n, q in enumerate(fractions):
            x = f"{f}_{n}"
            parts.append(f"tr{x} as (select * from fo where fold <> {f} and part < {q}), te{x} as (select * from fo where fold = {f} or part < {q}), {_numbered_nb(f'tr{x}', f'te{x}', x)}")
            hit = "avg((nb.label = nb.prediction)::int::double)"
            picks.append(f"select {q}::double as fraction, {f}::bigint as fold, round({hit} filter (fo.fold <> {f} and fo.part < {q}), 4) as train_accuracy, round({hit} filter (fo.fold = {f}), 4) as test_accuracy from nb{x} nb join fo on fo.id = nb.id")
    return f"with {', '.join(parts)} {' union all '.join(picks)}"


def _cv(k: int, fold: str, base: str) -> str:
    parts, picks = [f"{base}, fo as (select *, {fold} as fold from r)"], []
    for f in range(k):
        nb = _numbered_nb(f"tr{f}", f"te{f}", str(f))
        parts.append(f"tr{f} as (select * from fo where fold <> {f}), te{f} as (select * from fo where fold = {f}), {nb}")
        picks.append(f"select {f}::bigint as fold, avg((label = prediction)::int::double) as accuracy from nb{f}")
    return f"with {', '.join(parts)}, cv as ({' union all '.join(picks)})"


def _lloyd(rounds: int) -> str:
    parts = [_HEADS.replace(" h as (", " h0 as (")]
    for n in range(rounds):
        parts.append(f"a{n} as (select id, x, y, cluster from p, h{n} qualify row_number() over (partition by id order by sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), cluster) = 1)")
        parts.append(f"h{n + 1} as (select h.cluster, coalesce(m.cx, h.cx) as cx, coalesce(m.cy, h.cy) as cy from h{n} h left join (select cluster, avg(x) as cx, avg(y) as cy from a{n} group by cluster) m using (cluster))")
    return f"with {', '.join(parts)} select cluster::bigint as cluster, round(cx, 4) as cx, round(cy, 4) as cy from h{rounds}"


def _dbscan(pre: str, least: int) -> str:
    return f"""with recursive {pre}, core as (select id from e group by id having count(*) >= {least}),
ce as (select e.id, e.other from e join core a on a.id = e.id join core b on b.id = e.other),
{_REACH.format(core='core', edges='ce')}, comp as (select id, min(root) as component from reach group by id),
num as (select component, row_number() over (order by component) - 1 as cluster from (select distinct component from comp)),
cc as (select id, cluster from comp join num using (component)), bo as (select e.id, min(cluster) as near from e join cc on cc.id = e.other group by e.id)
select n.id, coalesce(cc.cluster, bo.near, -1)::bigint as prediction from (select id from {{nodes}}) n left join cc on cc.id = n.id left join bo on bo.id = n.id"""


def _runs(grid: list[tuple[float, int]]) -> str:
    """Labels and noise of each run: the components of the core points, and the points without a core neighbour."""
    pre = _VECTORS + ", pairs as materialized (select a.id as id, b.id as other, list_distance(a.e, b.e) as distance from v a, v b)"
    g = "grid(run, eps, least) as (values " + ", ".join(f"({k}, {e}, {m})" for k, (e, m) in enumerate(grid)) + ")"
    return f"""with recursive {pre}, {g}, e as materialized (select run, eps, least, id, other from pairs join grid on distance <= eps),
core as materialized (select run, id from e group by run, id, least having count(*) >= least),
ce as materialized (select e.run, e.id, e.other from e join core a on a.run = e.run and a.id = e.id join core b on b.run = e.run and b.id = e.other),
reach(run, id, root) as (select run, id, id from core union select r.run, ce.other, r.root from reach r join ce on ce.run = r.run and ce.id = r.id),
comp as (select run, id, min(root) as component from reach group by run, id),
held as (select distinct e.run, e.id from e join core c on c.run = e.run and c.id = e.other),
n as (select run, (select count(*) from v) - (select count(*) from held h where h.run = g.run) as noise, (select count(distinct component) from comp c where c.run = g.run) as clusters from grid g)
select eps::double as eps, least::bigint as min_samples, (clusters + (noise > 0)::int)::bigint as labels, noise::bigint as noise from n join grid using (run)"""


def _scale(expr: str) -> str:
    cols = ", ".join(f"round({expr.format(c=c)}, 4) as {c}" for c in CUSTOMER)
    stats = ", ".join(f"avg({c}) as a_{c}, stddev_pop({c}) as s_{c}, min({c}) as l_{c}, max({c}) as h_{c}" for c in CUSTOMER)
    return f"with {_CUSTOMERS}, st as (select {stats} from cu) select id, {cols} from cu, st"


def _encode() -> str:
    text = lambda c: f"coalesce({c}::varchar, 'nan')"
    dicts = ", ".join(f"d_{c} as (select v, row_number() over (order by v) - 1 as code from (select distinct {text(c)} as v from trips))" for c in CODED)
    cols = ", ".join(f"(select code from d_{c} where v = {text('t.' + c)})::bigint as {c}" for c in CODED)
    joins = " ".join(f"join d_{c} on d_{c}.v = {text('t.' + c)}" for c in CODED)
    cols = ", ".join(f"d_{c}.code::bigint as {c}" for c in CODED)
    return f"with {dicts} select t.record_id, {cols} from trips t {joins}"


def oracle_sql() -> dict[str, str]:
    rnd = lambda *cs: ", ".join(f"round({c}, 4) as {c}" for c in cs)
    plane_edges = _PLANE + ", e as (select a.id as id, b.id as other, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as distance from p a, p b where sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {eps})"
    sums = "d as (select a.id, a.label as own, b.label as cluster, sum(list_distance(a.e, b.e)) as total, count(*) as n from v a, v b group by 1, 2, 3), ab as (select id, own, max(case when cluster = own then n end) as size, max(case when cluster = own and n > 1 then total / (n - 1) end) as a, min(case when cluster <> own then total / n end) as b from d group by 1, 2), si as (select id, own as prediction, case when size = 1 or greatest(a, b) = 0 then 0.0 else (b - a) / greatest(a, b) end as s from ab)"
    gauss = lambda w, mx, my, vx, vy: f"ln({w}) - 0.5 * (2 * ln(2 * pi()) + ln({vx}) + ln({vy}) + (x - ({mx})) * (x - ({mx})) / {vx} + (y - ({my})) * (y - ({my})) / {vy})"
    g0, g1 = gauss("0.25", "0.0", "0.0", "4.0", "1.0"), gauss("0.75", "5.0", "-2.0", "9.0", "16.0")
    describe = " union all ".join(
        f"select '{c}' as \"column\", count(v)::bigint as count, round(avg(v), 3) as mean, round(stddev_samp(v), 3) as std, round(min(v), 3) as min, round(quantile_cont(v, 0.25), 3) as q25, round(quantile_cont(v, 0.5), 3) as q50, round(quantile_cont(v, 0.75), 3) as q75, round(max(v), 3) as max from (select {_real(c)} as v from trips)"
        for c in NUMBERS
    )
    single = f"""with recursive {_VECTORS}, e as (select a.id as id, b.id as other from v a, v b where list_distance(a.e, b.e) < 1.15), {_REACH.format(core='v', edges='e')},
comp as (select id, min(root) as component from reach group by id), num as (select component, row_number() over (order by component) - 1 as prediction from (select distinct component from comp)) select id, prediction::bigint as prediction from comp join num using (component)"""
    center = f"{_HEADS}, q as (select p.id, h.cluster, (p.x - (select avg(x) from p)) as px, (p.y - (select avg(y) from p)) as py, (h.cx - (select avg(cx) from h)) as hx, (h.cy - (select avg(cy) from h)) as hy from p, h)"
    return {
        "trip_clean": f"with {_CLEAN} select record_id, payment_type, price_category, extra, trip_distance, fare_amount, total_amount, pickup_hour, pickup_day_of_week, passenger_count, round(trip_duration, 4) as trip_duration from c",
        "trip_label_by_hour": f"with {_CLEAN} select price_category, pickup_hour, count(*)::bigint as n, round(avg(total_amount), 4) as mean_amount from c group by 1, 2",
        "profile_shape": f"select count(*)::bigint as n_rows, {len(TRIPS)}::bigint as n_cols from trips",
        "profile_info": " union all ".join(f"select '{c}' as \"column\", count({c})::bigint as non_null from trips" for c in TRIPS),
        "profile_nulls": " union all ".join(f"select '{c}' as \"column\", (count(*) - count({c}))::bigint as nulls from trips" for c in TRIPS),
        "profile_describe": describe,
        "head_rows": "select record_id, trip_id, vendor, fare_amount from trips order by record_id limit 5",
        "rows_by_position": "select vec_id as id, label::bigint as label from embeddings where vec_id in (10, 25, 50)",
        "distinct_guard": "select count(distinct label)::bigint as n_labels from embeddings",
        "class_names": "select distinct label::bigint as label from embeddings where label is not null",
        "mode_impute": "with m as (select passenger_count as pc from trips where passenger_count is not null group by 1 order by count(*) desc, 1 limit 1) select coalesce(passenger_count, (select pc from m))::bigint as passenger_count, count(*)::bigint as n from trips group by 1",
        "price_bucket": f"select record_id, {_PRICE.format('total_amount')} as price_category from trips",
        "label_encode": _encode(),
        "standard_scale": _scale("coalesce(({c} - a_{c}) / nullif(s_{c}, 0), 0.0)"),
        "minmax_scale": _scale("coalesce(({c} - l_{c}) / nullif(h_{c} - l_{c}, 0), 0.0)"),
        "centred": _scale("{c} - a_{c}").replace(", 4)", ", 7)"),
        "stratified_split": f"with {_SPLIT} select id, label, is_test from s",
        "stratified_folds": f"with {_RANKED} select id, label, ((rk - 1) % 5)::bigint as fold from r",
        "kfold": f"with {_LABELLED} select id, (('0x' || substr(md5(id::varchar), 1, 8))::bigint % 3)::bigint as fold from l",
        "distance_euclidean": f"with {_HEADS} select id, cluster::bigint as cluster, round(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), 4) as distance from p, h",
        "distance_pearson": f"with {center} select id, cluster::bigint as cluster, round(1 - coalesce((px * hx + py * hy) / nullif(sqrt(px * px + py * py) * sqrt(hx * hx + hy * hy), 0), 0), 4) as distance from q",
        "init_sample": f"with {_PLANE} select id from p order by md5(id::varchar || '|42'), id limit {K}",
        "kmeans_assign": f"with {_HEADS}, {_ASSIGN} select id, cluster::bigint as prediction, round(distance, 4) as distance from b",
        "kmeans_step": f"with {_HEADS}, {_ASSIGN} select cluster::bigint as prediction, count(*)::bigint as n, round(avg(x), 4) as cx, round(avg(y), 4) as cy, round(sum(distance * distance), 4) as sse, round(avg(distance * distance), 4) as mean_sq from b group by 1",
        "kmeans_sse_by_feature": f"with {_HEADS}, {_ASSIGN}, t as (select sum((x - cx) * (x - cx)) as sx, sum((y - cy) * (y - cy)) as sy from b) select 'x' as feature, round(sx, 4) as sse from t union all select 'y', round(sy, 4) from t union all select 'distortion', round(sx + sy, 4) from t",
        "kmeans_fit_k": _lloyd(3),
        "silhouette_exact": f"with {_VECTORS}, {sums} select round(avg(s), 6) as silhouette from si",
        "silhouette_points": f"with {_VECTORS}, {sums} select id, prediction, round(s, 4) as s from si",
        "neighbors_eps": f"with {_EDGES} select id, other, {rnd('distance')} from e",
        "neighbors_grid": f"with {plane_edges.format(eps='0.2')} select id, other, {rnd('distance')} from e",
        "dbscan": _dbscan(_EDGES, 3).format(nodes="v"),
        "dbscan_plane": _dbscan(plane_edges.format(eps="0.5"), 5).format(nodes="p"),
        "components": f"with recursive {_EDGES}, {_REACH.format(core='v', edges='e')} select id, min(root) as component from reach group by id",
        "single_linkage_threshold": single,
        "gmm_fixed_density": f"with {_PLANE}, g as (select id, {g0} as a, {g1} as b from p) select id, (case when b > a then 1 else 0 end)::bigint as prediction, round(greatest(a, b) + ln(1 + exp(-abs(a - b))), 4) as log_density from g",
        "knn_predict": f"with {_VECTORS}, w as (select *, ('0x' || substr(md5(id::varchar), 1, 8))::bigint % 3 as fold from v), n as (select a.id, a.label, b.label as vote from w a, w b where a.fold = 0 and b.fold <> 0 qualify row_number() over (partition by a.id order by list_distance(a.e, b.e), b.id) <= 5), c as (select id, label, vote, count(*) as k from n group by all) select id, label, vote as prediction from c qualify row_number() over (partition by id order by k desc, vote) = 1",
        "gaussian_nb": f"with {_NB} select id, label, prediction from nb",
        "confusion_matrix": f"with {_CONF} select label, prediction, n from cm",
        "classification_report": _report(),
        "in_sample_report": _report(f"{_LABELLED}, {_nb('l', 'l')}{_NAMES}"),
        "accuracy": f"with {_NB} select round(avg((label = prediction)::int::double), 4) as accuracy from nb",
        "cv_scores": _cv(5, "(rk - 1) % 5", _RANKED) + " select fold, round(accuracy, 4) as accuracy from cv",
        "cv_mean_std": _cv(5, "(rk - 1) % 5", _RANKED) + " select round(avg(accuracy), 4) as mean, round(stddev_pop(accuracy), 4) as std from cv",
        "learning_curve_nb": _curve(3, (0.5, 1.0)),
        "cv_stratified": _cv(3, "(rk - 1) % 3", _RANKED) + " select fold, round(accuracy, 4) as accuracy from cv",
        "scores_as_text": _cv(3, "('0x' || substr(md5(id::varchar), 1, 8))::bigint % 3", _RANKED) + " select fold, printf('%.3f', round(accuracy, 4)) as accuracy from cv",
        "confusion_colours": f"with {_CONF} select label, prediction, n, max(n) over () / 2.0::double as threshold, n > max(n) over () / 2.0 as light from cm",
        "profile_types": " union all ".join(f"select '{c}' as \"column\", '{_TYPES.get(c, 'string')}' as dtype, count({c})::bigint as non_null from trips" for c in TRIPS),
        "silhouette_fast": f"with {_VECTORS}, {sums.replace('list_distance(a.e, b.e)', 'list_distance(a.e, b.e) ** 2')} select round(avg(s), 6) as silhouette from si",
        "gmm_fixed_grid": f"with {_PLANE}, bx as (select min(x) - 1 as lx, max(x) + 1 as hx, min(y) - 1 as ly, max(y) + 1 as hy from p), pt as (select i as id, lx + (hx - lx) * (i % 100) / 99 as x, ly + (hy - ly) * (i // 100) / 99 as y from bx, range(10000) r(i)), g as (select id, {g0} as a, {g1} as b from pt) select id, round(greatest(a, b) + ln(1 + exp(-abs(a - b))), 4) as logp from g",
        "dbscan_labels_by_run": _runs([(1.15, 3), (1.15, 5), (1.18, 3), (1.18, 5)]),
        "cv_plain": _cv(3, "('0x' || substr(md5(id::varchar), 1, 8))::bigint % 3", _RANKED) + " select fold, round(accuracy, 4) as accuracy from cv",
        "cluster_scatter": f"with {_HEADS}, {_ASSIGN} select id, x, y, cluster::bigint as cluster from b",
        "pair_scatter": f"with {_HEADS}, {_ASSIGN} select id, i::bigint as dim_i, j::bigint as dim_j, case when i = 0 then x else y end as x, case when j = 0 then x else y end as y, cluster::bigint as cluster from b, range(2) a1(i), range(2) a2(j)",
        "eval_grid": f"with {_PLANE}, bx as (select min(x) - 1 as lx, max(x) + 1 as hx, min(y) - 1 as ly, max(y) + 1 as hy from p) select i as id, round(lx + (hx - lx) * (i % 100) / 99, 4) as x, round(ly + (hy - ly) * (i // 100) / 99, 4) as y from bx, range(10000) r(i)",
        "gen_circle": "select i as id, round(cos(2.0 * pi() * i / 20), 4) as x, round(sin(2.0 * pi() * i / 20), 4) as y from range(20) r(i)",
    }
