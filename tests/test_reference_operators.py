"""Analytics operators: unit cases, properties and comparison with plain NumPy."""

import math
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.functions.scalars import minutes_between
from marlstone.operators import clean, density, distance, encode, evaluate, graph, hierarchy, inspect, kmeans, mixture, plotdata, split, sweep
from marlstone.operators import classify as models, forest as grown
from marlstone.sources import generators
from marlstone.sources.tables import read_delimited


def one(df):
    return [r[0] for r in df.collect()]


def cloud(spark, n=60, seed=0, dims=2):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.4, (n // 3, dims)) for c in (0, 4, 9)])
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, features array<double>"), x


# ---------------------------------------------------------------- cleaning


def test_price_bins(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.0, 0.01, 10.0, 10.01, 20.0, 20.01, None, float("nan")])], "i int, v double")
    assert one(df.orderBy("i").select(clean.price_category(F.col("v")))) == [None, "low", "low", "medium", "medium", "high", None, None]


def test_weekday_and_duration(spark):
    df = spark.createDataFrame([(datetime(2018, 6, 4), datetime(2018, 6, 4, 0, 1, 30, 500000))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(F.weekday("a"), minutes_between("a", "b")).first() == (0, pytest.approx(1.5083333))


def test_open_filter_mode_rename_drop(spark):
    df = spark.createDataFrame([(1.0,), (1.01,), (120.0,), (None,), (float("nan"),)], "`Trip Time` double")
    assert one(clean.rename_columns(df).where(clean.between_open(F.col("trip_time"), 1, 120))) == [1.01]
    ties = spark.createDataFrame([(3,), (1,), (1,), (3,), (2,), (None,)], "v int")
    assert clean.mode_value(ties, "v").first()[0] == 1 and sorted(one(clean.fill_mode(ties, "v"))) == [1, 1, 1, 2, 3, 3]
    with pytest.raises(ValueError):
        clean.drop_columns(ties, ["w"])
    with pytest.raises(ValueError):
        clean.rename_columns(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))


def test_inspection(spark):
    df = spark.createDataFrame([(float(v), "x") for v in (1, 2, 4, 9, 7, 3)] + [(None, None), (float("nan"), None)], "v double, s string")
    d = inspect.describe(df).first()
    assert (d["count"], d.q25, d.q50, d.q75) == (6, 2.25, 3.5, 6.25)
    assert {tuple(r) for r in inspect.null_counts(df).collect()} == {("v", 1), ("s", 2)}
    assert tuple(inspect.shape(df).first()) == (8, 2)
    assert {tuple(r) for r in inspect.column_info(df).collect()} == {("v", "double", 7), ("s", "string", 6)}


# ---------------------------------------------------------------- encoding and splits


def test_label_codes_and_scaling(spark):
    df = spark.createDataFrame([("10",), ("2",), ("1.0",), (None,)], "c string")
    assert {r["value"]: r["code"] for r in encode.label_dictionary(df, "c").collect()} == {"1.0": 0, "10": 1, "2": 2, "nan": 3}
    num = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, k double")
    assert one(encode.standard_scale(num, ["a", "k"]).orderBy("a").select(F.round("a", 4))) == [-1.069, -0.2673, 1.3363]
    assert one(encode.minmax_scale(num, ["k"]).select("k")) == [0, 0, 0] and one(encode.standard_scale(num, ["k"]).select("k")) == [0, 0, 0]


def test_splits_are_exact_and_disjoint(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") < 700, "a").when(F.col("id") < 990, "b"))
    s = split.stratified_split(df, "id", "label")
    assert {r["label"]: r["n"] for r in s.where("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()} == {"a": 210, "b": 87, None: 3}
    f = split.stratified_folds(df, "id", "label", 5)
    n = [r["n"] for r in f.where("label = 'b'").groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert f.count() == 1000 and len(n) == 5 and max(n) - min(n) <= 1


# ---------------------------------------------------------------- distances and clusters


def test_distances(spark):
    pts, x = cloud(spark)
    heads = x[:3].tolist()
    got = {(r["id"], r["cluster"]): r["distance"] for r in distance.distance_table(pts, heads).collect()}
    assert all(got[i, k] == pytest.approx(np.linalg.norm(x[i] - heads[k])) for i in range(60) for k in range(3))
    even = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0])], "id bigint, features array<double>")
    p = {(r["id"], r["cluster"]): r["distance"] for r in distance.distance_table(even, [[1.0, 1.0], [3.0, 1.0]], "pearson").collect()}
    assert p[2, 0] == p[2, 1] == 1.0 and p[0, 0] == pytest.approx(0.0) and p[1, 0] == pytest.approx(2.0)
    with pytest.raises(ValueError):
        distance.distance_table(pts, heads, "foo")


@pytest.mark.parametrize("block", [7, 5000])
def test_silhouette_matches_numpy(spark, block, monkeypatch):
    pts, x = cloud(spark, 30)
    monkeypatch.setattr(distance, "BLOCK", block)
    lab = np.array([i // 10 for i in range(29)] + [7])
    df = pts.join(spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "id bigint, prediction bigint"), "id")
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    want = []
    for i in range(30):
        own = (lab == lab[i]).sum()
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        a = d[i, lab == lab[i]].sum() / (own - 1) if own > 1 else None
        want.append(0.0 if own == 1 else (b - a) / max(a, b))
    assert distance.silhouette(df).first()[0] == pytest.approx(np.mean(want))
    assert distance.silhouette(pts.withColumn("prediction", F.lit(1))).count() == 0


def test_kmeans(spark):
    pts, x = cloud(spark)
    f = kmeans.fit(pts, 3, init=[x[0].tolist(), x[25].tolist(), x[50].tolist()])
    assert all(b <= a + 1e-9 for a, b in zip(f.trace, f.trace[1:]))
    assert f.predict(pts).groupBy("prediction").count().count() == 3
    far = kmeans.fit(pts, 2, init=[x[0].tolist(), [1e6, 1e6]], max_iter=5)
    assert far.heads[1] == [1e6, 1e6]
    tie = spark.createDataFrame([(1, [0.0])], "id bigint, features array<double>")
    assert kmeans.assign(tie, [[1.0], [-1.0]]).first()["prediction"] == 0
    assert len(kmeans.init_range(pts, 4)) == 4 and len(kmeans.init_sample(pts, 4)) == 4
    assert kmeans.mllib(pts, 3, runs=1)[1] == pytest.approx(f.metric, rel=0.05)


def _lloyd(x, heads):
    """Brute force: heads and SSE where the reference's rule stops."""
    heads, old_mean, old = np.array(heads, float), None, None
    while True:
        at = ((x[:, None] - heads[None]) ** 2).sum(2).argmin(1)
        part = [((x[at == c] - heads[c]) ** 2) for c in range(len(heads)) if (at == c).any()]
        mean, sse = np.array([p.sum(1).mean() for p in part]), sum(p.sum(0) for p in part)
        if mean.sum() < 1e-4 or (old is not None and ((len(mean) == len(old_mean) and np.allclose(mean, old_mean)) or (abs(sse - old) < 1e-4).any())):
            return heads, sse.sum()
        old_mean, old = mean, sse
        heads = np.array([x[at == c].mean(0) if (at == c).any() else heads[c] for c in range(len(heads))])


def test_kmeans_queries_converge(spark, tmp_path):
    from marlstone.plans import reference_queries as q

    x = np.random.default_rng(5).random((400, 2)) * 10
    spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id bigint, x double, y double").write.parquet(f"{tmp_path}/points.parquet")
    heads = q.q_kmeans_fit(spark, str(tmp_path)).orderBy("cluster").collect()
    assert np.allclose([[r.cx, r.cy] for r in heads], _lloyd(x, x[: q.K])[0], atol=1e-4)
    sweep_ = {r.k: r.distortion for r in q.q_kmeans_sweep(spark, str(tmp_path)).collect()}
    pts = q._plane(spark, str(tmp_path))
    assert sweep_ == {k: pytest.approx(_lloyd(x, kmeans.init_sample(pts, k))[1]) for k in range(2, 10)}
    cut = kmeans.fit(pts, q.K, init=x[: q.K].tolist(), max_iter=3)
    assert cut.iterations == 3 and not cut.converged and kmeans.fit(pts, q.K, init=x[: q.K].tolist()).converged


def test_neighbours_grid_equals_blocks(spark):
    pts, x = cloud(spark)
    wide = pts.withColumn("features", F.concat("features", F.array(F.lit(0.0), F.lit(0.0))))
    pairs = lambda df: {(r["id"], r["other"]) for r in df.collect()}
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    want = {(i, j) for i in range(60) for j in range(60) if d[i, j] <= 0.5}
    assert pairs(distance.neighbours(pts, 0.5)) == pairs(distance.neighbours(wide, 0.5)) == want


def test_components_and_dbscan(spark):
    nodes = spark.range(40)
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)], "id bigint, other bigint")
    got = {r["id"]: r["component"] for r in graph.components(nodes, chain).collect()}
    assert all(got[i] == (0 if i <= 30 else i) for i in range(40))
    line = [0.0, 1.0, 2.0, 10.0, 11.0, 12.0, 3.0, 50.0]
    pts = spark.createDataFrame([(i, [v]) for i, v in enumerate(line)], "id bigint, features array<double>")
    assert {r["id"]: r["prediction"] for r in density.dbscan(pts, 1.0, 3).collect()} == {0: 0, 1: 0, 2: 0, 6: 0, 3: 1, 4: 1, 5: 1, 7: -1}
    assert set(one(density.dbscan(pts, 1e-6, 2).select("prediction"))) == {-1}


def test_linkage(spark):
    pts, x = cloud(spark, 30)
    merges = [tuple(r) for r in hierarchy.linkage(pts, "average").orderBy("step").collect()]
    assert len(merges) == 29 and merges[-1][4] == 30 and all(a[3] <= b[3] + 1e-9 for a, b in zip(merges, merges[1:]))
    groups = {i: [i] for i in range(30)}
    for step, left, right, dist, size in merges:  # each merge joins the pair with the smallest mean distance
        a, b = groups[left], groups[right]
        assert dist == pytest.approx(np.mean([np.linalg.norm(x[i] - x[j]) for i in a for j in b]))
        groups[30 + step] = groups.pop(left) + groups.pop(right)
        assert len(groups[30 + step]) == size
    by = lambda df: {frozenset(i for i, p in rows if p == k) for rows in [[tuple(r) for r in df.collect()]] for k in {p for _, p in rows}}
    assert by(hierarchy.agglomerative(pts, "single", threshold=2.0)) == by(hierarchy.agglomerative(pts, "average", n_clusters=3)) == {frozenset(range(a, a + 10)) for a in (0, 10, 20)}
    with pytest.raises(ValueError):
        hierarchy.agglomerative(pts)


@pytest.mark.parametrize("kind", ["euclidean", "cityblock", "cosine"])
@pytest.mark.parametrize("dims", [2, 5])
def test_average_linkage_without_a_matrix_equals_the_kernel(monkeypatch, kind, dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(6, dims))[rng.integers(0, 6, 400)] * 6 + rng.normal(size=(400, dims))
    x[5], x[9], x[10] = 0, x[8], x[8]
    want = hierarchy.merge_list(distance.matrix(x, x, kind), "average")
    monkeypatch.setattr(hierarchy, "CAP", 3)
    monkeypatch.setattr(hierarchy, "LEAF", 32)
    monkeypatch.setattr(hierarchy, "PAIRS", 1 << 12)
    got = hierarchy.average_merges(x, kind)
    assert [m[2] for m in got] == pytest.approx([m[2] for m in want], abs=1e-12)
    for k in (1, 2, 7, 50, 390):
        assert np.array_equal(hierarchy.cut(got, 400, n_clusters=k), hierarchy.cut(want, 400, n_clusters=k))


def test_average_linkage_takes_more_points_than_a_matrix(spark):
    n = hierarchy.CAP + 200
    pts = spark.range(n).select("id", F.array(F.col("id").cast("double") + F.when(F.col("id") >= 3000, 1e6).otherwise(0), F.lit(0.0)).alias("features"))
    got = hierarchy.agglomerative(pts, "average", n_clusters=2).groupBy("prediction").agg(F.min("id"), F.max("id")).orderBy("prediction").collect()
    assert [tuple(r) for r in got] == [(0, 0, 2999), (1, 3000, n - 1)]


@pytest.mark.parametrize("kind", ["euclidean", "cityblock", "cosine"])
def test_spanning_tree_in_blocks(spark, kind):
    pts, x = cloud(spark, 60)
    d = distance.matrix(x, x, kind)
    want = sorted(w for _, _, w in hierarchy._tree_of(np.arange(60), d))
    for block in (7, 25, 1000):
        tree = hierarchy.spanning_tree(pts, kind, block=block, fan=3).collect()
        assert sorted(r["distance"] for r in tree) == pytest.approx(want) and len(tree) == 59
        assert all(r["distance"] == pytest.approx(d[r["id"], r["other"]]) for r in tree)
    # single linkage by the tree equals the kernel's, cut either way
    leaves = {r["id"]: r["prediction"] for r in hierarchy.single_clusters(pts, 4, kind).collect()}
    merges = hierarchy.merge_list(d, "single")
    assert [leaves[i] for i in range(60)] == hierarchy.cut(merges, 60, n_clusters=4).tolist()
    got = hierarchy.linkage(pts, "single", kind).orderBy("step").collect()
    assert [r["distance"] for r in got] == pytest.approx([m[2] for m in merges]) and got[-1]["size"] == 60
    by_cut = hierarchy.cuts(pts, "single", kind, [{"threshold": float(want[-2])}, {"n_clusters": 4}])
    assert {r["id"]: r["prediction"] for r in by_cut.where("run = 1").collect()} == leaves
    assert by_cut.where("run = 0").select("prediction").distinct().count() == 3


def test_spanning_tree_of_copies_and_of_one_point(spark):
    same = spark.createDataFrame([(i, [float(i // 4)]) for i in range(12)], "id bigint, features array<double>")
    tree = hierarchy.spanning_tree(same, block=5).collect()
    assert sorted(r["distance"] for r in tree) == [0.0] * 9 + [1.0] * 2
    assert hierarchy.spanning_tree(same.where("id = 3")).count() == 0 and hierarchy.single_clusters(same.where("id = 3"), 2).count() == 1


def test_runs_of_a_grid_equal_single_runs(spark):
    pts, x = cloud(spark)
    grid = [(0.4, 3), (0.4, 6), (0.9, 4), (1e-6, 2)]
    edges = distance.neighbours(pts, 0.9)
    runs = density.dbscan_runs(pts, edges, grid)
    scores = {r["run"]: r["silhouette"] for r in distance.silhouettes(pts, runs).collect()}
    for k, (eps, least) in enumerate(grid):
        one_run = density.dbscan(pts, eps, least)
        assert sorted(map(tuple, runs.where(F.col("run") == k).select("id", "prediction").collect())) == sorted(map(tuple, one_run.collect()))
        alone = distance.silhouette(pts.join(one_run, "id")).first()
        assert (alone is None and k not in scores) or alone[0] == pytest.approx(scores[k])


def test_dbscan_sweep_lists_no_neighbours(spark, monkeypatch):
    """compare_algorithms failed on normalised points, where the largest eps has all pairs."""
    pts, x = cloud(spark)
    pts = pts.unionByName(pts.where("id < 6").select((F.col("id") + 100).alias("id"), "features"))
    grid = [(0.15, 2), (0.4, 4), (0.9, 9), (30.0, 70)]
    got = {r["id"]: r["labels"] for r in density.dbscan_labels(pts, grid).collect()}
    for k, (eps, least) in enumerate(grid):
        assert {i: v[k] for i, v in got.items()} == {r["id"]: r["prediction"] for r in density.dbscan(pts, eps, least).collect()}

    def listed(*_, **__):
        raise AssertionError("a neighbour table")

    for module in (density, sweep):
        monkeypatch.setattr(module, "neighbours", listed, raising=False)
    rows = sweep.dbscan_sweep(pts, (0.4, 30.0), (3, 5)).collect()
    assert [r["ord"] for r in rows] == [0, 1]


@pytest.mark.parametrize("most, hot", [(256, 1 << 20), (3, 1 << 20), (256, 0)])
def test_scores_of_many_labellings(monkeypatch, most, hot):
    monkeypatch.setattr(distance, "LABELS", most)
    monkeypatch.setattr(distance, "HOT", hot)
    monkeypatch.setattr(distance, "AT_ONCE", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 3))
    x[4] = x[5]
    labels = np.stack([rng.integers(0, k, 50) for k in (1, 2, 5, 20)] + [np.arange(50), np.r_[np.zeros(48, int), 7, 7], -(np.arange(50) % 2)], 1)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    got = distance.run_scores(x, labels, np.arange(30)) + distance.run_scores(x, labels, np.arange(30, 50))
    for r, lab in enumerate(labels.T):
        if len(set(lab)) == 1:
            assert np.isnan(got[r])
            continue
        want = 0.0
        for i in range(50):
            own = (lab == lab[i]).sum()
            a, b = d[i, lab == lab[i]].sum() / max(own - 1, 1), min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
            want += 0.0 if own == 1 else (b - a) / max(a, b)
        assert got[r] == pytest.approx(want, abs=1e-9)


def test_compare_scores_a_set_of_points_once(spark, monkeypatch):
    asked, score = [], sweep.label_scores
    monkeypatch.setattr(sweep, "label_scores", lambda pts, labelled: asked.append(len(labelled.first()["labels"])) or score(pts, labelled))
    rows = sweep.compare({"cloud": cloud(spark)[0]}).collect()
    assert asked == [6 + 18 + len(sweep.EPS) * len(sweep.MIN_SAMPLES) + 4]
    assert {r["algorithm"] for r in rows} == {"kmeans", "hierarchical", "dbscan", "gaussian mixture"} and all(r["score"] > 0.5 for r in rows)


def test_components_of_a_hub_and_a_chain_of_many_parts(spark):
    rng = np.random.default_rng(0)
    edges = [(7, i) for i in range(100, 1100)] + [(i, i + 1) for i in range(5000, 5400)] + [(5400, 100)] + [(20_000, 20_001), (20_001, 20_000), (3, 3)]
    rng.shuffle(edges)
    e = spark.createDataFrame([(int(a), int(b)) for a, b in edges], "id bigint, other bigint").repartition(6)
    nodes = spark.createDataFrame([(int(i),) for i in {x for ab in edges for x in ab}], "id bigint")
    got = {r["id"]: r["component"] for r in graph.components(nodes, e).collect()}
    assert all(got[i] == (i if i == 3 else 20_000 if i >= 20_000 else 7) for i in got)
    assert graph.components(nodes.where("false"), e.where("false")).count() == 0


@pytest.mark.parametrize("width", ["1", "5"])
def test_ranks_by_ranges(spark, width):
    from marlstone.operators.rank import ranks

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        rows = [(None if i % 7 == 0 else "a" if i % 3 else "b", i * 37 % 500) for i in range(500)]
        got = ranks(spark.createDataFrame(rows, "g string, v int"), ["g"], ["v"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for g in (None, "a", "b"):
        assert [v for _, v in sorted((r["rank"], r["v"]) for r in got if r["g"] == g)] == sorted(v for x, v in rows if x == g)
        assert sorted(r["rank"] for r in got if r["g"] == g) == list(range(sum(x == g for x, _ in rows)))


def test_distances_do_not_depend_on_the_block():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 40)) + 50
    whole = distance.matrix(x, x)
    assert np.all(np.diag(whole) == 0)
    part = np.vstack([distance.matrix(x[i : i + 7], x) for i in range(0, 300, 7)])
    assert np.allclose(whole, part, rtol=1e-6, atol=1e-9)
    i, j = np.nonzero(whole < 9)
    assert np.array_equal(distance.exactly(x[i], x[j]), np.sqrt(((x[i] - x[j]) ** 2).sum(1)))


@pytest.mark.parametrize("covariance", mixture.COVARIANCES)
def test_mixtures(spark, covariance):
    pts, x = cloud(spark)
    m = mixture.fit(pts, 3, covariance)
    assert m.weights.sum() == pytest.approx(1) and sorted(np.bincount(m.log_parts(x).argmax(1), minlength=3)) == [20, 20, 20]
    if covariance == "spherical":
        assert all(c[0, 0] == pytest.approx(c[1, 1]) and c[0, 1] == 0 for c in m.covs)


def test_sweep_best(spark):
    rows = [(0, "a", {}, 0.1), (1, "a", {}, 0.9), (2, "b", {}, 0.9)]
    df = spark.createDataFrame(rows, sweep.SCHEMA)
    assert sweep.best(df).first()["ord"] == 1 and sweep.best(df.where("false")).count() == 0
    assert {r["ord"] for r in sweep.best(df, ["algorithm"]).collect()} == {1, 2}


# ---------------------------------------------------------------- classifiers and evaluation


def labelled(spark, n=90):
    pts, x = cloud(spark, n)
    names = F.array(F.lit("high"), F.lit("low"), F.lit("medium"))
    return pts.withColumn("label", F.element_at(names, (F.floor(F.col("id") / (n // 3)) + 1).cast("int")))


@pytest.mark.parametrize("name", [*models.MODELS, "ovr"])
def test_classifiers_learn_separate_classes(spark, name):
    df = labelled(spark)
    make = {**models.MODELS, "ovr": models.logistic_ovr, "forest": lambda t: models.forest(t, trees=40, max_depth=5)}[name]
    assert evaluate.accuracy(make(df.where("id % 3 <> 0"))(df.where("id % 3 = 0"))).first()[0] >= 0.95


@pytest.mark.parametrize("shape", ["few", "many"])
def test_tree_cuts_where_gini_falls_most_and_goes_on_until_pure(monkeypatch, shape):
    rng = np.random.default_rng(3)
    n = 14 if shape == "few" else 5000
    monkeypatch.setattr(grown, "ROWS", 700)  # larger nodes in parts
    x, y, w = rng.integers(0, 32, (1, n), dtype=np.uint8), rng.integers(0, 3, n, dtype=np.uint8), rng.poisson(1, n).astype(np.uint8)
    y[x[0] > 20] = 2
    column, cut, child, weights = grown.grow(x, y, w, 3, 32, 1, rng)
    impure = lambda at: w[at].sum() * (1 - sum((w[at & (y == k)].sum() / max(w[at].sum(), 1)) ** 2 for k in range(3)))
    after = [impure(x[0] <= c) + impure(x[0] > c) for c in range(31)]
    assert after[cut[0]] == pytest.approx(min(after)) and column.tolist() == [0, -1, -1] and child[0] == 1
    assert weights[1:].sum(0).tolist() == weights[0].tolist() == [w[y == k].sum() for k in range(3)]
    x = np.concatenate([np.tile(np.arange(n) % 32, (1, 1)), np.arange(n)[None] // 32 % 32, np.arange(n)[None] // 1024, np.zeros((5, n), int)]).astype(np.uint8)  # no two rows are equal, most columns are constant
    tree = grown.grow(x, y, np.ones(n, np.uint8), 3, 32, 30, rng)
    assert (grown.shares(tree, x).argmax(1) == y).all() and np.all(grown.shares(tree, x).max(1) == 1)


def test_tree_is_grown_in_a_task_over_all_columns(spark, monkeypatch):
    monkeypatch.setattr(models.ml, "DecisionTreeClassifier", None)
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, (400, 9)).astype(float)
    y = np.where(x[:, 8] > 1, "a", np.where(x[:, 3] > 1, "b", "c"))  # two of nine columns tell all
    df = spark.createDataFrame([(i, x[i].tolist(), str(y[i])) for i in range(400)], "id bigint, features array<double>, label string")
    assert evaluate.accuracy(models.tree(df.where("id < 300"), max_depth=2)(df.where("id >= 300"))).first()[0] == 1
    monkeypatch.undo()
    assert evaluate.accuracy(models.tree(df, max_depth=2, most=1)(df)).first()[0] == 1  # MLlib's


def test_logistic_keeps_no_copy_of_the_rows(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    kept = []
    monkeypatch.setattr(Frame, "persist", lambda self, *_: kept.append(self) or self)
    df = labelled(spark)
    assert evaluate.accuracy(models.logistic(df)(df)).first()[0] > 0.95 and not kept


def test_forest_keeps_no_tree_in_the_driver_and_is_the_same_in_any_layout(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.c_[rng.normal(size=(600, 2)), rng.integers(0, 3, 600)]
    y = np.where(rng.random(600) < 0.2, "c", np.where(x[:, 0] + x[:, 1] > 0, "a", "b"))  # a fifth is noise
    rows = [(i, x[i].tolist(), str(y[i])) for i in range(600)]
    schema = "id bigint, features array<double>, label string"
    monkeypatch.setattr(models.ml, "RandomForestClassifier", None)
    found = []
    for layout, tasks in ((rows[:400], 1), (rows[:400][::-1], 5)):
        train, test = spark.createDataFrame(layout, schema).repartition(tasks), spark.createDataFrame([*rows[400:], rows[400], (None, *rows[401][1:])], schema).repartition(tasks)
        found.append(models.forest(train, trees=20)(test).select("id", "prediction", "label").collect())
    assert Counter(found[0]) == Counter(found[1]) and len(found[0]) == 202
    assert sum(r["prediction"] == r["label"] for r in found[0]) > 0.7 * 202


def test_held_out_moves_the_features_once_and_keeps_only_its_own_table(spark, monkeypatch):
    from marlstone import session
    from marlstone.plans import reference_queries as q

    monkeypatch.setattr(q, "_labelled", lambda s, d: session.materialise(labelled(s)))
    before = {path for _, path in session._written}
    train, test = q._held_out(spark, "")
    assert len({path for _, path in session._written} - before) == 1
    assert train.count() + test.count() == labelled(spark).count() and not train.join(test, "id").count()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in split.class_rank(labelled(spark), "id", "label", 42)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("cell", [40, 100_000])
def test_knn_is_exact_over_cells_and_moves_no_block_pairs(spark, monkeypatch, cell):
    rng = np.random.default_rng(5)
    x, votes = np.round(rng.normal(size=(300, 3)) * 2), rng.choice(["a", "b", "c"], 300)  # whole numbers: many ties
    df = spark.createDataFrame([(i, x[i].tolist(), str(votes[i])) for i in range(300)], "id bigint, features array<double>, label string")
    monkeypatch.setattr(distance, "block_pairs", None)
    monkeypatch.setattr(models, "block_pairs", None, raising=False)
    got = {r["id"]: r["prediction"] for r in models.knn(df.where("id >= 100"), 5, cell)(df.where("id < 100")).collect()}
    for i in range(100):
        near = np.lexsort((np.arange(100, 300), distance.exactly(np.repeat(x[i : i + 1], 200, 0), x[100:])))[:5] + 100
        assert got[i] == min((-(votes[near] == v).sum(), v) for v in set(votes[near]))[1]


def test_knn_sends_no_row_about_twice(spark, monkeypatch):
    from marlstone import session

    rng = np.random.default_rng(6)
    x, votes = np.round(rng.normal(size=(300, 3)) * 2), rng.choice(["a", "b", "c"], 300)
    df = spark.createDataFrame([(i, x[i].tolist(), str(votes[i])) for i in range(300)], "id bigint, features array<double>, label string")
    train, test, before = df.where("id >= 100"), df.where("id < 100"), {path for _, path in session._written}
    plans, own = [], models.materialise
    monkeypatch.setattr(models, "materialise", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or own(df))
    got = models.knn(train, 5, 40, asked=30)(test)
    assert len(plans) == 3 and "shuffle_replicate_nl" in plans[-1] and sum("CoGroup" in p for p in plans) == 1
    left = {path for _, path in session._written} - before
    assert [set(spark.read.parquet(path).columns) for path in left] == [{"id", "prediction"}]
    whole = models.knn(train)(test)
    assert Counter(map(str, got.collect())) == Counter(map(str, whole.collect())) and got.count() == 100


def test_blocks_come_to_a_task_one_at_a_time(spark, monkeypatch):
    seen, own, keys = [], models.materialise, ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(k) for k in keys]

    def write(df):
        if "shuffle_replicate_nl" in df._jdf.queryExecution().optimizedPlan().toString():
            seen.append([spark.conf.get(k) for k in keys])
        return own(df)

    monkeypatch.setattr(models, "materialise", write)
    df = labelled(spark)
    models.forest(df, trees=4)(df)
    models.tree(df)(df)
    models.knn(df, 5, 20)(df)
    assert seen == [["1", "1"]] * 3 and [spark.conf.get(k) for k in keys] == before
    packed = models.knn(df)(df)._jdf.queryExecution().optimizedPlan().toString()
    assert packed.count("MapInPandas") == 2  # one Python process a side
    assert models.knn(df.limit(0))(df).count() == 0


def test_forest_reads_its_blocks_in_each_task_and_shuffles_no_copies(spark, monkeypatch):
    plans, own = [], models.materialise
    monkeypatch.setattr(models, "materialise", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or own(df))
    df = labelled(spark)
    assert evaluate.accuracy(models.forest(df, trees=4)(df)).first()[0] > 0.95
    assert any("shuffle_replicate_nl" in p for p in plans) and not any("RepartitionByExpression" in p for p in plans)


def test_split_sorts_and_writes_no_rows(spark):
    from marlstone import session

    df = spark.createDataFrame([(i, "abc"[min(i % 7, 2)]) for i in range(500)] + [(None, "a"), (501, None), (502, None), (503, "d")], "id bigint, label string")
    for share in (0.0, 0.3, 0.5, 1.0):
        before = len(session._written)
        got = split.stratified_split(df, "id", "label", share)
        assert len(session._written) == before
        r = split.class_rank(df, "id", "label", 42).withColumn("is_test", F.col("rank") <= F.floor(F.col("size") * share + 0.5))
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, r.select("id", "label", "is_test").collect()))
    twice = spark.createDataFrame([(7, "a")] * 10, "id bigint, label string")
    assert split.stratified_split(twice, "id", "label").where("is_test").count() == 3


def test_scaled_parts_outlive_the_table_they_came_from(spark, monkeypatch):
    from marlstone import session
    from marlstone.plans import reference_queries as q

    n = len(q.FEATURES) + len(q.CODED)
    wide = labelled(spark).withColumn("features", F.transform(F.sequence(F.lit(1), F.lit(n)), lambda j: F.col("features")[0] * j))
    monkeypatch.setattr(q, "_labelled", lambda *_: session.materialise(wide))
    before = {path for _, path in session._written}
    fit, test = q._scaled(*q._held_out(spark, ""))
    assert len({path for _, path in session._written} - before) == 2 and fit.count() == 63 and test.count() == 27


def test_report_and_confusion(spark):
    rows = [("low", "low")] * 5 + [("low", "high")] * 2 + [("medium", "low")] * 3
    df = spark.createDataFrame(rows, "label string, prediction string")
    c = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion(df, list(clean.PRICE_ORDER)).collect()}
    assert len(c) == 9 and sum(c.values()) == 10 and c["high", "high"] == 0
    r = {x["name"]: x for x in evaluate.report(df, list(clean.PRICE_ORDER)).collect()}
    assert r["low"].precision == 5 / 8 and r["low"].recall == 5 / 7 and r["medium"].f1 == 0 and r["high"].support == 0
    assert r["accuracy"].f1 == 0.5 and r["macro avg"].recall == pytest.approx(5 / 21) and r["weighted avg"].precision == pytest.approx(0.7 * 5 / 8)


def test_cross_validation_and_curve(spark):
    df = split.folds(labelled(spark), "id", 3)
    cv = evaluate.cross_validate(df, models.gaussian_nb, 3)
    m = evaluate.mean_std(cv).first()
    assert cv.count() == 3 and m["mean"] > 0.9
    band = evaluate.curve_band(evaluate.learning_curve(df, models.gaussian_nb, 3, (0.5, 1.0)))
    assert band.count() == 2 and set(band.columns) == {"fraction", "train_mean", "train_std", "test_mean", "test_std"}


def test_models_are_scored_one_at_a_time_and_leave_no_files(spark, monkeypatch):
    from marlstone import session
    from marlstone.plans import reference_queries as q

    held, small = [], labelled(spark)

    def train(df):
        held.append(len(session._written))
        return models.gaussian_nb(session.materialise(df))

    monkeypatch.setattr(models, "MODELS", dict.fromkeys(models.MODELS, train))
    monkeypatch.setattr(q, "_labelled", lambda *_: small)
    monkeypatch.setattr(q, "_scaled", lambda train, test: (train, test))
    for run in (q.q_reports_by_model, q.q_confusion_by_model):
        held.clear()
        run(spark, "")
        assert len(held) == 5 and {*held} == {len(session._written)}  # the split itself stays


def test_cross_validation_leaves_no_files(spark):
    from marlstone import session

    held, before = [], len(session._written)

    def train(df):
        held.append(len(session._written))
        return models.gaussian_nb(session.materialise(df))

    assert evaluate.cross_validate(split.folds(labelled(spark), "id", 3), train, 3).count() == 3
    assert held == [before + 1] * 3 and len(session._written) == before


def test_learning_curve_of_the_logistic_model_is_fitted_in_common_passes(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3)) * [1, 10, 0.1]
    y = np.array(["high", "low", "medium"])[np.argmax(x / [1, 10, 0.1] + rng.normal(size=(600, 3)), axis=1)]
    df = spark.createDataFrame([(i, x[i].tolist(), str(y[i]), i % 3) for i in range(600)], "id bigint, features array<double>, label string, fold bigint")
    schema = lambda df: {(r["fraction"], r["fold"]): (r["train_accuracy"], r["test_accuracy"]) for r in df.collect()}
    want = schema(evaluate.learning_curve(df, lambda t: models.logistic_ovr(t), 3, (0.5, 1.0)))
    monkeypatch.setattr(models, "_mllib", None)
    got = schema(evaluate.learning_curve(df, models.logistic_ovr, 3, (0.5, 1.0)))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=0.006) for k in want)


def test_model_queries_run_the_models_of_the_survey(spark, monkeypatch):
    from marlstone.plans import reference_queries as q

    seen, small = [], labelled(spark)
    monkeypatch.setattr(q, "_labelled", lambda *_: small)
    monkeypatch.setattr(q, "_scaled", lambda train, test: (train, test))
    monkeypatch.setattr(evaluate, "learning_curve", lambda f, train, k: seen.append((f, train, k)) or spark.createDataFrame([], "fraction double, train_accuracy double, test_accuracy double"))
    q.q_learning_curve(spark, "")
    f, train, k = seen.pop()
    assert train is models.logistic_ovr and k == 3
    assert {r["count"] for r in f.groupBy("label", "fold").count().collect()} == {10}
    monkeypatch.setattr(q, "_scored", lambda s, d, train: train)
    assert q.q_forest_fit(spark, "") is models.forest and q.q_logreg_fit(spark, "") is models.logistic
    quick = {name: models.gaussian_nb for name in models.MODELS}
    monkeypatch.setattr(models, "MODELS", quick)
    assert {r["model"]: r["n"] for r in q.q_confusion_by_model(spark, "").groupBy("model").agg(F.sum("n").alias("n")).collect()} == dict.fromkeys(quick, 27)
    cv = q.q_cv_by_model(spark, "").collect()
    assert {(r["model"], r["splitter"]) for r in cv} == {(m, w) for m in quick for w in ("stratified 5", "plain 3", "stratified 3")} and all(r["mean"] > 0.9 for r in cv)


# ---------------------------------------------------------------- sources, plot data, streams


def test_generators(spark):
    c = [tuple(r) for r in generators.circle(spark, 4).orderBy("id").collect()]
    assert c[1][1] == pytest.approx(0, abs=1e-12) and c[1][2] == pytest.approx(1)
    b = generators.blobs(spark, [10, 20], [(0.0, 0.0), (9.0, 9.0)], [0.1, 0.2])
    assert {r["label"]: r["n"] for r in b.groupBy("label").agg(F.count("*").alias("n")).collect()} == {0: 10, 1: 20}
    assert generators.moons(spark, 100).groupBy("label").count().count() == 2
    with pytest.raises(ValueError):
        generators.blobs(spark, [1], [(0.0,), (1.0,)])


def test_csv_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,Avg Spend\n1,2.5\n2,\n")
    rows = read_delimited(spark, str(tmp_path / "a.csv"), "id bigint, avg_spend double").collect()
    assert [tuple(r) for r in rows] == [(1, 2.5), (2, None)]


def test_plot_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0)], "id bigint, features array<double>, prediction int")
    assert {tuple(r) for r in plotdata.pair_scatter(df, 2).collect()} == {(1, 0, 0, 1.0, 1.0, 0), (1, 0, 1, 1.0, 2.0, 0), (1, 1, 0, 2.0, 1.0, 0), (1, 1, 1, 2.0, 2.0, 0)}
    assert tuple(plotdata.cluster_scatter(df).first()) == (1, 1.0, 2.0, 0)
    m = mixture.Mixture(np.array([1.0]), np.zeros((1, 2)), np.eye(2)[None], 0.0, 0)
    g = mixture.density_grid(df, m, steps=3).collect()
    assert len(g) == 9 and min(r.x for r in g) == 0 and max(r.y for r in g) == 3
    assert next(r.logp for r in g if (r.x, r.y) == (0, 1)) == pytest.approx(-math.log(2 * math.pi) - 0.5)


def test_stream_scoring(spark, tmp_path):
    from marlstone.streaming import scoring

    pts, x = cloud(spark)
    pts.write.parquet(str(tmp_path / "in"))
    fit = kmeans.Fit([x[0].tolist(), x[50].tolist()], 0.0, 0, "euclidean")
    q = scoring.to_parquet(scoring.score_stream(spark.readStream.schema(pts.schema).parquet(str(tmp_path / "in")), fit), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select("id", "prediction").collect())) == sorted(map(tuple, fit.predict(pts).select("id", "prediction").collect()))
