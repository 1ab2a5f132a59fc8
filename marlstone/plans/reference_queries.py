"""Named queries of the analytics operators on the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone.functions.scalars import real_number
from marlstone.operators import clean, density, distance, encode, evaluate, graph, hierarchy, inspect, kmeans, mixture, plotdata, split, sweep
from marlstone.operators import classify as models
from marlstone.plans.reference_sql import oracle_sql  # noqa: F401
from marlstone.session import materialise, part_of, release, scratch, tidy
from marlstone.sources import generators
from marlstone.sources.tables import table

NUMBERS = ["passenger_count", "trip_distance", "fare_amount", "extra", "total_amount"]
CODED = ["vendor", "store_and_fwd_flag", "rate_type", "payment_type", "trip_type", "pu_location", "do_location"]
CUSTOMER = ["trips_per_month", "avg_spend", "balance", "night_share", "tenure_days", "complaints"]
FEATURES = ["passenger_count", "trip_distance", "fare_amount", "extra", "pickup_hour", "pickup_day_of_week", "trip_duration"]
LABELS = list(clean.PRICE_ORDER)
K = 4


def _round(df: DataFrame, *cols: str, places: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in cols})


def _trips(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "trips")


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return clean.clean_trips(_trips(spark, d))


def _customers(spark: SparkSession, d: str) -> DataFrame:
    """One row an id; a null feature is 0."""
    t = table(spark, d, "customer_data")
    return t.groupBy("id").agg(*(F.coalesce(F.max(real_number(c)), F.lit(0.0)).alias(c) for c in CUSTOMER))


def _plane(spark: SparkSession, d: str) -> DataFrame:
    return distance.points(table(spark, d, "points"), "id", ["x", "y"])


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), F.col("label").cast("bigint").alias("label"))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """id, features, label of the trips with a price: all columns but times, total and keys; the coded ones by codes over all cleaned rows. Written once."""
    c = _clean(spark, d).select("record_id", "price_category", *FEATURES, *CODED)
    c = encode.label_encode(c, CODED).where("price_category is not null")
    return materialise(c.select(F.col("record_id").alias("id"), F.array(*(F.col(x).cast("double") for x in (*FEATURES, *CODED))).alias("features"), F.col("price_category").alias("label")))


def _priced(spark: SparkSession, d: str) -> DataFrame:
    """id, label of the same trips, for splits that need no features."""
    return _clean(spark, d).where("price_category is not null").select(F.col("record_id").alias("id"), F.col("price_category").alias("label"))


def _heads(spark: SparkSession, d: str) -> tuple[DataFrame, list[list[float]]]:
    pts = _plane(spark, d)
    return pts, kmeans.init_first(pts, K)


# ---------------------------------------------------------------- trips


def q_trip_clean(spark, d):
    c = _clean(spark, d)
    cols = ["record_id", "payment_type", "price_category", "extra", "trip_distance", "fare_amount", "total_amount", "pickup_hour", "pickup_day_of_week"]
    return c.select(*cols, F.col("passenger_count").cast("bigint").alias("passenger_count"), F.round("trip_duration", 4).alias("trip_duration"))


def q_trip_label_by_hour(spark, d):
    return _round(_clean(spark, d).groupBy("price_category", "pickup_hour").agg(F.count(F.lit(1)).alias("n"), F.avg("total_amount").alias("mean_amount")), "mean_amount")


def q_profile_shape(spark, d):
    return inspect.shape(_trips(spark, d))


def q_profile_info(spark, d):
    return inspect.column_info(_trips(spark, d)).drop("dtype")


def q_profile_types(spark, d):
    return inspect.column_info(_trips(spark, d))


def q_profile_nulls(spark, d):
    return inspect.null_counts(_trips(spark, d))


def q_profile_describe(spark, d):
    return _round(inspect.describe(_trips(spark, d), NUMBERS), "mean", "std", "min", "q25", "q50", "q75", "max", places=3)


def q_head_rows(spark, d):
    return inspect.head(_trips(spark, d).select("record_id", "trip_id", "vendor", "fare_amount"), ["record_id"])


def q_rows_by_position(spark, d):
    return inspect.at_positions(_vectors(spark, d).select("id", "label"), "id", [10, 25, 50])


def q_distinct_guard(spark, d):
    return inspect.label_count(_vectors(spark, d), "label")


def q_class_names(spark, d):
    return inspect.class_names(_vectors(spark, d), "label")


def q_mode_impute(spark, d):
    return clean.fill_mode(_trips(spark, d), "passenger_count").groupBy(F.col("passenger_count").cast("bigint").alias("passenger_count")).agg(F.count(F.lit(1)).alias("n"))


def q_price_bucket(spark, d):
    return _trips(spark, d).select("record_id", clean.price_category(F.col("total_amount")).alias("price_category"))


def q_label_encode(spark, d):
    t = _trips(spark, d).select("record_id", *CODED)
    return encode.label_encode(t, CODED)


def q_standard_scale(spark, d):
    return _round(encode.standard_scale(_customers(spark, d), CUSTOMER), *CUSTOMER)


def q_minmax_scale(spark, d):
    return _round(encode.minmax_scale(_customers(spark, d), CUSTOMER), *CUSTOMER)


def q_centred(spark, d):
    return _round(encode.centre(_customers(spark, d), CUSTOMER), *CUSTOMER, places=7)


def q_stratified_split(spark, d):
    return split.stratified_split(_priced(spark, d), "id", "label").select("id", "label", "is_test")


def q_stratified_folds(spark, d):
    return split.stratified_folds(_priced(spark, d), "id", "label", 5).select("id", "label", "fold")


def q_kfold(spark, d):
    return split.folds(_priced(spark, d), "id", 3).select("id", "fold")


# ---------------------------------------------------------------- distances and clusters


def q_distance_euclidean(spark, d):
    pts, heads = _heads(spark, d)
    return _round(distance.distance_table(pts, heads).withColumn("cluster", F.col("cluster").cast("bigint")), "distance")


def q_distance_pearson(spark, d):
    pts, heads = _heads(spark, d)
    return _round(distance.distance_table(pts, heads, "pearson").withColumn("cluster", F.col("cluster").cast("bigint")), "distance")


def q_init_sample(spark, d):
    return split.sample_rows(_plane(spark, d), "id", K).select("id")


def q_init_range(spark, d):
    return plotdata.heads_table(spark, kmeans.init_range(_plane(spark, d), K))


def q_kmeans_assign(spark, d):
    pts, heads = _heads(spark, d)
    return _round(kmeans.assign(pts, heads).select("id", "prediction", "distance"), "distance")


def q_kmeans_step(spark, d):
    pts, heads = _heads(spark, d)
    s = kmeans.step_stats(kmeans.assign(pts, heads), heads)
    return _round(s.select("prediction", "n", F.col("m_0").alias("cx"), F.col("m_1").alias("cy"), (F.col("sse_0") + F.col("sse_1")).alias("sse")).withColumn("mean_sq", F.col("sse") / F.col("n")), "cx", "cy", "sse", "mean_sq")


def q_kmeans_sse_by_feature(spark, d):
    pts, heads = _heads(spark, d)
    s = kmeans.step_stats(kmeans.assign(pts, heads), heads)
    total = s.agg(F.sum("sse_0").alias("a"), F.sum("sse_1").alias("b"))
    return _round(total.select(F.expr("stack(3, 'x', a, 'y', b, 'distortion', a + b) as (feature, sse)")), "sse")


def q_kmeans_fit(spark, d):
    pts, heads = _heads(spark, d)
    return _round(plotdata.heads_table(spark, kmeans.fit(pts, K, init=heads).heads), "cx", "cy")


def q_kmeans_fit_k(spark, d):
    """Three rounds, as its SQL has them; q_kmeans_fit is the whole fit."""
    pts, heads = _heads(spark, d)
    f = kmeans.fit(pts, K, init=heads, max_iter=3)
    return _round(plotdata.heads_table(spark, f.heads), "cx", "cy")


def q_kmeans_sweep(spark, d):
    pts = _plane(spark, d)
    return plotdata.metric_line(spark, {k: kmeans.fit(pts, k).metric for k in range(2, 10)})


def q_kmeans_library_sweep(spark, d):
    pts = distance.points(encode.minmax_scale(_customers(spark, d), CUSTOMER), "id", CUSTOMER)
    return plotdata.metric_line(spark, {k: kmeans.mllib(pts, k, runs=1)[1] for k in range(2, 8)}, "inertia")


def q_silhouette_exact(spark, d):
    return _round(distance.silhouette(_vectors(spark, d).withColumnRenamed("label", "prediction")), "silhouette", places=6)


def q_silhouette_points(spark, d):
    return _round(distance.silhouette_points(_vectors(spark, d).withColumnRenamed("label", "prediction")), "s")


EPS, MIN_SAMPLES = 1.15, 3


def q_silhouette_fast(spark, d):
    v = _vectors(spark, d).withColumn("prediction", F.col("label").cast("int"))
    return _round(spark.createDataFrame([(distance.silhouette_fast(v),)], "silhouette double"), "silhouette", places=6)


def q_neighbors_eps(spark, d):
    return _round(distance.neighbours(_vectors(spark, d).drop("label"), EPS), "distance")


def q_neighbors_grid(spark, d):
    return _round(distance.neighbours(_plane(spark, d), 0.2), "distance")


def q_dbscan(spark, d):
    return density.dbscan(_vectors(spark, d).drop("label"), EPS, MIN_SAMPLES)


def q_dbscan_plane(spark, d):
    return density.dbscan(_plane(spark, d), 0.5, 5)


def q_components(spark, d):
    pts = _vectors(spark, d).drop("label")
    return graph.components(pts, distance.neighbours(pts, EPS))


def q_single_linkage_threshold(spark, d):
    return hierarchy.agglomerative(_vectors(spark, d).drop("label"), "single", threshold=EPS)


def q_single_linkage_two(spark, d):
    return hierarchy.agglomerative(_vectors(spark, d).drop("label"), "single", n_clusters=2)


def q_average_linkage(spark, d):
    return hierarchy.agglomerative(_vectors(spark, d).drop("label"), "average", n_clusters=10)


def q_linkage_merges(spark, d):
    return hierarchy.linkage(_vectors(spark, d).drop("label"), "average")


def q_linkage_merges_single(spark, d):
    return _round(hierarchy.linkage(_vectors(spark, d).drop("label"), "single"), "distance")


def q_hierarchical_sweep(spark, d):
    return sweep.hierarchical_sweep(_plane(spark, d))


def q_dbscan_sweep(spark, d):
    return sweep.dbscan_sweep(_plane(spark, d))


def q_sweep_best(spark, d):
    return sweep.best(q_dbscan_sweep(spark, d))


def q_dbscan_labels_by_run(spark, d):
    """eps, min_samples, labels (noise is one) of a small grid on the vectors."""
    pts, grid = _vectors(spark, d).drop("label"), [(1.15, 3), (1.15, 5), (1.18, 3), (1.18, 5)]
    runs = density.dbscan_runs(pts, distance.neighbours(pts, 1.18), grid)
    names = spark.createDataFrame([(k, e, m) for k, (e, m) in enumerate(grid)], "run bigint, eps double, min_samples bigint")
    n = runs.groupBy("run").agg(F.count_distinct("prediction").alias("labels"), F.count_if(F.col("prediction") == -1).alias("noise"))
    return names.join(n, "run").drop("run")


def q_kmeans_silhouettes(spark, d):
    """k, silhouette, k = 2 .. 7."""
    s = sweep.kmeans_sweep(_plane(spark, d))
    return s.select((F.col("ord") + 2).alias("k"), F.col("score").alias("silhouette"))


def q_compare_algorithms(spark, d):
    c, plane = _customers(spark, d), table(spark, d, "points").where("x is not null and y is not null")
    sets = {}
    for name, df, cols in (("points", plane, ["x", "y"]), ("customers", c, CUSTOMER)):
        sets[f"{name} raw"] = distance.points(df, "id", cols)
        sets[f"{name} normalised"] = distance.points(encode.minmax_scale(df.select("id", *cols), cols), "id", cols)
    return sweep.compare(sets)


# ---------------------------------------------------------------- mixtures


def _mixture(spark, d, covariance):
    pts = _plane(spark, d)
    m = mixture.fit(pts, 3, covariance)
    return mixture.predict(pts, m).select("id", "prediction", F.round("log_density", 6).alias("log_density"))


def q_gmm_full(spark, d):
    return _mixture(spark, d, "full")


def q_gmm_tied(spark, d):
    return _mixture(spark, d, "tied")


def q_gmm_diag(spark, d):
    return _mixture(spark, d, "diag")


def q_gmm_spherical(spark, d):
    return _mixture(spark, d, "spherical")


def q_gmm_sweep(spark, d):
    return sweep.mixture_sweep(_plane(spark, d))


def q_gmm_logdensity_grid(spark, d):
    pts = _plane(spark, d)
    return mixture.density_grid(pts, mixture.fit(pts, 3))


def q_gmm_contours(spark, d):
    """dim_i, dim_j, x, y, logp: a mixture fitted anew to every pair of features."""
    cols = CUSTOMER[:3]
    c = encode.minmax_scale(_customers(spark, d), cols)
    return mixture.pair_contours(distance.points(c, "id", cols), len(cols))


def q_gmm_fixed_grid(spark, d):
    import numpy as np

    m = mixture.Mixture(np.array([0.25, 0.75]), np.array([[0.0, 0.0], [5.0, -2.0]]), np.array([np.diag([4.0, 1.0]), np.diag([9.0, 16.0])]), 0.0, 0)
    return mixture.predict(mixture.evaluation_grid(_plane(spark, d)), m).select("id", F.round("log_density", 4).alias("logp"))


def q_gmm_fixed_density(spark, d):
    import numpy as np

    m = mixture.Mixture(np.array([0.25, 0.75]), np.array([[0.0, 0.0], [5.0, -2.0]]), np.array([np.diag([4.0, 1.0]), np.diag([9.0, 16.0])]), 0.0, 0)
    return _round(mixture.predict(_plane(spark, d), m).select("id", "prediction", "log_density"), "log_density")


# ---------------------------------------------------------------- classifiers


def _held_out(spark, d):
    with scratch(spark) as kept:
        kept.append(df := _labelled(spark, d))
    s = split.stratified_split(df, "id", "label")
    return tuple(part_of(s.where(x).drop("is_test"), df) for x in ("not is_test", "is_test"))


def _nb_predictions(spark, d):
    train, test = _held_out(spark, d)
    return models.gaussian_nb(train)(test)


def q_knn_predict(spark, d):
    v = split.folds(_vectors(spark, d), "id", 3)
    return models.knn(v.where("fold <> 0"))(v.where("fold = 0")).select("id", "label", "prediction")


def q_gaussian_nb(spark, d):
    return _nb_predictions(spark, d).select("id", "label", "prediction")


def q_confusion_matrix(spark, d):
    return evaluate.confusion(_nb_predictions(spark, d), LABELS)


def q_classification_report(spark, d):
    return _round(evaluate.report(_nb_predictions(spark, d), LABELS), "precision", "recall", "f1").withColumn("support", F.col("support").cast("bigint"))


def q_in_sample_report(spark, d):
    df = _labelled(spark, d)
    out = evaluate.report(models.gaussian_nb(df)(df), LABELS)
    return _round(out, "precision", "recall", "f1").withColumn("support", F.col("support").cast("bigint"))


def _by_model(spark, d, measure, columns):
    """model and the columns of measure(scored rows), a few rows a model; a model at a time."""
    fit, test = _scaled(*_held_out(spark, d))
    rows = []
    for name, train in models.MODELS.items():
        with scratch(spark):
            rows += [(name, *r) for r in measure(train(fit)(test), LABELS).select(*(c.split()[0] for c in columns.split(", "))).collect()]
    return spark.createDataFrame(rows, f"model string, {columns}")


def q_confusion_by_model(spark, d):
    """Confusion tables of all models on one held-out part."""
    return _by_model(spark, d, evaluate.confusion, "label string, prediction string, n bigint")


def q_accuracy(spark, d):
    return _round(evaluate.accuracy(_nb_predictions(spark, d)), "accuracy")


def q_cv_scores(spark, d):
    f = split.stratified_folds(_labelled(spark, d), "id", "label", 5)
    return _round(evaluate.cross_validate(f, models.gaussian_nb, 5), "accuracy")


def q_cv_mean_std(spark, d):
    f = split.stratified_folds(_labelled(spark, d), "id", "label", 5)
    return _round(evaluate.mean_std(evaluate.cross_validate(f, models.gaussian_nb, 5)), "mean", "std")


def q_cv_plain(spark, d):
    f = split.folds(_labelled(spark, d), "id", 3)
    return _round(evaluate.cross_validate(f, models.gaussian_nb, 3), "accuracy")


def q_cv_by_model(spark, d):
    """model, splitter, mean, std: every model under each of the three ways to cross-validate."""
    df = _labelled(spark, d)
    ways = {"stratified 5": (split.stratified_folds(df, "id", "label", 5), 5), "plain 3": (split.folds(df, "id", 3), 3), "stratified 3": (split.stratified_folds(df, "id", "label", 3), 3)}
    rows = [(name, way, *evaluate.mean_std(evaluate.cross_validate(f, train, k)).first()) for way, (f, k) in ways.items() for name, train in models.MODELS.items()]
    return spark.createDataFrame(rows, "model string, splitter string, mean double, std double")


def _scaled(train, test):
    """Features of both standardised by the training rows; the files of the table that they are parts of go."""
    n = len(FEATURES) + len(CODED)
    wide = lambda df: df.select("id", "label", *(F.col("features")[j].alias(f"f{j}") for j in range(n)))
    cols = [f"f{j}" for j in range(n)]
    fit = wide(train)
    back = lambda df: materialise(encode.standard_scale(wide(df), cols, fit).select("id", "label", F.array(*cols).alias("features")))
    out = back(train), back(test)
    for df in (train, test):
        release(df)
    tidy(train.sparkSession)
    return out


def _scored(spark, d, train):
    fit, test = _scaled(*_held_out(spark, d))
    return evaluate.accuracy(train(fit)(test))


def q_logreg_fit(spark, d):
    return _scored(spark, d, models.logistic)


def q_logreg_l2_ovr(spark, d):
    return _scored(spark, d, models.logistic_ovr)


def q_tree_fit(spark, d):
    return _scored(spark, d, models.tree)


def q_forest_fit(spark, d):
    return _scored(spark, d, models.forest)


def q_learning_curve_nb(spark, d):
    f = split.stratified_folds(_labelled(spark, d), "id", "label", 3)
    return _round(evaluate.learning_curve(f, models.gaussian_nb, 3, (0.5, 1.0)), "train_accuracy", "test_accuracy")


def q_cv_stratified(spark, d):
    f = split.stratified_folds(_labelled(spark, d), "id", "label", 3)
    return _round(evaluate.cross_validate(f, models.gaussian_nb, 3), "accuracy")


def q_confusion_colours(spark, d):
    return evaluate.text_colours(evaluate.confusion(_nb_predictions(spark, d), LABELS))


def q_scores_as_text(spark, d):
    """fold and accuracy with three places."""
    return evaluate.formatted(q_cv_plain(spark, d), {"accuracy": 3})


def q_reports_by_model(spark, d):
    """The report of each model on the held-out part."""
    return _by_model(spark, d, evaluate.report, "name string, precision double, recall double, f1 double, support bigint")


def q_in_sample_confusion(spark, d):
    """Confusion of the L2 one-vs-rest logistic model on the rows it was fitted on."""
    df = _labelled(spark, d)
    return evaluate.confusion(models.logistic_ovr(df)(df), LABELS)


def q_in_sample_logistic_report(spark, d):
    df = _labelled(spark, d)
    return evaluate.report(models.logistic_ovr(df)(df), LABELS)


def q_learning_curve(spark, d):
    f = split.stratified_folds(_labelled(spark, d), "id", "label", 3)
    return evaluate.curve_band(evaluate.learning_curve(f, models.logistic_ovr, 3))


# ---------------------------------------------------------------- plot data and generators


def q_cluster_scatter(spark, d):
    pts, heads = _heads(spark, d)
    return plotdata.cluster_scatter(kmeans.assign(pts, heads))


def q_pair_scatter(spark, d):
    pts, heads = _heads(spark, d)
    out = plotdata.pair_scatter(kmeans.assign(pts, heads), 2)
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("dim_i", "dim_j")})


def q_eval_grid(spark, d):
    g = mixture.evaluation_grid(_plane(spark, d))
    return _round(g.select("id", F.col("features")[0].alias("x"), F.col("features")[1].alias("y")), "x", "y")


def q_gen_circle(spark, d):
    return _round(generators.circle(spark), "x", "y")


def q_gen_blobs(spark, d):
    return generators.blobs(spark, [100, 150, 300, 400, 300, 200], [(0.0, 0.0), (5.0, 5.0), (-5.0, 5.0), (5.0, -5.0), (-5.0, -5.0), (10.0, 0.0)], [1.3, 0.6, 1.2, 1.7, 0.9, 1.7])


def q_gen_moons(spark, d):
    return generators.moons(spark)


def queries() -> dict:
    return {name[2:]: f for name, f in globals().items() if name.startswith("q_")}
