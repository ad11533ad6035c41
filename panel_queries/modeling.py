"""Models, tuning, clustering, reduction, sinks for them, and the named flows, all in the operators' own
configuration: tree counts, depths, iterations, folds, starts and models are never overridden here."""

from __future__ import annotations

from functools import partial

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from panel_queries.base import query, r
from panel_queries.derive import MASTER_COLUMNS, TARGET_STEPS, raw_tables
from panelcraft.functions.scalars import unit_interval
from panelcraft.operators import clustering, experiments, metrics, models, reduction, splits, tuning
from panelcraft.operators.dbscan import dbscan
from panelcraft.operators.targets import level_of
from panelcraft.plans import flows, stages
from panelcraft.session import scratch_folder
from panelcraft.sources import sinks


def scored_orders(t):
    """Orders with three inputs of few values each, and targets that follow from them: the level from the priority alone,
    with a gap between the classes, the capacity linearly from all three. What a model must find is therefore known."""
    joined = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    place = lambda c, values: F.array_position(F.array(*map(F.lit, values)), F.col(c)).cast("double")
    priority = F.substring("o_orderpriority", 1, 1).cast("double")
    rows = joined.select(
        F.col("o_orderkey").alias("row_key"), priority.alias("priority"), place("o_orderstatus", "FOP").alias("status"),
        F.ascii("c_mktsegment").cast("double").alias("segment"),
    )
    score = F.when(F.col("priority") <= 2, 0.2).when(F.col("priority") <= 3, 0.5).otherwise(0.9)
    capacity = 10 + 3 * F.col("priority") - 2 * F.col("status") + 0.5 * (F.col("segment") - 65)
    return rows.withColumns({"preparedness_level": level_of(score), "healthcare_capacity_score": capacity})


def _perfect(*names):
    """Rows of models that are right about every test row."""
    columns = ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc_ovr")
    return " UNION ALL ".join(f"SELECT '{n}' AS model, " + ", ".join(f"1.0::DOUBLE AS {c}" for c in columns) for n in names)


def _exact(*names):
    """Rows of models that are right about every test value, to two decimals of R2."""
    return " UNION ALL ".join(f"SELECT '{n}' AS model, 1.0::DOUBLE AS r2" for n in names)


def _class_scores(evaluation):
    return evaluation.select("model", *[r(c, 3) for c in ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc_ovr")])


def class_rows(t, folds=models.FOLDS):
    m = splits.classification_matrix(scored_orders(t), "row_key")
    coded = splits.label_indexer(m.rows, "preparedness_level").transform(m.assembled())
    stored = sinks.write_stage(coded.select("row_key", "label", "features", "is_test"), scratch_folder(t.spark, "classes"))
    train, test = splits.train_test(stored)
    return tuning.folded(train, "row_key", folds, "label"), test


def value_rows(t, folds=models.FOLDS):
    m = splits.regression_matrix(scored_orders(t), "row_key")
    rows = m.assembled().select("row_key", F.col(m.target).alias("label"), "features", "is_test")
    train, test = splits.train_test(sinks.write_stage(rows, scratch_folder(t.spark, "values")))
    return tuning.folded(train, "row_key", folds, None), test


def _classified(t, name, train):
    rows, test = class_rows(t)
    tuned = train(rows)
    out = tuned.model.transform(test)
    scored = out.select("label", "prediction", models.class_probabilities(out).alias("p"))
    union = metrics.union_scored({name: scored}, scored.columns)
    return _class_scores(metrics.evaluate_classifiers(union, "label", "prediction", {float(i): F.col("p")[i] for i in range(3)}))


@query("m1_logistic_regression", _perfect("logistic"))
def _(t):
    return _classified(t, "logistic", models.train_logistic)


@query("m2_random_forest", _perfect("forest"))
def _(t):
    return _classified(t, "forest", models.train_random_forest)


@query("m3_boosted_subspace", _perfect("boosted"))
def _(t):
    return _classified(t, "boosted", models.train_boosted_subspace)


@query("m4_kernel_svm", _perfect("svm"))
def _(t):
    return _classified(t, "svm", models.train_kernel_svm)


@query("m5_gradient_boosting", _perfect("boosting"))
def _(t):
    return _classified(t, "boosting", models.train_gradient_boosting)


def _regressed(t, name, train):
    rows, test = value_rows(t)
    scored = train(rows).model.transform(test)
    found = metrics.evaluate_regressors(metrics.union_scored({name: scored}, ["label", "prediction"]), "label", "prediction")
    return found.select("model", r("r2", 2))


@query("r3_forest_regressor", _exact("forest"))
def _(t):
    return _regressed(t, "forest", models.train_forest_regressor)


@query("r4_boosted_subspace_regressor", _exact("boosted"))
def _(t):
    return _regressed(t, "boosted", partial(models.train_boosted_regressor, columns="0.8"))


@query("r5_gradient_boosting_regressor", _exact("boosting"))
def _(t):
    return _regressed(t, "boosting", models.train_boosted_regressor)


def _one_input(t):
    rows = t.lineitem.select(F.col("l_quantity"), F.col("l_extendedprice").alias("label"))
    return VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)


def _line(t, model):
    return t.spark.createDataFrame(
        [(round(float(model.coefficients[0]), 4), round(float(model.intercept), 3))], "slope double, intercept double"
    )


@query(
    "r1_linear_regression",
    "SELECT ROUND(REGR_SLOPE(l_extendedprice, l_quantity), 4) AS slope, ROUND(REGR_INTERCEPT(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem",
)
def _(t):
    return _line(t, models.linear().fit(_one_input(t)))


@query(
    "r2_ridge_regression",
    """WITH s AS (SELECT REGR_SXY(l_extendedprice, l_quantity) / (REGR_SXX(l_extendedprice, l_quantity) + 100000) AS b, AVG(l_extendedprice) AS y, AVG(l_quantity) AS x FROM lineitem)
       SELECT ROUND(b, 4) AS slope, ROUND(y - b * x, 3) AS intercept FROM s""",
)
def _(t):
    """Closed form with one input; the penalty is large so that it shows."""
    rows = _one_input(t)
    return _line(t, models.ridge(rows, alpha=100000.0).fit(rows))


# ------------------------------------------------------------------------------------------ tuning


@query(
    "t6_grid_search",
    "SELECT strength::DOUBLE AS strength, 1.0::DOUBLE AS cv_mean, 0.0::DOUBLE AS cv_std FROM (VALUES (0.1), (1.0)) v(strength)",
)
def _(t):
    """One row per grid point: mean and std of the fold scores."""
    rows, _test = class_rows(t)
    tuned = models.train_logistic(rows, strengths=(0.1, 1.0))
    table = [(c, m, s) for c, m, s in zip((0.1, 1.0), tuned.grid_means, tuned.grid_stds)]
    return t.spark.createDataFrame(table, "strength double, cv_mean double, cv_std double").select("strength", r("cv_mean", 3), r("cv_std", 3))


@query("t7_cross_val_score", "SELECT 1.0::DOUBLE AS cv_mean, 0.0::DOUBLE AS cv_std")
def _(t):
    rows, _test = class_rows(t, folds=5)
    mean, std = tuning.cross_val_score(models.random_forest(), tuning.accuracy(), rows, folds=5)
    return t.spark.createDataFrame([(mean, std)], "cv_mean double, cv_std double")


@query("x7_cv_summary", "SELECT 'ridge' AS model, 1.0::DOUBLE AS cv_mean, 0.0::DOUBLE AS cv_std, '{''alpha'': 1.0, ''fit_intercept'': True}' AS params")
def _(t):
    rows, _test = value_rows(t)
    tuned = models.train_ridge(rows)
    return t.spark.createDataFrame([tuned.row("ridge", regression=True)], tuning.TRAINING_SCHEMA).select("model", r("cv_mean", 3), r("cv_std", 3), "params")


# ------------------------------------------------------------------------------------------ experiments


def _labels(t):
    rows = clustering.clustering_rows(scored_orders(t), "row_key")
    vectors = clustering.scaled_vectors(rows, "row_key").persist()
    kmeans = clustering.fit_kmeans(vectors, "features", 3).labels(vectors, "row_key", "features")
    tree = clustering.fit_hierarchy(vectors, "features").labels(vectors, "row_key", "features", 5)
    folder = scratch_folder(t.spark, "cluster-labels")
    return {n: sinks.save_labels(d, "row_key", "cluster", f"{folder}/{n}") for n, d in (("kmeans", kmeans), ("hierarchical", tree))}


def _experiments(t):
    prepared = experiments.experiment_splits(
        scored_orders(t), "row_key", "preparedness_level", _labels(t), exclude=["healthcare_capacity_score"]
    )
    return experiments.run_experiments(prepared)


@query(
    "m6_cluster_experiments",
    """SELECT experiment, n_features::BIGINT AS n_features, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS f1, 1.0::DOUBLE AS cv_mean, 0.0::DOUBLE AS cv_std
       FROM (VALUES ('baseline', 3), ('kmeans', 4), ('hierarchical', 4)) v(experiment, n_features)""",
)
def _(t):
    results, _importance, _models = _experiments(t)
    return results.select("experiment", "n_features", *[r(c, 3) for c in ("accuracy", "f1", "cv_mean", "cv_std")])


@query("x13_cluster_importance")
def _(t):
    results, importance, _models = _experiments(t)
    return experiments.experiment_report(results, importance)["cluster_rank"]


def _forest(t):
    rows, test = class_rows(t)
    return models.random_forest().fit(rows), test


@query("o3_top_importance", "SELECT 'priority' AS feature, true AS over_half")
def _(t):
    """The level follows from the priority alone."""
    model, _test = _forest(t)
    top = models.top_importance(models.importance_table(model, ["priority", "status", "segment"], t.spark), 1)
    return top.select("feature", (F.col("importance") > 0.5).alias("over_half"))


# ------------------------------------------------------------------------------------------ sinks


@query(
    "s3_metrics_sink",
    """SELECT 'orders' AS model, 'price.mean' AS metric, ROUND(AVG(o_totalprice), 4) AS value FROM orders
       UNION ALL SELECT 'orders', 'price.max', MAX(o_totalprice) FROM orders UNION ALL SELECT 'orders', 'rows', COUNT(*) FROM orders""",
)
def _(t):
    row = t.orders.agg(F.round(F.avg("o_totalprice"), 4).alias("m"), F.max("o_totalprice").alias("x"), F.count("*").alias("n")).first()
    path = scratch_folder(t.spark, "metrics")
    nested = {"price": {"mean": row["m"], "max": row["x"]}, "rows": row["n"]}
    sinks.write_metrics(sinks.metrics_frame(t.spark, "orders", nested), path)
    return t.spark.read.schema("model string, metric string, value double").json(path)


@query(
    "s4_model_persistence",
    """WITH s AS (SELECT substr(o_orderpriority, 1, 1)::INT AS s FROM orders JOIN customer ON o_custkey = c_custkey),
            c AS (SELECT CASE WHEN s <= 2 THEN 'Low' WHEN s <= 3 THEN 'Medium' ELSE 'High' END AS level, COUNT(*) AS n FROM s GROUP BY 1)
       SELECT SUM(FLOOR(0.2 * n + 0.5))::BIGINT AS n_rows, SUM(FLOOR(0.2 * n + 0.5))::BIGINT AS n_equal FROM c""",
)
def _(t):
    """Predictions of a forest before saving and after loading: the number of rows on which they agree."""
    model, test = _forest(t)
    path = sinks.save_model(model, scratch_folder(t.spark, "model"))
    again = RandomForestClassificationModel.load(path)
    first = model.transform(test).select("row_key", F.col("prediction").alias("a"))
    second = again.transform(test).select("row_key", F.col("prediction").alias("b"))
    return first.join(second, "row_key").agg(F.count("*").alias("n_rows"), F.count_if(F.col("a") == F.col("b")).alias("n_equal"))


@query("s5_label_sink", "SELECT vec_id, label FROM embeddings")
def _(t):
    return sinks.save_labels(t.embeddings, "vec_id", "label", scratch_folder(t.spark, "labels"))


# ------------------------------------------------------------------------------------------ clustering

CUSTOMER_SQL = """SELECT c_custkey AS row_key, COALESCE(n, 0)::BIGINT AS n_orders, c_acctbal, c_nationkey, s AS top_price FROM customer LEFT JOIN
    (SELECT o_custkey, COUNT(*) AS n, MAX(o_totalprice) AS s FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"""


def customer_rows(t):
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top_price"))
    return t.customer.join(orders, "c_custkey", "left").select(
        F.col("c_custkey").alias("row_key"), F.coalesce("n", F.lit(0)).alias("n_orders"), "c_acctbal", "c_nationkey", "top_price"
    )


def customer_vectors(t):
    return clustering.scaled_vectors(clustering.clustering_rows(customer_rows(t), "row_key"), "row_key")


@query(
    "k1_clustering_rows",
    f"SELECT row_key, n_orders::DOUBLE AS n_orders, c_acctbal, c_nationkey::DOUBLE AS c_nationkey, top_price FROM ({CUSTOMER_SQL}) WHERE top_price IS NOT NULL",
)
def _(t):
    return clustering.clustering_rows(customer_rows(t), "row_key")


@query("k2_search_k")
def _(t):
    return clustering.search_k(customer_vectors(t), "row_key", "features")[1]


@query("k3_kmeans")
def _(t):
    vectors = customer_vectors(t).persist()
    _fit, labels, _metrics = clustering.train_kmeans(vectors, "row_key", "features", 4)
    return labels


GROUPS = 4


def grouped_customers(t):
    """Customers in GROUPS groups set well apart, by nation: how many clusters there are and who is in which is known."""
    group = F.col("c_nationkey") % GROUPS
    place = F.array(group * 100.0 + F.col("c_acctbal") / 1000, group * group * 40.0 + F.col("c_custkey") % 7)
    return t.customer.select("c_custkey", place.alias("v"))


@query("k2_separated_groups", f"SELECT k, k = {GROUPS} AS is_best FROM (SELECT UNNEST(RANGE(2, 11))::INT AS k)")
def _(t):
    return clustering.search_k(grouped_customers(t), "c_custkey", "v")[1].select("k", "is_best")


@query("k3_separated_groups", f"SELECT c_custkey, MIN(c_custkey) OVER (PARTITION BY c_nationkey % {GROUPS}) AS first_of_cluster FROM customer")
def _(t):
    points = grouped_customers(t)
    labels = clustering.fit_kmeans(points, "v", GROUPS).labels(points, "c_custkey", "v")
    first = labels.groupBy("cluster").agg(F.min("c_custkey").alias("first_of_cluster"))
    return labels.join(first, "cluster").select("c_custkey", "first_of_cluster")


DBSCAN_EPS, DBSCAN_MIN = 0.2, 8

_DBSCAN_SQL = f"""WITH RECURSIVE p AS (SELECT c_custkey AS id, c_acctbal / 1000 AS x, c_nationkey / 2.0::DOUBLE AS y FROM customer),
near AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {DBSCAN_EPS}),
core AS (SELECT a AS id FROM near GROUP BY a HAVING COUNT(*) >= {DBSCAN_MIN}),
link AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id, id AS root FROM core UNION SELECT link.b, reach.root FROM reach JOIN link ON reach.id = link.a WHERE reach.root < link.b),
comp AS (SELECT id, MIN(root) AS root FROM reach GROUP BY id),
numbered AS (SELECT id, DENSE_RANK() OVER (ORDER BY root) - 1 AS cluster FROM comp),
border AS (SELECT near.a AS id, MIN(cluster) AS cluster FROM near JOIN numbered ON near.b = numbered.id WHERE near.a NOT IN (SELECT id FROM core) GROUP BY near.a)
SELECT p.id AS c_custkey, COALESCE(numbered.cluster, border.cluster, -1)::BIGINT AS cluster FROM p LEFT JOIN numbered ON p.id = numbered.id LEFT JOIN border ON p.id = border.id"""


@query("k4_dbscan", _DBSCAN_SQL)
def _(t):
    points = t.customer.select("c_custkey", F.array(F.col("c_acctbal") / 1000, F.col("c_nationkey") / 2.0).alias("v"))
    return dbscan(points, "c_custkey", "v", DBSCAN_EPS, DBSCAN_MIN).select("c_custkey", F.col("cluster").cast("long").alias("cluster"))


@query("k5_hierarchical")
def _(t):
    vectors = customer_vectors(t).persist()
    _fit, labels, _metrics = clustering.train_hierarchical(vectors, "row_key", "features", 5)
    return labels


@query("k5_separated_groups", "SELECT c_custkey, MIN(c_custkey) OVER (PARTITION BY c_nationkey % 5) AS first_of_cluster FROM customer")
def _(t):
    group = F.col("c_nationkey") % 5
    place = F.array(group * 100.0 + F.col("c_acctbal") / 1000, group * group * 40.0 + F.col("c_custkey") % 7)
    points = t.customer.select("c_custkey", place.alias("v"))
    labels = clustering.fit_hierarchy(points, "v").labels(points, "c_custkey", "v", 5)
    first = labels.groupBy("cluster").agg(F.min("c_custkey").alias("first_of_cluster"))
    return labels.join(first, "cluster").select("c_custkey", "first_of_cluster")


@query("k6_merge_table")
def _(t):
    return clustering.fit_hierarchy(customer_vectors(t), "features").merge_table(t.spark)


# ------------------------------------------------------------------------------------------ reduction


def _reduced(t):
    vectors = splits.standardize_array(t.embeddings, "embedding", 64).persist()
    return vectors, reduction.fit_pca(vectors, "embedding")


@query("y6_pca_scores")
def _(t):
    vectors, fit = _reduced(t)
    return fit.scores(vectors, "vec_id", "embedding")


@query("y7_top_loadings")
def _(t):
    return _reduced(t)[1].top_loadings(t.spark)


@query("y8_variance_table")
def _(t):
    return _reduced(t)[1].variance_table(t.spark)


@query("y8_biplot_table")
def _(t):
    vectors, fit = _reduced(t)
    return reduction.biplot_table(fit.scores(vectors, "vec_id", "embedding"), "vec_id", t.embeddings.select("vec_id", "label"))


@query("y9_reduction_summary")
def _(t):
    return _reduced(t)[1].summary(t.spark)


@query(
    "w7_cumulative_share",
    """WITH v AS (SELECT l_linenumber AS component, SUM(l_quantity) AS s FROM lineitem GROUP BY 1)
       SELECT component, ROUND(s / SUM(s) OVER (), 6) AS share, ROUND(SUM(s) OVER (ORDER BY component) / SUM(s) OVER (), 6) AS cumulative FROM v""",
)
def _(t):
    per = t.lineitem.groupBy(F.col("l_linenumber").alias("component")).agg(F.sum("l_quantity").alias("s"))
    whole, running = Window.partitionBy(), Window.partitionBy().orderBy("component")  # one row per component
    return per.select(
        "component", F.round(F.col("s") / F.sum("s").over(whole), 6).alias("share"),
        F.round(F.sum("s").over(running) / F.sum("s").over(whole), 6).alias("cumulative"),
    )


# ------------------------------------------------------------------------------------------ named flows


@query(
    "g1_data_engineering",
    f"""WITH {TARGET_STEPS} SELECT 'classification' AS dataset, preparedness_level, COUNT(*) AS n FROM levelled WHERE preparedness_level IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'regression', preparedness_level, COUNT(*) FROM levelled WHERE healthcare_capacity_score IS NOT NULL GROUP BY ALL""",
)
def _(t):
    raw = raw_tables(t)
    names = dict(zip(stages.RAW_TABLES, ("cases", "vaccinations", "by_age", "by_manufacturer")))
    classification, regression = stages.run_data_engineering(t.spark, {n: raw[s] for n, s in names.items()}, keep=MASTER_COLUMNS)
    parts = [
        df.groupBy("preparedness_level").agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), "preparedness_level", "n")
        for name, df in (("classification", classification), ("regression", regression))
    ]
    return parts[0].unionByName(parts[1])


@query("g2_classification_flow", _perfect(*flows.CLASSIFIERS))
def _(t):
    rows = scored_orders(t).drop("healthcare_capacity_score")
    return _class_scores(flows.run_classification(rows)["evaluation"])


@query("g3_regression_flow", _exact(*flows.REGRESSORS))
def _(t):
    return flows.run_regression(scored_orders(t))["evaluation"].select("model", r("r2", 2))


@query("g4_unsupervised_flow")
def _(t):
    found = flows.run_unsupervised(customer_rows(t), eps=0.8, min_samples=10)
    return found["comparison"]


@query("g5_integration_flow")
def _(t):
    rows = scored_orders(t).drop("healthcare_capacity_score")
    found = flows.run_integration(rows, _labels(t), rows=None)
    return found["comparison"].drop("seconds", "time_diff")


@query(
    "g6_supervised_flow",
    " UNION ALL ".join(f"SELECT '{k}' AS kind, '{n}' AS model, 1.0::DOUBLE AS score" for k, ns in (("classification", flows.CLASSIFIERS), ("regression", flows.REGRESSORS)) for n in ns),
)
def _(t):
    rows = scored_orders(t)
    found = flows.run_supervised(rows, rows)
    a = found["classification"]["evaluation"].select(F.lit("classification").alias("kind"), "model", F.round("f1_weighted", 2).alias("score"))
    return a.unionByName(found["regression"]["evaluation"].select(F.lit("regression").alias("kind"), "model", F.round("r2", 2).alias("score")))
