"""Splits, metrics and comparison tables on fixed predictions; cluster metrics and patterns on fixed labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from panel_queries.base import query, r
from panelcraft.functions import scalars as sc
from panelcraft.operators import cluster_metrics, metrics, patterns, splits

# ------------------------------------------------------------------------------------------ splits

_HASHED = "SELECT *, MD5(CONCAT(CAST(o_orderkey AS VARCHAR), '-42')) AS h FROM orders"
_SPLIT_SQL = f"""SELECT o_orderkey, o_orderstatus,
       ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY h) <= FLOOR(0.2 * COUNT(*) OVER (PARTITION BY o_orderstatus) + 0.5) AS is_test
FROM ({_HASHED})"""


@query("t3_stratified_split", _SPLIT_SQL)
def _(t):
    return splits.with_stratified_split(t.orders, "o_orderkey", "o_orderstatus").select("o_orderkey", "o_orderstatus", "is_test")


@query("t3_stratified_split_by_prefix", _SPLIT_SQL)
def _(t):
    """Same rows when hash prefixes have to be refined before anything is ranked."""
    out = splits.with_stratified_split(t.orders, "o_orderkey", "o_orderstatus", ranked_rows=1)
    return out.select("o_orderkey", "o_orderstatus", "is_test")


@query("t4_plain_split", f"SELECT o_orderkey, SUBSTR(h, 1, 8) < '33333333' AS is_test FROM ({_HASHED})")
def _(t):
    return splits.with_plain_split(t.orders, "o_orderkey").select("o_orderkey", "is_test")


@query(
    "t5_stratified_folds",
    f"""WITH k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY h) AS i, COUNT(*) OVER (PARTITION BY o_orderstatus) AS n FROM ({_HASHED}))
        SELECT o_orderkey, (CASE WHEN i > FLOOR(n * (1/3::DOUBLE) + 0.5) THEN 1 ELSE 0 END + CASE WHEN i > FLOOR(n * (2/3::DOUBLE) + 0.5) THEN 1 ELSE 0 END) AS fold FROM k""",
)
def _(t):
    return splits.with_stratified_folds(t.orders, "o_orderkey", "o_orderstatus", 3).select("o_orderkey", "fold")


@query(
    "t5_block_folds",
    """WITH k AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i, COUNT(*) OVER () AS n FROM orders),
            f AS (SELECT *, n // 7 AS s, n % 7 AS e FROM k)
       SELECT o_orderkey, CASE WHEN i < e * (s + 1) THEN i // (s + 1) ELSE e + (i - e * (s + 1)) // s END AS fold FROM f""",
)
def _(t):
    return splits.with_block_folds(t.orders, ["o_orderkey"], 7).select("o_orderkey", "fold")


_MATRIX_SQL = """WITH d AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderpriority <> '5-LOW' AND o_totalprice > 1000 THEN o_totalprice / 2 END AS gap FROM orders),
q AS (SELECT QUANTILE_CONT(gap, 0.5) AS m FROM d), k AS ({split})
SELECT d.o_orderkey, {target}, o_totalprice, ROUND(COALESCE(gap, m), 4) AS gap, is_test FROM d JOIN k ON d.o_orderkey = k.o_orderkey, q"""


def _gap_rows(t):
    gap = F.when(F.col("o_totalprice") > 1000, F.col("o_totalprice") / 2).otherwise(float("inf"))
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.when(F.col("o_orderpriority") != "5-LOW", gap).alias("gap")
    )


@query("t1_classification_matrix", _MATRIX_SQL.format(split=_SPLIT_SQL, target="d.o_orderstatus"))
def _(t):
    m = splits.classification_matrix(_gap_rows(t), "o_orderkey", "o_orderstatus")
    return m.rows.select("o_orderkey", "o_orderstatus", "o_totalprice", r("gap", 4), "is_test")


@query(
    "t2_regression_matrix",
    """WITH d AS (SELECT o_orderkey, o_custkey, o_totalprice AS vaccination_rate, SUBSTR(MD5(CONCAT(CAST(o_orderkey AS VARCHAR), '-42')), 1, 8) < '33333333' AS is_test FROM orders)
       SELECT o_orderkey, vaccination_rate, o_custkey::DOUBLE AS o_custkey, is_test FROM d""",
)
def _(t):
    named = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("vaccination_rate"))
    m = splits.regression_matrix(named, "o_orderkey")
    return m.rows.select("o_orderkey", "vaccination_rate", F.col("o_custkey").cast("double").alias("o_custkey"), "is_test")


@query(
    "t8_label_codes",
    """SELECT o_orderstatus, label::DOUBLE AS label, COUNT(*) AS n FROM orders JOIN (SELECT s, ROW_NUMBER() OVER (ORDER BY s) - 1 AS label FROM (SELECT DISTINCT o_orderstatus AS s FROM orders)) ON s = o_orderstatus GROUP BY ALL""",
)
def _(t):
    indexer = splits.label_indexer(t.orders, "o_orderstatus")
    coded = indexer.transform(t.orders)
    decoded = splits.label_decoder(indexer, "label", "o_orderstatus").transform(coded.drop("o_orderstatus"))
    return decoded.groupBy("o_orderstatus", "label").agg(F.count("*").alias("n"))


@query(
    "t9_standardize",
    """SELECT o_orderkey, ROUND((o_totalprice - AVG(o_totalprice) OVER ()) / STDDEV_POP(o_totalprice) OVER (), 6) AS o_totalprice, 0.0 AS one FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.lit(1).alias("one"))
    return splits.Standardizer(["o_totalprice", "one"]).fit_transform(rows).select("o_orderkey", r("o_totalprice"), "one")


# ------------------------------------------------------------------------------------------ metrics

_PRED_SQL = """SELECT 'quantity' AS model, l_returnflag AS label, CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 40 THEN 'N' ELSE 'X' END AS prediction,
    l_quantity / 50 AS score_a, l_discount AS score_n, l_tax AS score_r FROM lineitem
UNION ALL SELECT 'tax', l_returnflag, CASE WHEN l_tax < 0.03 THEN 'R' ELSE 'A' END, l_tax, l_discount, l_quantity / 50 FROM lineitem"""


def predictions(t):
    q, tax = F.col("l_quantity"), F.col("l_tax")
    one = t.lineitem.select(
        F.col("l_returnflag").alias("label"), F.when(q < 17, "A").when(q < 40, "N").otherwise("X").alias("prediction"),
        (q / 50).alias("score_a"), F.col("l_discount").alias("score_n"), tax.alias("score_r"),
    )
    two = t.lineitem.select(
        F.col("l_returnflag").alias("label"), F.when(tax < 0.03, "R").otherwise("A").alias("prediction"),
        tax.alias("score_a"), F.col("l_discount").alias("score_n"), (q / 50).alias("score_r"),
    )
    return metrics.union_scored({"quantity": one, "tax": two}, one.columns)


_CLASS_STEPS = f"""p AS ({_PRED_SQL}),
cls AS (SELECT model, label AS c FROM p UNION SELECT model, prediction FROM p),
per AS (SELECT cls.model, c, COUNT(*) FILTER (label = c) AS support, COUNT(*) FILTER (prediction = c) AS predicted, COUNT(*) FILTER (label = c AND prediction = c) AS hits
        FROM cls JOIN p ON cls.model = p.model GROUP BY cls.model, c),
pr AS (SELECT *, COALESCE(hits / NULLIF(predicted, 0), 0)::DOUBLE AS pre, COALESCE(hits / NULLIF(support, 0), 0)::DOUBLE AS rec FROM per),
f AS (SELECT *, COALESCE(2 * pre * rec / NULLIF(pre + rec, 0), 0) AS f1 FROM pr),
m AS (SELECT model, SUM(hits) / SUM(support) AS accuracy, AVG(pre) AS precision_macro, AVG(rec) AS recall_macro, AVG(f1) AS f1_macro, SUM(support) AS support,
             SUM(pre * support) / SUM(support) AS precision_weighted, SUM(rec * support) / SUM(support) AS recall_weighted, SUM(f1 * support) / SUM(support) AS f1_weighted
      FROM f GROUP BY model)"""
_METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted"]
_METRICS_SQL = "model, " + ", ".join(f"ROUND({c}, 6)::DOUBLE AS {c}" for c in _METRICS)


@query("x1_classification_metrics", f"WITH {_CLASS_STEPS} SELECT {_METRICS_SQL} FROM m")
def _(t):
    out = metrics.classification_metrics(predictions(t), "label", "prediction", by=["model"])
    return out.select("model", *[r(c) for c in _METRICS])


@query(
    "x2_confusion_matrix",
    f"""SELECT label, COUNT(*) FILTER (prediction = 'A') AS "A", COUNT(*) FILTER (prediction = 'N') AS "N", COUNT(*) FILTER (prediction = 'R') AS "R",
               COUNT(*) FILTER (prediction = 'X') AS "X" FROM ({_PRED_SQL}) WHERE model = 'quantity' GROUP BY label""",
)
def _(t):
    one = predictions(t).where(F.col("model") == "quantity")
    return metrics.confusion_matrix(one, "label", "prediction", ["A", "N", "R", "X"])


@query(
    "x3_class_report",
    f"""WITH {_CLASS_STEPS} SELECT model, c AS class, ROUND(pre, 6) AS precision, ROUND(rec, 6) AS recall, ROUND(f1, 6) AS f1, support::BIGINT AS support FROM f
        UNION ALL SELECT model, 'macro avg', ROUND(precision_macro, 6), ROUND(recall_macro, 6), ROUND(f1_macro, 6), support::BIGINT FROM m
        UNION ALL SELECT model, 'weighted avg', ROUND(precision_weighted, 6), ROUND(recall_weighted, 6), ROUND(f1_weighted, 6), support::BIGINT FROM m""",
)
def _(t):
    out = metrics.classification_report(predictions(t), "label", "prediction", by=["model"])
    return out.select("model", "class", r("precision"), r("recall"), r("f1"), "support")


_AUC_STEPS = f"""s AS (SELECT model, c, score, label = c AS pos FROM (
        SELECT model, label, 'A' AS c, score_a AS score FROM ({_PRED_SQL}) UNION ALL SELECT model, label, 'N', score_n FROM ({_PRED_SQL})
        UNION ALL SELECT model, label, 'R', score_r FROM ({_PRED_SQL}))),
g AS (SELECT model, c, score, COUNT(*) FILTER (pos) AS p, COUNT(*) FILTER (NOT pos) AS q FROM s GROUP BY ALL),
w AS (SELECT *, SUM(q) OVER (PARTITION BY model, c ORDER BY score) - q AS below FROM g),
auc AS (SELECT model, c, SUM(p * (below + q / 2)) / (SUM(p) * SUM(q)) AS a, SUM(p) AS n FROM w GROUP BY model, c),
roc AS (SELECT model, ROUND(SUM(a * n) / SUM(n), 6)::DOUBLE AS roc_auc_ovr FROM auc GROUP BY model)"""
_SCORES = {"A": "score_a", "N": "score_n", "R": "score_r"}


@query("x4_roc_auc_ovr", f"WITH {_AUC_STEPS} SELECT * FROM roc")
def _(t):
    out = metrics.roc_auc_ovr(predictions(t), "label", _SCORES, by=["model"])
    return out.select("model", r("roc_auc_ovr"))


_REG_SQL = """SELECT 'quantity' AS model, l_extendedprice AS y, 1000 * l_quantity AS p FROM lineitem
UNION ALL SELECT 'discount', l_discount, l_tax FROM lineitem"""


def regression_predictions(t):
    one = t.lineitem.select(F.col("l_extendedprice").alias("y"), (1000 * F.col("l_quantity")).alias("p"))
    two = t.lineitem.select(F.col("l_discount").alias("y"), F.col("l_tax").alias("p"))
    return metrics.union_scored({"quantity": one, "discount": two}, ["y", "p"])


_REG_METRICS_SQL = f"""SELECT model, ROUND(1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)), 6) AS r2, ROUND(AVG((y - p) * (y - p)), 3) AS mse,
       ROUND(SQRT(AVG((y - p) * (y - p))), 5) AS rmse, ROUND(AVG(ABS(y - p)), 5) AS mae, ROUND(AVG(ABS((y - p) / y)) FILTER (y <> 0) * 100, 5) AS mape
FROM ({_REG_SQL}) GROUP BY model"""


def _reg_out(df):
    return df.select("model", r("r2"), r("mse", 3), r("rmse", 5), r("mae", 5), r("mape", 5))


@query("x5_x6_regression_metrics", _REG_METRICS_SQL)
def _(t):
    return _reg_out(metrics.regression_metrics(regression_predictions(t), "y", "p", by=["model"]))


@query(
    "x8_evaluate_classifiers",
    f"WITH {_CLASS_STEPS}, {_AUC_STEPS} SELECT {_METRICS_SQL.replace('model,', 'm.model AS model,')}, roc_auc_ovr FROM m JOIN roc ON m.model = roc.model",
)
def _(t):
    out = metrics.evaluate_classifiers(predictions(t), "label", "prediction", _SCORES)
    return out.select("model", *[r(c) for c in _METRICS], r("roc_auc_ovr"))


@query("x9_evaluate_regressors", _REG_METRICS_SQL)
def _(t):
    return _reg_out(metrics.evaluate_regressors(regression_predictions(t), "y", "p"))


# training summaries derived from the same rows: fold = line number parity, seconds from quantities
_TRAINING_SQL = f"""SELECT model, AVG(acc) AS cv_mean, STDDEV_POP(acc) AS cv_std, SUM(seconds) AS seconds, 'depth=' || COUNT(*) AS params
FROM (SELECT model, fold, AVG(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS acc, MAX(score_a) AS seconds
      FROM (SELECT *, CASE WHEN score_n < 0.05 THEN 0 ELSE 1 END AS fold FROM ({_PRED_SQL})) GROUP BY model, fold) GROUP BY model"""


def training(t):
    folded = predictions(t).withColumn("fold", F.when(F.col("score_n") < 0.05, 0).otherwise(1))
    hit = F.when(F.col("label") == F.col("prediction"), 1.0).otherwise(0.0)
    per = folded.groupBy("model", "fold").agg(F.avg(hit).alias("acc"), F.max("score_a").alias("seconds"))
    return per.groupBy("model").agg(
        F.avg("acc").alias("cv_mean"), F.stddev_pop("acc").alias("cv_std"), F.sum("seconds").alias("seconds"),
        F.concat(F.lit("depth="), F.count("*")).alias("params"),
    )


@query(
    "x10_classification_ranking",
    f"""WITH {_CLASS_STEPS}, tr AS ({_TRAINING_SQL})
        SELECT m.model AS model, PRINTF('%.4f±%.4f', cv_mean, cv_std) AS cv_score, PRINTF('%.4f', accuracy) AS test_accuracy, PRINTF('%.4f', f1_weighted) AS test_f1_weighted,
               PRINTF('%.4f', precision_weighted) AS test_precision_weighted, PRINTF('%.4f', recall_weighted) AS test_recall_weighted,
               PRINTF('%.2f', seconds) AS training_time_s, params AS best_params FROM m JOIN tr ON m.model = tr.model""",
)
def _(t):
    scored = metrics.evaluate_classifiers(predictions(t), "label", "prediction")
    return metrics.classification_ranking(training(t), scored)


@query(
    "x11_regression_ranking",
    f"""WITH e AS ({_REG_METRICS_SQL}), tr AS (SELECT model, AVG(y) AS cv_mean, STDDEV_POP(y) AS cv_std FROM ({_REG_SQL}) GROUP BY model)
        SELECT e.model AS model, r2, rmse, mae, mape, PRINTF('%.4f ± %.4f', cv_mean, cv_std) AS cv_r2 FROM e JOIN tr ON e.model = tr.model""",
)
def _(t):
    rows = regression_predictions(t)
    summary = rows.groupBy("model").agg(F.avg("y").alias("cv_mean"), F.stddev_pop("y").alias("cv_std"))
    out = metrics.regression_ranking(summary, metrics.evaluate_regressors(rows, "y", "p"))
    return out.select("model", r("r2"), r("rmse", 5), r("mae", 5), r("mape", 5), "cv_r2")


_EXPERIMENTS_SQL = """SELECT CASE WHEN o_orderstatus = 'F' THEN 'baseline' WHEN o_orderstatus = 'O' THEN 'kmeans' ELSE 'hierarchical' END AS experiment,
    COUNT(*) AS n_features, AVG(CASE WHEN o_orderpriority < '3' THEN 1.0 ELSE 0.0 END) AS accuracy, AVG(CASE WHEN o_orderpriority < '4' THEN 1.0 ELSE 0.0 END) AS f1,
    AVG(o_totalprice) / 1000000 AS cv_mean, STDDEV_SAMP(o_totalprice) / 1000000 AS cv_std, MAX(o_totalprice) / 1000 AS seconds
FROM orders GROUP BY o_orderstatus"""


def experiments(t):
    name = F.when(F.col("o_orderstatus") == "F", "baseline").when(F.col("o_orderstatus") == "O", "kmeans").otherwise("hierarchical")
    under = lambda p: F.avg(F.when(F.col("o_orderpriority") < p, 1.0).otherwise(0.0))
    return t.orders.groupBy(name.alias("experiment")).agg(
        F.count("*").alias("n_features"), under("3").alias("accuracy"), under("4").alias("f1"),
        (F.avg("o_totalprice") / 1000000).alias("cv_mean"), (F.stddev_samp("o_totalprice") / 1000000).alias("cv_std"),
        (F.max("o_totalprice") / 1000).alias("seconds"),
    )


@query(
    "x12_compare_experiments",
    f"""WITH e AS ({_EXPERIMENTS_SQL}), b AS (SELECT accuracy AS a0, f1 AS f0, seconds AS s0 FROM e WHERE experiment = 'baseline')
        SELECT UPPER(experiment) AS experiment, n_features, ROUND(accuracy, 6)::DOUBLE AS accuracy, ROUND(accuracy - a0, 6)::DOUBLE AS accuracy_improvement,
               ROUND(f1, 6)::DOUBLE AS f1, ROUND(f1 - f0, 6)::DOUBLE AS f1_improvement, PRINTF('%.4f ± %.4f', cv_mean, cv_std) AS cv_score,
               ROUND(seconds, 6) AS seconds, ROUND(seconds - s0, 6) AS time_diff FROM e, b""",
)
def _(t):
    out = metrics.compare_experiments(experiments(t))
    return out.select(
        "experiment", "n_features", r("accuracy"), r("accuracy_improvement"), r("f1"), r("f1_improvement"), "cv_score", r("seconds"), r("time_diff")
    )


@query(
    "x12_experiment_conclusion",
    f"""WITH e AS ({_EXPERIMENTS_SQL}) SELECT UPPER(ARG_MAX(experiment, accuracy)) AS best_experiment, ROUND(MAX(accuracy), 6)::DOUBLE AS best_accuracy,
               MAX(accuracy) > (SELECT accuracy FROM e WHERE experiment = 'baseline') AS clusters_help FROM e""",
)
def _(t):
    out = metrics.experiment_conclusion(metrics.compare_experiments(experiments(t)))
    return out.withColumn("best_accuracy", r("best_accuracy"))


_MODEL_TABLE_SQL = """SELECT n_name AS model, ROUND(0.9 + 0.1 * AVG(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS accuracy, COUNT(*) * 10.0::DOUBLE AS seconds
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


def model_table(t):
    joined = t.customer.select("c_nationkey", "c_acctbal").join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    positive = F.avg(F.when(F.col("c_acctbal") > 0, 1.0).otherwise(0.0))
    return joined.groupBy(F.col("n_name").alias("model")).agg(
        F.round(0.9 + 0.1 * positive, 6).alias("accuracy"), (F.count("*") * 10.0).alias("seconds")
    )


@query(
    "f20_tradeoff_zones",
    f"""SELECT *, CASE WHEN accuracy > 0.99 AND seconds < 300 THEN 'ideal' WHEN accuracy > 0.99 THEN 'acceptable' WHEN accuracy < 0.99 THEN 'problematic' END AS zone,
               CASE WHEN accuracy > 0.995 THEN 'excellent' WHEN accuracy > 0.99 THEN 'very good' WHEN accuracy > 0.95 THEN 'good' ELSE 'insufficient' END AS accuracy_band,
               CASE WHEN seconds < 60 THEN 'very fast' WHEN seconds < 300 THEN 'fast' WHEN seconds < 1800 THEN 'slow' ELSE 'very slow' END AS speed_band
        FROM ({_MODEL_TABLE_SQL})""",
)
def _(t):
    return metrics.with_tradeoff(model_table(t))


@query("w8_rank_models", f"SELECT *, ROW_NUMBER() OVER (ORDER BY accuracy DESC, model) AS position FROM ({_MODEL_TABLE_SQL})")
def _(t):
    return metrics.ranked(model_table(t), "accuracy", ["model"])


@query("o4_fastest_good", f"SELECT * FROM ({_MODEL_TABLE_SQL}) WHERE accuracy > 0.985 ORDER BY seconds, model LIMIT 1")
def _(t):
    return metrics.fastest_good_model(model_table(t), above=0.985)


@query("o5_best_model", f"SELECT * FROM ({_MODEL_TABLE_SQL}) ORDER BY accuracy DESC, model LIMIT 1")
def _(t):
    return metrics.best_model(model_table(t), "accuracy")


@query(
    "x14_tradeoff_summary",
    f"""WITH m AS ({_MODEL_TABLE_SQL}) SELECT model, accuracy, seconds, ROW_NUMBER() OVER (ORDER BY accuracy DESC, model) AS position,
               model = (SELECT model FROM m ORDER BY accuracy DESC, model LIMIT 1) AS is_best,
               COALESCE(model = (SELECT model FROM m WHERE accuracy > 0.99 ORDER BY seconds, model LIMIT 1), false) AS is_fastest_good FROM m""",
)
def _(t):
    return metrics.tradeoff_summary(model_table(t))


@query("f17_formatted_labels", f"SELECT model, PRINTF('%.4f±%.4f', accuracy, seconds / 1000) AS label FROM ({_MODEL_TABLE_SQL})")
def _(t):
    return model_table(t).select("model", sc.mean_plus_minus(F.col("accuracy"), F.col("seconds") / 1000).alias("label"))


# ------------------------------------------------------------------------------------------ cluster quality

_VEC_SQL = "SELECT vec_id, label AS cluster, embedding::DOUBLE[] AS v FROM embeddings"
_OTHER_SQL = "(CASE WHEN embedding[1] > 0 THEN 2 ELSE 0 END + CASE WHEN embedding[2] > 0 THEN 1 ELSE 0 END)"


def other_label():
    """A second labelling: signs of the first two coordinates."""
    return F.when(F.col("embedding")[0] > 0, 2).otherwise(0) + F.when(F.col("embedding")[1] > 0, 1).otherwise(0)


@query(
    "y1_silhouette",
    f"""WITH p AS ({_VEC_SQL}), n AS (SELECT cluster, COUNT(*) AS size FROM p GROUP BY cluster),
        d AS (SELECT a.vec_id, a.cluster AS own, b.cluster AS other, SUM(LIST_DISTANCE(a.v, b.v)) AS d FROM p a, p b GROUP BY ALL),
        e AS (SELECT vec_id, MAX(d / NULLIF(size - 1, 0)) FILTER (own = other) AS a, MIN(d / size) FILTER (own <> other) AS b FROM d JOIN n ON d.other = n.cluster GROUP BY vec_id)
        SELECT ROUND(AVG(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / GREATEST(a, b) END), 6) AS silhouette FROM e""",
)
def _(t):
    value = cluster_metrics.silhouette(t.embeddings, "embedding", "label", block_rows=128)
    return t.spark.createDataFrame([(round(value, 6),)], "silhouette double")


_CENTRES = f"""p AS ({_VEC_SQL}), x AS (SELECT vec_id, cluster, UNNEST(v) AS val, GENERATE_SUBSCRIPTS(v, 1) AS i FROM p),
c AS (SELECT cluster, i, AVG(val) AS m, COUNT(*) AS n FROM x GROUP BY cluster, i), o AS (SELECT i, AVG(val) AS m FROM x GROUP BY i),
dist AS (SELECT vec_id, x.cluster, SUM((val - m) * (val - m)) AS d2 FROM x JOIN c ON x.cluster = c.cluster AND x.i = c.i GROUP BY ALL),
s AS (SELECT cluster, AVG(SQRT(d2)) AS s, SUM(d2) AS w, COUNT(*) AS n FROM dist GROUP BY cluster),
g AS (SELECT a.cluster AS a, b.cluster AS b, SQRT(SUM((a.m - b.m) * (a.m - b.m))) AS gap FROM c a JOIN c b ON a.i = b.i AND a.cluster <> b.cluster GROUP BY ALL)"""


@query(
    "y2_y3_dispersion",
    f"""WITH {_CENTRES}, db AS (SELECT g.a, MAX((x.s + y.s) / gap) AS worst FROM g JOIN s x ON g.a = x.cluster JOIN s y ON g.b = y.cluster GROUP BY g.a),
        b AS (SELECT SUM(c.n * (c.m - o.m) * (c.m - o.m)) AS b FROM c JOIN o ON c.i = o.i)
        SELECT ROUND((SELECT AVG(worst) FROM db), 6) AS davies_bouldin,
               ROUND(((SELECT b FROM b) / (COUNT(*) - 1)) / (SUM(w) / (SUM(n) - COUNT(*))), 6)::DOUBLE AS calinski_harabasz FROM s""",
)
def _(t):
    davies, calinski = cluster_metrics.dispersion_scores(t.embeddings, "embedding", "label")
    return t.spark.createDataFrame([(round(davies, 6), round(calinski, 6))], "davies_bouldin double, calinski_harabasz double")


_AGREEMENT_STEPS = f"""l AS (SELECT label AS a, {_OTHER_SQL} AS b FROM embeddings), n AS (SELECT a, b, COUNT(*)::DOUBLE AS n FROM l GROUP BY ALL),
ra AS (SELECT a, COUNT(*)::DOUBLE AS n FROM l GROUP BY a), rb AS (SELECT b, COUNT(*)::DOUBLE AS n FROM l GROUP BY b), t AS (SELECT COUNT(*)::DOUBLE AS t FROM l),
v AS (SELECT (SELECT SUM(n * (n - 1) / 2) FROM n) AS ij, (SELECT SUM(n * (n - 1) / 2) FROM ra) AS i, (SELECT SUM(n * (n - 1) / 2) FROM rb) AS j,
             (SELECT SUM(n.n / t * LN(n.n * t / (ra.n * rb.n))) FROM n JOIN ra ON n.a = ra.a JOIN rb ON n.b = rb.b, t) AS mi,
             (SELECT -SUM(n / t * LN(n / t)) FROM ra, t) AS ha, (SELECT -SUM(n / t * LN(n / t)) FROM rb, t) AS hb, (SELECT t FROM t) AS t),
sc AS (SELECT ROUND((ij - i * j / (t * (t - 1) / 2)) / ((i + j) / 2 - i * j / (t * (t - 1) / 2)), 8) AS adjusted_rand_index,
              ROUND(mi / ((ha + hb) / 2), 8) AS normalized_mutual_info FROM v)"""


@query("y4_y5_agreement", f"WITH {_AGREEMENT_STEPS} SELECT * FROM sc")
def _(t):
    out = cluster_metrics.agreement(t.embeddings.withColumn("other", other_label()), "label", "other")
    return out.select(r("adjusted_rand_index", 8), r("normalized_mutual_info", 8))


@query(
    "q3_f19_compare_labelings",
    f"""WITH {_AGREEMENT_STEPS} SELECT *, CASE WHEN adjusted_rand_index > 0.7 AND normalized_mutual_info > 0.7 THEN 'strong'
        WHEN adjusted_rand_index > 0.4 AND normalized_mutual_info > 0.4 THEN 'moderate' ELSE 'low' END AS agreement FROM sc""",
)
def _(t):
    out = patterns.compare_labelings(t.embeddings.withColumn("other", other_label()), "label", "other")
    return out.select(r("adjusted_rand_index", 8), r("normalized_mutual_info", 8), "agreement")


@query("a12_contingency", f"SELECT label AS a, {_OTHER_SQL} AS b, COUNT(*) AS n FROM embeddings GROUP BY ALL")
def _(t):
    return cluster_metrics.contingency(t.embeddings.withColumn("other", other_label()), "label", "other")


# ------------------------------------------------------------------------------------------ patterns

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LONG = "l AS (" + " UNION ALL ".join(
    f"SELECT l_linenumber AS cluster, {i} AS position, '{c}' AS feature, {c} AS x FROM lineitem" for i, c in enumerate(_MEASURES)
) + ")"
_CONTRAST = f"""{_LONG}, tot AS (SELECT feature, COUNT(x) AS n, SUM(x) AS s, STDDEV_SAMP(x) AS sd FROM l GROUP BY feature),
cl AS (SELECT cluster, position, feature, COUNT(x) AS n, SUM(x) AS s FROM l GROUP BY ALL),
z AS (SELECT cluster, position, cl.feature, ROUND((cl.s / cl.n - (tot.s - cl.s) / (tot.n - cl.n)) / sd, 6) AS z FROM cl JOIN tot ON cl.feature = tot.feature WHERE sd > 0)"""


def line_clusters(t):
    return t.lineitem.select(F.col("l_linenumber").alias("cluster_id"), *_MEASURES)


@query(
    "a7_k8_cluster_profiles",
    f"WITH {_LONG} SELECT cluster, feature, ROUND(AVG(x), 4) AS mean, ROUND(STDDEV_SAMP(x), 4) AS std, COUNT(x) AS count FROM l GROUP BY cluster, feature",
)
def _(t):
    return patterns.cluster_profiles(line_clusters(t), "cluster_id")


_STATS_SQL = f"""WITH {_LONG} SELECT cluster, feature, ROUND(AVG(x), 5) AS mean, ROUND(QUANTILE_CONT(x, 0.5), 5) AS median, ROUND(STDDEV_SAMP(x), 5) AS std,
    MIN(x) AS min, MAX(x) AS max, COUNT(*) AS count FROM l GROUP BY cluster, feature"""


def _stats_out(df):
    return df.select("cluster", "feature", r("mean", 5), r("median", 5), r("std", 5), "min", "max", "count")


@query("a8_cluster_statistics", _STATS_SQL)
def _(t):
    return _stats_out(patterns.cluster_statistics(line_clusters(t), "cluster_id"))


@query("a8_cluster_statistics_by_selection", _STATS_SQL)
def _(t):
    """Medians per cluster through exact selection."""
    return _stats_out(patterns.cluster_statistics(line_clusters(t), "cluster_id"))


def _wide_vectors(t):
    return t.embeddings.select(F.col("label").alias("cluster_id"), *[F.col("embedding")[i].cast("double").alias(f"e{i:02d}") for i in range(64)])


_WIDE_LONG = """l AS (SELECT label AS cluster, i - 1 AS position, PRINTF('e%02d', i - 1) AS feature, x FROM
    (SELECT label, UNNEST(embedding)::DOUBLE AS x, GENERATE_SUBSCRIPTS(embedding, 1) AS i FROM embeddings))"""


@query(
    "a9_top_features",
    f"""WITH {_WIDE_LONG}, m AS (SELECT cluster, position, feature, AVG(x) AS mean FROM l GROUP BY ALL)
        SELECT cluster, rank, feature, ROUND(mean, 6) AS mean FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY mean DESC, position) AS rank FROM m) WHERE rank <= 5""",
)
def _(t):
    return patterns.top_features(_wide_vectors(t), "cluster_id").select("cluster", "rank", "feature", r("mean"))


_WIDE_CONTRAST = _CONTRAST.replace(_LONG, _WIDE_LONG)


@query(
    "a10_distinctive_features",
    f"WITH {_WIDE_CONTRAST} SELECT cluster, rank, feature, z FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY ABS(z) DESC, position) AS rank FROM z) WHERE rank <= 10",
)
def _(t):
    return patterns.distinctive_features(_wide_vectors(t), "cluster_id").select("cluster", "rank", "feature", r("z"))


@query("a11_contrast_matrix", f"WITH {_WIDE_CONTRAST} SELECT cluster, feature, z FROM z WHERE position < 20")
def _(t):
    return patterns.contrast_matrix(_wide_vectors(t), "cluster_id", width=20).select("cluster", "feature", r("z"))


@query("q5_cluster_distribution", "SELECT label, COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM embeddings), 6)::DOUBLE AS pct FROM embeddings GROUP BY label")
def _(t):
    return patterns.cluster_distribution(t.embeddings, "label").select("label", "n", r("pct"))


_CARD_ROWS = "SELECT l_linenumber AS cluster, l_quantity / 55 AS preparedness_score, l_tax AS mortality_rate, l_discount AS vaccination_rate, l_extendedprice AS healthcare_capacity_score FROM lineitem"


def card_rows(t):
    return t.lineitem.select(
        F.col("l_linenumber").alias("cluster_id"), (F.col("l_quantity") / 55).alias("preparedness_score"), F.col("l_tax").alias("mortality_rate"),
        F.col("l_discount").alias("vaccination_rate"), F.col("l_extendedprice").alias("healthcare_capacity_score"),
    )


@query(
    "q2_profile_cards",
    f"""WITH c AS ({_CARD_ROWS}) SELECT cluster, COUNT(*) AS size, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM c), 6)::DOUBLE AS percentage, 4 AS n_measures,
               ROUND(AVG(preparedness_score), 6) AS preparedness_mean, ROUND(QUANTILE_CONT(preparedness_score, 0.5), 6) AS preparedness_median,
               ROUND(STDDEV_SAMP(preparedness_score), 6) AS preparedness_std, 4 AS n_distinctive FROM c GROUP BY cluster""",
)
def _(t):
    cards = patterns.profile_cards(card_rows(t), "cluster_id")
    first = F.filter("key_measures", lambda m: m["feature"] == "preparedness_score")[0]
    return cards.select(
        "cluster", "size", r("percentage"), F.size("key_measures").alias("n_measures"), F.round(first["mean"], 6).alias("preparedness_mean"),
        F.round(first["median"], 6).alias("preparedness_median"), F.round(first["std"], 6).alias("preparedness_std"), F.size("distinctive").alias("n_distinctive"),
    )


_LABELS_SQL = f"""WITH m AS (SELECT cluster, COUNT(*) AS size, AVG(preparedness_score) AS p, AVG(mortality_rate) AS d, AVG(vaccination_rate) * 100 AS v FROM ({_CARD_ROWS}) GROUP BY cluster)
SELECT cluster, size, ROUND(p, 6) AS preparedness_score, CASE WHEN p > 0.7 THEN 'high preparedness' WHEN p > 0.4 THEN 'moderate preparedness' ELSE 'limited preparedness' END AS name,
       CASE WHEN p > 0.7 THEN PRINTF('vaccination %.1f%%, low mortality %.3f, robust health systems', v, d)
            WHEN p > 0.4 THEN PRINTF('vaccination %.1f%%, controlled mortality %.3f', v, d) ELSE PRINTF('needs health infrastructure, vaccination %.1f%%', v) END AS description FROM m"""


@query("f18_semantic_labels", _LABELS_SQL)
def _(t):
    out = patterns.semantic_labels(patterns.profile_cards(card_rows(t), "cluster_id"))
    return out.select("cluster", "size", r("preparedness_score"), "name", "description")


@query(
    "q4_normalized_profiles",
    f"""WITH c AS ({_CARD_ROWS}), m AS (SELECT cluster, AVG(preparedness_score) AS a, AVG(mortality_rate) AS b, AVG(vaccination_rate) AS d, AVG(healthcare_capacity_score) AS e FROM c GROUP BY cluster),
        l AS (SELECT cluster, 'preparedness_score' AS feature, a AS mean FROM m UNION ALL SELECT cluster, 'mortality_rate', b FROM m UNION ALL SELECT cluster, 'vaccination_rate', d FROM m
              UNION ALL SELECT cluster, 'healthcare_capacity_score', e FROM m)
        SELECT cluster, feature, ROUND(mean, 5) AS mean, ROUND((mean - AVG(mean) OVER w) / STDDEV_POP(mean) OVER w, 6) AS z FROM l WINDOW w AS (PARTITION BY cluster)""",
)
def _(t):
    return patterns.normalized_profiles(card_rows(t), "cluster_id").select("cluster", "feature", r("mean", 5), r("z"))


@query("q1_pattern_analysis", _LABELS_SQL)
def _(t):
    """The label table of the full analysis of two labellings."""
    rows = card_rows(t).withColumnsRenamed({"cluster_id": "kmeans_cluster"})
    found = patterns.analyze_patterns(rows.withColumn("hierarchical_cluster", (F.col("kmeans_cluster") > 3).cast("int")))
    return found["kmeans_cluster.labels"].select("cluster", "size", r("preparedness_score"), "name", "description")


@query(
    "k7_compare_algorithms",
    f"""WITH {_CENTRES}, b AS (SELECT SUM(c.n * (c.m - o.m) * (c.m - o.m)) AS b FROM c JOIN o ON c.i = o.i)
        SELECT 'labels' AS algorithm, ROUND(((SELECT b FROM b) / (COUNT(*) - 1)) / (SUM(w) / (SUM(n) - COUNT(*))), 6)::DOUBLE AS calinski_harabasz, 1 AS position FROM s""",
)
def _(t):
    from panelcraft.operators.clustering import compare_algorithms

    found = cluster_metrics.clustering_metrics(t.embeddings, "embedding", "label")
    out = compare_algorithms(t.spark, {"labels": found})
    return out.select("algorithm", r("calinski_harabasz"), "position")
