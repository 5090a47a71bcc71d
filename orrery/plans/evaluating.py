"""Evaluation and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import evaluate as V
from orrery.operators.importance import topk_features as top_features
from orrery.operators.models import balanced_weight, class_weights as weights, decide
from orrery.operators.profile import correlation_matrix
from orrery.plans.registry import Tables, query, rounded


def _predictions(t: Tables):
    """Line prices against a price per unit of the part."""
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("p"),
    )


PREDICTIONS = """(SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y, l_quantity * p_retailprice AS p
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(
    f"""SELECT round(avg(pow(y - p, 2)), 1) AS mse, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
    round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(y)), 8) AS r2 FROM {PREDICTIONS} t"""
)
def regression_metrics(spark, sf):
    out = V.regression_metrics(_predictions(Tables(spark, sf)), "y", "p")
    return rounded(rounded(rounded(out, 8, "r2"), 4, "rmse", "mae"), 1, "mse")


@query(
    """SELECT round(avg(abs((l_tax - l_discount) / CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END)) * 100, 6) AS mape,
    count(*) FILTER (l_tax = 0) AS zero_labels FROM lineitem"""
)
def mape(spark, sf):
    return rounded(V.mape(Tables(spark, sf).lineitem, "l_tax", "l_discount"), 6, "mape")


def _classes(t: Tables):
    """Order status, with a guess from the price."""
    guess = F.when(F.col("o_totalprice") > 300000, "F").when(F.col("o_totalprice") > 100000, "O").otherwise("P")
    return t.orders.select("o_orderkey", F.col("o_orderstatus").alias("y"), guess.alias("p"))


CLASSES = """(SELECT o_orderkey, o_orderstatus AS y,
    CASE WHEN o_totalprice > 300000 THEN 'F' WHEN o_totalprice > 100000 THEN 'O' ELSE 'P' END AS p FROM orders)"""


@query(
    f"""SELECT a.y AS label, b.p AS prediction, count(t.y) AS n FROM (SELECT DISTINCT y FROM {CLASSES} x) a
    CROSS JOIN (SELECT DISTINCT y AS p FROM {CLASSES} x) b LEFT JOIN {CLASSES} t ON t.y = a.y AND t.p = b.p GROUP BY 1, 2"""
)
def confusion_matrix(spark, sf):
    return V.confusion_matrix(_classes(Tables(spark, sf)), "y", "p")


@query(
    f"""WITH c AS (SELECT k.c AS "class", count(*) FILTER (y = k.c AND p = k.c) AS hits, count(*) FILTER (y = k.c) AS support,
    count(*) FILTER (p = k.c) AS predicted FROM {CLASSES} t, (SELECT DISTINCT y AS c FROM {CLASSES} x) k GROUP BY 1),
    m AS (SELECT "class", hits, support, hits / predicted::DOUBLE AS p, hits / support::DOUBLE AS r, 2 * hits / (support + predicted)::DOUBLE AS f FROM c)
    SELECT "class", round(p, 8) AS precision, round(r, 8) AS recall, round(f, 8) AS f1_score, support FROM m
    UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 8), round(sum(hits) / sum(support), 8), round(sum(hits) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM m
    UNION ALL SELECT 'macro avg', round(avg(p), 8), round(avg(r), 8), round(avg(f), 8), CAST(sum(support) AS BIGINT) FROM m
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 8), round(sum(r * support) / sum(support), 8), round(sum(f * support) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM m"""
)
def classification_report(spark, sf):
    out = V.classification_report(_classes(Tables(spark, sf)), "y", "p")
    return rounded(out, 8, "precision", "recall", "f1_score")


def scored(t: Tables):
    """Events with their value as score; purchases and signups are positive."""
    return t.events.select(
        "event_id", F.col("event_type").isin("purchase", "signup").cast("int").alias("y"), F.col("value").alias("score")
    )


SCORED = "(SELECT event_id, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y, value AS score FROM events)"

CURVE = f"""g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM {SCORED} e GROUP BY 1),
    c AS (SELECT score AS threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn
          FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    f"""SELECT round((tp + tn) / n::DOUBLE, 8) AS accuracy, round(tp / (tp + fp)::DOUBLE, 8) AS precision,
    round(tp / (tp + fn)::DOUBLE, 8) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 8) AS f1_score FROM
    (SELECT count(*) FILTER (y = 1 AND score >= 30) AS tp, count(*) FILTER (y = 0 AND score >= 30) AS fp,
     count(*) FILTER (y = 1 AND score < 30) AS fn, count(*) FILTER (y = 0 AND score < 30) AS tn, count(*) AS n FROM {SCORED} t) s"""
)
def binary_metrics(spark, sf):
    rows = V.apply_threshold(scored(Tables(spark, sf)), "score", 30.0)
    return rounded(V.binary_metrics(rows, "y", "prediction"), 8, "accuracy", "precision", "recall", "f1_score")


@query(
    f"""WITH {CURVE} SELECT threshold, round(fp / nn::DOUBLE, 8) AS fpr, round(tp / np::DOUBLE, 8) AS tpr FROM c
    UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0"""
)
def roc_curve(spark, sf):
    return rounded(V.roc_curve(scored(Tables(spark, sf)), "y", "score"), 8, "fpr", "tpr")


@query(
    f"""WITH {CURVE}, l AS (SELECT *, row_number() OVER w AS i, lead(pos) OVER w AS p, lead(neg) OVER w AS n FROM c WINDOW w AS (ORDER BY threshold DESC))
    SELECT threshold, round(fp / nn::DOUBLE, 8) AS fpr, round(tp / np::DOUBLE, 8) AS tpr FROM l WHERE i = 1 OR p IS NULL OR p <> pos OR n <> neg
    UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0"""
)
def roc_curve_corners(spark, sf):
    out = V.roc_curve(scored(Tables(spark, sf)), "y", "score", corners_only=True)
    return rounded(out, 8, "fpr", "tpr")


@query(
    f"""WITH {CURVE}, l AS (SELECT fp / nn::DOUBLE AS x, tp / np::DOUBLE AS y, threshold FROM c UNION ALL SELECT 0, 0, 'Infinity'::DOUBLE)
    SELECT round(sum((x - px) * (y + py) / 2), 8) AS roc_auc FROM
    (SELECT x, y, lag(x) OVER (ORDER BY threshold DESC) AS px, lag(y) OVER (ORDER BY threshold DESC) AS py FROM l) t"""
)
def roc_auc(spark, sf):
    return rounded(V.roc_auc(scored(Tables(spark, sf)), "y", "score"), 8, "roc_auc")


@query(
    f"""WITH {CURVE} SELECT threshold, round(tp / (tp + fp)::DOUBLE, 8) AS precision, round(tp / np::DOUBLE, 8) AS recall FROM c
    UNION ALL SELECT NULL, 1.0, 0.0"""
)
def pr_curve(spark, sf):
    return rounded(V.pr_curve(scored(Tables(spark, sf)), "y", "score"), 8, "precision", "recall")


@query(
    f"""WITH {CURVE}, l AS (SELECT threshold, tp / (tp + fp)::DOUBLE AS p, tp / np::DOUBLE AS r FROM c)
    SELECT round(sum((r - pr) * p), 8) AS average_precision FROM
    (SELECT p, r, coalesce(lag(r) OVER (ORDER BY threshold DESC), 0) AS pr FROM l) t"""
)
def average_precision(spark, sf):
    return rounded(V.average_precision(scored(Tables(spark, sf)), "y", "score"), 8, "average_precision")


@query(
    f"""WITH {CURVE}, l AS (SELECT threshold, tp / (tp + fp)::DOUBLE AS p, tp / np::DOUBLE AS r FROM c),
    f AS (SELECT threshold, 2 * (p * r) / (p + r + 1e-6) AS v FROM l)
    SELECT threshold, round(v, 8) AS value FROM f ORDER BY v DESC, threshold LIMIT 1"""
)
def threshold_f1(spark, sf):
    return rounded(V.best_threshold(scored(Tables(spark, sf)), "y", "score", "f1"), 8, "value")


@query(
    f"""WITH {CURVE}, j AS (SELECT threshold, tp / np::DOUBLE - fp / nn::DOUBLE AS v FROM c UNION ALL SELECT 'Infinity'::DOUBLE, 0.0)
    SELECT threshold, round(v, 8) AS value FROM j ORDER BY v DESC, threshold DESC LIMIT 1"""
)
def threshold_youden(spark, sf):
    return rounded(V.best_threshold(scored(Tables(spark, sf)), "y", "score", "youden"), 8, "value")


@query(
    f"""WITH r AS (SELECT event_id % 5 AS fold, y, score, CAST(score >= 30 AS INTEGER) AS p FROM {SCORED} t),
    b AS (SELECT fold, avg(CAST(y = p AS INTEGER)) AS accuracy, sum(y * p) / sum(p) AS precision, sum(y * p) / sum(y) AS recall,
    2 * sum(y * p) / (sum(p) + sum(y)) AS f1_score FROM r GROUP BY 1),
    g AS (SELECT fold, score, sum(y) AS pos, sum(1 - y) AS neg FROM r GROUP BY 1, 2),
    c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (PARTITION BY fold ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
    a AS (SELECT fold, sum(neg * (tp - pos / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS roc_auc, sum(pos * tp / (tp + fp)::DOUBLE) / sum(pos) AS average_precision FROM c GROUP BY 1)
    SELECT fold, round(accuracy, 8) AS accuracy, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1_score, 8) AS f1_score,
    round(roc_auc, 8) AS roc_auc, round(average_precision, 8) AS average_precision FROM b JOIN a USING (fold)"""
)
def cv_fold_metrics(spark, sf):
    """Classification metrics of every fold."""
    rows = scored(Tables(spark, sf)).withColumn("fold", F.col("event_id") % 5)
    out = V.binary_metrics_by(V.apply_threshold(rows, "score", 30.0), "fold", "y", "prediction", "score")
    return rounded(out, 8, "accuracy", "precision", "recall", "f1_score", "roc_auc", "average_precision")


@query(f"SELECT event_id, CAST(score >= 30 AS INTEGER) AS prediction FROM {SCORED} t")
def apply_threshold(spark, sf):
    return V.apply_threshold(scored(Tables(spark, sf)), "score", 30.0).select("event_id", "prediction")


COMPARED = {"by_part": "p", "by_quantity": "q", "flat": "c"}


def _compare_sql(name: str, col: str) -> str:
    return f"""SELECT '{name}' AS model, avg(pow(y - {col}, 2)) AS mse, sqrt(avg(pow(y - {col}, 2))) AS rmse, avg(abs(y - {col})) AS mae,
    1 - sum(pow(y - {col}, 2)) / (var_pop(y) * count(y)) AS r2 FROM r"""


@query(
    f"""WITH r AS (SELECT l_extendedprice AS y, l_quantity * p_retailprice AS p, l_quantity * 1500 AS q, 38000 AS c
    FROM lineitem JOIN part ON l_partkey = p_partkey),
    m AS ({' UNION ALL '.join(_compare_sql(n, c) for n, c in COMPARED.items())})
    SELECT model, round(mse, 1) AS mse, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2, r2 = max(r2) OVER () AS best FROM m"""
)
def model_comparison(spark, sf):
    t = Tables(spark, sf)
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("p"),
        (F.col("l_quantity") * 1500).alias("q"),
        F.lit(38000.0).alias("c"),
    )
    return rounded(V.model_comparison({name: V.regression_metrics(rows, "y", c) for name, c in COMPARED.items()}), 1, "mse")


@query(
    f"""SELECT l_orderkey, l_partkey, l_linenumber, y AS actual, round(p, 6) AS predicted, min(y) OVER () AS line_from, max(y) OVER () AS line_to
    FROM {PREDICTIONS} t"""
)
def pred_vs_actual(spark, sf):
    rows = _predictions(Tables(spark, sf)).withColumn("k", F.struct("l_orderkey", "l_partkey", "l_linenumber"))
    out = V.pred_vs_actual(rows, "k", "y", "p").withColumn("predicted", F.round("predicted", 6))
    return out.select("k.*", "actual", "predicted", "line_from", "line_to")


@query(
    """SELECT pos AS positive, neg AS negative, n AS total, round(pos / n::DOUBLE, 9) AS positive_ratio, round(neg / n::DOUBLE, 9) AS negative_ratio,
    round(neg / pos::DOUBLE, 9) AS imbalance_ratio, round(pos / neg::DOUBLE, 9) AS scale_pos_weight FROM
    (SELECT count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg, count(*) AS n FROM labels) t"""
)
def class_weights(spark, sf):
    out = weights(Tables(spark, sf).labels, "quality")
    return rounded(out, 9, "positive_ratio", "negative_ratio", "imbalance_ratio", "scale_pos_weight")


@query(
    """SELECT l_orderkey, l_linenumber, l_suppkey, round((SELECT count(*) FROM lineitem) /
    ((SELECT count(DISTINCT l_suppkey) FROM lineitem) * count(*) OVER (PARTITION BY l_suppkey))::DOUBLE, 9) AS weight FROM lineitem"""
)
def balanced_weight_many(spark, sf):
    """A class per supplier."""
    rows = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return rounded(balanced_weight(rows, "l_suppkey"), 9, "weight")


TARGET = "l_extendedprice"
CANDIDATES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


@query(
    f"""SELECT feature, round(v, 8) AS importance FROM ({' UNION ALL '.join(
        f"SELECT '{c}' AS feature, abs(corr({c}, {TARGET})) AS v FROM lineitem" for c in CANDIDATES)}) t
    ORDER BY v DESC, feature LIMIT 3"""
)
def topk_features(spark, sf):
    """The three columns most correlated with the price."""
    corr = correlation_matrix(Tables(spark, sf).lineitem, [*CANDIDATES, TARGET])
    table = corr.where((F.col("a") != TARGET) & (F.col("b") == TARGET)).select(
        F.col("a").alias("feature"), F.abs("corr").alias("importance")
    )
    return rounded(top_features(table, 3), 8, "importance")


@query(
    """SELECT event_id, round(p, 9) AS approval_probability, CASE WHEN p >= 0.5 THEN 'Approved' ELSE 'Rejected' END AS prediction,
    round(greatest(p, 1 - p) * 100, 6) AS confidence FROM (SELECT event_id, 1 / (1 + exp(-(0.05 * value - 1.0))) AS p FROM events) t"""
)
def batch_scoring(spark, sf):
    """Decisions from a logistic score of each event."""
    p = 1 / (1 + F.exp(-(0.05 * F.col("value") - 1.0)))
    out = decide(Tables(spark, sf).events.select("event_id", p.alias("p")), "p").drop("p")
    return rounded(rounded(out, 9, "approval_probability"), 6, "confidence")
