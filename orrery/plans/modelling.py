"""Model queries. Trees and searches have no SQL form; their rows are checked, and the tests
check them against known answers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from orrery.operators import encode as E, importance as I, models as M, split as X
from orrery.operators.evaluate import binary_metrics, regression_metrics, summarize_folds
from orrery.plans.registry import Tables, query, rounded
from orrery.sources.bundles import load_bundle, save_bundle
from orrery.sources.storage import work_folder, written
from orrery.sources.tables import append_metrics

# ---- linear models on one feature, where the solution has a closed form

ALPHA_RIDGE, ALPHA_L1 = 1000.0, 2000.0


def _price(t: Tables) -> DataFrame:
    """Price by quantity, as a feature vector of length one."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("label"), F.col("l_quantity").alias("x")
    )
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)


_SUMS = """(SELECT covar_pop(l_extendedprice, l_quantity) AS cxy, var_pop(l_quantity) AS vx, avg(l_quantity) AS mx,
    avg(l_extendedprice) AS my, count(*) AS n FROM lineitem) s"""


def _line_sql(slope: str) -> str:
    return f"SELECT round(w, 3) AS slope, round(my - w * mx, 2) AS intercept FROM (SELECT *, {slope} AS w FROM {_SUMS}) t"


def _line(spark, model) -> DataFrame:
    return spark.range(1).select(
        F.round(F.lit(float(model.coefficients[0])), 3).alias("slope"),
        F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
    )


@query(_line_sql("cxy / vx"))
def linreg_ols(spark, sf):
    return _line(spark, M.fit_linear(_price(Tables(spark, sf)), kind="ols"))


@query(_line_sql(f"sign(cxy) * greatest(abs(cxy) - {ALPHA_L1}, 0) / vx"))
def linreg_lasso(spark, sf):
    return _line(spark, M.fit_linear(_price(Tables(spark, sf)), kind="lasso", alpha=ALPHA_L1))


@query(_line_sql(f"n * cxy / (n * vx + {ALPHA_RIDGE})"))
def linreg_ridge(spark, sf):
    return _line(spark, M.fit_linear(_price(Tables(spark, sf)), kind="ridge", alpha=ALPHA_RIDGE))


@query(_line_sql(f"sign(cxy) * greatest(abs(cxy) - {ALPHA_L1} * 0.9, 0) / (vx + {ALPHA_L1} * 0.1)"))
def linreg_elasticnet(spark, sf):
    model = M.fit_linear(_price(Tables(spark, sf)), kind="elasticnet", alpha=ALPHA_L1, l1_ratio=0.9)
    return _line(spark, model)


# ---- classifiers on labelled documents

NUMERIC = ["n_chars", "n_lines", "digit_share", "mean_word"]
CATEGORICAL = ["lang"]


def labelled_documents(t: Tables) -> DataFrame:
    """Labelled documents with measures of their whole text."""
    text = F.col("text")
    words = F.greatest(F.size(F.split(text, " ")), F.lit(1))
    measured = t.documents.select(
        "doc_id",
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.length(text), F.lit(1))).alias("digit_share"),
        (F.length(text) / words).alias("mean_word"),
    )
    labels = t.labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    return measured.join(labels, "doc_id")


def _prepared(spark, sf) -> tuple[DataFrame, PipelineModel, list[str]]:
    """Assembled features, written once because every fit reads them many times."""
    rows = written(labelled_documents(Tables(spark, sf)), "labelled")
    model = E.column_transformer(rows, NUMERIC, CATEGORICAL)
    return written(model.transform(rows), "prepared"), model, E.output_names(model, NUMERIC, CATEGORICAL)


def _scores(scored: DataFrame) -> DataFrame:
    out = M.positive_probability(scored)
    return out.select("doc_id", F.round("score", 6).alias("score"), F.col("prediction").cast("int").alias("prediction"))


@query()
def logistic(spark, sf):
    rows, _, _ = _prepared(spark, sf)
    return _scores(M.fit_logistic(rows).transform(rows))


@query()
def forest_regressor(spark, sf):
    """Prices by forest, from quantity and the price of the part."""
    t = Tables(spark, sf)
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_partkey", "l_linenumber", F.col("l_extendedprice").alias("label"),
        "l_quantity", "l_discount", "p_retailprice",
    )
    rows = written(rows, "prices")
    rows = VectorAssembler(
        inputCols=["l_quantity", "l_discount", "p_retailprice"], outputCol="features"
    ).transform(rows)
    fitted = M.forest_regressor(trees=20, depth=6).fit(rows)
    return fitted.transform(rows).select(
        "l_orderkey", "l_partkey", "l_linenumber", F.round("prediction", 4).alias("prediction")
    )


@query()
def forest_classifier(spark, sf):
    rows, _, _ = _prepared(spark, sf)
    weighted = M.balanced_weight(rows, "label")
    return _scores(M.forest_classifier(weight="weight").fit(weighted).transform(weighted))


@query()
def gbt_classifier(spark, sf):
    rows, _, _ = _prepared(spark, sf)
    weighted = M.positive_weight(rows, "label")
    return _scores(M.boosted_classifier(rounds=10, depth=3, weight="weight").fit(weighted).transform(weighted))


@query()
def early_stopping(spark, sf):
    """Rounds kept by ten rounds of patience on the precision-recall area of the validation rows, and the metrics of the
    refitted model."""
    rows, _, _ = _prepared(spark, sf)
    marked = written(X.exact_split(rows, "doc_id", by="label", out="is_validation"), "marked")
    model, rounds = M.early_stopping(marked, M.boosted_classifier(depth=3), "is_validation", 10, "areaUnderPR")
    metrics = binary_metrics(model.transform(marked), "label", "prediction")
    return metrics.withColumn("rounds", F.lit(rounds))


@query(
    """WITH c AS (SELECT o_orderpriority, year(o_orderdate) * 12 + month(o_orderdate) AS round, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2),
    n AS (SELECT *, max(v) OVER (PARTITION BY o_orderpriority ORDER BY round ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS lately,
      max(v) OVER (PARTITION BY o_orderpriority ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 6 PRECEDING) AS earlier FROM c),
    e AS (SELECT o_orderpriority, coalesce(min(round) FILTER (lately <= earlier), max(round)) AS last_round FROM n GROUP BY 1),
    b AS (SELECT o_orderpriority, last_round, max(v) AS top FROM c JOIN e USING (o_orderpriority) WHERE round <= last_round GROUP BY 1, 2)
    SELECT o_orderpriority, CAST(min(round) AS INTEGER) AS best_round, round(any_value(top), 4) AS best_value,
    CAST(any_value(last_round) AS INTEGER) AS last_round FROM c JOIN b USING (o_orderpriority) WHERE v = top GROUP BY 1"""
)
def early_stopping_rule(spark, sf):
    """The stop on curves given by the tables: monthly mean order values per priority, with six rounds of patience."""
    orders = Tables(spark, sf).orders
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    curve = orders.groupBy("o_orderpriority", month.alias("round")).agg(F.avg("o_totalprice").alias("value"))
    return rounded(M.stopped_round(curve, 6, True, ["o_orderpriority"]), 4, "best_value")


RIDGE = 50.0


def _cv_sql() -> str:
    """Ridge with three features by the rule of Cramer, on the training rows of each fold."""
    xs = ["l_quantity", "l_discount", "l_tax"]
    prod = [f"count(*) * covar_pop({a}, {b}) + {RIDGE if a == b else 0} AS s{i}{j}" for i, a in enumerate(xs) for j, b in enumerate(xs)]
    prod += [f"count(*) * covar_pop({a}, l_extendedprice) AS t{i}" for i, a in enumerate(xs)]
    prod += [f"avg({a}) AS m{i}" for i, a in enumerate(xs)]

    def det(replaced: int | None) -> str:
        m = [[f"t{i}" if j == replaced else f"s{i}{j}" for j in range(3)] for i in range(3)]
        return (
            f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
            f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))"
        )

    slopes = ", ".join(f"{det(i)} / {det(None)} AS w{i}" for i in range(3))
    guess = " + ".join(f"w{i} * ({a} - m{i})" for i, a in enumerate(xs))
    return f"""WITH r AS (SELECT l_orderkey % 5 AS fold, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
      {", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in xs)} FROM lineitem),
    g AS (SELECT f.fold, avg(l_extendedprice) AS my, {", ".join(prod)} FROM (SELECT DISTINCT fold FROM r) f JOIN r ON r.fold <> f.fold GROUP BY 1),
    w AS (SELECT *, {slopes} FROM g),
    p AS (SELECT r.fold, l_extendedprice AS y, my + {guess} AS p FROM r JOIN w ON r.fold = w.fold),
    m AS (SELECT fold, sqrt(avg(pow(y - p, 2))) AS rmse, avg(abs(y - p)) AS mae, 1 - sum(pow(y - p, 2)) / (var_pop(y) * count(y)) AS r2 FROM p GROUP BY 1),
    l AS (SELECT 'rmse' AS metric, rmse AS v FROM m UNION ALL SELECT 'mae', mae FROM m UNION ALL SELECT 'r2', r2 FROM m)
    SELECT metric, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std, count(*) AS folds FROM l GROUP BY 1"""


@query(_cv_sql())
def cross_validate_linear(spark, sf):
    """Five folds of a ridge regression on three features, fitted from the cross-products of each fold."""
    rows = Tables(spark, sf).lineitem.withColumn("fold", F.col("l_orderkey") % 5)
    scores = M.cross_validate_linear(rows, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "fold", RIDGE)
    return rounded(summarize_folds(scores, ["rmse", "mae", "r2"]), 4, "mean", "std")


@query()
def isotonic_calibration(spark, sf):
    """Calibrated on the validation rows, applied to all."""
    rows, _, _ = _prepared(spark, sf)
    marked = written(X.exact_split(rows, "doc_id", by="label", out="is_validation"), "marked")
    fitted = M.fit_logistic(marked.where("NOT is_validation"))
    scored = M.positive_probability(fitted.transform(marked))
    curve = M.isotonic_calibration(scored.where("is_validation"), "label", "score")
    out = M.apply_calibration(scored, curve, "score")
    return out.select("doc_id", F.round("score", 6).alias("score"), F.round("calibrated", 6).alias("calibrated"))


@query()
def grid_search(spark, sf):
    """Strength and kind of penalty of a logistic model, the whole grid over five shuffled folds."""
    rows, _, _ = _prepared(spark, sf)
    folds = X.kfold_stratified(rows, "label", "doc_id", k=5, seed=42)
    lr = LogisticRegression(standardization=False, maxIter=200)
    maps = M.logistic_maps(lr, rows.count())
    return rounded(M.search_results(spark, M.search(folds, lr, maps, "fold")), 6, "score")


@query()
def random_search(spark, sf):
    """Three draws from a forest space over three folds."""
    rows, _, _ = _prepared(spark, sf)
    folds = X.kfold_stratified(rows, "label", "doc_id", k=3)
    space = {"numTrees": [5, 10, 20], "maxDepth": [3, 5], "minInstancesPerNode": [1, 2, 5]}
    found = M.random_search(folds, M.forest_classifier(), space, 3, "fold")
    return rounded(M.search_results(spark, found), 6, "score")


@query()
def importance_trees(spark, sf):
    rows, _, names = _prepared(spark, sf)
    return I.importance_trees(spark, M.forest_classifier().fit(rows), names)


@query()
def importance_weight(spark, sf):
    rows, _, names = _prepared(spark, sf)
    return I.importance_weight(spark, M.boosted_classifier(rounds=5, depth=3).fit(rows), names)


@query(
    """WITH n AS (SELECT count(*) AS rows FROM labels JOIN documents USING (doc_id))
    SELECT unnest(range(9)) AS slot, 0.0::DOUBLE AS gradient, rows FROM n"""
)
def logistic_gradient(spark, sf):
    """Without a penalty the gradient of the mean loss is zero at the optimum, for each feature and the intercept."""
    rows, _, _ = _prepared(spark, sf)
    fitted = M.fit_logistic(rows, C=1e12).transform(rows)
    error = M.positive_probability(fitted).withColumn("error", F.col("score") - F.col("label"))
    terms = F.concat(F.transform(vector_to_array("features"), lambda x: x * F.col("error")), F.array("error"))
    cells = error.select(F.posexplode(terms).alias("slot", "term"))
    mean = cells.groupBy(F.col("slot").cast("bigint").alias("slot")).agg(
        F.avg("term").alias("gradient"), F.count(F.lit(1)).alias("rows")
    )
    return mean.withColumn("gradient", F.abs(F.round("gradient", 6)))


@query(
    """WITH g AS (SELECT n_chars::DOUBLE AS x, avg(quality) AS y, count(*) AS w FROM labels JOIN documents USING (doc_id) GROUP BY 1),
    s AS (SELECT row_number() OVER (ORDER BY x) AS i, x, sum(y * w) OVER (ORDER BY x) AS yw, sum(w) OVER (ORDER BY x) AS ws, y * w AS y0, w AS w0 FROM g),
    m AS (SELECT a.i AS a, b.i AS b, min((b.yw - a.yw + a.y0) / (b.ws - a.ws + a.w0)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS low FROM s a JOIN s b ON b.i >= a.i),
    c AS (SELECT b AS i, max(low) AS calibrated FROM m GROUP BY 1)
    SELECT x AS score, round(calibrated, 6) AS calibrated FROM c JOIN s USING (i)"""
)
def isotonic_minmax(spark, sf):
    """Quality by text length: each step is the largest of the smallest means over ranges around it."""
    t = Tables(spark, sf)
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").cast("double").alias("label"), F.col("n_chars").cast("double").alias("score")
    )
    rows = written(rows, "lengths")
    out = M.apply_calibration(rows, M.isotonic_calibration(rows, "label", "score"), "score")
    return out.select("score", F.round("calibrated", 6).alias("calibrated")).distinct()


@query(
    """WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
    SELECT 1 AS component, round((1 + r) / 2, 6) AS share FROM r UNION ALL SELECT 2, round((1 - r) / 2, 6) FROM r"""
)
def pca_two(spark, sf):
    """Two scaled columns: the shares follow from their correlation."""
    scaled = E.standard_scale(Tables(spark, sf).lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    vectors = VectorAssembler(inputCols=scaled.columns, outputCol="features").transform(scaled)
    fitted = PCA(k=2, inputCol="features", outputCol="parts").fit(vectors)
    shares = [(i + 1, float(v)) for i, v in enumerate(fitted.explainedVariance.toArray())]
    return rounded(spark.createDataFrame(shares, "component int, share double"), 6, "share")


@query()
def importance_coef(spark, sf):
    rows, _, names = _prepared(spark, sf)
    return rounded(I.importance_coef(spark, M.fit_logistic(rows), names), 6, "importance")


@query(
    """SELECT count(*) AS n, count(*) AS equal, count(*) FILTER (quality = 1) AS positive, CAST(8 AS BIGINT) AS features
    FROM labels JOIN documents USING (doc_id)"""
)
def model_persist(spark, sf):
    """Preparation, model, class counts and importances saved and loaded; the scores are
    compared row by row with the originals."""
    rows, prepare, names = _prepared(spark, sf)
    fitted = M.fit_logistic(rows)
    whole = PipelineModel([*prepare.stages, fitted])
    path = work_folder(spark, "bundle")
    side = {"classes": M.class_weights(rows, "label"), "importances": I.importance_coef(spark, fitted, names)}
    save_bundle(path, whole, side)
    again, tables = load_bundle(spark, path, list(side))
    source = rows.select("doc_id", "label", *NUMERIC, *CATEGORICAL)
    before = M.positive_probability(whole.transform(source)).select("doc_id", "score")
    after = M.positive_probability(again.transform(source)).select("doc_id", F.col("score").alias("again"))
    return before.join(after, "doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("score") == F.col("again")).alias("equal"),
        F.lit(tables["classes"].first()["positive"]).cast("bigint").alias("positive"),
        F.lit(tables["importances"].count()).cast("bigint").alias("features"),
    )


@query()
def cross_validate(spark, sf):
    """Mean and spread of the metrics of a boosted classifier over three shuffled folds."""
    rows, _, _ = _prepared(spark, sf)
    folds = X.kfold_stratified(rows, "label", "doc_id", k=3, seed=42)
    scores = M.cross_validate(folds, M.boosted_classifier(rounds=5, depth=3), "fold")
    metrics = ["roc_auc", "f1_score", "precision", "recall", "accuracy", "average_precision"]
    return rounded(summarize_folds(scores, metrics), 6, "mean", "std")


@query()
def pca(spark, sf):
    """Share of variance of the two main directions of the line numbers."""
    rows = Tables(spark, sf).lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    scaled = E.standard_scale(rows, rows.columns)
    vectors = VectorAssembler(inputCols=rows.columns, outputCol="features").transform(scaled)
    fitted = PCA(k=2, inputCol="features", outputCol="parts").fit(vectors)
    shares = [(i + 1, float(v)) for i, v in enumerate(fitted.explainedVariance.toArray())]
    return rounded(spark.createDataFrame(shares, "component int, share double"), 6, "share")


@query(
    """SELECT 'a' AS run, round(avg(abs(l_extendedprice - l_quantity * 1500)), 4) AS mae FROM lineitem
    UNION ALL SELECT 'b', round(avg(abs(l_extendedprice - l_quantity * 1400)), 4) FROM lineitem"""
)
def metric_log(spark, sf):
    """Metrics of two runs appended to one log."""
    path = work_folder(spark, "metrics")
    rows = Tables(spark, sf).lineitem
    for run, price in (("a", 1500), ("b", 1400)):
        guess = rows.withColumn("p", F.col("l_quantity") * price)
        append_metrics(regression_metrics(guess, "l_extendedprice", "p"), path, run)
    return rounded(spark.read.parquet(path).select("run", "mae"), 4, "mae")
