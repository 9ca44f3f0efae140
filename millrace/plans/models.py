"""Model training and evaluation on the shared tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import nested as N
from millrace.operators import evaluate as V
from millrace.operators import features as E
from millrace.operators import models as ML
from millrace.operators import sampling as S
from millrace.operators import text as X
from millrace.plans.features import priced
from millrace.plans.registry import Tables, query
from millrace.session import materialise, scratch, spread

_INPUTS = ["l_quantity", "l_discount", "l_tax"]


def _lines(t: Tables):
    """Line items as features and a price to predict, split by order."""
    lines = spread(t.lineitem).select("l_orderkey", *_INPUTS, "l_extendedprice")
    # Stored: every tree and boosting step reads the rows again.
    marked = materialise(S.mark_split(E.assembler(_INPUTS).transform(lines), "l_orderkey", 70), "lines")
    return marked.where("part = 'train'"), marked.where("part = 'test'")


def _labelled_orders(t: Tables):
    """Orders with encoded features and whether they lie above their segment's mean in the training part."""
    rows = priced(t).select(
        "o_orderkey", "c_mktsegment", "o_orderpriority", "o_orderstatus", "c_acctbal", "o_totalprice"
    )
    # Stored twice: the join of four tables once for all stages, their outcome once for all fits.
    marked = materialise(S.mark_split(rows, "o_orderkey", 70), "orders")
    labelled = E.label_vs_group_mean(marked.where("part = 'train'"), marked, "c_mktsegment", "o_totalprice", "above")
    chain = E.stage_chain(["c_mktsegment", "o_orderpriority", "o_orderstatus"], ["c_acctbal"]).fit(labelled.where("part = 'train'"))
    ready = materialise(chain.transform(labelled).select("o_orderkey", "above", "features", "part"), "ready")
    return ready.where("part = 'train'").drop("part"), ready.where("part = 'test'").drop("part")


@query("ml_kmeans")
def _(t: Tables):
    scaled = E.standard_scale(spread(t.lineitem), ["l_quantity", "l_extendedprice", "l_discount"], "features")
    _, clusters = ML.kmeans_clusters(scaled.select("features"), "features", 6, 1)
    return clusters


@query("ml_kmeans_assign")
def _(t: Tables):
    vectors = t.embeddings.select("vec_id", "label", N.as_vector("embedding").alias("features"))
    assigned, _ = ML.kmeans_clusters(vectors, "features", 10, 1)
    return assigned.select("vec_id", "label", "cluster")


@query("ml_kmeans_sweep")
def _(t: Tables):
    vectors = t.embeddings.select(N.as_vector("embedding").alias("features"))
    return ML.kmeans_sweep(vectors, "features", range(2, 11), 1)


@query(
    "ml_linear_reg",
    """SELECT unnest(['l_quantity', 'intercept']) AS term, round(unnest([slope, mid]), 4) AS value, round(r2, 6) AS r2
       FROM (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS mid,
                    regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem)""",
)
def _(t: Tables):
    fitted = ML.linear_regression(t.lineitem, ["l_quantity"], "l_extendedprice")
    return fitted.select("term", F.round("value", 4).alias("value"), F.round("r2", 6).alias("r2"))


@query("ml_linear_reg_many")
def _(t: Tables):
    return ML.linear_regression(t.lineitem, _INPUTS, "l_extendedprice")


@query("ml_logistic")
def _(t: Tables):
    train, test = _labelled_orders(t)
    chosen = {"logistic": ML.classifiers("above")["logistic"]}
    return ML.predictions(chosen, train, test, ["o_orderkey", "above"])


@query("ml_tree_reg")
def _(t: Tables):
    """Importances of the random forest and of the boosted trees."""
    train, _ = _lines(t)
    models = ML.regressors("l_extendedprice")
    found = [ML.importances(models[n], train, _INPUTS).withColumn("model", F.lit(n)) for n in ("forest", "boosted")]
    return found[0].unionByName(found[1])


@query("ml_tree_cls")
def _(t: Tables):
    train, test = _labelled_orders(t)
    chosen = {n: m for n, m in ML.classifiers("above").items() if n != "logistic"}
    return ML.predictions(chosen, train, test, ["o_orderkey", "above"])


@query("ml_grid_cv")
def _(t: Tables):
    train, _ = _labelled_orders(t)
    _, table = ML.grid_search(
        train, ML.classifiers("above")["logistic"], {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
        ML.binary_evaluator("above"), folds=3, seed=7,
    )
    return table


@query("ml_grid_cv_reg")
def _(t: Tables):
    """A grid over each kind of trees for regression."""
    train, _ = _lines(t)
    models, evaluator = ML.regressors("l_extendedprice"), ML.regression_evaluator("l_extendedprice")
    grids = {"forest": {"maxDepth": [3, 5], "numTrees": [5, 10]}, "boosted": {"maxDepth": [2, 3], "maxIter": [3, 5]}}
    tables = [ML.grid_search(train, models[n], g, evaluator, folds=3, seed=7, inputs=_INPUTS)[1].withColumn("model", F.lit(n)) for n, g in grids.items()]
    return tables[0].unionByName(tables[1])


@query("eval_fitted_regression")
def _(t: Tables):
    """Hold-out metrics of every fitted regressor."""
    train, test = _lines(t)
    found = ML.predictions(ML.regressors("l_extendedprice"), train, test, ["l_extendedprice"])
    return V.regression_metrics(found, "l_extendedprice", "prediction", ["model"])


@query("eval_fitted_classification")
def _(t: Tables):
    """Hold-out metrics of every fitted classifier."""
    train, test = _labelled_orders(t)
    found = ML.predictions(ML.classifiers("above"), train, test, ["above"]).withColumn("prediction", F.col("prediction").cast("int"))
    stored = materialise(found, "classified")
    names = sorted(ML.classifiers("above"))
    each = [V.classification_metrics(stored.where(F.col("model") == n), "above", "prediction").withColumn("model", F.lit(n)) for n in names]
    return reduce(DataFrame.unionByName, each)


@query("ml_predict")
def _(t: Tables):
    train, test = _lines(t)
    return ML.predictions(ML.regressors("l_extendedprice"), train, test, ["l_orderkey", *_INPUTS, "l_extendedprice"])


@query("txt_classify")
def _(t: Tables):
    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", X.tokens("text", 2, []).alias("w"), "quality")
    return ML.classify_text(rows, "w", "quality", ["doc_id"])


@query("txt_lda_topics")
def _(t: Tables):
    rows = t.documents.select("doc_id", X.tokens("text", 4).alias("w"))
    _, topics = ML.lda_topics(rows, "doc_id", "w", 6, 24, iterations=5)
    return topics


# --- evaluation --------------------------------------------------------------------------------

# A rule of thumb stands in for a model, so that the SQL side can follow: 2000 per unit plus 2000.
_GUESS = "(2000.0::DOUBLE * l_quantity + 2000)"


def _guessed(t: Tables):
    return t.lineitem.withColumn("guess", F.lit(2000.0) * F.col("l_quantity") + 2000)


_METRICS_SQL = f"""count(*) AS n, round(avg(abs(l_extendedprice - {_GUESS})), 4) AS mae, round(avg(pow(l_extendedprice - {_GUESS}, 2)), 2) AS mse,
    round(sqrt(avg(pow(l_extendedprice - {_GUESS}, 2))), 4) AS rmse,
    round(1 - avg(pow(l_extendedprice - {_GUESS}, 2)) / var_pop(l_extendedprice), 6) AS r2"""


@query("eval_regression", f"SELECT l_returnflag, {_METRICS_SQL} FROM lineitem GROUP BY 1 UNION ALL SELECT 'all', {_METRICS_SQL} FROM lineitem")
def _(t: Tables):
    # One aggregate over grouping sets gives the groups and the whole.
    found = V.regression_metrics(_guessed(t), "l_extendedprice", "guess", ["l_returnflag"], total="all")
    digits = {"mae": 4, "mse": 2, "rmse": 4, "r2": 6}
    return found.withColumns({c: F.round(c, d) for c, d in digits.items()})


_SCORED_SQL = "(SELECT round(1 - exp(-n_chars / 1000.0::DOUBLE), 3) AS score, quality FROM documents JOIN labels USING (doc_id))"


def _scored(t: Tables):
    score = F.round(1 - F.exp(-F.col("n_chars") / 1000.0), 3)
    return t.documents.join(t.labels, "doc_id").select(score.alias("score"), "quality")


_CURVE_SQL = f"""c AS (SELECT score, count(CASE WHEN quality = 1 THEN 1 END) AS pos, count(CASE WHEN quality = 0 THEN 1 END) AS neg FROM {_SCORED_SQL} GROUP BY 1),
    r AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM c WINDOW w AS (ORDER BY score DESC)),
    k AS (SELECT score, tp, fp, tp / p AS tpr, fp / n AS fpr, tp / (tp + fp) AS precision FROM r)"""


@query(
    "eval_binary_curves",
    f"""WITH {_CURVE_SQL} SELECT score, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tpr, 6) AS tpr, round(fpr, 6) AS fpr, round(precision, 6) AS precision FROM k""",
)
def _(t: Tables):
    curve = V.binary_curve(_scored(t), "score", "quality")
    rates = [F.round(c, 6).alias(c) for c in ("tpr", "fpr", "precision")]
    return curve.select("score", "tp", "fp", *rates)


@query(
    "eval_binary_areas",
    f"""WITH {_CURVE_SQL}, l AS (SELECT *, coalesce(lag(tpr) OVER w, 0) AS ltpr, coalesce(lag(fpr) OVER w, 0) AS lfpr, coalesce(lag(precision) OVER w, precision) AS lp
                                FROM k WINDOW w AS (ORDER BY score DESC))
        SELECT round(sum((fpr - lfpr) * (tpr + ltpr) / 2), 6) AS roc_area, round(sum((tpr - ltpr) * (precision + lp) / 2), 6) AS pr_area FROM l""",
)
def _(t: Tables):
    areas = V.binary_areas(V.binary_curve(_scored(t), "score", "quality"))
    return areas.select(F.round("roc_area", 6).alias("roc_area"), F.round("pr_area", 6).alias("pr_area"))


@query("eval_confusion", f"SELECT quality::INTEGER AS quality, (score > 0.3)::INTEGER AS called, count(*) AS n FROM {_SCORED_SQL} GROUP BY 1, 2")
def _(t: Tables):
    called = _scored(t).select(F.col("quality").cast("int"), (F.col("score") > 0.3).cast("int").alias("called"))
    return V.confusion(called, "quality", "called")


@query(
    "eval_classification",
    f"""SELECT round(sum((score > 0.3 AND quality = 1)::INTEGER) / sum((score > 0.3)::INTEGER), 6) AS precision,
               round(sum((score > 0.3 AND quality = 1)::INTEGER) / sum((quality = 1)::INTEGER), 6) AS recall,
               round(sum(((score > 0.3)::INTEGER = quality)::INTEGER) / count(*), 6) AS accuracy, count(*) AS n FROM {_SCORED_SQL}""",
)
def _(t: Tables):
    called = _scored(t).select("quality", (F.col("score") > 0.3).cast("int").alias("called"))
    found = V.classification_metrics(called, "quality", "called")
    return found.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "accuracy")})


@query(
    "eval_residuals",
    f"""WITH e AS (SELECT l_extendedprice - {_GUESS} AS r FROM lineitem), b AS (SELECT min(r) AS lo, max(r) AS hi FROM e),
        p AS (SELECT least(9, floor((r - lo) / ((hi - lo) / 10)))::INTEGER AS bin, lo, hi FROM e, b)
        SELECT bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 10, 4) AS bin_start, count(*) AS n FROM p GROUP BY bin""",
)
def _(t: Tables):
    bins = V.residual_histogram(_guessed(t), "l_extendedprice", "guess", 10)
    return bins.withColumn("bin_start", F.round("bin_start", 4))


@query(
    "eval_run_table",
    f"""SELECT 'rule' AS run, 'per_unit' AS model, 'base=2000, unit=2000' AS params,
               round(avg(abs(l_extendedprice - {_GUESS})), 4) AS mae, round(sqrt(avg(pow(l_extendedprice - {_GUESS}, 2))), 4) AS rmse FROM lineitem
        UNION ALL SELECT 'flat', 'constant', 'value=50000', round(avg(abs(l_extendedprice - 50000)), 4), round(sqrt(avg(pow(l_extendedprice - 50000, 2))), 4) FROM lineitem""",
)
def _(t: Tables):
    path = scratch(t.spark, "runs")
    rows = _guessed(t).withColumn("flat", F.lit(50000.0))
    rule = V.regression_metrics(rows, "l_extendedprice", "guess").select("mae", "rmse")
    flat = V.regression_metrics(rows, "l_extendedprice", "flat").select("mae", "rmse")
    V.record_run(rule, path, "rule", "per_unit", {"unit": 2000, "base": 2000})
    V.record_run(flat, path, "flat", "constant", {"value": 50000})
    table = V.compare_runs(t.spark, path, ["mae", "rmse"])
    return table.withColumns({c: F.round(c, 4) for c in ("mae", "rmse")})
