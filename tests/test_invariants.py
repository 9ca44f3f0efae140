"""What must hold for queries whose rows no SQL can give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

RUN = entry.queries()


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return lambda key: RUN[key](spark, sf_dir)


def test_row_ids(run):
    row = run("row_id").agg(F.count_distinct("row_id"), F.count("*"), F.min("row_id")).first()
    assert row[0] == row[1] and row[2] >= 0


def test_samples_are_repeatable_subsets(run, spark, sf_dir):
    orders = {r[0] for r in spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey").collect()}
    drawn = run("sample_n").collect()
    assert len(drawn) == 500 and {r["o_orderkey"] for r in drawn} <= orders
    a, b = (sorted(map(tuple, run("sample_fraction").collect())) for _ in range(2))
    assert a == b and len(a) > 0
    split = [r["o_orderkey"] for r in run("split_random").collect()]
    assert sorted(split) == sorted(orders)


def test_approximate_quantiles_by_rank(run, spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    values: dict[str, list[float]] = {}
    for r in lines.select("l_returnflag", "l_extendedprice").collect():
        values.setdefault(r[0], []).append(r[1])
    for row in run("agg_quantile_approx").collect():
        ordered = sorted(values[row["l_returnflag"]])
        for name, p in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
            at = sum(v <= row[name] for v in ordered) / len(ordered)
            assert abs(at - p) <= 0.01


def test_chi_square_p(run):
    assert all(0 <= r["p_value"] <= 1 for r in run("agg_chi2_p").collect())


def test_cluster_sizes(run, spark, sf_dir):
    sizes = [r["size"] for r in run("ml_kmeans").collect()]
    assert len(sizes) == 6 and sum(sizes) == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert all(-1 <= r["silhouette"] <= 1 for r in run("ml_kmeans_sweep").collect())


def test_predictions(run):
    scored = run("ml_logistic")
    assert scored.where("score < 0 OR score > 1 OR prediction NOT IN (0, 1)").count() == 0
    by_model = {r["model"]: r["count"] for r in run("ml_predict").groupBy("model").count().collect()}
    assert set(by_model) == {"forest", "boosted"} and len(set(by_model.values())) == 1
    weights = run("ml_tree_reg").groupBy("model").sum("importance").collect()
    assert {r["model"] for r in weights} == {"forest", "boosted"} and all(r[1] == pytest.approx(1.0) for r in weights)


def test_grid(run):
    rows = run("ml_grid_cv").collect()
    assert len(rows) == 4 and max(r["score"] for r in rows) == next(r["score"] for r in rows if r["best"])


def test_grid_over_regressors(run):
    rows = run("ml_grid_cv_reg").collect()
    assert len(rows) == 8
    for model in ("forest", "boosted"):
        own = [r for r in rows if r["model"] == model]
        assert min(r["score"] for r in own) == next(r["score"] for r in own if r["best"])


def test_metrics_of_fitted_models(run):
    """The metrics are those of the predictions, counted again here. Whether models predict well is up to the data."""
    found = {r["model"]: r for r in run("eval_fitted_regression").collect()}
    by_model = {}
    for r in run("ml_predict").select("model", "l_extendedprice", "prediction").collect():
        by_model.setdefault(r["model"], []).append((r["l_extendedprice"], r["prediction"]))
    assert set(found) == set(by_model) == {"forest", "boosted"}
    for model, pairs in by_model.items():
        truth, guess = np.array(pairs).T
        mse = float(((truth - guess) ** 2).mean())
        want = {"n": len(pairs), "mae": float(np.abs(truth - guess).mean()), "mse": mse, "rmse": mse**0.5, "r2": 1 - mse / float(truth.var())}
        assert {k: found[model][k] for k in want} == pytest.approx(want, rel=1e-6)
    classes = run("eval_fitted_classification").collect()
    assert len({r["model"] for r in classes}) == len(classes) >= 3


def test_draws_without_replacement(run):
    rows = run("sample_n_distinct")
    assert rows.count() == rows.select("o_orderkey").distinct().count() == 500


def test_saved_model_predicts_alike(run, spark, sf_dir):
    from millrace.operators.models import linear_pipeline

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    direct = linear_pipeline(["l_quantity", "l_discount"], "l_extendedprice").fit(rows).transform(rows)
    a = [round(r[0], 6) for r in direct.select("prediction").orderBy("prediction").collect()]
    b = [round(r[0], 6) for r in run("model_save_load").select("prediction").orderBy("prediction").collect()]
    assert a == b


def test_text_classes_beat_the_majority(run):
    rows = run("txt_classify").where("truth IS NOT NULL").collect()
    right = sum(r["predicted"] == r["truth"] for r in rows)
    ones = sum(r["truth"] for r in rows)
    assert right >= max(ones, len(rows) - ones)


def test_topics(run, spark, sf_dir):
    rows = run("txt_lda_topics").collect()
    assert len(rows) == 6 and sum(r["documents"] for r in rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["key_words"] for r in rows)


def test_hashed_weights(run):
    assert all(len(r["tfidf"]) == 20 and min(r["tfidf"]) >= 0 for r in run("txt_hash_tfidf").collect())


def test_stage_chain(run):
    rows = run("fe_stage_chain").collect()
    assert {r["part"] for r in rows} == {"train", "test"} and len({len(r["features"]) for r in rows}) == 1


def test_grouped_forecast(run):
    rows = run("fc_grouped_map")
    per = rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("y").alias("y"), F.count("*").alias("n"))
    assert all(r["n"] - r["y"] == 90 for r in per.collect())
    assert rows.where("NOT (yhat_lower <= yhat AND yhat <= yhat_upper)").count() == 0


def test_vocabulary_is_the_vectorizers_without_holding_tokens(spark, sf_dir, monkeypatch):
    """The vectorizer's fit keeps the tokens of all documents; words that come equally often follow by name here."""
    from pyspark.ml.feature import CountVectorizer

    from millrace.operators import models as ML
    from millrace.operators import text as X

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", X.tokens("text", 4).alias("w")).cache()
    plain = CountVectorizer(inputCol="w", vocabSize=100, minDF=0.05, maxDF=0.7).fit(rows).vocabulary
    n = dict(rows.select(F.explode("w").alias("w")).groupBy("w").count().collect())
    monkeypatch.setattr(CountVectorizer, "_fit", None)
    found = ML.vocabulary_model(rows, "w", "tf", 100, max_df=0.7).vocabulary
    assert [n[w] for w in found] == [n[w] for w in plain] and found == sorted(found, key=lambda w: (-n[w], w))
    per_doc, topics = ML.lda_topics(rows, "doc_id", "w", 2, 1, iterations=1)
    assert per_doc.count() == rows.count() and topics.count() == 2
    labelled = rows.withColumn("label", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 3 - 1))
    scored = ML.classify_text(labelled, "w", "label", ["doc_id"])
    assert scored.columns == ["doc_id", "predicted", "truth", "score"] and scored.count() == rows.count()
    rows.unpersist()
