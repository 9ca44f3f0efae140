"""Model training on Spark ML. Returned frames are lazy; fitting runs when the function is called."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, Evaluator, RegressionEvaluator
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.nested import index_of_max, index_words
from millrace.operators.cells import CellError, as_cells
from millrace.operators.features import assembler
from millrace.session import materialise


def linear_pipeline(columns: Sequence[str], label: str) -> Pipeline:
    model = LinearRegression(featuresCol="features", labelCol=label, solver="normal")
    return Pipeline(stages=[assembler(columns), model])


def linear_regression(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Ordinary least squares by the normal equations: one pass. A row per coefficient, intercept last."""
    model = linear_pipeline(columns, label).fit(df).stages[-1]
    summary = model.summary
    names = [*columns, "intercept"]
    values = [*model.coefficients.toArray(), model.intercept]
    rows = [
        (n, float(v), float(p), float(summary.r2))
        for n, v, p in zip(names, values, summary.pValues, strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, "term string, value double, p_value double, r2 double")


def kmeans_clusters(df: DataFrame, features: str, k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their cluster, one row per cluster with centre and size)."""
    # Read by every step of the fit; without this each would repeat what led to the vectors.
    df = materialise(df, "clustering")
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)
    assigned = model.transform(df)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    table = df.sparkSession.createDataFrame(centres, "cluster int, centre array<double>")
    sizes = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return assigned, table.join(sizes, "cluster", "left")


def kmeans_sweep(df: DataFrame, features: str, ks: Sequence[int], seed: int) -> DataFrame:
    """Silhouette per number of clusters. The vectors are written once and read by every fit."""
    stored = materialise(df.select(features), "sweep")
    evaluator = ClusteringEvaluator(featuresCol=features, metricName="silhouette", distanceMeasure="squaredEuclidean")
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol=features).fit(stored)
        rows.append((k, float(evaluator.evaluate(model.transform(stored)))))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def classifiers(label: str, features: str = "features") -> dict[str, Estimator]:
    return {
        "logistic": LogisticRegression(labelCol=label, featuresCol=features, maxIter=10, regParam=0.01),
        "tree": DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=5, seed=1),
        "forest": RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=10, maxDepth=5, seed=1),
    }


def regressors(label: str, features: str = "features") -> dict[str, Estimator]:
    return {
        "forest": RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=10, maxDepth=5, seed=1),
        "boosted": GBTRegressor(labelCol=label, featuresCol=features, maxIter=5, maxDepth=3, seed=1),
    }


def predictions(models: Mapping[str, Estimator], train: DataFrame, test: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Every model fitted on the training rows and applied to the others, stacked with its name."""
    out = None
    for name, estimator in models.items():
        scored = estimator.fit(train).transform(test)
        if "probability" in scored.columns:
            scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
        else:
            scored = scored.withColumn("score", F.col("prediction"))
        part = scored.select(F.lit(name).alias("model"), *keep, "prediction", "score")
        out = part if out is None else out.unionByName(part)
    return out


def importances(estimator: Estimator, train: DataFrame, names: Sequence[str]) -> DataFrame:
    """Feature importance of a tree model, largest first."""
    weights = estimator.fit(train).featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    return train.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def grid_search(
    df: DataFrame,
    estimator: Estimator,
    grid: Mapping[str, Sequence],
    evaluator: Evaluator,
    folds: int,
    seed: int,
    parallelism: int = 4,
    inputs: Sequence[str] = (),
) -> tuple[object, DataFrame]:
    """Cross-validated grid: the best model, and a row per candidate with its mean score.

    With ``inputs``, the few columns that trees for regression learn from, rows are counted once by the bins these lie
    in, and every fold and candidate reads the counts. Without, each reads the rows.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    candidates = builder.build()
    if inputs:
        if not isinstance(evaluator, RegressionEvaluator) or evaluator.getMetricName() != "rmse":
            raise ValueError("cells are scored by rmse")
        most = max(grid.get("numTrees", [estimator.getOrDefault("numTrees")])) if estimator.hasParam("numTrees") else 0
        bins, rows, estimator = as_cells(df, estimator, most, evaluator.getLabelCol(), inputs, folds, seed)
        evaluator = CellError()
    else:
        # Every fold and candidate reads the rows again, so they are written once.
        rows = materialise(df, "grid")
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=candidates, evaluator=evaluator, numFolds=folds, seed=seed,
        parallelism=parallelism, foldCol="fold" if inputs else "",
    )
    fitted = search.fit(rows)
    better = max if evaluator.isLargerBetter() else min
    best = better(fitted.avgMetrics)
    scores = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(c.items(), key=lambda kv: kv[0].name)), float(s), bool(s == best))
        for i, (c, s) in enumerate(zip(candidates, fitted.avgMetrics, strict=True))
    ]
    table = df.sparkSession.createDataFrame(scores, "candidate int, params string, score double, best boolean")
    return PipelineModel([*bins.stages, fitted.bestModel]) if inputs else fitted.bestModel, table


def binary_evaluator(label: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label)


def regression_evaluator(label: str, metric: str = "rmse") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)


def vocabulary_model(
    df: DataFrame, token_column: str, output: str, size: int = 2048, min_df: float = 0.05, max_df: float = 1.0, min_tf: float = 1
) -> CountVectorizerModel:
    """What ``CountVectorizer`` fits, as an aggregate: it would hold the tokens of all documents in memory.

    The ``size`` words that come most often, of those in a share of the documents from ``min_df`` to ``max_df``. Words
    that come equally often follow by name, where Spark's own fit leaves their order open.
    """
    documents = df.count()
    once, again = F.lit(1).cast("long"), F.lit(0).cast("long")

    def seen(words: Column | str, n: Column, docs: Column) -> Column:
        return F.transform(words, lambda w: F.struct(w.alias("word"), n.alias("n"), docs.alias("docs")))

    every = F.concat(seen(token_column, once, again), seen(F.array_distinct(token_column), again, once))
    counts = df.select(F.explode(every).alias("w")).select("w.*").groupBy("word").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    common = counts.where(F.col("docs").between(min_df * documents, max_df * documents))
    # As many words as the model holds.
    words = [r["word"] for r in common.orderBy(F.col("n").desc(), "word").limit(size).select("word").collect()]
    if not words:
        raise ValueError(f"no word is in {min_df} to {max_df} of the documents")
    return CountVectorizerModel.from_vocabulary(words, inputCol=token_column, outputCol=output, minTF=min_tf)


def classify_text(df: DataFrame, token_column: str, label: str, keep: Sequence[str]) -> DataFrame:
    """Supervised text label: term weights and logistic regression, fitted on the rows that have one."""
    counts = vocabulary_model(df.where(F.col(label).isNotNull()), token_column, "tf")
    # Read by every stage of the fit and by the scores; far smaller than the tokens.
    counted = materialise(counts.transform(df).select(*dict.fromkeys([*keep, label, "tf"])), "counted")
    stages = [IDF(inputCol="tf", outputCol="features"), LogisticRegression(labelCol=label, maxIter=20, regParam=0.01)]
    scored = Pipeline(stages=stages).fit(counted.where(F.col(label).isNotNull())).transform(counted)
    score = F.array_max(vector_to_array("probability"))
    return scored.select(*keep, F.col("prediction").cast("int").alias("predicted"), F.col(label).alias("truth"), score.alias("score"))


def lda_topics(df: DataFrame, doc: str, token_column: str, k: int, seed: int, iterations: int = 10, words: int = 10) -> tuple[DataFrame, DataFrame]:
    """(dominant topic and topic shares per document, key words and document count per topic)."""
    vectorizer = vocabulary_model(df, token_column, "tf", max_df=0.7, min_tf=2)
    counted = materialise(vectorizer.transform(df).select(doc, "tf"), "topics")
    model = LDA(k=k, seed=seed, maxIter=iterations, featuresCol="tf").fit(counted)
    shares = vector_to_array("topicDistribution")
    per_doc = model.transform(counted).select(doc, shares.alias("shares"))
    per_doc = per_doc.withColumn("topic", index_of_max("shares").cast("int"))
    key_words = index_words("termIndices", vectorizer.vocabulary).alias("key_words")
    sizes = per_doc.groupBy("topic").agg(F.count(F.lit(1)).alias("documents"))
    topics = model.describeTopics(words).select("topic", key_words).join(sizes, "topic", "left")
    return per_doc, topics.withColumn("documents", F.coalesce("documents", F.lit(0)))
