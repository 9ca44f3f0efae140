"""Model quality as aggregates over a frame of predictions; nothing is collected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import histogram
from millrace.operators.ordered import running
from millrace.session import materialise


def regression_metrics(df: DataFrame, truth: str, predicted: str, keys: Sequence[str] = (), total: str | None = None) -> DataFrame:
    """mae, mse, rmse and R², over everything or by group, in one aggregate. With ``total`` and one key, a row
    of that name for everything comes with the groups.

    Total variation is n times the population variance, which is computed stably.
    """
    error = F.col(truth) - F.col(predicted)
    known = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(truth).alias("__var"),
    ]
    if total is None:
        grouped = known.groupBy(*keys).agg(*aggs) if keys else known.agg(*aggs)
    else:
        (key,) = keys
        both = known.rollup(key).agg(*aggs, F.grouping(key).alias("__whole"))
        grouped = both.withColumn(key, F.when(F.col("__whole") == 1, F.lit(total)).otherwise(F.col(key))).drop("__whole")
    r2 = 1 - F.try_divide(F.col("mse"), F.col("__var"))
    return grouped.withColumns({"rmse": F.sqrt("mse"), "r2": r2}).drop("__var")


def binary_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score, from the highest down: counts and rates when everything from that
    score up is called positive.

    Scores are counted first; the running counts over them go through the chunked running sum, so a
    model with a different score for every row is no problem either.
    """
    grouped = df.groupBy(score).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg")
    )
    # Read for totals and for the running counts; the model scores every row only once.
    counts = materialise(grouped, "curve")
    totals = counts.agg(F.sum("pos"), F.sum("neg")).first()
    p, n = F.lit(totals[0]), F.lit(totals[1])
    placed = running(counts, [], [f"-{score}"], {"tp": F.col("pos"), "fp": F.col("neg")})
    return placed.withColumns(
        {
            "tpr": F.try_divide(F.col("tp"), p),
            "fpr": F.try_divide(F.col("fp"), n),
            "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
            "last_tpr": F.try_divide(F.col("tp") - F.col("pos"), p),
            "last_fpr": F.try_divide(F.col("fp") - F.col("neg"), n),
            "last_precision": F.try_divide(
                F.col("tp") - F.col("pos"), F.col("tp") - F.col("pos") + F.col("fp") - F.col("neg")
            ),
        }
    )


def binary_areas(curve: DataFrame) -> DataFrame:
    """Areas under the two curves by trapezoids. The row before is this row minus its own counts."""
    roc = (F.col("fpr") - F.col("last_fpr")) * (F.col("tpr") + F.col("last_tpr")) / 2
    before = F.coalesce("last_precision", "precision")
    pr = (F.col("tpr") - F.col("last_tpr")) * (F.col("precision") + before) / 2
    return curve.agg(F.sum(roc).alias("roc_area"), F.sum(pr).alias("pr_area"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, truth: str, predicted: str, positive=1) -> DataFrame:
    hit = (F.col(truth) == positive) & (F.col(predicted) == positive)
    counts = df.agg(
        F.count(F.when(hit, 1)).alias("tp"),
        F.count(F.when(F.col(predicted) == positive, 1)).alias("called"),
        F.count(F.when(F.col(truth) == positive, 1)).alias("real"),
        F.count(F.when(F.col(truth) == F.col(predicted), 1)).alias("right"),
        F.count(F.lit(1)).alias("n"),
    )
    return counts.select(
        F.try_divide("tp", "called").alias("precision"),
        F.try_divide("tp", "real").alias("recall"),
        F.try_divide("right", "n").alias("accuracy"),
        "n",
    )


def residual_histogram(df: DataFrame, truth: str, predicted: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    rest = df.withColumn("residual", F.col(truth) - F.col(predicted))
    return histogram(rest, list(keys), "residual", bins)


def record_run(metrics: DataFrame, path: str, run: str, model: str, params: Mapping[str, object]) -> None:
    """Append one run to the run table: a row per metric, with the parameters as text."""
    text = ", ".join(f"{k}={v}" for k, v in sorted(params.items()))
    names = metrics.columns
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    rows = metrics.select(F.explode(entries).alias("e")).select(
        F.lit(run).alias("run"), F.lit(model).alias("model"), F.lit(text).alias("params"), "e.metric", "e.value"
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def compare_runs(spark: SparkSession, path: str, metrics: Sequence[str]) -> DataFrame:
    """One row per run, a column per metric."""
    return spark.read.parquet(path).groupBy("run", "model", "params").pivot("metric", list(metrics)).agg(F.first("value"))
