"""Tree fits over counted cells: a tree sees a feature by its bins only, so rows of the same bins need no pass each."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import QuantileDiscretizer, SQLTransformer
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import assembler
from millrace.operators.sampling import poisson_draw
from millrace.session import materialise


def bins_of(df: DataFrame, inputs: Sequence[str], bins: int) -> PipelineModel:
    """Stages that give a row the vector ``cell`` of the bins its inputs lie in. The cuts are quantiles."""
    names, places = [f"__bin_{c}" for c in inputs], [f"__place_{c}" for c in inputs]
    cuts = QuantileDiscretizer(numBucketsArray=[bins] * len(names), inputCols=list(inputs), outputCols=names, relativeError=1e-4)
    # Bins come marked as categories, which trees would split in any order; their sum with nothing is a plain number.
    plain = ", ".join(f"`{n}` + 0D AS `{p}`" for n, p in zip(names, places, strict=True))
    return PipelineModel([cuts.fit(df), SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"), assembler(places, "cell")])


def count_cells(df: DataFrame, label: str, draws: int, rate: float, seed: int) -> DataFrame:
    """A row per cell and fold: its rows, their mean label and the squares about it; the same of every one of ``draws``
    bootstrap samples, in which a row stands as often as a Poisson draw says.

    For squared errors that is all a tree can learn from the rows: squares about the mean of a cell are in every node
    above and cancel in a split's gain. At most bins ** inputs cells a fold.
    """
    # A missing label fails the fit, as it does in a row.
    rows = df.withColumn("y", F.coalesce(F.col(label).cast("double"), F.lit(float("nan"))))
    # Spark adds a partition's number to the seed, so seeds lie further apart than partitions.
    rows = rows.withColumns({f"k{i}": poisson_draw(rate, seed + 1_000_003 * (i + 1)) for i in range(draws)})
    found = [F.count(F.lit(1)).cast("double").alias("n"), F.avg("y").alias("y"), (F.var_pop("y") * F.count(F.lit(1))).alias("within")]
    for i in range(draws):
        times = F.col(f"k{i}").cast("double")
        found += [F.sum(times).alias(f"n{i}"), F.try_divide(F.sum(times * F.col("y")), F.sum(times)).alias(f"y{i}")]
    return rows.groupBy("fold", "cell").agg(*found)


class CellError(Evaluator):
    """Root mean squared error over the rows that the cells stand for."""

    def _evaluate(self, dataset: DataFrame) -> float:
        miss = F.col("y") - F.col("prediction")
        return dataset.agg(F.sqrt(F.sum(F.col("n") * miss * miss + F.col("within")) / F.sum("n"))).first()[0]

    def isLargerBetter(self) -> bool:
        return False


class BaggedForest(Estimator):
    """A forest whose trees each take their own bootstrap sample of the cells, where Spark's would draw whole cells."""

    def __init__(self, forest: RandomForestRegressor):
        super().__init__()
        self.forest = forest

    def copy(self, extra=None) -> BaggedForest:
        return BaggedForest(self.forest.copy(extra))

    def _fit(self, dataset: DataFrame) -> BaggedForestModel:
        forest, trees = self.forest, self.forest.getNumTrees()
        subset = forest.getFeatureSubsetStrategy()
        if subset == "auto":
            subset = "onethird" if trees > 1 else "all"
        fitted = []
        for i in range(trees):
            own = {
                forest.numTrees: 1, forest.bootstrap: False, forest.subsamplingRate: 1.0, forest.featureSubsetStrategy: subset, forest.featuresCol: "cell",
                forest.labelCol: f"y{i}", forest.weightCol: f"n{i}", forest.predictionCol: f"__tree{i}", forest.seed: forest.getSeed() + i,
            }
            fitted.append(forest.copy(own).fit(dataset.where(F.col(f"n{i}") > 0)))
        return BaggedForestModel(fitted)


class BaggedForestModel(Model):
    """The mean of the trees' predictions."""

    def __init__(self, trees: Sequence[Model]):
        super().__init__()
        self.trees = list(trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        for tree in self.trees:
            df = tree.transform(df)
        names = [t.getPredictionCol() for t in self.trees]
        return df.withColumn("prediction", sum(F.col(n) for n in names) / len(names)).drop(*names)


def as_cells(
    df: DataFrame, estimator: Estimator, most: int, label: str, inputs: Sequence[str], folds: int, seed: int
) -> tuple[PipelineModel, DataFrame, Estimator]:
    """(stages from rows to cells, the cells of every fold, the estimator that fits on them). ``most``: trees of the
    largest forest asked for."""
    if estimator.getMinInstancesPerNode() > 1 or estimator.getMinInfoGain() < 0:
        raise ValueError("a cell counts as one instance, whatever its rows")
    bagged = isinstance(estimator, RandomForestRegressor)
    if not bagged and not isinstance(estimator, GBTRegressor):
        raise ValueError("cells are for forests and boosted trees of a regression")
    if estimator.getSubsamplingRate() != 1.0 if not bagged else not estimator.getBootstrap():
        raise ValueError("rows of a cell can be drawn with replacement or not at all")
    bins = bins_of(df, inputs, estimator.getMaxBins())
    rows = bins.transform(df).withColumn("fold", F.floor(F.rand(seed) * folds).cast("int"))
    rate = estimator.getSubsamplingRate()
    cells = materialise(count_cells(rows, label, most if bagged else 0, rate, seed), "cells")
    # Spark looks for splits in as many instances as the square of maxBins: in all cells, so that no bin is missed.
    every = {estimator.maxBins: max(estimator.getMaxBins(), math.isqrt(cells.count()) + 1)}
    if bagged:
        return bins, cells, BaggedForest(estimator.copy(every))
    return bins, cells, estimator.copy(every | {estimator.featuresCol: "cell", estimator.labelCol: "y", estimator.weightCol: "n"})
