"""Fitted stages that the library of stages lacks, written as DataFrame code: they chain, save and load like its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import IDF, PCA, Binarizer, HashingTF, MinMaxScaler, StandardScaler, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import encoder, indexer
from millrace.operators.selection import quantiles_of


class _MultiHotParams(HasInputCol, HasOutputCol):
    size = Param(Params._dummy(), "size", "most elements that get a place", TypeConverters.toInt)
    vocabulary = Param(Params._dummy(), "vocabulary", "elements in the order of their places", TypeConverters.toListString)


class MultiHotModel(Model, _MultiHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """A vector with a 1 in the place of every element the array holds; other elements, and null, have none."""

    def _transform(self, df: DataFrame) -> DataFrame:
        words, column = self.getOrDefault("vocabulary"), F.col(self.getInputCol())
        held = F.array(*[F.coalesce(F.array_contains(column, w).cast("double"), F.lit(0.0)) for w in words]) if words else F.array().cast("array<double>")
        return df.withColumn(self.getOutputCol(), array_to_vector(held))


class MultiHot(Estimator, _MultiHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """The ``size`` elements that most rows hold get a place, most frequent first, ties by name."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, size: int = 64):
        super().__init__()
        self._setDefault(size=64)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> MultiHotModel:
        each = df.select(F.explode(F.array_distinct(self.getInputCol())).alias("word")).where("word IS NOT NULL")
        best = each.groupBy("word").count().orderBy(F.desc("count"), "word").limit(self.getOrDefault("size"))
        # At most ``size`` rows.
        words = [r["word"] for r in best.collect()]
        return self._copyValues(MultiHotModel())._set(vocabulary=words)


class _MedianParams(HasInputCols, HasOutputCols):
    medians = Param(Params._dummy(), "medians", "median of each column, NaN for none", TypeConverters.toListFloat)


class MedianImputerModel(Model, _MedianParams, DefaultParamsReadable, DefaultParamsWritable):
    """The columns with their nulls filled; a column that had no values keeps its nulls."""

    def _transform(self, df: DataFrame) -> DataFrame:
        filled = {}
        for source, target, value in zip(self.getInputCols(), self.getOutputCols(), self.getOrDefault("medians"), strict=True):
            column = F.col(source).cast("double")
            filled[target] = column if value != value else F.coalesce(column, F.lit(value))
        return df.withColumns(filled)


class MedianImputer(Estimator, _MedianParams, DefaultParamsReadable, DefaultParamsWritable):
    """Exact medians (the lower middle value) of all columns, from the same few passes over the rows."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: list(v) for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        # One row for each column.
        found = {r["column"]: r["m"] for r in quantiles_of(df, [], self.getInputCols(), {"m": 0.5}, discrete=True).collect()}
        return self._copyValues(MedianImputerModel())._set(medians=[found.get(c, float("nan")) for c in self.getInputCols()])


def feature_pipeline(
    categories: Sequence[str], numbers: Sequence[str], flags: dict[str, float], lists: Sequence[str], text: str | None, components: int,
    places: int = 16, buckets: int = 20,
) -> Pipeline:
    """From raw columns to ``features``, everything fitted on the training rows.

    Categories are indexed and one-hot encoded; numbers get their gaps filled by the median and are scaled to 0..1;
    ``flags`` become 1 above their threshold; arrays become multi-hot; a text becomes hashed term weights; and
    all of it, standardised, is projected to so many principal components, which follow it in the vector.
    """
    filled = [f"{c}_filled" for c in numbers]
    stages = [indexer(categories, "keep"), encoder(categories), MedianImputer(inputCols=list(numbers), outputCols=filled)]
    stages += [VectorAssembler(inputCols=filled, outputCol="numbers"), MinMaxScaler(inputCol="numbers", outputCol="numbers_scaled")]
    inputs = [f"{c}_onehot" for c in categories] + ["numbers_scaled"]
    for column, threshold in flags.items():
        stages += [MedianImputer(inputCols=[column], outputCols=[f"{column}_known"])]
        stages += [Binarizer(inputCol=f"{column}_known", outputCol=f"{column}_flag", threshold=threshold)]
        inputs.append(f"{column}_flag")
    for column in lists:
        stages.append(MultiHot(inputCol=column, outputCol=f"{column}_held", size=places))
        inputs.append(f"{column}_held")
    if text is not None:
        stages += [Tokenizer(inputCol=text, outputCol="terms"), HashingTF(inputCol="terms", outputCol="tf", numFeatures=buckets), IDF(inputCol="tf", outputCol="weights")]
        inputs.append("weights")
    stages += [
        VectorAssembler(inputCols=inputs, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="standard", withMean=True, withStd=True),
        PCA(k=components, inputCol="standard", outputCol="components"),
        VectorAssembler(inputCols=["raw", "components"], outputCol="features"),
    ]
    return Pipeline(stages=stages)
