"""Feature engineering: indexing, encoding, scaling, imputing, outlier and label rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    PCA,
    Binarizer,
    HashingTF,
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import mode
from millrace.operators.ordered import attach
from millrace.operators.selection import quantiles, quantiles_of
from millrace.session import materialise


def indexer(columns: Sequence[str], invalid: str = "skip") -> StringIndexer:
    """Labels to numbers, most frequent first, ties by name. For category columns: the fitted model
    holds every label."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid=invalid)


def encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Index columns to 0/1 vectors, last category left out."""
    return OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_onehot" for c in columns])


def assembler(columns: Sequence[str], output: str = "features", invalid: str = "skip") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def standard_scale(df: DataFrame, columns: Sequence[str], output: str = "scaled") -> DataFrame:
    """Vector of the columns with mean 0 and sample deviation 1."""
    scaler = StandardScaler(inputCol="__raw", outputCol=output, withMean=True, withStd=True)
    vectors = assembler(columns, "__raw").transform(df)
    return scaler.fit(vectors).transform(vectors).drop("__raw")


def minmax_scale(df: DataFrame, columns: Sequence[str], output: str = "scaled") -> DataFrame:
    """Vector of the columns scaled to 0..1; a constant column becomes 0.5."""
    vectors = assembler(columns, "__raw").transform(df)
    return MinMaxScaler(inputCol="__raw", outputCol=output).fit(vectors).transform(vectors).drop("__raw")


def binarize(df: DataFrame, column: str, threshold: float, output: str) -> DataFrame:
    return Binarizer(inputCol=column, outputCol=output, threshold=threshold).transform(df)


def impute(df: DataFrame, strategies: Mapping[str, str]) -> DataFrame:
    """Fill nulls by ``mean``, ``median`` (the lower middle value) or ``mode`` (smallest on a tie).

    All means come from one pass, and all medians from the same few passes of radix selection.
    """
    values: dict[str, object] = {}
    means = [c for c, s in strategies.items() if s == "mean"]
    if means:
        values.update(df.agg(*[F.avg(c).alias(c) for c in means]).first().asDict())
    medians = [c for c, s in strategies.items() if s == "median"]
    if medians:
        # One row for each column.
        values.update({r["column"]: r["m"] for r in quantiles_of(df, [], medians, {"m": 0.5}, discrete=True).collect()})
    for column, strategy in strategies.items():
        if strategy == "mode":
            found = mode(df, [], column).first()
            values[column] = found["mode"] if found else None
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None}
    return df.withColumns(filled)


def iqr_bounds(df: DataFrame, column: str) -> tuple[float, float]:
    """First quartile and Q3 + 1.5 IQR."""
    q1, q3 = quantiles(df, [], column, {"q1": 0.25, "q3": 0.75}).first()
    return q1, q3 + 1.5 * (q3 - q1)


def iqr_filter(df: DataFrame, column: str, lower: float) -> DataFrame:
    """Rows between a fixed lower bound and Q3 + 1.5 times the interquartile range."""
    return df.where(F.col(column).between(lower, iqr_bounds(df, column)[1]))


def label_vs_group_mean(train: DataFrame, df: DataFrame, key: str, value: str, label: str) -> DataFrame:
    """1 where the value lies above its group's mean in the training rows. Groups the training rows do
    not have get 0, like a comparison with null."""
    # Written first, so that a hot key can be split in the join (see ordered.attach).
    means = materialise(train.groupBy(key).agg(F.avg(value).alias("group_mean")), "means")
    joined = df.join(means, key, "left")
    return joined.withColumn(label, F.when(F.col(value) > F.col("group_mean"), 1).otherwise(0))


def pca_variance(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Share of variance of each principal component of the standardised columns."""
    scaled = standard_scale(df, columns)
    model = PCA(k=k, inputCol="scaled", outputCol="pca").fit(scaled)
    shares = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    return df.sparkSession.createDataFrame(shares, "component int, share double")


def pca_project(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    scaled = standard_scale(df, columns)
    projected = PCA(k=k, inputCol="scaled", outputCol="pca").fit(scaled).transform(scaled)
    parts = vector_to_array("pca")
    return projected.withColumns({f"pc{i + 1}": F.get(parts, F.lit(i)) for i in range(k)}).drop("scaled", "pca")


def hash_tfidf(df: DataFrame, text: str, buckets: int = 20, output: str = "tfidf") -> DataFrame:
    """Words hashed to a fixed number of buckets, counted and weighted by inverse document frequency."""
    stages = [
        Tokenizer(inputCol=text, outputCol="__words"),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=buckets),
        IDF(inputCol="__tf", outputCol=output),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop("__words", "__tf")


def stage_chain(categories: Sequence[str], numbers: Sequence[str], text: str | None = None) -> Pipeline:
    """Index and encode categories, scale numbers, hash a text column, assemble: fit on training rows,
    applied to both parts."""
    stages = [indexer(categories), encoder(categories), assembler(numbers, "__numbers"),
              MinMaxScaler(inputCol="__numbers", outputCol="numbers_scaled")]
    inputs = [f"{c}_onehot" for c in categories] + ["numbers_scaled"]
    if text is not None:
        stages += [
            Tokenizer(inputCol=text, outputCol="__words"),
            HashingTF(inputCol="__words", outputCol="__tf", numFeatures=20),
            IDF(inputCol="__tf", outputCol="text_tfidf"),
        ]
        inputs.append("text_tfidf")
    return Pipeline(stages=[*stages, assembler(inputs)])


def group_distance(df: DataFrame, centres: DataFrame, key: str, columns: Mapping[str, str], name: str) -> DataFrame:
    """L1 distance to the centre of the row's group: ``columns`` maps a column to its centre column."""
    joined = attach(df, centres, [key])
    parts = [F.abs(F.col(c) - F.col(centre)) for c, centre in columns.items()]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return joined.withColumn(name, total).drop(*columns.values())
