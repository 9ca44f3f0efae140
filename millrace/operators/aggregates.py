"""Grouped and whole-table statistics. Each function reads its input once unless it says otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import attach
from millrace.operators.relational import columns_of_type
from millrace.operators.selection import quantiles
from millrace.session import materialise


def mean_and_count(df: DataFrame, key: str, value: str, at_least: int) -> DataFrame:
    """Mean and row count per key, keeping keys with enough rows."""
    grouped = df.groupBy(key).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    return grouped.where(F.col("n") >= at_least)


def first_last(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """First and last value along a total order."""
    along = F.struct(*order)
    picks = [F.min_by(value, along).alias("first"), F.max_by(value, along).alias("last")]
    return df.groupBy(*keys).agg(*picks) if keys else df.agg(*picks)


def mean_ratio(value: str) -> list[Column]:
    """Count, sum and mean, the mean also as sum over count."""
    return [
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.avg(value).alias("mean"),
        F.expr(f"try_divide(sum({value}), count({value}))").alias("ratio"),
    ]


def collect_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All values per key in long form: the rows of a key are the set, and ``n``, how often each occurs, makes them
    the list. Looks the same at every size; copies are counted before the shuffle, and no array grows with the
    table."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Two-way counts; the listed column values become columns, absent pairs are 0, and rows of any other
    value are counted as ``unlisted``."""
    aggs = [F.count(F.when(F.col(columns) == v, 1)).alias(str(v)) for v in values]
    return df.groupBy(rows).agg(*aggs, _unlisted(columns, values))


def pivot_mean(df: DataFrame, rows: str, columns: str, values: Sequence, value: str, digits: int) -> DataFrame:
    """Mean per row key and listed column value, 0 where there is none; rows of any other value are counted
    as ``unlisted``."""
    means = [F.coalesce(F.round(F.avg(F.when(F.col(columns) == v, F.col(value))), digits), F.lit(0.0)).alias(str(v)) for v in values]
    return df.groupBy(rows).agg(*means, _unlisted(columns, values))


def _unlisted(column: str, values: Sequence) -> Column:
    return F.count(F.when(~F.coalesce(F.col(column).isin(*values), F.lit(False)), 1)).alias("unlisted")


def frequent_candidates(df: DataFrame, column: str, support: float) -> DataFrame:
    """(candidate): every value (or null) that holds more than this share of the rows, and others, from one pass.

    Mergeable counters of the Misra-Gries kind: each task keeps 1 / support of them, whatever it reads.
    """
    found = df.stat.freqItems([column], support).toDF("__items")
    return found.select(F.explode("__items").alias("candidate"))


def frequent_items(df: DataFrame, column: str, support: float) -> DataFrame:
    """Values holding at least this share of the rows, exactly: a pass for candidates, and one that counts only these.

    At most 2 / support values are held anywhere; all other rows are counted as one.
    """
    # Counters for half the share, so that a value with just this share is among the candidates.
    candidates = materialise(frequent_candidates(df, column, support / 2).distinct(), "candidates")
    met = df.select(column).join(F.broadcast(candidates.withColumn("__hit", F.lit(True))), F.col(column).eqNullSafe(F.col("candidate")), "left")
    hit = F.col("__hit").isNotNull()
    counts = met.groupBy(F.when(hit, F.col(column)).alias(column), hit.alias("__hit")).agg(F.count(F.lit(1)).alias("n"))
    # A row for each candidate and one for the rest.
    whole = counts.withColumn("__rows", F.sum("n").over(Window.partitionBy()))
    return whole.where(F.col("__hit") & (F.col("n") >= support * F.col("__rows"))).select(column, "n")


def frequent_items_approx(df: DataFrame, columns: Sequence[str], support: float) -> DataFrame:
    """Candidates for a share of the rows from one pass with a small table; may hold false positives."""
    return df.stat.freqItems(list(columns), support).toDF(*columns)


def unpivot(row: DataFrame, labels: Sequence[str], measures: Sequence[str], label: str) -> DataFrame:
    """Columns named ``<label>__<measure>`` of each row as one row per label."""
    entries = F.array(
        *[F.struct(F.lit(x).alias(label), *[F.col(f"{x}__{m}").alias(m) for m in measures]) for x in labels]
    )
    return row.select(F.explode(entries).alias("e")).select("e.*")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min and max per numeric column, one row per column."""
    names = list(columns or columns_of_type(df, "numeric"))
    aggs = []
    for name in names:
        v = F.col(name).cast("double")
        aggs += [
            F.count(v).alias(f"{name}__n"),
            F.avg(v).alias(f"{name}__mean"),
            F.stddev_samp(v).alias(f"{name}__stddev"),
            F.min(v).alias(f"{name}__min"),
            F.max(v).alias(f"{name}__max"),
        ]
    return unpivot(df.agg(*aggs), names, ["n", "mean", "stddev", "min", "max"], "column")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, one row per column."""
    names = df.columns
    aggs = [F.count(F.when(F.col(f"`{n}`").isNull(), 1)).alias(f"{n}__nulls") for n in names]
    return unpivot(df.agg(*aggs), names, ["nulls"], "column")


def mode(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value that is not null; the smallest one on a tie."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    # min_by over (-n, value): most frequent first, then smallest.
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("b")
    picked = counts.groupBy(*keys).agg(best) if keys else counts.agg(best)
    return picked.select(*keys, F.col("b.v").alias("mode"), (-F.col("b.m")).alias("n"))


def five_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Minimum, quartiles and maximum per group, exact."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return quantiles(df, keys, value, probs)


def approx_quantile(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], accuracy: int) -> DataFrame:
    """Sketched quantiles: rank error at most rows / accuracy."""
    picks = [F.percentile_approx(value, p, accuracy).alias(n) for n, p in probs.items()]
    return df.groupBy(*keys).agg(*picks) if keys else df.agg(*picks)


def corr_by_group(df: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.corr(a, b).alias("r"), F.count(F.lit(1)).alias("n"))


def corr_with_target(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    aggs = [F.corr(c, target).alias(f"{c}__r") for c in columns]
    return unpivot(df.agg(*aggs), columns, ["r"], "column").orderBy(F.col("r").desc(), "column")


def chi_square(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Independence test of every pair of category columns: statistic and degrees of freedom.

    One pass over the rows: each yields one entry per column pair, counted before the shuffle and stored.
    The expected counts come from the sums of that small table.
    """
    pairs = list(combinations(columns, 2))
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y"))
            for a, b in pairs
        ]
    )
    exploded = df.select(F.explode(entries).alias("e")).select("e.*").where("x IS NOT NULL AND y IS NOT NULL")
    cells = materialise(exploded.groupBy("a", "b", "x", "y").agg(F.count(F.lit(1)).alias("o")), "cells")
    # Cells that never occur still carry an expected count E; their (0 - E)^2 / E = E. As all
    # expected counts add up to N, the statistic is sum(o^2 / E) - N over the cells that occur.
    rows = cells.groupBy("a", "b", "x").agg(F.sum("o").alias("row_sum"))
    cols = cells.groupBy("a", "b", "y").agg(F.sum("o").alias("col_sum"))
    shape = (
        rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("nx"), F.sum("row_sum").alias("total"))
        .join(cols.groupBy("a", "b").agg(F.count(F.lit(1)).alias("ny")), ["a", "b"])
    )
    parts = cells.join(rows, ["a", "b", "x"]).join(cols, ["a", "b", "y"])
    share = F.sum(F.col("o") * F.col("o") / (F.col("row_sum") * F.col("col_sum"))).alias("share")
    return (
        parts.groupBy("a", "b").agg(share)
        .join(shape, ["a", "b"])
        .select(
            "a", "b",
            (F.col("total") * (F.col("share") - 1)).alias("statistic"),
            ((F.col("nx") - 1) * (F.col("ny") - 1)).alias("dof"),
        )
    )


def chi_square_p(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same test with its p-value, by the library: one pass for each column against all after it."""
    known = df.select(*columns).dropna()
    indexed = StringIndexer(inputCols=list(columns), outputCols=[f"__{c}" for c in columns]).fit(known).transform(known)
    rows = materialise(indexed.select(*[f"__{c}" for c in columns]), "indexed")
    tests = []
    for i, label in enumerate(columns[:-1]):
        others = list(columns[i + 1 :])
        vectors = VectorAssembler(inputCols=[f"__{c}" for c in others], outputCol="__features").transform(rows)
        names = F.element_at(F.array(*[F.lit(c) for c in others]), F.col("featureIndex") + 1)
        found = ChiSquareTest.test(vectors, "__features", f"__{label}", True)
        tests.append(found.select(
            F.lit(label).alias("a"), names.alias("b"), "statistic", F.col("degreesOfFreedom").cast("long").alias("dof"),
            F.col("pValue").alias("p_value"),
        ))
    return reduce(DataFrame.unionByName, tests)


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int) -> DataFrame:
    """Equal-width bins per group between its smallest and largest value; the last bin is closed."""
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    bounds = known.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    if keys:
        joined = attach(known, bounds, keys)
    else:
        lo, hi = bounds.first()
        joined = known.withColumns({"lo": F.lit(lo), "hi": F.lit(hi)})
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / F.nullif(width, F.lit(0.0)))))
    numbered = joined.withColumn("bin", F.coalesce(place, F.lit(0)).cast("int"))
    counts = numbered.groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    start = F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins
    return counts.select(*keys, "bin", start.alias("bin_start"), "n")


def reduce_by_key(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Per-key sum. Group-then-reduce, reduce, aggregate and fold are this one plan: partial sums
    before the shuffle, final sums after it."""
    return df.groupBy(key).agg(F.sum(value).alias("total"))


def longest(df: DataFrame, word: str) -> DataFrame:
    """The longest word; among equals, the last in order."""
    return df.agg(F.max_by(word, F.struct(F.length(word), F.col(word))).alias("word"))


