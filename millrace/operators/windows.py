"""Series operators: ranks, running and moving means, change to the previous row, outliers.

All go through ``ordered``, so one key with a large share of the rows is worked on in pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import look_back, ranks, running
from millrace.operators.relational import stats_back


def rank_within(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rank and dense rank of a value among the rows of its key."""
    return ranks(df, keys, order)


def running_avg(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean from the first row of the key to the current one."""
    sums = {"__sum": F.col(value), "__n": F.when(F.col(value).isNotNull(), 1).otherwise(0)}
    placed = running(df, keys, order, sums)
    return placed.withColumn(name, F.try_divide("__sum", "__n")).drop("__sum", "__n")


def _mean(value: str, n: int):
    return lambda w: F.avg(value).over(w.rowsBetween(-(n - 1), 0))


def _previous(value: str):
    return lambda w: F.lag(value, 1).over(w)


def moving_avg(df: DataFrame, key: str, time: str, value: str, n: int, name: str = "moving_avg") -> DataFrame:
    """Mean of the last n rows of the key, fewer at its start."""
    return look_back(df, [key], [time], {name: _mean(value, n)}, n - 1)


def percent_change(value: str, previous: str, digits: int = 2) -> Column:
    change = F.try_divide(F.col(value) - F.col(previous), F.col(previous)) * 100
    return F.coalesce(F.round(change, digits), F.lit(0.0))


def lag_change(df: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Previous value and percent change to it; both 0 on the first row."""
    with_previous = look_back(df, [key], [time], {"previous": _previous(value)}, 1)
    return _fill_change(with_previous, value)


def _fill_change(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("change", percent_change(value, "previous")).withColumn(
        "previous", F.coalesce("previous", F.lit(0.0))
    )


def change_with_avg(df: DataFrame, key: str, time: str, value: str, n: int) -> DataFrame:
    """Percent change and moving mean side by side, from one ordering of the rows."""

    columns = {"previous": _previous(value), "moving_avg": _mean(value, n)}
    return _fill_change(look_back(df, [key], [time], columns, n - 1), value)


def zscore_outliers(df: DataFrame, key: str, time: str, value: str, deviations: float = 3.0) -> DataFrame:
    """Rows further than so many sample deviations from the mean of their key, with the percent change."""
    changed = lag_change(df, key, time, value)
    stats = {"mean": F.avg(value), "deviation": F.stddev_samp(value)}
    joined = stats_back(changed, [key], stats)
    far = F.abs(F.col(value) - F.col("mean")) > deviations * F.col("deviation")
    return joined.where(far).drop("mean", "deviation")

