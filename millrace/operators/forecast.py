"""Forecasts per series: a trend times weekday and month factors, natively or by a fit per group.

The rows are summed to one per series and day before anything else, with a combine before the
shuffle. So a series never has more rows than the calendar has days, however many rows of the table
belong to it, and windows and grouped functions over a series stay small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.dates import weekday
from millrace.sources.files import insert_partitioned

HORIZON = 90
# Fixed value: two-sided 95 % quantile of the normal distribution.
Z95 = 1.96

#: Changepoints of a trend at most, days of history for each, and the share of the history they lie in.
CHANGEPOINTS = 25
DAYS_A_CHANGEPOINT = 30
CHANGE_SHARE = 0.8
CHANGE_PENALTY = 0.01

FORECAST_COLUMNS = ["ds", "y", "yhat", "yhat_upper", "yhat_lower"]


def history(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Daily sums per series: ``keys, ds, y``."""
    return df.groupBy(*keys, F.to_date(time).alias("ds")).agg(F.sum(value).alias("y"))


def future_frame(hist: DataFrame, keys: Sequence[str], days: int = HORIZON) -> DataFrame:
    """History plus the given number of days after each series' last date, those with null ``y``.

    The last row of a series is repeated forward; there is no second read and no join.
    """
    marked = hist.withColumn("__last", F.max("ds").over(Window.partitionBy(*keys)))
    ahead = F.when(F.col("ds") == F.col("__last"), F.lit(days)).otherwise(0)
    spread = marked.withColumn("__step", F.explode(F.sequence(F.lit(0), ahead)))
    return spread.select(
        *keys,
        F.date_add("ds", F.col("__step")).alias("ds"),
        F.when(F.col("__step") == 0, F.col("y")).alias("y"),
    )


def _fit(hist: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """Trend and factors next to every date. All windows start with the series keys, so one shuffle
    by series serves them all."""
    series = Window.partitionBy(*keys)
    frame = future_frame(hist, keys, days)
    started = frame.withColumn("__first", F.min("ds").over(series))
    dated = started.withColumn("t", F.datediff("ds", "__first").cast("double"))
    known_t = F.when(F.col("y").isNotNull(), F.col("t"))
    trended = dated.withColumn(
        "trend",
        F.regr_intercept("y", known_t).over(series) + F.regr_slope("y", known_t).over(series) * F.col("t"),
    )
    parts = trended.withColumns({"weekday": weekday("ds"), "month": F.month("ds"), "ratio": F.try_divide("y", "trend")})
    by_day = Window.partitionBy(*keys, "weekday")
    with_day = parts.withColumn("weekday_factor", F.coalesce(F.avg("ratio").over(by_day), F.lit(1.0)))
    by_month = Window.partitionBy(*keys, "month")
    left = F.try_divide("ratio", "weekday_factor")
    return with_day.withColumn("month_factor", F.coalesce(F.avg(left).over(by_month), F.lit(1.0)))


def seasonal(hist: DataFrame, keys: Sequence[str], days: int = HORIZON) -> DataFrame:
    """Forecast with a 95 % band for history and future dates: ``keys, ds, y, yhat, yhat_upper, yhat_lower``."""
    yhat = F.col("trend") * F.col("weekday_factor") * F.col("month_factor")
    fitted = _fit(hist, keys, days).withColumn("yhat", yhat)
    spread = Z95 * F.stddev_samp(F.col("y") - F.col("yhat")).over(Window.partitionBy(*keys))
    banded = fitted.withColumn("__band", F.coalesce(spread, F.lit(0.0)))
    return banded.select(
        *keys, "ds", "y", "yhat",
        (F.col("yhat") + F.col("__band")).alias("yhat_upper"),
        (F.col("yhat") - F.col("__band")).alias("yhat_lower"),
    )


def components(hist: DataFrame, keys: Sequence[str], days: int = HORIZON) -> DataFrame:
    """The fitted parts in long form: trend per date, factor per weekday, factor per month."""
    fitted = _fit(hist, keys, days)
    name = F.lit
    parts = [
        fitted.select(*keys, name("trend").alias("part"), F.col("ds").cast("string").alias("at"), F.col("trend").alias("value")),
        fitted.select(*keys, name("weekday").alias("part"), F.col("weekday").cast("string").alias("at"), F.col("weekday_factor").alias("value")).distinct(),
        fitted.select(*keys, name("month").alias("part"), F.col("month").cast("string").alias("at"), F.col("month_factor").alias("value")).distinct(),
    ]
    return reduce(DataFrame.unionByName, parts)


def _design(days: np.ndarray) -> np.ndarray:
    """Columns: constant, slope, weekly waves (3 pairs), yearly waves (4 pairs)."""
    columns = [np.ones_like(days), days / 365.25]
    for period, pairs in ((7.0, 3), (365.25, 4)):
        for k in range(1, pairs + 1):
            angle = 2 * np.pi * k * days / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def _bends(days: np.ndarray, last: float) -> np.ndarray:
    """Columns that are 0 up to a changepoint and rise from there; changepoints lie evenly in the first part of the history."""
    count = int(min(CHANGEPOINTS, last // DAYS_A_CHANGEPOINT))
    at = np.linspace(0, CHANGE_SHARE * last, count + 1)[1:]
    return np.maximum(0.0, days[:, None] - at[None, :]) / max(last, 1.0)


def _forecast_group(pdf: pd.DataFrame, keys: Sequence[str], days: int) -> pd.DataFrame:
    """Least squares on the values, with the history and the days after it.

    The trend is piecewise linear: its slope may change at evenly spaced days, with a small penalty on the square of each
    change, and goes on as it last was. Over two years or more the seasons multiply the trend: every wave also comes times the slope. The fit is
    linear in the values, so zeros and negative values are values like others. A series without any value
    has no forecast.
    """
    known = pdf.dropna(subset=["y"]).sort_values("ds")
    if known.empty:
        return pd.DataFrame({c: pd.Series(dtype=object if c in ("ds", *keys) else "Float64") for c in [*keys, *FORECAST_COLUMNS]})
    dates = pd.to_datetime(known["ds"])
    start = dates.iloc[0]
    ahead = pd.date_range(dates.iloc[-1] + pd.Timedelta(days=1), periods=days, freq="D")
    every = pd.DatetimeIndex(dates).append(ahead)
    t = (every - start).days.to_numpy(dtype=float)
    level = known["y"].to_numpy(dtype=float)
    design = _design(t)
    if t[len(known) - 1] >= 2 * 365.25:
        design = np.column_stack([design, design[:, 2:] * design[:, 1:2]])
    bends = _bends(t, t[len(known) - 1])
    whole = np.column_stack([design, bends])
    # The penalty as rows of their own, in units of the series' size.
    size = max(float(np.abs(level).max()), 1e-12)
    penalty = np.column_stack([np.zeros((bends.shape[1], design.shape[1])), np.sqrt(CHANGE_PENALTY) * np.eye(bends.shape[1])])
    left = np.concatenate([whole[: len(known)], penalty])
    weights, *_ = np.linalg.lstsq(left, np.concatenate([level / size, np.zeros(bends.shape[1])]), rcond=None)
    fitted = size * (whole @ weights)
    rest = level - fitted[: len(known)]
    band = Z95 * (rest.std(ddof=1) if len(rest) > 1 else 0.0)
    out = pd.DataFrame(
        {
            "ds": every.date,
            # A nullable column: future dates have no value rather than NaN.
            "y": pd.array([*known["y"].to_numpy(dtype=float), *[None] * days], dtype="Float64"),
            "yhat": fitted,
            "yhat_upper": fitted + band,
            "yhat_lower": fitted - band,
        }
    )
    for key in keys:
        out[key] = known[key].iloc[0]
    return out[[*keys, *FORECAST_COLUMNS]]


def grouped_map(hist: DataFrame, keys: Sequence[str], days: int = HORIZON) -> DataFrame:
    """The same output from a model fitted per series in Python, one series per call."""
    names = {f.name: f.dataType.simpleString() for f in hist.schema.fields}
    kinds = [f"{k} {names[k]}" for k in keys] + ["ds date"] + [f"{c} double" for c in FORECAST_COLUMNS[1:]]
    wanted = list(keys)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return _forecast_group(pdf, wanted, days)

    return hist.groupBy(*keys).applyInPandas(fit, ", ".join(kinds))


def evaluate(forecast: DataFrame, keys: Sequence[str], before: str | None = None) -> DataFrame:
    """mae, mse and rmse per series over dates that have an actual value."""
    rows = forecast.where(F.col("y").isNotNull())
    rows = rows if before is None else rows.where(F.col("ds") < F.lit(before).cast("date"))
    error = F.col("y") - F.col("yhat")
    scored = rows.groupBy(*keys).agg(F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"))
    return scored.withColumn("rmse", F.sqrt("mse"))


def evaluate_grouped(forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same metrics from a function on each group, for callers who bring their own metric."""
    names = {f.name: f.dataType.simpleString() for f in forecast.schema.fields}
    wanted = list(keys)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        error = (pdf["y"] - pdf["yhat"]).to_numpy()
        mse = float(np.mean(error * error))
        row = {k: [pdf[k].iloc[0]] for k in wanted}
        return pd.DataFrame({**row, "mae": [float(np.mean(np.abs(error)))], "mse": [mse], "rmse": [mse**0.5]})

    schema = ", ".join([f"{k} {names[k]}" for k in wanted] + ["mae double", "mse double", "rmse double"])
    # Only what the metric needs travels to Python.
    rows = forecast.where(F.col("y").isNotNull()).select(*wanted, "y", "yhat")
    return rows.groupBy(*wanted).applyInPandas(score, schema)


def store(forecast: DataFrame, keys: Sequence[str], trained: Column, name: str, path: str) -> None:
    """Append a forecast to the table ``name`` at ``path``, partitioned by training date."""
    renames = {k: k for k in keys} | {
        "ds": "date", "y": "sales", "yhat": "sales_predicted", "yhat_upper": "sales_predicted_upper",
        "yhat_lower": "sales_predicted_lower", "training_date": "training_date",
    }
    insert_partitioned(forecast.withColumn("training_date", trained), name, path, renames, "training_date")
