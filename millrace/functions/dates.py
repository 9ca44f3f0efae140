"""Date expressions. Weekdays run from Sunday 0 to Saturday 6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.strings import col


def weekday(date: str | Column) -> Column:
    return F.dayofweek(col(date)) - 1


def month_start(date: str | Column) -> Column:
    return F.trunc(col(date), "MM")


def with_load_stamp(df: DataFrame) -> DataFrame:
    """Date and time of the run, one value for the whole query."""
    return df.withColumns({"load_date": F.current_date(), "load_time": F.current_timestamp()})


def parse_day(text: str | Column, pattern: str) -> Column:
    """Date of a string, null when it does not fit the pattern."""
    return F.to_date(F.try_to_timestamp(col(text), F.lit(pattern)))
