"""Number expressions; division by zero and bad input give null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.strings import col


def parse_percent(text: str | Column) -> Column:
    """``"95%"`` to 0.95; null when it is no number."""
    return F.regexp_replace(col(text), "%", "").try_cast("double") / 100


def parse_price(text: str | Column) -> Column:
    """``"$1,200.50"`` to 1200.5; null when it is no number."""
    return F.regexp_replace(col(text), "[$,]", "").try_cast("double")


def ratio(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(col(a), col(b))


def occupancy(available: str | Column, horizon: float) -> Column:
    return 1 - col(available) / horizon


def manhattan(x: str | Column, y: str | Column, centre_x: Column, centre_y: Column) -> Column:
    return F.abs(col(x) - centre_x) + F.abs(col(y) - centre_y)


def cents(column: str) -> Column:
    """Money as a whole number of cents. Sums of these don't depend on the order of adding."""
    return F.round(F.col(column) * 100).cast("long")


def cents_sql(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def mean_of_cents(total: str, n: str) -> Column:
    """Mean in whole money, rounded half up to 4 digits in whole numbers; null without rows."""
    return F.floor((F.col(total).cast("decimal(30,0)") * 200 + F.col(n)) / (F.col(n) * 2)).cast("long") / F.lit(10000.0)


def mean_of_cents_sql(total: str, n: str) -> str:
    return f"CAST(floor((CAST({total} AS HUGEINT) * 200 + {n}) // (2 * {n})) AS BIGINT) / 10000::DOUBLE"
