"""Missing values: drop, fill and replace."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.relational import columns_of_type


def drop_null(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how=how, subset=list(subset) if subset else None)


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill per column; a value of another type than its column changes nothing."""
    return df.fillna(dict(values))


def replace_values(df: DataFrame, column: str, old: Sequence, new: Sequence) -> DataFrame:
    return df.replace(list(old), list(new), subset=[column])


def tokens_to_null(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Placeholder strings become null in every string column."""
    names = columns_of_type(df, "string")
    return df.withColumns({n: F.when(~F.col(n).isin(list(tokens)), F.col(n)) for n in names})
