"""Structs, arrays, maps and vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.strings import col


def element(array: str | Column, index: int) -> Column:
    """0-based element, null when the array is shorter."""
    return F.get(col(array), F.lit(index))


def as_vector(array: str | Column) -> Column:
    return array_to_vector(col(array).cast("array<double>"))


def vector_elements(vector: str | Column, count: int, prefix: str = "x") -> list[Column]:
    values = vector_to_array(col(vector))
    return [F.get(values, F.lit(i)).alias(f"{prefix}{i}") for i in range(count)]


def index_of_max(array: str | Column) -> Column:
    """0-based place of the largest element, the first one on a tie."""
    return F.array_position(col(array), F.array_max(col(array))) - 1


def look_up(key: str | Column, table: Mapping, default=None) -> Column:
    """Value of a small constant table, ``default`` for other keys."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def index_words(indices: str | Column, vocabulary: Sequence[str]) -> Column:
    """Array of places to array of words."""
    listed = F.array(*[F.lit(w) for w in vocabulary])
    return F.transform(col(indices), lambda i: F.get(listed, i))


def multi_hot_array(array: str | Column, vocabulary: Sequence[str]) -> Column:
    return F.array(*[F.array_contains(col(array), w).cast("int") for w in vocabulary])
