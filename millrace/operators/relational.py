"""Projections, filters, joins, sorting, top-k and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import attach, order_columns
from millrace.session import materialise


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``string`` or ``numeric`` columns."""
    wanted = {"string": T.StringType, "numeric": T.NumericType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def select_type(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*columns_of_type(df, kind))


def add_rename_drop(
    df: DataFrame,
    add: Mapping[str, Column] | None = None,
    rename: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """All additions in one projection, then renames, then drops."""
    return df.withColumns(dict(add or {})).withColumnsRenamed(dict(rename or {})).drop(*drop)


def encode_flag(column: str | Column, true: str = "t") -> Column:
    """1 for the true mark, 0 for anything else; null stays null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c == true, 1).when(c.isNotNull(), 0)


def clamp_upper(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Cap columns at a maximum; null stays null."""
    return df.withColumns(
        {n: F.when(F.col(n) > top, F.lit(top)).otherwise(F.col(n)) for n, top in limits.items()}
    )


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, increasing within a partition; not consecutive and not stable between runs."""
    return df.withColumn(name, F.monotonically_increasing_id())


def partition_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).count()


def join_array_contains(left: DataFrame, array: str, right: DataFrame, key: str) -> DataFrame:
    """Rows of both sides where the left array holds the right key.

    Written as explode plus equi-join, since ``array_contains`` in a join condition is a nested loop.
    """
    element = "__element"
    return (
        left.withColumn(element, F.explode(F.array_distinct(array)))
        .join(right, F.col(element) == right[key])
        .drop(element)
    )


#: A key with more than 1/HOT of a side's rows is joined apart, however many partitions are asked for.
HOT = 1000


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """(key): every key holding more than 1/HOT of the rows, among at most HOT keys, from one pass."""
    found = df.stat.freqItems([key], 1 / HOT).toDF("__items")
    return found.select(F.explode("__items").alias(key)).where(F.col(key).isNotNull())


def _fragments(df: DataFrame, own: str, n: int, other: str, copies: int) -> DataFrame:
    """Deal the rows over ``n`` fragments, and send a copy of each to every fragment of the other side."""
    dealt = df.withColumn(own, F.pmod(F.monotonically_increasing_id(), F.lit(n)).cast("int"))
    return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def join_partitioned(left: DataFrame, right: DataFrame, key: str, parts: int) -> DataFrame:
    """Inner join of key-value frames in a chosen number of partitions.

    Adaptive execution does not touch partitions the caller asked for. So keys that are frequent on either side are
    joined apart, by fragments and replicas: a key that is hot on one side is dealt over ``parts`` fragments there,
    each of which meets a copy of the other side's few rows; one hot on both sides is dealt into a grid of about
    ``parts`` cells, each of which joins one fragment of either side.
    """
    sides = materialise(
        hot_keys(left, key).select(key, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
        .unionByName(hot_keys(right, key).select(key, F.lit(0).alias("__l"), F.lit(1).alias("__r")))
        .groupBy(key).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r")),
        "hot-keys",
    )
    # At most 2 * HOT keys by construction, so the hint is safe.
    hot = F.broadcast(sides)
    joined = left.join(hot, key, "left_anti").repartition(parts, key).join(right.join(hot, key, "left_anti").repartition(parts, key), key)
    side = max(2, ceil(sqrt(parts)))
    for where, rows, columns in (("__l = 1 AND __r = 0", parts, 1), ("__l = 0 AND __r = 1", 1, parts), ("__l = 1 AND __r = 1", side, side)):
        some = F.broadcast(sides.where(where).select(key))
        a = _fragments(left.join(some, key, "left_semi"), "__a", rows, "__b", columns)
        b = _fragments(right.join(some, key, "left_semi"), "__b", columns, "__a", rows)
        joined = joined.unionByName(a.join(b, [key, "__a", "__b"]).drop("__a", "__b"))
    return joined


def densify(df: DataFrame, key: str, values: Sequence[str], fill: int = 0) -> DataFrame:
    """Every whole number between the smallest and largest key, gaps filled.

    Only the two bounds reach the driver; the spine is a distributed range.
    """
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    spine = df.sparkSession.range(0 if lo is None else lo, 0 if lo is None else hi + 1)
    named = spine.select(F.col("id").cast(df.schema[key].dataType).alias(key))
    filled = {v: F.coalesce(F.col(v), F.lit(fill)) for v in values}
    return named.join(df, key, "left").withColumns(filled)


def stats_back(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Join per-group statistics to every row (null-safe on the keys; see ``attach`` for hot keys)."""
    return attach(df, df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()]), keys)


def label_names(df: DataFrame, column: str, names: Mapping[int, str], to: str) -> DataFrame:
    """Replace label ids by names; ids outside the map become null."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return df.withColumn(to, F.element_at(F.create_map(*pairs), F.col(column)))


def top_k(df: DataFrame, k: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_columns(order)).limit(k)


def top_k_per_group(df: DataFrame, keys: Sequence[str], k: int, order: Sequence[str]) -> DataFrame:
    """The k first rows of each key. The rank filter is applied before the shuffle as well, so no
    more than k rows per key and input partition move."""
    window = Window.partitionBy(*keys).orderBy(*order_columns(order))
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_letter_flag(df: DataFrame, word: str, letter: str) -> DataFrame:
    return df.select(
        word,
        F.substring(word, 1, 1).alias("first_letter"),
        F.startswith(F.col(word), F.lit(letter)).alias("starts_with"),
    )
