"""Exact quantiles by radix selection: no sort, no stored rows, every column, group and probability at once.

Values become integers of the same order. A pass counts the rows of every group by the leading digit; the digit in
which a wanted place lies, and the place within it, go on to the next pass, which counts only rows with such
beginnings by their next digit. It ends when every wanted beginning holds one value. What is stored between passes
is one row for each group and place; what is shuffled are counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import join_groups
from millrace.session import materialise

#: Bits of a digit, so that a group has at most 65 536 counts in a pass.
DIGIT = 16
BITS = 64

_SMALLEST = 2.0**-1022
_MANTISSA = 52


def order_key(value: Column) -> Column:
    """A 64-bit integer that orders doubles as Spark does: -0.0 equals 0.0, NaN comes last. Null stays null.

    Sign times the exponent and the bits behind the leading one, as they stand in a double.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    # The logarithm is rounded; one step either way puts it right.
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(power > size, -1).when(power * 2 <= size, 1).otherwise(0)
    normal = (exponent + 1023) * (1 << _MANTISSA) + ((size / F.pow(F.lit(2.0), exponent) - 1) * float(1 << _MANTISSA)).cast("long")
    tiny = (size * 2.0**537 * 2.0**537).cast("long")
    infinite = F.lit(2047 << _MANTISSA)
    key = (
        F.when(F.isnan(value), infinite + 1).when(size == 0, 0).when(size == float("inf"), infinite)
        .when(size < _SMALLEST, tiny).otherwise(normal).cast("long")
    )
    return F.when(value.isNotNull(), F.when(value < 0, -key).otherwise(key))


def key_value(key: Column) -> Column:
    """The double that ``order_key`` made the integer of."""
    size = F.abs(key)
    exponent, rest = F.shiftright(size, _MANTISSA), size.bitwiseAND(F.lit((1 << _MANTISSA) - 1)).cast("double")
    normal = F.pow(F.lit(2.0), exponent - 1023) * (1 + rest / float(1 << _MANTISSA))
    value = (
        F.when((exponent == 2047) & (rest > 0), float("nan")).when(exponent == 2047, float("inf"))
        .when(exponent == 0, rest * 2.0**-537 * 2.0**-537).otherwise(normal)
    )
    return F.when(key < 0, -value).otherwise(value)


def select(df: DataFrame, keys: Sequence[str], columns: Sequence[str], places: Mapping[str, Column]) -> DataFrame:
    """(keys, __column, __place, __value, __count): the values in 0-based places of each group's sorted values, nulls left out.

    ``places`` give a place as an expression of ``__size``, the number of values. Groups without values have no row.
    """
    each = F.array(*[F.struct(F.lit(c).alias("__column"), order_key(F.col(c).cast("double")).alias("__key")) for c in columns])
    rows = df.select(*keys, F.inline(each)) if len(columns) > 1 else df.select(*keys, F.lit(columns[0]).alias("__column"), order_key(F.col(columns[0]).cast("double")).alias("__key"))
    rows = rows.where("__key IS NOT NULL")
    group = [*keys, "__column"]
    asked = F.array(*[F.struct(F.lit(n).alias("__place"), p.cast("long").alias("__rest")) for n, p in places.items()])
    found = None
    for shift in range(BITS - DIGIT, -1, -DIGIT):
        begin = F.shiftright("__key", shift)
        if found is None:
            counted, by = rows, [*group]
        else:
            # As many beginnings as groups and places, at most.
            wanted = found.where("__low <> __high").select(*group, F.col("__digit").alias("__begin")).distinct()
            counted, by = join_groups(rows.withColumn("__begin", F.shiftright("__key", shift + DIGIT)), wanted, [*group, "__begin"]), [*group, "__begin"]
        counts = counted.groupBy(*by, begin.alias("__digit")).agg(F.count(F.lit(1)).alias("__n"), F.min("__key").alias("__low"), F.max("__key").alias("__high"))
        # At most 2 ** DIGIT rows for each beginning.
        along = Window.partitionBy(*by).orderBy("__digit")
        upto = counts.withColumn("__upto", F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        if found is None:
            whole = upto.withColumn("__size", F.sum("__n").over(Window.partitionBy(*by)))
            sought = whole.withColumn("__asked", F.explode(asked)).select("*", "__asked.__place", "__asked.__rest")
        else:
            open_ = found.where("__low <> __high").select(*group, "__place", "__size", "__rest", F.col("__digit").alias("__begin"))
            sought = join_groups(upto, open_, by)
        here = (F.col("__rest") < F.col("__upto")) & (F.col("__rest") >= F.col("__upto") - F.col("__n"))
        hit = sought.where(here).select(*group, "__place", "__size", (F.col("__rest") - F.col("__upto") + F.col("__n")).alias("__rest"), "__digit", "__low", "__high")
        found = materialise(hit if found is None else hit.unionByName(found.where("__low = __high")), "selected")
        if not found.where("__low <> __high").head(1):
            break
    return found.select(*group, "__place", key_value(F.col("__low")).alias("__value"), F.col("__size").alias("__count"))


def quantiles_of(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Mapping[str, float], discrete: bool = False) -> DataFrame:
    """(keys, column, one column per probability): exact quantiles of several columns, nulls left out.

    Interpolated, or with ``discrete`` the first value whose share of rows reaches the probability.
    """
    size, places = F.col("__size"), {}
    for i, p in enumerate(probs.values()):
        if discrete:
            places[f"lo{i}"] = F.greatest(F.ceil(F.lit(float(p)) * size) - 1, F.lit(0))
        else:
            places |= {f"lo{i}": F.floor(F.lit(float(p)) * (size - 1)), f"hi{i}": F.ceil(F.lit(float(p)) * (size - 1))}
    values = select(df, keys, columns, places)
    picks = [F.max(F.when(F.col("__place") == n, F.col("__value"))).alias(f"__{n}") for n in places]
    wide = values.groupBy(*keys, "__column").agg(F.max("__count").alias("__size"), *picks)
    outputs = []
    for i, (name, p) in enumerate(probs.items()):
        place, low = F.lit(float(p)) * (size - 1), F.col(f"__lo{i}")
        value = low if discrete else low + (place - F.floor(place)) * (F.col(f"__hi{i}") - low)
        outputs.append(value.alias(name))
    return wide.select(*keys, F.col("__column").alias("column"), *outputs)


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], discrete: bool = False) -> DataFrame:
    """Exact quantiles per key, one output column per probability; without keys one row, of nulls if there is no value."""
    found = quantiles_of(df, keys, [value], probs, discrete).drop("column")
    if keys:
        return found
    return found.agg(*[F.first(n).alias(n) for n in probs])
