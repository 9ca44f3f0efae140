"""Random samples and train/test splits.

Draws are told by hashes of the rows and a seed, so they don't depend on how a table is laid out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a hash by which rows are counted in a pass, and rows that share such a beginning before it is settled.
DIGIT = 16
SETTLED = 100_000


def _lowest(df: DataFrame, hash_: str, n: int) -> DataFrame:
    """The rows with the n smallest hashes: counts by leading digits give the bound, one filter the rows.

    Rows with the very hash at the bound are cut to the number that is missing.
    """
    low, missing, shift, prefix = -(1 << 63), n, 64, None
    while True:
        shift -= DIGIT
        inside = df if prefix is None else df.where(F.shiftright(hash_, shift + DIGIT) == prefix)
        # At most 2 ** DIGIT rows.
        counts = sorted(tuple(r) for r in inside.groupBy(F.shiftright(hash_, shift).alias("b")).count().collect())
        for begin, count in counts:
            if count >= missing:
                break
            missing -= count
        else:
            return df  # fewer than n rows
        prefix, low = begin, begin << shift
        if count <= SETTLED or not shift:
            break
    # As many hashes as one beginning holds: at most SETTLED, or one.
    last = df.where(F.shiftright(hash_, shift) == prefix).groupBy(hash_).count().collect()
    for value, count in sorted(tuple(r) for r in last):
        if count >= missing:
            break
        missing -= count
    if count == missing:
        return df.where(F.col(hash_) <= value)
    return df.where(F.col(hash_) < value).unionAll(df.where(F.col(hash_) == value).limit(missing))


def sample_n(df: DataFrame, n: int, seed: int, replace: bool = False, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly n rows (fewer only if the table is smaller and rows are not replaced), the same under any layout.

    Rows get a hash of the seed and of ``key``, columns that tell them apart; the n smallest are drawn. Without a key,
    rows alike in all columns are counted first and numbered. With replacement, a row stands for as many copies as a
    Poisson draw from its hash says, each with a hash of its own, and n of these are drawn; given their total, Poisson
    draws are uniform.
    """
    hash_, number = "__hash", "__number"
    if key is None:
        alike = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__times"))
        rows = alike.withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).drop("__times")
        told = [*df.columns, number]
    else:
        rows, told = df, list(key)
    own = F.xxhash64(F.lit(seed), *told)
    if not replace:
        return _lowest(rows.withColumn(hash_, own), hash_, n).select(*df.columns)
    total = df.count()
    if not total or not n:
        return df.limit(0)
    wanted = n + 6 * math.sqrt(n) + 20
    while True:
        draw = F.pmod(F.xxhash64(F.lit(seed + 1), *told), F.lit(1 << 53)) / float(1 << 53)
        copies = F.size(F.filter(_poisson_steps(wanted / total), lambda p: p < draw))
        drawn = rows.withColumn("__copies", copies).where("__copies > 0")
        drawn = drawn.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        drawn = drawn.withColumn(hash_, F.xxhash64(F.lit(seed), *told, "__copy"))
        if drawn.count() >= n:
            return _lowest(drawn, hash_, n).select(*df.columns)
        wanted *= 2  # so few with a chance below 1e-9


def sample_by_key(df: DataFrame, key: str, fractions: Mapping, seed: int, replace: bool = False) -> DataFrame:
    """Per-key fractions; a key that is not listed is left out."""
    if not replace:
        return df.sampleBy(key, dict(fractions), seed)
    steps = F.create_map(*[x for k, rate in fractions.items() for x in (F.lit(k), _poisson_steps(rate))])
    # The number of copies is the number of cumulative probabilities below a uniform draw.
    drawn = df.withColumn("__steps", F.try_element_at(steps, F.col(key))).withColumn("__u", F.rand(seed))
    copies = F.size(F.filter("__steps", lambda p: p < F.col("__u")))
    counted = drawn.where(F.col("__steps").isNotNull()).withColumn("__copies", copies)
    repeated = F.explode(F.array_repeat(F.lit(1), F.col("__copies")))
    return counted.where("__copies > 0").withColumn("__copy", repeated).drop("__steps", "__u", "__copies", "__copy")


def _poisson_steps(rate: float) -> Column:
    """Cumulative Poisson probabilities, up to the point where the rest is below 1e-15."""
    if rate > 700:
        raise ValueError(f"a rate of {rate} is beyond the range of the probabilities")
    term = total = math.exp(-rate)
    steps, k = [total], 0
    while 1 - total > 1e-15:
        k += 1
        term *= rate / k
        if total + term == total and k > rate:
            break
        total += term
        steps.append(total)
    return F.array(*[F.lit(p) for p in steps])


def poisson_draw(rate: float, seed: int) -> Column:
    """How often a row stands in a sample with replacement, drawn anew for every row."""
    # Drawn inside a transform, so that the steps are held against one draw.
    drawn = F.transform(F.array(F.rand(seed)), lambda u: F.size(F.filter(_poisson_steps(rate), lambda p: p < u)))
    return F.get(drawn, F.lit(0))


def mark_random(df: DataFrame, weights: Mapping[str, float], seed: int, key: Sequence[str], part: str = "part") -> DataFrame:
    """Name the part of every row in one column, at random by weight, from a hash of the seed and the key: one scan
    for all parts."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 53)) / float(1 << 53)
    names, bound, marked = list(weights), 0.0, None
    for name in names[:-1]:
        bound += weights[name] / sum(weights.values())
        marked = F.when(draw < bound, name) if marked is None else marked.when(draw < bound, name)
    last = F.lit(names[-1])
    return df.withColumn(part, last if marked is None else marked.otherwise(last))


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """0..buckets-1 from the md5 of the key: the same for a key however the table grows. A null key counts
    as an empty text."""
    c = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % buckets


def mark_split(df: DataFrame, key: str, train_percent: int, part: str = "part") -> DataFrame:
    """Name the part of every row, ``train`` or ``test``, in one column: one scan for both."""
    return df.withColumn(part, F.when(hash_bucket(key) < train_percent, "train").otherwise("test"))


def split_hash(df: DataFrame, key: str, train_percent: int) -> tuple[DataFrame, DataFrame]:
    low = hash_bucket(key) < train_percent
    return df.where(low), df.where(~low)
