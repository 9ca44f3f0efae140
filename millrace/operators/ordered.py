"""Ordered work per key (running sums, positions, look-back, ranks).

A window keeps each key in one task, which breaks when one key holds a third of a large table. So keys with very
many rows are cut into chunks along their order. Where to cut comes from a sample of those keys' rows and is kept as a
small table; a row's chunk is computed from it wherever the row is read, and no row is stored. A table with one row
for each chunk that a key goes on in supplies what came before it. All other keys are one chunk each, a plain window.

Order columns are names; a leading ``-`` means descending. The list should be a total order within a
key: rows equal in all of it end up in one chunk. Null comes first, or last if descending. Frames are read several
times: give a scan or a stored table, or one that is cheap to make again and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.session import materialise

#: A key with no more rows than this is never cut.
CHUNK_ROWS = 100_000
#: Chunks of cut keys for each shuffle partition, at most; several, so that hashing them deals evenly.
CHUNKS_PER_PARTITION = 4
#: Sampled rows for each chunk.
SAMPLE = 32
#: Rows in a block of consecutive positions when looking back.
BLOCK = 100_000

_CHUNK = "__chunk"
_ROW = "__row"
_POS = "__pos"
_BLOCK = "__block"
_HOME = "__home"
_CUTS = "__cuts"


def order_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]


def chunk_count(spark: SparkSession) -> int:
    return CHUNKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """(keys, __cuts): for each key with very many rows, the order values of the rows after which it is cut.

    None where there is no such key. At most ``chunk_count`` cuts in all, so the table can be broadcast.
    """
    spark = df.sparkSession
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > CHUNK_ROWS)
    large = materialise(sizes, "large")
    rows = large.agg(F.sum("__n")).first()[0]
    if not rows:
        return None
    each = max(CHUNK_ROWS, -(-rows // chunk_count(spark)))
    cut_keys = large.where(F.col("__n") > each).drop("__n")
    named = [o.lstrip("-") for o in order]
    # Fewer keys than chunks.
    some = join_groups(df.select(*keys, *[c for c in dict.fromkeys(named) if c not in keys]), F.broadcast(cut_keys), keys) if keys else df
    drawn = some.where(F.rand(7) < SAMPLE / each)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_columns(order)))
    kept = drawn.withColumn(_ROW, place).where(F.col(_ROW) % SAMPLE == 0)
    values = [F.col(c).alias(f"o{i}") for i, c in enumerate(named)]
    listed = F.array_sort(F.collect_list(F.struct(_ROW, F.struct(*values).alias("at"))))
    return materialise(kept.groupBy(*keys).agg(F.transform(listed, lambda x: x["at"]).alias(_CUTS)), "cuts")


def _upto(cut: Column, order: Sequence[str]) -> Column:
    """True where the cut's order values are those of the row or come before them."""
    holds = F.lit(True)
    for i, name in reversed(list(enumerate(order))):
        a, b = cut[f"o{i}"], F.col(name.lstrip("-"))
        if name.startswith("-"):
            before = (a.isNotNull() & b.isNull()) | F.coalesce(a > b, F.lit(False))
        else:
            before = (a.isNull() & b.isNotNull()) | F.coalesce(a < b, F.lit(False))
        holds = before | (a.eqNullSafe(b) & holds)
    return holds


def with_chunk(df: DataFrame, keys: Sequence[str], order: Sequence[str], known: DataFrame) -> DataFrame:
    """Add the number of the row's chunk within its key, null for keys that are not cut: a search among its key's cuts."""
    if keys:
        renamed = known.withColumnsRenamed({k: f"__r_{k}" for k in keys})
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        met = df.join(F.broadcast(renamed), same, "left").drop(*[f"__r_{k}" for k in keys])
    else:
        # One row.
        met = df.join(F.broadcast(known), F.lit(True), "left")
    size = F.size(_CUTS)

    def halve(state: Column, _step: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"], 1)
        passed = (state["low"] < state["high"]) & _upto(F.get(F.col(_CUTS), middle), order)
        return F.struct(
            F.when(passed, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(passed | (state["low"] >= state["high"]), state["high"]).otherwise(middle).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.ceil(F.log2(size + 1)).cast("int") + 1)
    begin = F.struct(F.lit(0).alias("low"), size.alias("high"))
    return met.withColumn(_CHUNK, F.when(F.col(_CUTS).isNotNull(), F.aggregate(steps, begin, halve, lambda s: s["low"]))).drop(_CUTS)


def join_groups(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner equi-join on columns of the same name where null matches null."""
    renamed = right.withColumnsRenamed({n: f"__r_{n}" for n in names})
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(f"__r_{name}"))
    return left.join(renamed, condition).drop(*[f"__r_{n}" for n in names])


def attach(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give every row the columns of its key's one row in ``groups`` (null matches null).

    The group table is written and read back. Joined straight from its aggregate, it would share the
    aggregate's shuffle, and adaptive execution splits a hot key only between two plain shuffles. The
    size on file also tells it whether to broadcast instead.
    """
    return join_groups(df, materialise(groups, "groups"), keys)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Add inclusive running sums per key, row by row. ``F.lit(1)`` gives the 1-based position."""
    return _running(df, keys, order, sums, cuts(df, keys, order))


def _running(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column], known: DataFrame | None) -> DataFrame:
    upto = (Window.unboundedPreceding, Window.currentRow)
    if known is None:
        window = Window.partitionBy(*keys).orderBy(*order_columns(order)).rowsBetween(*upto)
        return df.withColumns({n: F.sum(c).over(window) for n, c in sums.items()})
    rows = with_chunk(df, keys, order, known).withColumns({f"__v_{n}": c for n, c in sums.items()})
    totals = rows.where(F.col(_CHUNK).isNotNull()).groupBy(*keys, _CHUNK).agg(*[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in sums])
    along = Window.partitionBy(*keys).orderBy(_CHUNK)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumns({f"__v_{n}": F.sum(f"__v_{n}").over(before) for n in sums} | {_ROW: F.row_number().over(along)})
    # What came before a chunk enters as a row in front of it, so the rows are shuffled once and joined
    # to nothing. Only keys that go on from one chunk to the next have such rows: at most one a chunk.
    carry = carry.where(F.col(_ROW) > 1).withColumn(_ROW, F.lit(0))
    merged = rows.withColumn(_ROW, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    window = Window.partitionBy(*keys, _CHUNK).orderBy(_ROW, *order_columns(order)).rowsBetween(*upto)
    done = merged.withColumns({n: F.sum(f"__v_{n}").over(window) for n in sums}).where(F.col(_ROW) == 1)
    return done.drop(_CHUNK, _ROW, *[f"__v_{n}" for n in sums])


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    rows: int,
    block: int = BLOCK,
) -> DataFrame:
    """Window columns that read at most ``rows`` earlier rows of the key (lag, moving average).

    A key with very many rows is cut by position into blocks of ``block`` rows; the last ``rows`` rows of a block are
    also handed to the next one, and the copies are dropped afterwards.
    """
    known = cuts(df, keys, order)
    if known is None:
        window = Window.partitionBy(*keys).orderBy(*order_columns(order))
        return df.withColumns({name: make(window) for name, make in columns.items()})
    block = max(block, rows, 1)
    placed = _running(df, keys, order, {_POS: F.lit(1)}, known)
    at = F.floor((F.col(_POS) - 1) / block).cast("long")
    tail = (F.col(_POS) - 1) % block >= block - rows
    copies = F.when(tail, F.array(F.col(_HOME), F.col(_HOME) + 1)).otherwise(F.array(F.col(_HOME)))
    spread = placed.withColumn(_HOME, at).withColumn(_BLOCK, F.explode(copies))
    window = Window.partitionBy(*keys, _BLOCK).orderBy(_POS)
    done = spread.withColumns({name: make(window) for name, make in columns.items()})
    return done.where(F.col(_HOME) == F.col(_BLOCK)).drop(_POS, _HOME, _BLOCK)


def ranks(df: DataFrame, keys: Sequence[str], order: str, rank: str = "rank", dense: str = "dense_rank") -> DataFrame:
    """Rank and dense rank of a value within its key. Of keys with very many rows, distinct values are placed with their
    counts and joined back."""
    if cuts(df, keys, [order]) is None:
        window = Window.partitionBy(*keys).orderBy(*order_columns([order]))
        return df.withColumns({rank: F.rank().over(window), dense: F.dense_rank().over(window)})
    value = order.lstrip("-")
    counts = materialise(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), "counts")
    placed = running(counts, keys, [order], {"__upto": F.col("__n"), "__step": F.lit(1)}).select(
        *keys,
        value,
        (F.col("__upto") - F.col("__n") + 1).cast("int").alias(rank),
        F.col("__step").cast("int").alias(dense),
    )
    return attach(df, placed, [*keys, value])
