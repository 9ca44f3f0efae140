"""What a table knows of words, put back inside rows: by dictionaries of blocks of rows.

Rows are dealt into blocks by a hash. The distinct words of a block meet the table once, and what they find travels
to the block as one small dictionary, in which all its rows look up their words. Words are never shuffled one
by one, and the rows themselves once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block. A block, its rows and its dictionary, is one group in a Python worker.
BLOCK_ROWS = 512


def placed(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(__block, keep): the rows with their block, by a hash of all that is kept, so that a key with many rows is spread."""
    blocks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // BLOCK_ROWS))
    return df.select(F.pmod(F.xxhash64(*keep), F.lit(blocks)).alias("__block"), *keep)


def block_words(rows: DataFrame, words: Column) -> DataFrame:
    """(__block, word, n): the distinct words of each block, and how many of its rows have them, from rows of ``placed``."""
    each = rows.select("__block", F.explode(F.array_distinct(words)).alias("word"))
    return each.groupBy("__block", "word").agg(F.count(F.lit(1)).alias("n"))


def look_up(rows: DataFrame, asked: DataFrame, table: DataFrame, columns: Mapping[str, Column], fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` turns the rows of a block and the rows of ``table`` whose ``word`` the block asked for into rows of the result.

    ``columns`` are added to the rows behind their shuffle, so only what they are made of travels.
    """
    met = asked.select(F.col("__block").alias("__of"), "word").join(table, "word")
    dealt = rows.repartition("__block").withColumns(dict(columns))
    return dealt.groupBy("__block").cogroup(met.groupBy("__of")).applyInArrow(fn, schema)
