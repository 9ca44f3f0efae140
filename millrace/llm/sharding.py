"""A reproducible shuffle into shards by a permutation that can be computed, not stored.

Rows are numbered in the order of doc_id (ties by text). A Feistel network over pairs (left, right) with
left < a and right < b permutes 0 .. a*b-1, where a*b is just above the number of rows; a result beyond the last
row is sent through again until it falls inside (cycle walking). The permuted number p gives
shard = p mod shards and slot = p div shards, so shard sizes differ by one row at most and slots have no
gaps. ``row_at`` inverts it: which row stands in a shard's slot.

All in DataFrame functions. The round function is a cubic modulo the prime 2^31 - 1, so that products of
two values stay within 63 bits: the operator takes up to 2^61 rows.

A null text counts as empty, a null doc_id comes first. Rows that repeat an id are rows of their own; rows
equal in id and text can stand for each other. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import number_rows
from millrace.session import materialise

PRIME = (1 << 31) - 1
ROUNDS = 6
#: Applications of the network in one pass over the rows. More passes follow while a row is outside.
WALKS = 3


def sides(n: int) -> tuple[int, int]:
    """(a, b) with a * b at least n and less than n + a."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Two constants below the prime for every half round, from the seed by a linear congruence."""
    state, out = seed % PRIME, []
    for _ in range(2 * rounds):
        pair = []
        for _ in range(2):
            state = (state * 48271 + 11) % PRIME
            pair.append(state)
        out.append((pair[0], pair[1]))
    return out


def _mixed(value, pair: tuple[int, int], modulus: Callable):
    """The round function; works on columns and on plain numbers."""
    t = modulus(value + pair[0], PRIME)
    return modulus((modulus(t * t, PRIME) + pair[1]) * t, PRIME)


def _apply(df: DataFrame, n: int, seed: int, rounds: int) -> DataFrame:
    """Send ``__p`` through the network once where it is outside 0 .. n-1 (or not yet ``__in``)."""
    a, b = sides(n)
    mod = lambda value, by: value % F.lit(by)
    step = df.withColumns({"__left": F.expr(f"`__p` div {b}"), "__right": F.col("__p") % b})
    for k, pair in enumerate(keys(seed, rounds)):
        if k % 2:
            step = step.withColumn("__right", (F.col("__right") + mod(_mixed(F.col("__left"), pair, mod), b)) % b)
        else:
            step = step.withColumn("__left", (F.col("__left") + mod(_mixed(F.col("__right"), pair, mod), a)) % a)
    sent = F.col("__left") * b + F.col("__right")
    return step.withColumn("__p", F.when(F.col("__in"), F.col("__p")).otherwise(sent)).withColumn("__in", F.col("__p") < n).drop("__left", "__right")


def permute(rows: DataFrame, n: int, seed: int, rounds: int = ROUNDS, row: str = "row", output: str = "permuted") -> DataFrame:
    """Add the permuted number of each row number 0 .. n-1. Stores the rows, which should be narrow."""
    moved = rows.withColumn("__p", F.col(row)).withColumn("__in", F.lit(False))
    while True:
        for _ in range(WALKS):
            moved = _apply(moved, n, seed, rounds)
        moved = materialise(moved, "permuted")
        if not moved.where(~F.col("__in")).head(1):
            return moved.withColumnRenamed("__p", output).drop("__in")


def row_at(shard: int, slot: int, n: int, shards: int, seed: int, rounds: int = ROUNDS) -> int:
    """The row number in a shard's slot: the network run backwards."""
    a, b = sides(n)
    p = slot * shards + shard
    if not 0 <= p < n:
        raise IndexError(f"shard {shard} has no slot {slot}")
    while True:
        left, right = divmod(p, b)
        for k, pair in reversed(list(enumerate(keys(seed, rounds)))):
            if k % 2:
                right = (right - _mixed(left, pair, lambda v, m: v % m)) % b
            else:
                left = (left - _mixed(right, pair, lambda v, m: v % m)) % a
        p = left * b + right
        if p < n:
            return p


def shard(docs: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot): texts are read once and never shuffled."""
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 16).cast("long")
    rows = materialise(docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("__hash")), "rows")
    order: list[Column] = [F.col("doc_id"), F.col("__hash")]
    numbered = number_rows(rows, F.col("doc_id"), F.col("__hash"), order, "row").drop("__hash")
    moved = permute(numbered, rows.count(), seed)
    place = F.col("permuted")
    return moved.select(
        "doc_id", "size", "text_crc32", "row",
        (place % shards).cast("int").alias("shard"), F.expr(f"permuted div {int(shards)}").alias("slot"),
    )
