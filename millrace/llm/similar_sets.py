"""Exact similarity classes of shingle sets, linear in the rows but for families of alike sets.

Candidates come as ties (pairs of documents). Tied documents form families; within a family equal sets are
one, and sets meet in cells of bounded size: the sets of a family are dealt into blocks by size class and
hash, and every two blocks whose sizes allow a link share a cell. A cell computes all overlaps of its sets. A block's
own cell gives back one pair for each set that a link connects to others; the cell of two blocks sees what these cells
connect and gives back only pairs that connect more, never all pairs.

In a cell, the overlaps of a set with all others are derived from those of the most similar set done
before: only the index lists of the shingles in which the two differ are added and taken away.

Rows that repeat a doc_id are one document, with the links of all its texts. A null doc_id is linked with
nothing and has no component. A text without words is linked with nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import components, map_arrow, slices, texts, tidy
from millrace.llm.shingles import shingles
from millrace.llm.sketches import only_known
from millrace.session import materialise

#: A block of a family holds about so many sets, and so many shingles unless one set has more.
BLOCK_SETS = 128
BLOCK_SHINGLES = 200_000
#: Families of more distinct sets are tied again before their sets are compared.
LARGE_FAMILY = 4 * BLOCK_SETS


def digest(tokens: np.ndarray) -> bytes:
    """The identity of a set, from its ascending shingle hashes."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def set_table(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, digest) of every row."""

    def run(batch):
        sets = [np.unique(shingles(t, size)) for t in batch["text"].to_pylist()]
        columns = [batch["doc_id"], pa.array(map(len, sets), pa.int64()), pa.array(map(digest, sets), pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest"])

    return map_arrow(texts(docs), run, "doc_id long, n_shingles long, digest binary")


def overlaps(sets: Sequence[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets (ascending, distinct) share; the diagonal is not used."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = counts > 1
    row = np.cumsum(common) - 1
    kept = common[where]
    has = np.zeros((int(common.sum()), len(sets)), dtype=bool)
    has[row[where[kept]], owner[kept]] = True
    found = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for b in range(len(sets)):
        own = has[:, b]
        if b:
            a = int(found[:b, b].argmax())
            plus, minus = own & ~has[:, a], has[:, a] & ~own
            if np.count_nonzero(plus) + np.count_nonzero(minus) < np.count_nonzero(own):
                base = found[a].copy()
                base[a] = np.count_nonzero(has[:, a])
                found[b] = base + has[plus].sum(axis=0) - has[minus].sum(axis=0)
                continue
        found[b] = has[own].sum(axis=0)
    return found


def stars(linked: np.ndarray) -> list[tuple[int, int]]:
    """Each member of a component of a symmetric matrix of links, with the first one."""
    left, out = np.ones(len(linked), dtype=bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            new = np.flatnonzero(linked[queue.pop()] & left)
            left[new] = False
            out += [(root, int(n)) for n in new]
            queue += new.tolist()
    return out


def firsts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of the numbers 0 to n - 1, the least that pairs (a, b) of numbers connect it to, or itself."""
    first = np.arange(n)
    while True:
        x, y = first[a], first[b]
        np.minimum.at(first, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(further := first[first], first):
            first = further
        if np.array_equal(first[a], first[b]):
            return first


def links_of(ids: Sequence[int], sets: Sequence[np.ndarray], num: int, den: int, block: Sequence[int] | None = None) -> list[tuple[int, int]]:
    """What the pairs with den * |a & b| >= num * |a | b| connect: each set with the first of its component.

    Of sets from two blocks (0 and 1), only what they connect beyond the links within each block: a pair for each
    component of a block that is joined to another, where one for every set would come again in each cell of a block.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    shared = overlaps(sets)
    linked = den * shared >= num * (sizes[:, None] + sizes[None, :] - shared)
    if block is None or len(set(block)) < 2:
        return [(ids[a], ids[b]) for a, b in stars(linked)]
    apart = np.not_equal.outer(block, block)
    own = np.arange(len(ids))
    for a, b in stars(linked & ~apart):
        own[b] = a
    joined = np.argwhere(np.triu(linked & apart))
    first = firsts(len(ids), own[joined[:, 0]], own[joined[:, 1]])
    return [(ids[first[n]], ids[n]) for n in np.flatnonzero(first != np.arange(len(ids)))]


def _cells(families: DataFrame, num: int, den: int) -> DataFrame:
    """(set_id, cell, block): the cells of every distinct set and which of its blocks the set is from (0 or 1), from
    (family, set_id, n_shingles)."""
    sums = families.groupBy("family").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("shingles"))
    large = (F.col("sets") > BLOCK_SETS) | (F.col("shingles") > BLOCK_SHINGLES)
    sums = materialise(sums.where("sets > 1").select("family", large.alias("large")), "families")
    # A little wider than the ratio of linked sizes, so that these are at most one class apart.
    width = math.log(den / num * 1.001)
    cls = F.when(F.col("large"), F.floor(F.log(F.col("n_shingles").cast("double")) / width)).otherwise(0).cast("long")
    placed = families.join(sums, "family").withColumn("cls", cls).drop("large")
    counts = placed.groupBy("family", "cls").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    # At most a few hundred size classes for a family.
    along = Window.partitionBy("family").orderBy("cls")

    def beside(by: int):
        """Blocks of the next class, or of the last one; null where there is none."""
        there = F.lead if by > 0 else F.lag
        return F.when(there("cls").over(along) == F.col("cls") + by, there("k").over(along))

    near = counts.select("family", "cls", blocks.alias("k")).withColumns({"k_next": beside(1), "k_last": beside(-1)})
    known = placed.join(materialise(near, "blocks"), ["family", "cls"]).withColumn("i", F.pmod(F.xxhash64("set_id"), F.col("k")))

    def named(c1, i, c2, j, block):
        return F.struct(F.concat_ws(":", F.col("family"), c1, i, c2, j).alias("cell"), block.cast("byte").alias("block"))

    def upto(k):
        return F.when(F.col(k) > 0, F.sequence(F.lit(0).cast("long"), F.col(k) - 1)).otherwise(F.array().cast("array<long>"))

    one, two = F.lit(0), F.lit(1)
    c, i = F.col("cls"), F.col("i")
    own = F.transform(upto("k"), lambda j: named(c, F.least(i, j), c, F.greatest(i, j), i > j))
    after = F.transform(upto("k_next"), lambda j: named(c, i, c + 1, j, one))
    before = F.transform(upto("k_last"), lambda j: named(c - 1, j, c, i, two))
    return known.select("set_id", F.explode(F.concat(own, after, before)).alias("at")).select("set_id", "at.*")


def verified_links(docs: DataFrame, families: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """(a, b): pairs that connect what links connect within each family of distinct sets.

    Texts are read once more, and those of families travel to their cells as texts; most others stay where they are,
    as a Bloom filter of the families' ids says. The join is a merge at every size: how many texts are in families is
    known only now, and grows with the table.
    """
    cells = materialise(_cells(families, num, den), "cells")
    some = only_known(texts(docs), cells, "doc_id", "set_id").join(cells.hint("merge"), F.col("doc_id") == F.col("set_id")).select("cell", "set_id", "block", "text")
    dealt = some.repartition("cell").sortWithinPartitions("cell", "set_id")

    def run(batches):
        cell, ids, sets, blocks = None, [], [], []

        def flush():
            found = links_of(ids, sets, num, den, blocks) if len(ids) > 1 else []
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in slices(batches):
            for at, node, block, text in zip(*[batch[c].to_pylist() for c in ("cell", "set_id", "block", "text")], strict=True):
                if at != cell:
                    yield flush()
                    cell, ids, sets, blocks = at, [], [], []
                ids.append(node)
                blocks.append(block)
                sets.append(np.unique(shingles(text, size)))
        yield flush()

    return dealt.mapInArrow(tidy(run), "a long, b long")


def _refined(docs: DataFrame, distinct: DataFrame, again: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(family, set_id, n_shingles) of stored distinct sets, large families cut into what ``again`` ties.

    A cut family's parts are named by their least set.
    """
    sizes = materialise(distinct.groupBy("family").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") > LARGE_FAMILY).select("family"), "large")
    if not sizes.head(1):
        return distinct.select("family", "set_id", "n_shingles")
    large = materialise(distinct.join(sizes, "family").select("family", "set_id", "n_shingles"), "large-sets")
    some = only_known(texts(docs), large, "doc_id", "set_id").join(large.select("set_id").distinct().hint("merge"), F.col("doc_id") == F.col("set_id"))
    # Rows that repeat an id are one set each, and ties know ids only: what they connect stays together.
    cut = components(again(some.select("doc_id", "text"))).withColumnRenamed("node", "set_id")
    parts = large.drop("family").join(cut, "set_id").select(F.col("component").alias("family"), "set_id", "n_shingles")
    small = distinct.join(sizes, "family", "left_anti").select("family", "set_id", "n_shingles")
    # Least sets name families of both kinds; those of small families are no sets of large ones.
    return small.unionByName(parts)


def classes(
    docs: DataFrame, sets: DataFrame, ties: DataFrame, size: int, num: int, den: int, again: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row, given a superset of the links as ties (a, b).

    ``sets`` is a stored ``set_table``. Equal sets must be tied, directly or through others. ``again`` gives another
    superset of the links between some documents (doc_id, text), with fewer ties between unlike ones.
    """
    families = components(ties).withColumnRenamed("component", "family")
    members = materialise(families.join(sets.select(F.col("doc_id").alias("node"), "n_shingles", "digest"), "node"), "members")
    distinct = members.groupBy("family", "digest").agg(F.min("node").alias("set_id"), F.first("n_shingles").alias("n_shingles"))
    distinct = materialise(distinct, "distinct")
    cut = distinct.select("family", "set_id", "n_shingles") if again is None else materialise(_refined(docs, distinct, again), "refined")
    found = verified_links(docs, cut, size, num, den)
    equal = members.join(distinct.drop("n_shingles"), ["family", "digest"]).select(F.col("node").alias("a"), F.col("set_id").alias("b"))
    known = components(found.union(equal)).withColumnRenamed("node", "doc_id")
    rows = sets.select("doc_id", "n_shingles").join(known, "doc_id", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
