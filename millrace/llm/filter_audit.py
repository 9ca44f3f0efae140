"""What each filter of a chain removes, alone and behind the others, in every order of the chain.

Five filters look at whole texts; four of them at one text alone, the fifth at copies: a document fails it when a
smaller doc_id has the identical text. Every document gets a mask with a bit for each filter it fails. All that is
asked of any order of the filters is a sum over masks, so a part is counted once, by mask, and the counts of at
most 32 masks give all 120 orders.

Copies are found in two steps. A counting Bloom filter takes the digests of all texts: each task counts its own
rows, counters (0, 1, more) are merged segment by segment, and a text with a counter below two occurs once for
certain. Such texts are cleared where they are; only possible repeats are shuffled, by the SHA-256 of the whole
text, to the least doc_id of each text. The filter has as many segments as the row count asks for, and is broadcast up to a size
that this count tells beforehand; beyond it, rows meet their segment by a merge join (``sketches``).

A null text is empty, and so is a null source. A null doc_id is not smaller than any, so it is no first copy
and never a later one. Rows that repeat a doc_id are documents of their own, with the labels of that id; rows with
equal texts and the same doc_id are not copies of each other. Labels that repeat an id hold where one of them
does. An empty table gives no rows. Columns other than doc_id, text, source, quality and toxic are ignored.
"""

from __future__ import annotations

import hashlib
import json
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import sketches
from millrace.llm.common import slices
from millrace.session import materialise

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKS = b"#$%&*|"
COPY_BIT = 1 << FILTERS.index("E")

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_INNER_BYTES = bytes(range(0x80, 0xC0))


def text_mask(raw: bytes) -> int:
    """The bits of the filters A to D that a text (UTF-8) fails."""
    words = raw.split()  # of bytes: at blank, tab, newline, vertical tab, form feed and carriage return
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    points = len(raw.translate(None, _INNER_BYTES))
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * points,
        len(raw.translate(None, MARKS)) < len(raw),
    )
    return sum(1 << bit for bit, failed in enumerate(fails) if failed)


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest, at, probes): the whole text read once, its digest also as two integers."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in slices(batches):
            texts = batch["text"].to_pylist()
            digests = [hashlib.sha256(t).digest() for t in texts]
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 4)
            columns = [
                batch["doc_id"], batch["part"], pa.array(map(text_mask, texts), pa.int32()), pa.array(digests, pa.binary()),
                pa.array(halves[:, 0]), pa.array(halves[:, 1]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "digest", "at", "probes"])

    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary, at long, probes long")


def with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``repeat`` to stored rows of ``masks``: false where the text occurs once for certain."""
    return sketches.reached(rows, sketches.build(rows, 2), "repeat").drop("at", "probes")


def with_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of stored rows of ``masks``, the mask with the bit of the filter on copies."""
    tested = with_repeats(rows)
    known = tested.where("NOT repeat").select("doc_id", "part", "mask")
    possible = tested.where("repeat").select("doc_id", "part", "mask", "digest")
    least = possible.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that adaptive execution can split a text that a large share of the rows has.
    least = materialise(least.select("digest", "first"), "least")
    later = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    mask = F.when(later, F.col("mask").bitwiseOR(F.lit(COPY_BIT))).otherwise(F.col("mask"))
    return known.unionByName(possible.join(least, "digest", "left").select("doc_id", "part", mask.alias("mask")))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail exactly the filters of a mask."""
    rows = with_copies(materialise(masks(docs), "masks"))
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = rows.join(materialise(known, "labels"), "doc_id", "left")
    return marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")])


def steps() -> list[dict]:
    """Every order of the filters, step by step: the bit of the filter and those of the filters before it."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        earlier = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": order, "step": step, "bit": bit, "earlier": earlier})
            earlier |= bit
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, with counts of documents.

    kept: left after this step; removed: by it; redundant: failing its filter, but removed before; unique_fails:
    failing its filter only; good_lost, toxic_lost: removed by it, with that label; shapley: what its filter
    removes, summed over all orders.
    """
    # At most 32 masks to a part.
    cells = F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    parts = mask_counts(docs, labels).groupBy("part").agg(cells)
    schema = "array<struct<filter_order:string,step:int,bit:int,earlier:int>>"
    each = parts.select("part", "cells", F.inline(F.from_json(F.lit(json.dumps(steps())), schema)))
    bit, earlier = F.col("bit"), F.col("earlier")

    def fails(cell: Column, bits: Column) -> Column:
        return cell["mask"].bitwiseAND(bits) != 0

    def total(value, where) -> Column:
        return F.aggregate(F.filter("cells", where), F.lit(0).cast("long"), lambda sum_, cell: sum_ + value(cell))

    def removed(cell: Column) -> Column:
        return fails(cell, bit) & ~fails(cell, earlier)

    orders = factorial(len(FILTERS))
    return each.select(
        "part", "filter_order", "step",
        total(lambda c: c["n"], lambda c: ~fails(c, bit.bitwiseOR(earlier))).alias("kept"),
        total(lambda c: c["n"], removed).alias("removed"),
        total(lambda c: c["n"], lambda c: fails(c, bit) & fails(c, earlier)).alias("redundant"),
        total(lambda c: c["n"], lambda c: c["mask"] == bit).alias("unique_fails"),
        total(lambda c: c["good"], removed).alias("good_lost"),
        total(lambda c: c["toxic"], removed).alias("toxic_lost"),
        # A filter is the first of those a document fails in one order out of as many.
        total(lambda c: c["n"] * (F.lit(orders) / F.bit_count(c["mask"])).cast("long"), lambda c: fails(c, bit)).alias("shapley"),
    )
