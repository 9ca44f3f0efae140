"""Packing by powers of two: no sequence crosses documents, and none is padded.

A document's ids are cut into pieces whose lengths are powers of two: full windows first, then the binary
digits of the rest, largest first. Each piece is a sequence by itself. Sequences of one length form a
bucket, numbered without gaps, so a batch is a range of numbers of one bucket.

A null or empty text holds only the end id: one piece of length 1. Rows that repeat an id or a text are
packed as often as they come. An empty table gives no pieces. A very long text gives as many full windows as
it needs. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import slices, texts, tidy
from millrace.llm.tokens import SLICE, default_path, encoder
from millrace.session import materialise

WINDOW = 4096
END_ID = 2

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, __part long, __rank long"


def cut(n: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; ``window`` is a power of two."""
    digits = [1 << b for b in range(window.bit_length() - 2, -1, -1) if n % window >> b & 1]
    pieces, at = [], 0
    for length in [window] * (n // window) + digits:
        pieces.append((at, length))
        at += length
    return pieces


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document with their ids (little-endian unsigned 32-bit).

    ``__part`` and ``__rank`` name the writing task and the place among its pieces of that length.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in slices(batches, size=SLICE):
            rows: list[tuple] = []
            for doc, raw in zip(batch["doc_id"].to_pylist(), encode(batch["text"]), strict=True):
                raw += end
                total = len(raw) // 4
                for start, length in cut(total, window):
                    rows.append((doc, start, length, total, raw[4 * start : 4 * (start + length)], part, seen[length]))
                    seen[length] += 1
            kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return texts(docs).mapInArrow(tidy(run), PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset): one row per piece, one piece per sequence.

    Numbers ascend from the longest bucket to the shortest. Texts are read and encoded once, without a
    shuffle; the stored pieces get their numbers from a table of one row per task and length.
    """
    stored = materialise(pieces(docs, tokenizer or default_path(), window, end_id), "pieces")
    counts = materialise(stored.groupBy("length", "__part").agg(F.count(F.lit(1)).alias("n")), "counts")
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))
    # At most log2(window) + 1 rows here, and one row per task in a window below.
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("bucket"))
    earlier = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    first = counts.withColumn("before", before).join(F.broadcast(buckets), "length")
    first = materialise(first.select("length", "__part", (F.col("bucket") + F.col("before")).alias("__first")), "firsts")
    return stored.join(first, ["length", "__part"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.col("__first") + F.col("__rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
