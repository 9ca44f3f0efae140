"""Counting Bloom filters over rows with two hashes, built and asked where the rows are.

Rows bring ``at``, which names their segment, and ``probes``, whose 16-bit pieces name one counter each in the shares
of that segment. Tasks count their own rows; counters (0, 1, more) are merged segment by segment. What is kept is a
bit for each counter that reached ``least``. The number of segments follows the number of rows. A filter is broadcast
while its size, known from that number, is at most BROADCAST_BYTES; beyond it, rows meet their segment by a merge join.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise

#: Counters for each row, probes for each row, and counters in a segment, a share of them for each probe.
COUNTERS_PER_ROW = 8
PROBES = 4
SEGMENT = 1 << 16
_SHARE = SEGMENT // PROBES
#: Largest sketch that is sent to every executor: one bit for each counter, so some 60 million rows.
BROADCAST_BYTES = 64 << 20
#: Rows whose counters a task holds before it hands them on.
HELD_ROWS = 1 << 20


@dataclass(frozen=True)
class Sketch:
    """A stored table (segment, bits) and its number of segments."""

    table: DataFrame
    segments: int


def counters(probes: np.ndarray) -> np.ndarray:
    """The counters of each row within its segment: one in each share, so none is met twice by a row."""
    bits = [(probes >> (16 * i)) & (_SHARE - 1) for i in range(PROBES)]
    return np.stack([i * _SHARE + b for i, b in enumerate(bits)], axis=1)


def merged(rows: DataFrame, segments: int, least: int) -> DataFrame:
    """(segment, bits): a bit, in 64-bit words, for every counter that reached ``least``, 1 or 2."""

    def count(batches):
        held, size = [], 0

        def hand_on():
            at = np.concatenate([h[0] for h in held])
            cells = (at[:, None] * SEGMENT + counters(np.concatenate([h[1] for h in held]))).ravel()
            cells, times = np.unique(cells, return_counts=True)
            starts = np.flatnonzero(np.diff(cells // SEGMENT, prepend=-1))
            out: dict[str, list] = {"segment": [], "once": [], "more": []}
            for a, b in zip(starts, [*starts[1:], len(cells)], strict=True):
                place = (cells[a:b] % SEGMENT).astype("<u2")
                out["segment"].append(int(cells[a] // SEGMENT))
                out["once"].append(place[times[a:b] == 1].tobytes())
                out["more"].append(place[times[a:b] > 1].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(out["segment"], pa.int64()), pa.array(out["once"], pa.binary()), pa.array(out["more"], pa.binary())], list(out))

        for batch in batches:
            held.append((np.mod(batch["at"].to_numpy(), segments), batch["probes"].to_numpy()))
            size += batch.num_rows
            if size >= HELD_ROWS:
                yield hand_on()
                held, size = [], 0
        if size:
            yield hand_on()

    def merge(batches):
        now, sums = None, np.zeros(SEGMENT, dtype=np.uint8)

        def whole():
            words = np.packbits(sums >= least, bitorder="little").view("<i8")
            lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), lists], ["segment", "bits"])

        for batch in batches:
            for segment, once, more in zip(*[batch[c].to_pylist() for c in ("segment", "once", "more")], strict=True):
                if segment != now:
                    if now is not None:
                        yield whole()
                    now = segment
                    sums[:] = 0
                few = np.frombuffer(once, "<u2")
                sums[few] = np.minimum(sums[few] + 1, 2)
                sums[np.frombuffer(more, "<u2")] = 2
        if now is not None:
            yield whole()

    parts = rows.select("at", "probes").mapInArrow(count, "segment long, once binary, more binary")
    dealt = parts.repartition("segment").sortWithinPartitions("segment")
    return dealt.mapInArrow(merge, "segment long, bits array<long>")


def build(rows: DataFrame, least: int) -> Sketch:
    """The filter of stored rows (at, probes)."""
    segments = max(1, ceil(rows.count() * COUNTERS_PER_ROW / SEGMENT))
    return Sketch(materialise(merged(rows, segments, least), "sketch"), segments)


def reached(rows: DataFrame, sketch: Sketch, name: str) -> DataFrame:
    """Add ``name`` to rows with ``at`` and ``probes``: false where a counter of theirs did not reach its least.

    Of the columns of ``rows``, none is called ``__segment``, ``__place`` or ``bits``.
    """
    table = sketch.table.withColumnRenamed("segment", "__place")
    small = sketch.segments * (SEGMENT // 8) <= BROADCAST_BYTES
    here = rows.withColumn("__segment", F.pmod("at", F.lit(sketch.segments)))
    # A segment without any rows has no row of bits.
    met = here.join(F.broadcast(table) if small else table.hint("merge"), F.col("__segment") == F.col("__place"), "left")

    def set_at(i: int) -> Column:
        cell = F.shiftrightunsigned("probes", 16 * i).bitwiseAND(F.lit(_SHARE - 1)) + i * _SHARE
        word = F.get("bits", F.shiftright(cell, 6).cast("int"))
        return F.getbit(word, cell.bitwiseAND(F.lit(63)).cast("int")) == 1

    every = set_at(0)
    for i in range(1, PROBES):
        every = every & set_at(i)
    return met.withColumn(name, F.coalesce(every, F.lit(False))).drop("__segment", "__place", "bits")


def hashed(key: Column) -> dict[str, Column]:
    """``at`` and ``probes`` of a key."""
    return {"at": F.xxhash64(key), "probes": F.xxhash64(key, F.lit(1))}


def only_known(rows: DataFrame, keys: DataFrame, on: str, key: str) -> DataFrame:
    """The rows of ``rows`` whose column ``on`` may be in the stored ``keys``: all of these, and a few others.

    For use before a shuffle of wide rows, of which few have a partner: what is left still takes the join.
    """
    distinct = keys.select(F.col(key).alias("__key")).distinct()
    sketch = build(materialise(distinct.select(*[c.alias(n) for n, c in hashed(F.col("__key")).items()]), "keys"), 1)
    return reached(rows.withColumns(hashed(F.col(on))), sketch, "__may").where("__may").drop("__may", "at", "probes")
