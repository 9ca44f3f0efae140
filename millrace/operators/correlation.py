"""Correlation matrices of any number of columns or series, from summed products of whole blocks of rows.

A task turns its rows into matrices and adds up their products, so the work for a pair of columns is a few machine
operations a row, and the plan has the same size for two columns as for a thousand. Tasks hand on one row of sums for
each column; these are added up column by column. A correlation uses the rows where both columns have values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values of a matrix made at a time.
CELLS = 1 << 20
#: Of both columns where both have values: count, sums, sums of squares, sum of products.
_SUMS = 6
_PARTS = "i int, sums binary"


def _products(x: np.ndarray) -> np.ndarray:
    """The sums for every pair of columns, as (column, sum, other column), of rows with NaN for no value."""
    has = (~np.isnan(x)).astype(np.float64)
    x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
    square = x * x
    return np.stack([has.T @ has, x.T @ has, has.T @ x, square.T @ has, has.T @ square, x.T @ x], axis=1)


def _matrix(df: DataFrame, names: Sequence[str], scale: np.ndarray, rows_of: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """(a, b, r) of all pairs; ``rows_of`` gives the centred rows of a batch, ``scale`` the size of each column's mean."""
    width = len(names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, step = np.zeros((width, _SUMS, width)), max(1, CELLS // max(1, width))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                sums += _products(rows_of(batch.slice(at, step)))
        for low in range(0, width, 64):
            part = range(low, min(width, low + 64))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([sums[i].tobytes() for i in part], pa.binary())], ["i", "sums"])

    def correlate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros((_SUMS, width))

        def made() -> pa.RecordBatch:
            n, x, y, xx, yy, xy = sums
            over_x, over_y = n * xx - x * x, n * yy - y * y
            # What rounding leaves of a constant column is far below its own size.
            flat = (over_x <= 1e-24 * (n * scale[now]) ** 2) | (over_y <= 1e-24 * (n * scale) ** 2)
            with np.errstate(all="ignore"):
                r = np.where(np.arange(width) == now, 1.0, (n * xy - x * y) / np.sqrt(over_x * over_y))
            known = ~flat & (n > 1)
            values = pa.array(np.clip(r, -1, 1), mask=~known)
            return pa.RecordBatch.from_arrays([pa.array([names[now]] * width), pa.array(list(names)), values], ["a", "b", "r"])

        for batch in batches:
            for i, raw in zip(batch["i"].to_pylist(), batch["sums"].to_pylist(), strict=True):
                if i != now:
                    if now is not None:
                        yield made()
                    now, sums = i, np.zeros((_SUMS, width))
                sums += np.frombuffer(raw).reshape(_SUMS, width)
        if now is not None:
            yield made()

    dealt = df.mapInArrow(add, _PARTS).repartition("i").sortWithinPartitions("i")
    return dealt.mapInArrow(correlate, "a string, b string, r double")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full correlation matrix in long form ``(a, b, r)``, pairwise complete; null where a column is constant."""
    columns = list(columns)
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    centre = np.array([v or 0.0 for v in values.agg(*[F.avg(c) for c in values.columns]).first()])

    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) - centre

    return _matrix(values, columns, np.abs(centre), rows_of)


def series_corr(df: DataFrame, time: str, key: str, value: str, prefix: str = "", zero_fill: bool = False) -> DataFrame:
    """Correlation between all series found in the data, which has at most one row for a time and key.

    ``zero_fill`` puts 0 where a series has no value at a time; otherwise each pair uses the times both have. The names of
    the series come to the driver, as the result has their number squared.
    """
    known = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    means = known.groupBy(key).agg(F.avg(value).alias("m")).collect()
    centres = {r[0]: 0.0 if zero_fill else float(r["m"]) for r in means}
    places = {k: i for i, k in enumerate(sorted(centres))}
    centre, missing = np.array([centres[k] for k in places]), 0.0 if zero_fill else np.nan
    # One row for each time, with as many entries as there are series.
    rows = known.groupBy(time).agg(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).cast("double").alias("v"))).alias("e")).select("e")

    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        out = np.full((batch.num_rows, len(places)), missing)
        lists = batch["e"]
        flat = lists.flatten()
        at = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        column = np.array([places[k] for k in flat.field("k").to_pylist()], dtype=np.int64)
        out[at, column] = flat.field("v").to_numpy(zero_copy_only=False) - centre[column]
        return out

    scale = np.array([abs(float(r["m"])) for r in sorted(means, key=lambda r: r[0])])
    return _matrix(rows, [f"{prefix}{k}" for k in places], scale, rows_of)
