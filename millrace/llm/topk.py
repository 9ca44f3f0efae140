"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are dealt into blocks of bounded size. A block's index has, for each component, the rows in
descending order of the value, cut into segments of one quantised level; these lists are made and stored once. A query
takes segments of all components together in descending order of impact (its own component times the best value of
the segment) and adds their exact contributions. After each round, the rows that lead so far are scored exactly, which
gives a floor that the k-th best score cannot be below, and every row whose sum, with the most that its open
components can still add, stays under the floor is out by proof. The walk ends when the rows left are so few that
scoring them exactly costs less than going on, or when no segment is left. No row is given up without that proof, ties
included, and no walk ends before it.

Queries travel to every block in groups, and each (group, block) gives back k rows for a query. Equal scores
go to the smaller id. Rows with a null id, or with a null vector or one holding null or non-finite values,
take no part. Shorter vectors count as 0 in the components they lack. A row's own id is never its answer. Rows
that repeat an id are rows of their own. With fewer than k candidates all are returned, without any
none. An empty table gives no rows. Scores must fit 63 bits. Columns not named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialise

BLOCK_ROWS = 16_384
GROUP_QUERIES = 2_048
LEVELS = 32
#: Rounds end at these shares of a query's greatest impact; the last one takes all segments.
_SHARES = (0.2, 0.1, 0.06, 0.04, 0.028, 0.02, 0.014, 0.01, 0.007, 0.0)
#: Leading rows scored exactly in each round, as often as rows are asked for, and at least.
LEADERS, LEAST_LEADERS = 4, 32
#: Rows left, as 1 in so many, that are scored exactly: that costs less than walking the rest of the lists.
FEW = 64


def quantised(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """True for vectors without null, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def sorted_lists(vectors: np.ndarray) -> np.ndarray:
    """For each component, the rows in descending order of their value."""
    return np.argsort(-np.ascontiguousarray(vectors.T), axis=1, kind="stable").astype("<i4")


class Block:
    """The index of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray | None = None):
        self.ids, self.vectors = ids, vectors
        # One list per component, each in one piece of memory, in the types that indexing and sums work with.
        self.order = (sorted_lists(vectors) if order is None else order).astype(np.intp)
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)
        self.summed = self.values.astype(np.float64)
        self.open = np.ones(self.values.shape, dtype=np.float32)
        low, high = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
        self.width = max(1, -(-(high - low + 1) // LEVELS))
        self.low, self.high, self.exact = low, high, vectors.astype(np.float64)
        self.segments = [self._cuts(d) for d in range(vectors.shape[1])]
        # Of all searches: contributions added in walks, those there are, rows scored exactly, rows there are.
        self.walked = self.postings = self.scored = self.rows = 0

    def _cuts(self, d: int) -> np.ndarray:
        """Where the quantised level of component ``d`` changes along its list, both ends included."""
        level = (self.values[d] - self.low) // self.width
        return np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [len(level)]])

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(id, score) of the best ``k`` rows for a query, best first.

        An impact is the size of a contribution, so lists are walked from both ends: what is left of a list lies
        between its two next segments.
        """
        n, dims = self.vectors.shape
        eligible = self.ids != own
        few = min(k, int(eligible.sum()))
        if not few:
            return []
        sure, open_ = np.zeros(n), self.open
        open_.fill(1.0)
        walks = []
        for d in np.flatnonzero(query[:dims]):
            cuts = self.segments[d]
            first, last = float(query[d]) * self.values[d][cuts[:-1]], float(query[d]) * self.values[d][cuts[1:] - 1]
            # Greatest and least contribution of every segment, from the end with the greatest.
            high, low = (first, last) if query[d] > 0 else (last[::-1], first[::-1])
            walks.append((d, cuts if query[d] > 0 else cuts[::-1], high, low))
        top = max((max(high[0], -low[-1]) for *_, high, low in walks), default=0.0)
        done = [(0, len(high)) for *_, high, _ in walks]
        leaders = min(int(eligible.sum()), max(LEAST_LEADERS, LEADERS * few))
        floor, maybe, seen = -np.inf, np.flatnonzero(eligible), 0
        self.postings += n * len(walks)
        for share in _SHARES:
            limit, most = share * top, np.zeros(dims, dtype=np.float32)
            for at, (d, cuts, high, low) in enumerate(walks):
                start, stop = done[at]
                i = max(start, int(np.searchsorted(-high, -limit, side="right")))
                j = max(i, min(stop, int(np.searchsorted(-low, limit, side="left"))))
                for a, b in ((start, min(i, stop)), (j, stop)):
                    if a < b:
                        a, b = sorted((cuts[a], cuts[b]))
                        rows = self.order[d, a:b]
                        sure[rows] += float(query[d]) * self.summed[d, a:b]
                        open_[d][rows] = 0.0
                        seen += b - a
                done[at] = (min(i, stop), j)
                if i < j:
                    most[d] = high[i]
            ahead = maybe[np.argpartition(-sure[maybe], min(leaders, len(maybe)) - 1)[:leaders]]
            floor = max(floor, float(np.partition(self._scores(ahead, query[:dims]), -few)[-few]))
            # While a row with its share of components open is above the floor, most rows are: no use in asking yet.
            if share and most.sum() * (1 - seen / max(1, n * len(walks))) > floor - sure.mean():
                continue
            # What sums in 32 bits (of as many terms as components, with most itself rounded) can be off by, twice.
            margin = 2.0 * (dims + 2) * 2.0**-23 * float(np.abs(most).sum()) + 1e-9 * float(np.abs(sure).max())
            best = sure[maybe] + (most @ open_)[maybe] + margin
            maybe = maybe[best >= floor]
            if FEW * len(maybe) <= n or len(maybe) <= leaders:
                break
        scores = self._scores(maybe, query[:dims])
        self.walked += seen
        self.rows += n
        self.scored += len(maybe)
        won = np.flatnonzero(scores >= np.partition(scores, -few)[-few])
        order = won[np.lexsort((self.ids[maybe[won]], -scores[won]))[:k]]
        return [(int(self.ids[maybe[i]]), int(scores[i])) for i in order]

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores: in floating point where all sums are whole numbers below 2^53."""
        if float(np.abs(query).sum()) * max(abs(self.low), abs(self.high)) < 2.0**53:
            return (self.exact if len(rows) == len(self.exact) else self.exact[rows]) @ query.astype(np.float64)
        return self.vectors[rows] @ query


def _packed(rows: DataFrame, at: str, lists: bool) -> DataFrame:
    """One row per value of ``at``: (at, n, dims, ids, vectors, lists) with row-major 64-bit values; lists if asked for."""
    schema = pa.schema([(at, pa.int64()), ("n", pa.int64()), ("dims", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("lists", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, vectors = None, [], []

        def flush():
            dims = max(map(len, vectors))
            matrix = np.zeros((len(vectors), dims), dtype="<i8")
            for i, v in enumerate(vectors):
                matrix[i, : len(v)] = v
            order = sorted_lists(matrix).tobytes() if lists else b""
            row = {at: held, "n": len(ids), "dims": dims, "ids": np.array(ids, dtype="<i8").tobytes(), "vectors": matrix.tobytes(), "lists": order}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for place, vec, values in zip(*[batch[c].to_pylist() for c in (at, "vec_id", "vector")], strict=True):
                if ids and place != held:
                    yield flush()
                    ids, vectors = [], []
                held = place
                ids.append(vec)
                vectors.append(values)
        if ids:
            yield flush()

    dealt = rows.select(at, "vec_id", "vector").repartition(at).sortWithinPartitions(at)
    return dealt.mapInArrow(run, f"{at} long, n long, dims long, ids binary, vectors binary, lists binary")


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<i8").reshape(row["n"], row["dims"])


def search(vectors: DataFrame, queries: Column, k: int, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of (vec_id, embedding) that meet the condition ``queries``."""
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", quantised(F.col("embedding"), scale).alias("vector"), queries.alias("__asks"))
    stored = materialise(rows.withColumn("__n", F.monotonically_increasing_id()), "vectors")
    total, asks = stored.agg(F.count(F.lit(1)), F.count(F.when(F.col("__asks"), 1))).first()
    blocks, groups = max(1, -(-total // BLOCK_ROWS)), max(1, -(-asks // GROUP_QUERIES))
    deal = F.xxhash64("__n")
    index = materialise(_packed(stored.withColumn("block", F.pmod(deal, F.lit(blocks))), "block", True), "index")
    asked = _packed(stored.where("__asks").withColumn("grp", F.pmod(deal, F.lit(groups))), "grp", False)
    # Every group meets every block once: groups * blocks rows, each of bounded size. A task has one block, whose index comes
    # first, and takes the groups one after another. A join would be planned by what Spark takes the groups for, before they
    # are packed and sent to all blocks, and so broadcast them through the driver, or repeat the index in each of its rows.
    sent = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    met = index.withColumn("grp", F.lit(None).cast("long")).unionByName(sent)
    met = met.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("block", F.asc_nulls_first("grp"))

    def run(batches):
        number, block = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids, matrix = _unpack(row)
                if row["grp"] is None:
                    number, block = row["block"], Block(ids, matrix, np.frombuffer(row["lists"], "<i4").reshape(matrix.T.shape))
                    continue
                if row["block"] != number:
                    continue  # without rows of its own
                out = []
                for place, (own, query) in enumerate(zip(ids.tolist(), matrix, strict=True)):
                    wide = np.zeros(max(block.vectors.shape[1], len(query)), dtype=np.int64)
                    wide[: len(query)] = query
                    out += [(row["grp"], place, own, vec, score) for vec, score in block.search(wide, own, k)]
                columns = zip(*out, strict=True) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["grp", "place", "query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "grp long, place long, query_id long, vec_id long, score long")
    best = Window.partitionBy("grp", "place").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
