"""What several corpus operators share: texts, row numbers without a global sort task, components.

``doc_id`` identifies a document. Rows that repeat an id are kept as rows; where an order is needed
they are told apart by their text. Columns other than those an operator names are never looked at.
"""

from __future__ import annotations

import ctypes
import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialise

#: Blocks of an order for each task; several, so that hashing them deals evenly.
BLOCKS_PER_TASK = 8
#: Bytes of text that are dealt to a task.
TASK_BYTES = 16 << 20
#: Characters of text that a Python task works on at a time.
SLICE_CHARS = 4_000_000


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with an empty text for a null one."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def task_count(df: DataFrame, size: Column, most: int) -> int:
    """Into how many tasks a frame is dealt so that each gets about ``most`` of the summed ``size``; one a core at least."""
    whole = df.agg(F.sum(size)).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(whole / most))


#: Numbers of the blocks that one value of the key may be split into.
_SPLITS = 1 << 31


def with_block(df: DataFrame, key: Column, then: Column, parts: int, output: str = "__block") -> DataFrame:
    """Add a block number that ascends with (key, then), null first: about ``parts`` blocks of even numbers of rows.

    ``then`` is a 64-bit hash that follows the numeric ``key`` in the order. Blocks are cut at sketched values of the
    key. A key (or null) with more rows than two blocks hold is cut along the hash, and rows alike in both, which no
    order tells apart, are dealt out over as many blocks as they fill. Read several times: give a scan or a stored table.
    """
    spark = df.sparkSession
    measured = df.withColumns({"__key": key.cast("double"), "__then": then})
    total, nulls = measured.agg(F.count(F.lit(1)), F.count(F.when(F.col("__key").isNull(), 1))).first()
    found = measured.where("__key is not null").approxQuantile("__key", [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    # A sketched value that comes more than once has that many blocks of rows.
    heavy = {value: times for value, times in Counter(found).items() if times > 1}
    if nulls * parts > 2 * total:
        heavy[None] = nulls * parts // total
    points = sorted(set(found))
    place = F.coalesce("__key", F.lit(-math.inf))
    if points:
        cut = Bucketizer(splits=[-math.inf, *points, math.inf], inputCol="__place", outputCol="__bucket")
        bucketed = cut.transform(measured.withColumn("__place", place)).withColumn("__bucket", F.col("__bucket").cast("long")).drop("__place")
    else:
        bucketed = measured.withColumn("__bucket", F.lit(0).cast("long"))
    if not heavy:
        return bucketed.withColumn(output, F.col("__bucket") * _SPLITS).drop("__key", "__then", "__bucket")
    # Fewer rows than blocks here, and in ``alike``.
    keys = spark.createDataFrame(list(heavy.items()), "__heavy double, __times long")
    among = measured.join(F.broadcast(keys), F.col("__key").eqNullSafe(F.col("__heavy")))
    alike = among.groupBy("__key", "__then").count().where(F.col("count") > total / parts).collect()
    rows = [(k, n, sorted((r["__then"], 1 + r["count"] * parts // total) for r in alike if r["__key"] == k)) for k, n in heavy.items()]
    known = spark.createDataFrame(rows, "__heavy double, __times long, __alike array<struct<hash:long,n:long>>")
    met = bucketed.join(F.broadcast(known), F.col("__key").eqNullSafe(F.col("__heavy")), "left")
    along = F.floor((F.col("__then") / float(1 << 64) + 0.5) * F.col("__times"))
    before = F.aggregate(F.filter("__alike", lambda x: x["hash"] < F.col("__then")), F.lit(0).cast("long"), lambda n, x: n + x["n"])
    same = F.filter("__alike", lambda x: x["hash"] == F.col("__then"))
    dealt = F.when(F.size(same) > 0, F.pmod(F.monotonically_increasing_id(), F.get(same, F.lit(0))["n"])).otherwise(0)
    # Rows of lighter keys come after the heavy one that their bucket begins with.
    within = F.when(F.col("__times").isNull(), F.lit(_SPLITS - 1)).otherwise(along + before + dealt)
    return met.withColumn(output, F.col("__bucket") * _SPLITS + within).drop("__key", "__then", "__bucket", "__heavy", "__times", "__alike")


def bases(stored: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per block, the sum of each column over all blocks before it: one row for each block."""
    totals = stored.groupBy("__block").agg(*[F.sum(n).alias(n) for n in names])
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__block", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__base_{n}") for n in names])


#: Rows in a block of a numbering.
NUMBERED_ROWS = 100_000


def number_rows(df: DataFrame, key: Column, then: Column, order: Sequence[Column], output: str) -> DataFrame:
    """Add the 0-based place of each row in the order, which must refine the numeric ``key`` and the hash ``then``.

    Rows are cut into blocks (``with_block``), numbered within their block, and raised by the size of the blocks
    before it. Only one row per block goes through a single task. ``df`` is read several times: give a narrow stored
    table.
    """
    parts = BLOCKS_PER_TASK * task_count(df, F.lit(1), NUMBERED_ROWS * BLOCKS_PER_TASK)
    # Stored, as rows alike in all of the order are dealt out once.
    cut = materialise(with_block(df, key, then, parts), "cut")
    sizes = bases(cut.select("__block", F.lit(1).alias("n")), ["n"])
    place = F.row_number().over(Window.partitionBy("__block").orderBy(*order))
    placed = cut.withColumn(output, place.cast("long"))
    # At most one row per block.
    return (
        placed.join(F.broadcast(sizes), "__block")
        .withColumn(output, F.col(output) + F.col("__base_n") - 1)
        .drop("__block", "__base_n")
    )


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame is called so (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hashable(df: DataFrame) -> list[str]:
    """The columns that a hash can be taken of: those without maps and variants inside."""

    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return [f.name for f in df.schema.fields if plain(f.dataType)]


#: Rows of a file are numbered within so many bits.
_FILE_BITS = 40


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with a number of their own, which every reading gives again.

    Rows that come straight from files are numbered by file and place in it, and not copied. Other frames are stored
    with numbers that hold for one reading only.
    """
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return materialise(df.withColumn(name, F.monotonically_increasing_id()), "rows")
    path, file, place = fresh(df, "__path"), fresh(df, "__file"), fresh(df, "__place")
    # One row for each file.
    paths = sorted(r[0] for r in df.select(df.metadataColumn("_metadata")["file_path"]).distinct().collect())
    files = df.sparkSession.createDataFrame(list(enumerate(paths)), f"{file} long, {place} string")
    meta = df.metadataColumn("_metadata")
    rows = df.select("*", meta["file_path"].alias(path), meta["row_index"].alias(name))
    met = rows.join(F.broadcast(files), F.col(path) == F.col(place))
    return met.withColumn(name, F.shiftleft(file, _FILE_BITS) + F.col(name)).drop(path, file, place)


#: Rows whose small numbers are kept in one array.
ROW_BLOCK = 1 << 16


def by_row(values: DataFrame, row: str, value: str) -> DataFrame:
    """(__block, __values): small numbers (0 to 127) of some rows, by blocks of row numbers; other rows of a block have 0.

    One byte a row, so that a decision on every row of a table of texts is sent to the texts, not they to it,
    wherever Spark finds the table small enough to broadcast.
    """

    def run(batches):
        now, held = None, []

        def packed():
            at, what = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            numbers = np.zeros(int(at.max()) + 1, dtype=np.int8)
            numbers[at] = what
            lists = pa.ListArray.from_arrays(pa.array([0, len(numbers)], pa.int32()), pa.array(numbers))
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), lists], ["__block", "__values"])

        for batch in batches:
            blocks = batch["__block"].to_numpy()
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for some in np.split(np.arange(len(blocks)), cuts):
                if len(some) and blocks[some[0]] != now:
                    if held:
                        yield packed()
                    now, held = int(blocks[some[0]]), []
                held.append((batch["__at"].to_numpy()[some], batch["__value"].to_numpy()[some]))
        if held:
            yield packed()

    block, at = F.shiftright(F.col(row), ROW_BLOCK.bit_length() - 1), F.pmod(F.col(row), F.lit(ROW_BLOCK))
    dealt = values.select(block.cast("long").alias("__block"), at.alias("__at"), F.col(value).cast("byte").alias("__value"))
    dealt = dealt.repartition("__block").sortWithinPartitions("__block")
    return materialise(dealt.mapInArrow(run, "__block long, __values array<byte>"), "by-row")


def with_value(rows: DataFrame, row: str, packed: DataFrame, output: str) -> DataFrame:
    """Add the number that ``by_row`` holds for each row, 0 where it holds none. ``row`` counts from 0."""
    block, values = fresh(rows, "__block"), fresh(rows, "__values")
    known = packed.toDF(block, values)
    met = rows.join(known, F.shiftright(F.col(row), ROW_BLOCK.bit_length() - 1) == F.col(block), "left")
    found = F.get(F.col(values), F.pmod(F.col(row), F.lit(ROW_BLOCK)).cast("int"))
    return met.withColumn(output, F.coalesce(found, F.lit(0).cast("byte"))).drop(block, values)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``size`` bytes of text, or one longer text."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(text)).to_pylist()
        first = held = 0
        for at, length in enumerate(lengths):
            if held and held + (length or 0) > size:
                yield batch.slice(first, at - first)
                first, held = at, 0
            held += length or 0
        if first < len(lengths):
            yield batch.slice(first)


def give_back() -> None:
    """Return to the system what this worker has freed: it lives on, beside others, while later tasks run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def tidy(run: Callable) -> Callable:
    """The same function of batches, which gives memory back at the end of its task."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` turns one slice of rows into one Arrow batch."""

    def run(batches):
        for piece in slices(batches):
            yield fn(piece)

    return df.mapInArrow(tidy(run), schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge table (a, b); the component is its least node.

    Each round ties every node to its least neighbour, follows these ties to their ends, and goes on with the
    edges between ends. Ends are fewer than half of the nodes or close to it, so rounds are few and each is
    smaller than the last; following takes as many steps as the logarithm of the longest chain. All steps are
    joins of stored tables, so a node with very many edges is split by adaptive execution.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = materialise(both.where("a <> b").distinct(), "links")
    found = materialise(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up")), "ups")
    ends = _ends(found)
    whole = ends
    while True:
        at = ends.select(F.col("node").alias("a"), F.col("up").alias("x"))
        to = ends.select(F.col("node").alias("b"), F.col("up").alias("y"))
        left = links.join(at, "a").join(to, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        links = materialise(left.distinct(), "links")
        if not links.head(1):
            return whole.select("node", F.col("up").alias("component"))
        found = materialise(links.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up")), "ups")
        ends = _ends(found)
        last = ends.select(F.col("node").alias("up"), F.col("up").alias("end"))
        whole = whole.join(last, "up", "left").select("node", F.coalesce("end", "up").alias("up"))


def _ends(ups: DataFrame) -> DataFrame:
    """Follow (node, up) until every ``up`` is its own."""
    while True:
        nexts = ups.select(F.col("node").alias("up"), F.col("up").alias("next"))
        further = materialise(ups.join(nexts, "up").select("node", "up", "next"), "ends")
        if not further.where("next <> up").head(1):
            return ups
        ups = further.select("node", F.col("next").alias("up"))
