"""Token ids in directly addressable codes, written to files and read back.

A file is a table of segments. A segment holds the ids of consecutive documents (ascending doc_id) and
consists of levels of 8-bit chunks: level 0 has the lowest chunk of every id, level k the k-th chunk of those
ids that need it. A bitmap per level says which entries go on, and a rank directory counts the set bits
before every block of the bitmap. So id i is read by following its chunks: the place in the next level is the
rank of the bit in this one. Nothing else of the segment is decoded.

The container is Parquet, since only Spark's writers reach a cluster's store and commit a retried task's
output once. One row is one segment; a small table ``bases`` gives the number of ids before each block.

A null or empty text holds the end id alone. Rows that repeat a doc_id stand next to each other, in the
order of their texts' hashes. A null doc_id comes first. A document longer than a segment has a segment of
its own. An empty table gives an empty store. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import BLOCKS_PER_TASK, TASK_BYTES, bases, slices, task_count, texts, tidy, with_block
from millrace.llm.tokens import SLICE, default_path, encoder

END_ID = 1
SEGMENT_IDS = 1 << 17
#: Bits of a bitmap between two entries of its rank directory.
RANK_BITS = 512

SEGMENT = "__block long, segment long, first long, n_ids long, docs array<struct<doc_id:long,n:long>>, levels array<struct<chunks:binary,more:binary,ranks:binary>>"


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of one segment."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest > 0xFF
        padded = np.zeros(-(-len(more) // RANK_BITS) * RANK_BITS, dtype=bool)
        padded[: len(more)] = more
        counts = padded.reshape(-1, RANK_BITS).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4")
        levels.append({"chunks": (rest & 0xFF).astype(np.uint8).tobytes(), "more": np.packbits(padded, bitorder="little").tobytes(), "ranks": ranks.tobytes()})
        rest = rest[more] >> 8
    return levels


def read_ids(levels: list[dict[str, bytes]], places: np.ndarray) -> np.ndarray:
    """The ids at any places of a segment, each by its own chunks, bits and ranks."""
    at, out, open_ = places.astype(np.int64), np.zeros(len(places), dtype=np.uint32), np.arange(len(places))
    for k, level in enumerate(levels):
        chunks, bits = np.frombuffer(level["chunks"], np.uint8), np.frombuffer(level["more"], np.uint8)
        out[open_] |= chunks[at].astype(np.uint32) << np.uint32(8 * k)
        go = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        if not go.any():
            break
        at, open_ = at[go], open_[go]
        block = at // RANK_BITS
        # Bits of the block before the place: one masked row of the bitmap for each place asked for.
        rows = bits.reshape(-1, RANK_BITS // 8)
        step = max(1, (1 << 22) // RANK_BITS)
        inside = np.empty(len(at), dtype=np.int64)
        for s in range(0, len(at), step):
            part = np.unpackbits(rows[block[s : s + step]], axis=1, bitorder="little")
            inside[s : s + step] = (part * (np.arange(RANK_BITS) < (at[s : s + step] % RANK_BITS)[:, None])).sum(axis=1)
        at = np.frombuffer(level["ranks"], "<u4")[block].astype(np.int64) + inside
    return out


def read_all(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment: a level's entries that go on take the next level's in turn."""
    out = np.zeros(0, dtype=np.uint32)
    for level in reversed(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), bitorder="little")[: len(chunks)].astype(bool)
        chunks[more] |= out << np.uint32(8)
        out = chunks
    return out


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode the texts and write the store to ``path``. The texts are shuffled once, by blocks of ids."""
    file, end, spark = tokenizer or default_path(), end_id.to_bytes(4, "little"), docs.sparkSession
    rows, hash_ = texts(docs), F.xxhash64("text")
    tasks = task_count(rows, F.octet_length("text"), TASK_BYTES)
    cut = with_block(rows, F.col("doc_id"), hash_, BLOCKS_PER_TASK * tasks)

    def segments(batches):
        encode, held, block, number, first = encoder(file), [], None, 0, 0

        def flush():
            nonlocal held, number, first
            ids = np.frombuffer(b"".join(raw for _, raw in held), "<u4")
            docs = [{"doc_id": doc, "n": len(raw) // 4} for doc, raw in held]
            row = {"__block": block, "segment": number, "first": first, "n_ids": len(ids), "docs": docs, "levels": encode_levels(ids)}
            held, number, first = [], number + 1, first + len(ids)
            return pa.RecordBatch.from_pylist([row], schema=_segment_schema())

        size = 0
        for batch in slices(batches, size=SLICE):
            raws = encode(batch["text"])
            for at, doc, raw in zip(batch["__block"].to_pylist(), batch["doc_id"].to_pylist(), raws, strict=True):
                if held and (at != block or size + len(raw) // 4 >= segment_ids):
                    yield flush()
                    size = 0
                if at != block:
                    block, number, first = at, 0, 0
                held.append((doc, raw + end))
                size += len(raw) // 4 + 1
        if held:
            yield flush()

    ordered = cut.repartition(tasks, "__block").sortWithinPartitions("__block", "doc_id", hash_)
    ordered.select("__block", "doc_id", "text").mapInArrow(tidy(segments), SEGMENT).write.parquet(f"{path}/segments")
    stored = spark.read.parquet(f"{path}/segments").select("__block", "n_ids")
    bases(stored, ["n_ids"]).select("__block", F.col("__base_n_ids").alias("base")).write.parquet(f"{path}/bases")


def _segment_schema() -> pa.Schema:
    doc = pa.struct([("doc_id", pa.int64()), ("n", pa.int64())])
    level = pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])
    return pa.schema([
        ("__block", pa.int64()), ("segment", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("docs", pa.list_(doc)), ("levels", pa.list_(level)),
    ])


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with the global place of their first id. ``bases`` has one row per block of the writer."""
    base = spark.read.parquet(f"{path}/bases")
    whole = spark.read.parquet(f"{path}/segments").join(base, "__block")
    return whole.withColumn("first", F.col("first") + F.col("base")).drop("base")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, from the files; ids as little-endian unsigned 32-bit."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, at, out = read_all(row["levels"]).astype("<u4"), 0, []
                for doc in row["docs"]:
                    out.append((doc["doc_id"], row["first"] + at, doc["n"], ids[at : at + doc["n"]].tobytes()))
                    at += doc["n"]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    schema = "doc_id long, start long, n_tokens long, ids binary"
    return _segments(spark, path).select("first", "docs", "levels").mapInArrow(run, schema)


def read_tokens(spark: SparkSession, path: str, places: DataFrame, stride: int = SEGMENT_IDS) -> DataFrame:
    """(place, id) for any global places, one row each; places outside the store are left out.

    Places meet segments by an equi-join on runs of ``stride`` places. A segment's row travels once for
    each stride it touches; places of a segment are read from it in batches.
    """
    whole = _segments(spark, path).where("n_ids > 0")
    last = F.floor((F.col("first") + F.col("n_ids") - 1) / stride)
    strides = whole.withColumn("__stride", F.explode(F.sequence(F.floor(F.col("first") / stride), last)))
    asked = places.select(F.col("place").cast("long").alias("place")).where("place is not null")
    asked = asked.withColumn("__stride", F.floor(F.col("place") / stride))
    # Places of one stride come in groups of bounded size, so that a stride asked for often is many rows.
    group = F.pmod(F.xxhash64("place"), F.lit(64)).alias("__group")
    grouped = asked.groupBy("__stride", group).agg(F.collect_list("place").alias("places"))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = np.array(row["places"], dtype=np.int64)
                at = at[(at >= row["first"]) & (at < row["first"] + row["n_ids"])]
                ids = read_ids(row["levels"], at - row["first"]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids)], ["place", "id"])

    met = strides.join(grouped, "__stride").select("first", "n_ids", "levels", "places")
    return met.mapInArrow(run, "place long, id long")
