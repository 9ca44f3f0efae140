"""Document fingerprints by MinHash, and near-duplicate classes from them.

A fingerprint has one slot for each of many universal hash functions: the least value the function takes over the
document's shingles of five words, of which 16 bits are kept. The share of equal slots estimates the Jaccard
similarity of two shingle sets. Near duplicates meet in Spark by bands of slots, and every link is verified by
the Jaccard similarity of the whole sets.

A null or empty text, or one without words, has a fingerprint of its own kind: alike (1) to another such
text, unlike (0) to any other. A text of fewer than five words is one shingle. Equal texts have equal
fingerprints. Rows that repeat an id are rows of their own, next to each other in the order of their texts'
hashes. A null doc_id comes first. An empty table gives no rows; a single document is its own next
one. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import similar_sets
from millrace.llm.common import BLOCKS_PER_TASK, TASK_BYTES, map_arrow, slices, task_count, texts, with_block
from millrace.llm.shingles import shingles
from millrace.session import materialise

SLOTS = 128
SHINGLE = 5
BANDS = 32
#: Shingles hashed at once, to stay within a core's cache.
_STEP = 1024

_random = np.random.default_rng(7)
_FACTORS = _random.integers(1, 1 << 63, SLOTS, dtype=np.uint64)[:, None] | np.uint64(1)
_ADDED = _random.integers(0, 1 << 63, SLOTS, dtype=np.uint64)[:, None]
_EMPTY = np.full(SLOTS, 0xFFFF, dtype=np.uint16)


def fingerprint(text: str, size: int = SHINGLE) -> np.ndarray:
    """The slots as unsigned 16-bit numbers."""
    hashes = shingles(text, size)
    if not len(hashes):
        return _EMPTY
    least = np.full(SLOTS, 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(hashes), _STEP):
        values = (hashes[at : at + _STEP] * _FACTORS + _ADDED) >> np.uint64(32)
        np.minimum(least, values.min(axis=1), out=least)
    # 0xFFFF is left to texts without words.
    return np.minimum(least & np.uint64(0xFFFF), np.uint64(0xFFFE)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


FOUND = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints_with_next(docs: DataFrame) -> DataFrame:
    """FOUND for every row: its fingerprint, that of its edited text, and how like the next document's is.

    The next row is the following one in the order of doc_id, after the last the first. Texts are shuffled once
    into blocks of ids; the first row of a block also goes to the block before it.
    """
    rows = texts(docs).withColumn("__hash", F.xxhash64("text"))
    tasks = task_count(rows, F.octet_length("text"), TASK_BYTES)
    cut = with_block(rows, F.col("doc_id"), F.col("__hash"), BLOCKS_PER_TASK * tasks)
    # One row per block: its first document, and the block before it among those that have rows.
    known = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    heads = materialise(cut.groupBy("__block").agg(F.min(F.struct(known.alias("id"), "__hash")).alias("head")), "heads")
    # One row per block in these windows.
    along, whole = Window.orderBy("__block"), Window.partitionBy()
    before = F.coalesce(F.lag("__block").over(along), F.max("__block").over(whole))
    lead = heads.select(F.col("head.id").alias("__id"), F.col("head.__hash").alias("__h"), before.alias("__to"))
    # Blocks of rows alike in id and text begin alike: one of these rows is handed to each block before.
    firsts = rows.join(F.broadcast(lead.select("__id", "__h").distinct()), (known == F.col("__id")) & (F.col("__hash") == F.col("__h")))
    copies = firsts.dropDuplicates(["__id", "__h"]).join(F.broadcast(lead), ["__id", "__h"])
    copies = copies.select(F.col("__to").alias("__block"), F.lit(1).alias("__copy"), "doc_id", "__hash", "text")
    own = cut.select("__block", F.lit(0).alias("__copy"), "doc_id", "__hash", "text")

    def run(batches):
        held = None  # block, id, text, fingerprint of the row that waits for its next

        for batch in slices(batches):
            out = []
            columns = [batch[c].to_pylist() for c in ("__block", "__copy", "doc_id", "text")]
            for block, copy, doc, text in zip(*columns, strict=True):
                own = fingerprint(text)
                if held is not None and held[0] == block:
                    _, last, was, slots = held
                    new = edited(was, text)
                    new_slots = fingerprint(new)
                    digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    shown = (slots.astype(">u2").tobytes().hex(), new_slots.astype(">u2").tobytes().hex())
                    out.append((last, len(was), digest, *shown, likeness(slots, new_slots), likeness(slots, own)))
                held = None if copy else (block, doc, text, own)
            kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
            values = zip(*out, strict=True) if out else [()] * len(kinds)
            names = [c.split()[0] for c in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

    dealt = own.unionByName(copies).repartition(tasks, "__block").sortWithinPartitions("__block", "__copy", "doc_id", "__hash")
    return dealt.mapInArrow(run, FOUND)


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, slots) with the slots as an array of integers."""

    def run(batch):
        found = [fingerprint(t, size).tolist() for t in batch["text"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(pa.int32()))], ["doc_id", "slots"])

    return map_arrow(texts(docs), run, "doc_id long, slots array<int>")


def near_duplicates(docs: DataFrame, num: int = 8, den: int = 10, size: int = SHINGLE, bands: int = BANDS) -> DataFrame:
    """(doc_id, class_id): documents linked by a verified Jaccard similarity of num/den or more share a class.

    Documents whose slots agree in a whole band are candidates. With 32 bands of 4 slots a pair at 0.8 is missed
    with a chance below 1e-7. A band's documents are tied to the least one of them, not to each other;
    ``similar_sets.classes`` then compares whole sets within tied families and in bounded blocks.
    """
    sets = materialise(similar_sets.set_table(docs, size), "sets")
    width = SLOTS // bands
    slots = signatures(docs.where("doc_id is not null"), size).where(F.col("slots")[0] != int(_EMPTY[0]))
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b, F.slice("slots", b * width + 1, width)))
    banded = materialise(slots.select(F.col("doc_id").alias("a"), F.explode(keys).alias("band")).select("a", F.xxhash64("band").alias("band")), "bands")
    least = materialise(banded.groupBy("band").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1"), "least")
    ties = banded.join(least, "band").select("a", "b").where("a <> b")
    return similar_sets.classes(docs, sets, ties, size, num, den).select("doc_id", F.col("component_id").alias("class_id"))
