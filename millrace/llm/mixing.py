"""Mixing sources to target weights by systematic sampling.

The sources share the words of the whole table by weight; a target stops at ``most`` times the words
its source has, and what is over goes to the others by weight until no target is above. Every document of a
source has the same expected number of copies, target / words of the source. Within the source, in the
order of size, these are summed up from the first document, one random offset is added, and a document is
taken once for every integer that its step crosses. In the order of size, what is taken differs
from the target by less than one largest document.

A null or blank text has size 0, and is taken like any other document. Rows that repeat an id are rows of
their own. A null source is a source, the last in order. An empty table gives no rows. Reruns agree: the
offset and the order of equal sizes come from hashes of the seed with the source and the doc_id, and of the text
where rows of one size repeat an id.
Columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import fresh, number_rows
from millrace.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _share(value: Column, digits: int) -> Column:
    """A fraction below 1 from the first hexadecimal digits of an md5."""
    return F.conv(F.substring(value, 1, digits), 16, 10).cast("long") / F.lit(float(16**digits))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add order number, weight and target to (source, words, documents): one row per source in a window.

    A target is min(most * words, level * weight) for the one level at which the targets sum to all
    words. In the order of most * words / weight, the sources that stop are the first ones.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((number - 1) % len(weights) + 1).cast("int"))
    known = sources.select("*", number.cast("long").alias("number"), weight.alias("weight"))
    known = known.withColumn("docs_before", F.coalesce(F.sum("documents").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    whole, ratio = Window.partitionBy(), F.col("words") * float(most) / F.col("weight")
    earlier = Window.orderBy("ratio", "number").rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.sum(F.col("words") * most).over(earlier), F.lit(0))
    spent = F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    level = (F.sum("words").over(whole) - stopped) / (F.sum("weight").over(whole) - spent)
    levels = known.withColumn("ratio", ratio).withColumn("level", level)
    # The first source in that order whose share at its own level is below its limit sets the level.
    chosen = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True)
    final = chosen.over(Window.orderBy("ratio", "number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    limit = (F.col("words") * most).cast("double")
    target = F.when(F.col("level_all").isNull(), limit).otherwise(F.least(limit, F.col("level_all") * F.col("weight")))
    return levels.withColumn("level_all", final).withColumn("target", target).drop("ratio", "level", "level_all")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, seed: int = 1, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) and the columns to carry: one row per row of ``docs``.

    The texts are read once for their sizes. Places within a source come from one numbering of all rows
    by (source, size, hash), cut into blocks by value, so a source of any size is many tasks.
    """
    salt = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    # Within one id and size, the text decides.
    own = [word_count(F.col("text")).alias("size"), F.md5(salt).alias("__hash"), F.xxhash64("text").alias("__text")]
    rows = materialise(docs.select("doc_id", "source", *own, *carry), "sizes")
    stats = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("documents"))
    known = materialise(targets(materialise(stats, "sources"), weights, most), "targets").withColumnRenamed("source", "__source")
    joined = rows.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "weight", "documents")
    joined = materialise(joined, "joined")
    # Ascends with (source, size, hash); sizes beyond 2^26 words share a step and are ordered by hash.
    size = F.least("size", F.lit((1 << 26) - 1))
    key = F.col("number") * (1 << 42) + size * (1 << 16) + F.conv(F.substring("__hash", 1, 4), 16, 10).cast("long")
    numbered = number_rows(joined, key, F.xxhash64("__hash", "doc_id", "__text"), [key, F.col("__hash"), F.col("doc_id"), F.col("__text")], "__row")
    place = F.col("__row") - F.col("docs_before") + 1
    rate = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    offset = _share(F.md5(F.concat(F.lit(f"{seed}:source:"), F.coalesce("source", F.lit("")))), 5)
    crossed = lambda at: F.floor(rate * at + offset)
    copies = F.least(crossed(place) - crossed(place - 1), F.lit(most)).cast("long")
    return numbered.select("doc_id", "source", "size", F.col("words").alias("source_size"), "target", copies.alias("copies"), *carry)


def take(docs: DataFrame, copies: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` says; rows that repeat the key share its greatest number."""
    taken, number = fresh(docs, "__taken"), fresh(docs, "__copies")
    known = copies.groupBy(key).agg(F.max("copies").alias(number)).where(F.col(number) > 0)
    known = materialise(known.withColumnRenamed(key, taken), "copies")
    # A merge at every size, as what is taken grows with the table.
    joined = docs.join(known.hint("merge"), docs[key].eqNullSafe(F.col(taken)))
    return repeated(joined, number).select(*docs.columns)


def repeated(rows: DataFrame, number: str) -> DataFrame:
    """Every row as often as its column ``number`` says."""
    copies = F.explode(F.array_repeat(F.lit(1), F.col(number).cast("int")))
    return rows.where(F.col(number) > 0).withColumn(fresh(rows, "__copy"), copies).drop(fresh(rows, "__copy"))
