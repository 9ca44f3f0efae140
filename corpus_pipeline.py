"""Documents to packed training sequences, stage by stage.

Every stage but the last returns the columns of its input. A stage's rows are stored before the next one reads
them, so each works on all that its predecessor kept, and a lost executor costs one stage at most. What a stage wrote
for itself is removed when the next one begins, so a stage's frame is stored or done with by then. Names that stages add to rows for a while are none of the input's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language, mixing, ngram_join, packing, secret_scan
from millrace.llm.common import by_row, fresh, hashable, numbered, with_value
from millrace.session import held, made, materialise, release, scratch

#: Bytes of an Arrow batch handed to a Python worker, so that very long texts come few at a time.
BATCH_BYTES = 8 << 20
#: Copies share this much of their runs of so many words.
COPY_WORDS, COPY_NUM, COPY_DEN = 5, 8, 10

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch files of each stage's last call, by its name. Those of the last stage stay, as its frame reads them.
_own: dict[str, list[str]] = {}


def stage(after: str | None = None) -> Callable[[Stage], Stage]:
    """A stage that first removes the scratch files of the stage ``after`` which it comes, whose rows are stored by now."""

    def decorate(work: Stage) -> Stage:
        @wraps(work)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            release(spark, _own.pop(after, []))
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
            first = made()
            out = work(spark, docs, sf_dir)
            _own[work.__name__] = held(first)
            return out

        return run_stage

    return decorate


@stage()
def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that can have a language: those without text or letters go. Profiles come from the labelled rows.

    Without any labelled row there is no profile, and every text with letters stays.
    """
    found = fresh(docs, "__language")
    known = docs.withColumn(found, language.predict(language.train(docs), F.col("text")))
    return known.where(F.col(found)["letters"]).select(*docs.columns)


@stage("with_language")
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that shares four fifths of its runs of five words: the one with the least id, null last.

    Rows are linked as rows, whether or not their ids repeat. Of rows with equal ids the least hash stays.
    Rows without words are linked with nothing and stay.
    """
    row, gone = fresh(docs, "__row"), fresh(docs, "__gone")
    rows = numbered(docs, row)
    groups = ngram_join.components_of(rows.select(F.col(row).alias("doc_id"), "text"), COPY_WORDS, COPY_NUM, COPY_DEN)
    others = groups.where("doc_id <> component_id").select("doc_id", "component_id")
    members = materialise(others.union(others.select("component_id", "component_id").distinct()), "members")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*hashable(docs)).alias("hash"), F.col(row).alias("row"))
    places = rows.select(F.col(row).alias("member"), place.alias("place"))
    placed = members.join(places, F.col("member") == members["doc_id"])
    least = placed.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.row").alias("doc_id"))
    dropped = members.join(materialise(least, "least"), "doc_id", "left_anti").select("doc_id", F.lit(1).alias("gone"))
    told = with_value(rows, row, by_row(dropped, "doc_id", "gone"), gone)
    return told.where(F.col(gone) == 0).select(*docs.columns)


@stage("without_copies")
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret found."""
    return secret_scan.redact(docs, scratch(spark, "ledger"))


@stage("without_secrets")
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those it passes over go. Told by row, whether or not ids repeat."""
    number, copies = fresh(docs, "__number"), fresh(docs, "__copies")
    rows = numbered(docs, number)
    decided = mixing.mix(rows, carry=[number]).select(number, "copies")
    told = with_value(rows, number, by_row(decided, number, "copies"), copies)
    return mixing.repeated(told, copies).select(*docs.columns)


@stage("mixed")
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: one row per piece of a document, with its ids."""
    return packing.pack(docs)


STAGES = [
    ("language", with_language),
    ("copies", without_copies),
    ("secrets", without_secrets),
    ("mix", mixed),
    ("packing", packed),
]

# Language profiles and tokenizer ids are beyond SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = materialise(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
