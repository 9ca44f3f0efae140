"""File streams: read what has arrived in small batches, apply a frame function, write exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.files import STRICT, as_text, fitting


def _per_batch(files: int | None) -> dict[str, int]:
    return {} if files is None else {"maxFilesPerTrigger": files}


def csv_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """CSV files with a header as a stream; records that do not fit are dropped, leading blanks trimmed."""
    rows = spark.readStream.schema(as_text(schema)).options(header=True, **STRICT, **_per_batch(files_per_batch)).csv(path)
    return fitting(rows, schema)


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return spark.readStream.options(**_per_batch(files_per_batch)).text(path)


def run_to_files(stream: DataFrame, folder: str) -> DataFrame:
    """Process all files that are there, write the result and read it back.

    ``folder`` holds the rows, a log of the batches finished and one of the files read. Run again with the
    same folder, after a stop or for new files, the query neither skips nor repeats a batch.
    """
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/log")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], log: str) -> None:
    """Hand every batch to a function. With the same ``log`` folder a new run goes on after the last finished
    batch. The batch that a stop broke off comes again, so ``handle`` must be idempotent by batch number."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", log)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_stream(model: PipelineModel, stream: DataFrame, keep: list[str]) -> DataFrame:
    """Label, probability and prediction of a fitted pipeline, with the time of scoring."""
    scored = model.transform(stream)
    return scored.select(
        *keep,
        vector_to_array("probability").alias("probability"),
        "prediction",
        F.current_timestamp().alias("scored_at"),
    )


def parse_labelled(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(label,[v1,v2,...])`` lines to label and values; lines of another shape are dropped."""
    # Fixed value: the line format.
    shape = r"^\s*\(([^,\[\]()]+),\s*\[([^\[\]()]*)\]\)\s*$"
    label = F.regexp_extract(column, shape, 1).try_cast("double")
    values = F.split(F.regexp_extract(column, shape, 2), ",").try_cast("array<double>")
    parsed = lines.select(label.alias("label"), values.alias("features"))
    whole = F.size(F.array_compact("features")) == F.size("features")
    return parsed.where(F.col("label").isNotNull() & whole)
