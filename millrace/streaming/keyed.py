"""A model for each key of a stream, kept in the state store and dropped when its key falls silent.

Every task first reduces its rows to the sums of each key (X'X, X'y and their number), so a key with a third of a batch
sends one row a task to its model. The state store keeps the models by key, with the stream's own checkpoints: a
stream that stops goes on where it was. A timer of a key is set anew with each batch that has the key.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.streaming.online import OnlineLinear

RESULT = "key string, weights array<double>, rows long, batches long, dropped boolean"
STATE = "weights array<double>, rows long, batches long"


def sums_by_key(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, xx, xy): of each task's (key, label, features array), the sums of each key; a null key is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        for batch in batches:
            features = np.array(batch["features"].to_pylist(), dtype=float).reshape(batch.num_rows, -1)
            label = batch["label"].to_numpy(zero_copy_only=False).astype(float)
            coded = batch["key"].dictionary_encode()
            for i, name in enumerate(coded.dictionary.to_pylist()):
                some = coded.indices.to_numpy() == i
                x, y = features[some], label[some]
                held = sums.setdefault(name, [0, 0.0, 0.0])
                held[0] += len(y)
                held[1], held[2] = held[1] + x.T @ x, held[2] + x.T @ y
        names = list(sums)
        columns = [pa.array(names, pa.string()), pa.array([sums[k][0] for k in names], pa.int64())]
        columns += [pa.array([np.ravel(sums[k][i]).tolist() for k in names], pa.list_(pa.float64())) for i in (1, 2)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "n", "xx", "xy"])

    named = rows.where(rows[key].isNotNull()).selectExpr(f"CAST(`{key}` AS STRING) AS key", "label", "features")
    return named.mapInArrow(run, "key string, n long, xx array<double>, xy array<double>")


def keyed_linear(rows: DataFrame, key: str, model: OnlineLinear, idle_ms: int = 0) -> DataFrame:
    """RESULT after every batch for each of its keys: a linear model of the key, moved on by the batch.

    ``rows`` is a stream of (key, label, features). With ``idle_ms``, a key without rows for so long is dropped, which
    gives one more row of it; when it comes again, it starts anew. Write it in update mode.
    """
    start = model.weights().tolist()

    def shown(name: str, state: tuple, dropped: bool) -> pd.DataFrame:
        weights, seen, batches = state
        return pd.DataFrame({"key": [name], "weights": [list(weights)], "rows": [seen], "batches": [batches], "dropped": [dropped]})

    def move(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last = state.get
            state.remove()
            yield shown(name[0], last, True)
            return
        d = model.features
        n, xx, xy = 0, np.zeros((d, d)), np.zeros(d)
        for part in parts:
            n += int(part["n"].sum())
            xx += sum(np.reshape(x, (d, d)) for x in part["xx"])
            xy += sum(np.asarray(x) for x in part["xy"])
        weights, seen, batches = state.get if state.exists else (start, 0, 0)
        moved = (model.descend(xx / n, xy / n, np.array(weights, dtype=float)).tolist(), seen + n, batches + 1)
        state.update(moved)
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield shown(name[0], moved, False)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return sums_by_key(rows, key).groupBy("key").applyInPandasWithState(move, RESULT, STATE, "update", timeout)


def run_updates(stream: DataFrame, folder: str, timers: bool = False) -> DataFrame:
    """Process all files that are there and read back every update, with the number of its batch.

    With ``timers``, the stream runs on until a batch without rows has been through, so timers that are due have fired.

    ``folder`` holds the updates by batch and the log with the models. Run again with the same folder, the stream goes on
    with its models; a batch that a stop broke off is written anew in place of its first try.
    """
    spark = stream.sparkSession

    # A task for each core goes through several shards of the state, not a task for each shard in every batch: what a
    # task reports to the driver is as much for an empty shard as for a full one.
    tasks = spark.sparkContext.defaultParallelism

    def write(rows: DataFrame, batch: int) -> None:
        rows.coalesce(tasks).write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")

    writer = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/log")
    # With timers there is always another batch to come, so "all that is available" has no end.
    query = (writer.trigger(processingTime="0 seconds") if timers else writer.trigger(availableNow=True)).start()
    while timers and query.isActive:
        done = query.lastProgress
        if done is not None and not done["numInputRows"]:
            query.stop()
        time.sleep(0.1)
    query.awaitTermination()
    return spark.read.schema(f"{RESULT}, batch long").parquet(f"{folder}/rows")


def newest(updates: DataFrame) -> DataFrame:
    """The last update of every key."""
    last = F.max_by(F.struct(*[c for c in updates.columns if c != "key"]), "batch").alias("u")
    return updates.groupBy("key").agg(last).select("key", "u.*")
