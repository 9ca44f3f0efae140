"""Models updated by every batch of a stream.

Each batch is reduced to a few sums by one distributed aggregate; only those (d x d, or k x d
numbers) reach the driver, where the small update step runs. The state after each batch is written
to the shared folder under the batch number, which makes a repeated batch harmless: it starts again
from the state before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class StateTable:
    """States by batch number in a folder all executors and a restarted driver see.

    A state is written aside and then renamed, so a crash leaves the old state or the new one. A batch starts
    from the state of the one before it, whose folder is known by name; older ones are removed.
    """

    KEPT = 2

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, batch: int):
        return self._new(f"{self.path}/batch={batch}")

    def _batches(self) -> list[int]:
        """The few numbers there are."""
        if not self._files.exists(self._new(self.path)):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._new(self.path))]
        return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))

    def put(self, batch: int, state: dict) -> None:
        aside = f"{self.path}/new-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.parquet(aside)
        self._files.delete(self._at(batch), True)
        self._files.rename(self._new(aside), self._at(batch))
        for old in self._batches():
            if old <= batch - self.KEPT:
                self._files.delete(self._at(old), True)

    def before(self, batch: int | None = None) -> dict | None:
        """The state after the batch before this one, or the newest of all; None before the first batch."""
        if batch is None:
            batch = max(self._batches(), default=-1) + 1
        if not self._files.exists(self._at(batch - 1)):
            return None
        return json.loads(self.spark.read.schema("state string").parquet(f"{self.path}/batch={batch - 1}").first()["state"])


@dataclass
class OnlineLinear:
    """Linear model without intercept, moved by gradient steps on every batch.

    With A = X'X / n and b = X'y / n of the batch, step i is ``w -= step / sqrt(i) * (A w - b)``, so
    all steps of a batch need one pass over its rows. Stops early once a step changes the weights by
    less than ``tolerance`` of their length.
    """

    features: int
    step: float = 0.2
    iterations: int = 25
    tolerance: float = 0.001
    initial: Sequence[float] | None = None
    states: StateTable | None = field(default=None, repr=False)

    def weights(self, batch: int | None = None) -> np.ndarray:
        state = self.states.before(batch) if self.states else None
        if state is not None:
            return np.array(state["weights"])
        return np.zeros(self.features) if self.initial is None else np.array(self.initial, dtype=float)

    def update(self, rows: DataFrame, batch: int) -> None:
        """Fit step on a frame ``(label, features array)``; usable as a ``foreachBatch`` function."""
        d = self.features
        x = [F.get("features", F.lit(i)) for i in range(d)]
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        sums = [F.sum(x[i] * x[j]) for i, j in pairs] + [F.sum(v * F.col("label")) for v in x]
        row = rows.agg(F.count(F.lit(1)), *sums).first()
        n = row[0]
        if not n:
            # A state for every batch, as the next one looks for it.
            self.states.put(batch, {"weights": self.weights(batch).tolist()})
            return
        a = np.zeros((d, d))
        for value, (i, j) in zip(row[1 : 1 + len(pairs)], pairs, strict=True):
            a[i, j] = a[j, i] = value / n
        b = np.array(row[1 + len(pairs) :], dtype=float) / n
        self.states.put(batch, {"weights": self.descend(a, b, self.weights(batch)).tolist()})

    def descend(self, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        w = start
        for i in range(1, self.iterations + 1):
            moved = w - self.step / np.sqrt(i) * (a @ w - b)
            change, w = np.linalg.norm(moved - w), moved
            if change < self.tolerance * max(np.linalg.norm(w), 1.0):
                break
        return w

    def predict(self) -> Column:
        w = self.weights()
        terms = [F.lit(float(v)) * F.get("features", F.lit(i)) for i, v in enumerate(w)]
        return sum(terms[1:], terms[0])


@dataclass
class OnlineKMeans:
    """Cluster centres moved by every batch.

    A centre c of weight n that receives m rows with sum s becomes (c n a + s) / (n a + m) with weight
    n a + m, where a is the decay. With ``split_dying`` a centre whose weight has all but gone takes
    over half of the heaviest one.
    """

    centres: Sequence[Sequence[float]]
    weight: float = 1.0
    decay: float = 1.0
    split_dying: bool = False
    states: StateTable | None = field(default=None, repr=False)

    @staticmethod
    def random_centres(k: int, d: int, seed: int) -> list[list[float]]:
        return np.random.default_rng(seed).standard_normal((k, d)).tolist()

    def state(self, batch: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        found = self.states.before(batch) if self.states else None
        if found is not None:
            return np.array(found["centres"]), np.array(found["weights"])
        centres = np.array(self.centres, dtype=float)
        return centres, np.full(len(centres), float(self.weight))

    @staticmethod
    def nearest(centres: np.ndarray) -> Column:
        """Number of the closest centre; the first one on a tie."""

        def distance(c: np.ndarray) -> Column:
            gaps = [F.get("features", F.lit(i)) - F.lit(float(v)) for i, v in enumerate(c)]
            squares = [g * g for g in gaps]
            return sum(squares[1:], squares[0])

        entries = F.array(*[F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)])
        return F.array_min(entries)["i"]

    def update(self, rows: DataFrame, batch: int) -> None:
        centres, weights = self.state(batch)
        d = centres.shape[1]
        sums = [F.sum(F.get("features", F.lit(i))).alias(f"s{i}") for i in range(d)]
        found = (
            rows.withColumn("cluster", self.nearest(centres))
            .groupBy("cluster")
            .agg(F.count(F.lit(1)).alias("m"), *sums)
            .collect()
        )
        if not found:
            self.states.put(batch, {"centres": centres.tolist(), "weights": weights.tolist()})
            return
        received = np.zeros(len(centres))
        total = np.zeros_like(centres)
        for row in found:
            received[row["cluster"]] = row["m"]
            total[row["cluster"]] = [row[f"s{i}"] for i in range(d)]
        kept = weights * self.decay
        weights = kept + received
        filled = weights > 0
        centres[filled] = (centres[filled] * kept[filled, None] + total[filled]) / weights[filled, None]
        if self.split_dying:
            self._split(centres, weights)
        self.states.put(batch, {"centres": centres.tolist(), "weights": weights.tolist()})

    @staticmethod
    def _split(centres: np.ndarray, weights: np.ndarray) -> None:
        big, small = int(weights.argmax()), int(weights.argmin())
        if weights[small] < 1e-8 * weights[big]:
            weights[[big, small]] = (weights[big] + weights[small]) / 2
            shift = 1e-14 * np.maximum(np.abs(centres[big]), 1.0)
            centres[small] = centres[big] - shift
            centres[big] = centres[big] + shift

    def predict(self) -> Column:
        return self.nearest(self.state()[0])
