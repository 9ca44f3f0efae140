"""Streams equal batches however the rows are cut into files; online models equal a replay in numpy."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.plans.registry import Tables
from millrace.plans.streaming import _heart_like
from millrace.session import scratch
from millrace.sources.files import write_csv
from millrace.streaming import files as ST
from millrace.streaming import keyed
from millrace.streaming.online import OnlineKMeans, OnlineLinear, StateTable


def write_points(spark, batches):
    path = scratch(spark, "points")
    import os

    os.makedirs(path)
    for i, rows in enumerate(batches):
        with open(f"{path}/part-{i:03d}.txt", "w") as out:
            for label, x in rows:
                out.write(f"({label},[{','.join(map(str, x))}])\n")
        os.utime(f"{path}/part-{i:03d}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    return path


def make_batches(seed, sizes, d=3):
    rng = np.random.default_rng(seed)
    out = []
    for n in sizes:
        x = rng.random((n, d)).round(6)
        y = (x @ np.arange(1, d + 1) + 0.1 * rng.standard_normal(n)).round(6)
        out.append([(float(b), [float(v) for v in a]) for a, b in zip(x, y, strict=True)])
    return out


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 6), st.integers(1, 3))
def test_stream_equals_batch(spark, files, per_batch):
    frame = spark.range(100).select("id", (F.col("id") * 1.5).alias("v"))
    path = scratch(spark, "in")
    write_csv(frame, path, files=files)
    found = ST.run_to_files(ST.csv_stream(spark, path, frame.schema, per_batch), scratch(spark, "out"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, frame.collect()))


def test_malformed_records_are_dropped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,v\n  1,2.0\nx,3.0\n4,5.0\n")
    schema = spark.createDataFrame([], "id int, v double").schema
    found = ST.run_to_files(ST.csv_stream(spark, str(tmp_path / "in"), schema), scratch(spark, "dropped"))
    assert sorted(r["id"] for r in found.collect()) == [1, 4]


def test_scored_stream_equals_batch(spark, sf_dir):
    stages, train, test = _heart_like(Tables(spark, sf_dir))
    model = stages.fit(train)
    path = scratch(spark, "score")
    write_csv(test, path, files=3)
    found = ST.run_to_files(ST.score_stream(model, ST.csv_stream(spark, path, test.schema), ["o_orderkey"]), scratch(spark, "scored"))
    batch = model.transform(test).select("o_orderkey", "prediction")
    assert sorted((r["o_orderkey"], r["prediction"]) for r in found.collect()) == sorted(map(tuple, batch.collect()))


def replay_linear(batches, step, iterations, tolerance):
    w = np.zeros(len(batches[0][0][1]))
    for rows in batches:
        x, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
        for i in range(1, iterations + 1):
            gradient = x.T @ (x @ w - y) / len(y)
            new = w - step / np.sqrt(i) * gradient
            moved, w = np.linalg.norm(new - w), new
            if moved < tolerance * max(np.linalg.norm(w), 1.0):
                break
    return w


def test_online_linear_replay(spark):
    batches = make_batches(1, [40, 25, 60])
    model = OnlineLinear(3, 0.2, 25, states=StateTable(spark, scratch(spark, "linear")))
    ST.run_batches(ST.parse_labelled(ST.text_stream(spark, write_points(spark, batches), 1)), model.update, scratch(spark, "log"))
    assert model.weights() == pytest.approx(replay_linear(batches, 0.2, 25, 0.001), rel=1e-9)


def test_repeated_batch_changes_nothing(spark):
    frames = [spark.createDataFrame(b, "label double, features array<double>") for b in make_batches(2, [20, 20])]
    model = OnlineLinear(3, states=StateTable(spark, scratch(spark, "again")))
    for batch, frame in enumerate(frames):
        model.update(frame, batch)
    once = model.weights()
    model.update(frames[1], 1)
    assert model.weights() == pytest.approx(once)


@pytest.mark.parametrize("decay", [1.0, 0.5])
def test_online_kmeans_replay(spark, decay):
    batches = make_batches(3, [30, 50])
    start = [[0.1, 0.1, 0.1], [0.9, 0.9, 0.9]]
    model = OnlineKMeans(start, 1.0, decay, states=StateTable(spark, scratch(spark, "kmeans")))
    ST.run_batches(ST.parse_labelled(ST.text_stream(spark, write_points(spark, batches), 1)), model.update, scratch(spark, "log"))
    centres, weights = np.array(start), np.ones(2)
    for rows in batches:
        x = np.array([r[1] for r in rows])
        near = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        kept = weights * decay
        for c in range(2):
            m = (near == c).sum()
            centres[c] = (centres[c] * kept[c] + x[near == c].sum(axis=0)) / (kept[c] + m)
            weights[c] = kept[c] + m
    found, found_weights = model.state()
    assert found == pytest.approx(centres) and found_weights == pytest.approx(weights)


def test_dying_cluster_is_split(spark):
    model = OnlineKMeans([[0.0], [100.0]], 1.0, 0.0, split_dying=True, states=StateTable(spark, scratch(spark, "split")))
    model.update(spark.createDataFrame([([0.5],), ([1.5],)], "features array<double>"), 0)
    centres, weights = model.state()
    assert weights == pytest.approx([1.0, 1.0]) and centres[:, 0] == pytest.approx([1.0, 1.0])


def test_stopped_stream_goes_on(spark):
    """A run that breaks off in its second batch, started again with the same folders, equals an uncut one."""
    batches = make_batches(4, [30, 20, 40])
    path, log, states = write_points(spark, batches), scratch(spark, "log"), scratch(spark, "states")
    seen = []

    def run(stop_at=None):
        model = OnlineLinear(3, 0.2, 25, states=StateTable(spark, states))

        def handle(rows, batch):
            seen.append(batch)
            model.update(rows, batch)
            if batch == stop_at:
                raise RuntimeError("stop")

        ST.run_batches(ST.parse_labelled(ST.text_stream(spark, path, 1)), handle, log)
        return model

    with pytest.raises(Exception, match="stop"):
        run(stop_at=1)
    model = run()
    assert seen == [0, 1, 1, 2]
    assert model.weights() == pytest.approx(replay_linear(batches, 0.2, 25, 0.001), rel=1e-9)
    run()
    assert seen == [0, 1, 1, 2] and len(model.states._batches()) <= StateTable.KEPT


def test_stream_to_files_takes_up_new_files(spark):
    path, folder = write_points(spark, make_batches(5, [5, 5])), scratch(spark, "rows")
    read = lambda: ST.run_to_files(ST.parse_labelled(ST.text_stream(spark, path, 1)).select("label"), folder)
    assert read().count() == 10 and read().count() == 10
    with open(f"{path}/part-009.txt", "w") as out:
        out.write("(1.5,[1,2,3])\n")
    assert read().count() == 11


def test_empty_batch_keeps_the_state(spark):
    model = OnlineLinear(2, initial=[1.0, 2.0], states=StateTable(spark, scratch(spark, "empty")))
    empty = spark.createDataFrame([], "label double, features array<double>")
    model.update(empty, 0)
    model.update(spark.createDataFrame([(1.0, [1.0, 0.0])], empty.schema), 1)
    model.update(empty, 2)
    assert model.weights()[0] == pytest.approx(1.0) and model.weights()[1] == pytest.approx(2.0)


def keyed_batches(spark, batches, name):
    """Files of (k, label, features), one a batch, in the order given; a function that adds more of them."""
    path = scratch(spark, name)

    def add(more):
        import os
        import shutil

        for rows in more:
            at = len(os.listdir(path)) if os.path.exists(path) else 0
            aside = scratch(spark, "one")
            spark.createDataFrame(rows, KEYED).coalesce(1).write.parquet(aside)
            os.makedirs(path, exist_ok=True)
            part = next(f for f in os.listdir(aside) if f.startswith("part-"))
            shutil.copy(f"{aside}/{part}", f"{path}/b{at:03d}.parquet")
            os.utime(f"{path}/b{at:03d}.parquet", (1_700_000_000 + at, 1_700_000_000 + at))

    add(batches)
    return path, add


KEYED = "k string, label double, features array<double>"


def keyed_stream(spark, path, idle_ms=0):
    stream = spark.readStream.schema(KEYED).option("maxFilesPerTrigger", 1).parquet(path)
    return keyed.keyed_linear(stream, "k", OnlineLinear(features=2), idle_ms)


def two_keys(seed, n):
    rng = np.random.default_rng(seed)
    rows = [(k, x, y) for k in "ab" for x, y in rng.random((n if k == "a" else n // 3, 2))]
    return [(k, float(2 * x + 3 * y if k == "a" else x - y), [float(x), float(y)]) for k, x, y in rows] + [(None, 1.0, [0.0, 0.0])]


def test_keyed_models_go_on_after_a_stop(spark):
    """Two keys, cut after two of four batches: equal to the uncut run, and to a model for each key alone."""
    batches = [two_keys(i, 40 + i) for i in range(4)]
    whole, _ = keyed_batches(spark, batches, "whole")
    uncut = keyed.newest(keyed.run_updates(keyed_stream(spark, whole), scratch(spark, "uncut"))).orderBy("key").collect()
    cut, add = keyed_batches(spark, batches[:2], "cut")
    folder = scratch(spark, "cut-out")
    first = keyed.newest(keyed.run_updates(keyed_stream(spark, cut), folder)).collect()
    assert {r["batches"] for r in first} == {2}
    add(batches[2:])
    again = keyed.newest(keyed.run_updates(keyed_stream(spark, cut), folder)).orderBy("key").collect()
    assert [r["key"] for r in uncut] == ["a", "b"] and [r["batches"] for r in again] == [4, 4]
    for x, y in zip(uncut, again, strict=True):
        assert x["rows"] == y["rows"] and np.allclose(x["weights"], y["weights"], rtol=1e-9)
    model = OnlineLinear(features=2)
    for r in uncut:
        w = model.weights()
        for rows in batches:
            own = [(label, f) for k, label, f in rows if k == r["key"]]
            x, y = np.array([f for _, f in own]), np.array([label for label, _ in own])
            w = model.descend(x.T @ x / len(y), x.T @ y / len(y), w)
        assert np.allclose(w, r["weights"], rtol=1e-9)


def test_idle_keys_are_dropped(spark):
    """Key b comes once; its timer drops it, and when it comes again it starts anew."""
    only_a = [r for r in two_keys(5, 30) if r[0] == "a"]
    path, add = keyed_batches(spark, [two_keys(1, 30), only_a, only_a], "idle")
    folder = scratch(spark, "idle-out")
    updates = keyed.run_updates(keyed_stream(spark, path, 1), folder, timers=True).where("key = 'b'").orderBy("batch").collect()
    assert [r["dropped"] for r in updates] == [False, True] and updates[0]["weights"] == updates[1]["weights"]
    add([two_keys(2, 30)])
    last = keyed.newest(keyed.run_updates(keyed_stream(spark, path, 1), folder, timers=True)).where("key = 'b'").first()
    assert last["batches"] == 1


def test_keyed_batches_take_a_task_for_each_core(spark):
    """A task for every shard of the state reported to the driver in every batch, whatever the cores."""
    path, folder = scratch(spark, "many-keys"), scratch(spark, "many-keys-out")
    rows = spark.range(600).selectExpr("CAST(id % 300 AS STRING) AS k", "CAST(id AS DOUBLE) AS label", "array(1.0D, CAST(id % 7 AS DOUBLE)) AS features")
    rows.coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        stream = spark.readStream.schema(rows.schema).parquet(path)
        found = keyed.run_updates(keyed.keyed_linear(stream, "k", OnlineLinear(features=2)), folder)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found.count() == 300 and {r["rows"] for r in found.collect()} == {2}
    assert len(set(found.inputFiles())) <= spark.sparkContext.defaultParallelism
