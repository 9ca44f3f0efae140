"""The chunked path gives exactly what the plain window gives, also with one hot key, nulls and ties."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import evaluate as V
from millrace.operators import ordered as O
from millrace.operators import selection as S
from millrace.operators import windows as W


def rows(frame):
    def shown(v):
        return ("nan" if v != v else round(v, 9)) if isinstance(v, float) else v

    return sorted((tuple(map(shown, r)) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def series(spark):
    """A third of the rows under one key, one null key, values with ties and nulls."""
    rng = random.Random(5)
    data = []
    for i in range(1200):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(40)}")
        value = None if i % 37 == 0 else float(rng.randrange(25))
        data.append((key, i * 7 % 1200, value))
    return spark.createDataFrame(data, "key string, at int, value double").cache()


def plain(frame, keys, order, sums):
    window = Window.partitionBy(*keys).orderBy(*O.order_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    return frame.withColumns({n: F.sum(c).over(window) for n, c in sums.items()})


@pytest.fixture(autouse=True, params=[20, 100_000], ids=["cut", "whole"])
def chunk_rows(request, monkeypatch):
    """Everything holds with keys cut into chunks of some twenty rows, and with none cut."""
    monkeypatch.setattr(O, "CHUNK_ROWS", request.param)
    return request.param


def largest_chunk(frame, keys, order):
    chunks = O.with_chunk(frame, keys, order, O.cuts(frame, keys, order))
    return chunks.groupBy(*keys, O._CHUNK).count().agg(F.max("count")).first()[0]


def sums_of():
    return {"total": F.col("value"), "pos": F.lit(1)}


def test_running_sum_and_position(series):
    assert rows(O.running(series, ["key"], ["at"], sums_of())) == rows(plain(series, ["key"], ["at"], sums_of()))


def test_running_sum_descending_without_key(series):
    sums = {"pos": F.lit(1)}
    assert rows(O.running(series, [], ["-at"], sums)) == rows(plain(series, [], ["-at"], sums))


@pytest.mark.parametrize("order", [["day", "at"], ["-day", "at"], ["day", "-at"], ["-day", "-name"], ["name"], ["day", "name"]])
def test_hot_key_with_ties_nulls_and_strings(spark, order, chunk_rows):
    """Half of the rows share a key, most of those a day; half of the days are null, some NaN or infinite."""
    odd = {3: float("nan"), 4: float("inf"), 5: float("-inf")}
    data = [
        ("hot" if i % 2 else f"k{i % 9}", None if i % 4 < 2 else odd.get(i % 50, 7.0 if i % 5 else float(i % 30)), i * 13 % 1000, f"n{i * 7 % 1000:04}", float(i % 11))
        for i in range(1000)
    ]
    frame = spark.createDataFrame(data, "key string, day double, at int, name string, value double")
    assert rows(O.running(frame, ["key"], order, sums_of())) == rows(plain(frame, ["key"], order, sums_of()))
    if chunk_rows == 20:
        assert largest_chunk(frame, ["key"], order) <= 3 * 1000 / O.chunk_count(spark)
    else:
        assert O.cuts(frame, ["key"], order) is None


@pytest.mark.parametrize("block", [25, 60, 100_000])
def test_look_back(series, block):
    columns = {
        "mean": lambda w: F.avg("value").over(w.rowsBetween(-19, 0)),
        "last": lambda w: F.lag("value", 1).over(w),
    }
    window = Window.partitionBy("key").orderBy("at")
    wanted = series.withColumns({n: c(window) for n, c in columns.items()})
    assert rows(O.look_back(series, ["key"], ["at"], columns, 19, block)) == rows(wanted)


def test_ranks(series):
    for order in ("value", "-value"):
        window = Window.partitionBy("key").orderBy(*O.order_columns([order]))
        wanted = series.withColumns({"rank": F.rank().over(window), "dense_rank": F.dense_rank().over(window)})
        assert rows(O.ranks(series, ["key"], order)) == rows(wanted)


@pytest.mark.parametrize("keys", [[], ["key"]])
@pytest.mark.parametrize("kind", ["percentile_cont", "percentile_disc"])
def test_quantiles(series, keys, kind):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    picks = [F.expr(f"{kind}({p}D) WITHIN GROUP (ORDER BY value) AS {n}") for n, p in probs.items()]
    known = series.where("value IS NOT NULL")
    wanted = known.groupBy(*keys).agg(*picks) if keys else known.agg(*picks)
    assert rows(S.quantiles(series, keys, "value", probs, kind == "percentile_disc")) == rows(wanted)


def test_curve_with_many_scores(spark):
    rng = random.Random(2)
    data = [(rng.random(), rng.randrange(2)) for _ in range(600)]
    frame = spark.createDataFrame(data, "score double, label int")
    area = V.binary_areas(V.binary_curve(frame, "score", "label")).first()["roc_area"]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in data if x == 1 for b, y in data if y == 0]
    assert area == pytest.approx(sum(pairs) / len(pairs))


def test_empty_frame(spark):
    empty = spark.createDataFrame([], "key string, at int, value double")
    assert O.running(empty, ["key"], ["at"], {"n": F.lit(1)}).count() == 0
    assert O.look_back(empty, ["key"], ["at"], {"x": lambda w: F.lag("value").over(w)}, 1).count() == 0
    assert S.quantiles(empty, ["key"], "value", {"m": 0.5}).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-5, 5) | st.none()), min_size=1, max_size=60))
def test_running_sum_property(spark, data):
    frame = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(data)], "key string, at int, value double")
    assert rows(O.running(frame, ["key"], ["at"], {"total": F.col("value")})) == rows(plain(frame, ["key"], ["at"], {"total": F.col("value")}))
    assert rows(W.moving_avg(frame, "key", "at", "value", 1)) == rows(frame.withColumn("moving_avg", F.col("value")))


def test_order_keys_of_doubles(spark):
    """Integers in the order of the doubles, and the doubles back, at every scale."""
    rng = random.Random(9)
    values = [0.0, -0.0, float("inf"), float("-inf"), float("nan"), 5e-324, -5e-324, 2.0**-1022, 2.0**-1023, 1.7976931348623157e308, 1.0, 2.0, 0.1, 1 - 2.0**-53, 1 + 2.0**-52]
    values += [s * rng.random() * 2.0 ** rng.randrange(-1074, 1024) for s in (1, -1) for _ in range(400)] + [float(2**k) for k in range(-1000, 1000, 37)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = frame.select("v", S.order_key(F.col("v")).alias("k")).select("v", "k", S.key_value(F.col("k")).alias("back")).orderBy("v").collect()
    assert [r for r in got if (r["v"] is None) != (r["k"] is None)] == []
    keys = [r["k"] for r in got if r["k"] is not None]
    assert keys == sorted(keys) and len(set(keys)) == len({0.0 if v == 0 else v for v in values if v == v}) + 1
    assert all(r["back"] == r["v"] or r["v"] != r["v"] and r["back"] != r["back"] for r in got)


def test_medians_of_several_columns_together(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice([None, rng.gauss(0, 1), float("nan"), 1e300]), float(rng.randrange(5)), None) for _ in range(500)]
    frame = spark.createDataFrame(data, "key string, x double, y double, z double")
    for keys in ([], ["key"]):
        got = S.quantiles_of(frame, keys, ["x", "y", "z"], {"q": 0.3, "m": 0.5})
        for column in "xy":
            want = S.quantiles(frame, keys, column, {"q": 0.3, "m": 0.5})
            assert rows(got.where(F.col("column") == column).drop("column")) == rows(want)
        assert got.where("column = 'z'").count() == 0
    assert rows(S.quantiles(frame, [], "z", {"m": 0.5})) == [(None,)]
