"""Fitted stages: against plain counts, saved and loaded, on gaps, unseen values and empty tables."""

import random
from statistics import median_low

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators.stages import MedianImputer, MedianImputerModel, MultiHot, MultiHotModel, feature_pipeline


@pytest.fixture(scope="module")
def listings(spark):
    rng = random.Random(4)
    rows = [
        (i, rng.choice(["flat", "house", None, "room"]), rng.choice([None, round(rng.uniform(1, 9), 2)]), float(rng.randrange(400)),
         rng.choice([None, [], rng.sample(["wifi", "pool", "desk", "oven", "lift"], 3), ["wifi", "wifi"]]), rng.choice(["quiet place", "near the sea", ""]))
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "id long, kind string, score double, price double, amenities array<string>, title string")


def test_multi_hot(listings, tmp_path):
    model = MultiHot(inputCol="amenities", outputCol="held", size=3).fit(listings)
    rows = listings.select("amenities").collect()
    counts = {}
    for r in rows:
        for a in set(r[0] or []):
            counts[a] = counts.get(a, 0) + 1
    best = sorted(counts, key=lambda a: (-counts[a], a))[:3]
    assert model.getOrDefault("vocabulary") == best
    model.write().overwrite().save(str(tmp_path / "m"))
    for each in (model, MultiHotModel.load(str(tmp_path / "m"))):
        got = each.transform(listings).select("amenities", vector_to_array("held").alias("h")).collect()
        assert all(r["h"] == [float(a in (r["amenities"] or [])) for a in best] for r in got)


def test_median_imputer(spark, listings, tmp_path):
    rows = listings.withColumn("nothing", F.lit(None).cast("double"))
    model = MedianImputer(inputCols=["score", "price", "nothing"], outputCols=["s", "p", "n"]).fit(rows)
    known = [r["score"] for r in rows.select("score").collect() if r["score"] is not None]
    assert model.getOrDefault("medians")[0] == median_low(known) and np.isnan(model.getOrDefault("medians")[2])
    model.write().overwrite().save(str(tmp_path / "m"))
    for each in (model, MedianImputerModel.load(str(tmp_path / "m"))):
        got = each.transform(rows).collect()
        assert all(r["s"] == (median_low(known) if r["score"] is None else r["score"]) and r["n"] is None for r in got)


def test_chain_saved_and_loaded_gives_equal_rows(listings, tmp_path):
    chain = feature_pipeline(["kind"], ["score", "price"], {"price": 200.0}, ["amenities"], "title", 2, places=4, buckets=8)
    model = chain.fit(listings.where("id < 200"))
    model.write().overwrite().save(str(tmp_path / "chain"))
    shown = [vector_to_array(c).alias(c) for c in ("features", "components", "raw")]
    once, again = (m.transform(listings).select("id", "price", *shown).orderBy("id").collect() for m in (model, PipelineModel.load(str(tmp_path / "chain"))))
    assert once == again and len(once) == 300
    raw = np.array([r["raw"] for r in once])
    # Three kinds and one place for others less the last, two numbers, a flag, four amenities, eight buckets.
    assert raw.shape[1] == 3 + 2 + 1 + 4 + 8 and [r["features"] for r in once][0][: raw.shape[1]] == once[0]["raw"]
    assert [r["raw"][5] for r in once] == [float(r["price"] > 200) for r in once]
    # The components are those of the standardised training rows.
    train = raw[:200]
    spread = train.std(axis=0, ddof=1)
    standard = (raw - train.mean(axis=0)) / np.where(spread > 0, spread, np.inf)
    values, vectors = np.linalg.eigh(np.cov(standard[:200].T))
    found = np.array([r["components"] for r in once])
    for k in range(2):
        assert np.allclose(np.abs(standard @ vectors[:, -1 - k]), np.abs(found[:, k]), atol=1e-6)
