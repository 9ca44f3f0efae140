"""Tree fits over counted cells against fits over rows."""

import pytest
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.operators import models as ML
from millrace.operators.cells import CellError, as_cells
from millrace.operators.features import assembler
from millrace.operators.sampling import poisson_draw
from millrace.session import materialise

INPUTS = ["a", "b"]


class Stopped(Exception):
    """Raised in place of the search, once it is known what it would read."""


@pytest.fixture(scope="module")
def rows(spark):
    drawn = spark.range(0, 4000, numPartitions=4).select(
        (F.col("id") % 9 * 2.5).alias("a"), F.floor(F.rand(1) * 12).cast("double").alias("b"), (F.rand(2) * 10).alias("noise")
    )
    priced = drawn.withColumn("price", F.col("a") * 3 + F.when(F.col("b") > 7, 40).otherwise(F.col("b")) + F.col("noise"))
    return materialise(assembler(INPUTS).transform(priced), "rows")


def test_grid_reads_no_more_with_more_rows(spark, sf_dir, tmp_path, monkeypatch):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    repeated = lines.crossJoin(spark.range(8)).withColumn("l_orderkey", F.col("l_orderkey") + F.col("id") * 1_000_000).drop("id")
    repeated.write.parquet(f"{tmp_path}/lineitem.parquet")
    read = []

    def search(self, dataset, params=None):
        read.append(dataset.count())
        raise Stopped

    monkeypatch.setattr(CrossValidator, "fit", search)
    for folder in (sf_dir, str(tmp_path)):
        with pytest.raises(Stopped):
            entry.queries()["ml_grid_cv_reg"](spark, folder)
    # At most as many as 32 bins of each of three inputs allow in three folds; here quantity has more values than bins.
    assert read[1] <= 32 * 11 * 9 * 3 < lines.count() * 8 * 0.6


def test_boosted_trees_on_cells_are_those_on_rows(rows):
    boosted = ML.regressors("price")["boosted"]
    bins, cells, chosen = as_cells(rows, boosted, 0, "price", INPUTS, 3, 7)
    assert cells.count() == 9 * 12 * 3 and cells.agg(F.sum("n")).first()[0] == rows.count()
    by_rows, by_cells = boosted.fit(rows), chosen.fit(cells)
    error = ML.regression_evaluator("price").evaluate(by_rows.transform(rows))
    assert CellError().evaluate(by_cells.transform(cells)) == pytest.approx(error, rel=1e-9)
    assert ML.regression_evaluator("price").evaluate(by_cells.transform(bins.transform(rows))) == pytest.approx(error, rel=1e-9)
    assert by_cells.featureImportances.toArray() == pytest.approx(by_rows.featureImportances.toArray(), rel=1e-9)


def test_forest_on_cells_is_near_one_on_rows(rows):
    """Their bootstrap samples and choices of inputs are drawn apart, so the two differ as two seeds do."""
    forest, evaluator = ML.regressors("price")["forest"], ML.regression_evaluator("price")
    errors = [evaluator.evaluate(forest.copy({forest.seed: s}).fit(rows).transform(rows)) for s in range(1, 7)]
    bins, cells, chosen = as_cells(rows, forest, 10, "price", INPUTS, 3, 7)
    model = chosen.fit(cells)
    error = evaluator.evaluate(model.transform(bins.transform(rows)))
    assert error == pytest.approx(CellError().evaluate(model.transform(cells)), rel=1e-9)
    assert min(errors) * 0.85 <= error <= max(errors) * 1.15
    drawn = cells.agg(*[F.sum(f"n{i}") for i in range(10)]).first()
    # Poisson sums over 4000 rows: five standard deviations, and no two samples alike.
    assert all(abs(n - 4000) < 5 * 4000**0.5 for n in drawn) and len(set(drawn)) > 5


def test_grid_gives_the_best_model_for_rows(rows):
    forest = ML.regressors("price")["forest"]
    model, table = ML.grid_search(rows, forest, {"maxDepth": [1, 4], "numTrees": [2, 3]}, ML.regression_evaluator("price"), 3, 7, inputs=INPUTS)
    found = {r["params"]: r for r in table.collect()}
    assert len(found) == 4
    best = next(r for r in found.values() if r["best"])
    assert "maxDepth=4" in best["params"]
    assert ML.regression_evaluator("price").evaluate(model.transform(rows)) == pytest.approx(best["score"], rel=0.2)


def test_missing_label_fails_as_in_rows(rows):
    missing = rows.withColumn("price", F.when(F.col("b") != 3, F.col("price")))
    boosted = ML.regressors("price")["boosted"]
    _, cells, chosen = as_cells(missing, boosted, 0, "price", INPUTS, 3, 7)
    for estimator, frame in ((boosted, missing), (chosen, cells)):
        with pytest.raises(Exception, match="(?i)label"):
            estimator.fit(frame)


def test_poisson_draws(spark):
    k = spark.range(0, 20000, numPartitions=3).select(poisson_draw(1.0, 5).alias("k"))
    found = k.agg(F.avg("k"), F.var_pop("k"), F.avg((F.col("k") == 0).cast("int"))).first()
    assert found[0] == pytest.approx(1, abs=0.04) and found[1] == pytest.approx(1, abs=0.08) and found[2] == pytest.approx(0.3679, abs=0.02)
