"""Streams over files written from the shared tables, run until all files are processed."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import features as E
from millrace.operators import models as ML
from millrace.operators import sampling as S
from millrace.plans.features import priced
from millrace.plans.registry import Tables, query
from millrace.session import materialise, scratch
from millrace.sources.files import write_csv
from millrace.streaming import files as ST
from millrace.streaming import keyed
from millrace.streaming.online import OnlineKMeans, OnlineLinear, StateTable

# Input is cut by size; a batch takes a few files.
_ROWS = 250_000
_FILES_PER_BATCH = 4


@query("stream_files", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    path = scratch(t.spark, "events-in")
    write_csv(rows, path, maxRecordsPerFile=_ROWS)
    return ST.run_to_files(ST.csv_stream(t.spark, path, rows.schema, _FILES_PER_BATCH), scratch(t.spark, "events-out"))


def _heart_like(t: Tables) -> tuple[Pipeline, DataFrame, DataFrame]:
    rows = priced(t).select(
        "o_orderkey", "c_mktsegment", "o_orderpriority", "c_acctbal", F.round("o_totalprice", 2).alias("o_totalprice"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )
    chain = E.stage_chain(["c_mktsegment", "o_orderpriority"], ["c_acctbal", "o_totalprice"])
    stages = Pipeline(stages=[*chain.getStages(), ML.classifiers("label")["logistic"]])
    # Stored: one scan for both parts, and every fitted stage reads the first one again.
    marked = materialise(S.mark_split(rows, "o_orderkey", 70), "marked")
    return stages, marked.where("part = 'train'").drop("part"), marked.where("part = 'test'").drop("part")


@query("stream_ml_score")
def _(t: Tables):
    stages, train, test = _heart_like(t)
    model = stages.fit(train)
    path = scratch(t.spark, "score-in")
    write_csv(test, path, maxRecordsPerFile=_ROWS)
    stream = ST.csv_stream(t.spark, path, test.schema, _FILES_PER_BATCH)
    return ST.run_to_files(ST.score_stream(model, stream, ["o_orderkey", "label"]), scratch(t.spark, "score-out"))


def _points(t: Tables) -> DataFrame:
    """Line items as labelled points: price in thousands against three small numbers."""
    return t.lineitem.select(
        "l_returnflag",
        F.round(F.col("l_extendedprice") / 1000, 5).alias("label"),
        (F.col("l_quantity") / 50).alias("a"), (F.col("l_discount") * 10).alias("b"), (F.col("l_tax") * 10).alias("c"),
    ).withColumns({n: F.round(n, 4) for n in "abc"})


def _point_lines(t: Tables, path: str, rows: DataFrame) -> str:
    line = F.concat(F.lit("("), F.col("label").cast("string"), F.lit(",["), F.concat_ws(",", "a", "b", "c"), F.lit("])"))
    out = scratch(t.spark, path)
    rows.select(line.alias("value")).write.option("maxRecordsPerFile", _ROWS).text(out)
    return out


@query(
    "stream_labeled_parse",
    """SELECT round(l_extendedprice / 1000, 5) AS label, round(l_quantity / 50, 4) AS a, round(l_discount * 10, 4) AS b, round(l_tax * 10, 4) AS c
       FROM lineitem""",
)
def _(t: Tables):
    path = _point_lines(t, "points", _points(t))
    parsed = ST.parse_labelled(ST.text_stream(t.spark, path))
    elements = [F.get("features", F.lit(i)).alias(n) for i, n in enumerate("abc")]
    return ST.run_to_files(parsed.select("label", *elements), scratch(t.spark, "points-out"))


@query("stream_linear_sgd")
def _(t: Tables):
    rows = _points(t)
    train = _point_lines(t, "sgd-train", rows.where("l_returnflag <> 'N'"))
    test = _point_lines(t, "sgd-test", rows.where("l_returnflag = 'N'"))
    model = OnlineLinear(features=3, step=0.2, iterations=25, states=StateTable(t.spark, scratch(t.spark, "sgd-state")))
    ST.run_batches(ST.parse_labelled(ST.text_stream(t.spark, train, _FILES_PER_BATCH)), model.update, scratch(t.spark, "sgd-log"))
    fresh = ST.parse_labelled(ST.text_stream(t.spark, test))
    return ST.run_to_files(fresh.select("label", model.predict().alias("prediction")), scratch(t.spark, "sgd-out"))


@query("stream_linear_keyed")
def _(t: Tables):
    """A linear model for each return flag, moved on by every batch: what each knows after the last one."""
    rows = _points(t).select("l_returnflag", "label", F.array("a", "b", "c").alias("features"))
    path = scratch(t.spark, "keyed-in")
    rows.write.option("maxRecordsPerFile", _ROWS).parquet(path)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _FILES_PER_BATCH).parquet(path)
    updates = keyed.run_updates(keyed.keyed_linear(stream, "l_returnflag", OnlineLinear(features=3)), scratch(t.spark, "keyed-out"))
    return keyed.newest(updates).drop("dropped")


_START = [[0.2, 0.2, 0.2], [0.8, 0.8, 0.6]]


def _nearest_sql(table: str, *names: str) -> str:
    def distance(prefix: str) -> str:
        return " + ".join(f"pow({n} - {prefix}{n}, 2)" for n in names)

    return f"CASE WHEN {distance('u')} <= {distance('v')} THEN 0 ELSE 1 END"


@query(
    "stream_kmeans",
    f"""WITH p AS (SELECT l_returnflag, round(l_extendedprice / 1000, 5) AS label, round(l_quantity / 50, 4) AS a, round(l_discount * 10, 4) AS b,
                          round(l_tax * 10, 4) AS c FROM lineitem),
        s AS (SELECT 0.2::DOUBLE AS ua, 0.2::DOUBLE AS ub, 0.2::DOUBLE AS uc, 0.8::DOUBLE AS va, 0.8::DOUBLE AS vb, 0.6::DOUBLE AS vc),
        k AS (SELECT p.*, {_nearest_sql('p', 'a', 'b', 'c')} AS cluster FROM p, s WHERE l_returnflag <> 'N'),
        n AS (SELECT (0.2 + sum(CASE WHEN cluster = 0 THEN a END)) / (1 + sum(1 - cluster)) AS ua, (0.2 + sum(CASE WHEN cluster = 0 THEN b END)) / (1 + sum(1 - cluster)) AS ub,
                     (0.2 + sum(CASE WHEN cluster = 0 THEN c END)) / (1 + sum(1 - cluster)) AS uc, (0.8 + sum(CASE WHEN cluster = 1 THEN a END)) / (1 + sum(cluster)) AS va,
                     (0.8 + sum(CASE WHEN cluster = 1 THEN b END)) / (1 + sum(cluster)) AS vb, (0.6 + sum(CASE WHEN cluster = 1 THEN c END)) / (1 + sum(cluster)) AS vc FROM k)
        SELECT label, a, b, c, ({_nearest_sql('p', 'a', 'b', 'c')})::INTEGER AS cluster FROM p, n WHERE l_returnflag = 'N'""",
)
def _(t: Tables):
    rows = _points(t)
    train = _point_lines(t, "kmeans-train", rows.where("l_returnflag <> 'N'"))
    test = _point_lines(t, "kmeans-test", rows.where("l_returnflag = 'N'"))
    model = OnlineKMeans(centres=_START, weight=1.0, decay=1.0, states=StateTable(t.spark, scratch(t.spark, "kmeans-state")))
    # All files in one batch: the SQL side makes one update.
    ST.run_batches(ST.parse_labelled(ST.text_stream(t.spark, train)), model.update, scratch(t.spark, "kmeans-log"))
    fresh = ST.parse_labelled(ST.text_stream(t.spark, test))
    elements = [F.get("features", F.lit(i)).alias(n) for i, n in enumerate("abc")]
    return ST.run_to_files(fresh.select("label", *elements, model.predict().alias("cluster")), scratch(t.spark, "kmeans-out"))
