"""Feature queries on orders, customers, line items and labels."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import numbers as M
from millrace.functions import nested as N
from millrace.operators import features as E
from millrace.operators import sampling as S
from millrace.operators.stages import feature_pipeline
from millrace.plans.registry import Tables, query
from millrace.plans.scalars import RATES, RATES_SQL
from millrace.session import materialise, scratch, spread

_LINES = ["l_orderkey", "l_linenumber", "l_partkey"]
_LINES_SQL = "l_orderkey, l_linenumber, l_partkey"


def priced(t: Tables):
    """Orders with the customer's segment and the region: the listing-like table."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


PRICED_SQL = """(SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                 JOIN region ON n_regionkey = r_regionkey)"""

_HASH = "('0x' || substr(md5(CAST({0} AS VARCHAR)), 1, 8))::BIGINT % 100"


@query(
    "fe_string_index",
    """WITH c AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' GROUP BY 1),
        i AS (SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS DOUBLE) AS idx FROM c)
       SELECT o_orderkey, o_orderpriority, idx AS o_orderpriority_index FROM orders JOIN i ON o_orderpriority = label""",
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    seen = rows.where("o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'")
    # A label the fitted rows did not have: its rows are left out.
    return E.indexer(["o_orderpriority"], "skip").fit(seen).transform(rows).drop("o_orderstatus")


@query(
    "fe_one_hot",
    """WITH i AS (SELECT c_mktsegment AS label, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS idx FROM customer GROUP BY 1)
       SELECT c_custkey, array_to_string(list_transform(generate_series(0, 3), lambda x: CASE WHEN x = idx THEN '1' ELSE '0' END), ',') AS code
       FROM customer JOIN i ON c_mktsegment = label""",
)
def _(t: Tables):
    rows = t.customer.select("c_custkey", "c_mktsegment")
    stages = Pipeline(stages=[E.indexer(["c_mktsegment"]), E.encoder(["c_mktsegment"])])
    code = vector_to_array("c_mktsegment_onehot").cast("array<int>").cast("array<string>")
    return stages.fit(rows).transform(rows).select("c_custkey", F.concat_ws(",", code).alias("code"))


@query("fe_assemble", f"SELECT {_LINES_SQL}, l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem")
def _(t: Tables):
    vectors = E.assembler(["l_quantity", "l_discount", "l_tax"]).transform(t.lineitem)
    return vectors.select(*_LINES, *N.vector_elements("features", 3))


@query(
    "fe_standard_scale",
    f"""WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_samp(l_extendedprice) AS sp FROM lineitem)
        SELECT {_LINES_SQL}, round((l_quantity - mq) / sq, 6) AS x0, round((l_extendedprice - mp) / sp, 6) AS x1 FROM lineitem, s""",
)
def _(t: Tables):
    scaled = E.standard_scale(t.lineitem, ["l_quantity", "l_extendedprice"])
    parts = N.vector_elements("scaled", 2)
    return scaled.select(*_LINES, *parts).withColumns({"x0": F.round("x0", 6), "x1": F.round("x1", 6)})


@query(
    "fe_minmax_scale",
    f"""WITH s AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_extendedprice) AS c, max(l_extendedprice) AS d FROM lineitem)
        SELECT {_LINES_SQL}, round((l_quantity - a) / (b - a), 6) AS x0, round((l_extendedprice - c) / (d - c), 6) AS x1, 0.5::DOUBLE AS x2 FROM lineitem, s""",
)
def _(t: Tables):
    scaled = E.minmax_scale(t.lineitem.withColumn("constant", F.lit(3.0)), ["l_quantity", "l_extendedprice", "constant"])
    return scaled.select(*_LINES, *N.vector_elements("scaled", 3)).withColumns({"x0": F.round("x0", 6), "x1": F.round("x1", 6)})


@query("fe_binarize", f"SELECT {_LINES_SQL}, CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0.0 END AS big FROM lineitem")
def _(t: Tables):
    return E.binarize(t.lineitem.select(*_LINES, "l_quantity"), "l_quantity", 25.0, "big").drop("l_quantity")


@query(
    "fe_impute",
    """WITH j AS (SELECT doc_id, CASE WHEN l.quality IS NOT NULL THEN n_chars END::DOUBLE AS a, CASE WHEN l.quality IS NOT NULL THEN n_chars END::DOUBLE AS b,
                         CASE WHEN l.quality IS NOT NULL THEN lang END AS c FROM documents LEFT JOIN labels l USING (doc_id)),
        m AS (SELECT avg(a) AS mean, quantile_disc(b, 0.5) AS med FROM j),
        o AS (SELECT c AS mode FROM j WHERE c IS NOT NULL GROUP BY c ORDER BY count(*) DESC, c LIMIT 1)
       SELECT doc_id, round(coalesce(a, mean), 6) AS a, coalesce(b, med) AS b, coalesce(c, mode) AS c FROM j, m, o""",
)
def _(t: Tables):
    joined = t.documents.join(t.labels, "doc_id", "left")
    known = F.col("quality").isNotNull()
    size = F.when(known, F.col("n_chars").cast("double"))
    gaps = joined.select("doc_id", size.alias("a"), size.alias("b"), F.when(known, F.col("lang")).alias("c"))
    return E.impute(gaps, {"a": "mean", "b": "median", "c": "mode"}).withColumn("a", F.round("a", 6))


@query(
    "fe_percent_price_parse",
    f"""SELECT {_LINES_SQL}, round(l_discount, 2) AS discount, l_extendedprice AS price, l_quantity < 2 AS unreadable FROM lineitem""",
)
def _(t: Tables):
    percent = F.concat(F.format_string("%.0f", F.col("l_discount") * 100), F.lit("%"))
    price = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    dirty = F.when(F.col("l_quantity") < 2, F.lit("N/A")).otherwise(percent)
    rows = t.lineitem.select(*_LINES, percent.alias("percent"), price.alias("price"), dirty.alias("dirty"))
    return rows.select(
        *_LINES,
        F.round(M.parse_percent("percent"), 2).alias("discount"),
        M.parse_price("price").alias("price"),
        M.parse_percent("dirty").isNull().alias("unreadable"),
    )


@query(
    "fe_iqr_filter",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem, q WHERE l_extendedprice BETWEEN 1000 AND q3 + 1.5 * (q3 - q1)""",
)
def _(t: Tables):
    return E.iqr_filter(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 1000)




@query(
    "fe_currency",
    f"""SELECT o_orderkey, round(o_totalprice / {RATES_SQL}, 6) AS dollars
        FROM {PRICED_SQL}""",
)
def _(t: Tables):
    rate = N.look_up("r_name", RATES, 1.0)
    return priced(t).select("o_orderkey", F.round(F.col("o_totalprice") / rate, 6).alias("dollars"))


@query(
    "fe_distance",
    f"""WITH p AS {PRICED_SQL}, c AS (SELECT r_name, avg(o_totalprice) AS a, avg(c_acctbal) AS b FROM p GROUP BY 1)
        SELECT o_orderkey, round(abs(o_totalprice - a) + abs(c_acctbal - b), 4) AS distance FROM p JOIN c USING (r_name)""",
)
def _(t: Tables):
    rows = priced(t).select("o_orderkey", "r_name", "o_totalprice", "c_acctbal")
    centres = rows.groupBy("r_name").agg(F.avg("o_totalprice").alias("a"), F.avg("c_acctbal").alias("b"))
    measured = E.group_distance(rows, centres, "r_name", {"o_totalprice": "a", "c_acctbal": "b"}, "distance")
    return measured.select("o_orderkey", F.round("distance", 4).alias("distance"))


@query("fe_occupancy", "SELECT p_partkey, round(1 - p_size / 60.0::DOUBLE, 8) AS occupancy FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", F.round(M.occupancy("p_size", 60.0), 8).alias("occupancy"))


@query(
    "fe_label_vs_group_mean",
    f"""WITH p AS (SELECT o_orderkey, c_mktsegment, o_totalprice, {_HASH.format('o_orderkey')} < 70 AS train FROM {PRICED_SQL}),
        m AS (SELECT c_mktsegment, avg(o_totalprice) AS mean FROM p WHERE train GROUP BY 1)
        SELECT o_orderkey, train, CASE WHEN o_totalprice > mean THEN 1 ELSE 0 END AS above FROM p LEFT JOIN m USING (c_mktsegment)""",
)
def _(t: Tables):
    rows = priced(t).select("o_orderkey", "c_mktsegment", "o_totalprice")
    marked = rows.withColumn("train", S.hash_bucket("o_orderkey") < 70)
    labelled = E.label_vs_group_mean(marked.where("train"), marked, "c_mktsegment", "o_totalprice", "above")
    return labelled.select("o_orderkey", "train", "above")


@query(
    "fe_pca",
    """WITH c AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
       SELECT 1 AS component, round((1 + r) / 2, 8) AS share FROM c UNION ALL SELECT 2, round((1 - r) / 2, 8) FROM c""",
)
def _(t: Tables):
    return E.pca_variance(spread(t.lineitem), ["l_quantity", "l_extendedprice"], 2).withColumn("share", F.round("share", 8))


@query("fe_pca_project")
def _(t: Tables):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return E.pca_project(spread(t.lineitem).select(*_LINES, *names), names, 2).drop(*names)


@query("fe_stage_chain")
def _(t: Tables):
    rows = priced(t).select("o_orderkey", "c_mktsegment", "o_orderpriority", "r_name", "c_acctbal", "o_totalprice")
    # Stored: every stage that is fitted reads the training rows once more.
    marked = materialise(S.mark_split(rows, "o_orderkey", 70), "chain")
    chain = E.stage_chain(["c_mktsegment", "o_orderpriority"], ["c_acctbal"], "r_name").fit(marked.where("part = 'train'"))
    return chain.transform(marked).select("o_orderkey", "part", vector_to_array("features").alias("features"))


@query("fe_pipeline")
def _(t: Tables):
    """The whole chain, fitted on the training rows, saved, loaded, and applied to all rows."""
    words = F.split(F.lower("o_orderpriority"), "[- ]+")
    gaps = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    rows = priced(t).select("o_orderkey", "c_mktsegment", "r_name", "n_name", gaps.alias("balance"), "o_totalprice", words.alias("marks"))
    marked = materialise(S.mark_split(rows, "o_orderkey", 70), "chain")
    chain = feature_pipeline(["c_mktsegment", "r_name"], ["balance", "o_totalprice"], {"o_totalprice": 150_000.0}, ["marks"], "n_name", 3)
    path = scratch(t.spark, "feature-pipeline")
    chain.fit(marked.where("part = 'train'")).write().save(path)
    applied = PipelineModel.load(path).transform(marked)
    return applied.select("o_orderkey", "part", vector_to_array("features").alias("features"), vector_to_array("components").alias("components"))


@query("txt_hash_tfidf")
def _(t: Tables):
    weighted = E.hash_tfidf(t.documents.select("doc_id", "text"), "text", 20)
    return weighted.select("doc_id", vector_to_array("tfidf").alias("tfidf"))
