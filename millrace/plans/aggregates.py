"""Aggregations on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.numbers import cents, cents_sql, mean_of_cents, mean_of_cents_sql
from millrace.operators import aggregates as A
from millrace.operators import correlation as C
from millrace.operators import text as X
from millrace.plans.registry import Tables, query

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_UNLISTED = "count(CASE WHEN p_type IS NULL OR p_type NOT IN (" + ", ".join(f"'{x}'" for x in TYPES) + ") THEN 1 END)"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "agg_group_having",
    """WITH g AS (SELECT l_partkey, avg(l_quantity) AS mean, count(*) AS n FROM lineitem
                  GROUP BY l_partkey HAVING count(*) >= 25)
       SELECT l_partkey, p_name, round(mean, 6) AS mean_quantity, n FROM g JOIN part ON l_partkey = p_partkey
       ORDER BY mean DESC, l_partkey""",
)
def _(t: Tables):
    popular = A.mean_and_count(t.lineitem, "l_partkey", "l_quantity", 25)
    return (
        popular.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_partkey", "p_name", F.round("mean", 6).alias("mean_quantity"), "n")
        .orderBy(F.col("mean_quantity").desc(), "l_partkey")
    )


@query("agg_count", "SELECT count(p_name) AS n_names, count(*) AS n_rows FROM part")
def _(t: Tables):
    return t.part.agg(F.count("p_name").alias("n_names"), F.count("*").alias("n_rows"))


@query("agg_count_distinct", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def _(t: Tables):
    return t.lineitem.agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query(
    "agg_first_last",
    """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last
       FROM orders GROUP BY o_custkey""",
)
def _(t: Tables):
    return A.first_last(t.orders, ["o_custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"])


@query("agg_min_max", "SELECT min(l_quantity) AS lowest, max(l_quantity) AS highest, max(l_extendedprice) AS top_price FROM lineitem")
def _(t: Tables):
    q, p = "l_quantity", "l_extendedprice"
    return t.lineitem.agg(F.min(q).alias("lowest"), F.max(q).alias("highest"), F.max(p).alias("top_price"))


@query("agg_sum", "SELECT sum(l_quantity) AS quantity, round(sum(l_extendedprice), 2) AS price FROM lineitem")
def _(t: Tables):
    return t.lineitem.agg(F.sum("l_quantity").alias("quantity"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("agg_sum_distinct", "SELECT sum(DISTINCT l_quantity) AS quantity FROM lineitem")
def _(t: Tables):
    return t.lineitem.agg(F.sum_distinct("l_quantity").alias("quantity"))


@query(
    "agg_mean_ratio",
    """SELECT count(l_quantity) AS n, sum(l_quantity) AS total, round(avg(l_quantity), 6) AS mean,
              round(sum(l_quantity) / count(l_quantity), 6) AS ratio FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.agg(*A.mean_ratio("l_quantity")).select(
        "n", "total", F.round("mean", 6).alias("mean"), F.round("ratio", 6).alias("ratio")
    )


@query(
    "agg_variance",
    """SELECT l_returnflag, round(var_pop(l_quantity), 6) AS var_pop, round(var_samp(l_quantity), 6) AS var_samp,
              round(stddev_pop(l_quantity), 6) AS sd_pop, round(stddev_samp(l_quantity), 6) AS sd_samp
       FROM lineitem GROUP BY l_returnflag""",
)
def _(t: Tables):
    q = "l_quantity"
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.var_pop(q), 6).alias("var_pop"),
        F.round(F.var_samp(q), 6).alias("var_samp"),
        F.round(F.stddev_pop(q), 6).alias("sd_pop"),
        F.round(F.stddev_samp(q), 6).alias("sd_samp"),
    )


@query(
    "agg_shape",
    """WITH m AS (SELECT avg(l_extendedprice) AS m FROM lineitem),
            c AS (SELECT avg(pow(l_extendedprice - m, 2)) AS m2, avg(pow(l_extendedprice - m, 3)) AS m3,
                         avg(pow(l_extendedprice - m, 4)) AS m4 FROM lineitem, m)
       SELECT round(m3 / pow(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM c""",
)
def _(t: Tables):
    price = "l_extendedprice"
    return t.lineitem.agg(F.round(F.skewness(price), 6).alias("skewness"), F.round(F.kurtosis(price), 6).alias("kurtosis"))


@query(
    "agg_corr_cov",
    """SELECT round(corr(l_quantity, l_extendedprice), 6) AS r, round(covar_samp(l_quantity, l_extendedprice), 3) AS cov_samp,
              round(covar_pop(l_quantity, l_extendedprice), 3) AS cov_pop FROM lineitem""",
)
def _(t: Tables):
    a, b = "l_quantity", "l_extendedprice"
    return t.lineitem.agg(
        F.round(F.corr(a, b), 6).alias("r"),
        F.round(F.covar_samp(a, b), 3).alias("cov_samp"),
        F.round(F.covar_pop(a, b), 3).alias("cov_pop"),
    )


@query(
    "agg_collect",
    "SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1, 2",
)
def _(t: Tables):
    return A.collect_values(t.customer, ["c_nationkey"], "c_mktsegment")


@query(
    "agg_group",
    f"""WITH g AS (SELECT o_orderstatus, o_orderpriority, count(o_totalprice) AS n, sum({cents_sql('o_totalprice')})::BIGINT AS c,
                         round(stddev_pop(o_totalprice), 4) AS deviation FROM orders GROUP BY 1, 2)
       SELECT o_orderstatus, o_orderpriority, n, {mean_of_cents_sql('c', 'n')} AS mean, deviation, c / 100::DOUBLE AS total FROM g""",
)
def _(t: Tables):
    p = "o_totalprice"
    grouped = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(p).alias("n"), F.sum(cents(p)).alias("c"), F.expr(f"round(stddev_pop({p}), 4) AS deviation")
    )
    return grouped.select(
        "o_orderstatus", "o_orderpriority", "n", mean_of_cents("c", "n").alias("mean"), "deviation", (F.col("c") / 100.0).alias("total")
    )


@query(
    "agg_two_stage",
    f"""WITH d AS (SELECT o_orderdate AS d, sum({cents_sql('o_totalprice')})::BIGINT AS s FROM orders GROUP BY 1),
            g AS (SELECT year(d)::INTEGER AS year, dayofweek(d)::INTEGER AS weekday, sum(s)::BIGINT AS total, count(*) AS n FROM d GROUP BY 1, 2)
       SELECT year, weekday, {mean_of_cents_sql('total', 'n')} AS sales FROM g""",
)
def _(t: Tables):
    days = t.orders.groupBy("o_orderdate").agg(F.sum(cents("o_totalprice")).alias("s"))
    grouped = t.spark.sql(
        """SELECT year(o_orderdate) AS year, dayofweek(o_orderdate) - 1 AS weekday, sum(s) AS total, count(*) AS n
           FROM {days} GROUP BY 1, 2""",
        days=days,
    )
    return grouped.select("year", "weekday", mean_of_cents("total", "n").alias("sales"))


@query("agg_by_year", "SELECT year(l_shipdate)::INTEGER AS year, sum(l_quantity) AS sales FROM lineitem GROUP BY 1")
def _(t: Tables):
    return t.spark.sql("SELECT year(l_shipdate) AS year, sum(l_quantity) AS sales FROM {lines} GROUP BY year(l_shipdate)", lines=t.lineitem)


@query(
    "agg_by_month",
    """SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, sum(l_quantity) AS sales FROM lineitem GROUP BY 1""",
)
def _(t: Tables):
    return t.spark.sql(
        """SELECT cast(trunc(l_shipdate, 'MM') AS string) AS month, sum(l_quantity) AS sales
           FROM {lines} GROUP BY trunc(l_shipdate, 'MM')""",
        lines=t.lineitem,
    )


def _subtotals(grouped):
    return grouped.agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.grouping_id().cast("int").alias("gid")).select(
        F.coalesce("o_orderpriority", F.lit("*")).alias("priority"),
        F.coalesce("o_orderstatus", F.lit("*")).alias("status"),
        "gid", "total",
    )


@query(
    "agg_rollup",
    """SELECT coalesce(o_orderpriority, '*') AS priority, coalesce(o_orderstatus, '*') AS status,
              grouping_id(o_orderpriority, o_orderstatus)::INTEGER AS gid, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""",
)
def _(t: Tables):
    return _subtotals(t.orders.rollup("o_orderpriority", "o_orderstatus"))


@query(
    "agg_cube",
    """SELECT coalesce(o_orderpriority, '*') AS priority, coalesce(o_orderstatus, '*') AS status,
              grouping_id(o_orderpriority, o_orderstatus)::INTEGER AS gid, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""",
)
def _(t: Tables):
    return _subtotals(t.orders.cube("o_orderpriority", "o_orderstatus"))


@query(
    "agg_pivot",
    """SELECT p_brand, """
    + ", ".join(f"coalesce(round(avg(CASE WHEN p_type = '{x}' THEN p_size END), 2), 0) AS {x.lower()}" for x in TYPES)
    + f", {_UNLISTED} AS unlisted FROM part GROUP BY p_brand",
)
def _(t: Tables):
    return A.pivot_mean(t.part, "p_brand", "p_type", TYPES, "p_size", 2).withColumnsRenamed({x: x.lower() for x in TYPES})


@query(
    "agg_crosstab",
    "SELECT p_brand, " + ", ".join(f"count(CASE WHEN p_type = '{x}' THEN 1 END) AS {x.lower()}" for x in TYPES)
    + f", {_UNLISTED} AS unlisted FROM part GROUP BY p_brand",
)
def _(t: Tables):
    return A.crosstab(t.part, "p_brand", "p_type", TYPES).withColumnsRenamed({x: x.lower() for x in TYPES})


@query(
    "agg_freq_items",
    "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 0.02 * (SELECT count(*) FROM lineitem)",
)
def _(t: Tables):
    return A.frequent_items(t.lineitem, "l_quantity", 0.02)


@query("agg_freq_items_approx")
def _(t: Tables):
    return A.frequent_items_approx(t.lineitem, ["l_quantity", "l_returnflag"], 0.05)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "agg_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
                   min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in MEASURES
    ),
)
def _(t: Tables):
    return A.describe(t.lineitem, MEASURES).withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query(
    "agg_quantile",
    """SELECT o_orderpriority, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
              round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.75), 6) AS q3,
              max(o_totalprice) AS max FROM orders GROUP BY 1""",
)
def _(t: Tables):
    numbers = A.five_numbers(t.orders, ["o_orderpriority"], "o_totalprice")
    return numbers.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


@query("agg_quantile_approx")
def _(t: Tables):
    probs = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    return A.approx_quantile(t.lineitem, ["l_returnflag"], "l_extendedprice", probs, 1000)


@query(
    "agg_null_profile",
    """WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
       SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS "column",
              unnest([count(*) - count(doc_id), count(*) - count(lang), count(*) - count(quality), count(*) - count(toxic)]) AS nulls
       FROM j""",
)
def _(t: Tables):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return A.null_profile(joined)


@query(
    "agg_mode",
    """WITH c AS (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2),
            r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, l_quantity) AS k FROM c)
       SELECT l_returnflag, l_quantity AS mode, n FROM r WHERE k = 1""",
)
def _(t: Tables):
    return A.mode(t.lineitem, ["l_returnflag"], "l_quantity")


@query(
    "agg_corr_by_group",
    """SELECT l_returnflag, l_linestatus, round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n
       FROM lineitem GROUP BY 1, 2""",
)
def _(t: Tables):
    found = A.corr_by_group(t.lineitem, ["l_returnflag", "l_linestatus"], "l_quantity", "l_extendedprice")
    return found.withColumn("r", F.round("r", 6))


@query(
    "agg_corr_target",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(corr({c}, l_extendedprice), 6) AS r FROM lineitem"""
        for c in ("l_quantity", "l_discount", "l_tax")
    ),
)
def _(t: Tables):
    found = A.corr_with_target(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return found.withColumn("r", F.round("r", 6))


@query(
    "agg_corr_matrix",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d,
                  """
    + ", ".join(f"sum(CASE WHEN c_mktsegment = '{x}' THEN o_totalprice END) AS s{x}" for x in SEGMENTS)
    + """ FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) """
    + " UNION ALL ".join(
        f"SELECT 's{a}' AS a, 's{b}' AS b, " + ("max(1.0::DOUBLE)" if a == b else f"round(corr(s{a}, s{b}), 6)") + " AS r FROM d"
        for a in SEGMENTS
        for b in SEGMENTS
    ),
)
def _(t: Tables):
    daily = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.to_date("o_orderdate").alias("d"), "c_mktsegment")
        .agg(F.sum("o_totalprice").alias("sales"))
    )
    return C.series_corr(daily, "d", "c_mktsegment", "sales", "s").withColumn("r", F.round("r", 6))


_CHI_COLUMNS = ["o_orderstatus", "o_orderpriority", "c_mktsegment"]


def _chi_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(sum(pow(coalesce(o, 0) - e, 2) / e), 4) AS statistic,
        ((SELECT count(DISTINCT {a}) FROM j) - 1) * ((SELECT count(DISTINCT {b}) FROM j) - 1) AS dof
      FROM (SELECT x, y, rx * ry / (SELECT count(*) FROM j)::DOUBLE AS e
            FROM (SELECT {a} AS x, count(*) AS rx FROM j GROUP BY 1), (SELECT {b} AS y, count(*) AS ry FROM j GROUP BY 1))
      LEFT JOIN (SELECT {a} AS x, {b} AS y, count(*) AS o FROM j GROUP BY 1, 2) USING (x, y)"""


@query(
    "agg_chi2",
    "WITH j AS (SELECT o_orderstatus, o_orderpriority, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey) "
    + " UNION ALL ".join(_chi_sql(a, b) for i, a in enumerate(_CHI_COLUMNS) for b in _CHI_COLUMNS[i + 1 :]),
)
def _(t: Tables):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(*_CHI_COLUMNS)
    return A.chi_square(joined, _CHI_COLUMNS).withColumn("statistic", F.round("statistic", 4))


@query("agg_chi2_p")
def _(t: Tables):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(*_CHI_COLUMNS)
    return A.chi_square_p(joined, _CHI_COLUMNS)


@query(
    "agg_histogram",
    """WITH b AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1),
            p AS (SELECT l_returnflag, least(9, floor((l_extendedprice - lo) / ((hi - lo) / 10)))::INTEGER AS bin, lo, hi
                  FROM lineitem JOIN b USING (l_returnflag))
       SELECT l_returnflag, bin, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 10, 6) AS bin_start, count(*) AS n
       FROM p GROUP BY l_returnflag, bin""",
)
def _(t: Tables):
    bins = A.histogram(t.lineitem, ["l_returnflag"], "l_extendedprice", 10)
    return bins.withColumn("bin_start", F.round("bin_start", 6))


@query(
    "agg_kv_reduce",
    """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
       SELECT word[1:1] AS letter, CAST(sum(length(word)) AS BIGINT) AS total FROM w GROUP BY 1""",
)
def _(t: Tables):
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word"))
    return A.reduce_by_key(words.withColumn("letter", F.substring("word", 1, 1)), "letter", F.length("word"))


@query(
    "agg_kv_map_values",
    """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS word FROM part),
            k AS (SELECT lower(word[1:1]) AS key, upper(word) AS value FROM w)
       SELECT key, value, unnest(string_split(value, '')) AS letter FROM k""",
)
def _(t: Tables):
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word"))
    pairs = words.select(F.lower(F.substring("word", 1, 1)).alias("key"), F.upper("word").alias("value"))
    return pairs.withColumn("letter", F.explode(F.split("value", "")))


@query(
    "agg_custom_reduce",
    """WITH w AS (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents)
       SELECT arg_max(word, (length(word), word)) AS word FROM w""",
)
def _(t: Tables):
    return A.longest(X.words(t.documents, "text"), "word")
