"""Projections, filters, joins, sorting, set operations and sampling on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import relational as R
from millrace.operators import sampling as S
from millrace.functions.numbers import cents, cents_sql, mean_of_cents, mean_of_cents_sql
from millrace.plans.registry import Tables, query
from millrace.session import materialise


# --- projections -------------------------------------------------------------------------------


@query(
    "proj_select_expr",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
              p_size > 25 AS is_large, round(p_retailprice * 1.21, 4) AS price_with_tax
       FROM part""",
)
def _(t: Tables):
    return t.part.selectExpr("*", "p_size > 25 AS is_large", "round(p_retailprice * 1.21, 4) AS price_with_tax")


@query("proj_literal", "SELECT o_orderkey, 12 AS months, 'pending' AS mark, 0.25::DOUBLE AS share FROM orders")
def _(t: Tables):
    return t.orders.select(
        "o_orderkey", F.lit(12).alias("months"), F.lit("pending").alias("mark"), F.lit(0.25).alias("share")
    )


@query(
    "proj_add_rename_drop",
    """SELECT c_custkey AS customer_id, c_nationkey, c_acctbal, c_mktsegment AS segment,
              c_acctbal < 0 AS in_debt, length(c_name)::INTEGER AS name_length FROM customer""",
)
def _(t: Tables):
    return R.add_rename_drop(
        t.customer,
        add={"in_debt": F.col("c_acctbal") < 0, "name_length": F.length("c_name")},
        rename={"c_custkey": "customer_id", "c_mktsegment": "segment"},
        drop=["c_name"],
    )


@query("proj_schema_select", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _(t: Tables):
    return R.select_type(t.part, "numeric")


@query(
    "proj_first_letter_flag",
    """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
       SELECT word, word[1:1] AS first_letter, starts_with(word, 's') AS starts_with FROM w
       WHERE starts_with(word, 's')""",
)
def _(t: Tables):
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word"))
    return R.first_letter_flag(words, "word", "s").where("starts_with")


# --- filters -----------------------------------------------------------------------------------


@query(
    "filter_compare",
    """SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem
       WHERE l_quantity < 10 AND l_discount >= 0.05 AND l_returnflag <> 'N'
         AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'""",
)
def _(t: Tables):
    return (
        t.lineitem.where("l_quantity < 10")
        .where(F.col("l_discount") >= 0.05)
        .where(F.col("l_returnflag") != "N")
        .where("l_shipdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00'")
        .select("l_orderkey", "l_quantity", "l_returnflag")
    )


@query(
    "filter_compound",
    """SELECT p_partkey, p_name, p_brand, p_size FROM part
       WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#12')
         AND (p_size > 40 OR instr(p_name, 'ring') >= 1) AND NOT (p_retailprice <= 950)""",
)
def _(t: Tables):
    bright = (F.col("p_size") > 40) | (F.instr("p_name", "ring") >= 1)
    return (
        t.part.where(F.col("p_brand").isin("Brand#1", "Brand#7", "Brand#12"))
        .where(bright & ~(F.col("p_retailprice") <= 950))
        .select("p_partkey", "p_name", "p_brand", "p_size")
    )


@query(
    "filter_null",
    """SELECT d.doc_id, l.quality IS NULL AS unlabelled FROM documents d
       LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL AND d.text IS NOT NULL""",
)
def _(t: Tables):
    joined = t.documents.join(t.labels, "doc_id", "left")
    return joined.where(F.col("quality").isNull() & F.col("text").isNotNull()).select(
        "doc_id", F.col("quality").isNull().alias("unlabelled")
    )


@query(
    "filter_regex",
    """SELECT p_partkey, p_brand, CASE WHEN regexp_matches(p_name, '^(red|blue) ') THEN NULL ELSE p_name END AS name
       FROM part WHERE regexp_matches(p_brand, '#1[0-9]$')""",
)
def _(t: Tables):
    kept = t.part.where(F.col("p_brand").rlike("#1[0-9]$"))
    name = F.when(~F.col("p_name").rlike("^(red|blue) "), F.col("p_name"))
    return kept.select("p_partkey", "p_brand", name.alias("name"))


@query(
    "case_when",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'partial' END AS state,
              CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS flag,
              CASE WHEN o_totalprice > 400000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END AS band
       FROM orders""",
)
def _(t: Tables):
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "done").when(status == "O", "open").otherwise("partial").alias("state"),
        R.encode_flag(status, "F").alias("flag"),
        F.when(price > 400000, "high").when(price > 100000, "middle").otherwise("low").alias("band"),
    )


@query(
    "clamp_upper",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN 40.0 ELSE l_quantity END AS l_quantity,
              CASE WHEN l_extendedprice > 50000 THEN 50000.0 ELSE l_extendedprice END AS l_extendedprice FROM lineitem""",
)
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return R.clamp_upper(rows, {"l_quantity": 40.0, "l_extendedprice": 50000.0})


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t: Tables):
    return t.part.select("p_brand", "p_type").distinct()


@query("row_id")
def _(t: Tables):
    return R.with_row_id(t.orders.select("o_orderkey"))


@query("layout_repartition", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t: Tables):
    # By row number, then by a key, then merged: the content must not change.
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return rows.repartition(16).repartition(8, "o_orderkey").coalesce(4)


# --- joins -------------------------------------------------------------------------------------


@query(
    "join_inner",
    """SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
       JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def _(t: Tables):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )


@query(
    "join_left",
    """SELECT c_custkey, coalesce(o_orderkey, -1) AS order_id, o_orderkey IS NOT NULL AS has_order
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)
def _(t: Tables):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey",
        F.coalesce("o_orderkey", F.lit(-1)).alias("order_id"),
        F.col("o_orderkey").isNotNull().alias("has_order"),
    )


@query(
    "join_array_contains",
    """WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part),
            w AS (SELECT word, count(*) AS uses FROM (SELECT unnest(words) AS word FROM p) GROUP BY word)
       SELECT p.p_partkey, w.word, w.uses FROM p JOIN w ON list_contains(p.words, w.word)""",
)
def _(t: Tables):
    parts = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    words = parts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("uses"))
    # Stored first, so that a hot word can be split in the join (see ordered.attach).
    stored = materialise(words, "word-uses")
    return R.join_array_contains(parts, "words", stored, "word").select("p_partkey", "word", "uses")


@query(
    "join_kv_partitions",
    """SELECT l_partkey AS k, l_quantity AS quantity, p_retailprice AS price
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _(t: Tables):
    left = t.lineitem.select(F.col("l_partkey").alias("k"), F.col("l_quantity").alias("quantity"))
    right = t.part.select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("price"))
    return R.join_partitioned(left, right, "k", 8)


@query(
    "join_stats_back",
    f"""WITH p AS (SELECT *, {cents_sql('o_totalprice')} AS cents FROM orders),
            s AS (SELECT o_custkey, sum(cents)::BIGINT AS total, count(*) AS n FROM p GROUP BY o_custkey)
       SELECT o_orderkey, {mean_of_cents_sql('total', 'n')} AS customer_mean, n AS customer_orders, cents * n > total AS above
       FROM p JOIN s USING (o_custkey)""",
)
def _(t: Tables):
    # In whole cents, so that a price equal to its customer's mean compares as equal.
    rows = t.orders.select("o_orderkey", "o_custkey", cents("o_totalprice").alias("cents"))
    joined = R.stats_back(rows, ["o_custkey"], {"total": F.sum("cents"), "n": F.count("*")})
    return joined.select(
        "o_orderkey",
        mean_of_cents("total", "n").alias("customer_mean"),
        F.col("n").alias("customer_orders"),
        (F.col("cents") * F.col("n") > F.col("total")).alias("above"),
    )


@query(
    "join_spine_fill",
    """WITH c AS (SELECT p_size * 2 AS size, count(*) AS n FROM part GROUP BY 1),
            b AS (SELECT min(size) AS lo, max(size) AS hi FROM c),
            spine AS (SELECT unnest(generate_series(lo, hi)) AS size FROM b)
       SELECT CAST(spine.size AS INTEGER) AS size, coalesce(n, 0) AS n FROM spine LEFT JOIN c ON spine.size = c.size""",
)
def _(t: Tables):
    counts = t.part.groupBy((F.col("p_size") * 2).alias("size")).agg(F.count("*").alias("n"))
    return R.densify(counts, "size", ["n"])


@query(
    "join_multi_key",
    """WITH s AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
       SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, s.q AS pair_quantity
       FROM lineitem l LEFT JOIN s USING (l_partkey, l_suppkey)""",
)
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sums = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("pair_quantity"))
    # Stored first, so that a hot pair can be split in the join (see ordered.attach).
    return rows.join(materialise(sums, "pair-sums"), ["l_partkey", "l_suppkey"], "left")


@query(
    "join_spaced_names",
    "SELECT l_orderkey, l_linenumber, p_brand AS part_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey",
)
def _(t: Tables):
    named = t.part.withColumnsRenamed({"p_partkey": "Part key", "p_brand": "Part brand"})
    return t.lineitem.join(named, F.col("l_partkey") == F.col("`Part key`"), "left").select(
        "l_orderkey", "l_linenumber", F.col("`Part brand`").alias("part_brand")
    )


@query(
    "join_pred_truth",
    """SELECT d.doc_id, CASE WHEN d.n_chars >= 400 THEN 'good' ELSE 'poor' END AS predicted_label,
              CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS true_label
       FROM documents d JOIN labels l USING (doc_id)""",
)
def _(t: Tables):
    names = {0: "poor", 1: "good"}
    guess = t.documents.select("doc_id", (F.col("n_chars") >= 400).cast("int").alias("guess"))
    joined = guess.join(t.labels.select("doc_id", "quality"), "doc_id")
    joined = R.label_names(joined, "guess", names, "predicted_label")
    return R.label_names(joined, "quality", names, "true_label").select("doc_id", "predicted_label", "true_label")


# --- sorts and limits --------------------------------------------------------------------------


@query(
    "sort_multi",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey",
)
def _(t: Tables):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal").orderBy(
        F.col("c_mktsegment").asc(), F.col("c_acctbal").desc(), "c_custkey"
    )


@query(
    "topk_global",
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
       GROUP BY word ORDER BY n DESC, word LIMIT 10""",
)
def _(t: Tables):
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word"))
    return R.top_k(words.groupBy("word").agg(F.count("*").alias("n")), 10, ["-n", "word"])


@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(t: Tables):
    return R.top_k(t.orders.select("o_orderkey", "o_totalprice"), 25, ["-o_totalprice", "o_orderkey"])


@query(
    "topk_per_group",
    """WITH m AS (SELECT p_brand, p_partkey, avg(l_quantity) AS mean, count(*) AS n FROM lineitem
                  JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 HAVING count(*) > 20),
            r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY round(mean, 6) DESC, p_partkey) AS rank FROM m)
       SELECT p_brand, p_partkey, round(mean, 6) AS mean, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""",
)
def _(t: Tables):
    # Aggregate by part key first, so only one row per part meets the part table.
    by_part = (
        t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.round(F.avg("l_quantity"), 6).alias("mean"), F.count("*").alias("n"))
        .where(F.col("n") > 20)
    )
    named = by_part.join(t.part.select("p_partkey", "p_brand"), "p_partkey")
    return R.top_k_per_group(named, ["p_brand"], 3, ["-mean", "p_partkey"])


# --- set operations ----------------------------------------------------------------------------


@query(
    "set_union_positional",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def _(t: Tables):
    buyers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return buyers.union(t.supplier.select("s_suppkey", "s_name"))


@query(
    "set_union_by_name",
    """SELECT 'customer' AS kind, c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier
       UNION ALL SELECT 'part', p_name, p_retailprice FROM part""",
)
def _(t: Tables):
    frames = [
        t.customer.select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind")),
        t.part.select(F.col("p_name").alias("name"), F.lit("part").alias("kind"), F.col("p_retailprice").alias("balance")),
    ]
    return R.union_all_by_name(frames)


@query(
    "set_distinct_chars",
    "SELECT DISTINCT unnest(string_split(lower(p_name), '')) AS letter FROM part",
)
def _(t: Tables):
    return t.part.select(F.explode(F.split(F.lower("p_name"), "")).alias("letter")).distinct()


# --- sampling ----------------------------------------------------------------------------------


@query("sample_fraction")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").sample(False, 0.1, 5)


@query("sample_n")
def _(t: Tables):
    return S.sample_n(t.orders.select("o_orderkey", "o_totalprice"), 500, seed=7, replace=True, key=["o_orderkey"])


@query("sample_n_distinct")
def _(t: Tables):
    return S.sample_n(t.orders.select("o_orderkey", "o_totalprice"), 500, seed=7, key=["o_orderkey"])


@query("sample_by_key")
def _(t: Tables):
    wanted = {"A": 0.2, "N": 0.5, "R": 1.5}
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    return S.sample_by_key(rows, "l_returnflag", wanted, seed=3, replace=True)


@query("split_random")
def _(t: Tables):
    return S.mark_random(t.orders.select("o_orderkey"), {"train": 0.7, "test": 0.3}, 42, ["o_orderkey"])


@query(
    "split_hash",
    """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 70
                               THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def _(t: Tables):
    return S.mark_split(t.orders.select("o_orderkey"), "o_orderkey", 70)
