"""Round trips through the file formats. Files go to the shared scratch folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace.operators import models as ML
from millrace.plans.registry import Tables, query
from millrace.session import scratch
from millrace.sources import files as IO

_DAY = "strftime(o_orderdate, '%Y-%m-%d') AS day"
_ORDERS = f"SELECT o_orderkey, o_orderstatus, o_totalprice, {_DAY} FROM orders"


def _orders_csv(t: Tables) -> str:
    path = scratch(t.spark, "orders-csv")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    IO.write_csv(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", day), path)
    return path


@query("src_csv_inferred", _ORDERS)
def _(t: Tables):
    rows = IO.read_csv(t.spark, _orders_csv(t) + "/*.csv")
    return rows.select(
        F.col("o_orderkey").cast("long"), "o_orderstatus", F.col("o_totalprice").cast("double"), F.col("day").cast("string")
    )


@query("src_csv_schema", _ORDERS)
def _(t: Tables):
    schema = "o_orderkey long, o_orderstatus string, o_totalprice double, day date"
    return IO.read_csv(t.spark, _orders_csv(t), schema).withColumn("day", F.col("day").cast("string"))


@query("src_csv_multiline", "SELECT doc_id, text, lang FROM documents")
def _(t: Tables):
    path = scratch(t.spark, "documents-csv")
    writer = t.documents.select("doc_id", "text", "lang").write.partitionBy("lang")
    writer.options(header=True, quote='"', escape='"', compression="gzip", quoteAll=True).csv(path)
    # The folder of a file tells its source, a null one included, so no list of sources is needed.
    return IO.read_csv_quoted(t.spark, path, "doc_id long, text string, lang string")


@query("src_csv_malformed", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'signup')")
def _(t: Tables):
    # Errors lose their last field and sign-ups get a word for a number: both must be dropped.
    path = scratch(t.spark, "events-bad")
    fields = ["event_id", "user_id", "event_type", "value"]
    last = F.when(F.col("event_type") == "signup", F.lit("many")).otherwise(F.col("value").cast("string"))
    line = F.concat_ws(",", F.concat(F.lit("  "), F.col("event_id").cast("string")), "user_id", "event_type")
    whole = F.when(F.col("event_type") == "error", line).otherwise(F.concat_ws(",", line, last))
    t.events.select(whole.alias("value")).write.option("lineSep", "\n").text(path)
    return IO.read_csv_strict(t.spark, path, t.events.select(*fields).schema, header=False)


@query(
    "src_text_lines",
    """SELECT word AS value, count(*) AS n
       FROM (SELECT unnest(string_split(line, ' ')) AS word FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\n|\\r')) AS line FROM documents))
       GROUP BY 1""",
)
def _(t: Tables):
    path = scratch(t.spark, "documents-text")
    t.documents.select("text").write.text(path)
    return IO.read_lines(t.spark, path, " ").groupBy("value").agg(F.count("*").alias("n"))


@query(
    "src_delimited_parse",
    """SELECT value AS runs, CAST(user_id AS VARCHAR) AS player FROM events WHERE event_type NOT IN ('error', 'view') AND value >= 50""",
)
def _(t: Tables):
    # Score lines: a marker on some scores, words instead of a score on others, a header per file.
    path = scratch(t.spark, "scores")
    score = (
        F.when(F.col("event_type") == "error", "DNB")
        .when(F.col("event_type") == "view", "absent")
        .when(F.col("event_type") == "signup", F.concat(F.col("value").cast("string"), F.lit("*")))
        .otherwise(F.col("value").cast("string"))
    )
    t.events.select(score.alias("Runs"), F.col("user_id").alias("Player"), "event_type").write.option("header", True).csv(path)
    lines = IO.read_lines(t.spark, path)
    parsed = IO.parse_delimited(
        lines, "Runs,Player,event_type", {0: "runs", 1: "player"}, "runs", ["DNB", "TDNB", "absent"]
    )
    return parsed.where("runs >= 50")


@query("src_parquet", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R'")
def _(t: Tables):
    path = f"{t.sf_dir}/lineitem.parquet"
    return IO.read_parquet(t.spark, path, ["l_orderkey", "l_quantity"], "l_quantity > 30 AND l_returnflag = 'R'")


@query(
    "src_literal_rows",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                                         WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END AS code,
              CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'cars' WHEN 'BUILDING' THEN 'sites' WHEN 'FURNITURE' THEN 'rooms'
                                WHEN 'HOUSEHOLD' THEN 'homes' WHEN 'MACHINERY' THEN 'plants' END AS title
       FROM customer""",
)
def _(t: Tables):
    rows = [(1, "AUTOMOBILE", "cars"), (2, "BUILDING", "sites"), (3, "FURNITURE", "rooms"), (4, "HOUSEHOLD", "homes"), (5, "MACHINERY", "plants")]
    titles = IO.literal_rows(t.spark, rows, "code int, c_mktsegment string, title string")
    # A left join: customers of a segment without a title stay.
    return t.customer.join(F.broadcast(titles), "c_mktsegment", "left").select("c_custkey", "code", "title")


@query("sink_parquet", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def _(t: Tables):
    return IO.write_parquet(t.part.select("p_partkey", "p_brand", "p_retailprice"), scratch(t.spark, "part"))


@query("sink_csv_header", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t: Tables):
    path = scratch(t.spark, "customer-csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    # As many files as the rows need, written where they are.
    IO.write_csv(rows, path, maxRecordsPerFile=1_000_000)
    return IO.read_csv(t.spark, path, rows.schema)


@query(
    "sink_partitioned_insert",
    "SELECT o_orderkey AS id, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderstatus = 'F'",
)
def _(t: Tables):
    rows = t.orders.withColumn("day", F.to_date("o_orderdate"))
    renames = {"o_orderkey": "id", "o_totalprice": "price", "day": "day", "o_orderstatus": "status"}
    path = scratch(t.spark, "stored")
    name = f"stored_{path.rsplit('-', 1)[1]}"
    # In two inserts, as a table filled day by day.
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 <> 0"):
        IO.insert_partitioned(rows.where(part), name, path, renames, "status")
    stored = t.spark.read.parquet(path).where("status = 'F'")
    t.spark.sql(f"DROP TABLE {name}")
    return stored.select("id", "price", F.col("day").cast("string").alias("day"))


@query(
    "view_sql",
    "SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def _(t: Tables):
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return IO.query_view(
        joined, "customers", "SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM {customers} GROUP BY n_name"
    )


@query("model_save_load")
def _(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_extendedprice")
    model = ML.linear_pipeline(["l_quantity", "l_discount"], "l_extendedprice").fit(rows)
    path = scratch(t.spark, "model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path).transform(rows).select("l_orderkey", "l_extendedprice", "prediction")
