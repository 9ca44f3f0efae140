"""Scalar function families and column-expression helpers on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dates as D
from millrace.functions import nested as N
from millrace.functions import nulls as U
from millrace.functions import numbers as M
from millrace.functions import strings as S
from millrace.plans.registry import Tables, query
from millrace.session import materialise

_INITCAP = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"


# --- strings -----------------------------------------------------------------------------------


@query(
    "str_case",
    f"""SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, lower(upper(p_name)) AS both,
               {_INITCAP.format('p_name')} AS title FROM part""",
)
def _(t: Tables):
    return t.part.select(
        "p_partkey", F.lower("p_type").alias("low"), F.upper("p_name").alias("up"),
        F.lower(F.upper("p_name")).alias("both"), S.title_case("p_name").alias("title"),
    )


@query(
    "str_pad_trim",
    """SELECT p_partkey, ltrim('  ' || p_name || '  ') AS l, rtrim('  ' || p_name || '  ') AS r, trim('  ' || p_name || '  ') AS b,
              lpad(p_type, 4, '*') AS lp, rpad(p_type, 10, ' ') AS rp FROM part""",
)
def _(t: Tables):
    padded = F.concat(F.lit("  "), "p_name", F.lit("  "))
    return t.part.select(
        "p_partkey", F.ltrim(padded).alias("l"), F.rtrim(padded).alias("r"), F.trim(padded).alias("b"),
        F.lpad("p_type", 4, "*").alias("lp"), F.rpad("p_type", 10, " ").alias("rp"),
    )


@query(
    "str_regex",
    """SELECT c_custkey, regexp_replace(c_mktsegment, 'MACHINERY|FURNITURE', 'GOODS', 'g') AS segment,
              regexp_extract(c_name, '#(\\d+)$', 1) AS number,
              CASE WHEN regexp_extract(c_name, '\\((\\d{4})\\)', 1) <> '' THEN regexp_extract(c_name, '\\((\\d{4})\\)', 1)
                   ELSE regexp_extract(c_name, '0(\\d{4})$', 1) END AS year FROM customer""",
)
def _(t: Tables):
    return t.customer.select(
        "c_custkey",
        F.regexp_replace("c_mktsegment", "MACHINERY|FURNITURE", "GOODS").alias("segment"),
        F.regexp_extract("c_name", r"#(\d+)$", 1).alias("number"),
        S.first_match("c_name", [S.YEAR_PATTERNS[0], r"0(\d{4})$"]).alias("year"),
    )


_SEARCHED = ["red", "blue", "ring", "gear"]


@query(
    "str_search",
    "SELECT p_partkey, instr(p_name, 'ring')::INTEGER AS place, "
    + ", ".join(f"instr(upper(p_name), '{w.upper()}') > 0 AS is_{w}" for w in _SEARCHED)
    + " FROM part WHERE instr(p_name, 'r') >= 1",
)
def _(t: Tables):
    return t.part.where(F.instr("p_name", "r") >= 1).select(
        "p_partkey", F.instr("p_name", "ring").alias("place"), *S.words_found("p_name", _SEARCHED)
    )


@query("str_translate", "SELECT p_partkey, translate(upper(p_name), 'LEET', '1337') AS code FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", F.translate(F.upper("p_name"), "LEET", "1337").alias("code"))


@query(
    "str_format",
    """SELECT o_orderkey, (year(o_orderdate) // 10)::VARCHAR || '0s' AS decade, o_orderstatus || '-' || o_orderpriority AS joined,
              length(o_orderpriority)::INTEGER AS n, o_orderpriority[1:1] AS first FROM orders""",
)
def _(t: Tables):
    return t.orders.select(
        "o_orderkey",
        S.decade(F.year("o_orderdate")).alias("decade"),
        F.concat_ws("-", "o_orderstatus", "o_orderpriority").alias("joined"),
        F.length("o_orderpriority").alias("n"),
        F.substring("o_orderpriority", 1, 1).alias("first"),
    )


@query(
    "str_clean_punct",
    """SELECT doc_id, regexp_replace(lower(text), '[!"#$%&''()*+,\\-./:;<=>?@\\[\\\\\\]^_`{|}~]', '', 'g') AS clean FROM documents""",
)
def _(t: Tables):
    return t.documents.select("doc_id", S.clean_punctuation("text").alias("clean"))


@query(
    "str_split",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS first, coalesce(string_split(p_name, ' ')[3], '-') AS third,
              len(string_split(p_name, ' '))::INTEGER AS n, list_contains(string_split(p_name, ' '), 'red') AS is_red FROM part""",
)
def _(t: Tables):
    parts = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", N.element(parts, 0).alias("first"), F.coalesce(N.element(parts, 2), F.lit("-")).alias("third"),
        F.size(parts).alias("n"), F.array_contains(parts, "red").alias("is_red"),
    )


# --- numbers -----------------------------------------------------------------------------------


@query(
    "math_arith",
    """SELECT l_orderkey, l_linenumber, l_partkey, pow(l_quantity - 25, 2) * l_tax - 3 AS bent, round(ln(l_extendedprice), 8) AS log_price,
              abs(l_discount - l_tax) AS gap, l_orderkey % 7 AS rest, (l_orderkey // 10)::INTEGER AS tens,
              round(l_quantity / nullif(l_tax, 0), 6) IS NULL AS untaxed FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.pow(F.col("l_quantity") - 25, 2) * F.col("l_tax") - 3).alias("bent"),
        F.round(F.log("l_extendedprice"), 8).alias("log_price"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
        (F.col("l_orderkey") % 7).alias("rest"),
        (F.col("l_orderkey") / 10).cast("int").alias("tens"),
        M.ratio("l_quantity", "l_tax").isNull().alias("untaxed"),
    )


@query(
    "math_round",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / 2) AS half_up, round_even(l_quantity / 2, 0) AS half_even,
              round(l_extendedprice, -2) AS hundreds FROM lineitem""",
)
def _(t: Tables):
    half = F.col("l_quantity") / 2
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(half).alias("half_up"), F.bround(half).alias("half_even"),
        F.round("l_extendedprice", -2).alias("hundreds"),
    )


# --- dates -------------------------------------------------------------------------------------


@query("date_now")
def _(t: Tables):
    return D.with_load_stamp(t.orders.select("o_orderkey"))


@query(
    "date_arith",
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, DATE '1998-03-31' AS e FROM orders)
       SELECT o_orderkey, strftime(d + 5, '%Y-%m-%d') AS later, strftime(d - 5, '%Y-%m-%d') AS earlier,
              date_diff('day', d, e)::INTEGER AS days,
              round((year(d) - year(e)) * 12 + month(d) - month(e)
                    + CASE WHEN day(d) = day(e) OR (d = last_day(d) AND e = last_day(e)) THEN 0 ELSE (day(d) - day(e)) / 31.0::DOUBLE END, 8) AS months
       FROM d""",
)
def _(t: Tables):
    day, end = F.to_date("o_orderdate"), F.lit("1998-03-31").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.date_add(day, 5).cast("string").alias("later"),
        F.date_sub(day, 5).cast("string").alias("earlier"),
        F.datediff(end, day).alias("days"),
        F.months_between(day, end).alias("months"),
    )


@query(
    "date_parse_format",
    """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS day_first, strftime(o_orderdate, '%Y%m') AS month,
              strftime(o_orderdate, '%Y-%m-%d') AS plain, strftime(o_orderdate, '%Y-%m-%d') AS swapped,
              strftime(o_orderdate, '%Y-%m-%d 08:26:00') AS stamp, 1 AS bad FROM orders""",
)
def _(t: Tables):
    date = F.col("o_orderdate")
    swapped = D.parse_day(F.date_format(date, "yyyy-dd-MM"), "yyyy-dd-MM")
    written = F.concat(F.date_format(date, "M/d/yyyy"), F.lit(" 8:26"))
    stamp = F.to_timestamp(written, "M/d/yyyy H:mm")
    return t.orders.select(
        "o_orderkey",
        F.date_format(date, "dd/MM/yyyy").alias("day_first"),
        F.date_format(date, "yyyyMM").alias("month"),
        F.to_date(F.date_format(date, "yyyy-MM-dd")).cast("string").alias("plain"),
        swapped.cast("string").alias("swapped"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        D.parse_day(F.lit("2016-20-12"), "yyyy-MM-dd").isNull().cast("int").alias("bad"),
    )


@query(
    "date_parts",
    """SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, dayofweek(o_orderdate)::INTEGER AS weekday,
              strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, (year(o_orderdate) // 10 * 10)::INTEGER AS decade,
              strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def _(t: Tables):
    date = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(date).alias("year"), D.weekday(date).alias("weekday"),
        D.month_start(date).cast("string").alias("month"),
        (F.floor(F.year(date) / 10) * 10).cast("int").alias("decade"),
        date.cast("date").cast("string").alias("day"),
    )


# --- nulls -------------------------------------------------------------------------------------


def _labelled(t: Tables):
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")


_LABELLED = "(SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


@query("null_coalesce", f"SELECT doc_id, coalesce(quality, toxic, -1)::INTEGER AS label FROM {_LABELLED}")
def _(t: Tables):
    label = F.coalesce("quality", "toxic", F.lit(-1)).cast("int")
    return _labelled(t).select("doc_id", label.alias("label"))


@query(
    "null_drop_fill",
    f"""SELECT 'drop_any' AS kind, doc_id, quality::INTEGER AS quality, toxic::INTEGER AS toxic FROM {_LABELLED} WHERE quality IS NOT NULL AND toxic IS NOT NULL
        UNION ALL SELECT 'drop_all', doc_id, quality::INTEGER, toxic::INTEGER FROM {_LABELLED} WHERE quality IS NOT NULL OR toxic IS NOT NULL
        UNION ALL SELECT 'fill', doc_id, coalesce(quality, 5)::INTEGER, coalesce(toxic, 7)::INTEGER FROM {_LABELLED}""",
)
def _(t: Tables):
    rows = _labelled(t).select("doc_id", F.col("quality").cast("int"), F.col("toxic").cast("int"))
    marks = ["quality", "toxic"]
    stored = materialise(rows, "labelled")
    frames = {
        "drop_any": U.drop_null(stored, "any", marks),
        "drop_all": U.drop_null(stored, "all", marks),
        "fill": U.fill(stored, {"quality": 5, "toxic": 7}),
    }
    tagged = [f.withColumn("kind", F.lit(k)) for k, f in frames.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(
    "null_replace",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'OFFER' WHEN 'SMALL' THEN 'LITTLE' ELSE p_type END AS p_type,
              p_brand IN ('Brand#1', 'Brand#2') AS no_brand FROM part""",
)
def _(t: Tables):
    rows = t.part.select("p_partkey", "p_type", "p_brand")
    replaced = U.replace_values(rows, "p_type", ["PROMO", "SMALL"], ["OFFER", "LITTLE"])
    blank = U.tokens_to_null(replaced, ["Brand#1", "Brand#2"])
    return blank.select("p_partkey", "p_type", F.col("p_brand").isNull().alias("no_brand"))


# --- nested values -----------------------------------------------------------------------------


@query("cx_struct", "SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def _(t: Tables):
    packed = t.orders.select("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("kind"))
    return packed.select(
        "o_orderkey", F.col("kind.o_orderstatus").alias("status"), F.col("kind").getField("o_orderpriority").alias("priority")
    )


@query(
    "cx_array",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS first, len(string_split(p_name, ' '))::INTEGER AS n,
              list_contains(string_split(p_name, ' '), 'bolt') AS is_bolt FROM part""",
)
def _(t: Tables):
    split = t.part.select("p_partkey", F.split("p_name", " ").alias("w"))
    return split.select(
        "p_partkey", F.col("w")[0].alias("first"), F.size("w").alias("n"), F.array_contains("w", "bolt").alias("is_bolt")
    )


@query("cx_explode", "SELECT p_partkey, p_brand, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(t: Tables):
    return t.part.select("p_partkey", "p_brand", F.explode(F.split("p_name", " ")).alias("word"))


@query(
    "cx_map",
    "SELECT p_partkey, p_size AS found, p_name <> 'red ring' AS missing FROM part WHERE p_name IS NOT NULL",
)
def _(t: Tables):
    mapped = t.part.where("p_name IS NOT NULL").select("p_partkey", "p_name", F.create_map("p_name", "p_size").alias("m"))
    return mapped.select(
        "p_partkey",
        F.try_element_at("m", F.col("p_name")).alias("found"),
        F.try_element_at("m", F.lit("red ring")).isNull().alias("missing"),
    )


@query(
    "cx_vector_array",
    """SELECT vec_id, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS x1, embedding[3]::DOUBLE AS x2, len(embedding)::INTEGER AS n
       FROM embeddings""",
)
def _(t: Tables):
    vectors = t.embeddings.select("vec_id", N.as_vector("embedding").alias("v"), F.size("embedding").alias("n"))
    return vectors.select("vec_id", *N.vector_elements("v", 3), "n")


# --- user functions ----------------------------------------------------------------------------


def _cube(value):
    """A plain Python function of a column: it builds an expression and never runs per row."""
    return value * value * value


@query("udf_native_expr", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * l_quantity * l_quantity AS cubed FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", _cube(F.col("l_quantity")).alias("cubed"))


#: Invented units of local money per unit of account; any other region counts as 1.
RATES = {"AFRICA": 12.5, "AMERICA": 1.25, "ASIA": 8.0, "EUROPE": 0.75}
RATES_SQL = "CASE r_name " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in RATES.items()) + " ELSE 1 END"


@query(
    "udf_scalar",
    f"""SELECT c_custkey, round(c_acctbal / {RATES_SQL}, 6) AS dollars,
              round(abs(c_acctbal - n_nationkey * 100.0::DOUBLE) + abs(c_custkey - 500.0::DOUBLE), 6) AS distance
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    dollars = F.col("c_acctbal") / N.look_up("r_name", RATES, 1.0)
    centre = F.col("n_nationkey") * 100.0
    return rows.select(
        "c_custkey",
        F.round(dollars, 6).alias("dollars"),
        F.round(M.manhattan("c_acctbal", "c_custkey", centre, F.lit(500.0)), 6).alias("distance"),
    )


_NAMES = ["red", "blue", "hot", "cold", "small", "large"]


@query(
    "udf_array",
    "SELECT p_partkey, "
    + " || ".join(f"CASE WHEN list_contains(string_split(p_name, ' '), '{w}') THEN '1' ELSE '0' END" for w in _NAMES)
    + " AS hot, list_extract(['"
    + "', '".join(_NAMES)
    + "'], (p_size % 6 + 1)::INTEGER) || ' ' || list_extract(['"
    + "', '".join(_NAMES)
    + "'], (p_partkey % 6 + 1)::INTEGER) AS words FROM part",
)
def _(t: Tables):
    hot = N.multi_hot_array(F.split("p_name", " "), _NAMES)
    places = F.array((F.col("p_size") % 6).cast("int"), (F.col("p_partkey") % 6).cast("int"))
    return t.part.select(
        "p_partkey",
        F.concat_ws("", hot.cast("array<string>")).alias("hot"),
        F.concat_ws(" ", N.index_words(places, _NAMES)).alias("words"),
    )


@query(
    "udf_array_max",
    """SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS place FROM embeddings""",
)
def _(t: Tables):
    return t.embeddings.select("vec_id", N.index_of_max("embedding").alias("place"))
