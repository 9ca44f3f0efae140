"""Small literal frames with known results, and dirty input."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import dates as D
from millrace.functions import nested as N
from millrace.functions import nulls as U
from millrace.functions import numbers as M
from millrace.functions import strings as S
from millrace.operators import aggregates as A
from millrace.operators import correlation as C
from millrace.operators import features as E
from millrace.operators import relational as R
from millrace.operators import sampling as SA
from millrace.operators import text as X
from millrace.sources import files as IO
from millrace.streaming.files import parse_labelled


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.fixture(scope="module")
def boats(spark):
    rows = [(11, "Heron", "T1", [3, 7]), (12, "Tern", "T2", []), (13, "Gull", "T9", [7, 7, 8]), (14, "Skua", None, None), (15, "Loon", "T1", [99])]
    return spark.createDataFrame(rows, "boat int, name string, dock string, crew array<int>")


@pytest.fixture(scope="module")
def docks(spark):
    return spark.createDataFrame([("T1", 40.5, True), ("T2", 12.0, False), ("T3", 8.25, True)], "dock string, depth double, lit boolean")


@pytest.fixture(scope="module")
def sailors(spark):
    return spark.createDataFrame([(3, "mate"), (7, "cook"), (8, "pilot"), (20, "cook")], "sailor int, task string")


def test_joins(spark, boats, docks, sailors):
    inner = boats.join(docks, "dock")
    assert {r["name"]: r["depth"] for r in inner.collect()} == {"Heron": 40.5, "Tern": 12.0, "Loon": 40.5}
    held = R.join_array_contains(boats, "crew", sailors, "sailor")
    assert sorted((r["boat"], r["sailor"]) for r in held.collect()) == [(11, 3), (11, 7), (13, 7), (13, 8)]
    more = docks.union(spark.createDataFrame([("T4", None, None)], docks.schema))
    assert more.count() == 4 and more.columns == docks.columns


def test_partitioned_join_with_hot_key(spark):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    salted = sorted(map(tuple, R.join_partitioned(left, right, "k", 8).collect()))
    assert salted == sorted(map(tuple, left.join(right, "k").collect()))


def test_titles_and_decades(spark):
    titles = ["Harbour (1995)", "Series (1995-", "Other (1995–2000", "No Year"]
    frame = spark.createDataFrame([(t,) for t in titles], "title string")
    assert [r[0] for r in frame.select(S.title_year("title")).collect()] == ["1995", "1995", "1995", ""]
    assert one(spark, d=S.decade(F.lit(1995)))["d"] == "1990s"


def test_padding_and_rounding(spark):
    text = F.lit("  HELLO  ")
    row = one(
        spark, l=F.ltrim(text), r=F.rtrim(text), b=F.trim(text), p=F.lpad(F.lit("HELLO"), 3, " "), q=F.rpad(F.lit("HELLO"), 10, " "),
        up=F.round(F.lit(2.5)), even=F.bround(F.lit(2.5)),
    )
    assert tuple(row) == ("HELLO  ", "  HELLO", "HELLO", "HEL", "HELLO     ", 3.0, 2.0)


def test_dates(spark):
    a, b = F.lit("2016-01-01").cast("date"), F.lit("2017-05-22").cast("date")
    row = one(
        spark, months=F.months_between(a, b), days=F.datediff(F.date_sub(b, 7), b), bad=D.parse_day(F.lit("2016-20-12"), "yyyy-MM-dd"),
        good=D.parse_day(F.lit("2017-12-11"), "yyyy-dd-MM"), written=D.parse_day(F.lit("1/4/2011 8:26"), "M/d/yyyy H:mm"),
        sunday=D.weekday(F.lit("2024-03-03").cast("date")), month=D.month_start(b),
    )
    assert row["months"] == pytest.approx(-16.67741935) and row["days"] == -7 and row["bad"] is None
    assert row["good"] == dt.date(2017, 11, 12) and row["written"] == dt.date(2011, 1, 4)
    assert row["sunday"] == 0 and row["month"] == dt.date(2017, 5, 1)


def test_load_stamp(spark):
    row = D.with_load_stamp(spark.range(1)).first()
    assert abs((dt.datetime.now() - row["load_time"]).total_seconds()) < 86_400
    assert isinstance(row["load_date"], dt.date)


@pytest.mark.parametrize(
    "text, percent, price",
    [("95%", 0.95, None), ("$1,200.50", None, 1200.5), ("", None, None), ("N/A", None, None), (None, None, None)],
)
def test_percent_and_price(spark, text, percent, price):
    row = one(spark, a=M.parse_percent(F.lit(text).cast("string")), b=M.parse_price(F.lit(text).cast("string")))
    assert row["a"] == (pytest.approx(percent) if percent is not None else None)
    assert row["b"] == (price if price is not None else None)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 100), st.integers(0, 10**9))
def test_percent_and_price_round_trip(spark, share, cents):
    row = one(spark, a=M.parse_percent(F.lit(f"{share}%")), b=M.parse_price(F.lit(f"${cents / 100:,.2f}")))
    assert row["a"] == pytest.approx(share / 100) and row["b"] == pytest.approx(cents / 100)


@pytest.mark.parametrize("text, items", [("['email', 'phone']", ["email", "phone"]), ("[]", [""]), (None, None)])
def test_list_strings(spark, text, items):
    assert one(spark, x=X.parse_list(F.lit(text).cast("string")))["x"] == items


def test_score_lines(spark):
    lines = ["runs,minutes,balls,fours", "15,28,24,2", "50*,70,61,5", "DNB,-,-,-", "absent,-,-,-", "x,1,2,3", "120"]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = IO.parse_delimited(frame, lines[0], {0: "runs", 3: "fours"}, "runs", ["DNB", "TDNB", "absent"])
    assert [tuple(r) for r in parsed.collect()] == [(15.0, "2"), (50.0, "5"), (None, "3"), (120.0, None)]
    assert parsed.where("runs >= 50").count() == 2


def test_labelled_points(spark):
    lines = ["(1.0,[0.5,1.5,2.0])", "(2, [1, 2, 3])", "broken", "(x,[1,2,3])", "(1,[1,y,3])", ""]
    found = parse_labelled(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r["label"], r["features"]) for r in found] == [(1.0, [0.5, 1.5, 2.0]), (2.0, [1.0, 2.0, 3.0])]


def test_strict_csv_drops_bad_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,value\n 1,a,2.5\n2,b\n3,c,many\n4,d,1.0\n")
    rows = IO.read_csv_strict(spark, str(tmp_path), spark.createDataFrame([], "id int, name string, value double").schema)
    assert sorted(r["id"] for r in rows.select("id").collect()) == [1, 4]


def test_nulls(spark):
    frame = spark.createDataFrame([(1, "a"), (None, "N/A"), (None, None)], "n int, s string")
    assert U.drop_null(frame, "all").count() == 2 and U.drop_null(frame, "any").count() == 1
    assert [r["s"] for r in U.tokens_to_null(frame, ["N/A", "."]).collect()] == ["a", None, None]
    # A text fill leaves the number column alone.
    assert [r["n"] for r in frame.fillna("x").collect()] == [1, None, None]
    assert [r["s"] for r in U.replace_values(frame, "s", ["a"], ["b"]).collect()] == ["b", "N/A", None]


def test_clamp_keeps_null(spark):
    frame = spark.createDataFrame([(None,), (5.0,), (500.0,)], "v double")
    assert [r["v"] for r in R.clamp_upper(frame, {"v": 200.0}).collect()] == [None, 5.0, 200.0]


def test_densify(spark):
    counts = spark.createDataFrame([(1990, 3), (1993, 1)], "year int, n long")
    filled = {r["year"]: r["n"] for r in R.densify(counts, "year", ["n"]).collect()}
    assert filled == {1990: 3, 1991: 0, 1992: 0, 1993: 1}
    assert R.densify(counts.where("year < 0"), "year", ["n"]).count() == 0


def test_histogram_of_a_constant(spark):
    frame = spark.createDataFrame([("a", 4.0)] * 3 + [("b", None)], "k string, v double")
    assert [tuple(r) for r in A.histogram(frame, ["k"], "v", 5).collect()] == [("a", 0, 4.0, 3)]


def test_chi_square_known_value(spark):
    cells = {("a", "x"): 10, ("a", "y"): 20, ("b", "x"): 30, ("b", "y"): 5}
    data = [pair for pair, n in cells.items() for _ in range(n)]
    frame = spark.createDataFrame(data, "p string, q string")
    row = A.chi_square_p(frame, ["p", "q"]).first()
    n = sum(cells.values())
    left, top = {"a": 30, "b": 35}, {"x": 40, "y": 25}
    wanted = sum((cells[i, j] - left[i] * top[j] / n) ** 2 / (left[i] * top[j] / n) for i, j in cells)
    assert row["statistic"] == pytest.approx(wanted) and row["dof"] == 1
    assert row["p_value"] == pytest.approx(math.erfc(math.sqrt(wanted / 2)), rel=1e-6)


def test_mode_tie_and_nulls(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert tuple(A.mode(frame, [], "v").first()) == ("a", 2)


def test_rollup_inside_cube(spark):
    frame = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", "x", 3)], "p string, q string, n int")
    both = [
        {tuple(r) for r in g.agg(F.grouping_id().alias("g"), F.sum("n").alias("n")).collect()}
        for g in (frame.rollup("p", "q"), frame.cube("p", "q"))
    ]
    assert both[0] < both[1]


def test_label_uses_training_mean(spark):
    frame = spark.createDataFrame([("a", 1.0, True), ("a", 3.0, True), ("a", 9.0, False), ("z", 5.0, False)], "k string, v double, train boolean")
    labelled = E.label_vs_group_mean(frame.where("train"), frame, "k", "v", "y")
    assert sorted((r["v"], r["y"]) for r in labelled.collect()) == [(1.0, 0), (3.0, 1), (5.0, 0), (9.0, 1)]


def test_impute(spark):
    frame = spark.createDataFrame([(1.0, 1.0, "u"), (2.0, 2.0, "u"), (6.0, 3.0, "v"), (None, 4.0, None), (None, None, None)], "a double, b double, c string")
    filled = E.impute(frame, {"a": "mean", "b": "median", "c": "mode"}).collect()
    assert [r["a"] for r in filled][3:] == [3.0, 3.0] and filled[4]["b"] == 2.0 and filled[4]["c"] == "u"


def test_look_ups(spark):
    row = one(
        spark, rate=N.look_up(F.lit("Rome"), {"Paris": 0.9, "Rome": 0.92}, 1.0), other=N.look_up(F.lit("Oslo"), {"Rome": 0.92}, 1.0),
        top=N.index_of_max(F.array(*[F.lit(v) for v in (1.0, 9.0, 9.0)])), words=N.index_words(F.array(F.lit(2), F.lit(0)), ["a", "b", "c"]),
        short=N.element(F.array(F.lit(1)), 3),
    )
    assert tuple(row) == (0.92, 1.0, 1, ["c", "a"], None)


def test_prompt_layout(spark):
    frame = spark.createDataFrame([("What a lovely evening",)], "t string")
    examples = [(1, "The train is late again.", "Bad")]
    prompt = X.few_shot_prompt(frame, "t", examples, "Tell the mood of each note:", "Note", "Mood")
    assert frame.select(prompt).first()[0] == (
        "Tell the mood of each note:\n"
        '[Note]: "The train is late again."\n[Mood]: Bad\n###\n'
        '[Note]: "What a lovely evening"\n[Mood]:'
    )


def test_punctuation(spark):
    assert one(spark, x=S.clean_punctuation(F.lit("A!?.,-_[]^`~\\b")))["x"] == "ab"


def test_tokens_round_trip_and_padding(spark):
    frame = spark.createDataFrame([(1, " to be or  not\nto be "), (2, "be"), (3, "  ")], "d int, t string")
    vocab = X.vocabulary(frame, "t")
    assert sorted(r["id"] for r in vocab.collect()) == [1, 2, 3, 4]
    coded = X.encode(frame, "d", "t", vocab, 4)
    sizes = {r["d"]: (len(r["ids"]), sum(r["mask"])) for r in coded.collect()}
    assert sizes == {1: (4, 4), 2: (4, 1), 3: (4, 0)}
    assert {r["d"]: r["text"] for r in X.decode(coded, "d", "ids", vocab).collect()} == {1: "to be or not", 2: "be", 3: ""}


def test_vocabulary_numbers_have_no_gaps(spark):
    frame = spark.createDataFrame([(" ".join(f"w{i % (j + 1)}" for i in range(300)),) for j in (400, 20, 5)], "t string")
    found = sorted(map(tuple, X.vocabulary(frame, "t").select("id", "n").collect()))
    assert [i for i, _ in found] == list(range(1, 301)) and [n for _, n in found] == sorted((n for _, n in found), reverse=True)


def test_money_means_round_half_up(spark):
    frame = spark.createDataFrame([(100_000_001, 800), (3, 2), (-1, 8), (None, 0)], "total long, n long")
    got = [r[0] for r in frame.select(M.mean_of_cents("total", "n")).collect()]
    assert got == [1250.0, 0.015, -0.0012, None]


def test_null_keys_stay_in_one_part(spark):
    frame = spark.createDataFrame([(1,), (None,), (None,), (2,)], "k int")
    low, high = SA.split_hash(frame, "k", 70)
    assert low.count() + high.count() == 4
    assert {r["part"] for r in SA.mark_split(frame, "k", 70).collect()} <= {"train", "test"}


def test_flags_and_unlisted_values(spark):
    frame = spark.createDataFrame([("t",), ("f",), ("x",), (None,)], "m string")
    assert [r[0] for r in frame.select(R.encode_flag("m")).collect()] == [1, 0, 0, None]
    pairs = spark.createDataFrame([("a", "x", 1.0), ("a", "z", 2.0), ("a", None, 4.0)], "p string, q string, v double")
    assert tuple(A.crosstab(pairs, "p", "q", ["x", "y"]).first()) == ("a", 1, 0, 2)
    assert tuple(A.pivot_mean(pairs, "p", "q", ["x", "y"], "v", 2).first()) == ("a", 1.0, 0.0, 2)


def test_lines_without_the_number_field_stay(spark):
    lines = spark.createDataFrame([("h",), ("x,5",), ("y",)], "value string")
    parsed = IO.parse_delimited(lines, "h", {0: "name", 1: "runs"}, "runs", ["DNB"])
    assert sorted(map(tuple, parsed.collect())) == [("x", 5.0), ("y", None)]


def test_inserts_append(spark, tmp_path):
    """Two inserts into one table, and one more from a session that doesn't know it."""
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "i int, day string")
    names = {"i": "id", "day": "day"}
    IO.insert_partitioned(rows.where("i = 1"), "kept_days", str(tmp_path / "t"), names, "day")
    IO.insert_partitioned(rows.where("i = 2"), "kept_days", str(tmp_path / "t"), names, "day")
    assert sorted(map(tuple, spark.table("kept_days").collect())) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE kept_days")
    IO.insert_partitioned(rows.where("i = 2"), "kept_days", str(tmp_path / "t"), names, "day")
    assert sorted(map(tuple, spark.table("kept_days").collect())) == [(1, "a"), (2, "b"), (2, "b")]
    spark.sql("DROP TABLE kept_days")


def test_hot_keys_on_either_side(spark):
    left = spark.range(3000).select((F.when(F.col("id") < 1000, 7).otherwise(F.col("id"))).alias("k"), F.lit(1).alias("a"))
    right = spark.range(200).select((F.when(F.col("id") < 50, 9).otherwise(F.col("id"))).alias("k"), F.lit(2).alias("b"))
    joined = R.join_partitioned(left, right, "k", 8)
    assert joined.count() == left.join(right, "k").count()


def test_forecast_of_a_series_with_zeros(spark):
    from millrace.operators import forecast as FC

    days = [("a", f"2020-{1 + i // 28:02}-{1 + i % 28:02}", 0.0 if i % 20 == 0 else 100.0 + (i % 7)) for i in range(300)]
    hist = spark.createDataFrame(days, "k string, ds string, y double").withColumn("ds", F.to_date("ds"))
    hist = hist.union(spark.createDataFrame([("none", None, None)], "k string, ds string, y double").withColumn("ds", F.to_date("ds")))
    found = FC.grouped_map(hist, ["k"], 10).where("y IS NOT NULL").agg(F.avg("y"), F.avg("yhat")).first()
    assert abs(found[0] - found[1]) < 0.05 * found[0]


def test_next_words(spark):
    frame = spark.createDataFrame([("a b a b a c",), ("a",), ("",)], "t string")
    found = {(r["word"], r["next"]): r["n"] for r in X.next_token(frame, "t", 10, 0.5).collect()}
    assert found == {("a", "b"): 2, ("b", "a"): 2}


def test_strip_html(spark):
    frame = spark.createDataFrame([("<b>café</b>\n  bar",)], "h string")
    assert X.strip_html(frame, ["h"]).first()[0] == " caf bar"


def test_splits_are_disjoint_and_complete(spark):
    frame = spark.range(500)
    a, b = SA.split_hash(frame, "id", 70)
    assert a.count() + b.count() == 500 and a.intersect(b).count() == 0 and 300 < a.count() < 400
    # A key keeps its side when the table grows.
    grown, _ = SA.split_hash(spark.range(1000), "id", 70)
    assert a.subtract(grown).count() == 0
    sizes = {r["part"]: r["count"] for r in SA.mark_random(frame, {"c": 7, "d": 3}, 42, ["id"]).groupBy("part").count().collect()}
    assert sum(sizes.values()) == 500 and 300 < sizes["c"] < 400
    assert SA.mark_random(frame.repartition(7), {"c": 7, "d": 3}, 42, ["id"]).exceptAll(SA.mark_random(frame, {"c": 7, "d": 3}, 42, ["id"])).count() == 0


def test_samples(spark):
    frame = spark.range(2000).withColumn("k", F.col("id") % 3)
    assert SA.sample_n(frame, 50, 1).count() == 50
    assert SA.sample_n(frame, 50, 1).select("id").distinct().count() == 50
    assert SA.sample_n(frame, 3000, 1, replace=True).count() == 3000
    assert SA.sample_n(frame, 3000, 1).count() == 2000
    # The same rows under any layout, with and without a key, and from a table with equal rows.
    for more in ({}, {"key": ["id"]}, {"key": ["id"], "replace": True}, {"replace": True}):
        once, again = (sorted(map(tuple, SA.sample_n(f, 70, 5, **more).collect())) for f in (frame, frame.repartition(9, "k")))
        assert once == again and len(once) == 70
    equal = spark.range(1000).select((F.col("id") % 2).alias("v"))
    halves = {r["v"]: r["count"] for r in SA.sample_n(equal, 300, 2).groupBy("v").count().collect()}
    assert sum(halves.values()) == 300 and 100 < halves[0] < 200
    SETTLED, SA.SETTLED = SA.SETTLED, 10
    try:
        assert SA.sample_n(frame, 777, 3, key=["id"]).distinct().count() == 777
        # A key that does not tell rows apart: the last hash is cut to the number that is missing.
        assert SA.sample_n(frame, 777, 3, key=["k"]).count() == 777
    finally:
        SA.SETTLED = SETTLED
    drawn = SA.sample_by_key(frame, "k", {0: 2.0, 1: 0.5}, 9, replace=True)
    counts = {r["k"]: r["count"] for r in drawn.groupBy("k").count().collect()}
    assert set(counts) == {0, 1} and abs(counts[0] - 1334) < 200 and abs(counts[1] - 333) < 100
    assert SA.sample_by_key(frame, "k", {0: 0.5}, 9).where("k <> 0").count() == 0


def test_key_hot_on_both_sides_is_a_grid(spark):
    """Half of both sides under one key: the join of that key is many tasks, and nothing is lost or doubled."""
    left = spark.range(0, 400, 1, 4).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(0, 300, 1, 4).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("b"))
    joined = R.join_partitioned(left, right, "k", 16)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    cells = R._fragments(left.where("k = 5"), "x", 4, "y", 4).groupBy("x", "y").count().collect()
    assert len(cells) == 16 and max(r["count"] for r in cells) <= 2 * 200 / 4


def test_frequent_items_count_candidates_only(spark):
    frame = spark.range(10_000).select(F.when(F.col("id") % 4 == 0, 1).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") + 10).alias("v"))
    want = {(r["v"], r["count"]) for r in frame.groupBy("v").count().collect() if r["count"] >= 0.02 * 10_000}
    assert {tuple(r) for r in A.frequent_items(frame, "v", 0.02).collect()} == want and len(want) == 2
    assert A.frequent_items(frame, "v", 0.25).collect()[0][0] == 1
    assert A.frequent_candidates(frame, "v", 0.02).count() <= 50
    assert A.frequent_items(frame.limit(0), "v", 0.5).collect() == []


def test_correlation_of_many_columns(spark):
    """500 columns, some with gaps, one constant, one without values: equal to a plain count of every pair."""
    r = np.random.default_rng(2)
    data = r.normal(1e6, 3, (60, 500))
    data[:, 1] = 2 * data[:, 0] + r.normal(0, 1, 60)
    data[::7, 2:9] = np.nan
    data[:, 9], data[:, 10] = 0.1, np.nan
    frame = spark.createDataFrame([[None if v != v else float(v) for v in row] for row in data], ", ".join(f"x{i} double" for i in range(500)))
    got = {(x["a"], x["b"]): x["r"] for x in C.corr_matrix(frame.repartition(3), frame.columns).collect()}
    assert len(got) == 500 * 500
    for i, j in [(0, 1), (1, 0), (2, 3), (2, 400), (8, 0), (499, 498), (5, 5)]:
        both = ~np.isnan(data[:, i]) & ~np.isnan(data[:, j])
        assert got[f"x{i}", f"x{j}"] == pytest.approx(np.corrcoef(data[both, i], data[both, j])[0, 1], abs=1e-9)
    assert got["x9", "x9"] is None and got["x9", "x0"] is None and got["x10", "x3"] is None
    assert C.corr_matrix(frame.limit(0), ["x0", "x1"]).where("r IS NOT NULL").count() == 0


def test_correlation_of_series_found_in_the_data(spark):
    rows = [(t, f"k{k}", float((t * (k + 3)) % 11)) for t in range(30) for k in range(40) if (t + k) % 9]
    frame = spark.createDataFrame(rows, "t int, k string, v double")
    for fill in (False, True):
        got = {(x["a"], x["b"]): x["r"] for x in C.series_corr(frame, "t", "k", "v", zero_fill=fill).collect()}
        wide = {k: {t: v for t, key, v in rows if key == k} for k in {r[1] for r in rows}}
        assert len(got) == 1600
        for a, b in [("k0", "k1"), ("k7", "k31"), ("k39", "k2")]:
            at = sorted(set(wide[a]) & set(wide[b])) if not fill else range(30)
            x, y = ([wide[k].get(t, 0.0) for t in at] for k in (a, b))
            assert got[a, b] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)


def test_forecast_of_a_kinked_series(spark):
    """A trend that turns: history and the days after it are met within 5 per cent."""
    from millrace.operators import forecast as FC

    start = dt.date(2020, 1, 1)
    level = lambda i: 100 + i if i < 200 else 300 - 0.5 * (i - 200)
    days = [("a", start + dt.timedelta(days=i), float(level(i) + (i % 7))) for i in range(400)]
    hist = spark.createDataFrame(days, "k string, ds date, y double")
    got = FC.grouped_map(hist, ["k"], 30).orderBy("ds").collect()
    assert len(got) == 430
    for i, r in enumerate(got):
        truth = level(i) + (i % 7)
        assert abs(r["yhat"] - truth) <= 0.05 * abs(truth), (i, r["yhat"], truth)
