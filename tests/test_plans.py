"""Plans: filters in the scan, partitions pruned, top-k without a full sort, few shuffles."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.operators import aggregates, dictionaries, features, ordered, sampling, selection, text
from millrace.operators import forecast as FC
from millrace.operators import relational as R
from millrace.plans import text as plan_text
from millrace.session import materialise


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().toString()


def test_filters_reach_the_scan(spark, sf_dir):
    plan = plan_of(entry.queries()["src_parquet"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_returnflag), GreaterThan(l_quantity,30.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan
    dated = plan_of(entry.queries()["filter_compare"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_shipdate" in dated


def test_partition_is_pruned(spark, sf_dir):
    plan = plan_of(entry.queries()["sink_partitioned_insert"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(status" in plan


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["topk_global"](spark, sf_dir))
    assert "WindowGroupLimit" in plan_of(entry.queries()["topk_per_group"](spark, sf_dir))


def test_forecast_shuffles_twice(spark, sf_dir):
    """Once for the daily sums, once by series for all windows together."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = ["l_returnflag", "l_linestatus"]
    plan = FC.seasonal(FC.history(lines, keys, "l_shipdate", "l_quantity"), keys)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2


def test_hot_key_is_split_in_group_joins(spark):
    """With a third of the rows under one key and no broadcast, the join of group values is split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 997)
        rows = spark.range(0, 60_000, 1, 8).select(key.alias("k"), F.col("id").alias("v"))
        joined = R.stats_back(rows, ["k"], {"n": F.count("*"), "m": F.avg("v")})
        assert joined.count() == 60_000
        found = joined.where("v >= 0")
        assert len(found.collect()) == 60_000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def stored(monkeypatch):
    """The frames that operators store on their way, as (columns, executed plan), in order."""
    found = []

    def recorded(df, label):
        found.append((df.columns, df._jdf.queryExecution().toString()))
        return materialise(df, label)

    for module in (dictionaries, ordered, selection, sampling, text, features, aggregates, plan_text):
        if hasattr(module, "materialise"):
            monkeypatch.setattr(module, "materialise", recorded)
    return found


def physical(plan):
    return plan.partition("== Physical Plan ==")[2]


def reads(plan, column, table=""):
    """Scans of a table that read a column."""
    scans = [line for line in physical(plan).splitlines() if "Scan parquet" in line and table in line]
    return sum(f"{column}:" in found for line in scans for found in re.findall(r"ReadSchema: (struct<.*)", line))


def test_summaries_read_texts_twice_and_shuffle_them_once(spark, sf_dir, stored):
    final = plan_of(entry.queries()["txt_extract_summary"](spark, sf_dir))
    plans = [p for _, p in stored] + [final]
    assert sum(reads(p, "text", "documents.parquet") for p in plans) <= 2
    # Texts travel to their block; of all other exchanges none carries a text.
    assert sum("text#" in line for p in plans for line in physical(p).splitlines() if "Exchange" in line) == 0
    assert physical(final).count("REPARTITION_BY_COL") == 1


def test_token_ids_never_shuffle_tokens(spark, sf_dir, stored):
    final = plan_of(entry.queries()["txt_token_ids"](spark, sf_dir))
    plans = [physical(p) for _, p in stored] + [physical(final)]
    assert not any("posexplode" in p for p in plans)
    assert sum("FlatMapCoGroupsInArrow" in p or "FlatMapCoGroupsInPandas" in p for p in plans) >= 1
    # Once for the vocabulary, once for the words of blocks, once for the texts themselves.
    assert sum(reads(p, "text", "documents.parquet") for p in [*(p for _, p in stored), final]) == 3


def test_quantiles_sort_and_store_no_rows(spark, sf_dir, stored):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    selection.quantiles(lines, ["l_returnflag"], "l_extendedprice", {"a": 0.1, "m": 0.5, "z": 0.9}).collect()
    assert 1 <= len(stored) <= selection.BITS // selection.DIGIT
    for columns, plan in stored:
        assert reads(plan, "l_extendedprice", "lineitem.parquet") == 1
        assert "rangepartitioning" not in physical(plan) and "__place" in columns
    # One digit after the other: all groups and probabilities go through each pass together.
    stored.clear()
    selection.quantiles_of(lines, [], ["l_quantity", "l_discount", "l_tax"], {"m": 0.5}).collect()
    assert all(reads(plan, "l_tax", "lineitem.parquet") == 1 for _, plan in stored)


@pytest.mark.parametrize("key", ["win_rank", "win_running_avg", "win_moving_avg", "win_lag_change", "win_change_with_avg"])
def test_windows_store_no_rows(spark, sf_dir, stored, key):
    """Only the keys with very many rows are stored, and there are none here; the rows are shuffled once."""
    final = physical(plan_of(entry.queries()[key](spark, sf_dir)))
    assert [c for c, _ in stored if "__n" not in c] == []
    assert final.count("Exchange hashpartitioning") == 1


def test_a_draw_is_counts_and_one_filter(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    plan = physical(plan_of(sampling.sample_n(orders, 100, 3, key=["o_orderkey"])))
    assert "Exchange" not in plan and "Sort" not in plan and plan.count("Scan parquet") == 1
