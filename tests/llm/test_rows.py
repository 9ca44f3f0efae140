"""Sharding, mixing and row numbers against plain readings."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import common, mixing, sharding
from millrace.llm.queries import QUERIES

from .conftest import collected


def slow_permutation(row, n, seed):
    a, b = sharding.sides(n)
    p = row
    while True:
        left, right = divmod(p, b)
        for k, (c1, c2) in enumerate(sharding.keys(seed)):
            def mixed(v):
                t = (v + c1) % sharding.PRIME
                return ((t * t % sharding.PRIME + c2) * t) % sharding.PRIME

            if k % 2:
                right = (right + mixed(left) % b) % b
            else:
                left = (left + mixed(right) % a) % a
        p = left * b + right
        if p < n:
            return p


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 97, 1000])
def test_permutation(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "row")
    got = dict(collected(sharding.permute(rows, n, 5), "row", "permuted"))
    assert got == {i: slow_permutation(i, n, 5) for i in range(n)}
    assert sorted(got.values()) == list(range(n))
    assert all(sharding.row_at(p % 3, p // 3, n, 3, 5) == i for i, p in got.items())


def test_other_seeds_give_other_orders():
    assert len({tuple(slow_permutation(i, 100, seed) for i in range(100)) for seed in range(20)}) == 20


def test_shard_query(spark, sf_dir, rows):
    got = {r["doc_id"]: r for r in QUERIES["op3_sharding"](spark, sf_dir).collect()}
    n = len(rows)
    for at, (doc, text, *_) in enumerate(sorted(rows)):
        data, p, r = (text or "").encode(), slow_permutation(at, n, 1), got[doc]
        assert (r["size"], r["text_crc32"], r["shard"], r["slot"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), p % 40, p // 40, "rows", None)


def test_shard_cases(spark, frame):
    rows = [(1, None), (1, ""), (None, "é"), (3, "x" * 100_000), (3, "a"), (3, "a")]
    got = sharding.shard(frame(rows), 4)
    assert sorted(Counter(r["shard"] for r in got.collect()).values()) == [1, 1, 2, 2]
    places = collected(got, "shard", "slot")
    assert len(set(places)) == 6 and all(slot in (0, 1) for _, slot in places)
    assert Counter(r["size"] for r in got.collect()) == Counter([16, 16, 18, 100_016, 17, 17])
    assert sharding.shard(frame([]), 4).collect() == []
    assert [(r["shard"], r["slot"]) for r in sharding.shard(frame([(9, "a")]), 40).collect()] == [(0, 0)]


def test_row_numbers_with_repeats(spark):
    df = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(300)], "k long, v long")
    got = common.number_rows(df, F.col("k"), F.xxhash64("v"), [F.col("k").asc_nulls_first(), F.xxhash64("v")], "n")
    hashes = {r["v"]: r["h"] for r in df.select("v", F.xxhash64("v").alias("h")).collect()}
    want = sorted(((i % 7 if i % 5 else None, i) for i in range(300)), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    assert [(r["k"], r["v"]) for r in sorted(got.collect(), key=lambda r: r["n"])] == want


def test_blocks_split_hot_ids_and_equal_rows(spark):
    """A third of the rows without an id, a fifth with one id, and most of those one text: no block much above its share."""
    def row(i):
        doc = None if i % 3 == 0 else 5 if i % 5 == 0 else i
        return doc, "copy" if i % 3 == 0 and i % 4 else "same" if doc == 5 else f"text {i}"

    df = spark.createDataFrame([row(i) for i in range(12_000)], "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    parts = 24
    cut = common.with_block(df, F.col("doc_id"), F.col("h"), parts)
    sizes = [r["count"] for r in cut.groupBy("__block").count().collect()]
    assert max(sizes) <= 2.5 * 12_000 / parts and len(sizes) >= parts / 2
    spans = cut.select("__block", F.struct(F.col("doc_id").isNotNull().alias("a"), F.coalesce("doc_id", F.lit(0)).alias("b"), "h").alias("at"))
    ends = spans.groupBy("__block").agg(F.min("at").alias("low"), F.max("at").alias("high")).orderBy("__block").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(ends, ends[1:], strict=False))
    numbered = common.number_rows(df, F.col("doc_id"), F.col("h"), [F.col("doc_id"), F.col("h")], "n").collect()
    assert sorted(r["n"] for r in numbered) == list(range(12_000))
    shown = [(r["doc_id"] is not None, r["doc_id"] or 0, r["h"]) for r in sorted(numbered, key=lambda r: r["n"])]
    assert shown == sorted(shown)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (3, 1), *[(100 + i, 101 + i) for i in range(60)], *[(500, 501 + i) for i in range(50)]]
    got = dict(collected(common.components(spark.createDataFrame(edges, "a long, b long")), "node", "component"))
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, **{100 + i: 100 for i in range(61)}, **{500 + i: 500 for i in range(51)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


def slow_targets(words, weights=(5, 2, 1), most=3):
    """Share out again and again what is above a limit."""
    names = sorted((s for s in words if s is not None)) + [None] * (None in words)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, sum(words.values()), set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * words[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = most * words[s]
            free.remove(s)
            left -= target[s]
    return target


def check_mix(rows, got):
    words, taken, largest = Counter(), Counter(), Counter()
    for _, text, source in rows:
        words[source] += len((text or "").split())
    target = slow_targets(words)
    for r in got:
        assert r["source_size"] == words[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(got) == len(rows)
    for source in words:
        assert abs(taken[source] - target[source]) <= largest[source] + 1e-6
    return target


def test_mix(spark, docs, rows):
    got = mixing.mix(docs).collect()
    check_mix([(d, t, s) for d, t, _, s, _ in rows], got)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r["doc_id"], r["copies"]) for r in again)


def test_mix_cases(spark, frame):
    rows = [(i, "a b c" * (i % 4), None, "big") for i in range(40)] + [(100, "x", None, "alone"), (101, None, None, None), (102, "q r", None, None)]
    rows += [(103, "", None, "void"), (1, "a b", None, "big"), (1, "a b", None, "big"), (None, "word " * 500, None, "zed")]
    target = check_mix([(d, t, s) for d, t, _, s in rows], mixing.mix(frame(rows)).collect())
    assert target["alone"] == 3 and target["void"] == 0
    assert mixing.mix(frame([])).collect() == []


def test_take(spark, frame):
    rows = [(i, "a b c d", None, "s" if i % 3 else None) for i in range(30)] + [(None, "n", None, "t")]
    made = frame(rows)
    decided = mixing.mix(made)
    got = mixing.take(made, decided)
    assert got.columns == made.columns
    want = {r["doc_id"]: r["copies"] for r in decided.collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(want)


def test_word_count(spark):
    texts = ["", " ", "a", " a\tb\nc\x0bd\x0ce\rf ", "a\x1cb\x85c d", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(F.col("t"))).collect()]
    assert got == [0, 0, 1, 6, 2, 0]


def test_sizes_by_source_are_whole(spark, sf_dir, rows):
    got = QUERIES["op9_mixing"](spark, sf_dir).collect()
    sizes = defaultdict(int)
    by_id = {d: s for d, _, _, s, _ in rows}
    for r in got:
        sizes[by_id[r["doc_id"]]] += r["size"]
    assert all(r["source_size"] == sizes[by_id[r["doc_id"]]] for r in got)
