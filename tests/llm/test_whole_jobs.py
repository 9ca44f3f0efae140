"""Cases of a review of whole jobs: each failed before its finding was settled."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from millrace.llm import mixing, ngram_join, pii, similar_sets
from millrace.llm.common import by_row, numbered, with_value

from .conftest import collected, passage
from .test_similar import CASES, slow_classes, variants


@pytest.mark.parametrize("size", [1, 5, 10, 25, 60, 300, 20_000])
def test_lists_at_eight_tenths_are_whole_and_few(size):
    """Long sets were listed under every three of their empty parts: 400,000 lists for 20,000 shingles."""
    r, linked = np.random.default_rng(size), 0
    for _ in range(300 if size <= 300 else 20):
        a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
        cut, new = r.integers(0, max(1, size // 8) + 1, 2)
        b = np.unique(np.concatenate([a[cut:], r.integers(0, 1 << 63, new, dtype=np.uint64)]))
        both, lists = len(np.intersect1d(a, b)), ngram_join.part_keys(a, 8, 10)
        assert len(lists) <= 3 * len(a) + 1
        if len(b) and 10 * both >= 8 * (len(a) + len(b) - both):
            linked += 1
            assert len(np.intersect1d(lists, ngram_join.part_keys(b, 8, 10)))
    assert linked


def test_components_at_eight_tenths_of_five_words(frame):
    rows = [*CASES, *variants(6, 12_000, 300, 9, 1000)]
    got = collected(ngram_join.components_of(frame(rows), 5, 8, 10), "doc_id", "n_shingles", "component_id")
    assert got == slow_classes(rows, 5, 8, 10)


def test_copies_are_told_by_row(spark, frame, sf_dir):
    a, b, c = passage(40), passage(40, 3), passage(40, 7)
    rows = [
        (1, a), (2, a), (2, b), (3, b),  # 2 repeats: its copy of 1 goes, its other text stays and stands for 3
        (4, c), (4, c), (4, c),  # equal rows of one id
        (None, passage(50, 9)), (None, passage(50, 9)), (None, a), (None, passage(60, 11)),  # no id
        (5, ""), (5, ""), (None, None),  # no words: linked with nothing
    ]
    want = [(1, a), (2, b), (4, c), (None, passage(50, 9)), (None, passage(60, 11)), (5, ""), (5, ""), (None, None)]
    made = frame(rows)
    got = P.without_copies(spark, made, sf_dir)
    assert got.columns == made.columns
    assert collected(got, "doc_id", "text") == sorted(want, key=repr)


def test_a_hot_id_keeps_its_clean_rows(spark, frame, sf_dir):
    rows = [(1, passage(40)), (7, passage(40)), *[(7, f"own{i} " + passage(30, 3, i)) for i in range(0, 60, 5)], (8, passage(80, 13))]
    assert collected(P.without_copies(spark, frame(rows), sf_dir), "doc_id", "text") == sorted([rows[0], *rows[2:]], key=repr)


FORMS = [
    ("ip 192 dot 168 dot 0 dot 1 ok", "ip", "192 dot 168 dot 0 dot 1"),
    ("10 dot 0 dot 0 dot one", "ip", "10 dot 0 dot 0 dot one"),
    ("5 10.0.0.one ok", "ip", "10.0.0.one"),
    ("pay 4111 1111 1111 one 111 now", "card", "4111 1111 1111 one 111"),
    ("+1 555 five 55 oh one two three", "phone", "+1 555 five 55 oh one two three"),
    ("by john dot smith at example dot com", "email", "john dot smith at example dot com"),
    ("jane at example.org", "email", "jane at example.org"),
    ("jane At example Dot org", "email", "jane At example Dot org"),
    ("jane  at\texample point\r\norg", "email", "jane  at\texample point\r\norg"),
    ("jane\n[ AT ]\texample  (Dot)  org", "email", "jane\n[ AT ]\texample  (Dot)  org"),
    ("x \u0661\u0660.0.0.\u0661", "ip", "\u0661\u0660.0.0.\u0661"),
    ("x \U0001d7cf\U0001d7ce.0.0.1", "ip", "\U0001d7cf\U0001d7ce.0.0.1"),
]


@pytest.mark.parametrize("text,kind,what", FORMS)
def test_disguises_in_any_form(text, kind, what):
    base, spans = pii.find(text)
    assert [(k, text[a:b]) for k, a, b in spans if (k, a, b) not in base] == [(kind, what)]


@pytest.mark.parametrize("text", ["we met at 5.30 and one, two", "at one point five of them left", "the dot at the end. One 2", "zero point one at most", " " * 50_000 + "(", "1 " * 30_000 + "one", "a dot " * 20_000])
def test_prose_is_left_alone(text):
    assert pii.find(text) == ([], [])


def test_rows_of_one_id_are_taken_one_by_one(spark, frame, sf_dir):
    ids, sources = [None] * 20 + [7] * 20, ["a", "b"] * 20
    made = frame([(d, f"text{i} " + passage(9), "en", s) for i, (d, s) in enumerate(zip(ids, sources, strict=True))])
    got = Counter(r["text"] for r in P.mixed(spark, made, sf_dir).collect())
    # Sizes are equal, so of each source what its copies sum to is taken, spread evenly over its rows.
    decided = mixing.mix(made).groupBy("source").agg(F.sum("copies").alias("n")).collect()
    for row in decided:
        mine = [got[r["text"]] for r in made.collect() if r["source"] == row["source"]]
        assert sum(mine) == row["n"] and max(mine) - min(mine) <= 1


def test_rows_from_files_keep_their_numbers(spark, tmp_path):
    made = spark.range(0, 30_000, 1, 3).select((F.col("id") % 7).alias("doc_id"), F.col("id").alias("__path"), F.lit("x").alias("text"))
    made.write.parquet(str(tmp_path / "rows"))
    whole = spark.read.parquet(str(tmp_path / "rows"))
    once = numbered(whole, "n")
    assert once.columns == [*whole.columns, "n"]
    first = {r["__path"]: r["n"] for r in once.collect()}
    assert len(set(first.values())) == 30_000
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert {r["__path"]: r["n"] for r in numbered(whole, "n").collect()} == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Rows that are not a file's own are stored with their numbers.
    twice = numbered(whole.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), "n")
    assert twice.select("n").distinct().count() == 60_000
    packed = by_row(once.where("__path % 5 = 0").withColumn("v", F.lit(3)), "n", "v")
    told = with_value(once, "n", packed, "v").collect()
    assert len(told) == 30_000 and all(r["v"] == (0 if r["__path"] % 5 else 3) for r in told)


@pytest.mark.parametrize("num,den", [(9, 10), (8, 10)])
def test_large_families_are_tied_again_without_losing_a_link(frame, monkeypatch, num, den):
    """Unlike texts around common passages make one family; what the second lists tie has every link and fewer sets."""
    monkeypatch.setattr(similar_sets, "LARGE_FAMILY", 3)
    r, rows = random.Random(4), []
    for i in range(120):
        own = passage(r.choice([30, 80, 300]), 7, 1000 + 400 * i).split()
        text = own + passage(46, 1, 97 * (i % 3)).split()
        rows.append((10 * i, " ".join(text)))
        for k in range(i % 4):
            changed = list(text)
            changed[r.randrange(len(own))] = f"edit{i}"
            rows.append((10 * i + 1 + k, " ".join(changed)))
    want = slow_classes(rows, 5, num, den)
    assert collected(ngram_join.components_of(frame(rows), 5, num, den), "doc_id", "n_shingles", "component_id") == want
    for n in (8, 20, 60, 200, 700, 3000):
        base = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        kept = base[: -(-n * num // den)]
        for a, b in ((base, kept), (base, np.sort(np.concatenate([kept, base[:0]])))):
            assert set(ngram_join.second_keys(a, num, den)) & set(ngram_join.second_keys(b, num, den))
            assert set(ngram_join.part_keys(a, num, den)) & set(ngram_join.part_keys(b, num, den))
