"""Spelling variants against a plain search for near words, and the filter audit against a plain run of each order."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import filter_audit, sketches, spelling
from millrace.llm.queries import QUERIES


def slow_variants(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 2}
    near, same = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            same[w[:i], w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in same.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


def shown(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=repr)


def test_spelling_query(spark, rows, sf_dir):
    want = slow_variants(rows)
    assert len(want) > 1000 and any(w[1] for w in want)
    assert shown(QUERIES["op11_spelling"](spark, sf_dir)) == want


def test_spelling_in_rounds_and_shards(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(spelling, "ROUND_BYTES", 16 * spelling.SHARD_BLOCKS)
    assert spelling.shape(10_000) == (3, spelling.SHARD_BLOCKS) and spelling.shape(1) == (1, 1)
    shapes = {7: (3, spelling.SHARD_BLOCKS), 9: (1, 4)}
    rounds = list(spelling._rounds(None, shapes))
    assert [sum(16 * shapes[w][1] * n for w, _, n in r) <= spelling.ROUND_BYTES for r in rounds] == [True] * len(rounds)
    assert sorted((w, f + i) for r in rounds for w, f, n in r for i in range(n)) == [(7, 0), (7, 1), (7, 2), (9, 0)]
    assert shown(spelling.variants(docs)) == slow_variants(rows)


def test_spelling_on_odd_rows(spark, frame, monkeypatch):
    common = "Gardening gardening GARDENING " * 20
    odd = [
        (1, None), (2, ""), (3, common), (3, common), (None, common), (4, "gardenin gardenin gardeniing gardeniing gardexing gardexing"),
        (5, "Éclairage Éclairage éclairage éclairage straßenbahn straßenbahn"), (6, "x" * 40_000 + " " + "x" * 40_000 + " " + "x" * 39_999 + "y " + "x" * 39_999 + "y"),
        (7, "łukaszéééé " * 3 + "ábcdefgh " * 3), (8, "1" * 50_000),
    ]
    assert shown(spelling.variants(frame(odd))) == slow_variants(odd)
    monkeypatch.setattr(spelling, "PIECE", 50)
    assert shown(spelling.variants(frame(odd))) == slow_variants(odd)
    assert spelling.variants(frame([])).collect() == []


def test_joined_crc():
    for a, b in ((b"", b"x"), (b"17:", b"stra\xc3\x9fe"), (b"123:", b"q" * 1000)):
        one, two = (np.array([zlib.crc32(x)], dtype=np.uint32) for x in (a, b))
        assert spelling.crc_joined(one, two, len(b))[0] == zlib.crc32(a + b)


def slow_audit(rows, labels):
    first, marks = {}, defaultdict(lambda: [0, 0])
    for doc, text, *_ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    for doc, quality, toxic in labels:
        marks[doc][0] |= quality == 1
        marks[doc][1] |= toxic == 1
    docs = []
    for doc, text, _, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc is not None and first[text] < doc,
        }
        good, toxic = marks[doc] if doc is not None else (0, 0)
        docs.append((source or "", {f for f, failed in fails.items() if failed}, good, toxic))
    out = []
    for part in {d[0] for d in docs}:
        own, found, shapley = [d for d in docs if d[0] == part], [], Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                redundant = sum(f in d[1] for d in own) - len(gone)
                found.append((part, "".join(order), step, len(left), len(gone), redundant, sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*x, shapley[x[1][x[2] - 1]]) for x in found]
    return sorted(out)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("broadcast", [True, False])
def test_audit_on_odd_rows(spark, frame, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(sketches, "BROADCAST_BYTES", 0)
    # Many segments, and tasks that hand on their counters more than once.
    monkeypatch.setattr(sketches, "COUNTERS_PER_ROW", 20_000)
    monkeypatch.setattr(sketches, "HELD_ROWS", 3)
    many = " ".join(f"w{i}" for i in range(250))
    odd = [
        (1, None, None, "a"), (2, "", None, None), (3, "", None, ""), (4, many, None, "a"), (4, many, None, "b"), (5, many, None, "b"), (None, many, None, "b"),
        (6, "SAME same " * 150, None, "a"), (7, "a|b", None, "a"), (8, many + " é", None, "a"), (9, "word " * 300_000, None, "a"), (None, None, None, None),
        (9, "word " * 300_000, None, "a"), (10, "\x1c".join(["u"] * 300), None, "c"),
    ]
    marks = [(1, 1, 0), (1, 0, 1), (5, 1, 1), (6, 0, 1), (None, 1, 1), (9, None, 1), (99, 1, 1)]
    labels = spark.createDataFrame([(*m, "x") for m in marks], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(frame(odd), labels)
    assert sorted(tuple(r[c] for c in AUDIT) for r in got.collect()) == slow_audit(odd, marks)
    assert filter_audit.audit(frame([]), labels).collect() == []
    assert filter_audit.audit(frame(odd), labels.limit(0)).where("good_lost + toxic_lost > 0").collect() == []


def test_sketch_clears_most_unique_texts(spark, docs):
    from millrace.session import materialise

    tested = filter_audit.with_repeats(materialise(filter_audit.masks(docs), "masks"))
    repeated = docs.groupBy("text").count().where("count > 1").agg({"count": "sum"}).first()[0] or 0
    flagged = tested.where("repeat").count()
    assert repeated <= flagged <= repeated + 0.1 * docs.count()


def test_only_known_keeps_every_partner(spark, monkeypatch):
    rows = spark.range(20_000).select((F.col("id") % 7_000).alias("doc_id"), F.lit("x").alias("segment"))
    keys = spark.range(0, 7_000, 50).select(F.col("id").alias("k"))
    for size in (sketches.BROADCAST_BYTES, 0):
        monkeypatch.setattr(sketches, "BROADCAST_BYTES", size)
        left = sketches.only_known(rows, keys, "doc_id", "k")
        assert left.columns == rows.columns
        exact = rows.where("doc_id % 50 = 0").count()
        assert left.where("doc_id % 50 = 0").count() == exact and exact <= left.count() < 1.2 * exact
        assert sketches.only_known(rows, keys.limit(0), "doc_id", "k").collect() == []
