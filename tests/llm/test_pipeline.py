"""The pipeline against a plain reading of its stages, and its behaviour on odd input."""

import hashlib
import os
from collections import Counter, defaultdict
from math import floor

from pyspark.sql import functions as F

import corpus_pipeline as P
from millrace.llm import secret_scan
from millrace.llm.queries import QUERIES

from .conftest import passage
from .test_rows import slow_targets
from .test_similar import slow_classes
from .test_tokens import check_pieces


def redacted(text):
    spans = sorted({(a, b) for _, a, b in secret_scan.find(text, secret_scan.RULES)})
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def slow_copies(rows):
    """Copies by (doc, source): sorted by size and hash within a source, taken where the running sum crosses."""
    by_source = defaultdict(list)
    for doc, text, source in rows:
        by_source[source].append((len(text.split()), hashlib.md5(f"1:{doc}".encode()).hexdigest(), doc))
    words = {s: sum(n for n, *_ in docs) for s, docs in by_source.items()}
    target, out = slow_targets(words), Counter()
    for source, docs in by_source.items():
        rate = target[source] / words[source] if words[source] else 0.0
        u = int(hashlib.md5(f"1:source:{source or ''}".encode()).hexdigest()[:5], 16) / 16**5
        for i, (_, _, doc) in enumerate(sorted(docs), 1):
            out[doc] += floor(rate * i + u) - floor(rate * (i - 1) + u)
    return out


def test_pipeline_equals_plain_reading(spark, docs, rows, sf_dir):
    known = [(d, t, s) for d, t, _, s, _ in rows if t and any(c.isalpha() for c in t)]
    kept = {d for d, _, c in slow_classes([(d, t) for d, t, _ in known], 5, 8, 10) if d == c}
    clean = [(d, redacted(t), s) for d, t, s in known if d in kept]
    copies = slow_copies(clean)
    frame, by_stage = docs, {}
    for name, stage in P.STAGES[:-1]:
        frame = stage(spark, frame, sf_dir)
        assert frame.columns == docs.columns
        frame = spark.createDataFrame(frame.collect(), docs.schema)
        by_stage[name] = [tuple(r) for r in frame.collect()]
    assert {r[0] for r in by_stage["language"]} == {d for d, *_ in known}
    assert {r[0] for r in by_stage["copies"]} == kept and len(by_stage["copies"]) == len(kept)
    assert {(r[0], r[1], r[4]) for r in by_stage["secrets"]} == {(d, t, len(t)) for d, t, _ in clean}
    assert Counter(r[0] for r in by_stage["mix"]) == +copies
    pieces = P.STAGES[-1][1](spark, frame, sf_dir).collect()
    once = {d: t for d, t, _ in clean if copies[d] == 1}
    assert sum(p["length"] for p in pieces) == sum(p["doc_tokens"] for p in pieces if p["start"] == 0)
    assert sorted(p["sequence_id"] for p in pieces) == list(range(len(pieces)))
    some = [p for p in pieces if p["doc_id"] in once]
    for place, p in enumerate(sorted(some, key=lambda p: p["sequence_id"])):
        some[some.index(p)] = {**p.asDict(), "sequence_id": place}
    check_pieces(some, once)


def test_run_equals_its_stages(spark, docs, sf_dir):
    frame = docs
    for _, stage in P.STAGES:
        frame = stage(spark, frame, sf_dir)
        if frame.columns == docs.columns:
            frame = spark.createDataFrame(frame.collect(), docs.schema)
    key = ("doc_id", "start", "length", "doc_tokens")
    got = Counter(tuple(r[k] for k in key) for r in P.run(spark, sf_dir).collect())
    assert got == Counter(tuple(r[k] for k in key) for r in frame.collect())


def test_stages_on_odd_rows(spark, frame, sf_dir):
    odd = [(1, None), (2, ""), (3, "12 34"), (4, passage(40), None, "a"), (5, passage(40), "en", "b"), (None, "some words here", "de", None), (6, passage(3000), "en", "a")]
    made = frame(odd)
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, made, sf_dir)
        assert got.columns == made.columns and got.count() >= 0, name
        empty = stage(spark, frame([]), sf_dir)
        assert empty.columns == made.columns and empty.collect() == [], name
    assert {r["doc_id"] for r in P.with_language(spark, made, sf_dir).collect()} == {4, 5, 6, None}
    assert {r["doc_id"] for r in P.without_copies(spark, made, sf_dir).collect()} == {1, 2, 3, 4, 6, None}
    assert P.packed(spark, frame([]), sf_dir).collect() == []


def test_language_stage_drops_only_texts_without_letters(spark, frame, sf_dir):
    unlabelled = frame([(1, "some words"), (2, "12 34"), (3, None), (4, "łódź")])
    assert {r["doc_id"] for r in P.with_language(spark, unlabelled, sf_dir).collect()} == {1, 4}
    called_und = frame([(1, "some words here", "und"), (2, "andere Wörter hier", "de"), (3, "more words here", "und"), (4, "--")])
    assert {r["doc_id"] for r in P.with_language(spark, called_und, sf_dir).collect()} == {1, 2, 3}


def test_clashing_columns_and_maps(spark, frame, sf_dir):
    """Columns called as the stages' own ones come out as they went in, and columns without a hash do no harm."""
    names = ["__row", "__hash", "__gone", "__kept", "__key", "__blob", "__spans", "__number", "__copies", "__copy", "__language", "__values", "__BLOCK_"]
    rows = [(1, passage(40), "en", "a"), (2, passage(40), "en", "a"), (3, "my password = hunter2222 here", "en", "b"), (3, "other words", None, "b")]
    made = frame(rows).withColumns({n: F.concat(F.lit(n), "doc_id") for n in names} | {"notes": F.create_map(F.lit("k"), "doc_id")})
    kept = {}
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, made, sf_dir)
        assert got.columns == made.columns
        kept[name] = got.collect()
        for r in kept[name]:
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names) and r["notes"] == {"k": r["doc_id"]}
    assert [len(kept[n]) for n in ("language", "copies", "secrets")] == [4, 3, 4]
    assert any("[secret]" in r["text"] for r in kept["secrets"])


def test_scratch_of_a_stage_goes_with_the_next(spark, frame, sf_dir):
    made = frame([(1, passage(40), "en", "a"), (2, passage(50, 3), "en", "b")])
    P.without_copies(spark, made, sf_dir).collect()
    own = list(P._own["without_copies"])
    assert own and all(os.path.exists(p) for p in own)
    P.without_secrets(spark, made, sf_dir).collect()
    assert not any(os.path.exists(p) for p in own)


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert [name for name, _ in P.STAGES] == ["language", "copies", "secrets", "mix", "packing"]
