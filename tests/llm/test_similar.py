"""Fingerprints, set joins, languages and top-k against plain readings."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language, minhash, ngram_join, similar_sets, topk
from millrace.llm.queries import QUERIES
from millrace.llm.shingles import shingles
from millrace.session import materialise

from .conftest import collected, passage


def words_of(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", small)


def set_of(text, size):
    w = words_of(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def slow_classes(rows, size, num, den):
    sets = [set_of(t, size) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if rows[i][0] is None or rows[j][0] is None:
                continue
            if same_id and sets[i] and sets[j] or both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                at[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = doc if doc is None else min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def variants(n, words, edits, seed, first):
    """``n`` texts that differ from one passage in up to ``edits`` places."""
    r, base, out = random.Random(seed), passage(words, 3, seed).split(), []
    for i in range(n):
        text = list(base)
        for _ in range(r.randrange(edits + 1)):
            text[r.randrange(words)] = f"edit{r.randrange(10**6)}"
        out.append((first + i, " ".join(text)))
    return out


CASES = [
    *[(i, passage(30, 1, i // 3)) for i in range(9)], *variants(60, 120, 3, 1, 100), *variants(40, 400, 20, 2, 200), *variants(20, 12, 1, 3, 300),
    (400, None), (401, ""), (402, " \n"), (403, "A b"), (404, "a B"), (405, "a"), (406, "a b c"), (407, "a b c a b c"), (None, "a b c"), (None, None),
    (408, "X " * 5000), (409, "x " * 7000),
]


def test_components_of_cases(frame):
    assert collected(ngram_join.components_of(frame(CASES)), "doc_id", "n_shingles", "component_id") == slow_classes(CASES, 3, 9, 10)


def test_small_blocks_lose_no_link(frame, monkeypatch):
    monkeypatch.setattr(similar_sets, "BLOCK_SETS", 7)
    rows = [*variants(60, 120, 3, 1, 100), *variants(50, 60, 8, 4, 300), *[(500 + i, passage(100 + i, 3, 1)) for i in range(40)]]
    assert collected(ngram_join.components_of(frame(rows)), "doc_id", "n_shingles", "component_id") == slow_classes(rows, 3, 9, 10)


def test_repeated_ids_are_one_document(frame):
    rows = [(1, passage(50)), (1, passage(50)), (2, passage(50)), (3, passage(40, 3)), (4, passage(40, 3)), (3, passage(40, 7)), (5, passage(40, 7))]
    assert collected(ngram_join.components_of(frame(rows)), "doc_id", "component_id") == [(1, 1), (1, 1), (2, 1), (3, 3), (3, 3), (4, 3), (5, 3)]


def test_no_documents(frame):
    assert ngram_join.components_of(frame([])).collect() == []
    assert minhash.near_duplicates(frame([])).collect() == []
    assert minhash.fingerprints_with_next(frame([])).collect() == []


@pytest.mark.parametrize("size", [1, 9, 10, 25, 60, 300])
def test_linked_sets_share_a_list(size):
    r = np.random.default_rng(size)
    for _ in range(300):
        a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
        cut = r.integers(0, max(1, size // 10) + 1)
        b = np.unique(np.concatenate([a[cut:], r.integers(0, 1 << 63, r.integers(0, max(1, size // 10) + 1), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 10 * both >= 9 * (len(a) + len(b) - both):
            assert len(np.intersect1d(ngram_join.part_keys(a, 9, 10), ngram_join.part_keys(b, 9, 10)))


def test_overlaps():
    r = np.random.default_rng(0)
    base = r.integers(0, 1 << 62, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[k % 9 :], r.integers(0, 1 << 62, k, dtype=np.uint64)])) for k in range(30)]
    got = similar_sets.overlaps(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(30) for j in range(30) if i != j)


def test_shingles():
    assert [len(shingles(t, 3)) for t in ("the quick brown fox", "a b", "a", " \n ", "")] == [2, 1, 1, 0, 0]
    assert (shingles("A b\tC", 3) == shingles(" a B  c\n", 3)).all() and shingles("É b c", 3) != shingles("é b c", 3)
    assert shingles("ab c", 3) != shingles("a bc", 3)


def test_fingerprint_query(spark, sf_dir, rows):
    rows = sorted(rows)
    got = {r["doc_id"]: r for r in QUERIES["op5_minhash"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    slots = {d: minhash.fingerprint(t or "") for d, t, *_ in rows}
    for (doc, text, *_), (after, following, *_) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, following, r = text or "", following or "", got[doc]
        new = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r["fingerprint"] == slots[doc].astype(">u2").tobytes().hex()
        assert r["edited_fingerprint"] == minhash.fingerprint(new).astype(">u2").tobytes().hex()
        assert r["near_next"] == (slots[doc] == slots[after]).mean()
        assert abs(r["near_edited"] - jaccard(text, new)) < 0.25


def jaccard(a, b, size=5):
    a, b = set_of(a, size), set_of(b, size)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_estimate_jaccard(rows):
    errors = []
    for doc, text in variants(60, 200, 25, 9, 0):
        a, b = passage(200, 3, 9), text
        errors.append(minhash.likeness(minhash.fingerprint(a), minhash.fingerprint(b)) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.2


def test_fingerprint_cases(frame):
    rows = [(3, "c"), (1, None), (2, ""), (3, "c"), (None, "é" * 9), (7, "long " * 20_000)]
    got = {(r["doc_id"], r["n_chars"]): r for r in minhash.fingerprints_with_next(frame(rows)).collect()}
    assert len(minhash.fingerprints_with_next(frame(rows)).collect()) == 6
    assert got[1, 0]["near_next"] == 1.0 and got[2, 0]["near_next"] == 0.0 and got[3, 1]["near_next"] in (0.0, 1.0)
    assert got[7, 100_000]["edited_sha256"] == hashlib.sha256(("long " * 10_000 + "é" * 9).encode()).hexdigest()
    alone = minhash.fingerprints_with_next(frame([(4, "a b c d")])).collect()
    assert [(r["near_next"], r["n_chars"]) for r in alone] == [(1.0, 7)]


def test_near_duplicates(frame):
    rows = [*variants(30, 200, 4, 5, 0), *variants(25, 200, 4, 6, 100), *[(200 + i, passage(60, 7, i * 11)) for i in range(10)], (300, None), (301, "")]
    want = [(d, c) for d, _, c in slow_classes(rows, 5, 8, 10)]
    assert collected(minhash.near_duplicates(frame(rows)), "doc_id", "class_id") == want


def test_language_query(spark, sf_dir, rows):
    got = {r["doc_id"]: r for r in QUERIES["op6_language"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    held = [(d, lang) for d, _, lang, *_ in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, r in got.items() if r["held_out"]} == {d for d, _ in held}
    assert np.mean([got[d]["lang_pred"] == lang for d, lang in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_cases(spark, frame):
    learn = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "fr"), (4, "no label", None), (5, "", "es")]
    profiles = language.train(frame(learn))
    assert profiles.languages == ("de", "en", "es")
    asked = [(1, "the dog"), (2, "die katze"), (3, None), (4, ""), (5, "12 — ²½"), (6, "漢字"), (7, "the " * 50_000), (7, "und der")]
    made = frame(asked)
    got = dict(collected(made.select(F.monotonically_increasing_id().alias("n"), language.predict(profiles, F.col("text")).alias("f")).select("n", "f.lang"), "n", "lang"))
    by_row = [got[k] for k in sorted(got)]
    assert by_row[:5] == ["en", "de", "und", "und", "und"] and by_row[5] in profiles.languages and by_row[6:] == ["en", "de"]
    none = language.train(frame([]))
    assert none.languages == () and language.guess("some text", none) == ("und", 0.0, True)
    one = language.train(frame([(1, "only one", "xx")]))
    assert language.guess("only this", one)[0] == "xx"


def slow_topk(rows, k, asks):
    usable = []
    for vec, v in rows:
        if vec is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((vec, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for q, a in usable:
        if asks(q):
            best = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), c) for c, b in usable if c != q)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best)]
    return sorted(out)


def test_topk_cases(spark, monkeypatch):
    r = np.random.default_rng(5)
    centres = r.normal(size=(4, 16))
    rows = [(i, (centres[i % 4] + 0.2 * r.normal(size=16)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(20)] + [(2000 + i, [0.0] * 16) for i in range(5)] + [(2100, [-1.0] * 16)]
    rows += [(3000, None), (3001, [None] + [0.5] * 15), (3002, [float("nan")] * 16), (3003, [float("inf")] * 16), (None, [1.0] * 16), (3050, [0.5, 0.25])]
    df = spark.createDataFrame([(v, e, 1, "x") for v, e in rows], "vec_id long, embedding array<float>, block int, score string")
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 5)
    got = topk.search(df, F.col("vec_id") % 50 == 0, 5)
    assert sorted(tuple(x) for x in got.collect()) == slow_topk(rows, 5, lambda q: q % 50 == 0)


def test_topk_sends_no_queries_through_the_driver(spark, monkeypatch):
    """Vectors that Spark's files hold in few bytes: by their estimate the queries of all blocks look fit for a broadcast."""
    df = spark.range(6000).select(F.col("id").alias("vec_id"), F.array([(F.col("id") % 3 + i).cast("float") for i in range(8)]).alias("embedding"))
    monkeypatch.setattr(topk, "BLOCK_ROWS", 500)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 10)
    got = topk.search(df, F.col("vec_id") % 50 == 0, 2)
    assert got.count() == 240
    assert {r["vec_id"] for r in got.where("query_id = 100").collect()} == {2, 5}
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "MapInArrow" in plan and "Broadcast" not in plan


def test_topk_with_few_rows(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return sorted(tuple(x) for x in topk.search(df, F.col("vec_id") % 50 == 0, 5).collect())

    assert run([]) == [] and run([(0, [1.0])]) == []
    assert run([(0, [1.0]), (1, [0.5]), (2, [0.5])]) == [(0, 1, 1, 256 * 128), (0, 2, 2, 256 * 128)]
    assert run([(50, [-0.001, 3.0]), (7, [])]) == [(50, 1, 7, 0)]


def test_search_stops_early_and_stays_exact():
    r = np.random.default_rng(8)
    base = r.normal(size=(20, 32))
    vectors = np.floor(256 * np.concatenate([base[i % 20][None] + 0.1 * r.normal(size=(1, 32)) for i in range(2000)])).astype(np.int64)
    block = topk.Block(np.arange(2000), vectors)
    for q in range(0, 200, 13):
        scores = vectors @ vectors[q]
        scores[q] = scores.min() - 1
        want = sorted(range(2000), key=lambda i: (-scores[i], i))[:5]
        assert block.search(vectors[q], q, 5) == [(i, int(scores[i])) for i in want]
    assert block.walked < 0.9 * block.postings and block.scored < 0.05 * block.rows


def test_walks_of_the_test_table_decide_by_proof(spark):
    """On vectors without any structure most rows are ruled out by the walk, and few are scored exactly."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.floor(256 * np.array([r["embedding"] for r in rows], dtype=np.float64)).astype(np.int64)
    block = topk.Block(ids, vectors)
    for q in np.flatnonzero(ids % 50 == 0):
        scores = np.where(ids == ids[q], -(10**9), vectors @ vectors[q])
        want = np.lexsort((ids, -scores))[:5]
        assert block.search(vectors[q], int(ids[q]), 5) == [(int(ids[i]), int(scores[i])) for i in want]
    assert block.walked < 0.8 * block.postings and block.scored < 0.05 * block.rows


def test_near_duplicates_against_brute_force_at_size(spark):
    """Of all pairs of the test table at five words and 0.8, every one shares a class; no class joins documents that no
    chain of such pairs joins."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r["doc_id"]: set_of(r["text"], 5) for r in table.collect()}
    holders, pairs = {}, set()
    for doc, shingle_set in sets.items():
        for s in shingle_set:
            holders.setdefault(s, []).append(doc)
    shared = {}
    for docs in holders.values():
        for i, a in enumerate(docs):
            for b in docs[:i]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if 10 * n >= 8 * (len(sets[a]) + len(sets[b]) - n):
            pairs.add((a, b))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(table).collect()}
    assert len(pairs) > 100 and all(got[a] == got[b] for a, b in pairs)
    at = {d: d for d in sets}

    def root(d):
        while at[d] != d:
            d = at[d]
        return d

    for a, b in pairs:
        at[max(root(a), root(b))] = min(root(a), root(b))
    assert {d: root(d) for d in sets} == got


def test_near_copies_are_tied_by_about_one_pair_a_row(spark, frame):
    """Each row was tied to the first of every list it stands in: very many for copies with different edits."""
    r, base = np.random.default_rng(3), passage(300).split()
    rows = [(n, " ".join(f"edit{n}x{at}" if at in cut else w for at, w in enumerate(base))) for n in range(400) for cut in [set(r.integers(0, 300, 2).tolist())]]
    docs = frame(rows).repartition(4)
    ties = ngram_join.ties(materialise(ngram_join.index(docs, 5, 8, 10), "indexed"))
    assert ties.distinct().count() <= 400 + 4 * 4
    found = dict(collected(ngram_join.components_of(docs, 5, 8, 10), "doc_id", "component_id"))
    assert found == {doc: component for doc, _, component in slow_classes(rows, 5, 8, 10)}


def test_two_blocks_tell_only_what_they_join():
    """Every cell of a block gave back a pair for each of its sets, whatever their own cell had connected."""
    same = np.arange(100, dtype=np.uint64)
    ids, block = list(range(10, 50)), [n % 2 for n in range(40)]
    sets = [same] * 38 + [same + np.uint64(1000)] * 2
    own = [similar_sets.links_of([i for i, b in zip(ids, block, strict=True) if b == k], sets[k::2], 9, 10) for k in (0, 1)]
    across = similar_sets.links_of(ids, sets, 9, 10, block)
    assert sorted(across) == [(10, 11), (48, 49)]
    assert sorted(set(similar_sets.firsts(50, *np.array([*own[0], *own[1], *across]).T)[10:].tolist())) == [10, 48]
    assert similar_sets.links_of(ids, sets, 9, 10, [1] * 40) == similar_sets.links_of(ids, sets, 9, 10)
