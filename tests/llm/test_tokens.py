"""Token ids, the directly addressable store and packing, against the library and plain readings."""

import random
import zlib

import numpy as np
import pytest

from millrace.llm import packing, token_store, tokens
from millrace.llm.queries import QUERIES

from .conftest import collected, passage

ODD = [
    "áb é ́x  '̸= ≠ <|endoftext|>x<|startoftext|> it's I'M don't\x1c\x1da b c \tq\r\n 123abc १२ ΣΑΣ İstanbul ǅ ﬁ 한국 👩‍👩‍👧",
    "", " ", "\n\n", "x" * 30_000, "It'S Ω Å ªº µ ß. ŉ ǆ Ǆ word... a.b, ©® naïve, ﬀ Straße! ÀÉ?", "<|EndOfText|>", "ΑΣ. ΣΣ K K",
]


def ids_of(texts, path=None):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path or tokens.default_path()).encode_batch(list(texts), add_special_tokens=False)
    return [list(f.ids) for f in found]


def random_texts(n):
    r = random.Random(1)
    pool = [chr(c) for c in [*range(32, 127)] * 3 + [9, 10, 13, 0x1C, 0x85, 0xA0, 0xAD] + [*range(0xC0, 0x250)]]
    pool += [chr(c) for c in (0x300, 0x301, 0x130, 0x131, 0x3A3, 0x3C2, 0x212A, 0x2126, 0x1E9E, 0xFB01, 0x4E00, 0x1F600)] + ["'s", "'ll", " .", "<|"]
    return ["".join(r.choice(pool) for _ in range(r.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(name, rows):
    import public_tokenizers

    path = public_tokenizers.path(name)
    texts = [*ODD, *random_texts(3000), *[t for _, t, *_ in rows]]
    got = [np.frombuffer(b, "<u4").tolist() for b in tokens.encoder(path)(texts)]
    assert got == ids_of(texts, path)


def test_ids_do_not_depend_on_the_store(rows, monkeypatch):
    texts = [t for _, t, *_ in rows][:40]
    monkeypatch.setattr(tokens, "KEPT", 10)
    small = tokens.Encoder(tokens.default_path())
    assert [small([t])[0] for t in texts] == tokens.encoder(tokens.default_path())(texts)


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_levels_give_every_id_back():
    r = np.random.default_rng(3)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = r.integers(0, [1 << 7, 1 << 16, 1 << 24, 1 << 32][n % 4], n, dtype=np.uint32)
        levels = token_store.encode_levels(ids)
        assert (token_store.read_all(levels) == ids).all()
        places = r.integers(0, n, 300) if n else np.zeros(0, np.int64)
        assert (token_store.read_ids(levels, places) == ids[places]).all()


def test_store_query(spark, sf_dir, rows):
    want, start = {}, 0
    for (doc, *_), ids in zip(sorted(rows), ids_of([t or "" for _, t, *_ in sorted(rows)]), strict=True):
        want[doc] = (start, len(ids) + 1, crc([*ids, 1]))
        start += len(ids) + 1
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op2_token_store"](spark, sf_dir).collect()}
    assert got == want


def test_store_cases_and_single_tokens(spark, frame, tmp_path):
    rows = [(5, passage(50)), (2, None), (9, ""), (5, passage(50)), (5, "other"), (None, "first"), (7, passage(3000))]
    path = str(tmp_path / "store")
    token_store.write(frame(rows), path, segment_ids=100)
    docs = sorted(token_store.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in docs] == [None, 2, 5, 5, 5, 7, 9]
    flat = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in docs])
    assert [r["start"] for r in docs] == [0, *np.cumsum([r["n_tokens"] for r in docs])[:-1]]
    texts = {None: ["first"], 2: [""], 9: [""], 7: [passage(3000)], 5: [passage(50), passage(50), "other"]}
    for doc in texts:
        got = sorted(np.frombuffer(r["ids"], "<u4").tolist() for r in docs if r["doc_id"] == doc)
        assert got == sorted([*i, 1] for i in ids_of(texts[doc]))
    asked = [(p,) for p in [*range(0, len(flat), 7), 3, 3, len(flat), -1, None]]
    found = collected(token_store.read_tokens(spark, path, spark.createDataFrame(asked, "place long"), stride=64), "place", "id")
    assert found == sorted(((p, int(flat[p])) for (p,) in asked if p is not None and 0 <= p < len(flat)), key=repr)


def test_empty_store(spark, frame, tmp_path):
    token_store.write(frame([]), str(tmp_path / "store"))
    assert token_store.read_documents(spark, str(tmp_path / "store")).collect() == []


def check_pieces(pieces, texts, window=4096):
    by_doc, total = {}, 0
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    for doc, text in texts.items():
        ids = [*ids_of([text or ""])[0], 2]
        own = sorted(by_doc[doc], key=lambda p: p["start"])
        assert [p["doc_tokens"] for p in own] == [len(ids)] * len(own)
        assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in own]).tolist() == ids
        assert [p["start"] for p in own] == [0, *np.cumsum([p["length"] for p in own])[:-1]]
        assert all(p["length"] & (p["length"] - 1) == 0 and p["length"] <= window and p["offset"] == 0 for p in own)
        total += len(own)
    numbers = sorted((p["sequence_id"], p["length"]) for p in pieces)
    assert [n for n, _ in numbers] == list(range(total)) and [x for _, x in numbers] == sorted((x for _, x in numbers), reverse=True)


def test_packing(spark, docs, rows):
    check_pieces(packing.pack(docs.repartition(5)).collect(), {d: t for d, t, *_ in rows})


def test_packing_query(spark, sf_dir, rows):
    got = QUERIES["op7_packing"](spark, sf_dir).collect()
    lengths = {d: len(i) + 1 for (d, *_), i in zip(rows, ids_of([t for _, t, *_ in rows]), strict=True)}
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == lengths and sum(r["length"] for r in got) == sum(lengths.values())


def test_packing_cases(spark, frame):
    texts = {1: None, 2: "", 3: passage(6000), None: "a", 4: "one two three"}
    check_pieces(packing.pack(frame(list(texts.items()))).collect(), texts)
    twice = packing.pack(frame([(1, "a b c"), (1, "a b c")]), window=2).collect()
    assert len(twice) == 4 and len({r["sequence_id"] for r in twice}) == 4
    assert packing.pack(frame([])).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4095, 4096, 4097, 12345])
def test_cut(n):
    pieces = packing.cut(n)
    assert sum(length for _, length in pieces) == n and [a for a, _ in pieces] == [0, *np.cumsum([x for _, x in pieces])[:-1]]
    assert len(pieces) == n // 4096 + bin(n % 4096).count("1")
