"""Spelling variants: every word's neighbours at one edit, found by probing generated edits.

Words are runs of letters (A-Z, a-z and U+00C0 to U+00FF) with A-Z in small letters. They are counted per slice of
the texts and by word. Frequent enough words of enough letters are the vocabulary.

Two words are near if one inserted, deleted or replaced letter makes one of the other. The pair is looked for from
one side only: from the longer word, by deleting each letter, and of two words of one length from the one
with the smaller letter in the place where they differ, by putting in each greater letter that words of this length
have. The edits are not written out as words: their hashes are sums over (letter, place), so each costs one addition.
They are probed against blocked Bloom filters, sharded by word length and by hash range. Shards have a bounded
number of words. They are broadcast in rounds of at most ROUND_BYTES, so what an executor holds does not grow with the
vocabulary; the rounds do. Only edits that pass are written out and shuffled, to an exact join with the vocabulary
that removes false positives.

A word's form is its near word of the greatest count, if that is at least ``ratio`` times its own; the root
follows forms to the last. Counts grow by that ratio with every step, so chains are short and have no cycles.

A null or empty text has no words. A null doc_id is an empty one where the id takes part. Rows that repeat an id or a
text count as often as they come. Equal counts go to the smaller word in code-point order. Very long texts
are cut between words, and a very long run is one word. An empty table gives no rows. Columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices
from millrace.llm.shingles import mix
from millrace.session import materialise

LETTERS = 7
COUNT = 2
RATIO = 10
#: Bytes of text worked on at a time; longer texts are cut between words.
PIECE = 2_000_000
#: Words in a shard of a filter, and 64-bit blocks for each table of a full shard: 16 bits a word.
SHARD_WORDS = 4096
SHARD_BLOCKS = SHARD_WORDS // 4
#: Bytes of filters broadcast at a time.
ROUND_BYTES = 32 << 20
#: Bits that a word sets in its block, and edits probed at a time.
_BITS = 5
_STEP = 1 << 17

_random = np.random.default_rng(31)
_LETTER = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_random.integers(1, 1 << 62)) * 2 + 1
_MASKS = np.array(
    [np.bitwise_or.reduce(np.uint64(1) << _random.choice(64, _BITS, replace=False).astype(np.uint64)) for _ in range(4096)], dtype=np.uint64
)
_OTHER = np.uint64(0x9E3779B97F4A7C15)
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF in UTF-8, and of nothing else
_starts = np.zeros(256, dtype=bool)
_starts[[*range(ord("a"), ord("z") + 1), _LEAD]] = True


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, code points) of the maximal runs of letters in lower-cased UTF-8 bytes."""
    letter, lead = _starts[data], data == _LEAD
    letter[1:] |= lead[:-1]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    leads = np.concatenate([[0], np.cumsum(lead, dtype=np.int32)])
    return start, end, end - start - (leads[end] - leads[start])


@cache
def _after(n: int) -> np.ndarray:
    """What n more bytes make of each bit of a CRC-32: the columns of a matrix over bits."""
    if n == 1:
        # Of one byte 0, less what it makes of nothing.
        return np.array([zlib.crc32(b"\0", 1 << i) ^ zlib.crc32(b"\0", 0) for i in range(32)], dtype=np.uint32)
    half = _after(n // 2)
    whole = _times(half, half)
    return _times(_after(1), whole) if n % 2 else whole


def _times(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for i in range(32):
        out ^= np.where(values >> np.uint32(i) & np.uint32(1), matrix[i], np.uint32(0))
    return out


def crc_joined(first: np.ndarray, second: np.ndarray, length: int) -> np.ndarray:
    """CRC-32 of two strings in a row, from theirs and the second one's length."""
    return _times(_after(length), first) ^ second


def _pieces(texts: Sequence[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(text number, bytes) in lists of about PIECE bytes; long texts are cut at a byte that no run holds."""
    held, size = [], 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = at + PIECE
            while end < len(text) and (_starts[text[end]] or text[end - 1] == _LEAD):
                end += 1
            held.append((number, text[at:end]))
            size += len(held[-1][1])
            at = end
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _counted(pieces: list[tuple[int, bytes]], prefixes: np.ndarray, letters: int, every: int) -> tuple[list[str], list[int]]:
    """The words of some pieces with their counts, changed where the hash of document and word says so."""
    joined = b"\n".join(p for _, p in pieces)
    data = np.frombuffer(joined, np.uint8)
    start, end, points = runs(data)
    kept = points >= letters
    start, end, points = start[kept], end[kept], points[kept]
    if not len(start):
        return [], []
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[start] += 1
    inside[end] -= 1
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)])])
    coded = tokens.dictionary_encode()
    words, of = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    crcs = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
    first = np.cumsum([0] + [len(p) + 1 for _, p in pieces[:-1]])
    owner = prefixes[[n for n, _ in pieces]][np.searchsorted(first, start, side="right") - 1]
    hashes = np.empty(len(start), dtype=np.uint32)
    for size in np.unique(sizes):
        some = sizes == size
        # A document's prefix is carried over this many bytes once.
        docs, back = np.unique(owner[some], return_inverse=True)
        hashes[some] = crc_joined(docs, np.uint32(0), int(size))[back] ^ crcs[of[some]]
    hit = hashes % np.uint32(every) == 0
    counts = np.bincount(of[~hit], minlength=len(words))
    names = [words[i].decode() for i in np.flatnonzero(counts)]
    numbers = counts[counts > 0].tolist()
    if hit.any():
        changed, times = np.unique(np.stack([of[hit], hashes[hit] % points[hit]], axis=1), axis=0, return_counts=True)
        for (i, at), n in zip(changed.tolist(), times.tolist(), strict=True):
            word = words[i].decode()
            if len(word) > letters:
                names.append(word[:at] + word[at + 1 :])
                numbers.append(n)
    return names, numbers


def vocabulary(docs: DataFrame, letters: int = LETTERS, count: int = COUNT, every: int = 31) -> DataFrame:
    """(word, n, length) of the words of at least ``letters`` letters that occur ``count`` times.

    In a document, a run whose CRC-32 after the document's id is divisible by ``every`` loses one letter, as told
    by the same number: a stand-in for slips of the pen that the same corpus always gives again.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")

    def run(batches):
        for batch in slices(batches, size=PIECE):
            prefixes = np.array([zlib.crc32(f"{d}:".encode()) for d in batch["id"].to_pylist()], dtype=np.uint32)
            for pieces in _pieces([t.lower() for t in batch["text"].to_pylist()]):
                words, counts = _counted(pieces, prefixes, letters, every)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= count).withColumn("length", F.length("word"))


def _powers(n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(_BASE, len(out), 1 << 64))])
    return out[:n]


def codes(words: Sequence[str]) -> np.ndarray:
    """Letters of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    return (_LETTER[letters] * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)


def shape(words: int) -> tuple[int, int]:
    """(shards, blocks of a shard) for so many words of one length."""
    shards = -(-words // SHARD_WORDS)
    return shards, SHARD_BLOCKS if shards > 1 else 1 << max(0, (-(-words // 4) - 1).bit_length())


def places(hashes: np.ndarray, shards: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(block, mask) in the first table of a filter and in the second, both in the same shard."""
    x = mix(hashes)
    block = (x >> np.uint64(32)) * np.uint64(shards * blocks) >> np.uint64(32)
    y = mix(x ^ _OTHER)
    other = block // np.uint64(blocks) * np.uint64(blocks) + (y >> np.uint64(20)) % np.uint64(blocks)
    return block, _MASKS[x & np.uint64(4095)], other, _MASKS[y & np.uint64(4095)]


def filters(words: DataFrame, shapes: dict[int, tuple[int, int]]) -> DataFrame:
    """(length, shard, letters, tables): a shard's two tables of blocks in a row, and the letters of its words."""

    def located(batches):
        for batch in batches:
            lengths, found = batch["length"].to_numpy(), np.empty(batch.num_rows, dtype=np.int64)
            every = batch["word"].to_pylist()
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                shards, blocks = shapes[int(length)]
                found[at] = (places(word_hashes(codes([every[i] for i in at])), shards, blocks)[0] // np.uint64(blocks)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch["length"], pa.array(found), batch["word"]], ["length", "shard", "word"])

    def built(batches):
        now, held = None, []

        def made():
            shards, blocks = shapes[now[0]]
            tables, letters = np.zeros((2, blocks), dtype=np.uint64), codes(held)
            first, mask, second, other = places(word_hashes(letters), shards, blocks)
            np.bitwise_or.at(tables[0], first % np.uint64(blocks), mask)
            np.bitwise_or.at(tables[1], second % np.uint64(blocks), other)
            row = {"length": now[0], "shard": now[1], "letters": np.unique(letters).tobytes(), "tables": tables.tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("length", pa.int32()), ("shard", pa.int64()), ("letters", pa.binary()), ("tables", pa.binary())]))

        for batch in batches:
            for key in zip(*[batch[c].to_pylist() for c in ("length", "shard", "word")], strict=True):
                if key[:2] != now:
                    if held:
                        yield made()
                    now, held = key[:2], []
                held.append(key[2])
        if held:
            yield made()

    dealt = words.select("length", "word").mapInArrow(located, "length int, shard long, word string")
    dealt = dealt.repartition("length", "shard").sortWithinPartitions("length", "shard")
    return dealt.mapInArrow(built, "length int, shard long, letters binary, tables binary")


class Filter:
    """Shards of one length that follow each other."""

    def __init__(self, shards: int, blocks: int, letters: bytes, first: int, tables: np.ndarray):
        self.shards, self.blocks, self.letters = shards, blocks, letters
        self.low, self.high = first * blocks, (first + len(tables)) * blocks
        self.first, self.second = (np.ascontiguousarray(tables[:, i]).ravel() for i in (0, 1))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of those hashes that may be of words of these shards."""
        block, mask, other, more = places(hashes, self.shards, self.blocks)
        here = np.flatnonzero((block >= self.low) & (block < self.high))
        here = here[self.first[block[here].astype(np.int64) - self.low] & mask[here] == mask[here]]
        return here[self.second[other[here].astype(np.int64) - self.low] & more[here] == more[here]]


def edits(letters: np.ndarray, filter_of: Callable[[int], Filter | None]) -> Iterator[tuple[int, int, int]]:
    """(row, place, letter) of edits of words of one length that pass a filter; letter -1 deletes."""
    count, length = letters.shape
    powers = _powers(length)
    values = _LETTER[letters]
    there = values * powers
    shorter, same = filter_of(length - 1), filter_of(length)
    if shorter is not None:
        # Of equal letters in a row only the last is deleted, so every result comes once.
        last = np.ones(letters.shape, dtype=bool)
        last[:, :-1] = letters[:, :-1] != letters[:, 1:]
        before = np.cumsum(there, axis=1, dtype=np.uint64) - there
        moved = np.zeros_like(there)
        moved[:, 1:] = values[:, 1:] * powers[:-1]
        after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        hashes, at = (before + after)[last], np.flatnonzero(last)
        for i in shorter.has(hashes):
            yield int(at[i]) // length, int(at[i]) % length, -1
    if same is not None:
        rest = (there.sum(axis=1, dtype=np.uint64)[:, None] - there).ravel()
        power, flat = np.tile(powers, count), letters.ravel()
        for letter in same.letters:
            for low in range(0, len(flat), _STEP):
                at = low + np.flatnonzero(flat[low : low + _STEP] < letter)
                for i in same.has(rest[at] + _LETTER[letter] * power[at]):
                    yield int(at[i]) // length, int(at[i]) % length, letter


def _rounds(built: DataFrame, shapes: dict[int, tuple[int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """(length, first shard, shards) of filters that together hold at most ROUND_BYTES."""
    held, size = [], 0
    for length in sorted(shapes):
        shards, blocks = shapes[length]
        first = 0
        while first < shards:
            room = max(0, ROUND_BYTES - size) // (16 * blocks)
            if not room:
                yield held
                held, size = [], 0
                continue
            some = min(room, shards - first)
            held.append((length, first, some))
            size += some * 16 * blocks
            first += some
    if held:
        yield held


def candidates(words: DataFrame) -> Iterator[DataFrame]:
    """(word, n, near) in rounds: edits of stored vocabulary words that pass the filters."""
    spark = words.sparkSession
    # One row for each word length.
    shapes = {r["length"]: shape(r["count"]) for r in words.groupBy("length").count().collect()}
    built = materialise(filters(words, shapes), "filters")
    for some in _rounds(built, shapes):
        wanted = F.lit(False)
        for length, first, shards in some:
            wanted = wanted | ((F.col("length") == length) & F.col("shard").between(first, first + shards - 1))
        # At most ROUND_BYTES, and as many rows as shards.
        tables: dict[int, list] = {length: [] for length, *_ in some}
        for row in built.where(wanted).collect():
            tables[row["length"]].append((row["shard"], bytes(row["letters"]), bytes(row["tables"])))
        known = {}
        for length, first, shards in some:
            blocks = shapes[length][1]
            whole = np.zeros((shards, 2, blocks), dtype=np.uint64)
            for shard, _, raw in tables[length]:
                whole[shard - first] = np.frombuffer(raw, np.uint64).reshape(2, blocks)
            letters = bytes(sorted(set(b"".join(found for _, found, _ in tables[length]))))
            known[length] = (*shapes[length], letters, first, whole)
        sent = spark.sparkContext.broadcast(known)

        def run(batches, sent=sent):
            ready: dict[int, Filter] = {}

            def filter_of(length: int) -> Filter | None:
                if length not in ready and length in sent.value:
                    ready[length] = Filter(*sent.value[length])
                return ready.get(length)

            for batch in batches:
                every, numbers, lengths = batch["word"].to_pylist(), batch["n"].to_pylist(), batch["length"].to_numpy()
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    step = max(1, _STEP // int(length))
                    for low in range(0, len(at), step):
                        own = [every[i] for i in at[low : low + step]]
                        out = [
                            (own[row], numbers[at[low + row]], own[row][:place] + (chr(letter) if letter >= 0 else "") + own[row][place + 1 :])
                            for row, place, letter in edits(codes(own), filter_of)
                        ]
                        columns = zip(*out, strict=True) if out else ((), (), ())
                        kinds = (pa.string(), pa.int64(), pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n", "near"])

        lengths = sorted({x for length, *_ in some for x in (length, length + 1)})
        probing = words.where(F.col("length").isin(lengths)).repartition("word").sortWithinPartitions("length")
        yield probing.mapInArrow(run, "word string, n long, near string")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every near pair of a stored vocabulary, both ways, stored."""
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = [materialise(some.join(exact, "near").select("word", "n", "near", "near_n"), "near") for some in candidates(words)]
    if not found:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    one_way = found[0]
    for more in found[1:]:
        one_way = one_way.unionByName(more)
    other_way = one_way.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return one_way.unionByName(other_way)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to their ends, twice as far in each round."""
    up = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = materialise(up.join(further, "root", "left").select("word", "root", "next"), "roots")
        if not joined.where("next IS NOT NULL").head(1):
            return up
        up = joined.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, letters: int = LETTERS, count: int = COUNT, ratio: int = RATIO, every: int = 31) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every vocabulary word."""
    words = materialise(vocabulary(docs, letters, count, every), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words).groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best)
    strong = -F.col("best.less") >= ratio * F.col("n")
    near = materialise(near.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")), "neighbours")
    ends = roots(near.where("form IS NOT NULL"))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
