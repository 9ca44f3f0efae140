"""Which documents share most of their word n-grams: an exact Jaccard join, linked into components.

Index lists are keyed by blocks of positions. The shingles of a set, in the order of their hashes, fall into
parts by hash, and a list holds the sets that agree in a whole part: everything that differs in a part is skipped
with it. Sets are indexed by size class, and also in the next class where a linked set could be that large.

Small sets have more parts than shingles in which two linked sets of that size can differ, so linked sets agree in
whole parts. Parts without shingles say little and have no list of their own; parts are so many that a set nearly
always fills more of them than linked sets can differ in. Two linked sets that both fill fewer meet by prefix: each is
also listed under as many of its first shingles as hold at least one that both have. Large sets can differ in very
many shingles, but these fall into parts at random: fewer parts, of which only those with several shingles have a
list, still leave linked sets without a shared list with a chance below MISSED only.

A task ties the sets it holds itself, each to the least one reached through its lists, and lists tell only that one
to other tasks. So a list never grows beyond the number of slices of the input, and a group of near copies, which share
very many lists, is tied by about one pair a row. Lists only tie sets into families; ``similar_sets`` compares whole sets. Passages that
many documents have can tie unlike sets. So a large family is tied again, by lists of large parts under several hash
functions, which linked sets share as surely and unlike ones hardly ever, and falls apart before sets are compared.

A document's set: distinct shingles of ``size`` words; the whole sequence as one if it has fewer; none without
words or text, which links with nothing. Other cases as in ``similar_sets``. An empty table gives no rows.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from functools import cache
from math import ceil, exp, factorial, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import similar_sets
from millrace.llm.common import map_arrow, texts
from millrace.llm.shingles import mix, shingles
from millrace.session import materialise

SIZE = 3
#: Ratio of the sizes at which a size class starts and ends.
CLASS_RATIO = 1.6
#: Parts filled beyond those that can differ, as expected: so many, and so many deviations of the empty ones.
SPARE_PARTS = 3
SPARE_DEVIATIONS = 2
#: The chance that two linked sets share no list is below this where parts are fewer than shingles that can differ.
MISSED = 1e-10
#: Shingles that a part holds at least to have a list, where linked sets share lists by chance: the most that will do.
LEAST_SHINGLES = (3, 2)
#: Shingles in which linked sets differ, as expected of a part, when a large family is tied again.
SECOND_DIFFER = 1.6
#: Lists for each shingle of a set, at most, when a family is tied again.
SECOND_MOST = 8


@cache
def class_starts() -> list[int]:
    """The least set size of every class."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * CLASS_RATIO)))
    return starts


def _limits(cls: int, num: int, den: int) -> tuple[int, int]:
    """In how many shingles linked sets of a class can differ, and how many they share at least."""
    start, most = class_starts()[cls], class_starts()[cls + 1] - 1
    return 2 * most * (den - num) // (den + num), -(-start * num // den)


def _shared(parts: int, differ: int, least: int, fewest: int) -> float:
    """Parts with enough shingles of both sets and none of one alone, as expected of the most unlike linked sets.

    Shingles fall into parts at random, and what parts hold is negatively associated: the chance that there is no
    such part is at most exp(-expected).
    """
    mean = least / parts
    few = sum(exp(-mean) * mean**k / factorial(k) for k in range(fewest))
    return parts * (1 - 1 / parts) ** differ * (1 - few)


@cache
def part_count(cls: int, num: int, den: int) -> tuple[int, int, int]:
    """In how many shingles linked sets of a class can differ, how many parts are made, and the least of a part.

    More parts than ``differ`` where the least is 1; else so many that sets share one but for a chance of MISSED.
    """
    differ, least = _limits(cls, num, den)
    fewest = differ + SPARE_PARTS
    # Sets of a few shingles need not fill enough of any number of parts; theirs stay the fewest.
    sure = fewest
    for parts in range(fewest, max(least, fewest + 1)):
        empty = parts * exp(-least / parts)
        if parts - empty - SPARE_DEVIATIONS * sqrt(empty) >= differ + 1:
            sure = parts
            break
    for fewest in LEAST_SHINGLES:
        enough = next((p for p in range(8, sure) if _shared(p, differ, least, fewest) >= -log(MISSED)), None)
        if enough is not None:
            return differ, enough, fewest
    return differ, sure, 1


@cache
def second_count(cls: int, num: int, den: int) -> tuple[int, int]:
    """(parts, hash functions) of the lists by which the sets of a large family are tied again."""
    differ, least = _limits(cls, num, den)
    parts = max(2, round(differ / SECOND_DIFFER))
    return parts, ceil(-log(MISSED) / max(_shared(parts, differ, least, LEAST_SHINGLES[0]), 1e-3))


def _classes(n: int, num: int, den: int) -> range:
    starts = class_starts()
    return range(bisect_right(starts, n) - 1, bisect_right(starts, n * den // num))


def _lists(tokens: np.ndarray, mixed: np.ndarray, parts: int, label: int, fewest: int) -> tuple[np.ndarray, int]:
    """Keys of the parts with at least ``fewest`` shingles, and how many parts have any."""
    part = (tokens >> np.uint64(20)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    filled, at, sizes = np.unique(part[order], return_index=True, return_counts=True)
    sums = np.add.reduceat(mixed[order], at)
    keys = mix(sums + mix(np.uint64(label) << np.uint64(40) | filled))
    return keys[sizes >= fewest], len(filled)


def part_keys(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the lists that a set (its ascending hashes) is in; equal sets have equal keys."""
    n, mixed = len(tokens), mix(tokens ^ np.uint64(0x9E3779B97F4A7C15))
    keys = [mix(mixed.sum(dtype=np.uint64, keepdims=True))]
    sparse = False
    for cls in _classes(n, num, den):
        differ, parts, fewest = part_count(cls, num, den)
        if not differ:
            continue  # linked sets of this size are equal, which the first key says
        found, filled = _lists(tokens, mixed, parts, cls, fewest)
        keys.append(found)
        sparse |= fewest == 1 and filled <= differ
    if sparse:
        keys.append(_prefix(tokens, num, den))
    return np.concatenate(keys)


def _prefix(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the first shingles: of linked sets, each has at least num / den of its shingles in the other."""
    return mix(tokens[: len(tokens) - -(-len(tokens) * num // den) + 1] ^ np.uint64(0xC2B2AE3D27D4EB4F))


def second_keys(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the lists that a set of a large family is in."""
    keys = [mix(mix(tokens).sum(dtype=np.uint64, keepdims=True))]
    for cls in _classes(len(tokens), num, den):
        if not _limits(cls, num, den)[0]:
            continue
        parts, functions = second_count(cls, num, den)
        if functions * parts > SECOND_MOST * len(tokens):
            # Sets so small that no part can hold several shingles and be shared for sure: the lists of before.
            keys.append(part_keys(tokens, num, den))
            continue
        for k in range(functions):
            seen = mix(tokens + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            keys.append(_lists(seen, mix(seen), parts, cls << 10 | k, LEAST_SHINGLES[0])[0])
    return np.concatenate(keys)


def index(docs: DataFrame, size: int, num: int, den: int, keys_of: Callable = part_keys) -> DataFrame:
    """(doc_id, n_shingles, digest, keys, root): per row, lists that no row before it stands in, and the least id of its
    slice that lists of the slice tie it to."""

    def run(batch):
        ids, sets, keys = batch["doc_id"].to_pylist(), [], []
        for doc, text in zip(ids, batch["text"].to_pylist(), strict=True):
            tokens = np.unique(shingles(text, size))
            sets.append((len(tokens), similar_sets.digest(tokens)))
            keys.append(keys_of(tokens, num, den) if doc is not None and len(tokens) else tokens[:0])
        lengths = [len(k) for k in keys]
        every, owner = np.concatenate(keys) if keys else np.zeros(0, np.uint64), np.repeat(np.arange(len(ids)), lengths)
        node = np.array([0 if d is None else d for d in ids], dtype=np.int64)
        order = np.lexsort((node[owner], every))
        ascending = every[order]
        new = np.ones(len(every), dtype=bool)
        new[1:] = ascending[1:] != ascending[:-1]
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(every)), 0))] if len(every) else order
        kept = np.zeros(len(every), dtype=bool)
        kept[order[new]] = True
        # Ids ascend, so the first of those tied is the least.
        names, place = np.unique(node, return_inverse=True)
        least = similar_sets.firsts(len(names), place[owner[order[~new]]], place[owner[head[~new]]])

        def lists(of: np.ndarray, values: np.ndarray) -> pa.ListArray:
            """One list per row from values whose row numbers ascend."""
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(ids)))]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

        columns = [
            pa.array(ids, pa.int64()), pa.array([n for n, _ in sets], pa.int64()), pa.array([d for _, d in sets], pa.binary()),
            lists(owner[kept], every[kept].view(np.int64)), pa.array(names[least[place]]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "keys", "root"])

    return map_arrow(texts(docs), run, "doc_id long, n_shingles long, digest binary, keys array<long>, root long")


def ties(indexed: DataFrame) -> DataFrame:
    """(a, b): of each list, what its slices' rows are tied to with the least of these, and every other row with its own."""
    listed = indexed.select(F.col("root").alias("a"), F.explode("keys").alias("key"))
    # A list has at most one row for each slice of the input.
    across = listed.select("a", F.min("a").over(Window.partitionBy("key")).alias("b")).where("a <> b")
    return across.distinct().union(indexed.where("doc_id <> root").select(F.col("doc_id").alias("a"), F.col("root").alias("b")))


def components_of(docs: DataFrame, size: int = SIZE, num: int = 9, den: int = 10) -> DataFrame:
    """(doc_id, n_shingles, component_id): documents with Jaccard similarity of num/den or more are linked.

    The component is the least doc_id that can be reached by links.
    """
    indexed = materialise(index(docs, size, num, den), "indexed")

    def again(some: DataFrame) -> DataFrame:
        return ties(materialise(index(some, size, num, den, second_keys), "indexed"))

    return similar_sets.classes(docs, indexed.select("doc_id", "n_shingles", "digest"), ties(indexed), size, num, den, again)
