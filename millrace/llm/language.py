"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of letters is bound into one vector by multiplying its
letters' vectors, each rotated by its distance from the end; the vectors of all runs in a text are
bundled into a sum. The profile of a language is the bundle of its training texts, less the bundle all
languages share; a text goes to the profile with the greatest cosine.

Letters are Unicode letters in lower case; whatever lies between words is one blank. Letters share
SLOTS vectors by their code, a-z one each. A null text, or one without letters, is ``und`` with score 0. Texts
that no profile is near give the first language in order with score 0, a model without any language gives
``und``; whether a text has letters is told apart from that. Rows that repeat an id are rows of their own. Rows without a language don't train. An empty table
trains no language. Columns other than those named are ignored.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, tidy

DIMENSIONS = 512
RUN = 3
#: Vectors for letters: one for the blank, 26 for a-z, the rest shared by all other letters.
SLOTS = 48
UNKNOWN = "und"

_letters = np.random.default_rng(11).choice(np.array([-1, 1], dtype=np.int8), (SLOTS, DIMENSIONS))
_rotated = [np.roll(_letters, k, axis=1) for k in range(RUN)]


def _slot(char: str) -> int:
    low = char.lower()[0]
    return 0 if not char.isalpha() else ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % (SLOTS - 27)


_slots = np.array([_slot(chr(c)) for c in range(sys.maxunicode + 1)], dtype=np.uint8)
#: Runs whose vectors are added up at a time.
STEP = 2048
# Vectors of the runs met by this worker, in the order of their coming, and the place of each run among them.
_bound = np.zeros((STEP, DIMENSIONS), dtype=np.int8)
_place = np.full(SLOTS**RUN, -1, dtype=np.int32)


def letters(text: str) -> np.ndarray:
    """Slots of the letters, with one 0 between words and around the text; empty without letters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    slots = np.concatenate([[0], _slots[codes], [0]])
    kept = slots[np.flatnonzero(slots | np.concatenate([[1], slots[:-1]]))]
    return kept if len(kept) > 1 else kept[:0]


def runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs of letters in a text, ascending, and how often each comes."""
    slots = letters(text).astype(np.int64)
    if len(slots) < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = sum(slots[k : len(slots) - RUN + 1 + k] * SLOTS ** (RUN - 1 - k) for k in range(RUN))
    return np.unique(joined, return_counts=True)


def bound(codes: np.ndarray) -> np.ndarray:
    """One vector per distinct run: its letters' vectors, rotated by their distance from its end, multiplied."""
    global _bound
    new = codes[_place[codes] < 0]
    if len(new):
        made = _rotated[0][new % SLOTS]
        for k in range(1, RUN):
            made = made * _rotated[k][new // SLOTS**k % SLOTS]
        known = int(_place.max()) + 1
        if known + len(new) > len(_bound):
            # Grown by half, to what this worker meets and no further.
            _bound = np.concatenate([_bound, np.zeros((max(len(new), len(_bound) // 2), DIMENSIONS), dtype=np.int8)])
        _bound[known : known + len(new)] = made
        _place[new] = np.arange(known, known + len(new))
    return _bound[_place[codes]]


def total(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted sum of the vectors of distinct runs, some at a time."""
    out = np.zeros(DIMENSIONS, dtype=weights.dtype)
    for at in range(0, len(codes), STEP):
        out += weights[at : at + STEP] @ bound(codes[at : at + STEP]).astype(weights.dtype)
    return out


def bundle(text: str) -> np.ndarray:
    """The sum of the vectors of a text's runs, of which there are at most SLOTS ** RUN."""
    codes, counts = runs(text)
    return total(codes, counts.astype(np.float32))


@dataclass(frozen=True)
class Profiles:
    """Languages in order and one vector of length 1 for each; empty without training rows."""

    languages: tuple[str, ...]
    vectors: np.ndarray
    shared: np.ndarray


def train(rows: DataFrame) -> Profiles:
    """Profiles from (text, lang). Tasks count the runs of each language and bundle them once.

    What comes to the driver is one vector for each language, whatever the number of rows.
    """
    kept = rows.select("text", "lang").where("text is not null and lang is not null")

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                codes, n = runs(text)
                # Each text weighs alike, as its cosine will.
                counts.setdefault(lang, np.zeros(SLOTS**RUN))[codes] += n / max(n.sum(), 1)
        for lang, sums in counts.items():
            codes = np.flatnonzero(sums)
            names = pa.array([lang] * DIMENSIONS)
            values = pa.array(total(codes, sums[codes]))
            yield pa.RecordBatch.from_arrays([names, pa.array(np.arange(DIMENSIONS, dtype=np.int32)), values], ["lang", "dim", "value"])

    parts = kept.mapInArrow(tidy(run), "lang string, dim int, value double")
    sums = parts.groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect()
    languages = tuple(sorted({r["lang"] for r in sums}))
    vectors = np.zeros((len(languages), DIMENSIONS))
    for r in sums:
        vectors[languages.index(r["lang"]), r["dim"]] = r["value"]
    # Rounded, so that the order in which tasks' sums arrive cannot show.
    vectors = _unit(np.round(_unit(vectors), 9))
    shared = vectors.mean(axis=0) if len(languages) > 1 else np.zeros(DIMENSIONS)
    return Profiles(languages, _unit(vectors - shared).astype(np.float32), shared.astype(np.float32))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def guess(text: str | None, profiles: Profiles) -> tuple[str, float, bool]:
    """(language, cosine with its profile, at least 0, whether the text has letters)."""
    if not len(letters(text or "")):
        return UNKNOWN, 0.0, False
    if not profiles.languages:
        return UNKNOWN, 0.0, True
    sums = bundle(text or "")
    apart = sums / max(float(np.linalg.norm(sums)), 1e-12) - profiles.shared
    scores = profiles.vectors @ (apart / max(float(np.linalg.norm(apart)), 1e-12))
    best = int(scores.argmax())
    return profiles.languages[best], min(1.0, max(0.0, float(scores[best]))), True


def predict(profiles: Profiles, text: Column) -> Column:
    """A column of struct(lang, score, letters) for a column of texts."""

    @F.arrow_udf("struct<lang:string,score:double,letters:boolean>")
    def of(column):
        found = [guess(t.as_py(), profiles) for t in column]
        kinds = {"lang": pa.string(), "score": pa.float64(), "letters": pa.bool_()}
        values = zip(*found, strict=True) if found else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(values, kinds.values(), strict=True)], list(kinds))

    return of(text)
