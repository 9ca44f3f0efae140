"""Token ids of a public tokenizer file, with the ids of repeated words kept at hand.

A word BPE file cuts a text into words before it merges, and never joins characters across a space. So
the ids of a text are those of its space-separated parts in turn. Parts not seen before go to the
library, many at a time. Those that are one word of Latin letters, with or without a stop after it, skip
the steps that only find words: the merges alone are run on them, and the mark that such a file puts on the
last token of a word tells where the next one begins. Splitting and finding equal parts is left to Arrow,
so Python sees each distinct part of a batch once. Any other kind of file is handed whole texts.
``tests/llm`` compares the outcome with whole texts in both cases.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts kept per worker, and bytes of their names. When full, the store starts anew; ids don't depend on it.
KEPT = 600_000
KEPT_BYTES = 16 << 20
#: Parts given to the library at once.
_TOGETHER = 5_000
#: Bytes of text worth handing over at a time: the more, the fewer parts are distinct.
SLICE = 8_000_000
_STOPS = ".,;:!?"
_NONE = np.zeros(0, "<u4")

# How the file must cut words for the shortcut to hold.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = ["NFC", "Replace", "Lowercase"]
_WORD_END = "</w>"

# Letters outside Latin, and the one Latin letter whose small form is two characters.
_FAR = "[\u0130\u0250-\U0010ffff]"
_SMALL = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower())
_ONE_WORD = f"^[{_SMALL}]+[{_STOPS}]?$"

_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _cuts_words(library) -> bool:
    kind = json.loads(library.to_str())
    normal = [n["type"] for n in (kind["normalizer"] or {}).get("normalizers", [])]
    cut = (kind["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    marked = kind["model"].get("end_of_word_suffix") == _WORD_END
    return marked and normal == _NORMAL and cut.get("pattern") == {"Regex": _WORDS} and bool(cut.get("invert"))


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte; visible Latin-1 characters stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)} | {0x20: " "}


def _parts(texts: pa.Array) -> pa.ListArray:
    """The space-separated parts of each text, in small letters where that is all the library would do."""
    kept = pc.match_substring_regex(texts, _FAR + r"|<\|")
    small = pc.if_else(kept, texts, pc.utf8_lower(texts))
    return pc.split_pattern(pc.replace_substring(small, "\n", " "), " ")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes. One per worker process and file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.by_words = _cuts_words(self.library)
        self.merges = Tokenizer(self.library.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.letters = _byte_letters()
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.stops = {s: np.frombuffer(self._whole([s])[0], "<u4") for s in _STOPS}
        self._forget()

    def _forget(self) -> None:
        """Start the store anew: the parts met, and in their order the ids of all and where each part's end."""
        self.parts, self.ids, self.cuts = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        found = self.library.encode_batch(list(texts), add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4").tobytes() for f in found]

    def _learn(self, parts: pa.Array) -> None:
        simple = pc.match_substring_regex(parts, _ONE_WORD)
        names = parts.filter(simple)
        words = pc.utf8_rtrim(names, _STOPS)
        stops = pc.utf8_slice_codeunits(names, -1).to_pylist()
        plain = words.to_pylist()
        for at in range(0, len(plain), _TOGETHER):
            joined = " ".join(plain[at : at + _TOGETHER])
            if not joined.isascii():
                joined = joined.encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.merges.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            # A stop's ids go behind those of its word.
            behind = [self.stops.get(s, _NONE) for s in stops[at : at + _TOGETHER]]
            sizes = np.fromiter(map(len, behind), np.int64, len(behind))
            ids = np.insert(ids, np.repeat(cuts, sizes), np.concatenate([_NONE, *behind]))
            self._keep(names.slice(at, _TOGETHER), ids, cuts + np.cumsum(sizes))
        odd = parts.filter(pc.invert(simple))
        for at in range(0, len(odd), _TOGETHER):
            some = odd.slice(at, _TOGETHER)
            found = self.library.encode(" ".join(some.to_pylist()), add_special_tokens=False)
            places = np.array([a for a, _ in found.offsets], dtype=np.int64)
            lengths = pc.utf8_length(some).to_numpy()
            self._keep(some, np.array(found.ids, dtype="<u4"), np.searchsorted(places, np.cumsum(lengths + 1)))

    def _keep(self, names: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        self.parts = pa.concat_arrays([self.parts, names])
        self.cuts = np.concatenate([self.cuts, self.cuts[-1] + ends])
        self.ids = np.concatenate([self.ids, ids[: ends[-1]]])

    def __call__(self, texts: pa.Array | Sequence[str]) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.by_words:
            return self._whole(texts.to_pylist())
        if not len(texts):
            return []
        if len(self.parts) > KEPT or self.parts.nbytes > KEPT_BYTES:
            self._forget()
        split = _parts(texts)
        coded = split.flatten().dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.parts)
        if place.null_count:
            self._learn(coded.dictionary.filter(place.is_null()))
            place = pc.index_in(coded.dictionary, value_set=self.parts)
        # The ids of every part in turn: each run of places starts where its part's ids start.
        at = place.to_numpy()[coded.indices.to_numpy()]
        start, size = self.cuts[at], self.cuts[at + 1] - self.cuts[at]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(start - (ends - size), size) + np.arange(ends[-1])]
        raw, cuts = ids.tobytes(), np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()] * 4
        return [raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; workers serve many tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
