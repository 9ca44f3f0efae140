"""Personal data, also where it is disguised, at its place in the source text.

Plain identifiers are found in the text as it stands. Then transducers rewrite disguises: look-alike letters
and digits become their plain forms, invisible characters go, "(at)" and "[dot]" become signs, spelled digits
join the numerals beside them, "dot" and "point" between words or digits become signs, and so does "at" before
a host with a dot, in any case and with any blanks. What is found decides, not what is rewritten. Each rewriting keeps, for every character it
writes, the stretch of source characters it stands for. What is found in the normalised text is carried back
through these stretches; a span inside one already found plainly adds nothing.

Spans are code points, end exclusive. A null text is an empty one. Rows that repeat an id or a text are rows
of their own. An empty table gives no rows. Very long texts take time in proportion to their length.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import map_arrow, texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# The base patterns. A match never starts inside a run of digits, so looking behind changes none
# and spares trying every place of a long run.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterable[tuple[int, int]]:
    """Matches of local part, sign and host, found from the sign: each run before one is read once."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at) if start < at else None
        if host:
            floor = host.end()
            yield start, floor
        at = text.find("@", max(floor, at + 1))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d // 10 + d % 10 for d in doubled)) % 10 == 0


def _is_card(match: str) -> bool:
    digits = re.sub(r"[ -]", "", match)
    return 13 <= len(digits) <= 19 and luhn(digits)


def plain(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    found += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(m[0])]
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


# Characters that look like others.
_LOOKS = str.maketrans(
    "АВЕЅІЈКМНОРСТХУаеіјорсухѕԁһΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρ",
    "ABESIJKMHOPCTXYaeijopcyxsdhABEZHIKMNOPTYXovp",
) | {0xA0: " ", 0x2009: " ", 0x202F: " ", 0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-", 0xFF0D: "-"} | {
    0x2024: ".", 0xFF0E: ".", 0x3002: ".", 0xFF20: "@", 0xFE6B: "@", 0xFF0B: "+",
} | {0xFF21 + i: chr(65 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_OTHER_DIGIT = re.compile(r"(?![0-9])\d")
_HIDDEN = re.compile("[\u00ad\u200b\u200c\u200d\u2060\ufeff]")
_ODD = re.compile("[^\x00-\x9f\xa1-\xac\xae-\xff]")

_DIGITS = {
    word: str(value)
    for value, words in enumerate([
        "zero oh null cero zéro", "one eins uno", "two zwei dos deux", "three drei tres trois", "four vier cuatro quatre",
        "five fünf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf",
    ])
    for word in words.split()
}
_ANY_DIGIT = "(?:" + "|".join(sorted(_DIGITS, key=len, reverse=True)) + ")"
_NUMERAL = rf"(?:{_ANY_DIGIT}|[0-9]+)(?!\w)"
_SPELLED = re.compile(rf"(?i)(?:\bplus[\s-]+)?(?<!\w){_NUMERAL}(?:(?:[\s,-]+(?:(?:dot|point)[\s,-]+)?|\.){_NUMERAL})+")
_APART = str.maketrans("-,.", "   ")
_IN_RUN = re.compile(r"[^\W_]+")
_BRACKETED = re.compile(r"(?i)(?<!\s)\s*[\[({<]\s*(at|dot|punkt|punto|point)\s*[\])}>]\s*")
_DOT = re.compile(r"(?i)(?<=[A-Za-z0-9])\s+(?:dot|point)\s+(?=[A-Za-z0-9])")
_AT = re.compile(r"(?i)(?<=[A-Za-z0-9._%+-])\s+at\s+(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![A-Za-z0-9-]))")


class Rewritten:
    """A text under rewriting, with the source stretch of every stretch of it."""

    def __init__(self, text: str):
        self.text = text
        #: Where a piece starts now, where it starts and ends in the source; a piece of equal length maps one to one.
        self.pieces = [(0, 0, len(text))]

    def place(self, at: int) -> tuple[int, int]:
        """Source start and end of the character now at ``at``."""
        k = bisect_right(self.pieces, at, key=lambda p: p[0]) - 1
        now, start, end = self.pieces[k]
        size = (self.pieces[k + 1][0] if k + 1 < len(self.pieces) else len(self.text)) - now
        if size == end - start:
            return start + at - now, start + at - now + 1
        return start, end

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put texts in place of ascending stretches."""
        if not edits:
            return
        out, pieces, at, size = [], [], 0, 0

        def keep(a: int, b: int) -> None:
            nonlocal size
            k = bisect_right(self.pieces, a, key=lambda p: p[0]) - 1
            while a < b:
                stop = min(b, self.pieces[k + 1][0] if k + 1 < len(self.pieces) else len(self.text))
                pieces.append((size, self.place(a)[0], self.place(stop - 1)[1]))
                out.append(self.text[a:stop])
                size, a, k = size + stop - a, stop, k + 1

        for a, b, new in edits:
            keep(at, a)
            if new:
                pieces.append((size, self.place(a)[0], self.place(b - 1)[1]))
                out.append(new)
                size += len(new)
            at = b
        keep(at, len(self.text))
        self.text, self.pieces = "".join(out), pieces or [(0, 0, 0)]

    def source(self, a: int, b: int) -> tuple[int, int]:
        return self.place(a)[0], self.place(b - 1)[1]


def _spelled(match: re.Match) -> Iterable[tuple[int, int, str]]:
    """Edits that join spelled digits with the numerals beside them; blanks between plain numerals stay."""
    words = [(m.start() + match.start(), m.end() + match.start(), m[0].lower()) for m in _IN_RUN.finditer(match[0])]
    if not any(word in _DIGITS for _, _, word in words):
        return
    end, spelled, sign = match.start(), True, ""
    for a, b, word in words:
        if word in ("dot", "point"):
            sign = "."
        elif word == "plus":
            sign = "+"
        else:
            digit = _DIGITS.get(word)
            if end < a and match.string[end:a] != "." and (sign or spelled or digit):
                yield end, a, sign
            if digit:
                yield a, b, digit
            end, spelled, sign = b, digit is not None, ""


def normalise(text: str) -> Rewritten | None:
    """The text with its disguises rewritten, or None where there is none."""
    work = Rewritten(text)
    if _ODD.search(text):
        work.text = _OTHER_DIGIT.sub(lambda m: str(unicodedata.decimal(m[0])), text.translate(_LOOKS))
        work.replace([(m.start(), m.end(), "") for m in _HIDDEN.finditer(work.text)])
    signs = {"at": "@"}
    work.replace([(m.start(), m.end(), signs.get(m[1].lower(), ".")) for m in _BRACKETED.finditer(work.text)])
    low = work.text.lower()
    if not _DIGITS.keys().isdisjoint(low.translate(_APART).split()):
        work.replace([edit for m in _SPELLED.finditer(work.text) for edit in _spelled(m)])
    if "dot" in low or "point" in low:
        work.replace([(m.start(), m.end(), ".") for m in _DOT.finditer(work.text)])
    work.replace([(m.start(), m.end(), "@") for m in _AT.finditer(work.text)])
    return None if work.text == text else work


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans, each by kind in the order of KINDS, then start."""
    base, work = plain(text), normalise(text)
    if work is None:
        return base, base
    extra = []
    for kind, a, b in plain(work.text):
        start, end = work.source(a, b)
        if not any(k == kind and s <= start and end <= e for k, s, e in base):
            extra.append((kind, start, end))
    return base, sorted({*base, *extra}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def written(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); counts and digest of the plain spans.

    One pass over the texts, no shuffle.
    """

    def run(batch):
        rows = []
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            base, spans = find(text)
            counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            rows.append((doc, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in FOUND.split(", ")])

    return map_arrow(texts(docs), run, FOUND)
