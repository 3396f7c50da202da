"""Look, core and three-character pieces of a text, over lists of strings.

*Look*: Unicode form NFKC without format characters (category Cf), every space character as a
plain blank, look-alike Cyrillic and Greek letters as Latin ones. *Core*: the look in lower
case, letters and digits only; a look made of labelled fields gives the cores of its pieces in
sorted order. *Pieces*: the distinct three-character substrings of a core.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

#: Cyrillic and Greek letters and the Latin letters that they look like.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j",
    "α": "a", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "ү": "y", "Ү": "Y", "ӏ": "l", "Ӏ": "I", "ѵ": "v", "Ѵ": "V",
}

#: What NFKC and the other rules leave as it is: ASCII and composed Hangul. JVM and Python alike.
STABLE = r"^[\u0009\u000a\u000d -~가-힣]*$"
_stable = re.compile(r"[\t\n\r -~가-힣]*").fullmatch
_break = re.compile(r"[;|\n\r]+")
LABEL_MAX, PIECE = 20, 3


@lru_cache(1)
def _table() -> dict[str, str]:
    table = dict(LOOKALIKES)
    for cp in (*range(0x80, 0x20000), *range(0xE0000, 0xE0200)):  # no format or space character lies elsewhere
        kind = unicodedata.category(chr(cp))
        if kind == "Cf":
            table[chr(cp)] = ""
        elif kind == "Zs":
            table[chr(cp)] = " "
    return table


def look(text: str) -> str:
    """One consistent form of ``text``; a text that is in it already comes back as it is."""
    if _stable(text):
        return text
    while (made := _translated(unicodedata.normalize("NFKC", text))) != text:  # taking a character away can bring a mark to its base
        text = made
    return text


def _translated(text: str) -> str:
    """The table applied to the few characters of a text that it has; none of what it gives is one of them."""
    table = _table()
    for c in set(text) & table.keys():
        text = text.replace(c, table[c])
    return text


def plain_core(text: str) -> str:
    return "".join(filter(str.isalnum, text.lower()))


def core(text: str | None) -> str:
    """Core of a raw text; null gives the empty core."""
    if text is None:
        return ""
    seen = look(text)
    if ":" in seen:
        parts = [p for p in _break.split(seen) if p.strip()]
        if len(parts) > 1 and all((k := p.find(":")) > 0 and 0 < len(p[:k].strip()) <= LABEL_MAX for p in parts):
            return "".join(sorted(map(plain_core, parts)))
    return plain_core(seen)


def pieces(cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(every three-character piece as one exact number, how many each core has), repeats kept.

    A core of under three characters has none.
    """
    joined = np.frombuffer("".join(cores).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, cores), np.int64, len(cores))
    if len(joined) < PIECE:
        return np.empty(0, np.uint64), np.zeros(len(cores), np.int64)
    grams = joined[:-2] << np.uint64(42) | joined[1:-1] << np.uint64(21) | joined[2:]
    ok = np.ones(len(joined), bool)
    ends = np.cumsum(lens)
    ok[ends[lens > 0] - 1] = False
    ok[ends[lens > 1] - 2] = False
    return grams[ok[:-2]], np.maximum(lens - 2, 0)


def likeness(a: str, b: str) -> float:
    """Share of distinct pieces in common, from whole cores; 0 where neither has a piece."""
    x, y = {a[i : i + 3] for i in range(len(a) - 2)}, {b[i : i + 3] for i in range(len(b) - 2)}
    both = len(x & y)
    return both / (len(x) + len(y) - both) if x or y else 0.0
