"""Hangul syllable arithmetic: final consonants by code point, and character classes built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE, LAST, FINALS = 0xAC00, 0xD7A3, 28
#: Fixed value: final consonants in the order of the syllable block; the first place is for none.
FINAL_JAMO = ["", *"ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"]


def final_index(jamo: str) -> int:
    if jamo not in FINAL_JAMO:
        raise ValueError(f"no final consonant: {jamo!r}")
    return FINAL_JAMO.index(jamo)


def has_final(ch: Column, jamo: str) -> Column:
    """Whether a single character is a syllable with this final consonant."""
    at = F.ascii(ch) - BASE
    return (F.length(ch) == 1) & at.between(0, LAST - BASE) & (F.pmod(at, F.lit(FINALS)) == final_index(jamo))


def syllables_with(jamo: str) -> str:
    k = final_index(jamo)
    if not k:
        raise ValueError("a final consonant is needed")
    return "".join(map(chr, range(BASE + k, LAST + 1, FINALS)))


def final_class(jamo: str, suffix: str = "") -> str:
    """Regex class of all syllables with the final consonant."""
    return f"[{syllables_with(jamo)}]{suffix}"
