"""Bridges: builders of expressions that find components with no literal surface, in a window of text.

Each gives ``array<struct<s,e>>`` relative to the window, without repeats of a span.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hangul import final_class
from .spans import cut, span
from .textfn import finditer_spans


@dataclass(frozen=True)
class Bridge:
    bridge_id: str
    find: Callable[[Column, list[str]], Column]
    description: str
    version: str = "v1"
    requires_morph: bool = False


def first_of_each(spans: Column) -> Column:
    """Without later repeats of a span; order kept."""
    return F.array_distinct(spans)


#: The patterns of the three bridges, here and in the functions below.
ADNOMINAL, THING = "[ㄴᆫ]|은", "[것거게건걸]"
NDE = r"(?:은|는|ㄴ|ᆫ)\s*데(?:요)?|(?:은데|는데|인데|운데)(?:요)?"


def _adnominal(window: Column, options: list[str]) -> Column:
    return first_of_each(F.concat(finditer_spans(window, ADNOMINAL), finditer_spans(window, final_class("ㄴ"))))


def _nde(window: Column, options: list[str]) -> Column:
    polite = any(o.endswith("요") for o in options)
    loose = finditer_spans(window, NDE)
    if not polite:
        loose = F.transform(loose, lambda x: span(x["s"], x["e"] - F.when(cut(window, x["e"] - 1, x["e"]) == "요", 1).otherwise(0)))
    # A syllable ending in ㄴ before 데, over at most one plain blank; each syllable starts its own match.
    glued = finditer_spans(window, final_class("ㄴ", "(?= ?데)"))

    def widened(x: Column) -> Column:
        e = x["e"] + F.when(cut(window, x["e"], x["e"] + 1) == " ", 2).otherwise(1)
        return span(x["s"], e + (F.when(cut(window, e, e + 1) == "요", 1).otherwise(0) if polite else F.lit(0)))

    return first_of_each(F.concat(loose, F.transform(glued, widened)))


def _thing(window: Column, options: list[str]) -> Column:
    return finditer_spans(window, THING)


BRIDGES = {
    b.bridge_id: b
    for b in (
        Bridge("adnominal_n", _adnominal, "adnominal ㄴ/은, written out or as the final consonant of a syllable"),
        Bridge("nde", _nde, "connective ㄴ/은/는데, also with a blank, and a final ㄴ before 데"),
        Bridge("thing", _thing, "것 and its contracted forms"),
    )
}


def register(bridge: Bridge) -> None:
    """Extension point: adds a bridge for bundles to name."""
    BRIDGES[bridge.bridge_id] = bridge
