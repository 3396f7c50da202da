"""Needles of a regular expression: strings of which every match must contain some.

They are derived from the parsed rule, so a rule and its prefilter cannot drift apart. An
alternative gives sets of needles, and a match contains one needle of each set. Case is folded on
both sides; white space ends a needle, since what is replaced by a blank must not make one.
"""

from __future__ import annotations

import re
from itertools import product
from re import _constants as op
from re import _parser

MOST, KEPT = 64, 3  # strings of one set; sets kept of one alternative
PARTICLES = frozenset("이가을를은는의에")


def fold(text: str) -> str:
    """Lower case as IGNORECASE sees it: dotted and dotless i are i, long s is s."""
    if not text.isascii():
        text = text.replace("İ", "i").replace("ſ", "s").replace("ı", "i")
    return text.lower()


def _weight(needles: frozenset[str]) -> tuple[int, int]:
    """Rarest last: length of the shortest needle, a letter beyond ASCII counting twice and a particle not; then few needles."""
    return min(0 if n in PARTICLES else sum(1 + (c > "\x7f") for c in n) for n in needles), -len(needles)


def _item(kind, arg) -> tuple[set[str] | None, list[frozenset[str]]]:
    """(all strings that the item matches, if they are few; sets of needles that it needs)."""
    if kind is op.LITERAL:
        return (None, []) if chr(arg).isspace() else ({fold(chr(arg))}, [])
    if kind is op.IN:
        chars = {chr(x) for k, x in arg if k is op.LITERAL}
        return (None, []) if len(chars) < len(arg) or len(chars) > 8 or any(map(str.isspace, chars)) else ({fold(c) for c in chars}, [])
    if kind is op.SUBPATTERN:
        return _sequence(arg[-1])
    if kind is op.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        if all(e is not None for e, _ in parts) and len(exact := set().union(*(e for e, _ in parts))) <= MOST:
            return exact, []
        best = [max(s, key=_weight, default=None) for s in (_sets(*p) for p in parts)]
        return None, [] if None in best else [frozenset().union(*best)]
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = arg
        exact, sets = _sequence(inner)
        if not least:
            return (exact | {""} if most == 1 and exact is not None else None), []
        if exact is None or len(exact) ** least > MOST:
            return None, _sets(exact, sets)
        many = {"".join(x) for x in product(exact, repeat=least)}
        return (many, []) if most == least else (None, _sets(many, []))
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):  # take up no text
        return {""}, []
    return None, []


def _sets(exact: set[str] | None, sets: list[frozenset[str]]) -> list[frozenset[str]]:
    return sets + [frozenset(exact)] if exact and "" not in exact else sets


def _sequence(items) -> tuple[set[str] | None, list[frozenset[str]]]:
    run, sets, whole = {""}, [], True
    for item in items:
        exact, own = _item(*item)
        if exact is not None and len(run) * len(exact) <= MOST:
            run = {a + b for a in run for b in exact}
            continue
        sets, run, whole = _sets(run, sets) + own, exact if exact is not None else {""}, False
    return (run, []) if whole else (None, _sets(run, sets))


def _shortest(needles: frozenset[str]) -> frozenset[str]:
    """Without needles that hold another one."""
    return frozenset(n for n in needles if not any(m != n and m in n for m in needles))


def _alternatives(items) -> list:
    items = list(items)
    if len(items) == 1 and items[0][0] is op.SUBPATTERN:
        return _alternatives(items[0][1][-1])
    if len(items) == 1 and items[0][0] is op.BRANCH:
        return [a for p in items[0][1][1] for a in _alternatives(p)]
    return [items]


#: Common letters, most common first: of a needle, its rarest one is looked for first.
COMMON = "이다는을가에고의로하한지기를은서도사시해어아있리인자것" + "etaoinsrhldcumfpgwybvkxjqz"


def _rarest(needle: str) -> str:
    return max(needle, key=lambda c: (len(COMMON) if (at := COMMON.find(c)) < 0 else at, c))


class Needles:
    """Call with a folded text: False means that none of the rules can match anywhere in it.

    ``bare`` stands for the alternatives whose needles are of one plain character: a pattern
    that finds something in every match of theirs.
    """

    def __init__(self, *rules: re.Pattern, bare: re.Pattern | None = None):
        self.bare, gates = None, {}
        for rule in rules:
            for items in _alternatives(_parser.parse(rule.pattern, rule.flags)):
                sets = sorted(map(_shortest, _sets(*_sequence(items))), key=_weight, reverse=True)
                if bare is not None and (not sets or _weight(sets[0])[0] < 2):
                    self.bare = bare
                elif not sets:
                    raise ValueError(f"an alternative without needles in {rule.pattern[:80]}")
                else:
                    gates.setdefault(tuple(sorted(sets[0])), []).append([tuple(sorted(s)) for s in sets[1:KEPT]])
        self.gates = list(gates.items())
        self.by_letter: dict[str, list[tuple[str, list]]] = {}
        for first, others in self.gates:
            for needle in first:
                self.by_letter.setdefault(_rarest(needle), []).append((needle, others))

    def __call__(self, folded: str) -> bool:
        for letter, needles in self.by_letter.items():
            if letter in folded:
                for needle, others in needles:
                    if needle in folded:
                        for sets in others:
                            if all(any(n in folded for n in s) for s in sets):
                                return True
        return self.bare is not None and self.bare.search(folded) is not None
