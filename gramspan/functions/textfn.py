"""Text helpers as Column expressions: Unicode white space, regex dialect, match spans."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the characters that ``\s`` and ``strip`` of Python take as white space, for a Java class.
WS = r"\t-\r\x1c-\x20\x85\xa0" + "".join(map(chr, (0x1680, 0x2000))) + "-" + "".join(map(chr, (0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_WORD = r"\p{L}\p{N}_"
SPAN = "struct<s:int,e:int>"
SPANS = f"array<{SPAN}>"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_ws(x: Column | str) -> Column:
    return F.regexp_replace(col(x), f"^[{WS}]+|[{WS}]+$", "")


def blank_to_null(x: Column | str) -> Column:
    """Trimmed text; null where nothing is left."""
    return F.nullif(trim_ws(x), F.lit(""))


def without_ws(x: Column) -> Column:
    return F.regexp_replace(x, f"[{WS}]+", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def java_pattern(pattern: str) -> str:
    """The Java pattern that finds what the Python one finds, for use in Spark's regex functions."""
    re.compile(pattern)
    out, k, inside, start = ["(?d)"], 0, False, False
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            e = pattern[k + 1 : k + 2]
            plain = {"s": WS, "d": r"\p{Nd}", "w": _WORD}
            if e in plain:
                out.append(plain[e] if inside else f"[{plain[e]}]")
            elif e and e in "SDW":
                out.append(f"[^{plain[e.lower()]}]")  # a nested negated class is a union in Java
            elif e == "b" and not inside:
                out.append(f"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))")
            elif e == "B" and not inside:
                out.append(f"(?:(?<=[{_WORD}])(?=[{_WORD}])|(?<![{_WORD}])(?![{_WORD}]))")
            elif e == "b":
                out.append(r"\x08")
            elif e == "Z":
                out.append(r"\z")
            else:
                out.append(pattern[k : k + 2])
            k, start = k + 2, False
            continue
        if inside:
            if c == "]" and not start:
                inside = False
                out.append(c)
            elif c in "[&":
                out.append("\\" + c)
            elif c == "]":
                out.append(r"\]")
            else:
                out.append(c)
            start = c == "^" and start
        elif c == "[":
            inside = start = True
            out.append(c)
        elif pattern.startswith("(?P<", k):
            name, k = pattern[k + 4 :].split(">", 1)[0], k + 4 + len(pattern[k + 4 :].split(">", 1)[0])
            out.append(f"(?<{name.replace('_', 'U')}>")
        elif pattern.startswith("(?P=", k):
            name = pattern[k + 4 :].split(")", 1)[0]
            k += 4 + len(name)
            out.append(rf"\k<{name.replace('_', 'U')}>")
        else:
            out.append(c)
        k += 1
    return "".join(out)


def may_match_empty(pattern: str) -> bool:
    """Whether some match can be empty; such patterns break the gap split and go through ``_python_spans``."""
    import re._parser as parser

    return parser.parse(pattern).getwidth()[0] == 0


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])))
def _python_spans(s: pd.Series, p: pd.Series, n: pd.Series) -> pd.Series:
    def one(text, pattern, most):
        if text is None:
            return None
        out = []
        for m in re.finditer(pattern, text):
            if len(out) >= most:
                break
            if m.end() > m.start():
                out.append({"s": m.start(), "e": m.end()})
        return out

    return pd.Series([one(*x) for x in zip(s, p, n)])


def finditer_spans(text: Column, pattern: str, cap: int = 1 << 20) -> Column:
    """Spans of the first ``cap`` non-overlapping matches, in code points.

    Matches and the gaps around them are cut natively; starts are running sums of their lengths.
    """
    if may_match_empty(pattern):
        return _python_spans(text, F.lit(pattern), F.lit(cap))
    java = F.lit(java_pattern(pattern))
    found = F.slice(F.regexp_extract_all(text, java, F.lit(0)), 1, cap)

    def spans(m: Column, gaps: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("a"))

        def step(acc: Column, x: Column) -> Column:
            s = acc["at"] + F.length(x["gaps"])
            e = s + F.length(x["m"])
            return F.struct(e.alias("at"), F.concat(acc["a"], F.array(F.struct(s.alias("s"), e.alias("e")))).alias("a"))

        pairs = F.arrays_zip(m.alias("m"), F.slice(gaps, 1, F.size(m)).alias("gaps"))
        return F.aggregate(pairs, zero, step, lambda acc: acc["a"])

    empty = F.array().cast(SPANS)
    pair = F.struct(found.alias("m"), F.split(text, java_pattern(pattern), -1).alias("gaps"))
    return F.when(text.rlike(java_pattern(pattern)), let(pair, lambda p: F.when(F.size(p["m"]) > 0, spans(p["m"], p["gaps"])).otherwise(empty))).otherwise(F.when(text.isNotNull(), empty))


def count_matches(text: Column, pattern: str) -> Column:
    return F.size(finditer_spans(text, pattern))
