"""Text, span and Hangul functions against plain Python."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gramspan.functions import spans as P
from gramspan.functions.hangul import FINAL_JAMO, final_class, has_final, syllables_with
from gramspan.functions.textfn import finditer_spans, trim_ws

PATTERNS = ["가+", r"\s+", r"\w+", r"[^\s가]", r"(?<=가)나", r"가(?!나)", r"\b가", "a|ab", "x*", r"[\d\s]+", "^가", "나$"]
TEXTS = ["가나 가가　다", "😀가 나\r\n가", "", "ab aab 12\x1c3", "\x85가\xa0나 ", "가나", None, "나\n"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_finditer(spark, pattern):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [None if r.s is None else [tuple(x) for x in r.s] for r in df.select(finditer_spans(F.col("t"), pattern).alias("s")).collect()]
    assert got == [None if t is None else [m.span() for m in re.finditer(pattern, t) if m.end() > m.start()] for t in TEXTS]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.text("가 나\n.", max_size=12), st.lists(st.tuples(st.integers(-1, 13), st.integers(-1, 14)), max_size=4)), min_size=1, max_size=40))
def test_span_algebra(spark, rows):
    df = spark.createDataFrame([(k, t, [{"s": a, "e": b} for a, b in x]) for k, (t, x) in enumerate(rows)], f"k int, t string, x {P.SPANS}")
    t, x = F.col("t"), F.col("x")
    ok = P.valid(t, x)
    out = df.select("k", ok.alias("ok"), F.when(ok, P.inject_markers(t, x)).alias("m"), F.when(ok, P.span_text(t, x)).alias("w"), P.format_spans(x).alias("f"), P.merge_gaps(t, F.filter(x, lambda s: (s["s"] >= 0) & (s["e"] > s["s"]) & (s["e"] <= F.length(t)))).alias("g"), F.when(ok, P.char_window(t, x, 2)["text"]).alias("c"), P.parse_spans(P.format_spans(x)).alias("back")).collect()
    for r in out:
        text, segs = rows[r.k]
        good = bool(segs) and all(0 <= a < b <= len(text) for a, b in segs) and all(p[1] <= q[0] for p, q in zip(segs, segs[1:]))
        assert r.ok == good
        assert r.f == "[" + ",".join(f"[{a},{b}]" for a, b in segs) + "]"
        assert ([tuple(s) for s in r.back] if r.back else []) == segs
        if good:
            marked = text
            for a, b in reversed(segs):
                marked = marked[:a] + "[SPAN]" + marked[a:b] + "[/SPAN]" + marked[b:]
            assert r.m == marked and r.w == " ... ".join(text[a:b] for a, b in segs)
            assert r.c == text[max(0, segs[0][0] - 2) : segs[-1][1] + 2]
        merged = []
        for a, b in sorted(s for s in segs if 0 <= s[0] < s[1] <= len(text)):
            if merged and not text[merged[-1][1] : a].strip():
                merged[-1] = (merged[-1][0], b)
            else:
                merged.append((a, b))
        assert [tuple(s) for s in r.g] == merged


def test_parse_and_inspect(spark):
    rows = ["[[0,1]]", "[(0, 1), (2, 3)]", "((0,1),)", "", "x", "[]", "[[0]]", "[[2,1]]", "[[1,2],[0,1]]", "[[0,99]]", None]
    df = spark.createDataFrame([("가나다", v) for v in rows], "t string, v string")
    got = [r[0] for r in df.select(P.inspect(F.col("t"), F.col("v"))["status"]).collect()]
    assert got == ["parsed", "parsed", "parsed", "parse_error", "parse_error", "parse_error", "parse_error", "out_of_bounds", "overlap_or_unsorted", "out_of_bounds", "parse_error"]


def test_overlap_and_trim(spark):
    df = spark.createDataFrame([([(0, 2)], [(2, 3)], "　a \x85"), ([(0, 2), (5, 6)], [(5, 9)], " b")], f"a {P.SPANS}, b {P.SPANS}, t string")
    got = df.select(P.overlap(F.col("a"), F.col("b")), trim_ws("t")).collect()
    assert [tuple(r) for r in got] == [(False, "a"), (True, "b")]


def test_hangul(spark):
    assert len(FINAL_JAMO) == 28 and len(syllables_with("ㄴ")) == 399 and re.fullmatch(final_class("ㄴ"), "간")
    df = spark.createDataFrame([(c,) for c in "간가ㄴa안닭"], "c string")
    assert [r[0] for r in df.select(has_final(F.col("c"), "ㄴ")).collect()] == [True, False, False, False, True, False]
    for bad in (lambda: syllables_with(""), lambda: syllables_with("ㅏ")):
        with pytest.raises(ValueError):
            bad()
