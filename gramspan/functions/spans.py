"""Span algebra over ``array<struct<s,e>>`` of half-open code-point offsets, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .textfn import SPANS, WS, let

GAP, OPEN, CLOSE = " ... ", "[SPAN]", "[/SPAN]"


def cut(text: Column, s: Column, e: Column) -> Column:
    """text[s:e] for 0 <= s <= e."""
    return F.substring(text, s + 1, e - s)


def span(s: Column, e: Column) -> Column:
    return F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"))


def span_status(text: Column, segs: Column) -> Column:
    """empty, out_of_bounds, overlap_or_unsorted (the first offender decides) or ok."""
    bad = F.transform(
        segs,
        lambda x, i: F.when(~((x["s"] >= 0) & (x["s"] < x["e"]) & (x["e"] <= F.length(text))), "out_of_bounds").when((i > 0) & (x["s"] < F.coalesce(F.get(segs, i - 1)["e"], F.lit(0))), "overlap_or_unsorted"),
    )
    first = F.get(F.filter(bad, lambda x: x.isNotNull()), F.lit(0))
    return F.when(segs.isNull() | (F.size(segs) == 0), "empty").otherwise(F.coalesce(first, F.lit("ok")))


def valid(text: Column, segs: Column) -> Column:
    return span_status(text, segs) == "ok"


def parse_spans(value: Column) -> Column:
    """Spans of a JSON list of pairs, or of the same as a Python tuple or list; null where it is none."""
    tidy = F.translate(value, "()", "[]")
    tidy = F.regexp_replace(tidy, rf",[{WS}]*\]", "]")
    raw = F.when(tidy.rlike(rf"^[{WS}]*\[[{WS}]*\[.*\][{WS}]*\][{WS}]*$"), F.from_json(tidy, "array<array<int>>", {"mode": "PERMISSIVE"}))
    ok = (F.size(raw) > 0) & F.forall(raw, lambda p: (F.size(p) == 2) & F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull())
    return F.when(ok, F.transform(raw, lambda p: span(F.get(p, F.lit(0)), F.get(p, F.lit(1)))))


def format_spans(segs: Column) -> Column:
    """Compact ``[[s,e],...]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(segs, lambda x: F.concat(F.lit("["), x["s"].cast("string"), F.lit(","), x["e"].cast("string"), F.lit("]"))), ","), F.lit("]"))


def inject_markers(text: Column, segs: Column, open_: str = OPEN, close: str = CLOSE) -> Column:
    """The text with each segment between markers; segments sorted and disjoint."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, x: F.struct(F.concat(acc["out"], cut(text, acc["at"], x["s"]), F.lit(open_), cut(text, x["s"], x["e"]), F.lit(close)).alias("out"), x["e"].alias("at"))
    return F.aggregate(segs, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def span_key(segs: Column) -> Column:
    return F.array_join(F.transform(segs, lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), "|")


def span_text(text: Column, segs: Column, gap: str = GAP) -> Column:
    return F.array_join(F.transform(segs, lambda x: cut(text, x["s"], x["e"])), gap)


def envelope(segs: Column) -> Column:
    return span(F.array_min(F.transform(segs, lambda x: x["s"])), F.array_max(F.transform(segs, lambda x: x["e"])))


def char_window(text: Column, segs: Column, n: int) -> Column:
    """struct(start, end, text) of the envelope widened by ``n`` on both sides."""
    if n < 0:
        raise ValueError("a window is 0 or wider")
    return let(envelope(segs), lambda v: let(F.struct(F.greatest(F.lit(0), v["s"] - n).alias("start"), F.least(F.length(text), v["e"] + n).alias("end")), lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), cut(text, w["start"], w["end"]).alias("text"))))


def overlap(a: Column, b: Column) -> Column:
    return F.exists(a, lambda x: F.exists(b, lambda y: F.greatest(x["s"], y["s"]) < F.least(x["e"], y["e"])))


def merge_gaps(text: Column, segs: Column) -> Column:
    """Segments sorted and merged where only white space, or nothing, lies between two.

    Overlapping ones have nothing between them; the later end then holds, even if it is smaller.
    """
    ordered = F.array_sort(segs)

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        between = F.when(x["s"] > last["e"], cut(text, last["e"], x["s"])).otherwise("")
        glued = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(span(last["s"], x["e"])))
        return F.when(F.size(acc) == 0, F.array(span(x["s"], x["e"]))).when(between.rlike(f"^[{WS}]*$"), glued).otherwise(F.concat(acc, F.array(span(x["s"], x["e"]))))

    return F.aggregate(ordered, F.array().cast(SPANS), step)


def inspect(text: Column, value: Column) -> Column:
    """struct(status, note, text) of a span cell: parsed, parse_error, out_of_bounds or overlap_or_unsorted."""

    def seen(segs: Column) -> Column:
        status = F.when(segs.isNull(), "parse_error").when(span_status(text, segs) == "ok", "parsed").otherwise(span_status(text, segs))
        extracted = F.when(status == "parsed", span_text(text, segs)).otherwise("")
        return F.struct(status.alias("status"), F.when(status == "parsed", "").otherwise(F.concat(F.lit("span_segments: "), status)).alias("note"), extracted.alias("text"))

    return let(parse_spans(value), seen)
