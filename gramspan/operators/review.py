"""Review rows: flattening of detections, span checks, context columns and advisory first passes."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spans import cut, format_spans, inspect, parse_spans
from ..functions.textfn import blank_to_null, java_pattern, let, without_ws
from .detect import each

#: Fixed value: the review columns in their order.
REVIEW_COLUMNS = [
    "hit_id", "candidate_index", "batch_id", "text_id", "corpus_domain", "source", "source_file", "source_row_index", "source_line_no",
    "origin_e_id", "unit_id", "unit_type", "member_e_ids", "canonical_form", "group", "regex_match_span", "raw_text", "regex_match_text",
    "human_label", "span_segments", "span_key", "span_text", "span_source", "component_span_status", "component_span_enabled",
    "partial_span_text", "matched_component_ids", "missing_required_component_ids", "partial_component_spans", "partial_span_segments",
    "applied_bridge_ids", "detect_rule_ids", "hard_fail_rule_ids", "llm_temp_label", "llm_note", "span_status", "corrected_span_segments",
    "corrected_span_text", "memo", "reviewer",
]
HUMAN = ["human_label", "llm_temp_label", "llm_note", "span_status", "corrected_span_segments", "corrected_span_text", "memo", "reviewer"]
LISTS = ["member_e_ids", "matched_component_ids", "missing_required_component_ids", "applied_bridge_ids", "detect_rule_ids", "hard_fail_rule_ids"]


def pair_json(x: Column) -> Column:
    return F.concat(F.lit("["), x["s"].cast("string"), F.lit(","), x["e"].cast("string"), F.lit("]"))


def span_map_json(m: Column) -> Column:
    entries = F.transform(F.map_entries(m), lambda x: F.concat(F.lit('"'), x["key"], F.lit('":'), pair_json(x["value"])))
    return F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))


def review_rows(detected: DataFrame) -> DataFrame:
    """One row per kept candidate in the review columns; cells are text, lists and spans compact JSON."""
    keys = ["batch_id", "text_id", "corpus_domain", "source", "source_file", "source_row_index", "source_line_no"]
    there = [c if c in detected.columns else F.lit("").alias(c) for c in keys]
    rows = each(detected.select(*there, "raw_text", "candidates"), *keys, "raw_text").withColumnRenamed("k", "_k")
    place = F.col("_k") + 1
    own = {"hit_id": F.format_string("%s-cand%02d", F.col("text_id").cast("string"), place), "candidate_index": place, "raw_text": F.col("raw_text")}
    own |= {k: F.col(k) for k in keys} | {k: F.lit("") for k in HUMAN} | {k: F.to_json(F.col(f"c.{k}")) for k in LISTS}
    own |= {"regex_match_span": pair_json(F.col("c.regex_match_span")), "span_segments": format_spans(F.col("c.span_segments")), "partial_span_segments": format_spans(F.col("c.partial_span_segments")), "partial_component_spans": span_map_json(F.col("c.partial_component_spans"))}
    return rows.select(*[F.coalesce(own.get(k, F.col(f"c.{k}")).cast("string"), F.lit("")).alias(k) for k in REVIEW_COLUMNS])


def batch_of(explicit: str | None, path: str) -> str:
    """The given batch id, else ``batch_<digits>`` from the file's name, else its stem."""
    import re

    stem = Path(path).stem
    return explicit or (m.group(0) if (m := re.search(r"batch_\d+", stem)) else stem)


def search_report(detected: DataFrame) -> DataFrame:
    """(dimension, value, texts, hit_texts, candidates): totals, and by domain, unit, span source and component status, in one pass."""
    domain = F.coalesce(blank_to_null("corpus_domain"), F.lit("unknown"))
    texts = detected.select(domain.alias("domain"), F.size("candidates").alias("n")).groupBy("domain").agg(F.count(F.lit(1)).alias("texts"), F.count_if(F.col("n") > 0).alias("hit_texts"), F.sum("n").alias("candidates"))
    by_domain = texts.rollup("domain").agg(F.sum("texts").alias("texts"), F.sum("hit_texts").alias("hit_texts"), F.sum("candidates").alias("candidates"), F.grouping("domain").alias("g"))
    first = by_domain.select(F.when(F.col("g") == 1, "total").otherwise("domain").alias("dimension"), F.when(F.col("g") == 1, "").otherwise(F.col("domain")).alias("value"), "texts", "hit_texts", "candidates")
    hits = each(detected).select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(f"c.{c}").alias("value")) for d, c in (("unit", "unit_id"), ("span_source", "span_source"), ("status", "component_span_status"))])).alias("x"))
    rest = hits.groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("candidates"))
    return first.unionByName(rest.select("dimension", "value", F.lit(None).cast("long").alias("texts"), F.lit(None).cast("long").alias("hit_texts"), "candidates"))


def key_violations(rows: DataFrame) -> DataFrame:
    """(code, hit_id): blank or repeated hit ids."""
    blank = rows.where(blank_to_null("hit_id").isNull()).select(F.lit("blank_hit_id").alias("code"), "hit_id")
    again = rows.groupBy("hit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and hit_id is not null").select(F.lit("duplicate_hit_id").alias("code"), "hit_id")
    return blank.unionByName(again)


def column_order(columns: list[str], fixed: list[str] = REVIEW_COLUMNS) -> list[str]:
    return [*fixed, *[c for c in columns if c not in fixed]]


def enriched(rows: DataFrame) -> DataFrame:
    """Review rows with the span check: status, note, extracted text, and spans in compact form."""
    seen = inspect(F.col("raw_text"), F.col("span_segments"))
    made = rows.withColumn("_i", seen)
    tidy = F.when(F.col("_i.status") == "parsed", format_spans(parse_spans(F.col("span_segments")))).otherwise(F.col("span_segments"))
    return made.withColumns({"span_parse_status": F.col("_i.status"), "span_parse_note": F.col("_i.note"), "span_text_extracted": F.col("_i.text"), "span_segments": tidy}).drop("_i")


def span_context(text: Column, segs: Column) -> Column:
    """struct(before, after, window, prev_char, next_char) around the first segment; empty strings where there is none."""

    def around(x: Column) -> Column:
        lo = lambda n: F.greatest(F.lit(0), x["s"] - n)
        parts = [cut(text, lo(6), x["s"]).alias("before"), cut(text, x["e"], x["e"] + 6).alias("after"), cut(text, lo(8), x["e"] + 8).alias("window"), cut(text, lo(1), x["s"]).alias("prev_char"), cut(text, x["e"], x["e"] + 1).alias("next_char")]
        return F.struct(*[F.coalesce(p, F.lit("")).alias(n) for p, n in zip(parts, ("before", "after", "window", "prev_char", "next_char"))])

    return let(F.get(segs, F.lit(0)), around)


def match_pair(text: Column, span_json: Column, match_text: Column) -> Column:
    """struct<s,e> of the stated match if it is within the text, else of the first place of the match's text, else null."""

    def first(p: Column) -> Column:
        s, e = F.get(p, F.lit(0)), F.get(p, F.lit(1))
        at = F.locate(match_text, text, 1) - 1 if isinstance(match_text, str) else F.call_function("instr", text, match_text) - 1
        good = (F.size(p) == 2) & (s >= 0) & (s < e) & (e <= F.length(text))
        return F.when(good, F.struct(s.alias("s"), e.alias("e"))).when((F.length(match_text) > 0) & (at >= 0), F.struct(at.cast("int").alias("s"), (at + F.length(match_text)).cast("int").alias("e")))

    parsed = F.when(span_json.rlike(r"^\s*\[\s*-?\d+\s*,\s*-?\d+\s*\]\s*$"), F.from_json(span_json, "array<int>"))
    return let(F.coalesce(parsed, F.array().cast("array<int>")), first)


def _token(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, java_pattern(pattern), 1)


def kwic(text: Column, at: Column, tokens: int = 5) -> Column:
    """The tokens that overlap the match and ``tokens`` on each side, joined by one blank.

    Only the text beside the match is cut into tokens; to its left it is read backwards.
    """
    inner = cut(text, at["s"], at["e"])
    head = F.length(_token(inner, r"^(\s*)"))
    tail = F.length(_token(F.reverse(inner), r"^(\s*)"))
    s, e = at["s"] + head, at["e"] - tail
    left = F.reverse(_token(F.reverse(cut(text, F.lit(0), s)), rf"^(\S*(?:\s+\S+){{0,{tokens}}})"))
    right = _token(cut(text, e, F.length(text)), rf"^(\S*(?:\s+\S+){{0,{tokens}}})")
    whole = F.concat(left, cut(text, s, e), right)
    return F.when(at.isNotNull() & (head < F.length(inner)), F.regexp_replace(F.regexp_replace(whole, java_pattern(r"\s+"), " "), "^ | $", "")).otherwise("")


def adjacent_tokens(text: Column, at: Column) -> Column:
    """struct(left, right_1, right_2): the fragment or token left of the match, and up to two right of it, a split token's rest first."""
    before, after = F.reverse(cut(text, F.lit(0), at["s"])), cut(text, at["e"], F.length(text))
    found = {"left": F.reverse(_token(before, r"^\s*(\S+)")), "right_1": _token(after, r"^\s*(\S+)"), "right_2": _token(after, r"^\s*\S+\s+(\S+)")}
    return F.struct(*[F.when(at.isNull(), "").otherwise(F.coalesce(c, F.lit(""))).alias(n) for n, c in found.items()])


@dataclass(frozen=True)
class Caution:
    """One advisory rule: every field matches its pattern, and one of its alternatives."""

    caution_id: str
    match: dict[str, str | list[str]]
    label: str = "unclear"
    span_status: str = "ok"
    reason: str | None = None
    note: str = ""
    priority: int = 100


#: Fields a caution may look at.
HAYSTACKS = ("raw_text", "compact_text", "span_text", "regex_match_text", "window", "before", "after", "prev_char", "next_char")


def load_cautions(path: str, item_id: str) -> list[Caution]:
    """Cautions of a JSON file, by priority and id; wrong owner, missing and repeated ids are errors."""
    raw = json.loads(Path(path).read_text("utf-8"))
    if raw.get("item_id", item_id) != item_id:
        raise ValueError(f"cautions of {raw.get('item_id')}, not of {item_id}")
    out, seen = [], set()
    for c in raw.get("cautions", []):
        if not c.get("caution_id") or c["caution_id"] in seen:
            raise ValueError(f"missing or repeated caution id: {c.get('caution_id')!r}")
        seen.add(c["caution_id"])
        o = c.get("output", {})
        out.append(Caution(c["caution_id"], c.get("match", {}), o.get("label", "unclear"), o.get("span_status", "ok"), o.get("reason"), o.get("note", ""), int(c.get("priority") or 100)))
    return sorted(out, key=lambda c: (c.priority, c.caution_id))


def caution_hit(c: Caution) -> Column:
    ok = F.lit(bool(c.match))
    for key, patterns in c.match.items():
        name = key.removesuffix("_any").removesuffix("_regex")
        if name not in HAYSTACKS:
            raise ValueError(f"a caution can't look at {name}")
        either = F.lit(False)
        for p in [patterns] if isinstance(patterns, str) else patterns:
            either = either | F.col(name).rlike(java_pattern(p))
        ok = ok & F.coalesce(either, F.lit(False))
    return ok


def first_match(cautions: list[Caution], otherwise: Column) -> Column:
    """struct(label, span_status, reason, note) of the first caution that matches, else ``otherwise``."""
    out = otherwise
    for c in sorted(cautions, key=lambda c: (c.priority, c.caution_id), reverse=True):
        made = F.struct(F.lit(c.label).alias("label"), F.lit(c.span_status).alias("span_status"), F.lit(c.reason or f"caution_{c.caution_id}").alias("reason"), F.lit(c.note).alias("note"))
        out = F.when(caution_hit(c), made).otherwise(out)
    return out


@dataclass(frozen=True)
class Profile:
    """An ordered decision list: (field, pattern, label, span_status, reason); the first that matches holds."""

    steps: list[tuple[str, str, str, str, str]] = field(default_factory=list)
    default: tuple[str, str, str] = ("unclear", "ok", "no_rule")

    def column(self) -> Column:
        make = lambda label, status, reason: F.struct(F.lit(label).alias("label"), F.lit(status).alias("span_status"), F.lit(reason).alias("reason"), F.lit("").alias("note"))
        out = make(*self.default)
        for name, pattern, label, status, reason in reversed(self.steps):
            out = F.when(F.col(name).rlike(java_pattern(pattern)), make(label, status, reason)).otherwise(out)
        return out


NO_PROFILE = Profile(default=("", "", "no_first_pass_profile"))


def first_pass(rows: DataFrame, profile: Profile = NO_PROFILE, cautions: list[Caution] | None = None) -> DataFrame:
    """Review rows with context columns and advisory label, status, reason and note; human columns stay as they are."""
    context = rows.withColumn("_c", span_context(F.col("raw_text"), parse_spans(F.col("span_segments"))))
    names = ("before", "after", "window", "prev_char", "next_char")
    wide = context.withColumns({n: F.coalesce(F.col(f"_c.{n}"), F.lit("")) for n in names} | {"compact_text": without_ws(F.col("raw_text")), "_at": match_pair(F.col("raw_text"), F.col("regex_match_span"), F.col("regex_match_text"))}).drop("_c")
    wide = wide.withColumns({"regex_with_context": kwic(F.col("raw_text"), F.col("_at")), "_t": adjacent_tokens(F.col("raw_text"), F.col("_at"))})
    wide = wide.withColumns({f"token_{n}": F.col(f"_t.{n}") for n in ("left", "right_1", "right_2")}).drop("_t", "_at")
    judged = wide.withColumn("_j", first_match(cautions or [], profile.column()))
    return judged.withColumns({"first_pass_label": F.col("_j.label"), "first_pass_span_status": F.col("_j.span_status"), "first_pass_reason": F.col("_j.reason"), "first_pass_note": F.col("_j.note"), "checked": F.lit("1")}).drop("_j", "compact_text")


def reason_report(rows: DataFrame, per_reason: int = 5, labels: dict[str, str] | None = None) -> DataFrame:
    """(reason, label_text, n, rank, hit_id): counts per reason and its first examples in order of hit id."""
    shown = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), F.col("first_pass_reason")), F.col("first_pass_reason")) if labels else F.col("first_pass_reason")
    first = Window.partitionBy("first_pass_reason").orderBy("hit_id")
    top = rows.select("first_pass_reason", "hit_id").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_reason)  # each task keeps a reason's first few
    counts = rows.groupBy("first_pass_reason").agg(F.count(F.lit(1)).alias("n"))
    same = top["first_pass_reason"].eqNullSafe(counts["first_pass_reason"])
    return top.join(counts, same).drop(counts["first_pass_reason"]).select(F.col("first_pass_reason").alias("reason"), shown.alias("label_text"), "n", "rank", "hit_id")


def value_counts(rows: DataFrame, columns: list[str], zero: dict[str, list[str]] | None = None) -> DataFrame:
    """(column, value, n) of several columns in one pass; values of ``zero`` appear even where there are none."""
    kinds = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns])
    got = rows.select(F.explode(kinds).alias("x")).groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("n"))
    if not zero:
        return got
    want = rows.sparkSession.createDataFrame([(c, v) for c, vs in zero.items() for v in vs], "column string, value string")
    return F.broadcast(want).join(got, ["column", "value"], "full_outer").select("column", "value", F.coalesce("n", F.lit(0)).alias("n"))
