"""The expression compiler: a bundle becomes Column expressions that find, assemble and filter spans.

``detect`` adds ``candidates``, ``rejected`` and ``summary`` to a table of texts without a shuffle
and without Python (but for patterns that can match nothing): matches and components are found by
native regex functions, paths are arrays extended component by component, the best path is the
smallest score struct, merging and verification are array functions. Texts that no detection rule
of the active units can match are told by ``rlike`` and skip all of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bridges import BRIDGES
from ..functions.spans import char_window, cut, merge_gaps, span, span_key, span_text, valid
from ..functions.textfn import SPANS, finditer_spans, java_pattern, let, may_match_empty, without_ws
from .bundle import Bundle, Component, Rule, Unit

_CAND = "array<struct<d:int,neg:int,pen:int,s:int,i:int,e:int,bridge:string>>"
_STRINGS = "array<string>"
_SPAN_MAP = "map<string,struct<s:int,e:int>>"
ANALYSIS = ["partial_component_spans", "partial_span_segments", "partial_span_key", "partial_span_text", "matched_component_ids", "missing_required_component_ids"]
MOST_COMPILED = 1_000  # expressions kept
SOURCES = ["component_spans", "regex_match_fallback", "regex_match"]


@dataclass(frozen=True)
class Options:
    max_matches_per_rule: int = 50
    max_candidates_per_component: int = 20
    max_component_paths: int = 2000
    window_chars: int = 20
    component_window_chars: int = 20
    realtime: bool = False

    def __post_init__(self):
        if self.component_window_chars < 0 or self.window_chars < 0:
            raise ValueError("a window is 0 or wider")
        if min(self.max_matches_per_rule, self.max_candidates_per_component, self.max_component_paths) < 1:
            raise ValueError("caps are 1 or more")


def _tagged(spans: Column, bridge: str | None) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(bridge).cast("string").alias("bridge")))


def component_candidates(text: Column, match: Column, comp: Component, o: Options) -> Column:
    """Ranked places of one component around a match: nearest, longest, literal before bridge, leftmost."""
    lo = F.greatest(F.lit(0), match["s"] - o.component_window_chars)
    hi = F.least(F.length(text), match["e"] + o.component_window_chars)

    def pieces(w: Column) -> list[tuple[Column, str | None]]:
        literal = [(finditer_spans(w, comp.surface), None)] if comp.surface else []
        return literal + ([(BRIDGES[comp.bridge_id].find(w, comp.options), comp.bridge_id)] if comp.bridge_id else [])

    def ranked(w: Column) -> Column:
        found = [_tagged(spans, bridge) for spans, bridge in pieces(w)]
        if not found:
            return F.array().cast(_CAND)
        every = F.concat(*found)

        def unique(a: Column) -> Column:
            return F.filter(a, lambda x, i: ~F.exists(F.slice(a, 1, i), lambda y: (y["s"] == x["s"]) & (y["e"] == x["e"])))

        def scored(x: Column, i: Column) -> Column:
            s, e = x["s"] + lo, x["e"] + lo
            gap = F.when(e <= match["s"], match["s"] - e).when(s >= match["e"], s - match["e"]).otherwise(0)
            return F.struct(gap.cast("int").alias("d"), (s - e).cast("int").alias("neg"), F.when(x["bridge"].isNull(), 0).otherwise(1).alias("pen"), s.cast("int").alias("s"), i.cast("int").alias("i"), e.cast("int").alias("e"), x["bridge"].alias("bridge"))

        return F.slice(F.array_sort(let(every, lambda a: F.transform(unique(a), scored))), 1, o.max_candidates_per_component)

    return let(cut(text, lo, hi), ranked)


def search_debug(text: Column, match: Column, comps: list[Component], o: Options) -> Column:
    """struct(search_start, search_end, candidate_counts): the window that components are looked for in, and how many places each has."""
    counts = F.create_map(*[x for c in comps for x in (F.lit(c.comp_id), F.size(component_candidates(text, match, c, o)))])
    return F.struct(F.greatest(F.lit(0), match["s"] - o.component_window_chars).alias("search_start"), F.least(F.length(text), match["e"] + o.component_window_chars).alias("search_end"), counts.alias("candidate_counts"))


def orders(comps: list[Component]) -> list[list[int]]:
    """Path orders as places in ``comps``: the given one, and each swap of two free neighbours, neither of them the anchor."""
    ranks = [(c.anchor_rank, c.comp_order is None, c.comp_order or 0, c.comp_id) for c in comps if c.anchor_rank is not None]
    anchor = min(ranks)[-1] if ranks else None
    base = list(range(len(comps)))
    out = [base]
    free = lambda k: comps[k].order_policy == "fl" and comps[k].comp_id != anchor
    for k in range(len(comps) - 1):
        if free(k) and free(k + 1):
            out.append([*base[:k], k + 1, k, *base[k + 2 :]])
    return out


def _numbered(paths: Column, which: int, score) -> Column:  # noqa: ANN001
    return F.transform(paths, lambda p, i: score(p, which, i))


def best_path(cands: list[Column], comps: list[Component], o: Options) -> Column:
    """struct(path, order) of the smallest score over all path orders, null where no path holds; ``cands`` by component.

    Paths come in the order of a depth-first search, so a budget of complete paths is a slice, kept while they grow.
    """

    def follows(end: Column, c: Column, before: Component) -> Column:
        gap = c["s"] - end
        ok = gap >= max(0, before.min_gap_to_next or 0)
        return ok & (gap <= before.max_gap_to_next) if before.max_gap_to_next is not None else ok

    def paths(order: list[int]) -> Column:
        places = [cands[k] for k in order]
        before = [comps[k] for k in order]
        if o.max_candidates_per_component ** len(order) <= o.max_component_paths:
            return extended(places, before, None)

        # From the last component to the first, only places from which a path can be completed are left; then
        # every path begun is completed, and at each step the first of them, in search order, are all that is needed.
        def narrowed(k: int, later: list[Column]) -> Column:
            own = places[k] if not later else F.filter(places[k], lambda c: F.exists(later[0], lambda x: follows(c["e"], x, before[k])))
            return let(own, lambda a: narrowed(k - 1, [a, *later]) if k else extended([a, *later], before, o.max_component_paths))

        return narrowed(len(order) - 1, [])

    def extended(places: list[Column], before: list[Component], most: int | None) -> Column:
        out = F.transform(places[0], lambda c: F.array(c))
        for k in range(1, len(places)):
            step = lambda p, k=k: F.transform(F.filter(places[k], lambda c: follows(F.element_at(p, -1)["e"], c, before[k - 1])), lambda c: F.concat(p, F.array(c)))
            out = F.flatten(F.transform(out, lambda p: step(p)))
            if most:
                out = F.slice(out, 1, most)
        return out

    def score(p: Column, which: int, i: Column) -> Column:
        add = lambda f: F.aggregate(p, F.lit(0), lambda acc, c: acc + f(c))
        gaps = F.aggregate(p, F.struct(F.lit(0).alias("g"), F.element_at(p, 1)["s"].alias("at")), lambda acc, c: F.struct((acc["g"] + c["s"] - acc["at"]).alias("g"), c["e"].alias("at")), lambda acc: acc["g"])
        return F.struct(add(lambda c: c["d"]).alias("d"), gaps.alias("g"), add(lambda c: c["neg"]).alias("n"), add(lambda c: c["pen"]).alias("b"), F.element_at(p, 1)["s"].alias("s"), F.lit(which).alias("o"), i.alias("i"), F.transform(p, lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["bridge"].alias("bridge"))).alias("path"))

    every = orders(comps)

    def pick(groups: list[Column]) -> Column:
        """Smallest score, each later order within what the earlier ones leave of the budget."""
        used, scored = F.lit(0), []
        for k, g in enumerate(groups):
            kept = F.slice(g, 1, F.greatest(F.lit(0), F.lit(o.max_component_paths) - used))
            scored.append(_numbered(kept, k, score))
            used = used + F.size(g)
        return F.array_min(F.concat(*scored)) if len(scored) > 1 else F.array_min(scored[0])

    if len(every) == 1:
        return let(paths(every[0]), lambda g: pick([g]))
    named = F.struct(*[paths(x).alias(f"o{k}") for k, x in enumerate(every)])
    return let(named, lambda g: pick([g[f"o{k}"] for k in range(len(every))]))


def _assembled(text: Column, match: Column, comps: list[Component], o: Options) -> Column:
    """What the components of one match give: struct(ok, status, segs, spans, partial, partial_segs, matched, missing, bridges)."""
    ids = [c.comp_id for c in comps]
    named = F.struct(*[component_candidates(text, match, c, o).alias(f"c{k}") for k, c in enumerate(comps)])

    def result(found: Column) -> Column:
        cands = [found[f"c{k}"] for k in range(len(comps))]
        whole = F.lit(True)
        for c in cands:
            whole = whole & (F.size(c) > 0)
        best = F.when(whole, best_path(cands, comps, o))

        def filled(b: Column) -> Column:
            ok = b.isNotNull()
            first = F.filter(F.array(*[F.when(F.size(c) > 0, F.struct(F.lit(i).alias("id"), span(c[0]["s"], c[0]["e"]).alias("x"))) for i, c in zip(ids, cands)]), lambda x: x.isNotNull())
            missing = F.filter(F.array(*[F.when(F.size(c) == 0, F.lit(i)) for i, c in zip(ids, cands)]), lambda x: x.isNotNull())
            partial = let(merge_gaps(text, F.transform(first, lambda x: x["x"])), lambda m: F.when(valid(text, m), m).otherwise(F.array().cast(SPANS)))
            status = F.when(ok, "ok").when(F.size(first) == 0, "missing_required_component").when(~whole, "partial_required_components").otherwise("no_ordered_component_path")
            # The path follows its order; ids are put back beside its places.
            by_order = F.lit(None).cast(_STRINGS)
            for k, order in enumerate(orders(comps)):
                by_order = F.when(b["o"] == k, F.array(*[F.lit(ids[p]) for p in order])).otherwise(by_order)
            pairs = F.zip_with(by_order, b["path"], lambda i, p: F.struct(i.alias("key"), span(p["s"], p["e"]).alias("value")))
            return F.struct(
                ok.alias("ok"),
                status.alias("status"),
                F.when(ok, merge_gaps(text, F.transform(b["path"], lambda p: span(p["s"], p["e"])))).alias("segs"),
                F.when(ok, F.map_from_entries(pairs)).otherwise(F.create_map().cast(_SPAN_MAP)).alias("spans"),
                F.when(ok, F.create_map().cast(_SPAN_MAP)).otherwise(F.map_from_entries(F.transform(first, lambda x: F.struct(x["id"].alias("key"), x["x"].alias("value"))))).alias("partial"),
                F.when(ok, F.array().cast(SPANS)).otherwise(partial).alias("partial_segs"),
                F.when(ok, F.array(*[F.lit(i) for i in sorted(ids)])).otherwise(F.transform(first, lambda x: x["id"])).alias("matched"),
                F.when(ok, F.array().cast(_STRINGS)).otherwise(missing).alias("missing"),
                F.when(ok, F.array_sort(F.array_distinct(F.filter(F.transform(b["path"], lambda p: p["bridge"]), lambda x: x.isNotNull())))).otherwise(F.array().cast(_STRINGS)).alias("bridges"),
            )

        return let(best, filled)

    return let(named, result)


def _strings(values) -> Column:  # noqa: ANN001
    return F.array(*[F.lit(v) for v in values]).cast(_STRINGS)


def _candidate(text: Column, match: Column, unit: Unit, rule: Rule, comps: list[Component], o: Options) -> Column:
    none = F.array().cast(_STRINGS)

    def build(a: Column | None) -> Column:
        own = F.array(span(match["s"], match["e"]))
        segs = F.when(a["ok"], a["segs"]).otherwise(own) if a is not None else own
        source = F.when(a["ok"], "component_spans").otherwise("regex_match_fallback") if a is not None else F.lit("regex_match")
        part = a["partial_segs"] if a is not None else F.array().cast(SPANS)
        return F.struct(
            F.lit(rule.unit_id).alias("origin_e_id"),
            F.lit(unit.unit_id).alias("unit_id"),
            F.lit(unit.unit_type).alias("unit_type"),
            _strings(unit.member_e_ids).alias("member_e_ids"),
            F.lit(unit.group).cast("string").alias("group"),
            F.lit(unit.canonical_form).cast("string").alias("canonical_form"),
            span(match["s"], match["e"]).alias("regex_match_span"),
            cut(text, match["s"], match["e"]).alias("regex_match_text"),
            segs.alias("span_segments"),
            span_key(segs).alias("span_key"),
            span_text(text, segs).alias("span_text"),
            source.alias("span_source"),
            (a["ok"] if a is not None else F.lit(False)).alias("component_span_enabled"),
            (a["status"] if a is not None else F.lit("no_components")).alias("component_span_status"),
            (a["spans"] if a is not None else F.create_map().cast(_SPAN_MAP)).alias("component_spans"),
            (a["partial"] if a is not None else F.create_map().cast(_SPAN_MAP)).alias("partial_component_spans"),
            part.alias("partial_span_segments"),
            span_key(part).alias("partial_span_key"),
            span_text(text, part).alias("partial_span_text"),
            (a["matched"] if a is not None else none).alias("matched_component_ids"),
            (a["missing"] if a is not None else none).alias("missing_required_component_ids"),
            (a["bridges"] if a is not None else none).alias("applied_bridge_ids"),
            _strings(unit.detect_ruleset_ids).alias("detect_ruleset_ids"),
            _strings(unit.verify_ruleset_ids).alias("verify_ruleset_ids"),
            F.array(F.lit(rule.rule_id)).alias("detect_rule_ids"),
            none.alias("hard_fail_rule_ids"),
        )

    return let(_assembled(text, match, comps, o), build) if comps else build(None)


def compiled(df: DataFrame, key: tuple, build) -> Column:  # noqa: ANN001
    """The expression built for ``key``, once per application: a bundle is compiled for its first texts and reused for all later ones."""
    held = df.sparkSession.sparkContext.__dict__.setdefault("_gramspan_compiled", {})
    if key not in held:
        if len(held) >= MOST_COMPILED:
            held.clear()
        held[key] = build()
    return held[key]


def _candidates(text: Column, matches: Column, unit: Unit, rule: Rule, comps: list[Component], o: Options) -> Column:
    return F.transform(matches, lambda m: _candidate(text, m, unit, rule, comps, o))


def merge(found: Column) -> Column:
    """One candidate per unit and span: the first, with the rule ids of all in order."""
    same = lambda x, y: (x["unit_id"] == y["unit_id"]) & (x["span_key"] == y["span_key"])

    def merged(a: Column) -> Column:
        firsts = F.filter(a, lambda x, i: ~F.exists(F.slice(a, 1, i), lambda y: same(x, y)))
        ids = lambda x: F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(a, lambda y: same(x, y)), lambda y: y["detect_rule_ids"]))))
        return F.transform(firsts, lambda x: x.withField("detect_rule_ids", ids(x)))

    return let(found, merged)


def haystack(text: Column, cand: Column, rule: Rule, o: Options) -> Column:
    """Where a verification rule looks; null where its component was not found, which skips the rule."""
    if rule.target == "char_window":
        return char_window(text, cand["span_segments"], o.window_chars)["text"]
    if rule.target not in ("component_right_context", "component_left_context", "component_text", "left_plus_component_text"):
        return text
    at = F.coalesce(F.try_element_at(cand["component_spans"], F.lit(rule.component_id)), F.try_element_at(cand["partial_component_spans"], F.lit(rule.component_id)))
    right = F.left(without_ws(F.substring(text, at["e"] + 1, F.length(text))), F.lit(rule.context))
    left = F.right(without_ws(F.substring(text, F.lit(1), at["s"])), F.lit(rule.context))
    own = cut(text, at["s"], at["e"])
    picked = {"component_right_context": right, "component_left_context": left, "component_text": own, "left_plus_component_text": F.concat(left, own)}[rule.target]
    return F.when(at.isNotNull(), picked)


def hard_fails(text: Column, cand: Column, rules: list[Rule], o: Options) -> Column:
    hits = [F.when(F.coalesce(haystack(text, cand, r, o).rlike(java_pattern(r.pattern)), F.lit(False)), F.lit(r.rule_id)) for r in rules if r.hard_fail]
    return F.filter(F.array(*hits).cast(_STRINGS), lambda x: x.isNotNull()) if hits else F.array().cast(_STRINGS)


def _by_source(cands: Column) -> Column:
    count = lambda name: F.size(F.filter(cands, lambda c: c["span_source"] == name))
    return F.struct(*[count(s).alias(s) for s in SOURCES], F.size(F.filter(cands, lambda c: ~c["span_source"].isin(*SOURCES))).alias("other"))


def detect(df: DataFrame, bundle: Bundle, unit_ids: list[str] | None = None, text_col: str = "raw_text", options: Options | None = None, allow_all: bool = False, allow_polyset: bool = True, only_hits: bool = False) -> DataFrame:
    """``df`` with ``candidates`` (kept), ``rejected`` and ``summary``. Null texts have none. With ``only_hits`` texts without a match are dropped first."""
    o = options or Options()
    units = bundle.select(unit_ids, allow_all, allow_polyset)
    text = F.col(text_col)
    runs = [(u, r) for u in units for k in u.detect_ruleset_ids for r in bundle.rules_of(k, "detect")]
    verify = {u.unit_id: [r for k in u.verify_ruleset_ids for r in bundle.rules_of(k, "verify")] for u in units}
    any_rule = F.lit(False)
    for p in dict.fromkeys(r.pattern for _, r in runs):
        any_rule = any_rule | (F.lit(True) if may_match_empty(p) else text.rlike(java_pattern(p)))
    hit = F.coalesce(any_rule, F.lit(False))
    if only_hits:
        df = df.where(hit)
    # One column per rule, with one match more than the cap to tell truncation.
    spans = [compiled(df, ("spans", text_col, r.pattern, o.max_matches_per_rule), lambda r=r: finditer_spans(text, r.pattern, o.max_matches_per_rule + 1)) for _, r in runs]
    names = {f"_m{k}": F.when(hit, x) for k, x in enumerate(spans)}
    staged = df.withColumns(names) if names else df
    matches = [F.slice(F.coalesce(F.col(f"_m{k}"), F.array().cast(SPANS)), 1, o.max_matches_per_rule) for k in range(len(runs))]
    comps = [bundle.components_of(r.unit_id) for _, r in runs]
    arrays = [compiled(df, ("candidates", text_col, k, u, r, tuple(c), o), lambda m=m, u=u, r=r, c=c: _candidates(text, m, u, r, c, o)) for k, (m, (u, r), c) in enumerate(zip(matches, runs, comps))]
    if not arrays:
        raise ValueError("the active units have no detection rule")
    found = F.concat(*arrays) if len(arrays) > 1 else arrays[0]

    def verified(c: Column) -> Column:
        out = F.array().cast(_STRINGS)
        for u in units:
            if verify[u.unit_id]:
                out = F.when(c["unit_id"] == u.unit_id, hard_fails(text, c, verify[u.unit_id], o)).otherwise(out)
        return c.withField("hard_fail_rule_ids", out)

    staged = staged.withColumn("_all", F.transform(merge(found), verified))
    passed = lambda c: F.size(c["hard_fail_rule_ids"]) == 0
    kept = F.filter("_all", passed)
    shown = F.transform(F.filter(kept, lambda c: c["span_source"] != "regex_match_fallback"), lambda c: c.dropFields(*ANALYSIS)) if o.realtime else kept
    sizes = [F.size(m) for m in matches]
    over = [F.when(F.size(F.coalesce(F.col(f"_m{k}"), F.array().cast(SPANS))) > o.max_matches_per_rule, 1).otherwise(0) for k in range(len(runs))]
    add = lambda xs: sum(xs[1:], xs[0])
    hidden = F.size(F.filter(kept, lambda c: c["span_source"] == "regex_match_fallback")) if o.realtime else F.lit(0)
    summary = F.struct(add(sizes).alias("n_detect_matches"), F.size("_all").alias("n_candidates_before_verify"), (F.size(kept) - hidden).alias("n_candidates_after_verify"), (F.size("_all") - F.size(kept)).alias("n_candidates_hard_failed"), add(over).alias("n_matches_truncated"), hidden.alias("n_candidates_hidden_realtime"), _by_source(shown).alias("span_source_counts"), _by_source(F.col("_all")).alias("span_source_counts_before_verify"))
    rejected = F.filter("_all", lambda c: ~passed(c))
    if o.realtime:
        rejected = F.slice(rejected, 1, 0)
    return staged.withColumns({"candidates": shown, "rejected": rejected, "summary": summary}).drop("_all", *names)


def each(df: DataFrame, *keep: str, what: str = "candidates") -> DataFrame:
    """One row per candidate ``c`` with its place ``k``.

    An outer explode with a filter behind it: for a plain one the optimizer adds a filter on the array's
    size below it, which would work out all candidates a second time.
    """
    return df.select(*keep, F.posexplode_outer(what).alias("k", "c")).where("k is not null")
