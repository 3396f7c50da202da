"""Compiled detection against a plain enumeration written for this test."""

import re
from itertools import product

from pyspark.sql import functions as F

from gramspan.functions.hangul import syllables_with
from gramspan.operators.bundle import Bundle, Component, Rule, Unit, violations
from gramspan.operators.detect import Options, detect, orders

COMPS = [
    Component("u1", "c1", "본/은", comp_order=1, anchor_rank=2, order_policy="fl", max_gap_to_next=2, bridge_id="adnominal_n"),
    Component("u1", "c2", "적", comp_order=2, anchor_rank=1, max_gap_to_next=3),
    Component("u1", "c3", "있/없", comp_order=3, order_policy="fl"),
]
FREE = [Component("u2", "a", "가", comp_order=1, order_policy="fl", max_gap_to_next=4), Component("u2", "b", "나", comp_order=2, order_policy="fl", max_gap_to_next=4)]
RULES = [
    Rule("u1", "d1", "r1", "detect", r"적[이은도]?\s*[있없]"),
    Rule("u1", "d1", "r2", "detect", r"[가-힣]\s*적", priority=1),
    Rule("u2", "d2", "r3", "detect", r"[가나]다?"),
    Rule("u1", "v1", "v1", "verify", "밥", "component_right_context", hard_fail=True, component_id="c3", context_chars=3),
    Rule("u1", "v1", "v2", "verify", "물", "char_window", hard_fail=True),
    Rule("u1", "v1", "v3", "verify", "^불", "raw_sentence", hard_fail=False),
    Rule("u1", "v1", "v4", "verify", "술$", "component_left_context", hard_fail=True, component_id="c2", context_chars=2),
]
BUNDLE = Bundle([Unit("u1", "item", "c", ("u1",), "적 있", None, ("d1",), ("v1",)), Unit("u2", "polyset", "a", ("x", "y"), "가나", None, ("d2",), ())], RULES, COMPS + FREE)
TEXTS = ["한국에 가 본 적이 있어요", "본 적 없다 밥", "먹은 적은　있다", "적이 있다", "가 나 나다 가", "나가나가", "", None, "😀 본 적이 있고 본 적도 없다", "술 적이 있다", "본 적 있 물", "적" * 60, "적 있 적 없 본 적", "없 적 본 있"]


def places(text, comp, lo, hi):
    window, out = text[lo:hi], []
    if comp.surface:
        out += [(m.start() + lo, m.end() + lo, None) for m in re.finditer(comp.surface, window)]
    if comp.bridge_id:
        out += [(m.start() + lo, m.end() + lo, comp.bridge_id) for p in ("[ㄴᆫ]|은", f"[{syllables_with('ㄴ')}]") for m in re.finditer(p, window)]
    seen, kept = set(), []
    for x in out:
        if x[:2] not in seen:
            seen.add(x[:2])
            kept.append(x)
    return kept


def glue(text, spans):
    out = []
    for s, e in sorted(spans):
        if out and not text[out[-1][1] : s].strip():
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def expected(text, unit, o):
    found = {}
    for rs in unit.detect_ruleset_ids:
        for rule in BUNDLE.rules_of(rs, "detect"):
            for m in list(re.finditer(rule.pattern, text))[: o.max_matches_per_rule]:
                comps = BUNDLE.components_of(rule.unit_id)
                lo, hi = max(0, m.start() - o.component_window_chars), min(len(text), m.end() + o.component_window_chars)
                dist = lambda s, e: m.start() - e if e <= m.start() else max(0, s - m.end())
                cands = []
                for c in comps:
                    got = places(text, c, lo, hi)
                    order = sorted(range(len(got)), key=lambda k: (dist(*got[k][:2]), got[k][0] - got[k][1], got[k][2] is not None, got[k][0]))
                    cands.append([got[k] for k in order][: o.max_candidates_per_component])
                best = None
                if all(cands):
                    for n, order in enumerate(orders(comps)):
                        for i, path in enumerate(product(*[cands[k] for k in order])):
                            gaps = [b[0] - a[1] for a, b in zip(path, path[1:])]
                            ok = all(g >= max(0, comps[k].min_gap_to_next or 0) and g <= (comps[k].max_gap_to_next if comps[k].max_gap_to_next is not None else 10**9) for g, k in zip(gaps, order))
                            if ok:
                                key = (sum(dist(*p[:2]) for p in path), sum(gaps), sum(p[0] - p[1] for p in path), sum(p[2] is not None for p in path), path[0][0], n, i)
                                if best is None or key < best[0]:
                                    best = (key, path)
                if best:
                    segs, source = glue(text, [p[:2] for p in best[1]]), "component_spans"
                    full = dict(zip([comps[k].comp_id for k in orders(comps)[best[0][5]]], [p[:2] for p in best[1]]))
                else:
                    segs, source = [m.span()], "regex_match_fallback"
                    full = {c.comp_id: x[0][:2] for c, x in zip(comps, cands) if x}
                found.setdefault("|".join(f"{s}:{e}" for s, e in segs), [source, set(), full, segs])[1].add(rule.rule_id)
    out = []
    for key, (source, ids, full, segs) in found.items():
        fails = []
        for rule in RULES:
            if rule.stage != "verify" or rule.ruleset_id not in unit.verify_ruleset_ids or not rule.hard_fail:
                continue
            hay = text
            if rule.target == "char_window":
                hay = text[max(0, min(s for s, _ in segs) - 20) : max(e for _, e in segs) + 20]
            elif rule.component_id:
                if rule.component_id not in full:
                    continue
                s, e = full[rule.component_id]
                hay = "".join(text[e:].split())[: rule.context] if "right" in rule.target else "".join(text[:s].split())[-rule.context :]
            if re.search(rule.pattern, hay):
                fails.append(rule.rule_id)
        out.append((unit.unit_id, key, source, tuple(sorted(ids)), tuple(fails)))
    return out


def test_detect_equals_enumeration(spark):
    o = Options(component_window_chars=8)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "id int, raw_text string")
    rows = {r.id: r for r in detect(df, BUNDLE, ["u1", "u2"], options=o).collect()}
    for k, t in enumerate(TEXTS):
        want = [] if t is None else [x for u in BUNDLE.units for x in expected(t, u, o)]
        pick = lambda cs: [(c.unit_id, c.span_key, c.span_source, tuple(c.detect_rule_ids), tuple(c.hard_fail_rule_ids)) for c in cs]
        assert pick(rows[k].candidates) == [x for x in want if not x[4]], t
        assert pick(rows[k].rejected) == [x for x in want if x[4]], t
        if t is not None:
            assert rows[k].summary.n_candidates_before_verify == len(want)


def test_truncation_and_realtime(spark):
    df = spark.createDataFrame([("적" * 120,)], "raw_text string")
    row = detect(df, Bundle([Unit("u", detect_ruleset_ids=("d",))], [Rule("u", "d", "r", "detect", "적")]), ["u"]).first()
    assert row.summary.n_detect_matches == 50 and row.summary.n_matches_truncated == 1
    df = spark.createDataFrame([("적이 있다",)], "raw_text string")
    live = detect(df, BUNDLE, ["u1"], options=Options(realtime=True)).first()
    assert live.candidates == [] and live.summary.n_candidates_hidden_realtime == 1


def test_selection_and_violations():
    assert [c for c, _ in violations(BUNDLE)] == ["warn_verify_not_hard"]
    broken = Bundle([Unit("u", group="z", detect_ruleset_ids=("d", "none"))], [Rule("w", "d", "r", "detect", "r'x'"), Rule("u", "d", "r", "verify", "(", "component_text")])
    codes = {c for c, _ in violations(broken)}
    assert {"unit_group", "duplicate_rule", "rule_python_literal", "rule_pattern", "rule_component", "ruleset_mixed_stage", "ruleset_missing", "ruleset_owner"} <= codes
    for bad in (lambda: BUNDLE.select([]), lambda: BUNDLE.select(["nope"]), lambda: BUNDLE.select(["u2"])):
        try:
            bad()
        except ValueError:
            continue
        raise AssertionError


def test_two_free_neighbours_may_swap():
    assert orders(FREE) == [[0, 1], [1, 0]]
    assert orders(COMPS) == [[0, 1, 2]]
