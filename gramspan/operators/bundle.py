"""Rule catalogues: loading, building from tables, and constraint checks.

A bundle is metadata of some kilobytes that compiles into Column expressions; it lives on the
driver. The constraint checks are also given as queries over tables of rules and components.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bridges import BRIDGES
from ..functions.textfn import blank_to_null, java_pattern, trim_ws

SCHEMA_VERSION = "detector_bundle_v1"
GROUPS, STAGES, POLICIES = ("a", "b", "c"), ("detect", "verify"), ("fx", "fl")
SCOPED = ("component_right_context", "component_left_context", "component_text", "left_plus_component_text")
TARGETS = {"detect": ("raw_sentence",), "verify": ("raw_sentence", "char_window", *SCOPED)}
TRUE, FALSE = {"1", "true", "t", "yes", "y"}, {"0", "false", "f", "no", "n", ""}


@dataclass(frozen=True)
class Rule:
    unit_id: str
    ruleset_id: str
    rule_id: str
    stage: str
    pattern: str
    target: str = "raw_sentence"
    priority: int = 0
    hard_fail: bool = False
    component_id: str | None = None
    context_chars: int | None = None

    @property
    def context(self) -> int:
        """Characters of context, 1 to 20; 1 where none is given."""
        return max(1, min(20, self.context_chars or 1))


@dataclass(frozen=True)
class Component:
    unit_id: str
    comp_id: str
    comp_surf: str = ""
    is_required: bool = True
    anchor_rank: int | None = None
    comp_order: int | None = None
    order_policy: str = "fx"
    min_gap_to_next: int | None = None
    max_gap_to_next: int | None = None
    bridge_id: str | None = None

    @property
    def options(self) -> list[str]:
        return [x for x in (p.strip() for p in self.comp_surf.split("/")) if x]

    @property
    def surface(self) -> str | None:
        """Alternation of the literal surfaces, the longest first."""
        found = sorted(self.options, key=len, reverse=True)
        return "|".join(map(re.escape, found)) if found else None


@dataclass(frozen=True)
class Unit:
    unit_id: str
    unit_type: str = "item"
    group: str | None = None
    member_e_ids: tuple[str, ...] = ()
    canonical_form: str | None = None
    gloss: str | None = None
    detect_ruleset_ids: tuple[str, ...] = ()
    verify_ruleset_ids: tuple[str, ...] = ()
    task_unit_kind: str | None = None


@dataclass
class Bundle:
    units: list[Unit]
    rules: list[Rule]
    components: list[Component] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    source: dict[str, Any] = field(default_factory=dict)

    def rules_of(self, ruleset_id: str, stage: str) -> list[Rule]:
        own = [r for r in self.rules if r.ruleset_id == ruleset_id and r.stage == stage]
        return sorted(own, key=lambda r: (r.priority, r.rule_id))

    def components_of(self, unit_id: str) -> list[Component]:
        """Required components of the rule's unit in path order."""
        own = [c for c in self.components if c.unit_id == unit_id and c.is_required]
        return sorted(own, key=lambda c: (c.comp_order is None, c.comp_order or 0, c.comp_id))

    def select(self, unit_ids: list[str] | None, allow_all: bool = False, allow_polyset: bool = False) -> list[Unit]:
        """Units in the order asked for; all of them, sorted, only where that is allowed."""
        known = {u.unit_id: u for u in self.units}
        if not unit_ids:
            if not allow_all:
                raise ValueError("name the active units, or allow all")
            unit_ids = sorted(known)
        missing = [u for u in unit_ids if u not in known]
        if missing:
            raise ValueError(f"unknown units: {missing}")
        chosen = [known[u] for u in unit_ids]
        many = [u.unit_id for u in chosen if u.unit_type == "polyset"]
        if many and not allow_polyset:
            raise ValueError(f"polysets need allow_polyset: {many}")
        return chosen


def load(path: str) -> Bundle:
    """A bundle from its JSON file."""
    raw = json.loads(Path(path).read_text("utf-8"))
    pick = lambda kind, row: kind(**{k: v for k, v in row.items() if k in kind.__dataclass_fields__ and v is not None})
    rules = [pick(Rule, {"unit_id": r.get("unit_id") or r.get("e_id")} | {k: v for k, v in r.items() if k != "unit_id"} | {"ruleset_id": key}) for key, own in raw.get("rules_by_ruleset_id", {}).items() for r in own]
    comps = [pick(Component, {k: v for k, v in c.items() if k != "unit_id"} | {"unit_id": key}) for key, own in raw.get("components_by_e_id", {}).items() for c in own]
    lists = ("member_e_ids", "detect_ruleset_ids", "verify_ruleset_ids")
    units = [pick(Unit, u | {k: tuple(u.get(k) or ()) for k in lists}) for u in raw.get("runtime_units", [])]
    return Bundle(units, rules, comps, list(raw.get("warnings", [])), raw.get("source", {}))


def save(bundle: Bundle, path: str) -> None:
    """Writes the JSON file that ``load`` reads."""
    rules, comps = defaultdict(list), defaultdict(list)
    for r in bundle.rules:
        rules[r.ruleset_id].append(asdict(r))
    for c in bundle.components:
        comps[c.unit_id].append(asdict(c))
    out = {"schema_version": SCHEMA_VERSION, "source": bundle.source, "rules_by_ruleset_id": rules, "components_by_e_id": comps, "runtime_units": [asdict(u) for u in bundle.units], "warnings": bundle.warnings}
    Path(path).write_text(json.dumps(out, ensure_ascii=False, indent=2), "utf-8")


def provenance(path: str) -> dict[str, str]:
    return {"path": path, "sha256": hashlib.sha256(Path(path).read_bytes()).hexdigest(), "created_at": datetime.now(UTC).isoformat(timespec="seconds")}


def to_bool(value: Any, default: bool = False) -> bool:
    text = str(value).strip().lower() if value is not None and value == value else ""
    if text == "" and value is not False:
        return default
    if text in TRUE or text.endswith(".0") and text[:-2] in TRUE:
        return True
    if text in FALSE or text.endswith(".0") and text[:-2] in FALSE:
        return False
    raise ValueError(f"not a truth value: {value!r}")


def id_list(value: Any) -> list[str]:
    return [] if value is None or value != value else [x for x in (p.strip() for p in str(value).split(";")) if x]


def literal_lint(pattern: str) -> bool:
    """Whether a pattern looks like a Python literal instead of its content."""
    return re.fullmatch(r"[rR]?(['\"]).*\1", pattern.strip(), re.S) is not None


def violations(bundle: Bundle) -> list[tuple[str, str]]:
    """(code, id) of every broken constraint; empty for a sound bundle."""
    out: list[tuple[str, str]] = []
    add = lambda code, *ids: out.extend((code, str(i)) for i in ids)
    repeated = lambda xs: sorted({x for x in xs if xs.count(x) > 1})
    units, sets = {u.unit_id for u in bundle.units}, defaultdict(list)
    members = units | {m for u in bundle.units for m in u.member_e_ids}
    add("duplicate_unit", *repeated([u.unit_id for u in bundle.units]))
    add("duplicate_rule", *repeated([r.rule_id for r in bundle.rules]))
    add("unit_group", *[u.unit_id for u in bundle.units if u.group not in (None, "mixed", *GROUPS)])
    comps = defaultdict(set)
    for c in bundle.components:
        comps[c.unit_id].add(c.comp_id)
        if c.unit_id not in members:
            add("component_unit", c.comp_id)
        if c.bridge_id and c.bridge_id not in BRIDGES:
            add("component_bridge", c.comp_id)
        if c.order_policy not in POLICIES:
            add("component_order_policy", c.comp_id)
    for r in bundle.rules:
        sets[r.ruleset_id].append(r)
        if r.stage not in STAGES:
            add("rule_stage", r.rule_id)
        elif r.target not in TARGETS[r.stage]:
            add("rule_target", r.rule_id)
        if r.target in SCOPED and r.component_id not in comps[r.unit_id]:
            add("rule_component", r.rule_id)
        if r.context_chars is not None and not 1 <= r.context_chars <= 20:
            add("rule_context_chars", r.rule_id)
        if literal_lint(r.pattern):
            add("rule_python_literal", r.rule_id)
        try:
            java_pattern(r.pattern)
        except re.error:
            add("rule_pattern", r.rule_id)
        if r.stage == "verify" and not r.hard_fail:
            add("warn_verify_not_hard", r.rule_id)
    add("ruleset_mixed_stage", *sorted(k for k, own in sets.items() if len({r.stage for r in own}) > 1))
    used = set()
    for u in bundle.units:
        for stage, ids in (("detect", u.detect_ruleset_ids), ("verify", u.verify_ruleset_ids)):
            for k in ids:
                used.add(k)
                if not any(r.stage == stage for r in sets.get(k, [])):
                    add("ruleset_missing", k)
                if any(r.unit_id not in {u.unit_id, *u.member_e_ids} for r in sets.get(k, [])):
                    add("ruleset_owner", k)
    add("warn_ruleset_unreferenced", *sorted(set(sets) - used))
    return out


# ---- the same over tables -------------------------------------------------------------------------------------


def required_columns(df: DataFrame, needed: list[str]) -> list[str]:
    """Columns that are missing."""
    return [c for c in needed if c not in {x.strip() for x in df.columns}]


def item_violations(items: DataFrame) -> DataFrame:
    """(code, id): repeated or blank ids, unknown groups, group c without a unit of its own."""
    e, g, ps = blank_to_null("e_id"), F.lower(blank_to_null("group")), F.coalesce(blank_to_null("ps_id"), blank_to_null("polyset_id"))
    rows = items.select(e.alias("id"), g.alias("g"), ps.alias("ps"))
    repeated = rows.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("item_duplicate").alias("code"), "id")
    checks = F.array(F.when(F.col("id").isNull(), "item_blank_id"), F.when(F.col("g").isNotNull() & ~F.col("g").isin(*GROUPS), "item_group"), F.when((F.col("g") == "c") & F.col("ps").isNull(), "warn_c_without_ps"))
    return repeated.unionByName(rows.select(F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("code"), "id"))


def member_violations(units: DataFrame, items: DataFrame) -> DataFrame:
    """(unit_id, member) of unit members that no item has."""
    members = units.select("unit_id", F.explode("member_e_ids").alias("member"))
    return members.join(items.select(blank_to_null("e_id").alias("member")).distinct(), "member", "left_anti").select("unit_id", "member")


def unit_of(*ids: str) -> Column:
    """The first of several id columns that isn't blank."""
    return F.coalesce(*[blank_to_null(c) for c in ids])


def unit_violations(units: DataFrame, items: DataFrame) -> DataFrame:
    """(code, id): repeated units, members without an item, members that another unit claims, several members outside group c."""
    again = units.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("unit_duplicate").alias("code"), F.col("unit_id").alias("id"))
    lacking = member_violations(units, items).select(F.lit("unit_member").alias("code"), F.col("unit_id").alias("id"))
    owner = items.select(blank_to_null("e_id").alias("member"), unit_of("ps_id", "polyset_id").alias("owner"))
    claimed = units.where(F.size("member_e_ids") > 1).select("unit_id", F.explode("member_e_ids").alias("member")).join(owner, "member").where("owner is not null and owner <> unit_id").select(F.lit("unit_claimed").alias("code"), F.col("unit_id").alias("id"))
    several = units.where((F.size("member_e_ids") > 1) & ~F.coalesce(F.lower(blank_to_null("group")) == "c", F.lit(False))).select(F.lit("warn_members_outside_c").alias("code"), F.col("unit_id").alias("id"))
    return again.unionByName(lacking).unionByName(claimed).unionByName(several)


def unit_rulesets(items: DataFrame, units: DataFrame | None = None) -> DataFrame:
    """(unit_id, detect_ruleset_ids): a unit's own rulesets where a row names them, else those of its members in order."""
    rows = items.select(unit_of("ps_id", "polyset_id", "e_id").alias("unit_id"), blank_to_null("e_id").alias("e_id"), blank_to_null("detect_ruleset_id").alias("r")).where("e_id is not null")
    own = rows.groupBy("unit_id").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("r").isNotNull(), F.struct("e_id", "r")))), lambda x: x["r"]).alias("derived"))
    if units is None:
        return own.select("unit_id", F.col("derived").alias("detect_ruleset_ids"))
    named = units.select("unit_id", F.col("detect_ruleset_ids").alias("named"))
    both = own.join(named, "unit_id", "full_outer")
    return both.select("unit_id", F.when(F.size("named") > 0, F.col("named")).otherwise(F.coalesce("derived", F.array().cast("array<string>"))).alias("detect_ruleset_ids"))


def polysets(items: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """Units of items that share a polyset id: form, gaps allowed, components, members, and the gloss for an encoder.

    The derived form is the members' common one without trailing digits, or all their forms joined by ``/``. A row of
    ``explicit`` (ps_id, canonical_form, gloss_intro) wins over what is derived, and its intro comes before the glosses.
    """
    form = F.coalesce(blank_to_null("canonical_form"), blank_to_null("e_id"))
    rows = items.select(unit_of("ps_id", "polyset_id").alias("ps_id"), blank_to_null("e_id").alias("e_id"), form.alias("form"), "disconti_allowed", "e_comp_ids", blank_to_null("gloss").alias("gloss")).where("ps_id is not null and e_id is not null")
    got = rows.groupBy("ps_id").agg(
        F.array_sort(F.collect_set("e_id")).alias("member_e_ids"),
        F.array_sort(F.collect_set(F.struct("e_id", "form", "gloss"))).alias("own"),
        F.coalesce(F.bool_or("disconti_allowed"), F.lit(False)).alias("disconti_allowed"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("e_comp_ids", F.array().cast("array<string>")))))).alias("ps_comp_ids"),
    )
    forms = F.transform("own", lambda x: x["form"])
    bare = F.array_distinct(F.transform(forms, lambda x: trim_ws(F.regexp_replace(x, r"\d+$", ""))))
    derived = F.when(F.size(bare) == 1, bare[0]).otherwise(F.array_join(forms, "/"))
    gloss = F.array_join(F.filter(F.transform("own", lambda x: F.nullif(F.regexp_replace(x["gloss"], r"\.+$", ""), F.lit(""))), lambda x: x.isNotNull()), "; ")
    made = got.select("ps_id", "member_e_ids", derived.alias("canonical_form"), "disconti_allowed", "ps_comp_ids", gloss.alias("encoder_gloss"))
    if explicit is None:
        return made
    stated = explicit.select(blank_to_null("ps_id").alias("ps_id"), blank_to_null("canonical_form").alias("_form"), blank_to_null("gloss_intro").alias("_intro")).where("ps_id is not null").dropDuplicates(["ps_id"])
    both = made.join(stated, "ps_id", "full_outer")
    return both.select("ps_id", "member_e_ids", F.coalesce("_form", "canonical_form").alias("canonical_form"), "disconti_allowed", "ps_comp_ids", F.concat_ws(" ", "_intro", F.nullif(F.col("encoder_gloss"), F.lit(""))).alias("encoder_gloss"))


#: The tables of a dictionary workbook and the columns that they must have.
SHEETS = {
    "items": ("e_id", "canonical_form", "group", "gloss"),
    "rule_components": ("comp_surf", "comp_id", "is_required", "anchor_rank", "comp_order", "order_policy", "min_gap_to_next", "max_gap_to_next"),
    "detect_rules": ("ruleset_id", "rule_id", "stage", "target", "pattern", "priority", "hard_fail"),
}
UNIT_IDS = ("unit_id", "ps_id", "e_id")
MOST_ROWS = 200_000  # rows of a dictionary that may become one bundle


def tidy_items(items: DataFrame) -> DataFrame:
    """Items of a sheet or table with all columns that units are made from; truth values and id lists may be text."""
    kinds = dict(items.dtypes)
    truth = lambda c: F.lower(F.trim(F.col(c))).isin(*TRUE) | F.lower(F.trim(F.col(c))).isin(*[f"{x}.0" for x in TRUE])
    split = lambda c: F.filter(F.transform(F.split(F.regexp_replace(F.col(c), r'[\\[\\]"]', ""), "[;,]"), lambda x: F.trim(x)), lambda x: x != "")
    made = {c: F.lit(None).cast("string") for c in ("ps_id", "polyset_id") if c not in kinds}
    for c, kind, read in (("disconti_allowed", "boolean", truth), ("e_comp_ids", "array<string>", split)):
        if kinds.get(c) != kind:
            made[c] = read(c) if c in kinds else F.lit(None).cast(kind)
    return items.withColumns(made) if made else items


def from_tables(items: DataFrame, components: DataFrame, rules: DataFrame, explicit: DataFrame | None = None) -> Bundle:
    """A bundle of a dictionary's tables; lacking columns are an error. Rows of components and rules belong to the first of their ids that isn't blank."""
    lacking = {name: required_columns(df, list(SHEETS[name])) for name, df in (("items", items), ("rule_components", components), ("detect_rules", rules))}
    for name, df in (("rule_components", components), ("detect_rules", rules)):
        if not set(UNIT_IDS) & set(df.columns):
            lacking[name].append("/".join(UNIT_IDS))
    if any(lacking.values()):
        raise ValueError(f"columns lacking: { {k: v for k, v in lacking.items() if v} }")

    items = tidy_items(items)

    def rows_of(df: DataFrame) -> list[dict[str, Any]]:
        found = df.limit(MOST_ROWS + 1).collect()  # metadata: a dictionary is compiled on the driver
        if len(found) > MOST_ROWS:
            raise ValueError(f"over {MOST_ROWS} rows in a dictionary table")
        return [{k: v if not isinstance(v, str) or v.strip() else None for k, v in r.asDict().items()} for r in found]

    owner = lambda r: next((str(r[k]).strip() for k in UNIT_IDS if r.get(k)), "")
    number = lambda v: None if v is None else int(float(v))
    comps = [Component(owner(r), r["comp_id"], r["comp_surf"] or "", to_bool(r["is_required"], True), number(r["anchor_rank"]), number(r["comp_order"]), r["order_policy"] or "fx", number(r["min_gap_to_next"]), number(r["max_gap_to_next"]), r.get("bridge_id")) for r in rows_of(components)]
    made = [Rule(owner(r), r["ruleset_id"], r["rule_id"], r["stage"], r["pattern"], r["target"] or "raw_sentence", number(r["priority"]) or 0, to_bool(r["hard_fail"]), r.get("component_id"), number(r.get("context_chars"))) for r in rows_of(rules)]
    sets = unit_rulesets(items).select("unit_id", "detect_ruleset_ids") if "detect_ruleset_id" in items.columns else None
    units = runtime_units(items)
    units = units.join(sets, "unit_id", "left") if sets is not None else units.withColumn("detect_ruleset_ids", F.lit(None))
    forms = polysets(items, explicit).select(F.col("ps_id").alias("unit_id"), F.col("canonical_form").alias("form"), F.col("encoder_gloss").alias("gloss"))
    single = items.select(blank_to_null("e_id").alias("unit_id"), blank_to_null("canonical_form").alias("own_form")).dropDuplicates(["unit_id"])
    wide = units.join(forms, "unit_id", "left").join(single, "unit_id", "left")
    staged = {(r.ruleset_id, r.stage) for r in made}
    out = []
    for r in sorted(rows_of(wide), key=lambda r: r["unit_id"]):
        ids = tuple(r["detect_ruleset_ids"] or ())
        kind = "multi_member" if r["n_members"] > 1 else "single_member"
        out.append(Unit(r["unit_id"], r["unit_type"], r["group"], tuple(r["member_e_ids"].split(";")), r["form"] or r["own_form"], r["gloss"], ids, tuple(k for k in ids if (k, "verify") in staged), kind))
    return Bundle(out, made, comps)


def runtime_units(items: DataFrame) -> DataFrame:
    """(unit_id, unit_type, group, member_e_ids, n_members): items without a polyset, and polysets."""
    rows = items.select(F.coalesce(blank_to_null("ps_id"), blank_to_null("polyset_id")).alias("ps"), blank_to_null("e_id").alias("e_id"), F.lower(blank_to_null("group")).alias("g")).where("e_id is not null")
    got = rows.groupBy(F.coalesce("ps", "e_id").alias("unit_id")).agg(F.array_sort(F.collect_set("e_id")).alias("members"), F.countDistinct("g").alias("n_groups"), F.min("g").alias("g"))
    kind = F.when(F.size("members") > 1, "polyset").otherwise("item")
    return got.select("unit_id", kind.alias("unit_type"), F.when(F.col("n_groups") > 1, "mixed").otherwise(F.col("g")).alias("group"), F.array_join("members", ";").alias("member_e_ids"), F.size("members").alias("n_members"))
