"""Structural comparison of a unit's catalogue in two places, by flattened paths."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bundle import Bundle

MISSING = "<missing>"
COMPARED = ("stage", "target", "pattern", "priority", "hard_fail", "component_id")


def unit_slice(bundle: Bundle, unit_id: str) -> dict[str, Any]:
    """The unit, its components and rules in canonical types and order; id lists as sorted sets, blank as null."""
    unit = next((u for u in bundle.units if u.unit_id == unit_id), None)
    own = {unit_id, *(unit.member_e_ids if unit else ())}
    none = lambda v: None if isinstance(v, str) and not v.strip() else v
    rules = sorted((r for r in bundle.rules if r.unit_id in own), key=lambda r: (r.ruleset_id, r.rule_id))
    comps = sorted((c for c in bundle.components if c.unit_id in own), key=lambda c: (c.unit_id, c.comp_id))
    fields = lambda x: {k: none(getattr(x, k)) for k in x.__dataclass_fields__}
    return {
        "unit": None if unit is None else {k: sorted(set(v)) if isinstance(v, tuple) else none(v) for k, v in ((k, getattr(unit, k)) for k in unit.__dataclass_fields__)},
        "components": [fields(c) for c in comps],
        "rules": [{"rule_id": r.rule_id, "ruleset_id": r.ruleset_id} | {k: none(getattr(r, k)) for k in COMPARED} for r in rules],
    }


def paths(value: Any, at: str = "$") -> list[tuple[str, str | None]]:
    """(path, value as text) of every leaf; empty lists and maps are leaves."""
    if isinstance(value, dict) and value:
        return [x for k in sorted(value) for x in paths(value[k], f"{at}.{k}")]
    if isinstance(value, (list, tuple)) and value:
        return [x for i, v in enumerate(value) for x in paths(v, f"{at}[{i}]")]
    if value is None:
        return [(at, None)]
    return [(at, str(value).lower() if isinstance(value, bool) else "[]" if isinstance(value, (list, tuple)) else "{}" if isinstance(value, dict) else str(value))]


def diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """(path, expected, actual) where two flattened tables (path, value) differ: a full outer join on the path."""
    a = left.select("path", F.col("value").alias("a"), F.lit(True).alias("in_a"))
    b = right.select("path", F.col("value").alias("b"), F.lit(True).alias("in_b"))
    both = a.join(b, "path", "full_outer")
    there = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    return both.where(~(there & F.col("a").eqNullSafe(F.col("b")))).select("path", F.when(F.col("in_a").isNull(), MISSING).otherwise(F.col("a")).alias("expected"), F.when(F.col("in_b").isNull(), MISSING).otherwise(F.col("b")).alias("actual"))


def sync_report(spark: SparkSession, expected: Bundle, actual: Bundle, unit_id: str) -> dict[str, Any]:
    kind = "path string, value string"
    found = diff(spark.createDataFrame(paths(unit_slice(expected, unit_id)), kind), spark.createDataFrame(paths(unit_slice(actual, unit_id)), kind)).orderBy("path").collect()
    return {"unit_id": unit_id, "in_sync": not found, "diff_count": len(found), "diffs": [r.asDict() for r in found], "compared_fields": list(COMPARED)}
