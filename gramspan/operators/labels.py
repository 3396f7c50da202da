"""Human labels: normalisation, summaries over review files, and the decision what to do next."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textfn import blank_to_null, trim_ws

#: Aliases of labels and span statuses.
LABELS = {
    "tp": "tp", "t": "tp", "true_positive": "tp", "true positive": "tp", "positive": "tp", "pos": "tp",
    "fp": "fp", "f": "fp", "false_positive": "fp", "false positive": "fp", "negative": "fp", "neg": "fp",
    "unclear": "unclear", "unsure": "unclear", "unknown": "unclear", "?": "unclear",
}
STATUSES = {
    "ok": "ok", "o": "ok",
    "span_wrong": "span_wrong", "span wrong": "span_wrong", "wrong": "span_wrong",
    "not_applicable": "not_applicable", "not applicable": "not_applicable", "na": "not_applicable", "n/a": "not_applicable", "none": "not_applicable",
}
BATCH = r"(?i)batch[_-]([0-9]{3,})"


def _aliased(value: Column, aliases: dict[str, str]) -> Column:
    key = F.lower(trim_ws(F.coalesce(value, F.lit(""))))
    out = F.lit("invalid")
    for name in dict.fromkeys(aliases.values()):
        out = F.when(key.isin(*[k for k, v in aliases.items() if v == name]), name).otherwise(out)
    return F.when(key == "", "blank").otherwise(out)


def normal_label(value: Column) -> Column:
    """tp, fp, unclear, blank or invalid."""
    return _aliased(value, LABELS)


def normal_status(value: Column) -> Column:
    return _aliased(value, STATUSES)


def batch_token(*places: Column) -> Column:
    """``batch_<digits>`` from the first place that names a batch, else unknown."""
    found = [F.nullif(F.regexp_extract(F.coalesce(p, F.lit("")), BATCH, 1), F.lit("")) for p in places]
    return F.coalesce(F.concat(F.lit("batch_"), F.coalesce(*found)), F.lit("unknown"))


def item_of(df: DataFrame) -> Column:
    return F.coalesce(blank_to_null("origin_e_id"), blank_to_null("unit_id"))


def labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"label": normal_label(F.col("human_label")), "status": normal_status(F.col("span_status"))})


def label_pivot(rows: DataFrame, by: str) -> DataFrame:
    """One row per value of ``by`` with a count per label."""
    each = [F.count_if(F.col("label") == x).alias(x) for x in ("tp", "fp", "unclear", "blank", "invalid")]
    return labelled(rows).groupBy(F.coalesce(blank_to_null(by), F.lit("unknown")).alias(by)).agg(*each, F.count(F.lit(1)).alias("total"))


def label_cube(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, label, n) over several dimensions and in total, from one grouping-sets pass."""
    cols = {d: F.coalesce(blank_to_null(d), F.lit("unknown")) for d in dimensions}
    view = labelled(rows).select("label", *[c.alias(d) for d, c in cols.items()])
    sets = [[F.col("label")], *[[F.col("label"), F.col(d)] for d in dimensions]]
    got = view.groupingSets(sets, "label", *dimensions).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    name, value = F.lit("total"), F.lit("")
    for k, d in enumerate(dimensions):
        on = F.bitwise_and(F.col("g"), F.lit(1 << (len(dimensions) - 1 - k))) == 0 if hasattr(F, "bitwise_and") else F.col("g").bitwiseAND(F.lit(1 << (len(dimensions) - 1 - k))) == 0
        name, value = F.when(on, d).otherwise(name), F.when(on, F.col(d)).otherwise(value)
    return got.select(name.alias("dimension"), value.alias("value"), "label", "n")


def invalid_rows(rows: DataFrame) -> DataFrame:
    """(hit_id, problem) of rows that need cleaning up before export."""
    r = labelled(rows)
    checks = F.array(F.when(F.col("label").isin("blank", "invalid"), F.concat(F.lit("label_"), F.col("label"))), F.when(F.col("status") == "invalid", "status_invalid"), F.when((F.col("label") == "tp") & (F.col("status") == "blank"), "tp_without_status"))
    return r.select("hit_id", F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("problem"))


def repeated_hits(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def item_mismatches(rows: DataFrame, item_id: str) -> DataFrame:
    """(hit_id, problem): rows of another item (``item_mismatch``), and rows that name none (``item_reference_missing``).

    A row with an origin belongs to the item of its origin or unit, one without to its unit's.
    """
    origin, unit = blank_to_null("origin_e_id"), blank_to_null("unit_id")
    other = F.coalesce(unit != item_id, F.lit(True)) & F.coalesce(origin != item_id, F.lit(True))
    problem = F.when(origin.isNull() & unit.isNull(), "item_reference_missing").when(other, "item_mismatch")
    return rows.select("hit_id", problem.alias("problem")).where("problem is not null")


@dataclass(frozen=True)
class Goals:
    target_pos: int = 100
    target_neg: int = 100
    max_batches: int = 3
    min_tp: int = 30
    fp_tp_ratio: float = 2.0


def summary(rows: DataFrame, goals: Goals = Goals()) -> DataFrame:
    """The summary of all rows, in one row."""
    return summary_by(rows, [], goals)


def summary_by(rows: DataFrame, by: list[str], goals: Goals = Goals()) -> DataFrame:
    """A row per value of ``by``: label and status counts, batches, targets reached, flags of what is to be cleaned up, what to do next, and
    whether the rules need work.

    Order of the decision: clean up, targets reached, too few positives, batches used up, go on. Order of the other:
    clean up, batches used up, no labels, no positives, ratio.
    """
    r = labelled(rows)
    n = lambda x: F.count_if(F.col("label") == x).alias(x)
    no_status = (F.col("label") == "tp") & (F.col("status") == "blank")
    bad = F.col("label").isin("blank", "invalid") | (F.col("status") == "invalid") | no_status
    statuses = [F.count_if(F.col("status") == x).alias(f"status_{x}") for x in ("ok", "span_wrong", "not_applicable", "blank", "invalid")]
    got = r.groupBy(*by).agg(n("tp"), n("fp"), n("unclear"), n("blank"), n("invalid"), *statuses, F.count_if(no_status).alias("tp_without_status"), F.count_if(bad).alias("to_clean"), F.count_distinct(batch_token(F.col("batch_id"), F.col("hit_id"))).alias("batches"))
    flags = F.array(F.when((F.col("blank") > 0) | (F.col("invalid") > 0), "human_label_blank_or_invalid"), F.when(F.col("status_invalid") > 0, "span_status_invalid"), F.when(F.col("tp_without_status") > 0, "tp_span_status_blank"))
    tp, fp, clean = F.col("tp"), F.col("fp"), F.col("to_clean") > 0
    reached = (tp >= goals.target_pos) & (fp >= goals.target_neg)
    low = F.lit(goals.min_tp > 0) & (tp < goals.min_tp) & (tp < goals.target_pos)
    used_up = F.col("batches") >= goals.max_batches
    stop = F.when(clean, "needs_label_cleanup").when(reached, "target_reached").when(low, "low_tp_for_batch_mode").when(used_up, "max_batches_reached").otherwise("continue_batch_search")
    action = F.when(F.col("stop_reason") == "target_reached", "ready_for_encoder_export").when(F.col("stop_reason") == "low_tp_for_batch_mode", "switch_to_full_corpus_search").otherwise(F.col("stop_reason"))
    ratio = F.when(tp > 0, fp / F.when(tp > 0, tp))
    refine = (
        F.when(clean, "needs_label_cleanup").when(used_up, "processed_batches_limit_reached").when((tp == 0) & (fp == 0), "fp_tp_ratio_unavailable")
        .when(tp == 0, "fp_tp_ratio_infinite").when(ratio > goals.fp_tp_ratio, "fp_tp_ratio_above_threshold").otherwise("fp_tp_ratio_within_threshold")
    )
    made = got.select("*", F.filter(flags, lambda x: x.isNotNull()).alias("cleanup_flags"), reached.alias("targets_reached"), ratio.alias("fp_tp_ratio"), stop.alias("stop_reason"), refine.alias("refinement"))
    return made.select("*", action.alias("next_action"), F.col("refinement").isin("fp_tp_ratio_infinite", "fp_tp_ratio_above_threshold").alias("should_consider_rule_update"))


#: After these the labels may be exported.
EXPORTABLE = ("ready_for_encoder_export", "continue_batch_search", "max_batches_reached")


def gate(next_action: str, allow_cleanup: bool = False) -> tuple[bool, str]:
    """(may export, why not)."""
    if next_action == "switch_to_full_corpus_search":
        return False, f"blocked: {next_action}"
    if next_action in EXPORTABLE or allow_cleanup:
        return True, ""
    return False, f"blocked: {next_action}"
