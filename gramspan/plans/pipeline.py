"""Runs: one sampled batch, a whole corpus in shards, many units, and finalising labels."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import evaluate, labels, pairs, review, sampling
from ..operators.bundle import Bundle
from ..operators.detect import Options, detect
from ..session import Scratch

LABEL_ORDER = ["tp", "unclear", "fp", "blank", ""]


@dataclass(frozen=True)
class Caps:
    tp_target: int | None = None
    fp_cap: int | None = None
    unclear_cap: int | None = None


@dataclass
class Report:
    status: str
    steps: dict[str, Any] = field(default_factory=dict)
    reason: str = ""


def run_batch(corpus: DataFrame, bundle: Bundle, unit_id: str, gold: DataFrame | None = None, profile: review.Profile = review.NO_PROFILE, cautions: list[review.Caution] | None = None, options: Options | None = None) -> tuple[DataFrame | None, Report]:
    """Gold gate, detection, review rows and first pass of one unit over prepared records. No candidate at all is fine."""
    report = Report("ok")
    if gold is not None:
        r = evaluate.detector_recall(evaluate.detector_outcome(detect(gold, bundle, [unit_id], text_col="sentence", options=options), unit_id)).first().asDict()
        report.steps["gold"] = r
        if not evaluate.gold_gate({"total": r["total"], "recall": r["overlapping_recall"]}):
            return None, Report("blocked", report.steps, "gold recall under 1")
    rows = review.enriched(review.review_rows(detect(corpus, bundle, [unit_id], options=options, only_hits=True)))
    return review.first_pass(rows, profile, cautions), report


def stop_reason(caps: Caps) -> Column:
    """Why a run ends at a shard, from running totals; null to go on."""
    never = F.lit(False)
    fp = F.col("fp") >= caps.fp_cap if caps.fp_cap is not None else never
    unclear = F.col("unclear") >= caps.unclear_cap if caps.unclear_cap is not None else never
    tp = F.col("tp") >= caps.tp_target if caps.tp_target is not None else never
    return F.when(fp & unclear, "fp_and_unclear_cap_reached").when(fp, "fp_cap_reached").when(unclear, "unclear_cap_reached").when(tp, "tp_target_reached").when(F.col("all_exhausted"), "all_domains_exhausted").when(F.col("backfill_exhausted"), "backfill_domain_exhausted")


def running_totals(counts: DataFrame) -> DataFrame:
    """Counts per shard (shard_index, n_input_texts, n_candidates, tp, fp, unclear, blank) summed up to each shard; a row per shard."""
    w = Window.orderBy("shard_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select("shard_index", *[F.sum(c).over(w).alias(c) for c in counts.columns if c not in ("shard_index", "all_exhausted", "backfill_exhausted")], *[c for c in ("all_exhausted", "backfill_exhausted") if c in counts.columns])


def run_corpus(lines: DataFrame, bundle: Bundle, unit_id: str, quota: dict[str, int], backfill: str, seed: int, shards: int, caps: Caps = Caps(), profile: review.Profile = review.NO_PROFILE, cautions: list[review.Caution] | None = None, block: int = 8, run_id: str = "run") -> tuple[DataFrame | None, list[dict]]:
    """First-pass rows of all shards up to the stop, and the running totals of each shard.

    Records are hashed and ranked once; shards are rank ranges. They are searched in blocks, so that at
    most a block too many is searched; its surplus shards are left out, and the result is that of one shard after another.
    """
    spark = lines.sparkSession
    scratch = Scratch(spark, "corpus_run")
    ranked = scratch.keep(sampling.ranked(lines, seed), "ranked")
    valid = {r["corpus_domain"]: r["n"] for r in ranked.groupBy("corpus_domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = sampling.shard_plan(valid, quota, backfill, shards)
    used: dict[int, dict] = {}
    gone: set[str] = set()
    for domain, shard, _, want, got in plan:
        if got < want:
            gone.add(domain)
        used[shard] = {"all_exhausted": len(gone) == len(quota), "backfill_exhausted": backfill in gone}
    table = spark.createDataFrame(plan, "domain string, shard_index int, rank_start long, requested long, n long")
    out, totals = None, []
    for first in range(0, len(used), block):
        own = table.where(F.col("shard_index").between(first, first + block - 1) & (F.col("n") > 0))
        on = (ranked["corpus_domain"] == own["domain"]) & (ranked["sample_rank"] >= own["rank_start"]) & (ranked["sample_rank"] < own["rank_start"] + own["n"])
        texts = ranked.join(F.broadcast(own), on).withColumn("text_id", F.concat(F.format_string("%s_s%05d_", "corpus_domain", "shard_index"), F.lpad((F.col("sample_rank") - F.col("rank_start") + 1).cast("string"), 6, "0")))
        texts = texts.withColumn("batch_id", F.format_string(f"{run_id}_shard_%05d", "shard_index"))
        rows = review.first_pass(review.enriched(review.review_rows(detect(texts, bundle, [unit_id], only_hits=True))), profile, cautions)
        rows = scratch.keep(rows.withColumn("shard_index", F.regexp_extract("batch_id", r"(\d+)$", 1).cast("int")).withColumn("run_id", F.lit(run_id)), f"block{first}")
        label = F.coalesce(F.nullif(F.col("first_pass_label"), F.lit("")), F.lit("blank"))
        got = {r["shard_index"]: r.asDict() for r in rows.groupBy("shard_index").agg(F.count(F.lit(1)).alias("n_candidates"), *[F.count_if(label == x).alias(x) for x in ("tp", "fp", "unclear", "blank")]).collect()}
        n_texts: dict[int, int] = {}
        for _, shard, _, _, n in plan:
            n_texts[shard] = n_texts.get(shard, 0) + n
        last = None
        for shard in range(first, min(first + block, len(used))):
            c = got.get(shard, {})
            prev = totals[-1] if totals else {}
            now = {"shard_index": shard, "n_input_texts": prev.get("n_input_texts", 0) + n_texts.get(shard, 0)} | {k: prev.get(k, 0) + c.get(k, 0) for k in ("n_candidates", "tp", "fp", "unclear", "blank")} | used[shard]
            now["stop_reason"] = _reason(now, caps)
            totals.append(now)
            if now["stop_reason"]:
                last = shard
                break
        kept = rows if last is None else rows.where(F.col("shard_index") <= last)
        out = kept if out is None else out.unionByName(kept, allowMissingColumns=True)
        if last is not None:
            break
    if totals and not totals[-1]["stop_reason"]:
        totals[-1]["stop_reason"] = "max_shards_reached"
    return out, totals


def _reason(now: dict, caps: Caps) -> str | None:
    over = lambda k, cap: cap is not None and now[k] >= cap
    fp, unclear = over("fp", caps.fp_cap), over("unclear", caps.unclear_cap)
    steps = [(fp and unclear, "fp_and_unclear_cap_reached"), (fp, "fp_cap_reached"), (unclear, "unclear_cap_reached"), (over("tp", caps.tp_target), "tp_target_reached"), (now["all_exhausted"], "all_domains_exhausted"), (now["backfill_exhausted"], "backfill_domain_exhausted")]
    return next((name for on, name in steps if on), None)


def merged(shards: list[DataFrame]) -> DataFrame:
    """All shards' rows in review order: label, reason, domain, match text, hit id."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    rank = F.lit(len(LABEL_ORDER))
    for k, x in reversed(list(enumerate(LABEL_ORDER))):
        rank = F.when(F.col("first_pass_label") == x, k).otherwise(rank)
    return out.orderBy(rank, "first_pass_reason", "corpus_domain", "regex_match_text", "hit_id")


def finalize(rows: DataFrame, item_id: str, texts: DataFrame | None = None, goals: labels.Goals = labels.Goals(), allow_cleanup: bool = False, seed: int = 0) -> tuple[DataFrame | None, Report]:
    """Summary, gate, and the pair examples of one item's labelled rows."""
    again = labels.repeated_hits(rows).limit(10).collect()
    if again:
        raise ValueError(f"repeated hit ids: {[r['hit_id'] for r in again]}")
    s = labels.summary(rows, goals).first().asDict()
    ok, why = labels.gate(s["next_action"], allow_cleanup)
    if not ok:
        return None, Report("blocked", {"summary": s}, why)
    kept = pairs.deduped(pairs.pair_rows(pairs.judged(rows, F.lit(item_id)), texts), ["hit_id"])
    return pairs.splits(pairs.example_ids(pairs.instance_ids(kept)), seed), Report("ok", {"summary": s})


def finalize_many(rows: DataFrame, item_col: str, goals: labels.Goals = labels.Goals(), allow_cleanup: bool = False, seed: int = 0, texts: DataFrame | None = None) -> tuple[DataFrame, list[dict]]:
    """Merged examples of all items whose labels may be exported, and each item's outcome: one pass over the rows of all items.

    Outcomes (a row per item, on the driver) have the fields of a run's summary; a blocked item's reason says why.
    """
    again = rows.groupBy(item_col, "hit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(10).collect()
    if again:
        raise ValueError(f"repeated hit ids: {[tuple(r)[:2] for r in again]}")
    outcomes = []
    for r in labels.summary_by(rows, [item_col], goals).collect():
        ok, why = labels.gate(r["next_action"], allow_cleanup)
        outcomes.append({"item_id": r[item_col]} | run_summary(Report("ok" if ok else "blocked", {"summary": r.asDict()}, why)))
    open_ = [o["item_id"] for o in outcomes if o["status"] == "ok"]
    kept = pairs.deduped(pairs.pair_rows(pairs.judged(rows.where(F.col(item_col).isin(open_)), F.col(item_col)), texts), ["hit_id"])
    made = Scratch(rows.sparkSession, "finalize").keep(pairs.splits(pairs.example_ids(pairs.instance_ids(kept)), seed), "examples")
    return merge_items([made]), outcomes


def run_many(entries: list[dict], run: Callable[[dict], Report], defaults: dict | None = None, only: str | None = None, start_at: str | None = None, stop_on_failure: bool = False, dry_run: bool = False) -> dict[str, list[dict]]:
    """Runs every entry under its defaults and sorts the outcomes into ok, blocked, failed, skipped and dry_run."""
    out: dict[str, list[dict]] = {k: [] for k in ("ok", "blocked", "failed", "skipped", "dry_run")}
    started = start_at is None
    for entry in entries:
        config = {**(defaults or {}), **entry}
        unit = config.get("unit_id")
        if not unit:
            raise ValueError(f"an entry without unit_id: {entry}")
        started = started or unit == start_at
        if not started or only is not None and unit != only:
            out["skipped"].append({"unit_id": unit})
            continue
        if dry_run:
            out["dry_run"].append({"unit_id": unit})
            continue
        try:
            r = run(config)
            out[r.status if r.status in out else "failed"].append({"unit_id": unit} | asdict(r))
        except Exception as e:  # noqa: BLE001
            out["failed"].append({"unit_id": unit, "reason": f"{type(e).__name__}: {e}"})
            if stop_on_failure:
                break
    return out


def bucket_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def merge_items(examples: list[DataFrame]) -> DataFrame:
    """The union of all items' examples in canonical order; a broken row or repeated key is an error."""
    out = examples[0]
    for e in examples[1:]:
        out = out.unionByName(e, allowMissingColumns=True)
    bad = pairs.row_violations(out).limit(10).collect()
    again = pairs.uniqueness(out).where("n_groups > 0").collect()
    if bad or again:
        raise ValueError(f"refused: {[tuple(b) for b in bad]} {[tuple(a) for a in again]}")
    return pairs.canonical_order(out)


def reusable(report: dict, unit_id: str, shard: int, plan: dict[str, tuple[int, int]]) -> bool:
    """Whether a finished shard's report can stand for running it again: same unit, shard and ranks, whole, its table there."""
    import os

    if report.get("status") not in ("ok", "empty") or report.get("unit_id") != unit_id or report.get("shard_index") != shard:
        return False
    if {d: tuple(x) for d, x in report.get("ranks", {}).items()} != plan:
        return False
    return report["status"] == "empty" or os.path.exists(str(report.get("table", "")))


def output_paths(unit_ids: list[str], source: str, root: str, batch_id: str | None = None) -> dict[str, str]:
    """Where a search writes if not told: a folder per unit, names by batch; only for a single unit."""
    if len(unit_ids) != 1:
        raise ValueError("give output paths, or one unit")
    batch, unit = review.batch_of(batch_id, source), unit_ids[0]
    return {k: f"{root}/{unit}/{unit}_{batch}_{k}.{end}" for k, end in (("detections", "jsonl"), ("review", "csv"), ("report", "json"))}


def coerced(config: dict, kinds: dict[str, type], required: tuple[str, ...] = ()) -> dict:
    """A manifest entry with its values in their types; a missing or unreadable one is an error."""
    from ..operators.bundle import to_bool

    missing = [k for k in required if config.get(k) in (None, "")]
    if missing:
        raise ValueError(f"missing: {missing}")
    return {k: v if v is None or k not in kinds else to_bool(v) if kinds[k] is bool else kinds[k](v) for k, v in config.items()}


def run_summary(report: Report, fields: tuple[str, ...] = ("total", "tp", "fp", "unclear", "next_action", "batches")) -> dict:
    """The fixed fields of a run's report that a table of many runs shows."""
    flat = {k: v for step in report.steps.values() if isinstance(step, dict) for k, v in step.items()}
    return {"status": report.status, "reason": report.reason} | {k: flat.get(k) for k in fields}
