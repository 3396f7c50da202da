"""Command line: ``python -m gramspan.plans.cli <command> ...``. Exit code 0 is fine, 1 blocked, 2 an error."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hangul import final_class
from ..functions.spans import parse_spans
from ..operators import bundle as bundles
from ..operators import evaluate, labels, pairs, profiles, review, sampling, sync
from ..operators.detect import Options, detect
from ..sources import files, lines
from ..sources.xlsx import read_sheet
from . import pipeline

RECORD = "text_id string, batch_id string, batch_index int, corpus_domain string, source string, source_file string, source_row_index long, source_line_no long, sample_hash string, raw_text string"
EXAMPLE = "item_id string, example_id string, label int, example_role string, split string, text_id string, hit_id string, candidate_index string, corpus_domain string, raw_text string, segs array<struct<s:int,e:int>>, span_key string, span_text string, text_a string, text_b string, pattern_type string, instance_id int, instances int, note string"
GOLD = "item_id string, example_id string, sentence string, target_text string, target_spans array<struct<start:int,end:int,text:string>>, split string, pattern_type string"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gramspan")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, **flags: dict) -> None:
        c = sub.add_parser(name)
        for flag, how in flags.items():
            c.add_argument("--" + flag.replace("_", "-"), **how)

    need, many, yes = {"required": True}, {"action": "append", "required": True}, {"action": "store_true"}
    command("hangul-class", final=need, suffix={"default": ""})
    command("validate-bundle", bundle=need)
    command("sync", expected=need, actual=need, unit_id=need, report={})
    command("search", bundle=need, input=need, unit_id=many, out=need, review=need, report={}, realtime=yes, overwrite=yes)
    command("prepare-review", input=need, out=need, report={}, overwrite=yes)
    command("first-pass", input=need, out=need, item_id=need, cautions={}, overwrite=yes)
    command("summarize", input=many, target_pos={"type": int, "default": 100}, target_neg={"type": int, "default": 100}, max_batches={"type": int, "default": 3}, min_tp={"type": int, "default": 30}, report={})
    command("finalize", input=many, item_id=need, out=need, seed={"type": int, "default": 0}, allow_cleanup=yes, overwrite=yes)
    command("gold", gold=need, bundle=need, unit_id=need, report={})
    command("regex-gold", gold=need, pattern=need, policy={"default": "overlap", "choices": ["overlap", "sentence"]}, report={})
    command("domain-report", corpus=need, domain=need, delimiter={"default": ";"}, report={})
    command("export-bundle", workbook=need, out=need, overwrite=yes)
    command("prepare-corpus", corpus=many, manifest=need, batch_index={"type": int, "required": True}, seed={"type": int, "default": 0}, delimiter={"default": ";"}, out=need, report={}, overwrite=yes)
    command("run-batch", input=need, bundle=need, unit_id=need, expected={}, gold={}, cautions={}, out=need, report={}, overwrite=yes)
    command("run-corpus", input=need, bundle=need, unit_id=need, quota=need, backfill=need, seed={"type": int, "default": 0}, shards={"type": int, "default": 50}, tp_target={"type": int}, fp_cap={"type": int}, unclear_cap={"type": int}, out=need, report={}, overwrite=yes)
    command("finalize-many", input=many, out=need, seed={"type": int, "default": 0}, min_tp={"type": int, "default": 30}, allow_cleanup=yes, report={}, overwrite=yes)
    command("merge", input=many, out=need, report={}, overwrite=yes)
    command("import", base=need, extra=need, out=need, report={}, overwrite=yes)
    command("gold-build", input=need, unit_id=need, expected={"type": int}, out=need, overwrite=yes)
    return p


def _reviews(spark: SparkSession, paths: list[str]) -> DataFrame:
    parts = [files.read_review(spark, p) for p in files.prefer_xlsx(paths)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows


def run_long(args: argparse.Namespace, spark: SparkSession) -> tuple[int, object]:
    """Commands that make tables."""
    files.guard([args.out], args.overwrite)
    if args.command == "export-bundle":
        sheet = lambda name: read_sheet(spark, args.workbook, name).drop("_row_no")
        made = bundles.from_tables(*[sheet(name) for name in bundles.SHEETS])
        found = bundles.violations(made)
        bad = any(not code.startswith("warn_") for code, _ in found)
        if not bad:
            made.warnings, made.source = [f"{c}: {i}" for c, i in found], bundles.provenance(args.workbook)
            bundles.save(made, args.out)
        return int(bad), [list(x) for x in found]
    out = files.safe_dir(args.out)
    if args.command == "prepare-corpus":
        rows = None
        for entry in args.corpus:  # domain=path
            domain, _, path = entry.partition("=")
            one = lines.read_corpus(spark, path, domain, args.delimiter).where("status = 'valid'")
            rows = one if rows is None else rows.unionByName(one)
        manifest = spark.read.schema("batch_id_prefix string, sampling map<string,int>").json(args.manifest, multiLine=True)
        records, report = sampling.prepare(rows, manifest, args.batch_index, args.seed)
        records.withColumn("text_id", sampling.text_id(F.col("corpus_domain"), F.lit(args.batch_index), F.col("place"))).write.mode("overwrite").json(out)
        return 0, [r.asDict() for r in report.collect()]
    if args.command in ("run-batch", "run-corpus"):
        bundle = bundles.load(args.bundle)
        texts = files.read_jsonl(spark, args.input, RECORD)
        cautions = review.load_cautions(args.cautions, args.unit_id) if getattr(args, "cautions", None) else []
        profile = profiles.PROFILES.get(args.unit_id, review.NO_PROFILE)
        if args.command == "run-batch":
            if args.expected and not (differs := sync.sync_report(spark, bundles.load(args.expected), bundle, args.unit_id))["in_sync"]:
                return 1, differs
            gold = files.read_jsonl(spark, args.gold, GOLD) if args.gold else None
            rows, report = pipeline.run_batch(texts, bundle, args.unit_id, gold, profile, cautions)
            if rows is None:
                return 1, {"status": report.status, "reason": report.reason, **report.steps}
            rows.write.mode("overwrite").parquet(out)
            return 0, {"status": report.status, **report.steps, "reasons": [r.asDict() for r in review.reason_report(spark.read.parquet(out)).collect()]}
        caps = pipeline.Caps(args.tp_target, args.fp_cap, args.unclear_cap)
        rows, totals = pipeline.run_corpus(texts, bundle, args.unit_id, json.loads(args.quota), args.backfill, args.seed, args.shards, caps, profile, cautions)
        if rows is not None:
            pipeline.merged([rows]).write.mode("overwrite").parquet(out)
        return 0, totals
    if args.command == "finalize-many":
        rows = _reviews(spark, args.input).withColumn("item_id", F.coalesce(F.nullif(F.col("origin_e_id"), F.lit("")), F.col("unit_id"))).where("item_id <> ''")
        made, outcomes = pipeline.finalize_many(rows.drop("item_id").withColumn("_item", F.coalesce(F.nullif(F.col("origin_e_id"), F.lit("")), F.col("unit_id"))), "_item", labels.Goals(min_tp=args.min_tp), args.allow_cleanup, args.seed)
        made.drop("_item").write.mode("overwrite").json(out)
        return int(all(o["status"] != "ok" for o in outcomes)), outcomes
    if args.command == "merge":
        made = pipeline.merge_items([spark.read.schema(EXAMPLE).json(p) for p in args.input])
        made.write.mode("overwrite").json(out)
        return 0, [r.asDict() for r in pairs.item_rollup(made).collect()]
    if args.command == "import":
        base, extra = (spark.read.schema(EXAMPLE).json(p) for p in (args.base, args.extra))
        pairs.import_table(base, extra).write.mode("overwrite").json(out)
        return 0, pairs.import_summary(base, extra).first().asDict()
    rows = files.read_review(spark, args.input, ("sentence", "span_segments")).withColumn("row_no", F.monotonically_increasing_id())
    blank = [c for c in ("split", "pattern_type") if c not in rows.columns]
    rows = rows.withColumns({"segs": parse_spans(F.col("span_segments"))} | {c: F.lit(None).cast("string") for c in blank} | {c: F.nullif(F.col(c), F.lit("")) for c in ("split", "pattern_type") if c in rows.columns})
    made = evaluate.gold_records(rows, args.unit_id, args.expected)
    made.write.mode("overwrite").json(out)
    return 0, {"rows": spark.read.schema("example_id string").json(out).count()}


LONG = ("export-bundle", "prepare-corpus", "run-batch", "run-corpus", "finalize-many", "merge", "import", "gold-build")


def run(args: argparse.Namespace, spark: SparkSession) -> tuple[int, object]:
    if args.command in LONG:
        return run_long(args, spark)
    if args.command == "validate-bundle":
        found = bundles.violations(bundles.load(args.bundle))
        return int(any(not code.startswith("warn_") for code, _ in found)), [list(x) for x in found]
    if args.command == "sync":
        out = sync.sync_report(spark, bundles.load(args.expected), bundles.load(args.actual), args.unit_id)
        return int(not out["in_sync"]), out
    if args.command == "search":
        files.guard([args.out, args.review], args.overwrite)
        found = detect(files.read_jsonl(spark, args.input, RECORD), bundles.load(args.bundle), args.unit_id, options=Options(realtime=args.realtime))
        files.write_detections(found, args.out)
        if not args.realtime:
            files.write_review(review.review_rows(found), args.review)
        return 0, [r.asDict() for r in review.search_report(found).collect()]
    if args.command == "prepare-review":
        files.guard([args.out], args.overwrite)
        rows = review.enriched(files.read_review(spark, args.input, ("hit_id", "raw_text", "span_segments")))
        bad = [tuple(r) for r in review.key_violations(rows).limit(10).collect()]
        if bad:
            raise ValueError(f"hit ids: {bad}")
        files.write_review(rows, args.out)
        return 0, [r.asDict() for r in review.value_counts(rows, ["span_parse_status", "span_source", "component_span_status", "human_label"]).collect()]
    if args.command == "first-pass":
        files.guard([args.out], args.overwrite)
        cautions = review.load_cautions(args.cautions, args.item_id) if args.cautions else []
        rows = review.first_pass(files.read_review(spark, args.input), review.NO_PROFILE, cautions)
        files.write_review(rows, args.out, "first_pass_label")
        return 0, [r.asDict() for r in review.reason_report(rows).collect()]
    if args.command in ("summarize", "finalize"):
        rows = _reviews(spark, args.input)
        if args.command == "summarize":
            return 0, labels.summary(rows, labels.Goals(args.target_pos, args.target_neg, args.max_batches, args.min_tp)).first().asDict()
        files.guard([args.out], args.overwrite)
        examples, report = pipeline.finalize(rows, args.item_id, allow_cleanup=args.allow_cleanup, seed=args.seed)
        if examples is None:
            return 1, {"status": report.status, "reason": report.reason, **report.steps}
        examples.write.mode("overwrite").json(files.safe_dir(args.out))
        return 0, report.steps
    if args.command == "gold":
        found = detect(files.read_jsonl(spark, args.gold, GOLD), bundles.load(args.bundle), [args.unit_id], text_col="sentence")
        out = evaluate.detector_recall(evaluate.detector_outcome(found, args.unit_id)).first().asDict()
        return int(out["overlapping_recall"] < 1), out
    if args.command == "regex-gold":
        out = evaluate.recall(evaluate.regex_outcome(files.read_jsonl(spark, args.gold, GOLD), args.pattern, args.policy)).first().asDict()
        return int(out["recall"] < 1), out
    rows = lines.read_corpus(spark, args.corpus, args.domain, args.delimiter)
    from ..operators.sampling import domain_report

    return 0, [r.asDict() for r in domain_report(rows).collect()]


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "hangul-class":
        print(json.dumps({"final": args.final, "class": final_class(args.final, args.suffix)}, ensure_ascii=False))
        return 0
    spark = SparkSession.builder.appName("gramspan").getOrCreate()
    try:
        code, out = run(args, spark)
    except (ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    if getattr(args, "report", None):
        files.write_json(args.report, out)
    print(json.dumps(out, ensure_ascii=False, default=str))
    return code


if __name__ == "__main__":
    sys.exit(main())
