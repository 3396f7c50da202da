"""Sampling, review, labels, pairs, evaluation, sync and sources on small rows."""

import json
import re
from random import Random

import pytest
from pyspark.sql import functions as F

from gramspan.functions.bridges import BRIDGES
from gramspan.functions.hangul import syllables_with
from gramspan.operators import evaluate, labels, pairs, review, sampling, sync
from gramspan.operators.bundle import Bundle, Component, Rule, Unit, load, save, to_bool
from gramspan.plans import cli, pipeline
from gramspan.sources import files, lines, xlsx


def test_shard_plan_like_a_simulation():
    rng = Random(3)
    for _ in range(300):
        quota = {d: rng.randint(1, 6) for d in "abc"}
        valid = {d: rng.randint(0, 30) for d in "abc"}
        plan = sampling.shard_plan(valid, quota, "a", 12)
        left, gone, want = dict(valid), set(), []
        for shard in range(12):
            ask = {d: 0 if d in gone else quota[d] for d in quota}
            if "a" not in gone:
                ask["a"] += sum(quota[d] for d in gone)
            for d in quota:
                got = min(ask[d], left[d])
                want.append((d, shard, valid[d] - left[d], ask[d], got))
                left[d] -= got
            gone |= {d for s_, d in ((x, x) for x in quota) if (w := [y for y in want if y[0] == d][-1])[4] < w[3]}
            if "a" in gone or len(gone) == 3:
                break
        assert plan == want


def test_schedules():
    s = [sampling.Schedule("x", 0, None, {"a": 5}), sampling.Schedule("y", 3, 6, {"a": 2}, {"a": 10}), sampling.Schedule("z", 3, None, {"a": 1})]
    assert [sampling.pick_schedule(s, b).schedule_id for b in (0, 2, 3, 7)] == ["x", "x", "z", "z"]
    assert sampling.batch_plan(s[:2], 5) == [("a", 5, 14, 2)]
    with pytest.raises(ValueError):
        sampling.batch_plan(s[1:], 0)
    assert sampling.batch_plan(s[1:], 0, {"a": 4}) == [("a", 0, 0, 4)]


def test_line_parse_and_header(spark):
    rows = ["본문;출처", "a;b;c", "x", " ;s", "", "text;source"]
    df = spark.createDataFrame([(r,) for r in rows], "line string")
    got = [(r.p.status, r.p.text, r.p.source, r.h) for r in df.select(sampling.parse_line(F.col("line"), ";").alias("p"), sampling.is_header(F.col("line"), ";").alias("h")).collect()]
    assert got == [("valid", "본문", "출처", False), ("valid", "a;b", "c", False), ("parse_error", None, None, False), ("empty", "", "s", False), ("parse_error", None, None, False), ("valid", "text", "source", True)]


def test_lines_source_cuts_files_anywhere(spark, tmp_path):
    text = "\ufeffform;출처\n" + "".join(f"줄 {k};s{k % 3}\r\n" for k in range(500)) + "끝;e"
    (tmp_path / "c.txt").write_bytes(text.encode("utf-8"))
    for size in ("7", "100", "100000"):
        got = lines.read_lines(spark, str(tmp_path / "c.txt"), splitBytes=size).orderBy("line_no").collect()
        assert [r.line_no for r in got] == list(range(1, 503)) and got[0].line == "form;출처" and got[-1].line == "끝;e"
    rows = lines.read_corpus(spark, str(tmp_path / "c.txt"), "news").orderBy("source_line_no").collect()
    assert rows[0].source_line_no == 2 and rows[0].source_row_index == 1 and rows[0].raw_text == "줄 0" and len(rows) == 501


def test_xlsx_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "x & <y>\n둘", "tp"), ("b", None, "fp"), ("", "", "")], "id string, t string, label string")
    at = str(tmp_path / "r.xlsx")
    files.write_review(df, at, "label")
    got = files.read_review(spark, at, ("id",)).collect()
    assert [tuple(r) for r in got] == [("a", "x & <y>\n둘", "tp"), ("b", "", "fp")]
    assert xlsx.header_of(at) == ["id", "t", "label"] and xlsx.column_number("AB12") == 27 and xlsx.column_name(27) == "AB"
    with pytest.raises(ValueError):
        files.read_review(spark, at, ("nope",))


def test_xlsx_goes_on_in_further_sheets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(xlsx, "MOST_ROWS", 4)
    monkeypatch.setattr(xlsx, "AT_ONCE", 3)
    df = spark.range(11, numPartitions=3).select(F.concat(F.lit("r"), "id").alias("id"), F.lit(None).alias("none"), (F.col("id") / 2).alias("half"))
    at = str(tmp_path / "r.xlsx")
    xlsx.write_book({"it's": df, "it's 2": df.limit(2), "whole": df.limit(4), "none": df.limit(0)}, at)
    assert xlsx.sheet_parts(at) == ["it's", "it's 3", "it's 4"] and xlsx.sheet_parts(at, "it's 2") == ["it's 2"] and xlsx.sheet_parts(at, "whole") == ["whole"]
    got = xlsx.read_sheet(spark, at).orderBy("_row_no").collect()
    assert [tuple(r)[1:] for r in got] == [(f"r{k}", "", str(k / 2)) for k in range(11)] and len({r._row_no for r in got}) == 11
    assert [xlsx.read_sheet(spark, at, name).count() for name in ("it's 2", "whole", "none", "it's 4")] == [2, 4, 0, 3]
    assert [p.name for p in tmp_path.iterdir()] == ["r.xlsx"]


def test_csv_round_trip_and_guards(spark, tmp_path):
    df = spark.createDataFrame([('q"uo', "줄1\n줄2", [1, 2])], "a string, b string, c array<int>")
    at = str(tmp_path / "r.csv")
    files.write_review(df, at)
    assert open(at, "rb").read(3) == b"\xef\xbb\xbf"
    assert [tuple(r) for r in files.read_review(spark, at).collect()] == [('q"uo', "줄1\n줄2", "[1,2]")]
    with pytest.raises(FileExistsError):
        files.guard([at], False)
    with pytest.raises(ValueError):
        files.safe_dir("/")
    (tmp_path / "d.csv").write_text("a,a\n1,2\n")
    with pytest.raises(ValueError):
        files.read_review(spark, str(tmp_path / "d.csv"))
    assert files.prefer_xlsx(["x/a.csv", "x/a.xlsx", "x/b.csv"]) == ["x/a.xlsx", "x/b.csv"]


def test_jsonl_strict(spark, tmp_path):
    at = tmp_path / "a.jsonl"
    at.write_text('{"a": 1}\n\n{"a": 2}\n')
    assert [(r.a, r._line_no) for r in files.read_jsonl(spark, str(at), "a int").collect()] == [(1, 1), (2, 3)]
    at.write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="bad JSON at a.jsonl:2"):
        files.read_jsonl(spark, str(at), "a int").collect()


def test_nde_bridge_like_python(spark):
    final = f"[{syllables_with('ㄴ')}]"
    texts = ["간데요 먹는데", "은  데요", "큰 데", "한데 간 데요", "ㄴ데", "인데 운데요 는 데", "본데요본 데"]
    for options in (["데"], ["데요"]):
        polite = any(o.endswith("요") for o in options)
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [[tuple(x) for x in r[0]] for r in df.select(BRIDGES["nde"].find(F.col("t"), options)).collect()]
        for t, g in zip(texts, got):
            want = []
            for m in re.finditer(r"(?:은|는|ㄴ|ᆫ)\s*데요?|(?:은데|는데|인데|운데)요?", t):
                want.append((m.start(), m.end() - (not polite and m.group().endswith("요"))))
            for m in re.finditer(rf"(?=({final} ?데))", t):
                e = m.start() + len(m.group(1))
                want.append((m.start(), e + (polite and t[e : e + 1] == "요")))
            assert g == list(dict.fromkeys(want)), t


def test_review_context_columns(spark):
    df = spark.createDataFrame([("가 나다 라마 바사 아자", "[3,4]", "다"), ("가 나다", "x", "나다"), ("가", "", "")], "t string, s string, m string")
    at = review.match_pair(F.col("t"), F.col("s"), F.col("m"))
    got = df.withColumn("at", at).select(review.kwic(F.col("t"), F.col("at"), 1).alias("k"), review.adjacent_tokens(F.col("t"), F.col("at")).alias("a")).collect()
    assert [(r.k, r.a.left, r.a.right_1, r.a.right_2) for r in got] == [("가 나다 라마", "나", "라마", "바사"), ("가 나다", "가", "", ""), ("", "", "", "")]


def test_cautions(spark, tmp_path):
    at = tmp_path / "c.json"
    at.write_text(json.dumps({"item_id": "u", "cautions": [{"caution_id": "b", "priority": 0, "match": {"after_regex": "다"}}, {"caution_id": "a", "priority": 5, "match": {"after_regex": "다"}, "output": {"label": "fp"}}]}))
    found = review.load_cautions(str(at), "u")
    assert [(c.caution_id, c.priority) for c in found] == [("a", 5), ("b", 100)]
    with pytest.raises(ValueError):
        review.load_cautions(str(at), "v")
    with pytest.raises(ValueError):
        review.caution_hit(review.Caution("x", {"nowhere_regex": "a"}))


def test_summary_decisions(spark):
    row = lambda k, label, status="ok": (f"h{k}", f"batch_{k % 3:03d}", label, status)
    kind = "hit_id string, batch_id string, human_label string, span_status string"
    action = lambda rows, g: labels.summary(spark.createDataFrame(rows, kind), g).first()
    good = [row(k, "T") for k in range(3)] + [row(k + 3, "fp") for k in range(2)]
    assert action(good, labels.Goals(3, 2)).next_action == "ready_for_encoder_export"
    assert action(good, labels.Goals(9, 2, min_tp=5)).next_action == "switch_to_full_corpus_search"
    assert action(good, labels.Goals(9, 2, max_batches=3, min_tp=0)).next_action == "max_batches_reached"
    assert action(good, labels.Goals(9, 2, max_batches=9, min_tp=0)).next_action == "continue_batch_search"
    assert action([*good, row(9, "")], labels.Goals(3, 2)).next_action == "needs_label_cleanup"
    assert labels.gate("needs_label_cleanup") == (False, "blocked: needs_label_cleanup") and labels.gate("needs_label_cleanup", True)[0]


def test_split_sizes(spark):
    for n in (9, 10, 15, 25, 34, 36):
        rows = [("u", "pos_conti", f"h{k}", f"t{k}", "0:1") for k in range(n)]
        df = spark.createDataFrame(rows, "item_id string, example_role string, hit_id string, raw_text string, span_key string")
        got = {r["split"]: r["count"] for r in pairs.splits(df).groupBy("split").count().collect()}
        share = max(1, round(0.1 * n)) if n >= 10 else 0
        assert got.get("dev", 0) == got.get("test", 0) == share and got["train"] == n - 2 * share


def test_gold_and_finalize(spark):
    bundle = Bundle([Unit("u", "item", "a", ("u",), "적", None, ("d",))], [Rule("u", "d", "r", "detect", "적")])
    gold = spark.createDataFrame([("g1", "한 적", [(2, 3, "적")]), ("g2", "없다", [(0, 1, "없")])], "example_id string, sentence string, target_spans array<struct<start:int,end:int,text:string>>")
    corpus = spark.createDataFrame([("t1", "본 적 있다"), ("t2", "없음")], "text_id string, raw_text string")
    rows, report = pipeline.run_batch(corpus.withColumn("corpus_domain", F.lit("news")), bundle, "u", gold)
    assert rows is None and report.status == "blocked"
    rows, report = pipeline.run_batch(corpus.withColumn("corpus_domain", F.lit("news")), bundle, "u", gold.where("example_id = 'g1'"))
    assert report.status == "ok" and [r.hit_id for r in rows.collect()] == ["t1-cand01"]
    done = rows.withColumns({"human_label": F.lit("tp"), "span_status": F.lit("ok")})
    examples, report = pipeline.finalize(done, "u", goals=labels.Goals(min_tp=0))
    e = examples.first()
    assert e.example_id == "u-pos-0001" and e.text_a == "본 [SPAN]적[/SPAN] 있다" and e.split == "train"
    assert pipeline.merge_items([examples]).count() == 1
    with pytest.raises(ValueError):
        pipeline.merge_items([examples, examples])
    fixed = evaluate.gold_records(spark.createDataFrame([(1, "한 적", [(2, 3)]), (2, "x", [(0, 9)])], "row_no int, sentence string, segs array<struct<s:int,e:int>>").withColumns({"split": F.lit(None).cast("string"), "pattern_type": F.lit(None).cast("string")}), "u").collect()
    assert [(r.example_id, r.target_text, r.split, r.gold_example_role) for r in fixed] == [("u-GOLD-001", "적", "train", "pos_conti")]


def test_corpus_run_in_blocks_equals_shard_by_shard(spark):
    bundle = Bundle([Unit("u", "item", "a", ("u",), "적", None, ("d",))], [Rule("u", "d", "r", "detect", "적")])
    data = [(d, f"{d}.txt", k, ("적" if (k * 7 + len(d)) % 3 else "무") + f" {k}") for d, n in (("a", 40), ("bb", 9), ("ccc", 5)) for k in range(n)]
    df = spark.createDataFrame(data, "corpus_domain string, source_file string, source_line_no long, raw_text string")
    profile = review.Profile([("raw_text", "[02468]$", "tp", "ok", "even")], ("fp", "ok", "odd"))
    seen = []
    for block in (1, 8):
        rows, totals = pipeline.run_corpus(df, bundle, "u", {"a": 4, "bb": 3, "ccc": 2}, "a", 5, 20, pipeline.Caps(tp_target=9), profile, block=block)
        seen.append((sorted(r.hit_id for r in rows.collect()), totals))
    assert seen[0] == seen[1] and seen[0][1][-1]["stop_reason"] == "tp_target_reached"
    _, totals = pipeline.run_corpus(df, bundle, "u", {"a": 4, "bb": 3, "ccc": 2}, "a", 5, 20)
    assert totals[-1]["stop_reason"] == "all_domains_exhausted" and totals[-1]["n_input_texts"] == 54


def test_many_units():
    def run(config):
        if config["unit_id"] == "bad":
            raise ValueError("x")
        return pipeline.Report("blocked" if config["unit_id"] == "no" else "ok")

    out = pipeline.run_many([{"unit_id": u} for u in ("a", "bad", "no", "b")], run, start_at="bad")
    assert {k: [x["unit_id"] for x in v] for k, v in out.items()} == {"ok": ["b"], "blocked": ["no"], "failed": ["bad"], "skipped": ["a"], "dry_run": []}
    assert len(pipeline.run_many([{"unit_id": "a"}], run, dry_run=True)["dry_run"]) == 1


def test_run_helpers(tmp_path):
    plan = {"a": (0, 5)}
    good = {"status": "ok", "unit_id": "u", "shard_index": 2, "ranks": {"a": [0, 5]}, "table": str(tmp_path)}
    assert pipeline.reusable(good, "u", 2, plan) and not pipeline.reusable(good, "u", 3, plan)
    assert not pipeline.reusable(good | {"table": "/nowhere"}, "u", 2, plan) and not pipeline.reusable(good, "u", 2, {"a": (0, 6)})
    assert pipeline.output_paths(["u"], "x/batch_003_y.jsonl", "out")["review"] == "out/u/u_batch_003_review.csv"
    with pytest.raises(ValueError):
        pipeline.output_paths(["u", "v"], "x", "out")
    assert pipeline.coerced({"n": "5", "f": "yes", "x": None}, {"n": int, "f": bool}, ("n",)) == {"n": 5, "f": True, "x": None}
    with pytest.raises(ValueError):
        pipeline.coerced({}, {}, ("n",))
    assert pipeline.run_summary(pipeline.Report("ok", {"summary": {"tp": 3}}))["tp"] == 3


def test_metrics_and_epochs(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 1.0), (1, -3.0), (0, -800.0)], "gold_label int, logit double")
    r = evaluate.metrics(evaluate.predicted(df)).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (1, 1, 1, 1) and r.f1 == 0.5 and r.mean_loss < 2
    assert evaluate.metrics(evaluate.predicted(df.where("false"))).count() in (0, 1)
    assert evaluate.best_epoch([(1, 0.5, 0.6), (2, 0.4, 0.7), (3, 0.4, 0.8), (4, 0.6, 0.9)]) == (3, 4)
    assert evaluate.best_epoch([(1, 0.5, 0.6), (2, 0.6, 0.7), (3, 0.7, 0.8)], patience=1) == (1, 2)


def test_bundle_files_and_sync(spark, tmp_path):
    b = Bundle([Unit("u", "item", "a", ("u",), "적", "뜻.", ("d",))], [Rule("u", "d", "r", "detect", "적")], [Component("u", "c", "적/것", comp_order=1)])
    save(b, str(tmp_path / "b.json"))
    back = load(str(tmp_path / "b.json"))
    assert back.units == b.units and back.rules == b.rules and back.components == b.components
    assert sync.sync_report(spark, b, back, "u")["in_sync"]
    other = Bundle(b.units, [Rule("u", "d", "r", "detect", "것", priority=2)], [])
    got = sync.sync_report(spark, b, other, "u")
    assert {d["path"] for d in got["diffs"]} >= {"$.rules[0].pattern", "$.rules[0].priority", "$.components"}
    assert b.components[0].surface == "적|것" and to_bool("Yes") and not to_bool("0.0") and to_bool(None, True)
    with pytest.raises(ValueError):
        to_bool("maybe")


def test_cli(capsys, tmp_path):
    assert cli.main(["hangul-class", "--final", "ㄴ"]) == 0 and "간" in capsys.readouterr().out
    save(Bundle([Unit("u", detect_ruleset_ids=("d",))], [Rule("u", "d", "r", "detect", "(")]), str(tmp_path / "b.json"))
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["nope"])


def test_cli_runs(spark, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    (tmp_path / "news.txt").write_text("sentence;source\n" + "".join(f"본 적 있다 {k};n{k}\n" for k in range(12)), "utf-8")
    (tmp_path / "manifest.json").write_text(json.dumps({"batch_id_prefix": "m", "sampling": {"news": 5}}), "utf-8")
    assert cli.main(["prepare-corpus", "--corpus", f"news={at('news.txt')}", "--manifest", at("manifest.json"), "--batch-index", "1", "--out", at("records")]) == 0
    save(Bundle([Unit("u", "item", "a", ("u",), "적", None, ("d",))], [Rule("u", "d", "r", "detect", "적")]), at("b.json"))
    save(Bundle([Unit("u", "item", "a", ("u",), "것", None, ("d",))], [Rule("u", "d", "r", "detect", "적")]), at("other.json"))
    batch = ["run-batch", "--input", at("records") + "/*.json", "--bundle", at("b.json"), "--unit-id", "u"]
    assert cli.main([*batch, "--expected", at("other.json"), "--out", at("no")]) == 1
    assert cli.main([*batch, "--expected", at("b.json"), "--out", at("rows")]) == 0
    rows = spark.read.parquet(at("rows"))
    assert rows.count() == 5 and {r.text_id for r in rows.collect()} == {f"news_b001_{k:06d}" for k in range(1, 6)}
    files.write_review(rows.withColumns({"human_label": F.lit("tp"), "span_status": F.lit("ok"), "origin_e_id": F.lit("u")}), at("review.csv"))
    assert cli.main(["finalize-many", "--input", at("review.csv"), "--out", at("pairs"), "--min-tp", "0"]) == 0
    assert cli.main(["merge", "--input", at("pairs"), "--out", at("merged")]) == 0
    assert cli.main(["merge", "--input", at("pairs"), "--out", at("merged")]) == 2  # already there
    assert cli.main(["import", "--base", at("pairs"), "--extra", at("merged"), "--out", at("all")]) == 0
    assert spark.read.json(at("all")).count() == 5
    assert cli.main(["run-corpus", "--input", at("records") + "/*.json", "--bundle", at("b.json"), "--unit-id", "u", "--quota", '{"news": 2}', "--backfill", "news", "--out", at("corpus")]) == 0
    assert spark.read.parquet(at("corpus")).count() == 5
    files.write_review(spark.createDataFrame([("한 적", "[[2,3]]"), ("x", "")], "sentence string, span_segments string"), at("gold.csv"))
    assert cli.main(["gold-build", "--input", at("gold.csv"), "--unit-id", "u", "--out", at("gold"), "--expected", "1"]) == 0
    assert cli.main(["gold-build", "--input", at("gold.csv"), "--unit-id", "u", "--out", at("gold2"), "--expected", "2"]) == 2
    capsys.readouterr()
