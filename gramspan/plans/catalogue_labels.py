"""Registered queries on review rows, labels, pair examples, gold and metrics, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spans import parse_spans
from ..functions.textfn import trim_ws
from ..operators import evaluate, labels, pairs, review
from ..operators.detect import detect
from . import pipeline
from .catalogue import _SQLWS, EXP, UNITS, longs, sql_spans, sql_trim, table, test_bundle

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_MARKS = ("human_label", "span_status")
_PAIR = ("text_id", "raw_text", "unit_id", "human_label", "span_status", "span_segments", "detect_rule_ids", "memo", "reviewer", "candidate_index", "corpus_domain")


def rows_of(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Hits with the given columns of their review row. Rows repeat as a whole, so only what is asked for is compared and shuffled."""
    return table(spark, sf_dir, "search_corpus").select("hit_id", *[c for c in columns if c != "hit_id"]).distinct()


R = "r AS (SELECT DISTINCT * FROM search_corpus)"
_key = lambda c: f"lower({sql_trim(f'coalesce({c}, {chr(39)}{chr(39)})')})"
# Written out by hand, not made from the library's maps: this is what they are checked against.
LABEL = f"""CASE WHEN {_key("human_label")} = '' THEN 'blank' WHEN {_key("human_label")} IN ('tp', 't', 'true_positive', 'true positive', 'positive', 'pos') THEN 'tp'
 WHEN {_key("human_label")} IN ('fp', 'f', 'false_positive', 'false positive', 'negative', 'neg') THEN 'fp' WHEN {_key("human_label")} IN ('unclear', 'unsure', 'unknown', '?') THEN 'unclear' ELSE 'invalid' END"""
STATUS = f"""CASE WHEN {_key("span_status")} = '' THEN 'blank' WHEN {_key("span_status")} IN ('ok', 'o') THEN 'ok' WHEN {_key("span_status")} IN ('span_wrong', 'span wrong', 'wrong') THEN 'span_wrong'
 WHEN {_key("span_status")} IN ('not_applicable', 'not applicable', 'na', 'n/a', 'none') THEN 'not_applicable' ELSE 'invalid' END"""
J = f"{R}, j AS (SELECT *, {LABEL} AS label, {STATUS} AS status, TRY_CAST(span_segments AS BIGINT[][]) AS segs FROM r)"
_orunk = lambda c: f"coalesce(nullif({sql_trim(c)}, ''), 'unknown')"


# ---- review ---------------------------------------------------------------------------------------------------


@query(f"WITH {R}, c AS (SELECT hit_id, raw_text, TRY_CAST(span_segments AS BIGINT[][])[1] AS p FROM r WHERE hit_id IS NOT NULL AND raw_text IS NOT NULL) SELECT hit_id, coalesce(substring(raw_text, greatest(0, p[1] - 6)::INT + 1, (p[1] - greatest(0, p[1] - 6))::INT), '') AS before, coalesce(substring(raw_text, p[2]::INT + 1, 6), '') AS after, coalesce(substring(raw_text, greatest(0, p[1] - 8)::INT + 1, (p[2] + 8 - greatest(0, p[1] - 8))::INT), '') AS \"window\", coalesce(substring(raw_text, p[2]::INT + 1, 1), '') AS next_char FROM c")
def span_context(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "raw_text", "span_segments").where("hit_id is not null and raw_text is not null").withColumn("c", review.span_context(F.col("raw_text"), parse_spans(F.col("span_segments"))))
    return rows.select("hit_id", *[F.coalesce(f"c.{n}", F.lit("")).alias(n) for n in ("before", "after", "window", "next_char")])


_AT = f"""{R}, a AS (SELECT hit_id, raw_text, TRY_CAST(regex_match_span AS BIGINT[]) AS rm, coalesce(regex_match_text, '') AS mtext FROM r WHERE hit_id IS NOT NULL AND raw_text IS NOT NULL),
mt AS (SELECT hit_id, raw_text, CASE WHEN len(rm) = 2 AND rm[1] >= 0 AND rm[1] < rm[2] AND rm[2] <= length(raw_text) THEN rm WHEN length(mtext) > 0 AND instr(raw_text, mtext) > 0 THEN [instr(raw_text, mtext) - 1, instr(raw_text, mtext) - 1 + length(mtext)] END AS pos FROM a)"""
_TOK = f"{_AT}, {sql_spans("t", "mt", f'[^{_SQLWS}]+', 'hit_id, pos')}"


@query(f"WITH {_TOK}, o AS (SELECT hit_id, raw_text, pos, min(k) AS a, max(k) AS b FROM t WHERE s < pos[2] AND e > pos[1] GROUP BY 1, 2, 3), w AS (SELECT t.hit_id, t.raw_text, t.pos, string_agg(match_text, ' ' ORDER BY k) AS v FROM t JOIN o ON t.hit_id = o.hit_id AND t.raw_text = o.raw_text AND t.pos = o.pos AND k BETWEEN a - 5 AND b + 5 GROUP BY 1, 2, 3) SELECT mt.hit_id, coalesce(v, '') AS kwic FROM mt LEFT JOIN w ON mt.hit_id = w.hit_id AND mt.raw_text = w.raw_text AND mt.pos = w.pos")
def kwic_context(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "raw_text", "regex_match_span", "regex_match_text").where("hit_id is not null and raw_text is not null").withColumn("at", review.match_pair(F.col("raw_text"), F.col("regex_match_span"), F.coalesce("regex_match_text", F.lit(""))))
    return rows.select("hit_id", review.kwic(F.col("raw_text"), F.col("at")).alias("kwic"))


@query(f"WITH {_TOK}, l AS (SELECT hit_id, raw_text, pos, max_by(substring(raw_text, s::INT + 1, (least(e, pos[1]) - s)::INT), k) AS v FROM t WHERE s < pos[1] GROUP BY 1, 2, 3), q AS (SELECT *, row_number() OVER (PARTITION BY hit_id, raw_text, pos ORDER BY k) AS n FROM t WHERE e > pos[2]), r1 AS (SELECT hit_id, raw_text, pos, substring(raw_text, greatest(s, pos[2])::INT + 1, (e - greatest(s, pos[2]))::INT) AS v FROM q WHERE n = 1) SELECT mt.hit_id, coalesce(l.v, '') AS left_token, coalesce(r1.v, '') AS right_token FROM mt LEFT JOIN l USING (hit_id, raw_text, pos) LEFT JOIN r1 USING (hit_id, raw_text, pos)")
def adjacent_tokens(spark, sf_dir):
    rows = rows_of(spark, sf_dir, "raw_text", "regex_match_span", "regex_match_text").where("hit_id is not null and raw_text is not null").withColumn("at", review.match_pair(F.col("raw_text"), F.col("regex_match_span"), F.coalesce("regex_match_text", F.lit("")))).withColumn("t", review.adjacent_tokens(F.col("raw_text"), F.col("at")))
    return rows.select("hit_id", F.col("t.left").alias("left_token"), F.col("t.right_1").alias("right_token"))


CAUTIONS = [review.Caution("quoted", {"after_regex": "고 (했|전했)"}, "unclear", priority=5), review.Caution("brand", {"raw_text_regex": "[A-Za-z]{4}", "span_text_regex_any": ["적", "수"]}, "fp", "span_wrong", "latin_name", priority=10), review.Caution("late", {"compact_text_regex": "때문이"}, "tp", priority=20)]
PROFILE = review.Profile([("after", "^[다었]", "tp", "ok", "plain_ending"), ("window", "[?!]", "unclear", "ok", "marked")])


def _passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.first_pass(rows_of(spark, sf_dir, "corpus_domain", "raw_text", "span_segments", "span_text", "regex_match_span", "regex_match_text").where("hit_id is not null and raw_text is not null"), PROFILE, CAUTIONS)


_FP = f"""{R}, c0 AS (SELECT *, TRY_CAST(span_segments AS BIGINT[][])[1] AS p FROM r WHERE hit_id IS NOT NULL AND raw_text IS NOT NULL),
c AS (SELECT *, coalesce(substring(raw_text, p[2]::INT + 1, 6), '') AS aft, coalesce(substring(raw_text, greatest(0, p[1] - 8)::INT + 1, (p[2] + 8 - greatest(0, p[1] - 8))::INT), '') AS win FROM c0),
f AS (SELECT *, CASE WHEN regexp_matches(aft, '고 (했|전했)') THEN 'caution_quoted' WHEN regexp_matches(raw_text, '[A-Za-z]{{4}}') AND regexp_matches(coalesce(span_text, ''), '적|수') THEN 'latin_name' WHEN regexp_matches(regexp_replace(raw_text, '[{_SQLWS}]+', '', 'g'), '때문이') THEN 'caution_late' WHEN regexp_matches(aft, '^[다었]') THEN 'plain_ending' WHEN regexp_matches(win, '[?!]') THEN 'marked' ELSE 'no_rule' END AS reason FROM c)"""


@query(f"WITH {_FP} SELECT hit_id, reason, CASE reason WHEN 'latin_name' THEN 'fp' WHEN 'caution_late' THEN 'tp' WHEN 'plain_ending' THEN 'tp' ELSE 'unclear' END AS label FROM f")
def caution_first_match(spark, sf_dir):
    return _passed(spark, sf_dir).select("hit_id", F.col("first_pass_reason").alias("reason"), F.col("first_pass_label").alias("label"))


@query(f"WITH {_FP} SELECT hit_id, CASE WHEN regexp_matches(aft, '^[다었]') THEN 'plain_ending' WHEN regexp_matches(win, '[?!]') THEN 'marked' ELSE 'no_rule' END AS reason FROM f")
def profile_decision_list(spark, sf_dir):
    return review.first_pass(rows_of(spark, sf_dir, "corpus_domain", "raw_text", "span_segments", "span_text", "regex_match_span", "regex_match_text").where("hit_id is not null and raw_text is not null"), PROFILE).select("hit_id", F.col("first_pass_reason").alias("reason"))


@query(f"WITH {_FP}, n AS (SELECT reason, hit_id, count(*) OVER (PARTITION BY reason) AS n, row_number() OVER (PARTITION BY reason ORDER BY hit_id) AS rank FROM f) SELECT reason, n, rank, hit_id FROM n WHERE rank <= 5")
def reason_topn(spark, sf_dir):
    return longs(review.reason_report(_passed(spark, sf_dir)).select("reason", "n", "rank", "hit_id"))


@query("SELECT code, hit_id FROM (SELECT 'duplicate_hit_id' AS code, hit_id FROM search_corpus WHERE hit_id IS NOT NULL GROUP BY 2 HAVING count(*) > 1) UNION ALL SELECT 'blank_hit_id', hit_id FROM search_corpus WHERE nullif(trim(hit_id), '') IS NULL")
def review_key_violations(spark, sf_dir):
    return review.key_violations(table(spark, sf_dir, "search_corpus"))


@query(f"WITH {R} SELECT x.c AS \"column\", coalesce(x.v, '') AS value, count(*) AS n FROM (SELECT unnest(['span_source', 'component_span_status']) AS c, unnest([span_source, component_span_status]) AS v FROM r) x GROUP BY 1, 2")
def review_value_counts(spark, sf_dir):
    return review.value_counts(rows_of(spark, sf_dir, "span_source", "component_span_status"), ["span_source", "component_span_status"])


# ---- labels ---------------------------------------------------------------------------------------------------


@query(f"SELECT coalesce(human_label, '') AS raw, {LABEL} AS label, count(*) AS n FROM search_corpus GROUP BY 1, 2")
def label_normalise(spark, sf_dir):
    return table(spark, sf_dir, "search_corpus").groupBy(F.coalesce("human_label", F.lit("")).alias("raw"), labels.normal_label(F.col("human_label")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT coalesce(span_status, '') AS raw, {STATUS} AS status, count(*) AS n FROM search_corpus GROUP BY 1, 2")
def status_normalise(spark, sf_dir):
    return table(spark, sf_dir, "search_corpus").groupBy(F.coalesce("span_status", F.lit("")).alias("raw"), labels.normal_status(F.col("span_status")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


_BATCH = "CASE WHEN regexp_matches(coalesce(batch_id, ''), '(?i)batch[_-][0-9]{3,}') THEN 'batch_' || regexp_extract(batch_id, '(?i)batch[_-]([0-9]{3,})', 1) WHEN regexp_matches(coalesce(hit_id, ''), '(?i)batch[_-][0-9]{3,}') THEN 'batch_' || regexp_extract(hit_id, '(?i)batch[_-]([0-9]{3,})', 1) ELSE 'unknown' END"


@query(f"SELECT {_BATCH} AS batch, count(*) AS n FROM search_corpus GROUP BY 1")
def batch_id_extract(spark, sf_dir):
    return table(spark, sf_dir, "search_corpus").groupBy(labels.batch_token(F.col("batch_id"), F.col("hit_id")).alias("batch")).agg(F.count(F.lit(1)).alias("n"))


_EACH = ", ".join(f"count(*) FILTER (WHERE label = '{x}') AS {x}" for x in ("tp", "fp", "unclear", "blank", "invalid"))


@query(f"WITH {J} SELECT {_orunk('unit_id')} AS unit_id, {_EACH}, count(*) AS total FROM j GROUP BY 1")
def review_label_pivot(spark, sf_dir):
    return labels.label_pivot(rows_of(spark, sf_dir, "unit_id", *_MARKS), "unit_id")


@query(f"WITH {J}, v AS (SELECT label, {_orunk('corpus_domain')} AS d, {_orunk('span_source')} AS s FROM j) SELECT CASE WHEN grouping(d) = 0 THEN 'corpus_domain' WHEN grouping(s) = 0 THEN 'span_source' ELSE 'total' END AS dimension, CASE WHEN grouping(d) = 0 THEN d WHEN grouping(s) = 0 THEN s ELSE '' END AS value, label, count(*) AS n FROM v GROUP BY GROUPING SETS ((label), (label, d), (label, s))")
def review_label_cube(spark, sf_dir):
    return labels.label_cube(rows_of(spark, sf_dir, "corpus_domain", "span_source", *_MARKS), ["corpus_domain", "span_source"])


@query(f"WITH {J} SELECT hit_id, unnest(list_filter([CASE WHEN label IN ('blank', 'invalid') THEN 'label_' || label END, CASE WHEN status = 'invalid' THEN 'status_invalid' END, CASE WHEN label = 'tp' AND status = 'blank' THEN 'tp_without_status' END], lambda x: x IS NOT NULL)) AS problem FROM j")
def review_invalid_rows(spark, sf_dir):
    return labels.invalid_rows(rows_of(spark, sf_dir, *_MARKS))


_SUM = f"{J}, b AS (SELECT *, {_BATCH} AS batch FROM j), g AS (SELECT unit_id, {_EACH}, count(*) FILTER (WHERE label IN ('blank', 'invalid') OR status = 'invalid' OR label = 'tp' AND status = 'blank') AS to_clean, count(DISTINCT batch) AS batches FROM b GROUP BY 1)"


_GOAL = "SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(unclear)::BIGINT AS unclear, sum(blank)::BIGINT AS blank, sum(invalid)::BIGINT AS invalid, sum(to_clean)::BIGINT AS to_clean FROM g"


@query(f"WITH {_SUM}, t AS ({_GOAL}), n AS (SELECT count(DISTINCT batch) AS batches FROM b), f AS (SELECT count(*) FILTER (WHERE label IN ('blank', 'invalid')) AS f1, count(*) FILTER (WHERE status = 'invalid') AS f2, count(*) FILTER (WHERE label = 'tp' AND status = 'blank') AS f3 FROM b) SELECT tp, fp, unclear, blank, invalid, to_clean, batches, concat_ws(',', CASE WHEN f1 > 0 THEN 'human_label_blank_or_invalid' END, CASE WHEN f2 > 0 THEN 'span_status_invalid' END, CASE WHEN f3 > 0 THEN 'tp_span_status_blank' END) AS cleanup_flags, CASE WHEN to_clean > 0 THEN 'needs_label_cleanup' WHEN tp >= 100 AND fp >= 100 THEN 'ready_for_encoder_export' WHEN tp < 30 THEN 'switch_to_full_corpus_search' WHEN batches >= 3 THEN 'max_batches_reached' ELSE 'continue_batch_search' END AS next_action FROM t, n, f")
def review_next_action(spark, sf_dir):
    got = labels.summary(rows_of(spark, sf_dir, "batch_id", *_MARKS))
    return got.select("tp", "fp", "unclear", "blank", "invalid", "to_clean", "batches", F.array_join("cleanup_flags", ",").alias("cleanup_flags"), "next_action")


# Each unit's labels on their own, cleaned up: here the decisions differ.
_UNIT = f"{J}, b AS (SELECT *, {_BATCH} AS batch FROM j WHERE label IN ('tp', 'fp', 'unclear') AND status <> 'invalid' AND NOT (label = 'tp' AND status = 'blank')), u AS (SELECT unit_id, count(*) FILTER (WHERE label = 'tp') AS tp, count(*) FILTER (WHERE label = 'fp') AS fp, count(DISTINCT batch) AS batches FROM b WHERE unit_id IS NOT NULL GROUP BY 1)"


@query(f"WITH {_UNIT} SELECT unit_id, CASE WHEN tp >= 20 AND fp >= 20 THEN 'target_reached' WHEN tp < 4 THEN 'low_tp_for_batch_mode' WHEN batches >= 9 THEN 'max_batches_reached' ELSE 'continue_batch_search' END AS stop_reason, round(CASE WHEN tp > 0 THEN fp / tp END, 6) AS ratio, CASE WHEN batches >= 9 THEN 'processed_batches_limit_reached' WHEN tp = 0 AND fp = 0 THEN 'fp_tp_ratio_unavailable' WHEN tp = 0 THEN 'fp_tp_ratio_infinite' WHEN fp / tp > 2 THEN 'fp_tp_ratio_above_threshold' ELSE 'fp_tp_ratio_within_threshold' END AS refinement, batches < 9 AND fp > 0 AND (tp = 0 OR fp / tp > 2) AS should_consider_rule_update FROM u")
def rule_refinement(spark, sf_dir):
    r = labels.labelled(rows_of(spark, sf_dir, "batch_id", "unit_id", *_MARKS).where("unit_id is not null"))
    clean = r.where(F.col("label").isin("tp", "fp", "unclear") & (F.col("status") != "invalid") & ~((F.col("label") == "tp") & (F.col("status") == "blank"))).drop("label", "status")
    goals = labels.Goals(target_pos=20, target_neg=20, min_tp=4, max_batches=9)
    got = labels.summary_by(clean, ["unit_id"], goals)
    return got.select("unit_id", "stop_reason", F.round("fp_tp_ratio", 6).alias("ratio"), "refinement", "should_consider_rule_update")


@query(f"WITH {R} SELECT hit_id, CASE WHEN o IS NULL AND u IS NULL THEN 'item_reference_missing' ELSE 'item_mismatch' END AS problem FROM (SELECT hit_id, nullif({sql_trim('origin_e_id')}, '') AS o, nullif({sql_trim('unit_id')}, '') AS u FROM r) WHERE (o IS NULL AND u IS NULL) OR NOT (coalesce(o, '') = (SELECT min(unit_id) FROM runtime_units) OR coalesce(u, '') = (SELECT min(unit_id) FROM runtime_units))")
def review_item_mismatch(spark, sf_dir):
    item = table(spark, sf_dir, "runtime_units").agg(F.min("unit_id")).first()[0]
    return labels.item_mismatches(rows_of(spark, sf_dir, "origin_e_id", "unit_id"), item)


# ---- pairs ----------------------------------------------------------------------------------------------------

_VALID = "(len(segs) > 0 AND list_bool_and(list_transform(segs, lambda p: p[1] >= 0 AND p[1] < p[2] AND p[2] <= length(raw_text))) AND list_bool_and(list_transform(range(2, len(segs) + 1), lambda i: segs[i][1] >= segs[i - 1][2])) IS DISTINCT FROM FALSE)"
_SKIP = f"CASE WHEN label IN ('blank', 'invalid', 'unclear') THEN 'human_label_' || label WHEN status = 'invalid' THEN 'span_status_invalid' WHEN label = 'tp' AND status <> 'ok' THEN 'tp_span_not_ok' WHEN label = 'fp' AND status NOT IN ('ok', 'not_applicable', 'blank') THEN 'fp_span_status' WHEN nullif({sql_trim('raw_text')}, '') IS NULL THEN 'raw_text_blank' WHEN NOT coalesce({_VALID}, false) THEN 'span_invalid' ELSE 'kept' END"
_KEY = "list_aggregate(list_transform(segs, lambda p: p[1] || ':' || p[2]), 'string_agg', '|')"
E = f"{J}, e0 AS (SELECT *, unit_id AS item_id, {_SKIP} AS skip_reason FROM j), e AS (SELECT * REPLACE ((label = 'tp')::INT::BIGINT AS label, {_KEY} AS span_key), CASE WHEN label = 'fp' THEN 'neg_target_absent' WHEN len(segs) > 1 THEN 'pos_disconti' ELSE 'pos_conti' END AS example_role FROM e0 WHERE skip_reason = 'kept'), dd AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY item_id, label, raw_text, span_key ORDER BY hit_id, text_id) = 1)"


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.deduped(pairs.pair_rows(pairs.judged(rows_of(spark, sf_dir, *_PAIR), F.col("unit_id"))), ["hit_id", "text_id"])


@query(f"WITH {E} SELECT skip_reason, count(*) AS n FROM e0 GROUP BY 1")
def pair_skip_reasons(spark, sf_dir):
    return pairs.skip_report(pairs.judged(rows_of(spark, sf_dir, *_PAIR), F.col("unit_id")))


@query(f"WITH {E} SELECT hit_id, item_id, label, example_role, span_key, list_aggregate(list_transform(range(1, len(segs) + 1), lambda i: substring(raw_text, (CASE WHEN i = 1 THEN 0 ELSE segs[i - 1][2] END)::INT + 1, (segs[i][1] - CASE WHEN i = 1 THEN 0 ELSE segs[i - 1][2] END)::INT) || '[SPAN]' || substring(raw_text, segs[i][1]::INT + 1, (segs[i][2] - segs[i][1])::INT) || '[/SPAN]'), 'string_agg', '') || substring(raw_text, segs[len(segs)][2]::INT + 1) AS text_a FROM e")
def pair_rows(spark, sf_dir):
    rows = pairs.pair_rows(pairs.judged(rows_of(spark, sf_dir, *_PAIR), F.col("unit_id")))
    return longs(rows.select("hit_id", "item_id", "label", "example_role", "span_key", "text_a"))


@query("SELECT e_id AS item_id, concat_ws(chr(10), nullif(trim(canonical_form), ''), nullif(trim(gloss), '')) AS text_b FROM items WHERE e_id IS NOT NULL UNION ALL SELECT unit_id, concat_ws(chr(10), nullif(trim(canonical_form), ''), nullif(trim(gloss), '')) FROM runtime_units WHERE unit_id NOT IN (SELECT e_id FROM items WHERE e_id IS NOT NULL)")
def pair_item_texts(spark, sf_dir):
    return pairs.unit_texts(table(spark, sf_dir, "items"), table(spark, sf_dir, "runtime_units"))


@query(f"WITH {E} SELECT item_id, label, count(*) AS n, count(DISTINCT hit_id) AS hits FROM dd GROUP BY 1, 2")
def pair_dedupe(spark, sf_dir):
    return longs(kept(spark, sf_dir).groupBy("item_id", "label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("hit_id").alias("hits")))


_INST = "row_number() OVER (PARTITION BY item_id, coalesce(nullif(text_id, ''), 'text:' || raw_text) ORDER BY segs[1][1], segs[1][2], coalesce(TRY_CAST(candidate_index AS INT), 0), span_key, hit_id)"
_EXID = "item_id || CASE WHEN label = 1 THEN '-pos-' ELSE '-neg-' END || lpad((row_number() OVER (PARTITION BY item_id, label ORDER BY hit_id, span_key))::VARCHAR, 4, '0')"


@query(f"WITH {E} SELECT hit_id, span_key, {_INST} AS instance_id, count(*) OVER (PARTITION BY item_id, coalesce(nullif(text_id, ''), 'text:' || raw_text)) AS instances FROM dd")
def pair_instance_ids(spark, sf_dir):
    return longs(pairs.instance_ids(kept(spark, sf_dir)).select("hit_id", "span_key", "instance_id", "instances"))


@query(f"WITH {E} SELECT hit_id, span_key, {_EXID} AS example_id FROM dd")
def pair_example_ids(spark, sf_dir):
    return pairs.example_ids(kept(spark, sf_dir)).select("hit_id", "span_key", "example_id")


_SPLIT = "h AS (SELECT *, count(*) OVER (PARTITION BY item_id, example_role) AS n, row_number() OVER (PARTITION BY item_id, example_role ORDER BY sha256(concat_ws('|', '3', item_id, example_role, hit_id, raw_text, span_key)), hit_id) AS place FROM dd), sp AS (SELECT *, CASE WHEN n < 10 THEN 'train' WHEN place <= n - 2 * greatest(1, round_even(n * 0.1, 0)::INT) THEN 'train' WHEN place <= n - greatest(1, round_even(n * 0.1, 0)::INT) THEN 'dev' ELSE 'test' END AS new_split FROM h)"


@query(f"WITH {E}, {_SPLIT} SELECT hit_id, span_key, new_split AS split FROM sp")
def pair_split(spark, sf_dir):
    return pairs.splits(kept(spark, sf_dir), seed=3).select("hit_id", "span_key", "split")


@query(f"WITH {E}, {_SPLIT} SELECT example_role, new_split AS split, count(*) AS n FROM sp GROUP BY CUBE (1, 2)")
def pair_role_split_cube(spark, sf_dir):
    return pairs.split_cube(pairs.splits(kept(spark, sf_dir), seed=3))


_DOM = "WHEN contains(source, '일상') THEN 'daily_conversation' WHEN contains(source, '대화') THEN 'daily_conversation' WHEN contains(source, '신문') THEN 'news' WHEN contains(source, '뉴스') THEN 'news' WHEN contains(source, '비출판') THEN 'non_published' WHEN contains(source, '구어') THEN 'learner_spoken' WHEN contains(source, '문어') THEN 'learner_written' WHEN contains(source, '학습자') THEN 'learner_written'"


@query(f"SELECT CASE {_DOM} ELSE 'unknown' END AS domain, count(*) AS n FROM search_corpus GROUP BY 1")
def pair_source_domain(spark, sf_dir):
    return table(spark, sf_dir, "search_corpus").groupBy(pairs.domain_of_source(F.col("source")).alias("domain")).agg(F.count(F.lit(1)).alias("n"))


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.splits(pairs.instance_ids(pairs.example_ids(kept(spark, sf_dir))), seed=3)


_X = f"{E}, {_SPLIT}, x AS (SELECT *, {_EXID} AS example_id FROM sp), base AS (SELECT * FROM x WHERE new_split = 'train'), extra AS (SELECT * REPLACE (CASE WHEN new_split = 'dev' THEN example_id ELSE 'x-' || example_id END AS example_id) FROM x), o AS (SELECT extra.*, EXISTS (SELECT 1 FROM base b WHERE b.example_id = extra.example_id) AS a, EXISTS (SELECT 1 FROM base b WHERE b.item_id = extra.item_id AND b.label = extra.label AND b.raw_text = extra.raw_text AND b.span_key = extra.span_key) AS b FROM extra)"


@query(f"WITH {_X} SELECT example_id, CASE WHEN a THEN 'skipped_existing' WHEN b THEN 'skipped_duplicate_content' ELSE 'imported' END AS outcome FROM o")
def import_antijoin(spark, sf_dir):
    every = _examples(spark, sf_dir)
    extra = every.withColumn("example_id", F.when(F.col("split") == "dev", F.col("example_id")).otherwise(F.concat(F.lit("x-"), "example_id")))
    return pairs.import_additions(every.where("split = 'train'"), extra).select("example_id", "outcome")


@query(f"WITH {_X} SELECT code, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN new_split = 'dev' THEN 'label_role' END, CASE WHEN new_split = 'test' THEN 'span_key' END], lambda c: c IS NOT NULL)) AS code FROM x) GROUP BY 1")
def merge_row_violations(spark, sf_dir):
    """Examples broken on purpose: a wrong label in dev, a wrong key in test."""
    rows = _examples(spark, sf_dir).withColumns({"label": F.when(F.col("split") == "dev", 1 - F.col("label")).otherwise(F.col("label")), "span_key": F.when(F.col("split") == "test", "9:9").otherwise(F.col("span_key"))})
    return pairs.row_violations(rows).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {E} SELECT 'example_id' AS key, count(*) AS n_groups FROM (SELECT text_id FROM e GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'item_example_id', count(*) FROM (SELECT item_id, text_id FROM e GROUP BY 1, 2 HAVING count(*) > 1) UNION ALL SELECT 'content', count(*) FROM (SELECT item_id, label, raw_text, span_key FROM e GROUP BY 1, 2, 3, 4 HAVING count(*) > 1)")
def merge_uniqueness(spark, sf_dir):
    return pairs.uniqueness(pairs.pair_rows(pairs.judged(rows_of(spark, sf_dir, *_PAIR), F.col("unit_id"))).withColumn("example_id", F.col("text_id")))


@query(f"WITH {E}, {_SPLIT} SELECT item_id, count(*) AS total, count(*) FILTER (WHERE label = 1) AS positive, count(*) FILTER (WHERE label = 0) AS negative, count(*) FILTER (WHERE new_split = 'train') AS train FROM sp GROUP BY ROLLUP (1)")
def merge_item_rollup(spark, sf_dir):
    return pairs.item_rollup(pairs.splits(kept(spark, sf_dir), seed=3)).select("item_id", "total", "positive", "negative", "train")


# ---- gold and metrics -----------------------------------------------------------------------------------------

GOLD = "gold AS (SELECT DISTINCT * FROM df003_gold_50 WHERE sentence IS NOT NULL AND example_id IS NOT NULL)"


def gold_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "df003_gold_50").where("sentence is not null and example_id is not null").distinct()


_GX = f"{GOLD}, {sql_spans('x', 'gold', EXP, 'example_id, target_spans', 'sentence')}, hit AS (SELECT DISTINCT example_id FROM (SELECT example_id, s, e, unnest(target_spans) AS t FROM x) WHERE greatest(s, t.start) < least(e, t.\"end\"))"


@query(f"WITH {_GX} SELECT count(*) AS total, count(*) FILTER (WHERE example_id IN (SELECT example_id FROM hit)) AS matched, round(count(*) FILTER (WHERE example_id IN (SELECT example_id FROM hit)) / count(*), 6) AS recall FROM gold")
def gold_regex_recall(spark, sf_dir):
    return evaluate.recall(evaluate.regex_outcome(gold_of(spark, sf_dir), EXP)).select("total", "matched", F.round("recall", 6).alias("recall"))


@query(f"WITH {GOLD} SELECT count(*) AS total, count(*) FILTER (WHERE regexp_matches(sentence, '{EXP}')) AS matched FROM gold")
def gold_sentence_recall(spark, sf_dir):
    return evaluate.recall(evaluate.regex_outcome(gold_of(spark, sf_dir), EXP, "sentence")).select("total", "matched")


@query(f"WITH {_GX} SELECT example_id, target_text FROM gold WHERE example_id NOT IN (SELECT example_id FROM hit)")
def gold_fn_rows(spark, sf_dir):
    return evaluate.regex_outcome(gold_of(spark, sf_dir), EXP).where(~F.col("matched")).select("example_id", "target_text")


@query(f"WITH {_GX}, n AS (SELECT example_id, count(*) AS k FROM x GROUP BY 1) SELECT count(*) AS total, coalesce(sum(k), 0)::BIGINT AS candidates, round(count(k) / count(*), 6) AS in_sentence_recall FROM gold LEFT JOIN n USING (example_id)")
def gold_detector_recall(spark, sf_dir):
    found = detect(gold_of(spark, sf_dir), test_bundle(), UNITS[:1], text_col="sentence")
    got = evaluate.detector_recall(evaluate.detector_outcome(found, "u_exp"))
    return got.select("total", "candidates", F.round("in_sentence_recall", 6).alias("in_sentence_recall"))


@query(f"WITH {GOLD}, t AS (SELECT coalesce(nullif({sql_trim('split')}, ''), 'none') AS split, length(sentence) AS n FROM gold) SELECT split, count(*) AS n, max(n) AS longest, round(avg(n), 6) AS mean, round(avg((n > 60)::INT), 6) AS truncated FROM t GROUP BY 1")
def length_stats(spark, sf_dir):
    rows = gold_of(spark, sf_dir).withColumn("split", F.coalesce(F.nullif(trim_ws("split"), F.lit("")), F.lit("none")))
    got = evaluate.length_stats(rows, F.length("sentence"), 60)
    return longs(got.select("split", "n", "longest", F.round("mean", 6).alias("mean"), F.round("truncated", 6).alias("truncated")))


@query(f"WITH {GOLD}, g AS (SELECT example_id, item_id, CASE WHEN gold_example_role = 'neg_target_absent' THEN 0 ELSE 1 END AS label, split, sentence AS text_a, coalesce(target_text, '') AS text_b FROM gold) SELECT code, sum(n)::BIGINT AS n FROM (SELECT 'missing_split' AS code, count(*) AS n FROM g WHERE split IS NULL OR split = '' UNION ALL SELECT 'missing_text_b', count(*) FROM g WHERE text_b = '' UNION ALL SELECT 'missing_text_a', count(*) FROM g WHERE text_a = '' UNION ALL SELECT 'split', count(*) FROM g WHERE split NOT IN ('train', 'dev', 'test') UNION ALL SELECT 'duplicate_example_id', count(*) FROM (SELECT example_id FROM g GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'train_without_label_0', 1 WHERE NOT EXISTS (SELECT 1 FROM g WHERE split = 'train' AND label = 0) UNION ALL SELECT 'dev_without_label_0', 1 WHERE NOT EXISTS (SELECT 1 FROM g WHERE split = 'dev' AND label = 0) UNION ALL SELECT 'warn_test_without_label_0', 1 WHERE NOT EXISTS (SELECT 1 FROM g WHERE split = 'test' AND label = 0) UNION ALL SELECT 'train_without_label_1', 1 WHERE NOT EXISTS (SELECT 1 FROM g WHERE split = 'train' AND label = 1) UNION ALL SELECT 'dev_without_label_1', 1 WHERE NOT EXISTS (SELECT 1 FROM g WHERE split = 'dev' AND label = 1) UNION ALL SELECT 'warn_test_without_label_1', 1 WHERE NOT EXISTS (SELECT 1 FROM g WHERE split = 'test' AND label = 1)) GROUP BY 1 HAVING sum(n) > 0")
def training_split_checks(spark, sf_dir):
    g = gold_of(spark, sf_dir).select("example_id", "item_id", F.when(F.col("gold_example_role") == "neg_target_absent", 0).otherwise(1).alias("label"), "split", F.col("sentence").alias("text_a"), F.coalesce("target_text", F.lit("")).alias("text_b"))
    return evaluate.training_violations(g)


_PRED = f"{E}, p AS (SELECT hit_id, span_key, corpus_domain, label::INT AS gold_label, (length(raw_text) % 41 - 20) / 8.0 AS logit FROM dd), q AS (SELECT *, 1 / (1 + exp(-logit)) AS prob, (1 / (1 + exp(-logit)) >= 0.5)::INT AS pred_label, ln(1 + exp(-abs(logit))) + greatest(logit, 0) - logit * gold_label AS loss FROM p), m AS (SELECT *, gold_label = 1 AND pred_label = 1 AS tp, gold_label = 0 AND pred_label = 1 AS fp, gold_label = 0 AND pred_label = 0 AS tn, gold_label = 1 AND pred_label = 0 AS fn FROM q)"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with a logit worked out from the text's length, in place of a model's."""
    rows = kept(spark, sf_dir).select("hit_id", "span_key", "corpus_domain", F.col("label").alias("gold_label"), ((F.length("raw_text") % 41 - 20) / 8.0).alias("logit"))
    return evaluate.predicted(rows)


_MET = "count(*) AS total, count(*) FILTER (WHERE tp) AS tp, count(*) FILTER (WHERE fp) AS fp, count(*) FILTER (WHERE tn) AS tn, count(*) FILTER (WHERE fn) AS fn, round(avg(loss), 6) AS mean_loss, round(coalesce(count(*) FILTER (WHERE tp) / nullif(count(*) FILTER (WHERE tp OR fp), 0), 0), 6) AS precision, round(coalesce(count(*) FILTER (WHERE tp) / nullif(count(*) FILTER (WHERE tp OR fn), 0), 0), 6) AS recall, round(coalesce(2 * count(*) FILTER (WHERE tp) / nullif(2 * count(*) FILTER (WHERE tp) + count(*) FILTER (WHERE fp OR fn), 0), 0), 6) AS f1"


def _metric_columns(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "total", "tp", "fp", "tn", "fn", *[F.round(c, 6).alias(c) for c in ("mean_loss", "precision", "recall", "f1")])


@query(f"WITH {_PRED} SELECT {_MET} FROM m")
def metrics_overall(spark, sf_dir):
    return _metric_columns(evaluate.metrics(predictions(spark, sf_dir)))


@query(f"WITH {_PRED} SELECT coalesce(nullif(corpus_domain, ''), 'unknown') AS corpus_domain, {_MET} FROM m GROUP BY 1")
def metrics_by_group(spark, sf_dir):
    return _metric_columns(evaluate.metrics(predictions(spark, sf_dir), ["corpus_domain"]), "corpus_domain")


@query(f"WITH {_PRED} SELECT hit_id, span_key, gold_label::BIGINT AS gold_label, pred_label::BIGINT AS pred_label FROM q WHERE gold_label <> pred_label")
def prediction_errors(spark, sf_dir):
    return longs(evaluate.errors(predictions(spark, sf_dir)).select("hit_id", "span_key", "gold_label", "pred_label"))


@query()
def ml_standin_predictions(spark, sf_dir):
    rows = _examples(spark, sf_dir).select("example_id", "item_id", "label", "split", "text_a", F.col("unit_id").alias("text_b"))
    return evaluate.train_standin(rows).select("example_id", "split", "gold_label", "pred_label", F.round("prob", 4).alias("prob"))


# ---- runs -----------------------------------------------------------------------------------------------------

_RUN = "f AS (SELECT batch_index AS shard_index, n_input_texts, n_candidates, tp, fp, unclear FROM batch_runs WHERE created_at IS NOT NULL AND tp IS NOT NULL QUALIFY row_number() OVER (PARTITION BY batch_index ORDER BY created_at, run_id) = 1), t AS (SELECT shard_index, sum(tp) OVER w AS tp, sum(fp) OVER w AS fp, sum(unclear) OVER w AS unclear FROM f WINDOW w AS (ORDER BY shard_index))"


@query(f"WITH {_RUN} SELECT shard_index::BIGINT AS shard_index, tp::BIGINT AS tp, fp::BIGINT AS fp, unclear::BIGINT AS unclear, CASE WHEN fp >= 3000 AND unclear >= 300 THEN 'fp_and_unclear_cap_reached' WHEN fp >= 3000 THEN 'fp_cap_reached' WHEN unclear >= 300 THEN 'unclear_cap_reached' WHEN tp >= 500 THEN 'tp_target_reached' END AS stop_reason FROM t")
def running_stop_shard(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("batch_index").orderBy("created_at", "run_id")
    first = table(spark, sf_dir, "batch_runs").where("created_at is not null and tp is not null").withColumn("n", F.row_number().over(w)).where("n = 1")
    counts = first.select(F.col("batch_index").alias("shard_index"), "n_input_texts", "n_candidates", "tp", "fp", "unclear", F.lit(False).alias("all_exhausted"), F.lit(False).alias("backfill_exhausted"))
    totals = pipeline.running_totals(counts)
    return longs(totals.select("shard_index", "tp", "fp", "unclear", pipeline.stop_reason(pipeline.Caps(500, 3000, 300)).alias("stop_reason")))


@query("WITH b AS (SELECT CASE WHEN created_at IS NULL THEN 'failed' WHEN blank IS NULL THEN 'blocked' ELSE 'ok' END AS bucket FROM batch_runs) SELECT bucket, count(*) AS n FROM b GROUP BY 1")
def status_bucket_counts(spark, sf_dir):
    runs = table(spark, sf_dir, "batch_runs")
    return pipeline.bucket_counts(runs.select(F.when(F.col("created_at").isNull(), "failed").when(F.col("blank").isNull(), "blocked").otherwise("ok").alias("bucket")))


@query(f"WITH {_FP}, l AS (SELECT hit_id, corpus_domain, regex_match_text, reason, CASE reason WHEN 'latin_name' THEN 'fp' WHEN 'caution_late' THEN 'tp' WHEN 'plain_ending' THEN 'tp' ELSE 'unclear' END AS label FROM f) SELECT label, min(hit_id) AS first_hit, count(*) AS n FROM l GROUP BY 1")
def shard_merge_order(spark, sf_dir):
    rows = _passed(spark, sf_dir)
    half = F.pmod(F.xxhash64("hit_id"), F.lit(2))
    ordered = pipeline.merged([rows.where(half == 0), rows.where(half == 1)])
    return ordered.groupBy(F.col("first_pass_label").alias("label")).agg(F.min("hit_id").alias("first_hit"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {E}, {_SPLIT} SELECT hit_id, span_key, {_EXID} AS example_id, {_INST} AS instance_id FROM sp")
def finalize_examples(spark, sf_dir):
    """Labelled rows of all units to numbered examples, cleanup issues notwithstanding; the gate itself is tested on small rows."""
    rows = kept(spark, sf_dir)
    return longs(pairs.example_ids(pairs.instance_ids(rows)).select("hit_id", "span_key", "example_id", "instance_id"))


@query("WITH v AS (SELECT unit_id AS item_id, run_id AS regex_version, row_number() OVER (ORDER BY batch_index, run_id) AS ord FROM batch_runs CROSS JOIN (SELECT min(unit_id) AS unit_id FROM runtime_units)) SELECT item_id, regex_version, ord FROM v ORDER BY ord DESC LIMIT 1")
def regex_version_select(spark, sf_dir):
    from pyspark.sql import Window

    unit = table(spark, sf_dir, "runtime_units").agg(F.min("unit_id").alias("item_id")).first()[0]
    runs = table(spark, sf_dir, "batch_runs")  # some hundred rows
    versions = runs.select(F.lit(unit).alias("item_id"), F.col("run_id").alias("regex_version"), F.row_number().over(Window.orderBy("batch_index", "run_id")).alias("ord"))
    return longs(evaluate.latest_version(versions, unit))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .catalogue import _corpus_lines

    return _corpus_lines(spark, sf_dir)


@query()
def corpus_run_rows(spark, sf_dir):
    """A whole-corpus run: shards of hash ranks with backfill, detection, first pass, stop at a cap."""
    quota = {"daily_conversation": 400, "news": 200, "non_published": 200, "lecture_notes": 5}
    rows, _ = pipeline.run_corpus(_lines(spark, sf_dir), test_bundle(), "u_exp", quota, "daily_conversation", 17, 12, pipeline.Caps(tp_target=150), PROFILE, CAUTIONS)
    return rows.select("shard_index", "hit_id", "corpus_domain", "span_key", "first_pass_label", "first_pass_reason")


@query()
def corpus_run_totals(spark, sf_dir):
    """Running totals of the same run, shard by shard, with the reason it ended."""
    quota = {"daily_conversation": 400, "news": 200, "non_published": 200, "lecture_notes": 5}
    _, totals = pipeline.run_corpus(_lines(spark, sf_dir), test_bundle(), "u_exp", quota, "daily_conversation", 17, 12, pipeline.Caps(tp_target=150), PROFILE, CAUTIONS)
    return spark.createDataFrame([tuple(t.values()) for t in totals], "shard_index long, n_input_texts long, n_candidates long, tp long, fp long, unclear long, blank long, all_exhausted boolean, backfill_exhausted boolean, stop_reason string")
