"""Registered queries on detection, spans, sampling and bundles, and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import spans as P
from ..functions.bridges import BRIDGES
from ..functions.hangul import BASE, FINALS, final_index, has_final
from ..functions.textfn import finditer_spans, trim_ws
from ..operators import bundle as B
from ..operators import review, sampling, sync
from ..operators.detect import Options, detect, each

EXP, CAN, WHY = r"적[이은도]? ?[있없]", r"수[는도가]? ?[있없]", r"기 ?때문"
_RULES = [B.Rule("u_exp", "d_exp", "r_exp", "detect", EXP), B.Rule("u_can", "d_can", "r_can", "detect", CAN), B.Rule("ps_why", "d_why", "r_why", "detect", WHY)]
_COMPS = [B.Component("u_exp", "c1", "적", comp_order=1, max_gap_to_next=2), B.Component("u_exp", "c2", "있/없", comp_order=2), B.Component("u_can", "c1", "수", comp_order=1, max_gap_to_next=2), B.Component("u_can", "c2", "있/없", comp_order=2)]
UNITS = ["u_exp", "u_can", "ps_why"]


def test_bundle(*verify: B.Rule, extra: tuple[B.Rule, ...] = ()) -> B.Bundle:
    """Three units of common endings, free of look-around; verification rules go with the first."""
    units = [B.Unit("u_exp", "item", "c", ("u_exp",), "적 있/없", None, ("d_exp",), ("v_exp",) if verify else ()), B.Unit("u_can", "item", "c", ("u_can",), "수 있/없", None, ("d_can",)), B.Unit("ps_why", "polyset", "a", ("why1", "why2"), "기 때문", None, ("d_why",))]
    return B.Bundle(units, [*_RULES, *extra, *verify], _COMPS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text_id, corpus_domain, raw_text): one row per text. Grouped by the text as well, so filters on it reach the scan."""
    rows = table(spark, sf_dir, "search_corpus").where("text_id is not null")
    return rows.groupBy("text_id", "raw_text").agg(F.min(F.coalesce(F.lower(trim_ws("corpus_domain")), F.lit(""))).alias("corpus_domain"))


def longs(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes])


# ---- SQL building blocks --------------------------------------------------------------------------------------

_SQLWS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^[{_SQLWS}]+|[{_SQLWS}]+$', '', 'g')"


CORPUS = f"corpus AS (SELECT text_id, min(coalesce(lower({sql_trim('corpus_domain')}), '')) AS corpus_domain, min(raw_text) AS raw_text FROM search_corpus WHERE text_id IS NOT NULL GROUP BY 1)"


def sql_spans(name: str, source: str, pattern: str, keys: str, text: str = "raw_text") -> str:
    """CTE with one row per match: the keys, the text, its place k, and offsets s and e."""
    return f"""{name}_l AS (SELECT {keys}, {text}, regexp_extract_all({text}, '{pattern}') AS m, string_split_regex({text}, '{pattern}') AS g FROM {source} WHERE {text} IS NOT NULL),
{name} AS (SELECT {keys}, {text}, k, m[k] AS match_text, (coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0))::BIGINT AS s,
  (coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:k], lambda x: length(x))), 0))::BIGINT AS e
  FROM (SELECT {keys}, {text}, m, g, unnest(range(1, len(m) + 1)) AS k FROM {name}_l))"""


#: Candidates of the first two units: the component before the verb, and the verb at the end of the match.
CANDS = f"""{CORPUS}, {sql_spans('x', 'corpus', EXP, 'text_id, corpus_domain')},
cands AS (SELECT text_id, corpus_domain, raw_text, k, match_text, s, e, CASE WHEN e - s = 2 OR substring(raw_text, s::INT + 2, (e - s)::INT - 2) = ' ' THEN s || ':' || e ELSE s || ':' || (s + 1) || '|' || (e - 1) || ':' || e END AS span_key FROM x)"""

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- detection ------------------------------------------------------------------------------------------------


def found(spark: SparkSession, sf_dir: str, bundle: B.Bundle | None = None, units: list[str] | None = None, only_hits: bool = True, **options) -> DataFrame:  # noqa: ANN003
    return detect(corpus(spark, sf_dir), bundle or test_bundle(), units or UNITS, options=Options(**options), only_hits=only_hits)


def exploded(df: DataFrame, what: str = "candidates") -> DataFrame:
    return each(df, "text_id", "corpus_domain", "raw_text", what=what)


_COUNTS = " UNION ALL ".join(f"SELECT corpus_domain, '{u}' AS unit_id, len(regexp_extract_all(raw_text, '{p}')) AS n FROM corpus WHERE regexp_matches(raw_text, '{p}')" for u, p in zip(UNITS, (EXP, CAN, WHY)))


@query(f"WITH {CORPUS} SELECT corpus_domain, unit_id, sum(n)::BIGINT AS candidates, count(*) AS texts FROM ({_COUNTS}) GROUP BY 1, 2")
def flagship_unit_domain_counts(spark, sf_dir):
    hits = each(found(spark, sf_dir), "text_id", "corpus_domain").select("text_id", "corpus_domain", "c.unit_id")
    per_text = hits.groupBy("corpus_domain", "unit_id", "text_id").agg(F.count(F.lit(1)).alias("n"))
    return per_text.groupBy("corpus_domain", "unit_id").agg(F.sum("n").alias("candidates"), F.count(F.lit(1)).alias("texts"))


@query(f"WITH {CANDS} SELECT text_id, k AS candidate_index, span_key, match_text AS regex_match_text, 'component_spans' AS span_source FROM cands")
def detect_components(spark, sf_dir):
    return longs(exploded(found(spark, sf_dir, units=["u_exp"])).select("text_id", (F.col("k") + 1).cast("long").alias("candidate_index"), "c.span_key", "c.regex_match_text", "c.span_source"))


@query(f"WITH {CANDS}, twice AS (SELECT text_id, span_key, 'r_exp' AS r FROM cands UNION ALL SELECT text_id, span_key, 'r_two' FROM cands WHERE match_text LIKE '%있') SELECT text_id, span_key, string_agg(DISTINCT r, ',' ORDER BY r) AS rules FROM twice GROUP BY 1, 2")
def detect_merge(spark, sf_dir):
    more = B.Rule("u_exp", "d_exp", "r_two", "detect", r"적[이은도]? ?있", priority=1)
    return exploded(found(spark, sf_dir, test_bundle(extra=(more,)), ["u_exp"])).select("text_id", "c.span_key", F.array_join("c.detect_rule_ids", ",").alias("rules"))


def _verify(name: str, rule: B.Rule, where: str) -> None:
    sql = f"WITH {CANDS} SELECT text_id, span_key, CASE WHEN {where} THEN 'v' ELSE '' END AS failed FROM cands"

    def run(spark, sf_dir):
        got = found(spark, sf_dir, test_bundle(rule), ["u_exp"])
        pick = lambda what: exploded(got, what).select("text_id", "c.span_key", F.array_join("c.hard_fail_rule_ids", ",").alias("failed"))
        return pick("candidates").unionByName(pick("rejected"))

    run.__name__ = name
    query(sql)(run)


_RIGHT = f"left(regexp_replace(substring(raw_text, e::INT + 1), '[{_SQLWS}]+', '', 'g'), 3)"
_LEFT = f"right(regexp_replace(left(raw_text, s::INT), '[{_SQLWS}]+', '', 'g'), 2)"
_rule = lambda target, pattern, comp=None, n=None: B.Rule("u_exp", "v_exp", "v", "verify", pattern, target, hard_fail=True, component_id=comp, context_chars=n)
_verify("detect_verify_raw", _rule("raw_sentence", "했다"), "regexp_matches(raw_text, '했다')")
_verify("detect_verify_window", _rule("char_window", "근처|까지"), "regexp_matches(substring(raw_text, greatest(0, s - 20)::INT + 1, (least(length(raw_text), e + 20) - greatest(0, s - 20))::INT), '근처|까지')")
_verify("detect_verify_right", _rule("component_right_context", "^[다었]", "c2", 3), f"regexp_matches({_RIGHT}, '^[다었]')")
_verify("detect_verify_left", _rule("component_left_context", "한$", "c1", 2), f"regexp_matches({_LEFT}, '한$')")
_verify("detect_verify_text", _rule("component_text", "없", "c2"), "right(match_text, 1) = '없'")
_verify("detect_verify_leftplus", _rule("left_plus_component_text", "본적$", "c1", 2), f"regexp_matches({_LEFT} || left(match_text, 1), '본적$')")


@query(f"WITH {CANDS} SELECT corpus_domain, count(*) FILTER (WHERE NOT regexp_matches(raw_text, '했다')) AS kept, count(*) FILTER (WHERE regexp_matches(raw_text, '했다')) AS rejected FROM cands GROUP BY 1")
def detect_kept_rejected(spark, sf_dir):
    got = found(spark, sf_dir, test_bundle(_rule("raw_sentence", "했다")), ["u_exp"]).where("size(candidates) + size(rejected) > 0")
    return got.groupBy("corpus_domain").agg(F.sum(F.size("candidates")).alias("kept"), F.sum(F.size("rejected")).alias("rejected"))


@query(f"WITH {CORPUS} SELECT corpus_domain, sum(coalesce(least(len(regexp_extract_all(raw_text, '{EXP}')), 1), 0))::BIGINT AS matches, sum(CASE WHEN len(regexp_extract_all(raw_text, '{EXP}')) > 1 THEN 1 ELSE 0 END)::BIGINT AS truncated FROM corpus GROUP BY 1")
def detect_summary(spark, sf_dir):
    got = found(spark, sf_dir, units=["u_exp"], only_hits=False, max_matches_per_rule=1)
    return got.groupBy("corpus_domain").agg(F.sum("summary.n_detect_matches").alias("matches"), F.sum("summary.n_matches_truncated").alias("truncated"))


@query(f"WITH {CORPUS}, {sql_spans('w', 'corpus', WHY, 'text_id')} SELECT text_id, s || ':' || e AS span_key, 'regex_match' AS span_source FROM w")
def detect_realtime(spark, sf_dir):
    return exploded(found(spark, sf_dir, units=["ps_why"], realtime=True)).select("text_id", "c.span_key", "c.span_source")


# ---- spans ----------------------------------------------------------------------------------------------------


@query(f"WITH {CORPUS}, {sql_spans('x', 'corpus', '[0-9]+월|[A-Za-z]+', 'text_id')} SELECT text_id, s, e FROM x")
def span_scan(spark, sf_dir):
    got = corpus(spark, sf_dir).select("text_id", F.explode(finditer_spans(F.col("raw_text"), "[0-9]+월|[A-Za-z]+")).alias("x"))
    return longs(got.select("text_id", "x.s", "x.e"))


@query(f"WITH {CORPUS}, {sql_spans('x', 'corpus', '[0-9]+', 'text_id')} SELECT text_id, count(*) FILTER (WHERE k <= 2) AS matches, (max(k) > 2)::INT::BIGINT AS truncated FROM x GROUP BY 1")
def span_scan_capped(spark, sf_dir):
    got = corpus(spark, sf_dir).select("text_id", F.size(finditer_spans(F.col("raw_text"), "[0-9]+", 3)).alias("n")).where("n > 0")
    return longs(got.select("text_id", F.least("n", F.lit(2)).alias("matches"), (F.col("n") > 2).cast("int").alias("truncated")))


_HITS = "h AS (SELECT DISTINCT hit_id, raw_text, TRY_CAST(span_segments AS BIGINT[][]) AS segs, span_segments, TRY_CAST(regex_match_span AS BIGINT[]) AS rm FROM search_corpus WHERE hit_id IS NOT NULL AND raw_text IS NOT NULL), ok AS (SELECT * FROM h WHERE len(segs) > 0 AND list_bool_and(list_transform(segs, lambda p: p[1] >= 0 AND p[1] < p[2] AND p[2] <= length(raw_text))) AND list_bool_and(list_transform(range(2, len(segs) + 1), lambda i: segs[i][1] >= segs[i - 1][2])) IS DISTINCT FROM FALSE)"


def hits(spark: SparkSession, sf_dir: str, good: bool = True) -> DataFrame:
    rows = table(spark, sf_dir, "search_corpus").select("hit_id", "raw_text", "span_segments", "regex_match_span", "regex_match_text").where("hit_id is not null and raw_text is not null").distinct()
    rows = rows.withColumn("segs", P.parse_spans(F.col("span_segments")))
    return rows.where(P.valid(F.col("raw_text"), F.col("segs"))) if good else rows


def _span_query(name: str, column, sql: str) -> None:  # noqa: ANN001
    def run(spark, sf_dir):
        return hits(spark, sf_dir).select("hit_id", column(F.col("raw_text"), F.col("segs")).alias("value"))

    run.__name__ = name
    query(f"WITH {_HITS} SELECT hit_id, {sql} AS value FROM ok")(run)


_PIECE = "substring(raw_text, p[1]::INT + 1, (p[2] - p[1])::INT)"
_span_query("span_key", lambda t, x: P.span_key(x), "list_aggregate(list_transform(segs, lambda p: p[1] || ':' || p[2]), 'string_agg', '|')")
_span_query("span_text", P.span_text, f"list_aggregate(list_transform(segs, lambda p: {_PIECE}), 'string_agg', ' ... ')")
_span_query("span_format", lambda t, x: P.format_spans(x), "'[' || list_aggregate(list_transform(segs, lambda p: '[' || p[1] || ',' || p[2] || ']'), 'string_agg', ',') || ']'")
_span_query("span_window", lambda t, x: P.char_window(t, x, 7)["text"], "substring(raw_text, greatest(0, list_min(list_transform(segs, lambda p: p[1])) - 7)::INT + 1, (least(length(raw_text), list_max(list_transform(segs, lambda p: p[2])) + 7) - greatest(0, list_min(list_transform(segs, lambda p: p[1])) - 7))::INT)")
_span_query("span_envelope", lambda t, x: P.span_key(F.array(P.envelope(x))), "list_min(list_transform(segs, lambda p: p[1])) || ':' || list_max(list_transform(segs, lambda p: p[2]))")
_span_query("span_markers", P.inject_markers, f"list_aggregate(list_transform(range(1, len(segs) + 1), lambda i: substring(raw_text, (CASE WHEN i = 1 THEN 0 ELSE segs[i - 1][2] END)::INT + 1, (segs[i][1] - CASE WHEN i = 1 THEN 0 ELSE segs[i - 1][2] END)::INT) || '[SPAN]' || substring(raw_text, segs[i][1]::INT + 1, (segs[i][2] - segs[i][1])::INT) || '[/SPAN]'), 'string_agg', '') || substring(raw_text, segs[len(segs)][2]::INT + 1)")


@query(f"WITH {_HITS} SELECT h.hit_id, CASE WHEN h.segs IS NULL OR len(h.segs) = 0 THEN 'parse_error' WHEN ok.hit_id IS NOT NULL THEN 'parsed' ELSE 'bad' END AS status FROM h LEFT JOIN ok USING (hit_id, raw_text, span_segments)")
def span_parse_status(spark, sf_dir):
    s = P.inspect(F.col("raw_text"), F.col("span_segments"))["status"]
    return hits(spark, sf_dir, good=False).select("hit_id", F.when(s.isin("parsed", "parse_error"), s).otherwise("bad").alias("status"))


@query(f"WITH {_HITS} SELECT hit_id, list_bool_or(list_transform(segs, lambda p: greatest(p[1], rm[1]) < least(p[2], rm[2]))) AS overlaps FROM ok WHERE len(rm) = 2")
def span_overlap(spark, sf_dir):
    m = F.from_json("regex_match_span", "array<int>")
    return hits(spark, sf_dir).withColumn("m", m).where("size(m) = 2").select("hit_id", P.overlap(F.col("segs"), F.array(P.span(F.col("m")[0], F.col("m")[1]))).alias("overlaps"))


@query(f"WITH {_HITS}, a AS (SELECT hit_id, raw_text, unnest(segs) AS p FROM ok), b AS (SELECT *, lag(p[2]) OVER (PARTITION BY hit_id, raw_text ORDER BY p[1]) AS prev FROM a), c AS (SELECT *, sum(CASE WHEN prev IS NULL OR regexp_matches(substring(raw_text, prev::INT + 1, (p[1] - prev)::INT), '[^{_SQLWS}]') THEN 1 ELSE 0 END) OVER (PARTITION BY hit_id, raw_text ORDER BY p[1]) AS g FROM b), d AS (SELECT hit_id, raw_text, g, min(p[1]) AS s, max(p[2]) AS e FROM c GROUP BY 1, 2, 3) SELECT hit_id, string_agg(s || ':' || e, '|' ORDER BY s) AS value FROM d GROUP BY hit_id, raw_text")
def span_merge_gaps(spark, sf_dir):
    return hits(spark, sf_dir).select("hit_id", P.span_key(P.merge_gaps(F.col("raw_text"), F.col("segs"))).alias("value"))


# ---- Hangul and bridges ---------------------------------------------------------------------------------------


@query(f"WITH {CORPUS}, ch AS (SELECT text_id, unnest(string_split(raw_text, '')) AS c FROM corpus), u AS (SELECT text_id, unicode(c) AS u FROM ch WHERE c <> '') SELECT text_id, count(*) AS n FROM u WHERE u BETWEEN {BASE} AND 55203 AND (u - {BASE}) % {FINALS} = {final_index('ㄴ')} GROUP BY 1")
def hangul_final_consonant(spark, sf_dir):
    chars = corpus(spark, sf_dir).select("text_id", F.explode(F.split("raw_text", "")).alias("c")).where("c <> ''")
    return chars.where(has_final(F.col("c"), "ㄴ")).groupBy("text_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CORPUS}, {sql_spans('x', 'corpus', '[것거게건걸]', 'text_id')} SELECT text_id, s, e FROM x")
def bridge_thing(spark, sf_dir):
    got = corpus(spark, sf_dir).select("text_id", F.explode(BRIDGES["thing"].find(F.col("raw_text"), [])).alias("x"))
    return longs(got.select("text_id", "x.s", "x.e"))


@query(f"WITH {CORPUS}, ch AS (SELECT text_id, unnest(string_split(raw_text, '')) AS c FROM corpus) SELECT text_id, count(*) AS n FROM ch WHERE c IN ('ㄴ', chr(4523), '은') OR c <> '' AND unicode(c) BETWEEN {BASE} AND 55203 AND (unicode(c) - {BASE}) % {FINALS} = {final_index('ㄴ')} GROUP BY 1")
def bridge_adnominal(spark, sf_dir):
    got = corpus(spark, sf_dir).select("text_id", F.size(BRIDGES["adnominal_n"].find(F.col("raw_text"), [])).cast("long").alias("n"))
    return got.where("n > 0")


# ---- sampling -------------------------------------------------------------------------------------------------

_LINES = f"ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), cut AS (SELECT line, string_split(line, ':')[-1] AS tail FROM ln), p AS (SELECT CASE WHEN {sql_trim('line')} = '' OR NOT contains(line, ':') THEN 'parse_error' WHEN {sql_trim('left(line, length(line) - length(tail) - 1)')} = '' THEN 'empty' ELSE 'valid' END AS status, {sql_trim('left(line, length(line) - length(tail) - 1)')} AS t, {sql_trim('tail')} AS src FROM cut)"


@query(f"WITH {_LINES} SELECT status, count(*) AS lines, sum(CASE WHEN status = 'parse_error' THEN 0 ELSE length(t) END)::BIGINT AS text_chars, sum(CASE WHEN status = 'parse_error' THEN 0 ELSE length(src) END)::BIGINT AS source_chars FROM p GROUP BY 1")
def corpus_line_parse(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line")).select(sampling.parse_line(F.col("line"), ":").alias("p"))
    size = lambda c: F.sum(F.coalesce(F.length(c), F.lit(0)))
    return rows.groupBy("p.status").agg(F.count(F.lit(1)).alias("lines"), size("p.text").alias("text_chars"), size("p.source").alias("source_chars"))


@query(f"SELECT coalesce(nullif({sql_trim('corpus_domain')}, ''), 'unknown') AS corpus_domain, count(*) AS n_seen, count(*) FILTER (WHERE {sql_trim('raw_text')} <> '' AND contains(raw_text, ' ')) AS n_valid FROM search_corpus GROUP BY 1")
def corpus_domain_report(spark, sf_dir):
    rows = table(spark, sf_dir, "search_corpus").select(F.coalesce(F.nullif(trim_ws("corpus_domain"), F.lit("")), F.lit("unknown")).alias("corpus_domain"), F.when((trim_ws("raw_text") != "") & F.contains("raw_text", F.lit(" ")), "valid").otherwise("empty").alias("status"))
    return sampling.domain_report(rows).select("corpus_domain", "n_seen", "n_valid")


def _corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "search_corpus").where("text_id is not null and raw_text is not null and source_line_no is not null and corpus_domain is not null")
    return rows.groupBy(F.lower(trim_ws("corpus_domain")).alias("corpus_domain"), "source_file", F.col("source_line_no").cast("long").alias("source_line_no")).agg(F.min("raw_text").alias("raw_text"))


_PLAN = [("news", 0, 0, 40), ("news", 1, 40, 40), ("daily_conversation", 0, 5, 60), ("lecture_notes", 2, 0, 1_000_000)]
_RANKED = f"ln AS (SELECT lower({sql_trim('corpus_domain')}) AS corpus_domain, source_file, source_line_no::BIGINT AS source_line_no, min(raw_text) AS raw_text FROM search_corpus WHERE text_id IS NOT NULL AND raw_text IS NOT NULL AND source_line_no IS NOT NULL AND corpus_domain IS NOT NULL GROUP BY 1, 2, 3), hashed AS (SELECT *, sha256(concat_ws(chr(9), '17', corpus_domain, source_file, source_line_no::VARCHAR, raw_text)) AS sample_hash FROM ln), ranked AS (SELECT *, row_number() OVER (PARTITION BY corpus_domain ORDER BY sample_hash, source_line_no) - 1 AS sample_rank FROM hashed), plan(domain, batch_index, rank_start, requested) AS (VALUES {', '.join(map(str, _PLAN))})"


def _plan(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_PLAN, "domain string, batch_index long, rank_start long, requested long")


@query(f"WITH {_RANKED} SELECT corpus_domain, batch_index::BIGINT AS batch_index, sample_rank, sample_hash, corpus_domain || '_b' || lpad(batch_index::VARCHAR, 3, '0') || '_' || lpad((sample_rank - rank_start + 1)::VARCHAR, 6, '0') AS text_id FROM ranked JOIN plan ON corpus_domain = domain AND sample_rank >= rank_start AND sample_rank < rank_start + requested")
def sample_rank_slice(spark, sf_dir):
    got = sampling.slice_ranks(_corpus_lines(spark, sf_dir), _plan(spark), 17)
    return longs(got.select("corpus_domain", "batch_index", "sample_rank", "sample_hash", "text_id"))


@query(f"WITH {_RANKED}, got AS (SELECT corpus_domain, count(*) AS n, min(sample_hash) AS a, max(sample_hash) AS b FROM ranked JOIN plan ON corpus_domain = domain AND batch_index = 0 AND sample_rank >= rank_start AND sample_rank < rank_start + requested GROUP BY 1) SELECT domain AS corpus_domain, requested::BIGINT AS requested, coalesce(n, 0) AS n_selected, a AS hash_min, b AS hash_max, coalesce(n, 0) < requested AS short FROM plan LEFT JOIN got ON corpus_domain = domain WHERE batch_index = 0")
def sample_report(spark, sf_dir):
    own = _plan(spark).where("batch_index = 0")
    return longs(sampling.selection_report(sampling.slice_ranks(_corpus_lines(spark, sf_dir), own, 17), own))


_SCHED = "s AS (SELECT batch_id_prefix, unnest(sampling_schedules) AS s, generate_subscripts(sampling_schedules, 1) AS k FROM example_making_manifest), b AS (SELECT DISTINCT batch_index FROM batch_runs WHERE batch_index IS NOT NULL), m AS (SELECT batch_id_prefix, batch_index, s.schedule_id, row_number() OVER (PARTITION BY batch_id_prefix, batch_index ORDER BY s.start_batch_index DESC, k DESC) AS n FROM s JOIN b ON s.start_batch_index <= batch_index AND coalesce(s.end_batch_index, 1000000) >= batch_index)"


@query(f"WITH {_SCHED} SELECT batch_id_prefix, batch_index::BIGINT AS batch_index, schedule_id FROM m WHERE n = 1")
def sample_schedule_lookup(spark, sf_dir):
    batches = table(spark, sf_dir, "batch_runs").select("batch_index").where("batch_index is not null").distinct()
    return longs(sampling.schedule_lookup(table(spark, sf_dir, "example_making_manifest"), batches))


# ---- bundles --------------------------------------------------------------------------------------------------


@query("SELECT unit_id, m AS member FROM (SELECT unit_id, unnest(member_e_ids) AS m FROM runtime_units) WHERE m NOT IN (SELECT e_id FROM items WHERE e_id IS NOT NULL)")
def bundle_fk_violations(spark, sf_dir):
    return B.member_violations(table(spark, sf_dir, "runtime_units"), table(spark, sf_dir, "items"))


_ITEMS = f"i AS (SELECT nullif({sql_trim('e_id')}, '') AS id, lower(nullif({sql_trim('\"group\"')}, '')) AS g, coalesce(nullif({sql_trim('ps_id')}, ''), nullif({sql_trim('polyset_id')}, '')) AS ps, nullif({sql_trim('canonical_form')}, '') AS form, disconti_allowed, e_comp_ids, nullif({sql_trim('gloss')}, '') AS gloss FROM items)"


@query(f"WITH {_ITEMS} SELECT 'item_duplicate' AS code, id FROM i WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'item_blank_id', id FROM i WHERE id IS NULL UNION ALL SELECT 'item_group', id FROM i WHERE g NOT IN ('a', 'b', 'c') UNION ALL SELECT 'warn_c_without_ps', id FROM i WHERE g = 'c' AND ps IS NULL")
def bundle_item_violations(spark, sf_dir):
    return B.item_violations(table(spark, sf_dir, "items"))


@query(f"WITH {_ITEMS}, f AS (SELECT DISTINCT ps, id, coalesce(form, id) AS form, {sql_trim("regexp_replace(coalesce(form, id), '[0-9]+$', '')")} AS bare, disconti_allowed, nullif(regexp_replace(gloss, '\\.+$', ''), '') AS gloss FROM i WHERE ps IS NOT NULL AND id IS NOT NULL) SELECT ps AS ps_id, count(DISTINCT id) AS members, CASE WHEN count(DISTINCT bare) = 1 THEN min(bare) ELSE string_agg(form, '/' ORDER BY id) END AS canonical_form, coalesce(bool_or(disconti_allowed), false) AS disconti_allowed, coalesce(string_agg(gloss, '; ' ORDER BY id), '') AS encoder_gloss FROM f GROUP BY 1")
def bundle_polysets(spark, sf_dir):
    return longs(B.polysets(table(spark, sf_dir, "items")).select("ps_id", F.size("member_e_ids").alias("members"), "canonical_form", "disconti_allowed", "encoder_gloss"))


@query(f"WITH {_ITEMS} SELECT coalesce(ps, id) AS unit_id, CASE WHEN count(DISTINCT id) > 1 THEN 'polyset' ELSE 'item' END AS unit_type, CASE WHEN count(DISTINCT g) > 1 THEN 'mixed' ELSE min(g) END AS \"group\", string_agg(DISTINCT id, ';' ORDER BY id) AS member_e_ids, count(DISTINCT id) AS n_members FROM i WHERE id IS NOT NULL GROUP BY 1")
def bundle_runtime_units(spark, sf_dir):
    return longs(B.runtime_units(table(spark, sf_dir, "items")))


@query("WITH a AS (SELECT e_id || '.' || k AS path, v FROM (SELECT e_id, unnest(['form', 'gloss', 'group']) AS k, unnest([canonical_form, gloss, \"group\"]) AS v FROM items)), b AS (SELECT m || '.' || k AS path, v FROM (SELECT m, unnest(['form', 'gloss']) AS k, unnest([canonical_form, gloss]) AS v FROM (SELECT unnest(member_e_ids) AS m, canonical_form, gloss FROM runtime_units))) SELECT path, CASE WHEN a.path IS NULL THEN '<missing>' ELSE a.v END AS expected, CASE WHEN b.path IS NULL THEN '<missing>' ELSE b.v END AS actual FROM a FULL JOIN b USING (path) WHERE a.path IS NULL OR b.path IS NULL OR a.v IS DISTINCT FROM b.v")
def bundle_sync_diff(spark, sf_dir):
    leaves = lambda df, key, cols: df.select(F.explode(F.array(*[F.struct(F.concat(F.col(key), F.lit("." + n)).alias("path"), F.col(c).alias("value")) for n, c in cols])).alias("x")).select("x.*")
    units = table(spark, sf_dir, "runtime_units").select(F.explode("member_e_ids").alias("m"), "canonical_form", "gloss")
    return sync.diff(leaves(table(spark, sf_dir, "items"), "e_id", [("form", "canonical_form"), ("gloss", "gloss"), ("group", "group")]), leaves(units, "m", [("form", "canonical_form"), ("gloss", "gloss")]))


@query("SELECT unit_id, row_number() OVER (ORDER BY unit_id) AS place FROM runtime_units WHERE unit_id >= 'ps_' QUALIFY place >= 3")
def unit_selection(spark, sf_dir):
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy("unit_id"))  # a unit manifest: 22 rows
    return longs(table(spark, sf_dir, "runtime_units").where("unit_id >= 'ps_'").select("unit_id", place.alias("place")).where("place >= 3"))


# ---- review rows of our own detections ------------------------------------------------------------------------


@query(f"WITH {CANDS} SELECT text_id || '-cand' || lpad(k::VARCHAR, 2, '0') AS hit_id, k::VARCHAR AS candidate_index, corpus_domain, '[' || s || ',' || e || ']' AS regex_match_span, '[[' || replace(replace(span_key, ':', ','), '|', '],[') || ']]' AS span_segments, '[\"r_exp\"]' AS detect_rule_ids, 'true' AS component_span_enabled, '' AS human_label FROM cands")
def review_rows(spark, sf_dir):
    rows = review.review_rows(found(spark, sf_dir, units=["u_exp"]))
    return rows.select("hit_id", "candidate_index", "corpus_domain", "regex_match_span", "span_segments", "detect_rule_ids", "component_span_enabled", "human_label")


@query(f"WITH {CORPUS}, t AS (SELECT coalesce(nullif(corpus_domain, ''), 'unknown') AS d, coalesce(len(regexp_extract_all(raw_text, '{EXP}')), 0) AS n FROM corpus) SELECT CASE WHEN grouping(d) = 1 THEN 'total' ELSE 'domain' END AS dimension, CASE WHEN grouping(d) = 1 THEN '' ELSE d END AS value, count(*) AS texts, count(*) FILTER (WHERE n > 0) AS hit_texts, sum(n)::BIGINT AS candidates FROM t GROUP BY GROUPING SETS ((d), ()) UNION ALL SELECT x.a, x.b, NULL, NULL, sum(n)::BIGINT FROM t, (VALUES ('unit', 'u_exp'), ('span_source', 'component_spans'), ('status', 'ok')) x(a, b) GROUP BY 1, 2")
def review_grouping_sets(spark, sf_dir):
    return review.search_report(found(spark, sf_dir, units=["u_exp"], only_hits=False))


_TWO = "CASE WHEN e - s = 2 OR substring(raw_text, s::INT + 2, (e - s)::INT - 2) = ' ' THEN s || ':' || e ELSE s || ':' || (s + 1) || '|' || (e - 1) || ':' || e END AS span_key, CASE WHEN e - s = 2 OR substring(raw_text, s::INT + 2, (e - s)::INT - 2) = ' ' THEN match_text ELSE left(match_text, 1) || ' ... ' || right(match_text, 1) END AS span_text, 'component_spans' AS span_source"


@query(f"WITH c AS (SELECT row_number() OVER () AS rid, text_id, raw_text FROM search_corpus WHERE raw_text IS NOT NULL), {sql_spans('x', 'c', EXP, 'rid, text_id')}, {sql_spans('y', 'c', CAN, 'rid, text_id')}, {sql_spans('z', 'c', WHY, 'rid, text_id')} SELECT text_id, 'u_exp' AS unit_id, {_TWO} FROM x UNION ALL SELECT text_id, 'u_can', {_TWO} FROM y UNION ALL SELECT text_id, 'ps_why', s || ':' || e, match_text, 'regex_match' FROM z")
def stream_realtime_detect(spark, sf_dir):
    """A stream over the texts' file, run to its end, with the same columns as in batch."""
    import os

    from ..session import Scratch
    from ..streaming.realtime import realtime, stream_texts

    at = f"{sf_dir}/search_corpus.parquet"
    schema = table(spark, sf_dir, "search_corpus").schema
    # A stream reads folders: a table of one file is read by its name as a glob.
    source = stream_texts(spark, at if os.path.isdir(at) else at.replace("search_corpus", "search_corpu[s]"), schema).select("text_id", "raw_text")
    scratch = Scratch(spark, "stream")
    realtime(source, test_bundle(), UNITS).writeStream.format("parquet").option("path", scratch.path("out")).option("checkpointLocation", scratch.path("offsets")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("text_id string, unit_id string, span_key string, span_text string, span_source string").parquet(scratch.path("out"))




def queries() -> dict:
    from . import catalogue_labels, catalogue_more

    return QUERIES | catalogue_labels.QUERIES | catalogue_more.QUERIES


def oracle_sql() -> dict[str, str]:
    from . import catalogue_labels, catalogue_more

    return SQL | catalogue_labels.SQL | catalogue_more.SQL
