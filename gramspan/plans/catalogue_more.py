"""Registered queries on component search, bridges, sources and sinks, bundles, runs and evaluation, and their SQL.

The SQL is written by hand: nothing in it is made from what the library computes with.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bridges, hangul
from ..functions import spans as P
from ..functions.textfn import blank_to_null
from ..operators import bundle as B
from ..operators import evaluate, labels, pairs, profiles, review, sampling, sync
from ..operators.detect import Options, detect, search_debug
from ..session import Scratch, shared_dir
from ..sources import files, lines, xlsx
from . import pipeline
from .catalogue import _SQLWS, CORPUS, _corpus_lines, _RANKED, corpus, exploded, longs, sql_spans, sql_trim, table
from .catalogue_labels import E, GOLD, J, _PAIR, _SPLIT, _examples, gold_of, kept, rows_of

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def folder(spark: SparkSession, name: str) -> str:
    """A folder for single files beside the tables that runs leave in the shared folder."""
    at = f"{shared_dir(spark).removeprefix('file://')}/{name}_{uuid.uuid4().hex[:8]}"
    os.makedirs(at)
    return at


# ---- component search -----------------------------------------------------------------------------------------
# A rule finds 기 때문; its components are looked for 20 characters around each match, and SQL lists their places as
# (distance to the match, place), nearest first.

_DUE = r"기 ?때문"
_WIN = f"""{CORPUS}, {sql_spans("x", "corpus", _DUE, "text_id")},
w AS (SELECT text_id, raw_text, k, match_text, s, e, greatest(0, s - 20) AS lo, substring(raw_text, greatest(0, s - 20)::INT + 1, (least(length(raw_text), e + 20) - greatest(0, s - 20))::INT) AS win FROM x)"""


def _places(word: str) -> str:
    n = len(word)
    at = f"list_transform(list_filter(range(1, length(win) + 1), lambda i: substring(win, i::INT, {n}) = '{word}'), lambda i: lo + i - 1)"
    return f"list_sort(list_transform({at}, lambda p: {{'d': CASE WHEN p + {n} <= s THEN s - p - {n} WHEN p >= e THEN p - e ELSE 0 END, 'p': p}}))"


def _due(spark: SparkSession, sf_dir: str, comps: list[B.Component], *verify: B.Rule, **options) -> DataFrame:  # noqa: ANN003
    unit = B.Unit("due", "item", "a", ("due",), "기 때문", None, ("d_due",), ("v_due",) if verify else ())
    made = B.Bundle([unit], [B.Rule("due", "d_due", "r_due", "detect", _DUE), *verify], comps)
    return detect(corpus(spark, sf_dir), made, ["due"], options=Options(**options), only_hits=True)


def _pick(df: DataFrame, *columns, what: str = "candidates") -> DataFrame:  # noqa: ANN001, ANN002
    """Candidates by the match they come from."""
    return longs(exploded(df, what).select("text_id", F.col("c.regex_match_span.s").cast("long").alias("s"), *columns))


_C = lambda cid, word, order, **more: B.Component("due", cid, word, comp_order=order, **more)


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('기')} AS a, {_places('없')} AS b FROM w) SELECT text_id, s, CASE WHEN len(b) = 0 THEN 'partial_required_components' WHEN list_min(list_transform(a, lambda x: x.p)) < list_max(list_transform(b, lambda x: x.p)) THEN 'ok' ELSE 'no_ordered_component_path' END AS status, CASE WHEN len(b) = 0 THEN 'c1' ELSE 'c1,c2' END AS matched, CASE WHEN len(b) = 0 THEN 'c2' ELSE '' END AS missing, CASE WHEN len(b) > 0 AND list_min(list_transform(a, lambda x: x.p)) < list_max(list_transform(b, lambda x: x.p)) THEN '' WHEN len(b) = 0 THEN a[1].p || ':' || (a[1].p + 1) ELSE NULL END AS partial FROM f")
def detect_partial(spark, sf_dir):
    got = _due(spark, sf_dir, [_C("c1", "기", 1), _C("c2", "없", 2)])
    partial = F.when(F.col("c.component_span_status") != "no_ordered_component_path", F.col("c.partial_span_key"))
    return _pick(got, F.col("c.component_span_status").alias("status"), F.array_join("c.matched_component_ids", ",").alias("matched"), F.array_join("c.missing_required_component_ids", ",").alias("missing"), partial.alias("partial"))


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('다')} AS b FROM w) SELECT text_id, s, CASE WHEN len(b) = 0 THEN 'partial_required_components' WHEN b[1].p > s THEN 'ok' ELSE 'no_ordered_component_path' END AS status, CASE WHEN len(b) > 0 AND b[1].p > s THEN b[1].p END AS place FROM f")
def detect_component_cap(spark, sf_dir):
    """Only the nearest place of each component counts."""
    got = _due(spark, sf_dir, [_C("c1", "기", 1), _C("c2", "다", 2)], max_candidates_per_component=1)
    return _pick(got, F.col("c.component_span_status").alias("status"), F.try_element_at("c.component_spans", F.lit("c2"))["s"].alias("place"))


_BEST = "list_sort(flatten(list_transform(a, lambda x: list_transform(list_filter(b, lambda y: y.p > x.p), lambda y: {'d': x.d + y.d, 'g': y.p - x.p - 1, 's': x.p, 'y': y.p}))))"


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('기')} AS a, {_places('다')} AS b FROM w), g AS (SELECT text_id, s, {_BEST} AS paths FROM f) SELECT text_id, s, paths[1].s AS c1, paths[1].y AS c2 FROM g WHERE len(paths) > 0")
def detect_best_path(spark, sf_dir):
    """Of all ordered paths the one nearest to the match, then the one with the smallest gap."""
    got = _pick(_due(spark, sf_dir, [_C("c1", "기", 1), _C("c2", "다", 2)]), F.try_element_at("c.component_spans", F.lit("c1"))["s"].alias("c1"), F.try_element_at("c.component_spans", F.lit("c2"))["s"].alias("c2"))
    return longs(got.where("c1 is not null"))


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('기')} AS a, {_places('다')} AS b FROM w), g AS (SELECT text_id, s, list_filter(a, lambda x: list_max(list_transform(b, lambda y: y.p)) > x.p)[1] AS x, b FROM f) SELECT text_id, s, x.p AS c1, list_filter(b, lambda y: y.p > x.p)[1].p AS c2 FROM g WHERE x IS NOT NULL")
def detect_path_budget(spark, sf_dir):
    """A budget of one path: the first that the search completes, nearest places first."""
    got = _pick(_due(spark, sf_dir, [_C("c1", "기", 1), _C("c2", "다", 2)], max_component_paths=1), F.try_element_at("c.component_spans", F.lit("c1"))["s"].alias("c1"), F.try_element_at("c.component_spans", F.lit("c2"))["s"].alias("c2"))
    return longs(got.where("c1 is not null"))


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('기')} AS a, {_places('때문')} AS b FROM w) SELECT text_id, s, CASE WHEN len(list_filter(flatten(list_transform(a, lambda x: list_transform(b, lambda y: y.p - x.p - 1))), lambda g: g = 1)) > 0 THEN 'ok' ELSE 'no_ordered_component_path' END AS status FROM f")
def detect_gap_bounds(spark, sf_dir):
    """Exactly one character between the two components."""
    got = _due(spark, sf_dir, [_C("c1", "기", 1, min_gap_to_next=1, max_gap_to_next=1), _C("c2", "때문", 2)])
    return _pick(got, F.col("c.component_span_status").alias("status"))


_ORDERED = "len(list_filter(flatten(list_transform(b, lambda y: list_transform(a, lambda x: x.p - y.p))), lambda g: g >= 2)) > 0"


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('기')} AS a, {_places('때문')} AS b FROM w) SELECT text_id, s, 'fixed' AS policy, CASE WHEN {_ORDERED} THEN 'ok' ELSE 'no_ordered_component_path' END AS status FROM f UNION ALL SELECT text_id, s, 'anchored', CASE WHEN {_ORDERED} THEN 'ok' ELSE 'no_ordered_component_path' END FROM f UNION ALL SELECT text_id, s, 'free', 'ok' FROM f")
def detect_swap_anchor(spark, sf_dir):
    """Components stated the wrong way round: found if both are free to swap, not if the order is fixed or one is the anchor."""
    out = None
    for policy, kind in (("fixed", {}), ("anchored", {"order_policy": "fl"}), ("free", {"order_policy": "fl"})):
        comps = [_C("c1", "때문", 1, anchor_rank=1 if policy == "anchored" else None, **kind), _C("c2", "기", 2, **kind)]
        one = _pick(_due(spark, sf_dir, comps), F.lit(policy).alias("policy"), F.col("c.component_span_status").alias("status"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('기')} AS a, {_places('없')} AS b FROM w) SELECT text_id, s, lo AS search_start, least(length(raw_text), e + 20) AS search_end, least(20, len(a)) AS n1, least(20, len(b)) AS n2 FROM f")
def detect_search_debug(spark, sf_dir):
    comps = [_C("c1", "기", 1), _C("c2", "없", 2)]
    rows = _pick(_due(spark, sf_dir, []), F.col("raw_text"), F.col("c.regex_match_span").alias("m")).withColumn("x", search_debug(F.col("raw_text"), F.col("m"), comps, Options()))
    return longs(rows.select("text_id", "s", "x.search_start", "x.search_end", F.col("x.candidate_counts")["c1"].alias("n1"), F.col("x.candidate_counts")["c2"].alias("n2")))


@query(f"WITH {_WIN}, f AS (SELECT *, {_places('없')} AS b, left(regexp_replace(substring(raw_text, s::INT + 2), '[{_SQLWS}]+', '', 'g'), 20) AS r FROM w) SELECT text_id, s, regexp_matches(r, '다') AS failed FROM f WHERE len(b) = 0")
def detect_verify_clamped(spark, sf_dir):
    """A rule on a component that was found beside one that was not, with more context than is allowed: 20 characters are looked at."""
    rule = B.Rule("due", "v_due", "v", "verify", "다", "component_right_context", hard_fail=True, component_id="c1", context_chars=99)
    got = _due(spark, sf_dir, [_C("c1", "기", 1), _C("c2", "없", 2)], rule)
    pick = lambda what, failed: _pick(got.where("true"), F.col("c.component_span_status").alias("status"), F.lit(failed).alias("failed"), what=what)
    return pick("candidates", False).unionByName(pick("rejected", True)).where("status = 'partial_required_components'").drop("status")


@query("SELECT * FROM (VALUES ('window', true), ('matches', true), ('candidates', true), ('paths', true), ('defaults', false)) t(setting, refused)")
def detect_option_checks(spark, sf_dir):
    def refused(**kw) -> bool:  # noqa: ANN003
        try:
            Options(**kw)
        except ValueError:
            return True
        return False

    cases = {"window": {"component_window_chars": -1}, "matches": {"max_matches_per_rule": 0}, "candidates": {"max_candidates_per_component": 0}, "paths": {"max_component_paths": 0}, "defaults": {}}
    return spark.createDataFrame([(k, refused(**v)) for k, v in cases.items()], "setting string, refused boolean")


@query("WITH u AS (SELECT unit_id, unit_type FROM runtime_units) SELECT 'named' AS selection, string_agg(unit_id, ',' ORDER BY unit_id DESC) AS units FROM u WHERE unit_type = 'item' UNION ALL SELECT 'all', string_agg(unit_id, ',' ORDER BY unit_id) FROM u UNION ALL SELECT 'none', 'refused' UNION ALL SELECT 'unknown', 'refused' UNION ALL SELECT 'polyset', 'refused'")
def bundle_unit_selection(spark, sf_dir):
    rows = table(spark, sf_dir, "runtime_units").select("unit_id", "unit_type").collect()  # a catalogue of 22 units
    made = B.Bundle([B.Unit(r["unit_id"], r["unit_type"]) for r in rows], [])

    def chosen(ids, *how: bool) -> str:  # noqa: ANN001
        try:
            return ",".join(u.unit_id for u in made.select(ids, *how))
        except ValueError:
            return "refused"

    items = sorted((r["unit_id"] for r in rows if r["unit_type"] == "item"), reverse=True)
    many = [r["unit_id"] for r in rows if r["unit_type"] == "polyset"][:1]
    return spark.createDataFrame([("named", chosen(items)), ("all", chosen(None, True, True)), ("none", chosen([])), ("unknown", chosen(["nowhere"])), ("polyset", chosen(many))], "selection string, units string")


# ---- Hangul and bridges ---------------------------------------------------------------------------------------


@query("SELECT f.j AS final, count(*) AS n, chr(min(44032 + k + 28 * i)::INT) AS first, chr(max(44032 + k + 28 * i)::INT) AS last FROM (SELECT unnest(string_split('ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ', '')) AS j, generate_subscripts(string_split('ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ', ''), 1) AS k) f, range(399) r(i) GROUP BY 1")
def hangul_syllables(spark, sf_dir):
    rows = [(j, len(x := hangul.syllables_with(j)), x[0], x[-1]) for j in hangul.FINAL_JAMO[1:]]
    return spark.createDataFrame(rows, "final string, n long, first string, last string")


@query(f"WITH {CORPUS}, {sql_spans('x', 'corpus', '.다', 'text_id')} SELECT text_id, count(*) AS n FROM x WHERE unicode(match_text) BETWEEN 44032 AND 55203 AND (unicode(match_text) - 44032) % 28 = 20 GROUP BY 1")
def hangul_final_class(spark, sf_dir):
    """Syllables that end in ㅆ, in pairs with a following 다, by the regex class."""
    from ..functions.textfn import finditer_spans, java_pattern

    pairs_of = corpus(spark, sf_dir).select("text_id", "raw_text", F.explode(finditer_spans(F.col("raw_text"), ".다")).alias("x"))
    return pairs_of.where(P.cut(F.col("raw_text"), F.col("x.s"), F.col("x.e")).rlike(java_pattern(hangul.final_class("ㅆ", "다")))).groupBy("text_id").agg(F.count(F.lit(1)).alias("n"))


_NDE = r"(?:은|는|ㄴ|ᆫ)\s*데(?:요)?|(?:은데|는데|인데|운데)(?:요)?"
_NSYL = "[" + "".join(map(chr, range(44036, 55204, 28))) + "]"


@query(f"WITH {CORPUS}, {sql_spans('x', 'corpus', _NDE.replace(chr(92) + 's', f'[{_SQLWS}]'), 'text_id')}, l AS (SELECT text_id, s, CASE WHEN right(match_text, 1) = '요' THEN e - 1 ELSE e END AS e FROM x), {sql_spans('y', 'corpus', f'{_NSYL} ?데', 'text_id')} SELECT DISTINCT text_id, s, e FROM (SELECT * FROM l UNION ALL SELECT text_id, s, e FROM y)")
def bridge_nde(spark, sf_dir):
    got = corpus(spark, sf_dir).select("text_id", F.explode(bridges.BRIDGES["nde"].find(F.col("raw_text"), ["ㄴ데"])).alias("x"))
    return longs(got.select("text_id", "x.s", "x.e"))


@query(f"WITH {CORPUS}, {sql_spans('x', 'corpus', '까지', 'text_id')} SELECT text_id, count(*) AS n FROM x GROUP BY 1")
def bridge_registered(spark, sf_dir):
    """A bridge added by the extension point is found by its name."""
    from ..functions.textfn import finditer_spans

    bridges.register(bridges.Bridge("until", lambda w, options: finditer_spans(w, "까지"), "까지"))
    got = corpus(spark, sf_dir).select("text_id", F.size(bridges.BRIDGES["until"].find(F.col("raw_text"), [])).cast("long").alias("n")).where("n > 0")
    bridges.BRIDGES.pop("until")
    return got


# ---- sources and sinks ----------------------------------------------------------------------------------------


@query('SELECT e_id, canonical_form, "group", topic, true AS placed FROM items')
def jsonl_roundtrip(spark, sf_dir):
    """Items as JSON lines and back, each with its file and line."""
    at = Scratch(spark, "jsonl").path("items")
    table(spark, sf_dir, "items").write.json(at)
    back = files.read_jsonl(spark, at.removeprefix("file://") + "/*.json", "e_id string, canonical_form string, `group` string, topic string")
    return back.select("e_id", "canonical_form", "group", "topic", (F.col("_source_file").startswith("part-") & (F.col("_line_no") >= 1)).alias("placed"))


@query("SELECT * FROM (VALUES ('blank lines', 'rows 2 at lines 1,4'), ('bad line', 'refused'), ('empty file', 'refused')) t(name, outcome)")
def jsonl_strict(spark, sf_dir):
    at = folder(spark, "strict")

    def outcome(name: str, text: str) -> str:
        with open(f"{at}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
        try:
            got = sorted(r["_line_no"] for r in files.read_jsonl(spark, f"{at}/{name}", "a int", required=True).collect())
        except Exception:  # noqa: BLE001
            return "refused"
        return f"rows {len(got)} at lines {','.join(map(str, got))}"

    cases = {"blank lines": '{"a": 1}\n\n  \n{"a": 2}\n', "bad line": '{"a": 1}\n{"a": \n', "empty file": ""}
    return spark.createDataFrame([(k, outcome(k.replace(" ", "_"), v)) for k, v in cases.items()], "name string, outcome string")


_LINE = r"concat(regexp_replace(raw_text, '[\r\n]+', ' ', 'g'), ';', coalesce(source, ''))"
_CUT = "left(line, length(line) - length(string_split(line, ';')[-1]) - 1)"


@query(f"WITH ln AS (SELECT {_LINE} AS line FROM search_corpus WHERE raw_text IS NOT NULL), p AS (SELECT {sql_trim(_CUT)} AS t, {sql_trim('string_split(line, chr(59))[-1]')} AS src FROM ln) SELECT CASE WHEN t = '' THEN 'empty' ELSE 'valid' END AS status, count(*) AS n, sum(length(t))::BIGINT AS text_chars, sum(length(src))::BIGINT AS source_chars, 2 AS least_line, (SELECT count(*) FROM ln) AS last_row FROM p GROUP BY 1")
def corpus_scan(spark, sf_dir):
    """A delimited corpus with a header, cut into small byte ranges: every line once, numbered from the second."""
    rows = table(spark, sf_dir, "search_corpus").where("raw_text is not null").select(F.concat(F.regexp_replace("raw_text", r"[\r\n]+", " "), F.lit(";"), F.coalesce("source", F.lit(""))).alias("line"))
    at = folder(spark, "corpus")
    with open(f"{at}/corpus.txt", "w", encoding="utf-8-sig", newline="") as f:  # one delimited file, as corpora come
        f.write("sentence;source\n")
        for r in rows.toLocalIterator():
            f.write(r["line"] + "\n")
    got = lines.read_corpus(spark, f"{at}/corpus.txt", "news", split_bytes=200_000)
    ends = got.agg(F.min("source_line_no").alias("least_line"), F.max("source_row_index").alias("last_row"))
    size = lambda c: F.sum(F.length(c))
    per = got.groupBy("status").agg(F.count(F.lit(1)).alias("n"), size("raw_text").alias("text_chars"), size("source").alias("source_chars"))
    return per.join(F.broadcast(ends)).select("status", "n", "text_chars", "source_chars", F.col("least_line").cast("int").alias("least_line"), "last_row")  # ends: one row


@query("SELECT * FROM (VALUES ('sentence;source', true), ('Form;x', true), (' TEXT ;y', true), ('raw_text', true), ('그는 갔다;news', false), ('sentences;source2', false)) t(line, header)")
def header_detection(spark, sf_dir):
    df = spark.createDataFrame([(x,) for x in ("sentence;source", "Form;x", " TEXT ;y", "raw_text", "그는 갔다;news", "sentences;source2")], "line string")
    return df.select("line", sampling.is_header(F.col("line"), ";").alias("header"))


@query("SELECT 'NFC' AS asked, '말뭉치.txt' AS found UNION ALL SELECT 'NFD', '말뭉치.txt' UNION ALL SELECT 'absent', 'refused'")
def path_other_form(spark, sf_dir):
    import unicodedata

    at, name = folder(spark, "names"), "말뭉치.txt"
    with open(f"{at}/{unicodedata.normalize('NFD', name)}", "w", encoding="utf-8") as f:
        f.write("x\n")

    def found(asked: str) -> str:
        try:
            return unicodedata.normalize("NFC", os.path.basename(lines.resolve(f"{at}/{asked}")))
        except FileNotFoundError:
            return "refused"

    return spark.createDataFrame([("NFC", found(name)), ("NFD", found(unicodedata.normalize("NFD", name))), ("absent", found("x.txt"))], "asked string, found string")


_T = lambda c: sql_trim(f"coalesce({c}, '')")
_CELLS = f"SELECT {_T('e_id')} AS e_id, {_T('canonical_form')} AS canonical_form, coalesce(disconti_allowed::VARCHAR, '') AS disconti_allowed, coalesce(to_json(e_comp_ids)::VARCHAR, '') AS e_comp_ids, {_T('gloss')} AS gloss FROM items"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "items").select("e_id", "canonical_form", "disconti_allowed", "e_comp_ids", "gloss")


@query(_CELLS)
def review_csv_roundtrip(spark, sf_dir):
    at = folder(spark, "csv") + "/items.csv"
    files.write_review(_items(spark, sf_dir), at)
    return files.read_review(spark, at, ("e_id",))


@query(_CELLS)
def review_xlsx_roundtrip(spark, sf_dir):
    at = folder(spark, "xlsx") + "/items.xlsx"
    files.write_review(_items(spark, sf_dir), at, "disconti_allowed")
    return files.read_review(spark, at, ("e_id",))


@query("SELECT (row_number() OVER () + 1)::BIGINT AS _row_no, unit_id, unit_type, coalesce(task_unit_kind, '') AS task_unit_kind, coalesce(\"group\", '') AS \"group\", to_json(member_e_ids)::VARCHAR AS member_e_ids, coalesce(canonical_form, '') AS canonical_form, coalesce(gloss, '') AS gloss, coalesce(to_json(detect_ruleset_ids)::VARCHAR, '') AS detect_ruleset_ids, coalesce(to_json(verify_ruleset_ids)::VARCHAR, '') AS verify_ruleset_ids FROM runtime_units")
def xlsx_roundtrip(spark, sf_dir):
    """The units written as a workbook and read again."""
    at = folder(spark, "units") + "/units.xlsx"
    xlsx.write_sheet(files.cells(table(spark, sf_dir, "runtime_units")), at, "units")
    return xlsx.read_sheet(spark, at, "units")


@query("SELECT '.csv' AS kind, count(*) AS n FROM items UNION ALL SELECT '.xlsx', count(*) FROM items UNION ALL SELECT '.txt', NULL UNION ALL SELECT 'lacking', NULL")
def review_dispatch(spark, sf_dir):
    """The reader by suffix; another kind of file and a lacking column are refused."""
    at, out = folder(spark, "kinds"), []
    for kind in (".csv", ".xlsx"):
        files.write_review(_items(spark, sf_dir), f"{at}/items{kind}")
    for kind, name, needed in ((".csv", "items.csv", ()), (".xlsx", "items.xlsx", ()), (".txt", "items.txt", ()), ("lacking", "items.csv", ("nothing",))):
        try:
            out.append((kind, files.read_review(spark, f"{at}/{name}", needed).count()))
        except ValueError:
            out.append((kind, None))
    return spark.createDataFrame(out, "kind string, n long")


@query("SELECT unit_id FROM runtime_units WHERE unit_type = 'polyset'")
def artifact_discovery(spark, sf_dir):
    """Folders of polysets have their file, others lack it; folders of other use are passed over."""
    at = folder(spark, "artifacts")
    for r in [*table(spark, sf_dir, "runtime_units").select("unit_id", "unit_type").collect(), ("tmp", "polyset"), ("archive", "polyset")]:
        os.makedirs(f"{at}/{r[0]}")
        if r[1] == "polyset":
            with open(f"{at}/{r[0]}/{r[0]}_encoder_pair_examples.jsonl", "w", encoding="utf-8") as f:
                f.write("{}\n")
    return spark.createDataFrame([(os.path.basename(os.path.dirname(p)),) for p in files.discover(at)], "unit_id string")


@query("SELECT unit_id || CASE WHEN unit_type = 'polyset' THEN '.xlsx' ELSE '.csv' END AS file FROM runtime_units")
def review_twins(spark, sf_dir):
    names = [(r["unit_id"], r["unit_type"]) for r in table(spark, sf_dir, "runtime_units").select("unit_id", "unit_type").collect()]
    there = [f"r/{u}.csv" for u, _ in names] + [f"r/{u}.xlsx" for u, kind in names if kind == "polyset"]
    return spark.createDataFrame([(os.path.basename(p),) for p in files.prefer_xlsx(there)], "file string")


@query("SELECT coalesce(nullif(corpus_domain, ''), 'unknown') AS name, count(*) AS n FROM search_corpus GROUP BY 1")
def json_report(spark, sf_dir):
    counted = table(spark, sf_dir, "search_corpus").groupBy(F.coalesce(F.nullif(F.col("corpus_domain"), F.lit("")), F.lit("unknown")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    at = folder(spark, "report") + "/report.json"
    files.write_json(at, {"counts": [r.asDict() for r in counted.collect()]})
    return spark.read.json("file://" + at, multiLine=True).select(F.explode("counts").alias("x")).select("x.name", "x.n")


@query("SELECT batch_id, run_id FROM batch_runs")
def progress_log(spark, sf_dir):
    at = Scratch(spark, "progress").path("log")
    for r in table(spark, sf_dir, "batch_runs").select("batch_id", "run_id").collect():  # a row per run
        files.append_progress(spark, at, r.asDict())
    return spark.read.text(at).select(F.from_json("value", "batch_id string, run_id string").alias("x")).select("x.*")


@query("SELECT * FROM (VALUES ('there', true), ('there, overwrite', false), ('absent', false), ('root folder', true), ('own folder', false), ('written', false), ('empty', true), ('never written', true)) t(name, refused)")
def output_guards(spark, sf_dir):
    at = folder(spark, "guards")
    for name, text in (("full", "x"), ("empty", "")):
        with open(f"{at}/{name}", "w", encoding="utf-8") as f:
            f.write(text)

    def refused(f, *args) -> bool:  # noqa: ANN001, ANN002
        try:
            f(*args)
        except (ValueError, FileExistsError):
            return True
        return False

    full, empty, none = f"{at}/full", f"{at}/empty", f"{at}/none"
    rows = [("there", refused(files.guard, [none, full], False)), ("there, overwrite", refused(files.guard, [full], True)), ("absent", refused(files.guard, [none], False)), ("root folder", refused(files.safe_dir, "/")), ("own folder", refused(files.safe_dir, at)), ("written", refused(files.non_empty, full, "x")), ("empty", refused(files.non_empty, empty, "x")), ("never written", refused(files.non_empty, none, "x"))]
    return spark.createDataFrame(rows, "name string, refused boolean")


@query("SELECT (row_number() OVER (ORDER BY group_no, unit_id))::BIGINT AS place, unit_id AS caution_id, 'fp' AS label, 'caution_' || unit_id AS reason FROM (SELECT unit_id, CASE WHEN unit_type = 'polyset' THEN 1 ELSE 2 END AS group_no FROM runtime_units)")
def caution_load(spark, sf_dir):
    """Cautions of a file by priority, then id; a missing reason is made from the id."""
    import json

    rows = table(spark, sf_dir, "runtime_units").select("unit_id", "unit_type").collect()
    at = folder(spark, "cautions") + "/cautions.json"
    with open(at, "w", encoding="utf-8") as f:
        json.dump({"item_id": "u", "cautions": [{"caution_id": r["unit_id"], "priority": 1 if r["unit_type"] == "polyset" else 2, "match": {"raw_text_regex": "x"}, "output": {"label": "fp"}} for r in reversed(rows)]}, f)
    found = review.load_cautions(at, "u")
    return spark.createDataFrame([(k + 1, c.caution_id, c.label, c.reason or f"caution_{c.caution_id}") for k, c in enumerate(found)], "place long, caution_id string, label string, reason string")


@query(f"WITH {GOLD} SELECT example_id, sentence AS shown, len(target_spans)::INT AS n FROM gold WHERE NOT regexp_matches(sentence, '기 ?때문')")
def gold_fn_sink(spark, sf_dir):
    """Gold rows that a rule misses, written as JSON lines and read again."""
    at = Scratch(spark, "misses").path("rows")
    missed = evaluate.regex_outcome(gold_of(spark, sf_dir), _DUE, "sentence").where(~F.col("matched"))
    missed.select("example_id", "sentence", "target_spans").write.json(at)
    back = spark.read.schema("example_id string, sentence string, target_spans array<struct<start:int,end:int>>").json(at)
    return back.select("example_id", F.col("sentence").alias("shown"), F.size("target_spans").alias("n"))


@query(f"WITH {GOLD}, t AS (SELECT example_id, target_spans AS sp FROM gold) SELECT {_T('example_id')} AS example_id, len(sp) AS n, sp[1].start::INT AS s FROM t WHERE len(sp) > 0")
def gold_sheet(spark, sf_dir):
    """Gold rows as a sheet, read back with their spans."""
    at = folder(spark, "gold") + "/gold.xlsx"
    segs = evaluate.target_spans(F.col("target_spans"))
    xlsx.write_sheet(gold_of(spark, sf_dir).where(F.size("target_spans") > 0).select("example_id", "sentence", P.format_spans(segs).alias("span_segments")), at, "gold")
    back = xlsx.read_sheet(spark, at, "gold", ("example_id", "sentence", "span_segments")).withColumn("segs", P.parse_spans(F.col("span_segments")))
    return back.select("example_id", F.size("segs").cast("long").alias("n"), F.col("segs")[0]["s"].alias("s"))


# ---- bundles --------------------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('items', 'none'), ('batch_runs', 'e_id,canonical_form')) t(sheet, missing)")
def bundle_required_columns(spark, sf_dir):
    need = ["e_id", "canonical_form", "group"]
    return spark.createDataFrame([("items", ",".join(B.required_columns(table(spark, sf_dir, "items"), need)) or "none"), ("batch_runs", ",".join(B.required_columns(table(spark, sf_dir, "batch_runs"), need[:2])))], "sheet string, missing string")


_U = f"u AS (SELECT unit_id, member_e_ids, lower(nullif({sql_trim('\"group\"')}, '')) AS g FROM runtime_units), m AS (SELECT unit_id, unnest(member_e_ids) AS member, len(member_e_ids) AS n FROM u), i AS (SELECT nullif({sql_trim('e_id')}, '') AS e, coalesce(nullif({sql_trim('ps_id')}, ''), nullif({sql_trim('polyset_id')}, '')) AS ps FROM items)"


@query(f"WITH {_U} SELECT 'unit_member' AS code, unit_id AS id FROM m WHERE member NOT IN (SELECT e FROM i WHERE e IS NOT NULL) UNION ALL SELECT 'unit_claimed', unit_id FROM m JOIN i ON e = member WHERE n > 1 AND ps <> unit_id UNION ALL SELECT 'warn_members_outside_c', unit_id FROM u WHERE len(member_e_ids) > 1 AND coalesce(g, '') <> 'c' UNION ALL SELECT 'unit_duplicate', unit_id FROM u GROUP BY unit_id HAVING count(*) > 1")
def bundle_unit_violations(spark, sf_dir):
    return B.unit_violations(table(spark, sf_dir, "runtime_units"), table(spark, sf_dir, "items"))


_IDS = f"r AS (SELECT coalesce(nullif({sql_trim('ps_id')}, ''), nullif({sql_trim('polyset_id')}, ''), nullif({sql_trim('e_id')}, '')) AS unit_id, nullif({sql_trim('e_id')}, '') AS e, nullif({sql_trim('detect_ruleset_id')}, '') AS rs FROM items)"


@query(f"WITH {_IDS} SELECT unit_id, count(*) AS members FROM r WHERE e IS NOT NULL GROUP BY 1")
def bundle_unit_ids(spark, sf_dir):
    """The unit of each item: the first id of three that isn't blank."""
    rows = table(spark, sf_dir, "items").where(blank_to_null("e_id").isNotNull())
    return rows.groupBy(B.unit_of("ps_id", "polyset_id", "e_id").alias("unit_id")).agg(F.count(F.lit(1)).alias("members"))


@query(f"WITH {_IDS}, d AS (SELECT unit_id, string_agg(rs, ',' ORDER BY e) AS own FROM r WHERE e IS NOT NULL GROUP BY 1) SELECT coalesce(d.unit_id, u.unit_id) AS unit_id, CASE WHEN len(u.detect_ruleset_ids) > 0 THEN array_to_string(u.detect_ruleset_ids, ',') ELSE coalesce(own, '') END AS rulesets FROM d FULL JOIN runtime_units u USING (unit_id)")
def bundle_rulesets(spark, sf_dir):
    """A unit's own rulesets, or those of its members."""
    got = B.unit_rulesets(table(spark, sf_dir, "items"), table(spark, sf_dir, "runtime_units"))
    return got.select("unit_id", F.array_join("detect_ruleset_ids", ",").alias("rulesets"))


_POLY = f"p AS (SELECT coalesce(nullif({sql_trim('ps_id')}, ''), nullif({sql_trim('polyset_id')}, '')) AS ps, nullif({sql_trim('e_id')}, '') AS e FROM items)"


@query(f"WITH {_POLY}, k AS (SELECT DISTINCT ps FROM p WHERE ps IS NOT NULL AND e IS NOT NULL), x AS (SELECT unit_id, canonical_form FROM runtime_units WHERE unit_type = 'polyset') SELECT coalesce(k.ps, x.unit_id) AS ps_id, x.canonical_form AS stated, k.ps IS NOT NULL AS derived, x.unit_id IS NOT NULL AS introduced FROM k FULL JOIN x ON x.unit_id = k.ps")
def bundle_polysets_explicit(spark, sf_dir):
    """Stated units win over derived ones, and their intro comes first."""
    units = table(spark, sf_dir, "runtime_units").where("unit_type = 'polyset'").select(F.col("unit_id").alias("ps_id"), "canonical_form", F.lit("뜻:").alias("gloss_intro"))
    got = B.polysets(table(spark, sf_dir, "items"), units).join(units.select("ps_id", F.col("canonical_form").alias("want")), "ps_id", "left")
    stated = F.when(F.col("want") == F.col("canonical_form"), F.col("canonical_form"))
    return got.select("ps_id", stated.alias("stated"), F.col("member_e_ids").isNotNull().alias("derived"), F.col("encoder_gloss").startswith("뜻:").alias("introduced"))


@query(f"WITH {_IDS}, n AS (SELECT unit_id, count(DISTINCT e) AS members, string_agg(rs, ',' ORDER BY e) AS rulesets FROM r WHERE e IS NOT NULL GROUP BY 1) SELECT unit_id, CASE WHEN members > 1 THEN 'polyset' ELSE 'item' END AS unit_type, members, coalesce(rulesets, '') AS rulesets, 1 AS components, 'refused' AS lacking FROM n")
def bundle_from_tables(spark, sf_dir):
    """A bundle of a dictionary's tables: a component and a rule for every unit."""
    items = table(spark, sf_dir, "items")
    ids = items.where(blank_to_null("e_id").isNotNull()).select(B.unit_of("ps_id", "polyset_id", "e_id").alias("unit_id")).distinct()
    text = lambda **cells: [F.lit(v).alias(k) for k, v in cells.items()]
    comps = ids.select("unit_id", *text(comp_surf="적/것", comp_id="c1", is_required="Y", anchor_rank="", comp_order="1.0", order_policy="", min_gap_to_next="", max_gap_to_next="2"))
    rules = ids.select("unit_id", F.concat(F.lit("rs_"), "unit_id").alias("ruleset_id"), F.concat(F.lit("r_"), "unit_id").alias("rule_id"), *text(stage="detect", target="", pattern="적", priority="", hard_fail=""))
    made = B.from_tables(items, comps, rules)
    try:
        B.from_tables(items.drop("gloss"), comps, rules)
        lacking = "accepted"
    except ValueError:
        lacking = "refused"
    rows = [(u.unit_id, u.unit_type, len(u.member_e_ids), ",".join(u.detect_ruleset_ids), len(made.components_of(u.unit_id)), lacking) for u in made.units]
    return spark.createDataFrame(rows, "unit_id string, unit_type string, members long, rulesets string, components int, lacking string")


@query(f"WITH {_IDS}, n AS (SELECT unit_id, count(DISTINCT e) AS members, string_agg(rs, ',' ORDER BY e) AS rulesets FROM r WHERE e IS NOT NULL GROUP BY 1) SELECT unit_id, CASE WHEN members > 1 THEN 'polyset' ELSE 'item' END AS unit_type, members, coalesce(rulesets, '') AS rulesets FROM n")
def dictionary_workbook(spark, sf_dir):
    """A dictionary workbook of three sheets, read into a bundle."""
    at = folder(spark, "dictionary") + "/dictionary.xlsx"
    items = table(spark, sf_dir, "items")
    ids = items.where(blank_to_null("e_id").isNotNull()).select(B.unit_of("ps_id", "polyset_id", "e_id").alias("unit_id")).distinct()
    text = lambda **cells: [F.lit(v).alias(k) for k, v in cells.items()]
    comps = ids.select("unit_id", *text(comp_surf="적", comp_id="c1", is_required="Y", anchor_rank="", comp_order="1", order_policy="fx", min_gap_to_next="", max_gap_to_next=""))
    rules = ids.select("unit_id", F.concat(F.lit("rs_"), "unit_id").alias("ruleset_id"), F.concat(F.lit("r_"), "unit_id").alias("rule_id"), *text(stage="detect", target="raw_sentence", pattern="적", priority="1", hard_fail="N"))
    xlsx.write_book({"items": files.cells(items), "rule_components": comps, "detect_rules": rules}, at)
    made = B.from_tables(*[xlsx.read_sheet(spark, at, name).drop("_row_no") for name in B.SHEETS])
    return spark.createDataFrame([(u.unit_id, u.unit_type, len(u.member_e_ids), ",".join(u.detect_ruleset_ids)) for u in made.units], "unit_id string, unit_type string, members long, rulesets string")


_BROKEN = [("duplicate_unit", "u"), ("unit_group", "g"), ("duplicate_rule", "r"), ("component_unit", "cx"), ("component_bridge", "cb"), ("component_order_policy", "cp"), ("rule_stage", "rs"), ("rule_target", "rt"), ("rule_component", "rc"), ("rule_context_chars", "rn"), ("rule_python_literal", "rl"), ("rule_pattern", "rp"), ("warn_verify_not_hard", "rv"), ("ruleset_mixed_stage", "mixed"), ("ruleset_missing", "gone"), ("ruleset_owner", "foreign"), ("warn_ruleset_unreferenced", "mixed"), ("warn_ruleset_unreferenced", "own")]


@query(f"SELECT * FROM (VALUES {', '.join(map(str, _BROKEN))}) t(code, id)")
def bundle_violations(spark, sf_dir):
    """One broken constraint of each kind."""
    rule = lambda rid, **more: B.Rule(**({"unit_id": "u", "ruleset_id": "own", "rule_id": rid, "stage": "detect", "pattern": "a"} | more))
    units = [B.Unit("u", detect_ruleset_ids=("gone",)), B.Unit("u"), B.Unit("g", group="z", detect_ruleset_ids=("foreign",))]
    rules = [rule("r"), rule("r"), rule("rs", stage="x"), rule("rt", target="char_window"), rule("rc", ruleset_id="mixed", stage="verify", target="component_text", component_id="no", hard_fail=True), rule("rn", context_chars=21), rule("rl", pattern="r'a'"), rule("rp", pattern="("), rule("rv", ruleset_id="mixed", stage="verify"), rule("rm", ruleset_id="mixed"), rule("rf", ruleset_id="foreign")]
    comps = [B.Component("nobody", "cx"), B.Component("u", "cb", bridge_id="none"), B.Component("u", "cp", order_policy="zz")]
    found = B.violations(B.Bundle(units, rules, comps))
    keep = {x for x in found if x != ("ruleset_mixed_stage", "own")}  # the unknown stage mixes its ruleset as well
    return spark.createDataFrame(sorted(keep), "code string, id string")


@query("SELECT * FROM (VALUES ('1', 'true'), ('Yes', 'true'), ('1.0', 'true'), ('T', 'true'), ('0', 'false'), ('no', 'false'), ('0.0', 'false'), ('', 'false'), ('maybe', 'refused'), ('a; b;;c ', 'a,b,c')) t(value, outcome)")
def bundle_cell_values(spark, sf_dir):
    """Truth values and id lists of cells."""

    def outcome(v: str) -> str:
        try:
            return str(B.to_bool(v)).lower()
        except ValueError:
            return "refused"

    rows = [(v, outcome(v)) for v in ("1", "Yes", "1.0", "T", "0", "no", "0.0", "", "maybe")] + [("a; b;;c ", ",".join(B.id_list("a; b;;c ")))]
    return spark.createDataFrame(rows, "value string, outcome string")


@query("SELECT 'detector_bundle_v1' AS schema_version, count(*) AS units, 64 AS digest_length FROM runtime_units")
def bundle_file(spark, sf_dir):
    """A bundle saved, loaded, and its file's provenance."""
    import json

    at = folder(spark, "bundle") + "/bundle.json"
    units = [B.Unit(r["unit_id"], r["unit_type"], r["group"], tuple(r["member_e_ids"])) for r in table(spark, sf_dir, "runtime_units").collect()]
    B.save(B.Bundle(units, []), at)
    with open(at, encoding="utf-8") as f:
        version = json.load(f)["schema_version"]
    return spark.createDataFrame([(version, len(B.load(at).units), len(B.provenance(at)["sha256"]))], "schema_version string, units long, digest_length int")


@query("SELECT unit_id, CASE WHEN len(member_e_ids) > 0 THEN '[' || array_to_string(list_sort(member_e_ids), ',') || ']' ELSE '[]' END AS members, 0 AS components FROM runtime_units")
def sync_unit_slice(spark, sf_dir):
    """A unit's part of a bundle in canonical form."""
    rows = table(spark, sf_dir, "runtime_units").collect()
    made = B.Bundle([B.Unit(r["unit_id"], r["unit_type"], r["group"], tuple(reversed(r["member_e_ids"]))) for r in rows], [])
    cut = [(u.unit_id, sync.unit_slice(made, u.unit_id)) for u in made.units]
    return spark.createDataFrame([(u, "[" + ",".join(x["unit"]["member_e_ids"]) + "]", len(x["components"])) for u, x in cut], "unit_id string, members string, components int")


@query("SELECT unit_id, unit_type <> 'polyset' AS in_sync, CASE WHEN unit_type = 'polyset' THEN 1 ELSE 0 END::BIGINT AS diff_count FROM runtime_units")
def sync_gate(spark, sf_dir):
    """Two bundles that differ in the form of every polyset."""
    rows = table(spark, sf_dir, "runtime_units").collect()
    made = lambda tail: B.Bundle([B.Unit(r["unit_id"], r["unit_type"], r["group"], tuple(r["member_e_ids"]), "form" + (tail if r["unit_type"] == "polyset" else "")) for r in rows], [])
    kind, out = "unit string, path string, value string", []
    flat = lambda b: spark.createDataFrame([(r["unit_id"], f"{r['unit_id']}|{p}", v) for r in rows for p, v in sync.paths(sync.unit_slice(b, r["unit_id"]))], kind)
    diffs = {r["u"]: r["n"] for r in sync.diff(flat(made("")), flat(made("2"))).groupBy(F.split("path", r"\|")[0].alias("u")).agg(F.count(F.lit(1)).alias("n")).collect()}
    out = [(r["unit_id"], diffs.get(r["unit_id"], 0) == 0, diffs.get(r["unit_id"], 0)) for r in rows]
    return spark.createDataFrame(out, "unit_id string, in_sync boolean, diff_count long")


# ---- sampling -------------------------------------------------------------------------------------------------

_WANT = f"w AS (SELECT batch_id_prefix, d, sum(n) AS n FROM (SELECT batch_id_prefix, lower({sql_trim('e.key')}) AS d, e.value AS n FROM (SELECT batch_id_prefix, unnest(map_entries(sampling)) AS e FROM example_making_manifest)) WHERE n > 0 GROUP BY 1, 2)"


@query(f"WITH {_RANKED}, {_WANT}, g AS (SELECT batch_id_prefix, d, count(*) AS n_selected, min(sample_hash) AS a, max(sample_hash) AS b FROM w JOIN ranked ON corpus_domain = d AND sample_rank >= n AND sample_rank < 2 * n GROUP BY 1, 2) SELECT batch_id_prefix, d AS domain, n::BIGINT AS rank_start, n::BIGINT AS requested, coalesce(n_selected, 0) AS n_selected, a AS hash_min, b AS hash_max FROM w LEFT JOIN g USING (batch_id_prefix, d)")
def prepare_report(spark, sf_dir):
    """The second batch of every manifest, from one ranking."""
    return sampling.prepare(_corpus_lines(spark, sf_dir), table(spark, sf_dir, "example_making_manifest"), 1, 17)[1]


@query(f"WITH {_RANKED}, {_WANT} SELECT batch_id_prefix || '_batch_001' AS batch_id, corpus_domain, count(*) AS n, sum(length(raw_text))::BIGINT AS chars FROM w JOIN ranked ON corpus_domain = d AND sample_rank >= n AND sample_rank < 2 * n GROUP BY 1, 2")
def prepare_records(spark, sf_dir):
    got = sampling.prepare(_corpus_lines(spark, sf_dir), table(spark, sf_dir, "example_making_manifest"), 1, 17)[0]
    return got.groupBy("batch_id", "corpus_domain").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("raw_text")).alias("chars"))


@query("WITH s AS (SELECT batch_id_prefix, unnest(sampling_schedules) AS s, generate_subscripts(sampling_schedules, 1) AS k FROM example_making_manifest), p AS (SELECT batch_id_prefix, s FROM s WHERE s.start_batch_index <= 3 AND coalesce(s.end_batch_index, 1000000) >= 3 QUALIFY row_number() OVER (PARTITION BY batch_id_prefix ORDER BY s.start_batch_index DESC, k DESC) = 1), e AS (SELECT batch_id_prefix, s, unnest(map_entries(s.sampling)) AS e FROM p) SELECT batch_id_prefix, e.key AS domain, 3 AS batch_index, (coalesce(s.rank_start_offsets[e.key], 0) + (3 - s.start_batch_index) * e.value)::BIGINT AS rank_start, e.value::BIGINT AS requested FROM e")
def sample_batch_plan(spark, sf_dir):
    """Ranks of the third batch of every manifest, by the schedule that holds for it."""
    out = []
    for m in table(spark, sf_dir, "example_making_manifest").select("batch_id_prefix", "sampling_schedules").collect():  # 12 rows
        own = [sampling.Schedule(x["schedule_id"], x["start_batch_index"], x["end_batch_index"], x["sampling"] or {}, x["rank_start_offsets"] or {}) for x in m["sampling_schedules"] or []]
        if sampling.pick_schedule(own, 3):
            out += [(m["batch_id_prefix"], *row) for row in sampling.batch_plan(own, 3)]
    return spark.createDataFrame(out, "batch_id_prefix string, domain string, batch_index int, rank_start long, requested long")


_SHARDS = f"""WITH RECURSIVE {_RANKED}, v AS (SELECT count(*) FILTER (WHERE corpus_domain = 'daily_conversation') AS vd, count(*) FILTER (WHERE corpus_domain = 'news') AS vn, count(*) FILTER (WHERE corpus_domain = 'lecture_notes') AS vl FROM ranked),
s AS (SELECT 0 AS k, 0::BIGINT AS cd, 0::BIGINT AS cn, 0::BIGINT AS cl, false AS xd, false AS xn, false AS xl FROM v
  UNION ALL SELECT k + 1, cd + gd, cn + gn, cl + gl, xd OR gd < wd, xn OR gn < wn, xl OR gl < wl FROM (SELECT *, least(wd, greatest(0, vd - cd)) AS gd, least(wn, greatest(0, vn - cn)) AS gn, least(wl, greatest(0, vl - cl)) AS gl FROM (SELECT s.*, v.*, CASE WHEN xd THEN 0 ELSE 500 + CASE WHEN xn THEN 200 ELSE 0 END + CASE WHEN xl THEN 3 ELSE 0 END END AS wd, CASE WHEN xn THEN 0 ELSE 200 END AS wn, CASE WHEN xl THEN 0 ELSE 3 END AS wl FROM s, v)) WHERE NOT xd AND k < 100),
t AS (SELECT s.*, v.*, CASE WHEN xd THEN 0 ELSE 500 + CASE WHEN xn THEN 200 ELSE 0 END + CASE WHEN xl THEN 3 ELSE 0 END END AS wd, CASE WHEN xn THEN 0 ELSE 200 END AS wn, CASE WHEN xl THEN 0 ELSE 3 END AS wl FROM s, v WHERE NOT xd AND k < 100)
SELECT 'daily_conversation' AS domain, k::BIGINT AS shard_index, cd AS rank_start, wd::BIGINT AS requested, least(wd, greatest(0, vd - cd))::BIGINT AS selected FROM t
UNION ALL SELECT 'news', k, cn, wn, least(wn, greatest(0, vn - cn)) FROM t UNION ALL SELECT 'lecture_notes', k, cl, wl, least(wl, greatest(0, vl - cl)) FROM t"""


@query(_SHARDS)
def shard_plan_assign(spark, sf_dir):
    """Shards until the backfill domain is used up; an exhausted domain's quota goes to it from the next shard on."""
    rows = sampling.ranked(_corpus_lines(spark, sf_dir), 17)
    valid = {r["corpus_domain"]: r["n"] for r in rows.groupBy("corpus_domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = sampling.shard_plan(valid, {"daily_conversation": 500, "news": 200, "lecture_notes": 3}, "daily_conversation", 100)
    return spark.createDataFrame(plan, "domain string, shard_index long, rank_start long, requested long, selected long")


# ---- review ---------------------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('given', 'b7'), ('from name', 'batch_003'), ('stem', 'notes')) t(name, batch_id)")
def review_batch_id(spark, sf_dir):
    rows = [("given", review.batch_of("b7", "x/batch_003.jsonl")), ("from name", review.batch_of(None, "x/u_batch_003_y.jsonl")), ("stem", review.batch_of(None, "x/notes.jsonl"))]
    return spark.createDataFrame(rows, "name string, batch_id string")


@query("SELECT unit_id, 'out/' || unit_id || '/' || unit_id || '_batch_012_review.csv' AS review FROM runtime_units")
def review_output_paths(spark, sf_dir):
    units = [r["unit_id"] for r in table(spark, sf_dir, "runtime_units").select("unit_id").collect()]
    return spark.createDataFrame([(u, pipeline.output_paths([u], "in/batch_012_x.jsonl", "out")["review"]) for u in units], "unit_id string, review string")


@query("SELECT 1 AS place, 'hit_id' AS name UNION ALL SELECT 40, 'reviewer' UNION ALL SELECT 41, 'extra_a' UNION ALL SELECT 42, 'extra_b'")
def review_column_order(spark, sf_dir):
    got = review.column_order(["extra_a", *reversed(table(spark, sf_dir, "search_corpus").columns), "extra_b"])
    return spark.createDataFrame([(k + 1, n) for k, n in enumerate(got) if k in (0, 39) or k > 39], "place int, name string")


_OKSEG = "len(segs) > 0 AND list_bool_and(list_transform(segs, lambda p: p[1] >= 0 AND p[1] < p[2] AND p[2] <= length(raw_text))) AND list_bool_and(list_transform(range(2, len(segs) + 1), lambda i: segs[i][1] >= segs[i - 1][2])) IS DISTINCT FROM FALSE"


@query(f"WITH {J} SELECT hit_id, coalesce({_OKSEG}, false) AS good, CASE WHEN {_OKSEG} THEN list_aggregate(list_transform(segs, lambda p: substring(raw_text, p[1]::INT + 1, (p[2] - p[1])::INT)), 'string_agg', ' ... ') ELSE '' END AS span_text_extracted FROM j WHERE raw_text IS NOT NULL AND hit_id IS NOT NULL")
def review_enriched(spark, sf_dir):
    got = review.enriched(rows_of(spark, sf_dir, "raw_text", "span_segments").where("raw_text is not null and hit_id is not null"))
    return got.select("hit_id", (F.col("span_parse_status") == "parsed").alias("good"), "span_text_extracted")


@query("WITH r AS (SELECT DISTINCT hit_id, human_label FROM search_corpus WHERE raw_text IS NOT NULL) SELECT hit_id, human_label, '' AS first_pass_label, 'no_first_pass_profile' AS first_pass_reason, '1' AS checked FROM r")
def review_first_pass(spark, sf_dir):
    """Without a profile: the human columns as they are, no label, and why."""
    rows = rows_of(spark, sf_dir, "raw_text", "span_segments", "span_text", "regex_match_span", "regex_match_text", "human_label").where("raw_text is not null")
    return review.first_pass(rows).select("hit_id", "human_label", "first_pass_label", "first_pass_reason", "checked")


_CTX = f"""{J}, c0 AS (SELECT hit_id, raw_text, coalesce(nullif(span_text, ''), regex_match_text, '') AS span, coalesce(regex_match_text, '') AS rm, segs[1] AS p FROM j WHERE raw_text IS NOT NULL AND hit_id IS NOT NULL),
c AS (SELECT *, coalesce(substring(raw_text, greatest(0, p[1] - 6)::INT + 1, (p[1] - greatest(0, p[1] - 6))::INT), '') AS b, coalesce(substring(raw_text, p[2]::INT + 1, 6), '') AS a, coalesce(substring(raw_text, greatest(0, p[1] - 8)::INT + 1, (p[2] + 8 - greatest(0, p[1] - 8))::INT), '') AS w, coalesce(substring(raw_text, p[2]::INT + 1, 1), '') AS nx, regexp_replace(raw_text, '[{_SQLWS}]+', '', 'g') AS compact FROM c0)"""
_DE = r"""CASE WHEN span = '런데' AND contains(w, '그런데') THEN 'lexicalized_discourse_marker_geureonde' WHEN span = '근데' THEN 'lexicalized_discourse_marker_geunde'
 WHEN span = '군데' AND (regexp_matches(raw_text, '(몇|한|두|세|네|[0-9]+)WS*군데') OR nx IN ('가', '를', '에', '도', ' ')) THEN 'place_noun_gunde' WHEN span = '군데' THEN 'copula_contracted_gunde'
 WHEN span = '운데' AND (contains(replace(raw_text, ' ', ''), '가운데') OR contains(replace(raw_text, ' ', ''), '파운데이션')) THEN 'lexical_noun_or_loanword' WHEN span = '팬데' AND contains(raw_text, '팬데믹') THEN 'loanword_pandemic'
 WHEN span = '원데' AND (contains(raw_text, '원데이') OR contains(b || span || a, ' 원')) THEN 'loanword_or_title_oneday' WHEN span = '온데' AND contains(raw_text, '온데간데') THEN 'lexicalized_ondegande' WHEN span IN ('천데', '끈데') THEN 'noisy_or_nonstandard_form'
 WHEN span IN ('는데', '은데', '인데', '한데', '건데', '텐데', '닌데', '큰데', '신데', '던데', '언데', '든데', '긴데', '땐데', '뭔데', '젠데', '딘데', '븐데') THEN 'productive_connective_ending' WHEN span LIKE '%데' THEN 'tentative_connective_ending' ELSE 'unclassified' END""".replace("WS", f"[{_SQLWS}]")
_MAL = r"""CASE WHEN regexp_matches(a, '^(했|했다|했고|했는|하며|해|하면|하기|하긴|하는|전했|씀)') OR regexp_matches(a, '^을([^0-9A-Za-z_가-힣ㄱ-ㅎㅏ-ㅣ]|$)') OR regexp_matches(w, '고WS*말(씀|하|했|해|전했|을WS+하)') THEN 'speech_verb_malhada' WHEN regexp_matches(a, '^(이야|이WS|이[가-힣])') THEN 'lexical_noun_mal'
 WHEN regexp_matches(compact, '고(야)?말(았|겠|거|다|고야)') OR regexp_matches(a, '^(았|겠|거|다)') THEN 'auxiliary_go_malda' WHEN span IN ('고 말', '고 ... 말') OR rm LIKE '고%' THEN 'tentative_go_malda' ELSE 'unclassified' END""".replace("WS", f"[{_SQLWS}]")


def _profiled(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    rows = rows_of(spark, sf_dir, "raw_text", "span_segments", "span_text", "regex_match_span", "regex_match_text").where("raw_text is not null and hit_id is not null")
    got = review.first_pass(rows, profiles.PROFILES[unit])
    return got.select("hit_id", F.col("first_pass_label").alias("label"), F.col("first_pass_reason").alias("reason"))


_VERDICT = "CASE WHEN reason IN ('copula_contracted_gunde', 'productive_connective_ending', 'tentative_connective_ending', 'auxiliary_go_malda') THEN 'tp' WHEN reason IN ('noisy_or_nonstandard_form', 'tentative_go_malda', 'unclassified') THEN 'unclear' ELSE 'fp' END AS label"


@query(f"WITH {_CTX}, d AS (SELECT hit_id, {_DE} AS reason FROM c) SELECT hit_id, {_VERDICT}, reason FROM d")
def profile_connective_de(spark, sf_dir):
    return _profiled(spark, sf_dir, "ps_ce002")


@query(f"WITH {_CTX}, d AS (SELECT hit_id, {_MAL} AS reason FROM c) SELECT hit_id, {_VERDICT}, reason FROM d")
def profile_auxiliary_malda(spark, sf_dir):
    return _profiled(spark, sf_dir, "ps_df004")


@query(f"WITH {_CTX}, d AS (SELECT {_MAL} AS reason FROM c) SELECT reason, CASE reason WHEN 'auxiliary_go_malda' THEN '보조용언' WHEN 'unclassified' THEN '미분류' ELSE reason END AS label_text, count(*) AS n FROM d GROUP BY 1")
def reason_labels(spark, sf_dir):
    rows = _profiled(spark, sf_dir, "ps_df004").withColumnRenamed("reason", "first_pass_reason")
    got = review.reason_report(rows, 1, {"auxiliary_go_malda": "보조용언", "unclassified": "미분류"})
    return got.select("reason", "label_text", "n")


@query("WITH k AS (SELECT DISTINCT hit_id, corpus_domain FROM search_corpus) SELECT hit_id, count(*) AS n FROM (SELECT hit_id FROM k UNION ALL SELECT hit_id FROM k WHERE corpus_domain = 'news') GROUP BY 1 HAVING count(*) > 1")
def review_repeated_hits(spark, sf_dir):
    """The news rows come a second time in another file."""
    rows = rows_of(spark, sf_dir, "corpus_domain")
    return labels.repeated_hits(rows.unionByName(rows.where("corpus_domain = 'news'")))


@query("SELECT * FROM (VALUES ('needs_label_cleanup', false, true), ('ready_for_encoder_export', true, true), ('switch_to_full_corpus_search', false, false), ('max_batches_reached', true, true), ('continue_batch_search', true, true), ('something_else', false, true)) t(next_action, allowed, with_cleanup)")
def export_gate(spark, sf_dir):
    names = ("needs_label_cleanup", "ready_for_encoder_export", "switch_to_full_corpus_search", "max_batches_reached", "continue_batch_search", "something_else")
    return spark.createDataFrame([(a, labels.gate(a)[0], labels.gate(a, True)[0]) for a in names], "next_action string, allowed boolean, with_cleanup boolean")


# ---- pairs ----------------------------------------------------------------------------------------------------


@query(f"WITH {E} SELECT hit_id, concat_ws('; ', 'hit_id=' || hit_id, 'rules=' || nullif({sql_trim('detect_rule_ids')}, ''), 'memo=' || nullif({sql_trim('memo')}, ''), 'reviewer=' || nullif({sql_trim('reviewer')}, '')) AS note FROM e")
def pair_notes(spark, sf_dir):
    return pairs.pair_rows(pairs.judged(rows_of(spark, sf_dir, *_PAIR), F.col("unit_id"))).select("hit_id", "note")


_GROUPS = "g AS (SELECT item_id, coalesce(nullif(text_id, ''), 'text:' || raw_text) AS t, count(*) AS n, count(*) FILTER (WHERE coalesce(text_id, '') = '') AS lacking FROM dd GROUP BY 1, 2)"


@query(f"WITH {E}, {_GROUPS} SELECT count(*) FILTER (WHERE n > 1) AS n_multi_instance_sentences, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS n_examples_in_multi_instance_sentences, coalesce(sum(lacking), 0)::BIGINT AS n_examples_missing_text_id FROM g")
def pair_instance_summary(spark, sf_dir):
    return pairs.instance_summary(kept(spark, sf_dir))


_INST = "row_number() OVER (PARTITION BY item_id, coalesce(nullif(text_id, ''), 'text:' || raw_text) ORDER BY segs[1][1], segs[1][2], coalesce(TRY_CAST(candidate_index AS INT), 0), span_key, hit_id)"
_NAMED = f"{E}, {_SPLIT}, x AS (SELECT *, item_id || CASE WHEN label = 1 THEN '-pos-' ELSE '-neg-' END || lpad((row_number() OVER (PARTITION BY item_id, label ORDER BY hit_id, span_key))::VARCHAR, 4, '0') AS example_id, {_INST} AS instance_id FROM sp)"


@query(f"WITH {_NAMED} SELECT item_id, example_id, '' AS context_left, raw_text AS target_sentence, '' AS context_right, instance_id::VARCHAR AS instance_id, new_split AS split, '[' || list_aggregate(list_transform(segs, lambda p: '[' || p[1] || ',' || p[2] || ']'), 'string_agg', ',') || ']' AS span_segments, CASE WHEN len(segs) > 1 THEN 'disconti' ELSE 'conti' END AS pattern_type, example_role, coalesce(corpus_domain, '') AS source, concat_ws('; ', 'hit_id=' || hit_id, 'rules=' || nullif({sql_trim('detect_rule_ids')}, ''), 'memo=' || nullif({sql_trim('memo')}, ''), 'reviewer=' || nullif({sql_trim('reviewer')}, '')) AS note FROM x")
def pair_ledger(spark, sf_dir):
    return pairs.ledger(_examples(spark, sf_dir))


@query(f"WITH {GOLD} SELECT example_id, 'df003' AS item_id, CASE WHEN gold_example_role IN ('pos_conti', 'pos_disconti') THEN 1 WHEN gold_example_role = 'neg_target_absent' THEN 0 END AS label, CASE WHEN len(target_spans) > 1 THEN 'disconti' ELSE 'conti' END AS pattern_type, 'manual_' || left(sha1('df003|' || sentence), 12) AS text_id FROM gold")
def manual_rows(spark, sf_dir):
    """Gold sentences taken as hand-written rows."""
    rows = gold_of(spark, sf_dir).select("example_id", F.col("gold_example_role").alias("example_role"), F.col("sentence").alias("raw_text"), "source", evaluate.target_spans(F.col("target_spans")).alias("segs"), F.lit("").alias("text_id"))
    return pairs.manual_rows(rows, "df003").select("example_id", "item_id", "label", "pattern_type", "text_id")


@query(f"WITH {GOLD} SELECT code, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN coalesce(split, '') NOT IN ('train', 'dev', 'test') THEN 'split' END, CASE WHEN coalesce(gold_example_role, '') NOT IN ('pos_conti', 'pos_disconti', 'neg_target_absent') THEN 'role' END, CASE WHEN gold_example_role = 'pos_disconti' AND coalesce(len(target_spans), -1) < 2 OR gold_example_role = 'pos_conti' AND len(target_spans) > 1 THEN 'pattern_type' END, CASE WHEN length(sentence) % 5 < 1 THEN 'instance' END], lambda c: c IS NOT NULL)) AS code FROM gold) GROUP BY 1")
def manual_violations(spark, sf_dir):
    rows = gold_of(spark, sf_dir).select("example_id", "split", F.col("gold_example_role").alias("example_role"), evaluate.target_spans(F.col("target_spans")).alias("segs"), (F.length("sentence") % 5).alias("instance_id"))
    return pairs.manual_violations(rows).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


_ADD = f"{_NAMED}, base AS (SELECT * FROM x WHERE new_split = 'train'), extra AS (SELECT * FROM x WHERE new_split <> 'train' OR length(raw_text) % 2 = 0), o AS (SELECT *, example_id IN (SELECT example_id FROM base) AS old FROM extra)"


def _two_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    every = Scratch(spark, "import").keep(_examples(spark, sf_dir), "every")
    return every.where("split = 'train'"), every.where("split <> 'train' or length(raw_text) % 2 = 0")


@query(f"WITH {_ADD} SELECT count(*) FILTER (WHERE NOT old) AS imported, count(*) FILTER (WHERE old) AS skipped_existing, 0::BIGINT AS skipped_duplicate_content, (SELECT count(*) FROM base) AS base, (SELECT count(*) FROM x) AS total FROM o")
def import_summary(spark, sf_dir):
    return pairs.import_summary(*_two_files(spark, sf_dir))


@query(f"WITH {_NAMED} SELECT example_id, instance_id, count(*) OVER (PARTITION BY item_id, coalesce(nullif(text_id, ''), 'text:' || raw_text)) AS instances FROM x")
def import_table(spark, sf_dir):
    """Train rows with all others added: everything once, instances numbered anew."""
    return longs(pairs.import_table(*_two_files(spark, sf_dir)).select("example_id", "instance_id", "instances"))


@query(f"WITH {_NAMED} SELECT (row_number() OVER (ORDER BY item_id, label DESC, example_role, example_id)) AS place, example_id FROM x")
def merge_canonical_order(spark, sf_dir):
    rows = pairs.canonical_order(_examples(spark, sf_dir)).select("example_id").withColumn("at", F.monotonically_increasing_id())
    from ..operators.ranking import numbered

    return numbered(Scratch(spark, "order").keep(rows, "rows"), [], [F.col("at")], "place").select("place", "example_id")


@query(f"WITH {_NAMED} SELECT item_id, count(*) AS n, count(*) FILTER (WHERE label = 1) AS positive FROM x GROUP BY 1")
def merge_written(spark, sf_dir):
    """Merged examples written as JSON lines and read again."""
    at = Scratch(spark, "merged").path("examples")
    pipeline.merge_items([_examples(spark, sf_dir).select("item_id", "example_id", "label", "example_role", "split", "raw_text", "segs", "span_key", "span_text", "text_a")]).write.json(at)
    back = spark.read.schema("item_id string, example_id string, label int").json(at)
    return back.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("positive"))


# ---- evaluation -----------------------------------------------------------------------------------------------


@query(f"WITH {GOLD}, t AS (SELECT example_id, target_spans AS sp FROM gold WHERE len(target_spans) > 0 AND list_bool_and(list_transform(target_spans, lambda p: p.start >= 0 AND p.start < p.\"end\" AND p.\"end\" <= length(sentence))) AND list_bool_and(list_transform(range(2, len(target_spans) + 1), lambda i: target_spans[i].start >= target_spans[i - 1].\"end\")) IS DISTINCT FROM FALSE) SELECT 'df003-GOLD-' || printf('%03d', row_number() OVER (ORDER BY example_id)) AS example_id, example_id AS source_id, CASE WHEN len(sp) > 1 THEN 'pos_disconti' ELSE 'pos_conti' END AS gold_example_role FROM t")
def gold_build(spark, sf_dir):
    """Gold records built from sheet rows, numbered in their order."""
    segs = evaluate.target_spans(F.col("target_spans"))
    rows = gold_of(spark, sf_dir).select(F.col("example_id").alias("row_no"), "sentence", segs.alias("segs"), F.col("split"), F.lit(None).cast("string").alias("pattern_type"))
    made = evaluate.gold_records(rows.dropDuplicates(["row_no"]), "df003")
    source = rows.where(P.valid(F.col("sentence"), F.col("segs"))).select(F.col("row_no").alias("source_id"))
    from ..operators.ranking import numbered

    named = numbered(source.distinct(), [], [F.col("source_id")], "n").select(F.format_string("df003-GOLD-%03d", "n").alias("example_id"), "source_id")
    return named.join(made.select("example_id", "gold_example_role"), "example_id").select("example_id", "source_id", "gold_example_role")


@query(f"WITH {GOLD} SELECT true AS right_number, false AS wrong_number")
def gold_cardinality(spark, sf_dir):
    rows = spark.createDataFrame([(1, "한 적", [(2, 3)]), (2, "x", [(0, 9)])], "row_no int, sentence string, segs array<struct<s:int,e:int>>").withColumns({"split": F.lit(None).cast("string"), "pattern_type": F.lit(None).cast("string")})

    def accepted(n: int) -> bool:
        try:
            return evaluate.gold_records(rows, "u", n).count() == n
        except ValueError:
            return False

    return spark.createDataFrame([(accepted(1), accepted(2))], "right_number boolean, wrong_number boolean")


@query("SELECT * FROM (VALUES ('full', true), ('short', false), ('empty', false)) t(name, opens)")
def gold_gate(spark, sf_dir):
    cases = {"full": {"total": 50, "recall": 1.0}, "short": {"total": 50, "recall": 0.98}, "empty": {"total": 0, "recall": 0.0}}
    return spark.createDataFrame([(k, evaluate.gold_gate(v)) for k, v in cases.items()], "name string, opens boolean")


_GD = f"{GOLD}, {sql_spans('x', 'gold', _DUE, 'example_id', 'sentence')}"


@query(f"WITH {_GD}, hit AS (SELECT example_id, bool_or(len(list_filter(target_spans, lambda t: greatest(t.start, s) < least(t.\"end\", e))) > 0) AS over, bool_or(len(target_spans) = 1 AND target_spans[1].start = s AND target_spans[1].\"end\" = e) AS exact, count(*) AS k FROM x JOIN gold USING (example_id) GROUP BY 1) SELECT count(*) AS total, coalesce(sum(k), 0)::BIGINT AS candidates, round(count(k) / count(*), 6) AS in_sentence_recall, round(count(*) FILTER (WHERE over) / count(*), 6) AS overlapping_recall, round(count(*) FILTER (WHERE exact) / count(*), 6) AS exact_recall, 0::BIGINT AS rejected FROM gold LEFT JOIN hit USING (example_id)")
def gold_exact_recall(spark, sf_dir):
    unit = B.Unit("due", "item", "a", ("due",), "기 때문", None, ("d_due",))
    found = detect(gold_of(spark, sf_dir), B.Bundle([unit], [B.Rule("due", "d_due", "r_due", "detect", _DUE)]), ["due"], text_col="sentence")
    got = evaluate.detector_recall(evaluate.detector_outcome(found, "due"))
    return longs(got.select("total", "candidates", *[F.round(c, 6).alias(c) for c in ("in_sentence_recall", "overlapping_recall", "exact_recall")], "rejected"))


@query(f"WITH {E}, {_SPLIT}, want AS (SELECT s.split, l.label FROM (VALUES ('train'), ('dev'), ('test')) s(split), (VALUES (0), (1)) l(label)) SELECT want.split, want.label, count(sp.hit_id) AS n FROM want LEFT JOIN sp ON sp.new_split = want.split AND sp.label = want.label GROUP BY 1, 2")
def training_split_counts(spark, sf_dir):
    return evaluate.split_counts(pairs.splits(kept(spark, sf_dir), seed=3))


@query(f"WITH {E} SELECT round(count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1), 6) AS auto, 1.0::DOUBLE AS none, 2.5::DOUBLE AS given FROM dd")
def training_weight(spark, sf_dir):
    rows = kept(spark, sf_dir)
    return spark.createDataFrame([(round(evaluate.positive_weight(rows), 6), evaluate.positive_weight(rows, "none"), evaluate.positive_weight(rows, 2.5))], "auto double, none double, given double")


@query("SELECT * FROM (VALUES ('lower loss', 3, 4), ('patience', 1, 3), ('tie by accuracy', 2, 2), ('no epochs', -1, -1)) t(name, best, last)")
def training_best_epoch(spark, sf_dir):
    cases = {"lower loss": ([(1, 0.5, 0.6), (2, 0.4, 0.7), (3, 0.3, 0.6), (4, 0.6, 0.9)], {}), "patience": ([(1, 0.5, 0.6), (2, 0.6, 0.7), (3, 0.7, 0.8), (4, 0.1, 0.9)], {"patience": 2}), "tie by accuracy": ([(1, 0.50, 0.6), (2, 0.501, 0.7)], {"min_delta": 0.01}), "no epochs": ([], {})}
    return spark.createDataFrame([(k, *evaluate.best_epoch(v, **kw)) for k, (v, kw) in cases.items()], "name string, best int, last int")


@query(f"WITH {GOLD}, t AS (SELECT coalesce(nullif({sql_trim('split')}, ''), 'none') AS split, len(regexp_extract_all(sentence, '[^{_SQLWS}]+')) AS n FROM gold) SELECT split, count(*) AS n, max(n) AS longest, round(avg(n), 6) AS mean, round(avg((n > 12)::INT), 6) AS truncated FROM t GROUP BY 1")
def length_stats_tokens(spark, sf_dir):
    rows = gold_of(spark, sf_dir).withColumn("split", F.coalesce(blank_to_null("split"), F.lit("none")))
    got = evaluate.length_stats(rows, evaluate.token_count(F.col("sentence")), 12)
    return longs(got.select("split", "n", "longest", F.round("mean", 6).alias("mean"), F.round("truncated", 6).alias("truncated")))


@query("SELECT unit_id, CASE WHEN unit_type = 'polyset' THEN 'blocked' ELSE 'ok' END AS status, len(member_e_ids) AS tp, CASE WHEN unit_type = 'polyset' THEN 'gold recall under 1' ELSE '' END AS reason FROM runtime_units")
def run_summaries(spark, sf_dir):
    """The fixed fields of each run's report."""
    out = []
    for r in table(spark, sf_dir, "runtime_units").select("unit_id", "unit_type", "member_e_ids").collect():
        many = r["unit_type"] == "polyset"
        got = pipeline.run_summary(pipeline.Report("blocked" if many else "ok", {"summary": {"tp": len(r["member_e_ids"])}}, "gold recall under 1" if many else ""))
        out.append((r["unit_id"], got["status"], got["tp"], got["reason"]))
    return spark.createDataFrame(out, "unit_id string, status string, tp long, reason string")


@query(f"WITH {E} SELECT count(*) AS total, least(100, count(*)) AS saved FROM dd")
def prediction_sink(spark, sf_dir):
    """Metrics of all predictions, of which a hundred are written."""
    from .catalogue_labels import predictions

    at = Scratch(spark, "predictions").path("rows")
    total = evaluate.save_predictions(predictions(spark, sf_dir), at, 100).select("total")
    return total.join(F.broadcast(spark.read.json(at).agg(F.count(F.lit(1)).alias("saved"))))  # one row each


# ---- runs -----------------------------------------------------------------------------------------------------


@query("SELECT CASE WHEN unit_type = 'polyset' THEN 'blocked' WHEN unit_id = (SELECT min(unit_id) FROM runtime_units WHERE unit_type <> 'polyset') THEN 'failed' ELSE 'ok' END AS bucket, unit_id FROM runtime_units")
def run_many_buckets(spark, sf_dir):
    """Polysets are blocked, the first item fails, all others are fine."""
    rows = table(spark, sf_dir, "runtime_units").select("unit_id", "unit_type").collect()
    first = min(r["unit_id"] for r in rows if r["unit_type"] != "polyset")

    def run(config: dict) -> pipeline.Report:
        if config["unit_id"] == first:
            raise ValueError("broken")
        return pipeline.Report("blocked" if config["unit_type"] == "polyset" else "ok")

    out = pipeline.run_many([r.asDict() for r in rows], run)
    return spark.createDataFrame([(k, x["unit_id"]) for k, v in out.items() for x in v], "bucket string, unit_id string")


@query("SELECT * FROM (VALUES ('same', true), ('another shard', false), ('another plan', false), ('failed', false), ('table gone', false), ('empty', true)) t(name, reused)")
def run_shard_reuse(spark, sf_dir):
    at = folder(spark, "shards")
    good = {"status": "ok", "unit_id": "u", "shard_index": 2, "ranks": {"a": [0, 5]}, "table": at}
    plan = {"a": (0, 5)}
    rows = [("same", pipeline.reusable(good, "u", 2, plan)), ("another shard", pipeline.reusable(good, "u", 3, plan)), ("another plan", pipeline.reusable(good, "u", 2, {"a": (5, 9)})), ("failed", pipeline.reusable(good | {"status": "failed"}, "u", 2, plan)), ("table gone", pipeline.reusable(good | {"table": at + "/no"}, "u", 2, plan)), ("empty", pipeline.reusable(good | {"status": "empty", "table": None}, "u", 2, plan))]
    return spark.createDataFrame(rows, "name string, reused boolean")


@query("SELECT batch_id_prefix, seed, true AS strict, 'refused' AS lacking FROM example_making_manifest")
def run_coerced(spark, sf_dir):
    """Manifest entries as text, with their values in their types again."""

    def refused(entry: dict) -> str:
        try:
            return str(pipeline.coerced(entry, {}, ("unit_id",)))
        except ValueError:
            return "refused"

    rows = table(spark, sf_dir, "example_making_manifest").select("batch_id_prefix", F.col("seed").cast("string").alias("seed")).collect()  # 12 rows
    made = [pipeline.coerced({**r.asDict(), "strict": "yes"}, {"seed": int, "strict": bool}, ("batch_id_prefix",)) for r in rows]
    return spark.createDataFrame([(x["batch_id_prefix"], x["seed"], x["strict"], refused({"unit_id": ""})) for x in made], "batch_id_prefix string, seed long, strict boolean, lacking string")


@query(f"WITH {E} SELECT item_id, count(*) AS n FROM dd WHERE item_id IS NOT NULL GROUP BY 1 HAVING count(*) > 0")
def finalize_many(spark, sf_dir):
    """Every unit's clean rows finalised on their own, then merged."""
    marks = labels.labelled(rows_of(spark, sf_dir, "batch_id", *_PAIR).where("unit_id is not null"))
    clean = marks.where(~F.col("label").isin("blank", "invalid") & (F.col("status") != "invalid") & ~((F.col("label") == "tp") & (F.col("status") == "blank"))).drop("label", "status")
    examples, outcomes = pipeline.finalize_many(clean, "unit_id", labels.Goals(min_tp=0))
    if any(o["reason"] for o in outcomes):
        raise ValueError(outcomes)
    return examples.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


@query("WITH r AS (SELECT DISTINCT hit_id, unit_id, human_label FROM search_corpus WHERE unit_id IS NOT NULL), n AS (SELECT unit_id, count(*) FILTER (WHERE lower(trim(human_label)) IN ('tp', 't')) AS tp FROM r WHERE coalesce(trim(human_label), '') <> '' GROUP BY 1) SELECT unit_id AS item_id, CASE WHEN tp < 90 THEN 'blocked: switch_to_full_corpus_search' ELSE '' END AS reason FROM n")
def finalize_outcomes(spark, sf_dir):
    """Units with too few positives are blocked, and their rows are not exported."""
    rows = rows_of(spark, sf_dir, "batch_id", *_PAIR).where("unit_id is not null and coalesce(trim(human_label), '') <> ''").withColumn("span_status", F.lit("ok"))
    outcomes = pipeline.finalize_many(rows, "unit_id", labels.Goals(min_tp=90))[1]
    return spark.createDataFrame([(o["item_id"], o["reason"]) for o in outcomes], "item_id string, reason string")


@query(f"WITH {CORPUS}, {sql_spans('x', 'corpus', _DUE, 'text_id')} SELECT text_id || '-cand' || lpad(k::VARCHAR, 2, '0') AS hit_id, 'no_first_pass_profile' AS first_pass_reason, match_text AS span_text FROM x")
def run_batch_rows(spark, sf_dir):
    """One unit's batch: gold gate, detection, review rows, first pass."""
    unit = B.Unit("due", "item", "a", ("due",), "기 때문", None, ("d_due",))
    made = B.Bundle([unit], [B.Rule("due", "d_due", "r_due", "detect", _DUE)])
    gold = spark.createDataFrame([("g1", "비가 오기 때문에 쉬었다", [(4, 8, "기 때문")])], "example_id string, sentence string, target_spans array<struct<start:int,end:int,text:string>>")
    rows, report = pipeline.run_batch(corpus(spark, sf_dir), made, "due", gold)
    if report.status != "ok":
        raise ValueError(report)
    return rows.select("hit_id", "first_pass_reason", "span_text")
