"""Registered queries of the ten training-data problems; each reads whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .history import repeats_of_history

    found = repeats_of_history(_table(spark, sf_dir, "search_corpus"), _table(spark, sf_dir, "batch_runs"))
    return found.select(F.col("id").alias("text_id"))


_TERM_FIELDS = ["span_text", "regex_match_text"]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_terms(spark, sf_dir).where("mark is not null").select("field_name", "term", "mark")


def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct value of both fields with its occurrences, records and mark."""
    from .terms import term_counts

    return term_counts(_table(spark, sf_dir, "search_corpus"), _TERM_FIELDS)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .dedupe_exact import duplicate_sets

    sets, _ = duplicate_sets(_table(spark, sf_dir, "search_corpus"), "text_id", "raw_text")
    return sets.where("kept_id <> id").select(F.col("kept_id").alias("kept_text_id"), F.col("id").alias("text_id"))


def p3_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per kept text with its number of copies."""
    from .dedupe_exact import hidden_duplicates

    every = hidden_duplicates(_table(spark, sf_dir, "search_corpus"), "text_id", "raw_text")
    return every.where("kept_id = id").select(F.col("kept_id").alias("kept_text_id"), "copies")


def _texts_and_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _table(spark, sf_dir, "search_corpus").select(F.col("text_id").alias("key"), F.col("raw_text").alias("text"))
    return texts.unionByName(_table(spark, sf_dir, "df003_gold_50").select(F.col("example_id").alias("key"), F.col("sentence").alias("text")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .unify import lookalike_pairs

    return lookalike_pairs(_texts_and_gold(spark, sf_dir), "key", "text")


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record that looks like another one, with the class of its look and the number of records it looks like."""
    from .unify import lookalike_classes

    return lookalike_classes(_texts_and_gold(spark, sf_dir), "key", "text").withColumnRenamed("id", "key")


def p4_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of both tables in its one consistent form."""
    from .unify import unify

    return unify(_texts_and_gold(spark, sf_dir), "key", "text").select(F.col("id").alias("key"), "look", (~F.col("text").eqNullSafe(F.col("look"))).alias("changed"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .overlap import overlap_pairs, overlaps

    pairs = overlap_pairs(*overlaps(_table(spark, sf_dir, "df003_gold_50")))
    return pairs.select(F.col("id_a").alias("example_id_a"), F.col("id_b").alias("example_id_b"))


def p5_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gold record with a partner across the splits, with its class and number of partners."""
    from .overlap import overlap_classes, overlaps

    return overlap_classes(*overlaps(_table(spark, sf_dir, "df003_gold_50"))).withColumnRenamed("id", "example_id")


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed overlaps per evaluation split and source."""
    from .overlap import overlap_report, overlaps

    return overlap_report(*overlaps(_table(spark, sf_dir, "df003_gold_50")))


_SAMPLE = ["batch_id_prefix", "schedule_id"]


def _sampled(spark: SparkSession, sf_dir: str) -> tuple:
    from .sampling import Population, manifest_wants, plan

    population = Population(_table(spark, sf_dir, "search_corpus"), "text_id", "corpus_domain")
    wants = manifest_wants(_table(spark, sf_dir, "example_making_manifest"), _table(spark, sf_dir, "domain_minimums"))
    return population, plan(wants, population.sizes)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_report(spark, sf_dir).where("short").select(*_SAMPLE, "corpus_domain")


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each manifest and schedule wanted of each domain, what was there and what was drawn."""
    from .sampling import report

    return report(spark, _sampled(spark, sf_dir)[1], _SAMPLE).withColumnRenamed("category", "corpus_domain")


def p6_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn texts of every manifest and schedule."""
    from .sampling import draw

    drawn = draw(*_sampled(spark, sf_dir), _SAMPLE)
    return drawn.withColumnRenamed("category", "corpus_domain").withColumnRenamed("id", "text_id")


_STRATA = ["pattern_type", "gold_example_role"]


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .grouped_split import torn

    return torn(_table(spark, sf_dir, "df003_gold_50")).withColumnRenamed("id", "example_id")


def p7_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new split for every gold record, no group torn."""
    from .grouped_split import split_groups, targets_of

    targets = targets_of(_table(spark, sf_dir, "split_targets"))
    return split_groups(_table(spark, sf_dir, "df003_gold_50"), targets, _STRATA).withColumnRenamed("id", "example_id")


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of the new split beside the wanted ones."""
    from .grouped_split import split_report, targets_of

    return split_report(spark, p7_split(spark, sf_dir), targets_of(_table(spark, sf_dir, "split_targets")))


def p7_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every label's records are spread over the new splits."""
    from .grouped_split import label_report, split_groups, targets_of

    gold, targets = _table(spark, sf_dir, "df003_gold_50"), targets_of(_table(spark, sf_dir, "split_targets"))
    return label_report(gold, split_groups(gold, targets, _STRATA), targets, _STRATA)


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every text, or piece of an overlong text, goes for each kind of container."""
    from .packing import pack

    packed = pack(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pack_containers"))
    return packed.withColumnRenamed("id", "doc_id")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used and their fill."""
    from .packing import pack_report

    return pack_report(p8_packed(spark, sf_dir), _table(spark, sf_dir, "pack_containers"))


def p9_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of every mix with their repeats."""
    from .mixing import mix

    mixed, _ = mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))
    return mixed.select("mix_id", F.col("id").alias("doc_id"), "tokens", "repeats")


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual beside wanted shares of every mix."""
    from .mixing import mix, mix_report

    return mix_report(*mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets")))


def p9_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source classifier does on held-out documents."""
    from .mixing import classifier_report

    return classifier_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .residue import residue

    return residue(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def p10_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean rest of the documents."""
    from .residue import residue, without_residue

    docs = _table(spark, sf_dir, "documents")
    return without_residue(docs, residue(docs)).select("doc_id", "source", "n_chars")


def queries() -> dict:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that need neither NFKC nor an iterative or random method."""
    return {"p6_found": _P6, "p7_found": _P7}


_TRIM = r"lower(regexp_replace({}, '^[\s\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+|[\s\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+$', '', 'g'))"
_P6 = f"""
WITH sizes AS (SELECT {_TRIM.format("corpus_domain")} AS d, count(DISTINCT text_id) AS n FROM search_corpus GROUP BY 1),
plans AS (
  SELECT batch_id_prefix, 'base' AS schedule_id, sampling AS want, NULL AS skip FROM example_making_manifest
  UNION ALL
  SELECT batch_id_prefix, s.schedule_id, s.sampling, s.rank_start_offsets FROM (SELECT batch_id_prefix, unnest(sampling_schedules) AS s FROM example_making_manifest)),
wants AS (SELECT batch_id_prefix, schedule_id, {_TRIM.format("e.key")} AS d, sum(coalesce(e.value, 0)) AS n FROM (SELECT batch_id_prefix, schedule_id, unnest(map_entries(want)) AS e FROM plans) GROUP BY 1, 2, 3),
skips AS (SELECT batch_id_prefix, schedule_id, {_TRIM.format("e.key")} AS d, max(coalesce(e.value, 0)) AS o FROM (SELECT batch_id_prefix, schedule_id, unnest(map_entries(skip)) AS e FROM plans WHERE skip IS NOT NULL) GROUP BY 1, 2, 3)
SELECT w.batch_id_prefix, w.schedule_id, w.d AS corpus_domain
FROM wants w LEFT JOIN skips k USING (batch_id_prefix, schedule_id, d) LEFT JOIN sizes z USING (d)
WHERE w.d <> '' AND coalesce(z.n, 0) < w.n + coalesce(k.o, 0)
"""

# Components by reachability over the keys of records: e for sources, x for texts, r for the record itself.
_P7 = f"""
WITH RECURSIVE g AS (SELECT DISTINCT example_id AS id, nullif({_TRIM.format("source_e_id")}, '') AS e, nullif(source_example_id, '') AS x, {_TRIM.format("split")} AS s FROM df003_gold_50 WHERE example_id IS NOT NULL),
r AS (SELECT id, e, x, CASE WHEN s IN ('train', 'training') THEN 'train' WHEN s IN ('dev', 'val', 'valid', 'validation') THEN 'dev' WHEN s = 'test' THEN 'test' END AS split FROM g),
k AS (SELECT id, 'e' || e AS k FROM r WHERE e IS NOT NULL UNION SELECT id, 'x' || x FROM r WHERE x IS NOT NULL UNION SELECT id, 'r' || id FROM r),
link AS (SELECT DISTINCT a.k AS a, b.k AS b FROM k a JOIN k b USING (id)),
reach AS (SELECT k AS a, k AS b FROM k UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
root AS (SELECT substring(a, 2) AS id, min(b) AS root FROM reach WHERE a LIKE 'r%' GROUP BY 1),
named AS (SELECT root.id, root, CASE WHEN root LIKE 'e%' THEN substring(root, 2) ELSE min(root.id) OVER (PARTITION BY root) END AS group_key FROM root),
torn AS (SELECT root FROM named JOIN r USING (id) GROUP BY 1 HAVING count(DISTINCT split) > 1)
SELECT id AS example_id, group_key FROM named WHERE root IN (SELECT root FROM torn)
"""
