"""Labelled review rows to span-marked pair examples: eligibility, dedupe, numbering, splits, import, merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spans import CLOSE, OPEN, format_spans, inject_markers, parse_spans, span_key, span_text, valid
from ..functions.textfn import blank_to_null, trim_ws
from .labels import normal_label, normal_status
from .ranking import numbered

ROLES = {"pos_conti": 1, "pos_disconti": 1, "neg_target_absent": 0}
SPLITS = ("train", "dev", "test")
CONTENT = ["item_id", "label", "raw_text", "span_key"]
#: Fixed value: what a source's name says about its domain, first match first.
SOURCE_WORDS = (("일상", "daily_conversation"), ("대화", "daily_conversation"), ("신문", "news"), ("뉴스", "news"), ("비출판", "non_published"), ("구어", "learner_spoken"), ("문어", "learner_written"), ("학습자", "learner_written"))


def item_texts(items: DataFrame) -> DataFrame:
    """(item_id, text_b): the form, with the gloss on a line of its own where there is one."""
    form, gloss = blank_to_null("canonical_form"), blank_to_null("gloss")
    return items.select(F.col("e_id").alias("item_id"), F.concat_ws("\n", form, gloss).alias("text_b")).where("item_id is not null")


def unit_texts(items: DataFrame, units: DataFrame) -> DataFrame:
    """(item_id, text_b) of items first, then of units no item is named like."""
    own = item_texts(items).dropDuplicates(["item_id"])
    rest = units.select(F.col("unit_id").alias("item_id"), F.concat_ws("\n", blank_to_null("canonical_form"), blank_to_null("gloss")).alias("text_b"))
    return own.unionByName(rest.join(own.select("item_id"), "item_id", "left_anti"))


def judged(rows: DataFrame, item: Column) -> DataFrame:
    """Rows with label, role, segments and ``skip_reason``; a null reason keeps the row."""
    r = rows.withColumns({"item_id": item, "_l": normal_label(F.col("human_label")), "_s": normal_status(F.col("span_status")), "segs": parse_spans(F.col("span_segments"))})
    text_ok = blank_to_null("raw_text").isNotNull()
    reason = (
        F.when(F.col("_l").isin("blank", "invalid", "unclear"), F.concat(F.lit("human_label_"), F.col("_l")))
        .when(F.col("_s") == "invalid", "span_status_invalid")
        .when((F.col("_l") == "tp") & (F.col("_s") != "ok"), "tp_span_not_ok")
        .when((F.col("_l") == "fp") & ~F.col("_s").isin("ok", "not_applicable", "blank"), "fp_span_status")
        .when(~text_ok, "raw_text_blank")
        .when(~F.coalesce(valid(F.col("raw_text"), F.col("segs")), F.lit(False)), "span_invalid")
    )
    label = F.when(F.col("_l") == "tp", 1).when(F.col("_l") == "fp", 0)
    role = F.when(label == 0, "neg_target_absent").when(F.size("segs") > 1, "pos_disconti").when(label == 1, "pos_conti")
    return r.withColumns({"skip_reason": reason, "label": label, "example_role": role, "pattern_type": F.when(F.size("segs") > 1, "disconti").otherwise("conti")}).drop("_l", "_s")


def pair_rows(rows: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Kept rows as pairs: marked text, the item's text, span key and text, and a note of where they come from."""
    kept = rows.where("skip_reason is null")
    note = F.concat_ws("; ", F.concat(F.lit("hit_id="), F.col("hit_id")), F.concat(F.lit("rules="), blank_to_null("detect_rule_ids")), F.concat(F.lit("memo="), blank_to_null("memo")), F.concat(F.lit("reviewer="), blank_to_null("reviewer")))
    made = kept.withColumns({"text_a": inject_markers(F.col("raw_text"), F.col("segs")), "span_key": span_key(F.col("segs")), "span_text": span_text(F.col("raw_text"), F.col("segs")), "span_json": format_spans(F.col("segs")), "note": note})
    return made.join(texts, "item_id", "left") if texts is not None else made  # broadcast only where its size allows it


def deduped(rows: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each content, by ``order``."""
    w = Window.partitionBy(*CONTENT).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def instance_ids(rows: DataFrame) -> DataFrame:
    """``instance_id`` 1..n of an item's spans within one text, from left to right; ``instances`` is n."""
    text = F.coalesce(blank_to_null("text_id"), F.concat_ws(":", F.lit("text"), F.col("raw_text")))
    w = Window.partitionBy("item_id", text)
    first = F.get("segs", F.lit(0))
    place = F.coalesce(F.col("candidate_index").try_cast("int"), F.lit(0))
    return rows.withColumns({"instance_id": F.row_number().over(w.orderBy(first["s"], first["e"], place, "span_key", "hit_id")), "instances": F.count(F.lit(1)).over(w)})


def example_ids(rows: DataFrame) -> DataFrame:
    """``<item>-pos-0001`` and ``<item>-neg-0001`` in order of hit id."""
    made = numbered(rows, ["item_id", "label"], [F.col("hit_id"), F.col("span_key")], "_place")
    return made.withColumn("example_id", F.format_string("%s-%s-%04d", F.col("item_id"), F.when(F.col("label") == 1, "pos").otherwise("neg"), F.col("_place"))).drop("_place")


def splits(rows: DataFrame, seed: int = 0, dev: float = 0.1, test: float = 0.1) -> DataFrame:
    """``split`` per item and role: in hash order train, dev, test; a role of under 10 rows is all train."""
    key = F.sha2(F.concat_ws("|", F.lit(str(seed)), "item_id", "example_role", "hit_id", "raw_text", "span_key"), 256)
    made = numbered(rows, ["item_id", "example_role"], [key, F.col("hit_id")], "_place")
    sizes = made.groupBy("item_id", "example_role").agg(F.count(F.lit(1)).alias("_size"))
    size, place = F.col("_size"), F.col("_place")
    share = lambda x: F.greatest(F.lit(1), F.bround(size * F.lit(x), 0).cast("int"))
    train = size - share(dev) - share(test)
    return made.join(sizes, ["item_id", "example_role"]).withColumn("split", F.when(size < 10, "train").when(place <= train, "train").when(place <= train + share(dev), "dev").otherwise("test")).drop("_size", "_place")


def skip_report(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("skip_reason", F.lit("kept")).alias("skip_reason")).agg(F.count(F.lit(1)).alias("n"))


def split_cube(rows: DataFrame) -> DataFrame:
    """(example_role, split, n) with totals; null stands for all."""
    return rows.cube("example_role", "split").agg(F.count(F.lit(1)).alias("n"))


def domain_of_source(source: Column) -> Column:
    out = F.lit("unknown")
    for word, domain in reversed(SOURCE_WORDS):
        out = F.when(F.contains(source, F.lit(word)), domain).otherwise(out)
    return out


def stable_text_id(item: Column, text: Column) -> Column:
    return F.concat(F.lit("manual_"), F.substring(F.sha1(F.concat_ws("|", item, text)), 1, 12))


def manual_violations(rows: DataFrame) -> DataFrame:
    """(code, example_id) of manual rows outside the domains of split, role, pattern type and instance."""
    checks = F.array(
        F.when(~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False)), "split"),
        F.when(~F.coalesce(F.col("example_role").isin(*ROLES), F.lit(False)), "role"),
        F.when((F.col("example_role") == "pos_disconti") & (F.size("segs") < 2) | (F.col("example_role") == "pos_conti") & (F.size("segs") > 1), "pattern_type"),
        F.when(F.coalesce(F.col("instance_id"), F.lit(0)) < 1, "instance"),
    )
    return rows.select(F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("code"), "example_id")


def import_additions(base: DataFrame, extra: DataFrame) -> DataFrame:
    """``extra`` rows with ``imported``: not if the id is there, the content is there, or an earlier extra row has it."""
    by_id = extra.join(base.select("example_id").distinct().withColumn("_a", F.lit(True)), "example_id", "left")
    known = base.select(*CONTENT).distinct().withColumn("_b", F.lit(True))
    both = by_id.join(known, CONTENT, "left")
    fresh = F.col("_a").isNull() & F.col("_b").isNull()
    n = F.sum(fresh.cast("int")).over(Window.partitionBy(*CONTENT).orderBy("example_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    outcome = F.when(F.col("_a"), "skipped_existing").when(F.col("_b"), "skipped_duplicate_content").when(n > 1, "skipped_duplicate_content").otherwise("imported")
    return both.withColumn("outcome", outcome).drop("_a", "_b")


def manual_rows(rows: DataFrame, item_id: str) -> DataFrame:
    """Hand-written rows as examples: label by role, pattern type by segments, a stable text id where there is none, domain by source."""
    label = F.when(F.col("example_role").isin(*[r for r, v in ROLES.items() if v]), 1).when(F.col("example_role").isin(*[r for r, v in ROLES.items() if not v]), 0)
    made = {"item_id": F.lit(item_id), "label": label, "pattern_type": F.when(F.size("segs") > 1, "disconti").otherwise("conti"), "text_id": F.coalesce(blank_to_null("text_id"), stable_text_id(F.lit(item_id), F.col("raw_text"))), "corpus_domain": domain_of_source(F.coalesce("source", F.lit("")))}
    return rows.withColumns(made | {"span_key": span_key(F.col("segs")), "span_text": span_text(F.col("raw_text"), F.col("segs"))})


def import_table(base: DataFrame, extra: DataFrame) -> DataFrame:
    """``base`` and the rows of ``extra`` that it lacks, with instances numbered anew."""
    fresh = import_additions(base, extra).where("outcome = 'imported'").drop("outcome")
    old = [c for c in ("instance_id", "instances") if c in base.columns]
    return instance_ids(base.drop(*old).unionByName(fresh.drop(*old), allowMissingColumns=True))


def import_summary(base: DataFrame, extra: DataFrame) -> DataFrame:
    """One row: rows before, imported, skipped by id and by content, rows after."""
    n = lambda x: F.count_if(F.col("outcome") == x)
    got = import_additions(base, extra).agg(n("imported").alias("imported"), n("skipped_existing").alias("skipped_existing"), n("skipped_duplicate_content").alias("skipped_duplicate_content"))
    before = base.agg(F.count(F.lit(1)).alias("base"))
    return got.join(F.broadcast(before)).withColumn("total", F.col("base") + F.col("imported"))  # one row each


def instance_summary(rows: DataFrame) -> DataFrame:
    """One row: texts with several examples of one item, the examples in them, examples without a text id."""
    text = F.coalesce(blank_to_null("text_id"), F.concat_ws(":", F.lit("text"), F.col("raw_text")))
    per = rows.groupBy("item_id", text.alias("t")).agg(F.count(F.lit(1)).alias("n"), F.count_if(blank_to_null("text_id").isNull()).alias("lacking"))
    several = F.col("n") > 1
    return per.agg(F.count_if(several).alias("n_multi_instance_sentences"), F.coalesce(F.sum(F.when(several, F.col("n"))), F.lit(0)).alias("n_examples_in_multi_instance_sentences"), F.coalesce(F.sum("lacking"), F.lit(0)).alias("n_examples_missing_text_id"))


#: Fixed value: the columns of the ledger, in their order.
LEDGER_COLUMNS = ["item_id", "example_id", "context_left", "target_sentence", "context_right", "instance_id", "split", "span_segments", "pattern_type", "example_role", "source", "note"]


def ledger(rows: DataFrame) -> DataFrame:
    """Examples as the ledger's text columns; the source is the domain where there is one."""
    own = {"context_left": F.lit(""), "context_right": F.lit(""), "target_sentence": F.col("raw_text"), "span_segments": format_spans(F.col("segs")), "source": F.coalesce(F.nullif(F.col("corpus_domain"), F.lit("")), F.col("source") if "source" in rows.columns else F.lit("")), "instance_id": F.coalesce(F.col("instance_id").cast("string"), F.lit("1"))}
    return rows.select(*[F.coalesce(own.get(c, F.col(c)).cast("string"), F.lit("")).alias(c) for c in LEDGER_COLUMNS])


def row_violations(rows: DataFrame) -> DataFrame:
    """(code, example_id) of rows a strict merge refuses: split, role, label, markers, span key and span text recomputed."""
    segs = F.col("segs")
    want = F.lit(None).cast("int")
    for role, label in ROLES.items():
        want = F.when(F.col("example_role") == role, label).otherwise(want)
    differs = lambda a, b: ~a.eqNullSafe(b)
    checks = F.array(
        F.when(blank_to_null("example_id").isNull(), "example_id_blank"),
        F.when(~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False)), "split"),
        F.when(want.isNull(), "role").when(differs(F.col("label"), want), "label_role"),
        F.when(~F.coalesce(valid(F.col("raw_text"), segs), F.lit(False)), "span_invalid").when(differs(F.col("span_key"), span_key(segs)), "span_key").when(differs(F.col("span_text"), span_text(F.col("raw_text"), segs)), "span_text"),
        F.when(~(F.contains(F.coalesce("text_a", F.lit("")), F.lit(OPEN)) & F.contains(F.coalesce("text_a", F.lit("")), F.lit(CLOSE))), "markers"),
    )
    return rows.select(F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("code"), "example_id")


def uniqueness(rows: DataFrame) -> DataFrame:
    """(key, n_groups): how many example ids, ids within items, and contents occur more than once."""
    out = None
    for name, keys in (("example_id", ["example_id"]), ("item_example_id", ["item_id", "example_id"]), ("content", CONTENT)):
        again = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_groups")).select(F.lit(name).alias("key"), "n_groups")
        out = again if out is None else out.unionByName(again)
    return out


def canonical_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("item_id", F.desc("label"), "example_role", "example_id")


def item_rollup(rows: DataFrame) -> DataFrame:
    """Counts per item and in total (item null)."""
    each = [F.count_if(F.col("label") == 1).alias("positive"), F.count_if(F.col("label") == 0).alias("negative"), *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS], *[F.count_if(F.col("example_role") == r).alias(r) for r in ROLES]]
    return rows.rollup("item_id").agg(F.count(F.lit(1)).alias("total"), *each)


def tidy_id(x: str) -> Column:
    return trim_ws(F.col(x))
