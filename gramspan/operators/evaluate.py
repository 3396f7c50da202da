"""Gold records, recall of rules and detectors, training-set checks and classification metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import overlap, span_key, span_text, valid
from ..functions.textfn import SPANS, finditer_spans, java_pattern
from .ranking import numbered

KEYS = ("example_id", "item_id", "label", "split", "text_a", "text_b")


def gold_records(rows: DataFrame, unit_id: str, expected: int | None = None) -> DataFrame:
    """Numbered gold records of one unit with target spans and text, and defaults for split, pattern type and role.

    Another number of good rows than ``expected``, if given, is an error.
    """
    segs = F.col("segs")
    kind = F.coalesce("pattern_type", F.when(F.size(segs) > 1, "disconti").otherwise("conti"))
    spans = F.transform(segs, lambda x: F.struct(x["s"].alias("start"), x["e"].alias("end"), F.substring(F.col("sentence"), x["s"] + 1, x["e"] - x["s"]).alias("text")))
    good = rows.where(valid(F.col("sentence"), segs))
    if expected is not None and (found := good.count()) != expected:
        raise ValueError(f"expected {expected} gold rows for {unit_id}, found {found}")
    placed = numbered(good, [], [F.col("row_no")], "_place")
    return placed.select(F.lit(unit_id).alias("unit_id"), F.format_string("%s-GOLD-%03d", F.lit(unit_id), F.col("_place")).alias("example_id"), "sentence", span_text(F.col("sentence"), segs).alias("target_text"), spans.alias("target_spans"), F.coalesce("split", F.lit("train")).alias("split"), kind.alias("pattern_type"), F.concat(F.lit("pos_"), kind).alias("gold_example_role"))


def target_spans(gold: Column) -> Column:
    """Gold target spans as segments."""
    return F.transform(gold, lambda x: F.struct(x["start"].cast("int").alias("s"), x["end"].cast("int").alias("e"))).cast(SPANS)


def regex_outcome(gold: DataFrame, pattern: str, policy: str = "overlap") -> DataFrame:
    """Gold rows with ``matched``: some match overlaps a target span, or lies anywhere in the sentence."""
    if policy not in ("overlap", "sentence"):
        raise ValueError(policy)
    if policy == "sentence":
        return gold.withColumn("matched", F.coalesce(F.col("sentence").rlike(java_pattern(pattern)), F.lit(False)))
    staged = gold.withColumn("_m", finditer_spans(F.col("sentence"), pattern))
    return staged.withColumn("matched", F.coalesce(overlap(F.col("_m"), target_spans(F.col("target_spans"))), F.lit(False))).drop("_m")


def recall(outcome: DataFrame) -> DataFrame:
    """(total, matched, recall); recall is 0 for an empty set."""
    got = outcome.agg(F.count(F.lit(1)).alias("total"), F.count_if("matched").alias("matched"))
    return got.withColumn("recall", F.when(F.col("total") > 0, F.col("matched") / F.col("total")).otherwise(0.0))


def detector_outcome(detected: DataFrame, unit_id: str) -> DataFrame:
    """Per gold row: a candidate of the unit anywhere, one over a target span, one exactly on it; numbers of candidates."""
    own = F.filter("candidates", lambda c: (c["unit_id"] == unit_id) | F.array_contains(c["member_e_ids"], F.lit(unit_id)))
    t = target_spans(F.col("target_spans"))
    staged = detected.withColumn("_o", own)
    return staged.withColumns({"in_sentence": F.size("_o") > 0, "overlapping": F.exists("_o", lambda c: overlap(c["span_segments"], t)), "exact": F.exists("_o", lambda c: span_key(c["span_segments"]) == span_key(t)), "n_candidates": F.size("_o"), "n_rejected": F.size("rejected")}).drop("_o")


def detector_recall(outcome: DataFrame) -> DataFrame:
    share = lambda c: F.coalesce(F.avg(F.col(c).cast("int")), F.lit(0.0)).alias(f"{c}_recall")
    return outcome.agg(F.count(F.lit(1)).alias("total"), share("in_sentence"), share("overlapping"), share("exact"), F.sum("n_candidates").alias("candidates"), F.sum("n_rejected").alias("rejected"))


def gold_gate(report: dict) -> bool:
    """Only full recall lets a corpus search begin."""
    return bool(report.get("total")) and report.get("recall", 0) >= 1.0


def latest_version(versions: DataFrame, item_id: str, version: str = "latest") -> DataFrame:
    """The last record of the item, or the first of a named version; ``ord`` is the place in the file."""
    own = versions.where(F.col("item_id") == item_id)
    if version == "latest":
        return own.orderBy(F.desc("ord")).limit(1)
    return own.where(F.col("regex_version") == version).orderBy("ord").limit(1)


def training_violations(rows: DataFrame) -> DataFrame:
    """(code, n): rows that break a rule of the training set, splits that lack a label, repeated ids."""
    blank = F.array(*[F.when(F.col(k).isNull() | (F.col(k).cast("string") == ""), F.lit(f"missing_{k}")) for k in KEYS], F.when(~F.col("split").isin("train", "dev", "test"), "split"), F.when(~F.col("label").isin(0, 1), "label"))
    per_row = rows.select(F.explode(F.filter(blank, lambda c: c.isNotNull())).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    again = rows.groupBy("example_id").agg(F.count(F.lit(1)).alias("k")).agg(F.count_if(F.col("k") > 1).alias("n")).select(F.lit("duplicate_example_id").alias("code"), "n").where("n > 0")
    lacking = rows.agg(*[F.count_if((F.col("split") == s) & (F.col("label") == v)).alias(f"{s}_{v}") for s in ("train", "dev", "test") for v in (0, 1)])
    codes = F.array(*[F.when(F.col(f"{s}_{v}") == 0, F.lit(f"{'warn_' if s == 'test' else ''}{s}_without_label_{v}")) for s in ("train", "dev", "test") for v in (0, 1)])
    missing = lacking.select(F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code"), F.lit(1).cast("long").alias("n"))
    return per_row.unionByName(again).unionByName(missing)


def split_counts(rows: DataFrame) -> DataFrame:
    """(split, label, n) of train, dev and test by both labels, 0 where there is none."""
    want = rows.sparkSession.createDataFrame([(s, v) for s in ("train", "dev", "test") for v in (0, 1)], "split string, label int")
    got = rows.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(want).join(got, ["split", "label"], "left").select("split", "label", F.coalesce("n", F.lit(0)).alias("n"))


def save_predictions(rows: DataFrame, path: str, limit: int | None = None, order: str = "hit_id") -> DataFrame:
    """Metrics of all rows; of the rows themselves the first ``limit`` are written, as JSON lines in a folder."""
    (rows.orderBy(order).limit(limit) if limit is not None else rows).write.mode("overwrite").json(path)
    return metrics(rows)


def length_stats(rows: DataFrame, length: Column, most: int) -> DataFrame:
    """Per split: rows, longest, mean, and the share over ``most``."""
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("longest"), F.avg(length).alias("mean"), F.avg((length > most).cast("int")).alias("truncated"))


def token_count(text: Column) -> Column:
    """Words of a text: runs of characters that are no white space."""
    from ..functions.textfn import WS

    return F.size(F.filter(F.split(text, f"[{WS}]+"), lambda x: x != ""))


def predicted(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows with a logit get ``prob``, ``pred_label`` and the loss against ``gold_label``."""
    z = F.col("logit")
    prob = F.lit(1.0) / (1 + F.exp(-z))
    # log(1 + e^-|z|) + max(z, 0) - z*y: stable for large logits.
    loss = F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - z * F.col("gold_label")
    return rows.withColumns({"prob": prob, "pred_label": (prob >= threshold).cast("int"), "loss": loss})


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def metrics(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 and balanced accuracy; 0 where a denominator is 0."""
    n = lambda g, p: F.count_if((F.col("gold_label") == g) & (F.col("pred_label") == p))
    means = [F.avg("loss").alias("mean_loss"), *[F.avg(F.when(F.col("gold_label") == g, F.col(c))).alias(f"mean_{c}_{g}") for c in ("prob", "logit") for g in (0, 1)]]
    keys = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c) for c in by or []]
    got = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(0, 0).alias("tn"), n(1, 0).alias("fn"), *means)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    p, r, s = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    return got.withColumns({"accuracy": _ratio(tp + tn, F.col("total")), "precision": p, "recall": r, "f1": _ratio(2 * p * r, p + r), "balanced_accuracy": (r + s) / 2, "pos_accuracy": r, "neg_accuracy": s})


def errors(rows: DataFrame) -> DataFrame:
    return rows.where("gold_label <> pred_label")


def best_epoch(history: list[tuple[int, float, float]], min_delta: float = 0.0, patience: int | None = None) -> tuple[int, int]:
    """(best epoch, last epoch looked at) of (epoch, dev loss, balanced accuracy): lower loss, on a tie within ``min_delta`` higher accuracy."""
    best, since, last = None, 0, -1
    for epoch, loss, acc in history:
        last = epoch
        better = best is None or loss < best[1] - min_delta or abs(loss - best[1]) <= min_delta and acc > best[2]
        best, since = ((epoch, loss, acc), 0) if better else (best, since + 1)
        if patience is not None and since >= patience:
            break
    return (best[0] if best else -1), last


def positive_weight(rows: DataFrame, mode: str | float = "auto") -> float:
    """Weight of positives in the loss: 1, negatives per positive, or the number given."""
    if mode == "none":
        return 1.0
    if mode != "auto":
        return float(mode)
    r = rows.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).first()
    return r["n"] / r["p"] if r["p"] else 1.0


def train_standin(rows: DataFrame, features: int = 1 << 14, threshold: float = 0.5) -> DataFrame:
    """Predictions of a linear classifier over hashed tokens of both texts, trained on the train split.

    It fills the place of a transformer pair encoder, behind the same prediction columns.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    data = rows.withColumns({"gold_label": F.col("label").cast("int"), "y": F.col("label").cast("double"), "w": F.when(F.col("label") == 1, positive_weight(rows.where("split = 'train'"))).otherwise(1.0), "both": F.concat_ws(" ", "text_a", "text_b")})
    stages = [RegexTokenizer(inputCol="both", outputCol="t", pattern=r"\s+"), HashingTF(inputCol="t", outputCol="x", numFeatures=features, binary=True), LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", maxIter=30, regParam=0.01, rawPredictionCol="raw")]
    scored = Pipeline(stages=stages).fit(data.where("split = 'train'")).transform(data)
    return predicted(scored.withColumn("logit", vector_to_array("raw")[1]).select(*rows.columns, "gold_label", "logit"), threshold)
