"""Problem 9: mixing sources to target weights, by soft membership.

Method: documents with a source known to a mix are labelled. A multinomial naive Bayes classifier
over hashed character pairs is fitted on a bounded sample of them; how far its evidence is trusted
(a factor on log likelihoods, 0 leaving the prior) is chosen by the log loss on a held-out part of the
sample. It predicts every document's posterior over the sources. A label is evidence too: it is right
with probability TRUST, so a labelled document mostly belongs to its own source, and one without a
source is spread over those that its text suggests. Nonnegative document rates of at most
``max_repeats`` are then fitted by projected-gradient least squares on the difference between
expected source totals (in tokens) and targets. A rate is a function of membership and residuals so
far; memberships are rounded to 1 / PARTS, so an iteration passes over distinct memberships, those of
one source alone being worked out on the driver, and ships one small matrix each way. Rates become
whole repeats: each document's rate rounded down, and one more for some: long documents by a toss at
their fraction, then others in random order up to the tokens that the fractions add up to, by prefix
sums, which evens out the tosses.

Defined cases: sources are compared by look, lower case, without blanks; null or blank sources are
unlabelled, sources no mix names take no part; weights count relative to their mix's sum; a null
or non-positive weight, budget or repeat limit gives no tokens; sources without documents get none
and are reported; a source of several rows in one mix adds its weights, with the largest limit; a
repeated document id counts once; of documents with one text only one takes part (a labelled one
before others, then the smallest id), since no text may be used more often than its limit; empty
texts have no tokens and are left out; extra columns are ignored; empty tables give no rows. Mixes
and their sources (MOST_TARGETS rows) are on the driver.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .textform import look
from .tokens import VOCABULARY, count, ship

SAMPLE, BUCKETS, ITERATIONS, CLOSE, MOST_TARGETS, LONG = 20_000, 4096, 25, 1e-3, 10_000, 100  # labelled rows to fit on; hashed features; bounds of the fit; long: over a LONG-th of what fractions add up to
TRUST, PARTS, HELD, TEMPERS = 0.999, 64, 4, (0.0, 0.01, 0.03, 0.1, 0.3, 1.0)  # a label is right; memberships in parts; one in HELD sample rows is held out; factors tried on the evidence
_FREE = -1  # label of a document whose source no mix knows because it has none


@lru_cache(1 << 14)
def clean_source(source: str | None) -> str:
    return "".join(look(source or "").lower().split())


def features(text: str) -> np.ndarray:
    """Counts of hashed character pairs of a whole text."""
    x = np.frombuffer(look(text).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(x) < 2:
        return np.zeros(BUCKETS)
    h = (x[:-1] * np.uint32(2654435761) ^ x[1:] * np.uint32(2246822519)) >> np.uint32(20)
    return np.bincount(h, minlength=BUCKETS).astype(float)


class Bayes:
    """Multinomial naive Bayes from a (classes, BUCKETS) matrix of counts and class sizes."""

    def __init__(self, counts: np.ndarray, docs: np.ndarray, smooth: float = 0.5):
        self.log = np.log(counts + smooth) - np.log((counts + smooth).sum(1, keepdims=True))
        self.prior = np.log(docs + 1.0) - np.log((docs + 1.0).sum())

    def posterior(self, x: np.ndarray, temper: float = 1.0) -> np.ndarray:
        n = max(x.sum(), 1.0)
        score = self.prior + temper * min(1.0, 200.0 / n) * (self.log @ x)  # pairs of one text aren't independent: long texts are tempered
        p = np.exp(score - score.max())
        return p / p.sum()


def membership(p: np.ndarray, label: int) -> list[int] | None:
    """Parts of PARTS by source, from a posterior and a label (or _FREE); none if all of it is the label's."""
    if label >= 0:
        p = p * np.where(np.arange(len(p)) == label, TRUST, (1 - TRUST) / max(1, len(p) - 1))
        p = p / p.sum() if p.sum() > 0 else np.arange(len(p)) == label
    exact = p * PARTS
    parts = np.floor(exact).astype(int)
    parts[np.argsort(parts - exact, kind="stable")[: PARTS - parts.sum()]] += 1
    return None if label >= 0 and parts[label] == PARTS else parts.tolist()


class Targets:
    """Mixes by sources: token targets and repeat limits."""

    def __init__(self, table: DataFrame):
        rows = table.limit(MOST_TARGETS + 1).collect()
        if len(rows) > MOST_TARGETS:
            raise ValueError(f"over {MOST_TARGETS} rows of targets")
        good = [r for r in rows if r["mix_id"] is not None and clean_source(r["source"]) and (r["weight"] or 0) > 0 and (r["budget_tokens"] or 0) > 0]
        self.mixes = sorted({r["mix_id"] for r in good})
        self.sources = sorted({clean_source(r["source"]) for r in good})
        self.want = np.zeros((len(self.mixes), len(self.sources)))
        self.limit = np.zeros_like(self.want)
        self.named, budget = {}, defaultdict(float)
        for r in good:
            m, s = self.mixes.index(r["mix_id"]), self.sources.index(clean_source(r["source"]))
            self.want[m, s] += r["weight"]
            self.limit[m, s] = max(self.limit[m, s], r["max_repeats"] or 0)
            self.named[m, s] = r["source"]
            budget[m] = max(budget[m], r["budget_tokens"])
        for m in range(len(self.mixes)):
            self.want[m] *= budget[m] / self.want[m].sum()


def rates(member: np.ndarray, targets: Targets, steps: list[np.ndarray]) -> np.ndarray:
    """(documents, mixes) rates after the given steps, one (mixes, sources) matrix each; member is (documents, sources)."""
    limit = member @ targets.limit.T  # soft members repeat at most as their expected source allows
    r = np.zeros_like(limit)
    for step in steps:
        r = np.clip(r + member @ step.T, 0, limit)
    return r


def _soft(column) -> np.ndarray:
    """(rows, sources) memberships of a column of parts without nulls."""
    return np.array(column.to_pylist(), float).reshape(len(column), -1) / PARTS


class Classifier:
    """Posteriors of sources, learnt from a bounded sample of labelled documents; ``held_out`` is what it did on the rest of it."""

    def __init__(self, docs: DataFrame, targets: Targets, scratch: Scratch, sample: int, seed: int):
        n, place = len(targets.sources), {s: k for k, s in enumerate(targets.sources)}
        known = docs.where(F.trim("source") != "").count()
        share = min(1.0, sample / max(known, 1))
        toss = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20))
        picked = docs.where((toss < int(share * (1 << 20))) & F.col("source").isNotNull()).withColumn("held", F.pmod(F.xxhash64(F.lit(seed + 9), "id"), F.lit(HELD)) == 0)

        def labelled_texts(batch):
            for s, t in zip(batch.column("source").to_pylist(), batch.column("text").to_pylist()):
                k = place.get(clean_source(s))
                if k is not None and t:
                    yield k, features(t)

        def learn(batches):
            counts, sizes = np.zeros((n, BUCKETS)), np.zeros(n)
            for batch in batches:
                for k, x in labelled_texts(batch):
                    counts[k] += x
                    sizes[k] += 1
            there = np.flatnonzero(sizes)
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(sizes[there]), pa.array(counts[there].tolist(), pa.list_(pa.float64()))], ["label", "docs", "counts"])

        # One row per source and task, summed by source and feature before it reaches the driver: sources x BUCKETS numbers.
        learnt = scratch.keep(picked.where("not held").mapInArrow(learn, "label int, docs double, counts array<double>"), "learnt")
        counts, sizes = np.zeros((n, BUCKETS)), np.zeros(n)
        for r in learnt.groupBy("label").agg(F.sum("docs").alias("docs")).collect():
            sizes[r["label"]] = r["docs"]
        summed = learnt.select("label", F.posexplode("counts").alias("f", "c")).where("c > 0").groupBy("label", "f").agg(F.sum("c").alias("c"))
        for r in summed.groupBy("label").agg(F.collect_list(F.struct("f", "c")).alias("row")).toLocalIterator():  # at most BUCKETS each
            for f, c in r["row"]:
                counts[r["label"], f] = c
        self.model = model = docs.sparkSession.sparkContext.broadcast((counts, sizes))  # sources x BUCKETS numbers, whatever the input

        def score(batches):
            bayes, got = Bayes(*model.value), np.zeros((len(TEMPERS), 3))
            for batch in batches:
                for k, x in labelled_texts(batch):
                    for j, temper in enumerate(TEMPERS):
                        p = bayes.posterior(x, temper)
                        got[j] += 1, p.argmax() == k, -np.log(max(p[k], 1e-12))
            yield pa.RecordBatch.from_arrays([pa.array(TEMPERS), *map(pa.array, got.T)], ["temper", "docs", "right", "loss"])

        sums = picked.where("held").mapInArrow(score, "temper double, docs double, right double, loss double").groupBy("temper").agg(F.sum("docs").alias("docs"), F.sum("right").alias("right"), F.sum("loss").alias("loss"))
        self.held_out = sorted(((r["temper"], int(r["docs"]), r["right"] / r["docs"], r["loss"] / r["docs"]) for r in sums.where("docs > 0").collect()), key=lambda r: r[0])
        self.temper = min(self.held_out, key=lambda r: (r[3], r[0]))[0] if self.held_out else 0.0


def labelled(docs: DataFrame, targets: Targets, scratch: Scratch, sample: int = SAMPLE, vocabulary: str = VOCABULARY, seed: int = 0) -> DataFrame:
    """(id, tokens, label, parts), one row per distinct text: label is a source's place or _FREE; parts are those of membership()."""
    kind = docs.schema["id"].dataType.simpleString()
    place = {s: k for k, s in enumerate(targets.sources)}
    learnt = Classifier(docs, targets, scratch, sample, seed)
    model, temper = learnt.model, learnt.temper

    def measure(batches):
        bayes = Bayes(*model.value)
        for batch in batches:
            src = [clean_source(s) for s in batch.column("source").to_pylist()]
            label = [place.get(s, None) if s else _FREE for s in src]
            keep = [k for k, x in enumerate(label) if x is not None]
            part = batch.take(pa.array(keep, pa.int64()))
            texts, lab = part.column("text").to_pylist(), [label[k] for k in keep]
            tokens = count(texts, vocabulary)
            parts = [membership(bayes.posterior(features(t), temper), k) if n else None for t, k, n in zip(texts, lab, tokens)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("t1"), part.column("t2"), pa.array(tokens, pa.int64()), pa.array(lab, pa.int32()), pa.array(parts, pa.list_(pa.int32()))], ["id", "t1", "t2", "tokens", "label", "parts"])

    hashed = docs.select("id", "source", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    sized = hashed.mapInArrow(measure, f"id {kind}, t1 long, t2 long, tokens long, label int, parts array<int>").where("tokens > 0")
    row = F.struct((F.col("label") < 0).alias("free"), "id", "tokens", "label", "parts")
    by_id = sized.withColumn("row", F.struct("t1", "t2", row.alias("row"))).groupBy("id").agg(F.min("row").alias("x")).select("x.*")
    return scratch.keep(by_id.groupBy("t1", "t2").agg(F.min("row").alias("x")).select("x.id", "x.tokens", "x.label", "x.parts"), "members")


def fit(members: DataFrame, targets: Targets, scratch: Scratch) -> list[np.ndarray]:
    """Steps of the projected gradient, each a (mixes, sources) matrix. Documents of one source alone share one rate and are
    summed up first, others by membership; a pass goes over these sums."""
    m, n = targets.want.shape
    alone = np.zeros(n)
    for r in members.where("parts is null").groupBy("label").agg(F.sum("tokens").alias("tokens")).collect():  # a row per source
        alone[r["label"]] = r["tokens"]
    classes = scratch.keep(members.where("parts is not null").groupBy("parts").agg(F.sum("tokens").alias("tokens")), "classes")
    mixed = not classes.isEmpty()

    def totals(steps):
        reached, there = (rates(np.eye(n), targets, steps) * alone[:, None]).T, alone.copy()

        def run(batches):
            reached, there = np.zeros((m, n)), np.zeros(n)
            for batch in batches:
                t, w = batch.column("tokens").to_numpy().astype(float), _soft(batch.column("parts"))
                reached += (rates(w, targets, steps) * t[:, None]).T @ w
                there += t @ w
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(m + 1), n), pa.int32()), pa.array(np.tile(np.arange(n), m + 1), pa.int32()), pa.array(np.concatenate([reached.ravel(), there]))], ["mix", "source", "tokens"])

        if mixed:
            got = np.zeros((m + 1, n))
            for r in classes.mapInArrow(run, "mix int, source int, tokens double").groupBy("mix", "source").agg(F.sum("tokens").alias("tokens")).collect():
                got[r["mix"], r["source"]] = r["tokens"]
            reached, there = reached + got[:m], there + got[m]
        return reached, there

    steps: list[np.ndarray] = []
    last = None
    small = CLOSE * np.maximum(targets.want, targets.want.sum(1, keepdims=True) / (10 * max(n, 1)))
    for _ in range(ITERATIONS):
        reached, there = totals(steps)
        miss = targets.want - reached
        if last is not None and np.all(np.abs(reached - last) <= small):
            break
        last = reached
        # Scaled by each source's size, the step of a source with only its own documents is exact.
        steps.append(np.divide(miss, there, out=np.zeros_like(miss), where=there > 0))
    return steps


def mix(documents: DataFrame, table: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", vocabulary: str = VOCABULARY, seed: int = 0) -> tuple[DataFrame, Targets]:
    """(mix_id, id, label, tokens, repeats) of every document in a mix, and the targets."""
    spark = documents.sparkSession
    scratch, targets = Scratch(spark, "mixing"), Targets(table)
    kind = documents.schema[id_col].dataType.simpleString()
    docs = documents.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    empty = f"mix_id string, id {kind}, label int, tokens long, repeats long"
    if not targets.mixes:
        return spark.createDataFrame([], empty), targets
    ship(spark, vocabulary)
    members = labelled(docs, targets, scratch, vocabulary=vocabulary, seed=seed)
    steps, n, mixes = fit(members, targets, scratch), len(targets.sources), targets.mixes

    def apply(batches):
        alone = rates(np.eye(n), targets, steps)
        for batch in batches:
            label, parts = batch.column("label").to_numpy(), batch.column("parts")
            r, soft = alone[np.maximum(label, 0)], np.flatnonzero(parts.is_valid())
            if len(soft):
                r[soft] = rates(_soft(parts.take(pa.array(soft))), targets, steps)
            at, m = np.nonzero(r > 0)
            part = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(m, pa.int32()), part.column("id"), part.column("label"), part.column("tokens"), pa.array(r[at, m])], ["mix", "id", "label", "tokens", "rate"])

    rated = members.mapInArrow(apply, f"mix int, id {kind}, label int, tokens long, rate double")
    mixed = rated.withColumn("order", F.xxhash64(F.lit(seed + 1), "mix", "id")).repartitionByRange("mix", "label", "order", "id").sortWithinPartitions("mix", "label", "order", "id")
    rated = scratch.keep(mixed.select("mix", "label", "id", "tokens", "rate", F.monotonically_increasing_id().alias("at")), "rated")
    rest = F.col("rate") - F.floor("rate")
    whole = rated.groupBy("mix", "label").agg(F.sum(rest * F.col("tokens")).alias("budget"))  # a row per mix and source
    toss = F.pmod(F.xxhash64(F.lit(seed + 2), "mix", "id"), F.lit(1 << 30)) / float(1 << 30)
    long_ = F.col("tokens") * LONG > F.col("budget")
    own = rated.join(F.broadcast(whole), ["mix", "label"]).withColumn("part", F.shiftright("at", 33)).withColumn("rest", rest)
    own = own.withColumn("long", long_ & (F.col("rest") > 0)).withColumn("won", F.col("long") & (toss < F.col("rest"))).withColumn("t", F.when((F.col("rest") > 0) & ~F.col("long"), F.col("tokens")).otherwise(0))
    sums = own.groupBy("mix", "label", "part").agg(F.first("budget").alias("budget"), F.sum("t").alias("t"), F.sum(F.when(F.col("won"), F.col("tokens")).otherwise(0)).alias("long")).orderBy("mix", "label", "part").collect()
    left, seen, before = {}, defaultdict(int), []
    for s in sums:
        left[s["mix"], s["label"]] = left.get((s["mix"], s["label"]), s["budget"]) - s["long"]
    for s in sums:  # a row per mix, source and the partitions it spans
        key = (s["mix"], s["label"])
        before.append((*key, s["part"], float(seen[key]), float(left[key])))
        seen[key] += s["t"]
    offsets = spark.createDataFrame(before, "mix int, label int, part long, before double, open double")
    upto = F.sum("t").over(Window.partitionBy("part", "mix", "label").orderBy("at")) + F.col("before")
    extra = (F.col("won") | ((F.col("t") > 0) & (upto - F.col("t") / 2 <= F.col("open")))).cast("int")
    drawn = own.join(F.broadcast(offsets), ["mix", "label", "part"]).withColumn("repeats", F.floor("rate") + extra).where("repeats > 0")
    names = spark.createDataFrame(list(enumerate(mixes)), "mix int, mix_id string")
    return drawn.join(F.broadcast(names), "mix").select("mix_id", "id", "label", "tokens", "repeats"), targets


def classifier_report(documents: DataFrame, table: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0) -> DataFrame:
    """(temper, documents, accuracy, log_loss, chosen) of the source classifier on held-out documents; temper 0 is the prior alone."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    made = Classifier(docs, Targets(table), Scratch(spark, "mixing"), SAMPLE, seed)
    return spark.createDataFrame([(*r, r[0] == made.temper) for r in made.held_out], "temper double, documents long, accuracy double, log_loss double, chosen boolean")


def mix_report(mixed: DataFrame, targets: Targets) -> DataFrame:
    """(mix_id, source, target_tokens, target_share, tokens, share, short, documents, max_repeats, used_repeats); documents without a source have a line of their own."""
    spark = mixed.sparkSession
    rows = [(targets.mixes[m], s, name, float(targets.want[m, s]), float(targets.want[m, s] / targets.want[m].sum()), int(targets.limit[m, s])) for (m, s), name in sorted(targets.named.items())]
    rows += [(mix_id, _FREE, None, 0.0, 0.0, None) for mix_id in targets.mixes]
    want = spark.createDataFrame(rows, "mix_id string, label int, source string, target_tokens double, target_share double, max_repeats int")
    got = mixed.groupBy("mix_id", "label").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("used_repeats"))
    total = got.groupBy("mix_id").agg(F.sum("tokens").alias("total"))
    out = F.broadcast(want).join(got, ["mix_id", "label"], "left").join(F.broadcast(total), "mix_id", "left")
    tokens = F.coalesce("tokens", F.lit(0))
    return out.select("mix_id", "source", "target_tokens", "target_share", tokens.alias("tokens"), (tokens / F.col("total")).alias("share"), (tokens < 0.98 * F.col("target_tokens")).alias("short"), F.coalesce("documents", F.lit(0)).alias("documents"), "max_repeats", F.coalesce("used_repeats", F.lit(0)).alias("used_repeats"))
