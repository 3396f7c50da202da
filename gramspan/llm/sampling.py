"""Problem 6: samples that match target category proportions.

Method: systematic unequal-probability sampling. Members are put in random order within sorted
categories; inclusion probabilities (target / members, at most 1) are prefix-summed across the
range partitions; the members at which the running sum crosses random start + integer are drawn.
All samples share one ordered population; each has its own start. Categories left under their
floor are then repaired from their first undrawn members. Where that takes a sample beyond its total,
categories above their floor give back their last drawn, in proportion to what each has over it.

Defined cases: category names are trimmed and lower-cased, null or blank names are no category;
members repeat once per category however many rows they have; null ids are left out; a member
of several categories may be drawn for each; a target beyond what a category has takes all of it
and is reported; ties of the random order fall to the smaller id; an empty population gives an
empty sample and a report of shortfalls. Only wants (a few rows per sample) and per-partition,
per-category counts reach the driver; a category of any size spans as many partitions as it needs.
"""

from __future__ import annotations

import math
import random
from collections import defaultdict
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.textfn import WS
from ..session import Scratch

MOST_WANTS = 100_000  # rows of wants that may reach the driver


@dataclass(frozen=True)
class Want:
    """Target of one category in one sample: ``target`` members behind the first ``offset``, ``floor`` at least."""

    sample: tuple[str, ...]
    category: str
    target: float
    offset: int = 0
    floor: int = 0


def clean_name(name: Column) -> Column:
    """Trimmed and lower-cased; null for a blank name."""
    ws = f"[{WS}]+"
    return F.nullif(F.lower(F.regexp_replace(name, f"^{ws}|{ws}$", "")), F.lit(""))


class Population:
    """Members in random order within sorted categories, over range partitions; written once."""

    def __init__(self, df: DataFrame, id_col: str, category_col: str, seed: int = 0):
        self.spark, self.scratch = df.sparkSession, Scratch(df.sparkSession, "population")
        members = df.select(clean_name(F.col(category_col)).alias("category"), F.col(id_col).alias("id")).where("category is not null and id is not null").distinct()
        members = self.scratch.keep(members, "members")
        mixed = members.withColumn("mix", F.xxhash64(F.lit(seed), "id"))
        ordered = mixed.repartitionByRange("category", "mix", "id").sortWithinPartitions("category", "mix", "id")
        # The id is partition << 33 | place: it keeps the order once the table is written.
        self.ordered = self.scratch.keep(ordered.select("category", "id", F.monotonically_increasing_id().alias("at")), "ordered")
        part = F.shiftright("at", 33)
        self.parts = self.ordered.groupBy(part.alias("part"), "category").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).orderBy("category", "part").collect()
        self.sizes: dict[str, int] = defaultdict(int)
        self.before = []  # (part, category, at of its first member here, members of the category in earlier parts)
        for p in self.parts:
            self.before.append((p["part"], p["category"], p["first"], self.sizes[p["category"]]))
            self.sizes[p["category"]] += p["n"]

    def ranked(self) -> DataFrame:
        """(category, id, rank): 0-based place within the category."""
        table = self.spark.createDataFrame(self.before or [(0, "", 0, 0)], "part long, category string, first long, before long")
        at = self.ordered.withColumn("part", F.shiftright("at", 33))
        return at.join(F.broadcast(table), ["part", "category"]).select("category", "id", (F.col("at") - F.col("first") + F.col("before")).alias("rank"))


@dataclass(frozen=True)
class Line:
    """One category of one sample, worked out: what the report has and the draw needs."""

    want: Want
    available: int
    eligible: int
    before: float  # sum of inclusion probabilities of earlier categories
    after: float
    start: float
    drawn: int
    repaired: int
    removed: int = 0

    @property
    def n(self) -> int:
        return self.drawn + self.repaired - self.removed


def plan(wants: list[Want], sizes: dict[str, int], seed: int = 0) -> list[Line]:
    if len(wants) > MOST_WANTS:
        raise ValueError(f"{len(wants)} wants; at most {MOST_WANTS} are worked out on the driver")
    by_sample: dict[tuple[str, ...], list[Want]] = defaultdict(list)
    for w in wants:
        by_sample[w.sample].append(w)
    lines = []
    for sample, own in sorted(by_sample.items()):
        start, total, made = random.Random(f"{seed}|{'|'.join(sample)}").random(), 0.0, []
        for w in sorted(own, key=lambda w: (w.category, w.offset)):
            available = sizes.get(w.category, 0)
            eligible = max(0, available - w.offset)
            after = total + min(float(w.target), eligible)
            drawn = math.floor(after - start) - math.floor(total - start)
            repaired = max(0, min(w.floor, eligible) - drawn)
            made.append(Line(w, available, eligible, total, after, start, drawn, repaired))
            total = after
        over = [x.drawn - min(x.want.floor, x.eligible) if not x.repaired else 0 for x in made]
        beyond = sum(x.drawn + x.repaired for x in made) - math.ceil(sum(max(0.0, x.want.target) for x in made))
        lines += [replace(x, removed=k) for x, k in zip(made, given_back(max(0, min(beyond, sum(x.repaired for x in made))), over))]
    return lines


def given_back(n: int, over: list[int]) -> list[int]:
    """``n``, or all there is, taken from ``over`` in whole numbers in proportion, the largest remainders first."""
    whole = sum(x for x in over if x > 0)
    n = min(n, whole)
    exact = [n * max(0, x) / whole if whole else 0.0 for x in over]
    out = [math.floor(x) for x in exact]
    for k in sorted(range(len(over)), key=lambda k: (out[k] - exact[k], k))[: n - sum(out)]:
        out[k] += 1
    return out


def draw(population: Population, lines: list[Line], names: list[str]) -> DataFrame:
    """(*names of the sample key, category, id) of every member drawn."""
    rows = [(*x.want.sample, x.want.category, x.want.offset, x.eligible, x.before, x.after, x.start, x.repaired, x.drawn - x.removed) for x in lines if x.eligible and x.n]
    kind = ", ".join(f"{n} string" for n in names) + ", category string, skip long, eligible long, s0 double, s1 double, start double, repaired long, kept long"
    table = population.spark.createDataFrame(rows, kind)
    at = population.ranked().join(F.broadcast(table), "category").withColumn("r", F.col("rank") - F.col("skip")).where("r >= 0")
    step = (F.col("s1") - F.col("s0")) / F.col("eligible")
    upto = lambda r: F.when(r == 0, F.col("s0")).when(r == F.col("eligible"), F.col("s1")).otherwise(F.col("s0") + r * step)
    crossed = lambda r: F.floor(upto(r) - F.col("start"))
    taken = at.withColumn("c0", crossed(F.col("r"))).withColumn("c1", crossed(F.col("r") + 1))
    first = F.floor(F.col("s0") - F.col("start"))
    drawn = (F.col("c1") > F.col("c0")) & (F.col("c1") - first <= F.col("kept"))
    return taken.where(drawn | (F.col("r") - (F.col("c0") - first) < F.col("repaired"))).select(*names, "category", "id")


def report(spark: SparkSession, lines: list[Line], names: list[str]) -> DataFrame:
    """One row per category of each sample: what was wanted, there, drawn, repaired, and whether it fell short."""
    rows = []
    totals: dict[tuple[str, ...], list[float]] = defaultdict(lambda: [0.0, 0.0])
    for x in lines:
        totals[x.want.sample][0] += x.want.target
        totals[x.want.sample][1] += x.n
    for x in lines:
        wanted, got = totals[x.want.sample]
        n = x.n
        rows.append((*x.want.sample, x.want.category, float(x.want.target), x.want.offset, x.want.floor, x.available, n, x.repaired, x.removed, bool(x.available < x.want.target + x.want.offset), bool(n < x.want.floor), x.want.target / wanted if wanted else None, n / got if got else None))
    kind = ", ".join(f"{n} string" for n in names) + ", category string, target double, skip long, floor long, available long, drawn long, repaired long, removed long, short boolean, under_floor boolean, target_share double, share double"
    return spark.createDataFrame(rows, kind)


def manifest_wants(manifests: DataFrame, minimums: DataFrame | None) -> list[Want]:
    """Wants of each manifest's base sampling and of each schedule; floors from ``minimums`` hold for the base.

    Names are cleaned on all sides; null counts and offsets are 0, a null schedule has no wants. Entries
    of one map whose names clean to the same are added up.
    """
    base = manifests.select("batch_id_prefix", F.lit("base").alias("schedule_id"), F.col("sampling").alias("want"), F.lit(None).cast("map<string,int>").alias("skip"))
    each = manifests.select("batch_id_prefix", F.explode("sampling_schedules").alias("s")).select("batch_id_prefix", "s.schedule_id", F.col("s.sampling").alias("want"), F.col("s.rank_start_offsets").alias("skip"))
    both = base.unionByName(each)
    flat = both.select("batch_id_prefix", "schedule_id", F.explode("want").alias("name", "n")).select("batch_id_prefix", "schedule_id", clean_name(F.col("name")).alias("category"), F.coalesce("n", F.lit(0)).alias("n")).where("category is not null")
    skips = both.select("batch_id_prefix", "schedule_id", F.explode("skip").alias("name", "o")).select("batch_id_prefix", "schedule_id", clean_name(F.col("name")).alias("category"), F.coalesce("o", F.lit(0)).alias("o"))
    keys = ["batch_id_prefix", "schedule_id", "category"]
    rows = flat.groupBy(*keys).agg(F.sum("n").alias("n")).join(skips.groupBy(*keys).agg(F.max("o").alias("o")), keys, "left").limit(MOST_WANTS + 1).collect()
    floors = {}
    if minimums is not None:
        least = minimums.select("batch_id_prefix", clean_name(F.col("corpus_domain")).alias("category"), "min_texts").where("category is not null").limit(MOST_WANTS + 1).collect()
        for r in least:
            key = (r["batch_id_prefix"], r["category"])
            floors[key] = max(floors.get(key, 0), r["min_texts"] or 0)
    wants = [Want((r["batch_id_prefix"], r["schedule_id"]), r["category"], r["n"], r["o"] or 0, floors.get((r["batch_id_prefix"], r["category"]), 0) if r["schedule_id"] == "base" else 0) for r in rows]
    had = {(w.sample[0], w.category) for w in wants if w.sample[1] == "base"}
    return wants + [Want((prefix, "base"), category, 0, 0, n) for (prefix, category), n in floors.items() if (prefix, category) not in had]
