"""Deterministic corpus sampling: hash ranks, batches, shards and their reports.

A record's rank within its domain is its place by hash; a batch or shard is a slice of ranks. All
batches and shards of a corpus come from one ranking pass: no rescan per shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textfn import blank_to_null, trim_ws
from .ranking import numbered

HEADER_WORDS = ("sentence", "form", "text", "raw_text", "source")


def is_header(line: Column, delimiter: str) -> Column:
    parts = F.transform(F.split(F.lower(line), F.lit(f"\\Q{delimiter}\\E")), lambda p: trim_ws(p))
    return F.arrays_overlap(parts, F.array(*[F.lit(w) for w in HEADER_WORDS]))


def parse_line(line: Column, delimiter: str) -> Column:
    """struct(status, text, source): the line cut at its last delimiter; status valid, empty or parse_error."""
    tail = F.substring_index(line, delimiter, -1)
    cut = F.length(line) - F.length(tail) - len(delimiter)
    text, source = trim_ws(F.substring(line, F.lit(1), cut)), trim_ws(tail)
    status = F.when((F.length(trim_ws(line)) == 0) | ~F.contains(line, F.lit(delimiter)), "parse_error").when(text == "", "empty").otherwise("valid")
    return F.struct(status.alias("status"), F.when(status != "parse_error", text).alias("text"), F.when(status != "parse_error", source).alias("source"))


def record_hash(seed: int, domain: Column, file: Column, line_no: Column, text: Column) -> Column:
    """Hex digest; of fixed width, so its order as text is its order as a number."""
    return F.sha2(F.concat_ws("\t", F.lit(str(seed)), domain, file, line_no.cast("string"), text), 256)


def ranked(lines: DataFrame, seed: int, domain: str = "corpus_domain", file: str = "source_file", line_no: str = "source_line_no", text: str = "raw_text") -> DataFrame:
    """Valid lines with ``sample_hash`` and 0-based ``sample_rank`` in their domain."""
    hashed = lines.withColumn("sample_hash", record_hash(seed, F.col(domain), F.col(file), F.col(line_no), F.col(text)))
    return numbered(hashed, [domain], [F.col("sample_hash"), F.col(line_no)], "sample_rank").withColumn("sample_rank", F.col("sample_rank") - 1)


def text_id(domain: Column, batch: Column, place: Column) -> Column:
    return F.format_string("%s_b%03d_%06d", domain, batch.cast("int"), place.cast("int"))


def slice_ranks(lines: DataFrame, plan: DataFrame, seed: int, **columns: str) -> DataFrame:
    """Records of every plan row (domain, batch_index, rank_start, requested) with their text ids.

    One ranking serves all plan rows; ranks that no row reaches are left out before the join with the (small) plan.
    """
    domain = columns.get("domain", "corpus_domain")
    reach = plan.groupBy(F.col("domain").alias(domain)).agg(F.max(F.col("rank_start") + F.col("requested")).alias("_reach"))
    kept = ranked(lines, seed, **columns).join(F.broadcast(reach), domain).where("sample_rank < _reach").drop("_reach")
    on = (kept[domain] == plan["domain"]) & (kept["sample_rank"] >= plan["rank_start"]) & (kept["sample_rank"] < plan["rank_start"] + plan["requested"])
    hit = kept.join(F.broadcast(plan), on).drop("domain")
    place = F.col("sample_rank") - F.col("rank_start") + 1
    return hit.withColumn("place", place).withColumn("text_id", text_id(F.col(domain), F.col("batch_index"), place)).drop("rank_start", "requested")


def prepare(lines: DataFrame, manifest: DataFrame, batch_index: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(records, report) of one batch of every manifest row (batch_id_prefix, sampling): ranks from batch_index times the quota on.

    All manifests share one ranking; the report has what each wanted of each domain and got.
    """
    wants = manifest.select("batch_id_prefix", F.explode("sampling").alias("d", "requested")).select("batch_id_prefix", F.lower(trim_ws("d")).alias("domain"), F.col("requested").cast("long").alias("requested")).where("requested > 0")
    plan = wants.groupBy("batch_id_prefix", "domain").agg(F.sum("requested").alias("requested")).withColumn("rank_start", F.col("requested") * batch_index)  # a row per manifest and domain
    kept = ranked(lines, seed)
    on = (kept["corpus_domain"] == plan["domain"]) & (kept["sample_rank"] >= plan["rank_start"]) & (kept["sample_rank"] < plan["rank_start"] + plan["requested"])
    records = kept.join(F.broadcast(plan), on).withColumn("batch_id", F.format_string("%s_batch_%03d", "batch_id_prefix", F.lit(batch_index))).withColumn("place", F.col("sample_rank") - F.col("rank_start") + 1)
    got = records.groupBy("batch_id_prefix", "domain").agg(F.count(F.lit(1)).alias("n_selected"), F.min("sample_hash").alias("hash_min"), F.max("sample_hash").alias("hash_max"))
    report = F.broadcast(plan).join(got, ["batch_id_prefix", "domain"], "left").select("batch_id_prefix", "domain", "rank_start", "requested", F.coalesce("n_selected", F.lit(0)).alias("n_selected"), "hash_min", "hash_max")
    return records.drop("domain", "rank_start", "requested"), report


def domain_report(parsed: DataFrame, domain: str = "corpus_domain") -> DataFrame:
    """Lines seen, valid, empty and unparsable per domain."""
    count = lambda s: F.count_if(F.col("status") == s).alias(f"n_{s}")
    return parsed.groupBy(domain).agg(F.count(F.lit(1)).alias("n_seen"), count("valid"), count("empty"), count("parse_error"))


def selection_report(selected: DataFrame, requested: DataFrame, domain: str = "corpus_domain") -> DataFrame:
    """Per domain: requested and selected records, smallest and largest hash, whether it fell short."""
    got = selected.groupBy(domain).agg(F.count(F.lit(1)).alias("n_selected"), F.min("sample_hash").alias("hash_min"), F.max("sample_hash").alias("hash_max"))
    want = requested.select(F.col("domain").alias(domain), "requested")
    n = F.coalesce("n_selected", F.lit(0))
    return F.broadcast(want).join(got, domain, "left").select(domain, "requested", n.alias("n_selected"), "hash_min", "hash_max", (n < F.col("requested")).alias("short"))


@dataclass(frozen=True)
class Schedule:
    schedule_id: str
    start: int
    end: int | None
    sampling: dict[str, int]
    offsets: dict[str, int] = field(default_factory=dict)


def pick_schedule(schedules: list[Schedule], batch: int) -> Schedule | None:
    """The schedule whose range holds the batch; the latest start wins, and of equal ones the later entry."""
    fit = [(s.start, k, s) for k, s in enumerate(schedules) if s.start <= batch and (s.end is None or batch <= s.end)]
    return max(fit)[2] if fit else None


def batch_plan(schedules: list[Schedule], batch: int, default: dict[str, int] | None = None) -> list[tuple[str, int, int, int]]:
    """(domain, batch_index, rank_start, requested) of one batch."""
    s = pick_schedule(schedules, batch)
    if s is None:
        if default is None:
            raise ValueError(f"no schedule for batch {batch}")
        return [(d, batch, batch * n, n) for d, n in default.items()]
    return [(d, batch, s.offsets.get(d, 0) + (batch - s.start) * n, n) for d, n in s.sampling.items()]


def schedule_lookup(manifests: DataFrame, batches: DataFrame) -> DataFrame:
    """(batch_id_prefix, batch_index, schedule_id) for every manifest and batch: the latest start at or before the batch.

    A range join on two small tables, with the schedules broadcast.
    """
    rows = manifests.select("batch_id_prefix", F.posexplode("sampling_schedules").alias("k", "s")).select("batch_id_prefix", "k", "s.schedule_id", "s.start_batch_index", "s.end_batch_index")
    hit = batches.join(F.broadcast(rows), (F.col("start_batch_index") <= F.col("batch_index")) & (F.coalesce("end_batch_index", F.lit(1 << 30)) >= F.col("batch_index")))
    return hit.groupBy("batch_id_prefix", "batch_index").agg(F.max_by("schedule_id", F.struct("start_batch_index", "k")).alias("schedule_id"))


@dataclass
class ShardState:
    """Cursor of each domain, and the domains found exhausted."""

    cursor: dict[str, int]
    exhausted: set[str]


def shard_plan(valid: dict[str, int], quota: dict[str, int], backfill: str, shards: int) -> list[tuple[str, int, int, int, int]]:
    """(domain, shard, rank_start, requested, selected) until all is used up or ``shards`` are planned.

    A domain is found exhausted in the shard in which it gives less than asked; from the next one on
    its quota goes to the backfill domain, unless that is exhausted too, which ends the run.
    """
    state, out = ShardState(dict.fromkeys(quota, 0), set()), []
    for shard in range(shards):
        spare = sum(n for d, n in quota.items() if d in state.exhausted and d != backfill)
        for d, n in quota.items():
            want = 0 if d in state.exhausted else n + (spare if d == backfill else 0)
            got = min(want, max(0, valid.get(d, 0) - state.cursor[d]))
            out.append((d, shard, state.cursor[d], want, got))
            state.cursor[d] += got
            if got < want:
                state.exhausted.add(d)
        if backfill in state.exhausted or len(state.exhausted) == len(quota):
            break
    return out


def clean_domain(domain: Column) -> Column:
    return F.coalesce(F.lower(blank_to_null(domain)), F.lit("unknown"))
