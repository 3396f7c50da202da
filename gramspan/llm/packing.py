"""Problem 8: filling containers of fixed capacity, by best-two-fit.

Method: a container is filled greedily, each time with the largest item left that fits; then its
smallest item is replaced by two unpacked ones that fit the gap so widened more tightly, if there
are such. Items of equal size are interchangeable, so the unpacked items are counts by size, with
the sizes that are left as bits of one number: the largest size that fits is one bit operation.

Items are spread by the hash of their id over packing groups of some GROUP items, each packed by
one task; a group costs at most one container that is not full, whatever the input.

Defined cases: a text longer than the capacity is cut into full containers of its own and one
remainder, which is packed like any item; null and empty texts have no tokens and are not packed;
a repeated id is packed once, with its longest text; ties fall to the smaller id; null ids are left
out; extra columns are ignored; a capacity under 1 is an error; empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .tokens import VOCABULARY, count, ship

GROUP = 40_000  # items packed by one task
MOST_KINDS = 1_000  # kinds of containers


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions of ``sizes`` (1 to capacity each) by container."""
    left: dict[int, list[int]] = defaultdict(list)
    for k in range(len(sizes) - 1, -1, -1):
        left[sizes[k]].append(k)
    bits = 0
    for s in left:
        bits |= 1 << s

    def fits(room: int) -> int:
        """Largest size left of at most ``room``; 0 if none."""
        return (bits & ((2 << room) - 1)).bit_length() - 1 if room > 0 and bits & ((2 << room) - 1) else 0

    def take(size: int) -> int:
        nonlocal bits
        own = left[size]
        k = own.pop()
        if not own:
            bits ^= 1 << size
        return k

    bins = []
    while bits:
        inside: list[tuple[int, int]] = []
        room = capacity
        while s := fits(room):
            inside.append((s, take(s)))
            room -= s
        if room and bits:
            small, item = inside[-1]  # sizes fall, so the last is the smallest
            wide, best = room + small, (small, 0, 0)
            a = fits(wide - 1)
            while a and 2 * a >= best[0] and best[0] < wide:
                b = fits(min(a, wide - a))
                if b == a and len(left[a]) < 2:
                    b = fits(a - 1)
                if b and a + b > best[0]:
                    best = (a + b, a, b)
                a = fits(a - 1)
            if best[1]:
                inside[-1:] = [(best[1], take(best[1])), (best[2], take(best[2]))]
                left[small].append(item)
                bits |= 1 << small
        bins.append([k for _, k in inside])
    return bins


def sizes_of(df: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, tokens), whole texts."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count(batch.column(1).to_pylist(), vocabulary), pa.int64())], ["id", "tokens"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    return rows.mapInArrow(run, f"id {kind}, tokens long")


def pack(df: DataFrame, containers: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(container_kind, container, id, start_token, tokens): one row per item or piece; ``container`` is unique within its kind."""
    scratch = Scratch(df.sparkSession, "packing")
    ship(df.sparkSession, vocabulary)
    sizes = scratch.keep(sizes_of(df, id_col, text_col, vocabulary).groupBy("id").agg(F.max("tokens").alias("tokens")).where("tokens > 0"), "sizes")
    groups = max(1, -(-sizes.count() // GROUP))
    kinds = containers.select(F.col("container_kind").alias("kind"), F.col("capacity_tokens").cast("long").alias("capacity")).where("kind is not null and capacity is not null").distinct()
    if kinds.where("capacity < 1").limit(1).count():
        raise ValueError("a container needs a capacity of 1 token or more")
    id_kind = sizes.schema["id"].dataType.simpleString()

    def one(key, pdf):
        kind, group, capacity = key[0], int(key[1]), int(pdf["capacity"].iloc[0])
        pdf = pdf.sort_values("id", kind="stable")
        ids, tokens = pdf["id"].tolist(), pdf["tokens"].tolist()
        out, n, rest, whose = [], 0, [], []
        for i, t in zip(ids, tokens):
            full = t // capacity if t > capacity else 0
            for k in range(full):
                out.append((kind, f"{group}-{n}", i, k * capacity, capacity))
                n += 1
            if t - full * capacity:
                rest.append(t - full * capacity)
                whose.append((i, full * capacity))
        for members in best_two_fit(rest, capacity):
            out.extend((kind, f"{group}-{n}", whose[k][0], whose[k][1], rest[k]) for k in members)
            n += 1
        return pd.DataFrame(out, columns=["container_kind", "container", "id", "start_token", "tokens"])

    few = kinds.limit(MOST_KINDS + 1).collect()
    if len(few) > MOST_KINDS:
        raise ValueError(f"over {MOST_KINDS} kinds of containers, for each of which every text is packed")
    each = F.array(*[F.struct(F.lit(r["kind"]).alias("kind"), F.lit(r["capacity"]).alias("capacity")) for r in few]).cast("array<struct<kind:string,capacity:bigint>>")
    spread = sizes.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups))).withColumn("k", F.explode(each)).select("id", "tokens", "grp", "k.*")
    return spread.groupBy("kind", "grp").applyInPandas(one, f"container_kind string, container string, id {id_kind}, start_token long, tokens long")


def pack_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_kind, capacity_tokens, containers, tokens, fill): fill is the used share of all containers."""
    used = packed.groupBy("container_kind").agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    kinds = containers.select("container_kind", "capacity_tokens").distinct()
    return F.broadcast(kinds).join(used, "container_kind").withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).select("container_kind", "capacity_tokens", "containers", "tokens", "fill")
