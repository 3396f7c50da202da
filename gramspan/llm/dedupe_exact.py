"""Problem 3: duplicates hidden by formatting differences.

Method: each record's canonical hash (128 bits of its core) goes into partition-merged Bloom
filters of once- and repeatedly-seen hashes, one pair for each range of the hash, sized by its keys
(module bloom); only records whose hash may repeat are shuffled, for exact grouping; all others leave
as singletons, their rows never shuffled. The filter has no false negatives and false alarms only
cost a shuffled row, so the result is exact; it prunes alike at every size.

Defined cases: null, empty, blank or bare-punctuation text has an empty core and is a set of its
own; rows with a null id are left out; repeated rows of an id count once (an id with differing
texts is a record per distinct core); the smallest id is kept, so ties do not arise; extra columns
are ignored; an empty table gives no rows. A hot core (any share of all rows) is counted by partial
aggregation; its members are joined back in even slices of the id's hash, so no task gathers it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from . import bloom
from .textform import core

#: A set is hot from this many members, or from a MOST_HOT-th of all rows: so at most MOST_HOT sets are broadcast.
LEAST_HOT, MOST_HOT, SLICES = 20_000, 10_000, 64


def hash_core(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _hash_batches(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        cores = [core(t) for t in texts]
        raw = np.frombuffer(b"".join(map(hash_core, cores)), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([ids, pa.array(raw[:, 0]), pa.array(raw[:, 1]), pa.array([not c for c in cores], pa.bool_())], ["id", "h1", "h2", "blank"])


def core_hashes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h1, h2, blank) of every row with an id."""
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text")).where(F.col("id").isNotNull())
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_hash_batches, f"id {kind}, h1 long, h2 long, blank boolean")


def hidden_duplicates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per record: ``kept_id`` (smallest id of its set), ``id``, ``copies`` (records in the set)."""
    sets, single = duplicate_sets(df, id_col, text_col)
    return sets.unionByName(single.select(F.col("id").alias("kept_id"), "id", F.lit(1).cast("long").alias("copies")))


def duplicate_sets(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(records whose hash may repeat, with their set's ``kept_id`` and ``copies``; ids of all other records)."""
    scratch = Scratch(df.sparkSession, "hidden_duplicates")
    hashed = core_hashes(df, id_col, text_col)
    keys = scratch.keep(hashed, "keys")
    n = keys.count()
    full = bloom.marked(scratch, "keys", keys, n).where("not blank")
    members = scratch.keep(full.where("again").select("id", "h1", "h2").distinct(), "members")
    sets = scratch.keep(members.groupBy("h1", "h2").agg(F.min("id").alias("kept_id"), F.count(F.lit(1)).alias("copies")), "sets")
    single = full.where("not again").select("id")
    blank = keys.where("blank").select("id").distinct()
    return _with_sets(members, sets, max(LEAST_HOT, n // MOST_HOT)), single.unionByName(blank)


def _with_sets(members: DataFrame, sets: DataFrame, hot: int) -> DataFrame:
    """Members joined to their set; the at most MOST_HOT sets of over ``hot`` members are joined in SLICES."""
    big = sets.where(F.col("copies") > hot)
    flag = members.join(F.broadcast(big.select("h1", "h2", F.lit(True).alias("big"))), ["h1", "h2"], "left")
    sliced = flag.withColumn("slice", F.when(F.col("big"), F.pmod(F.xxhash64("id"), F.lit(SLICES))).otherwise(0).cast("int"))
    slices = F.when(F.col("copies") > hot, F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(F.lit(0)))
    right = sets.withColumn("slice", F.explode(slices))
    return sliced.join(right, ["h1", "h2", "slice"]).select("kept_id", "id", "copies")
