"""Problem 5: same or near-same records across splits.

Method: minwise hashes of three-character pieces in banded buckets; a bucket only pairs a record of
the training split with one of an evaluation split; candidates whose 64-bit sketches are close are
verified by exact Jaccard similarity on whole cores; confirmed pairs are counted per split and source.

The work is done on distinct cores, with copies joined to their core afterwards, so copies cost no
comparisons. Buckets holding a large share of the rows are spread over slices.

Defined cases: split names are trimmed and lower-cased, ``training`` is train, ``val``, ``valid`` and
``validation`` are dev; null or unknown splits, null ids and empty cores take no part; repeated rows
count once; cores under three characters only match equal cores; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textfn import trim_ws
from ..session import Scratch
from .dedupe_exact import hash_core
from .history import LIMIT, RECALL, SKETCH_MIN, TARGET
from .minhash import bit_sketch, signatures, tree_keys, trees_needed
from .skew import hot_keys, sliced_join
from .textform import core, likeness

ROWS_PER_BAND = 3


def clean_split(split: Column) -> Column:
    """train, dev or test; null for anything else."""
    s = F.lower(trim_ws(split))
    return F.when(s.isin("train", "training"), "train").when(s.isin("dev", "val", "valid", "validation"), "dev").when(s == "test", "test")


def _cores(batches):
    for batch in batches:
        cores = [core(t) for t in batch.column(1).to_pylist()]
        h = [hash_core(c) for c in cores]  # 128 bits stand for a core
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(h, pa.binary()), pa.array([c.encode("utf-16-le", "surrogatepass") for c in cores], pa.binary())], ["id", "split", "source", "h", "core"]).filter(pa.array([bool(c) for c in cores], pa.bool_()))


def _bands(batches, bands: int):
    n = max(64, bands * ROWS_PER_BAND)
    for batch in batches:
        cores = [c.decode("utf-16-le", "surrogatepass") for c in batch.column(1).to_pylist()]
        have, sig = signatures(cores, n)
        if not len(have):
            continue
        part = batch.take(pa.array(have))
        keys = tree_keys(sig, ROWS_PER_BAND, bands).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(have) + 1) * bands, pa.int32()), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bit_sketch(sig).view(np.int64)), part.column(2), part.column(3), lists], ["h", "sketch", "in_train", "in_eval", "keys"])


def _check(batches):
    for batch in batches:
        ok = [likeness(a.decode("utf-16-le", "surrogatepass"), b.decode("utf-16-le", "surrogatepass")) >= LIMIT for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield batch.select(["t", "e"]).filter(pa.array(ok, pa.bool_()))


def overlaps(df: DataFrame, id_col: str = "example_id", text_col: str = "sentence", split_col: str = "split", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(members: h, id, split, source; core pairs: t, e), t a core in train, e a near-same or equal one in dev or test."""
    scratch = Scratch(df.sparkSession, "overlap")
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), clean_split(F.col(split_col)).alias("split"), F.col(source_col).cast("string").alias("source")).where("id is not null and split is not null and text is not null")
    made = scratch.keep(rows.mapInArrow(_cores, f"id {kind}, split string, source string, h binary, core binary"), "rows")
    members = scratch.keep(made.select("h", "id", "split", "source").distinct(), "members")
    train = F.col("split") == "train"
    cores = scratch.keep(made.groupBy("h").agg(F.min("core").alias("core"), F.max(train).alias("in_train"), F.max(~train).alias("in_eval")), "cores")
    bands = trees_needed(TARGET, ROWS_PER_BAND, RECALL)
    signed = cores.mapInArrow(lambda it: _bands(it, bands), "h binary, sketch long, in_train boolean, in_eval boolean, keys array<long>")
    entries = scratch.keep(signed.select("h", "sketch", "in_train", "in_eval", F.explode("keys").alias("key")), "entries")
    hot = hot_keys(entries, ["key"], entries.count())
    left = entries.where("in_train").select("key", F.col("h").alias("t"), F.col("sketch").alias("st"))
    right = entries.where("in_eval").select("key", F.col("h").alias("e"), F.col("sketch").alias("se"))
    met = sliced_join(left, right, ["key"], hot, "t").where(F.bit_count(F.col("st").bitwiseXOR(F.col("se"))) <= 64 - SKETCH_MIN).where("t <> e")
    candidates = scratch.keep(met.select("t", "e").distinct(), "candidates")
    ct, ce = cores.select(F.col("h").alias("t"), F.col("core").alias("ct")), cores.select(F.col("h").alias("e"), F.col("core").alias("ce"))
    near = candidates.join(ct, "t").join(ce, "e").select("t", "e", "ct", "ce").mapInArrow(_check, "t binary, e binary")
    equal = cores.where("in_train and in_eval").select(F.col("h").alias("t"), F.col("h").alias("e"))
    return members, scratch.keep(near.unionByName(equal), "pairs")


def overlap_pairs(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id_a, id_b): every pair of records, one in train and one in dev or test, id_a < id_b."""
    hot = hot_keys(members, ["h"], members.count())
    train = members.where("split = 'train'").select(F.col("h").alias("t"), F.col("id").alias("a")).distinct()
    test = members.where("split <> 'train'").select(F.col("h").alias("e"), F.col("id").alias("b")).distinct()
    a = sliced_join(train, pairs, ["t"], hot.withColumnRenamed("h", "t"), "a")
    b = sliced_join(a, test, ["e"], hot.withColumnRenamed("h", "e"), "a")
    return b.where("a <> b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def overlap_report(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per split and source of the evaluation record: records hit and pairs, counted per core without expanding copies."""
    train = members.where("split = 'train'").groupBy(F.col("h").alias("t")).agg(F.countDistinct("id").alias("n_train"))
    test = members.where("split <> 'train'").groupBy(F.col("h").alias("e"), "split", "source").agg(F.countDistinct("id").alias("n_eval"))
    per_core = pairs.join(train, "t").groupBy("e").agg(F.sum("n_train").alias("n_train"))
    return per_core.join(test, "e").groupBy("split", "source").agg(F.sum("n_eval").alias("records"), F.sum(F.col("n_eval") * F.col("n_train")).alias("pairs"))


def overlap_classes(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, split, class_id, links): every record with a partner across the splits, the smallest id with its core, and its
    number of partners; one row per record, however many pairs there are."""
    size = members.groupBy("h").agg(F.countDistinct(F.when(F.col("split") == "train", F.col("id"))).alias("n_train"), F.countDistinct(F.when(F.col("split") != "train", F.col("id"))).alias("n_eval"), F.min("id").alias("class_id"))
    to_train = pairs.join(size.select(F.col("h").alias("t"), F.col("n_train").alias("n")), "t").groupBy(F.col("e").alias("h")).agg(F.sum("n").alias("links")).withColumn("eval", F.lit(True))
    to_eval = pairs.join(size.select(F.col("h").alias("e"), F.col("n_eval").alias("n")), "e").groupBy(F.col("t").alias("h")).agg(F.sum("n").alias("links")).withColumn("eval", F.lit(False))
    linked = to_train.unionByName(to_eval).where("links > 0").join(size.select("h", "class_id"), "h")
    every = members.select("id", "split", "h", (F.col("split") != "train").alias("eval")).distinct()
    return sliced_join(every, linked, ["h", "eval"], hot_keys(every, ["h", "eval"], every.count()), "id").select("id", "split", "class_id", "links")
