"""Joins on keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from LEAST rows, or from a MOST-th of all rows, so at most MOST keys are broadcast.
LEAST, MOST, SLICES = 10_000, 2_000, 32


def hot_keys(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Keys holding over max(LEAST, rows / MOST) rows: at most MOST of them, counted by partial aggregation."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > max(LEAST, rows // MOST)).select(*keys)


def sliced_join(many: DataFrame, few: DataFrame, keys: list[str], hot: DataFrame, spread: str, how: str = "inner") -> DataFrame:
    """``many`` joined to ``few``; rows of hot keys in ``many`` are spread over SLICES by the hash of a column, ``few`` repeated for them."""
    marked = F.broadcast(hot.distinct().withColumn("_hot", F.lit(True)))
    left = many.join(marked, keys, "left").withColumn("_slice", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SLICES))).otherwise(0).cast("int")).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(F.lit(0)))
    right = few.join(marked, keys, "left").withColumn("_slice", F.explode(every)).drop("_hot")
    return left.join(right, [*keys, "_slice"], how).drop("_slice")
