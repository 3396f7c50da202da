"""Numbers within groups of any size: no group is sorted or counted in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str = "n") -> DataFrame:
    """``df`` with ``name``, 1 to the group's size in the given order, within groups of equal ``by``.

    Rows are range-partitioned by group and order and written; each partition numbers its own, on top of the group's
    rows in the partitions before. A group may span any number of partitions; a row per group and partition is joined back.
    """
    keys = {f"_k{i}": k for i, k in enumerate(order)}
    wide = df.withColumns(keys)
    placed = wide.repartitionByRange(*by, *keys).sortWithinPartitions(*by, *keys).withColumn("_at", F.monotonically_increasing_id()).drop(*keys)
    kept = Scratch(df.sparkSession, "numbered").keep(placed, "rows").withColumn("_part", F.shiftright("_at", 33))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_n")  # a row per group and partition
    before = kept.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", upto)
    before = before.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], F.col("_part").alias("_p"), "_before")
    on = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    own = F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_at"))
    return kept.withColumn("_own", own).join(before, on).withColumn(name, F.col("_own") + F.col("_before")).select(*df.columns, name)
