"""Realtime detection over a stream of texts: stateless, with the same compiled columns as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bundle import Bundle
from ..operators.detect import Options, detect, each


def stream_texts(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(kind).load(folder)


def realtime(stream: DataFrame, bundle: Bundle, unit_ids: list[str], text_col: str = "raw_text") -> DataFrame:
    """One row per candidate as it comes; candidates without component spans stay hidden, as do analysis fields."""
    found = detect(stream, bundle, unit_ids, text_col=text_col, options=Options(realtime=True), only_hits=True)
    keys = [c for c in stream.columns if c != text_col]
    return each(found, *keys).select(*keys, "c.unit_id", "c.span_key", "c.span_text", "c.span_source")


def counts_per_window(found: DataFrame, time_col: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Candidates per unit and time window, with late rows admitted up to ``late``."""
    return found.withWatermark(time_col, late).groupBy(F.window(time_col, window), "unit_id").agg(F.count(F.lit(1)).alias("n"))
