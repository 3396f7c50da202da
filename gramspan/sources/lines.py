"""Line-numbered text as a Spark data source: format ``gramspan_lines``.

Options: ``path`` (a file, a glob or several separated by ``;``), ``encoding``, ``splitBytes``. A file is
cut into byte ranges by its size, so a file of any size is read by many tasks and none is read to plan;
lines are numbered within their range, and ``read_lines`` adds what the ranges before it hold.
"""

from __future__ import annotations

import glob
import os
import unicodedata
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.sampling import is_header, parse_line

SPLIT = 64 << 20


def resolve(path: str) -> str:
    """The path, or one beside it whose name is the same text in another Unicode form."""
    if os.path.exists(path):
        return path
    folder, name = os.path.split(path)
    for form in ("NFC", "NFD"):
        for other in sorted(os.listdir(folder or ".")):
            if unicodedata.normalize(form, other) == unicodedata.normalize(form, name):
                return os.path.join(folder, other)
    raise FileNotFoundError(path)


class Range(InputPartition):
    def __init__(self, path: str, place: int, start: int, end: int):
        self.path, self.place, self.start, self.end = path, place, start, end


def sizes(paths: str) -> dict[str, int]:
    """Bytes of each file that a path, a glob or several of them name."""
    found = [p for part in paths.split(";") for p in (sorted(glob.glob(part)) or [resolve(part)])]
    return {p: os.path.getsize(p) for p in found}


class LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.sizes = sizes(options["path"])
        self.encoding, self.split = options.get("encoding", "utf-8-sig"), int(options.get("splitbytes", SPLIT))

    def partitions(self) -> list[Range]:
        """Byte ranges by size alone; a line belongs to the range that it begins in."""
        return [Range(path, k, at, min(size, at + self.split)) for path, size in self.sizes.items() for k, at in enumerate(range(0, size, self.split))]

    def read(self, part: Range) -> Iterator[tuple]:
        name = unicodedata.normalize("NFC", os.path.basename(part.path))
        codec = "utf-8" if self.encoding.lower().replace("_", "-") in ("utf-8-sig", "utf8-sig") else self.encoding
        with open(part.path, "rb") as f:
            at, n = part.start, 1
            if at:
                f.seek(at - 1)
                at += len(f.readline()) - 1
            while at < part.end:
                raw = f.readline()
                at += len(raw)
                text = raw.decode(codec, "replace").rstrip("\r\n")
                yield name, part.path, part.place, n, text.removeprefix("﻿") if n == 1 and not part.place else text
                n += 1


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gramspan_lines"

    def schema(self) -> str:
        return "source_file string, path string, part int, line_no long, line string"

    def reader(self, schema) -> LineReader:  # noqa: ANN001
        return LineReader(self.options)


def read_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(source_file, line_no, line). Where a file has several ranges, their lines are counted by a job and added up, a row per range."""
    spark.dataSource.register(LineSource)
    lines = spark.read.format("gramspan_lines").options(path=path, **options).load()
    split = int(options.get("splitBytes", SPLIT))
    if max(sizes(path).values(), default=0) > split:
        upto = F.sum("n").over(Window.partitionBy("path").orderBy("part")) - F.col("n")
        before = lines.groupBy("path", "part").agg(F.count(F.lit(1)).alias("n")).select("path", "part", upto.alias("before"))
        lines = lines.join(before, ["path", "part"]).withColumn("line_no", F.col("line_no") + F.col("before"))
    return lines.select("source_file", "line_no", "line")


def read_corpus(spark: SparkSession, path: str, domain: str, delimiter: str = ";", encoding: str = "utf-8-sig", split_bytes: int = SPLIT) -> DataFrame:
    """(corpus_domain, source_file, source_row_index, source_line_no, status, raw_text, source) of a delimited corpus.

    A header is told by its words and left out; it makes row numbers start at the second line.
    """
    lines = read_lines(spark, path, encoding=encoding, splitBytes=str(split_bytes))
    first = lines.where("line_no = 1").select("source_file", is_header(F.col("line"), delimiter).cast("int").alias("header"))
    rows = lines.join(F.broadcast(first), "source_file").where("line_no > header")  # a row per file
    cut = rows.withColumn("p", parse_line(F.col("line"), delimiter))
    return cut.select(F.lit(domain).alias("corpus_domain"), "source_file", (F.col("line_no") - F.col("header")).alias("source_row_index"), F.col("line_no").alias("source_line_no"), "p.status", F.col("p.text").alias("raw_text"), F.col("p.source").alias("source"))
