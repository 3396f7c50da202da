"""Readers and writers of review files, JSON lines and reports, with their guards."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.textfn import blank_to_null, trim_ws
from .lines import read_lines, resolve
from .xlsx import read_sheet, write_sheet

SKIPPED_DIRS = ("all", "tmp", "archive", "__pycache__")


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, required: bool = False) -> DataFrame:
    """Records with ``_source_file`` and ``_line_no``; blank lines are skipped, a bad line fails with its place; so does an empty file, if rows are ``required``."""
    if required and not os.path.getsize(resolve(path)):
        raise ValueError(f"no rows in {path}")
    lines = read_lines(spark, path).where(blank_to_null("line").isNotNull())
    parsed = lines.select("source_file", "line_no", "line", F.from_json("line", schema, {"mode": "PERMISSIVE"}).alias("r"), F.try_parse_json("line").alias("j"))
    bad = F.col("j").isNull() | ~F.trim("line").startswith("{")
    place = F.concat(F.lit("bad JSON at "), F.col("source_file"), F.lit(":"), F.col("line_no").cast("string"))
    checked = F.when(bad, F.raise_error(place).cast("string")).otherwise(F.col("source_file"))
    return parsed.select("r.*", checked.alias("_source_file"), F.col("line_no").alias("_line_no"))


def read_review(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A review table from ``.csv`` or ``.xlsx``, every value stripped text; blank or repeated headers are errors."""
    kind = Path(path).suffix.lower()
    if kind == ".xlsx":
        return read_sheet(spark, path, required=required).drop("_row_no")
    if kind != ".csv":
        raise ValueError(f"neither .csv nor .xlsx: {path}")
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"', encoding="UTF-8", enforceSchema=False)
    names = [c.removeprefix("﻿").strip() for c in raw.columns]
    with open(path, encoding="utf-8-sig", newline="") as f:
        import csv

        header = [c.strip() for c in next(csv.reader(f), [])]
    if not header or "" in header or len(set(header)) < len(header):
        raise ValueError(f"blank or repeated header in {path}: {header}")
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    out = raw.toDF(*names)
    return out.select(*[F.coalesce(trim_ws(F.col(f"`{c}`")), F.lit("")).alias(c) for c in out.columns])


def discover(root: str, suffix: str = "_encoder_pair_examples.jsonl") -> list[str]:
    """``root/<item>/<item><suffix>`` of every item, sorted; folders of other use are skipped."""
    out = []
    for d in sorted(Path(root).iterdir()):
        if d.is_dir() and d.name not in SKIPPED_DIRS and not d.name.startswith("."):
            at = d / f"{d.name}{suffix}"
            if at.is_file():
                out.append(str(at))
    return out


def prefer_xlsx(paths: list[str]) -> list[str]:
    """Of a CSV and a workbook of one name, the workbook."""
    best: dict[tuple[str, str], str] = {}
    for p in sorted(paths):
        key = (os.path.dirname(p), Path(p).stem)
        if key not in best or Path(p).suffix.lower() == ".xlsx":
            best[key] = p
    return sorted(best.values())


def guard(paths: list[str], overwrite: bool) -> None:
    """Fails if an output is there already, unless it may be overwritten."""
    there = [p for p in paths if os.path.exists(p)]
    if there and not overwrite:
        raise FileExistsError(f"already there: {there}")


def safe_dir(path: str) -> str:
    """The absolute path; the root, the home folder and the working folder are refused as output."""
    full = os.path.realpath(path)
    if full in {os.path.realpath(p) for p in ("/", os.path.expanduser("~"), ".")}:
        raise ValueError(f"not an output folder: {path}")
    return full


def non_empty(path: str, label: str) -> None:
    if not os.path.isfile(path) or not os.path.getsize(path):
        raise ValueError(f"{label} was not written: {path}")


def write_json(path: str, value: object) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2, allow_nan=False, default=str) + "\n", "utf-8")


def cells(df: DataFrame) -> DataFrame:
    """Every value as cell text: nested ones as compact JSON, null as nothing."""
    nested = lambda t: t.startswith(("array", "map", "struct"))
    return df.select(*[F.coalesce(F.to_json(F.col(f"`{c}`")) if nested(t) else F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c, t in df.dtypes])


def write_review(df: DataFrame, path: str, color_by: str | None = None) -> None:
    """``.xlsx`` as one styled sheet, ``.csv`` as one file with a byte-order mark; any other path as a folder of Parquet."""
    kind = Path(path).suffix.lower()
    if kind == ".xlsx":
        write_sheet(cells(df), path, color_by=color_by)
    elif kind == ".csv":
        import csv

        with open(path, "w", encoding="utf-8-sig", newline="") as f:
            out = csv.writer(f)
            out.writerow(df.columns)
            for row in cells(df).toLocalIterator():  # one file for people, a partition at a time
                out.writerow(list(row))
    else:
        df.write.mode("overwrite").parquet(path)


def write_detections(df: DataFrame, path: str) -> None:
    """Texts with a candidate, as JSON lines in a folder."""
    df.where(F.size("candidates") > 0).write.mode("overwrite").json(path)


def append_progress(spark: SparkSession, path: str, event: dict) -> None:
    """One row of the append-only run log."""
    spark.createDataFrame([(json.dumps(event, ensure_ascii=False, default=str),)], "event string").coalesce(1).write.mode("append").text(path)
