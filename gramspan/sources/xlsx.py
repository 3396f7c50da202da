"""Workbooks as a Spark data source: format ``gramspan_xlsx``, with only the standard library.

Reading: options ``path``, ``sheet`` (the first if not given); every cell comes as stripped text in a
map-free row ``(_row_no, cells)`` which ``read_sheet`` turns into named columns. Writing:
``write_sheet`` makes one styled sheet; the driver writes it a few rows at a time. A table of more
rows than a sheet holds goes on in further sheets, which a name of the first lists and which are
read as one with it; their row numbers count on from a multiple of 2^20.
"""

from __future__ import annotations

import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import Scratch

MOST_ROWS = 1_000_000  # rows of a sheet; more go on in a further one
AT_ONCE, CHARS = 20_000, 16_000_000  # rows, and characters, that the driver takes at a time
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_MORE = "goes_on_in"  # defined name of a sheet: the sheets that go on with it
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_BAD = re.compile(r"[^\x09\x0a\x0d\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")  # what XML can't hold
FILLS = {"tp": "C6EFCE", "fp": "FFC7CE", "unclear": "FFEB9C", "header": "D9E1F2"}


def column_number(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def column_name(k: int) -> str:
    out, k = "", k + 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


def sheet_parts(path: str, sheet: str | None = None) -> list[str]:
    """Names of the sheet (the first if not given) and of those that go on with it."""
    with zipfile.ZipFile(path) as z:
        book = ET.fromstring(z.read("xl/workbook.xml"))
    names = [s.get("name") for s in book.find("m:sheets", _NS)]
    if sheet is not None and sheet not in names:
        raise ValueError(f"no sheet {sheet!r} in {path}")
    at = names.index(sheet) if sheet is not None else 0
    more = [d.text or "" for d in book.iterfind("m:definedNames/m:definedName", _NS) if d.get("name") == _MORE and d.get("localSheetId") == str(at)]
    return [names[at], *[x.replace("''", "'") for text in more for x in re.findall(r"'((?:[^']|'')+)'!", text)]]


def sheet_rows(path: str, sheet: str | None = None) -> Iterator[tuple[int, list[str]]]:
    """(row number, cells as stripped text) of every row of one sheet that is not blank."""
    with zipfile.ZipFile(path) as z:
        book, rels = ET.fromstring(z.read("xl/workbook.xml")), ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in rels}
        sheets = {s.get("name"): targets[s.get(_REL)] for s in book.find("m:sheets", _NS)}
        if sheet is not None and sheet not in sheets:
            raise ValueError(f"no sheet {sheet!r} in {path}")
        target = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))]
        data = None
        with z.open("xl/" + target.lstrip("/").removeprefix("xl/")) as f:
            for event, row in ET.iterparse(f, ("start", "end")):
                if event == "start":
                    data = row if row.tag == f"{{{_NS['m']}}}sheetData" else data
                    continue
                if row.tag != f"{{{_NS['m']}}}row":
                    continue
                cells: dict[int, str] = {}
                for k, c in enumerate(row):
                    kind, value = c.get("t"), c.find("m:v", _NS)
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
                    else:
                        text = (value.text or "") if value is not None else ""
                        text = shared[int(text)] if kind == "s" and text else {"1": "True", "0": "False"}.get(text, text) if kind == "b" else text
                    cells[column_number(c.get("r")) if c.get("r") else k] = text.strip()
                if any(cells.values()):
                    yield int(row.get("r") or 0), [cells.get(k, "") for k in range(max(cells) + 1)]
                data.clear()  # rows that were read are held no longer


@dataclass
class SheetPart(InputPartition):
    path: str
    sheet: str
    k: int


class SheetReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.sheet = options["path"], options.get("sheet")

    def partitions(self) -> list[InputPartition]:
        return [SheetPart(p, name, k) for p in self.path.split(";") for k, name in enumerate(sheet_parts(p, self.sheet))]

    def read(self, part: SheetPart) -> Iterator[tuple]:
        rows = sheet_rows(part.path, part.sheet)
        if part.k and (top := next(rows, (0, []))[1]) != next(sheet_rows(part.path, sheet_parts(part.path, self.sheet)[0]), (0, []))[1]:
            raise ValueError(f"{part.path}: sheet {part.sheet!r} goes on under another header: {top}")
        for n, cells in rows:
            yield part.path, (part.k << 20) + n, cells


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gramspan_xlsx"

    def schema(self) -> str:
        return "_source_file string, _row_no long, cells array<string>"

    def reader(self, schema) -> SheetReader:  # noqa: ANN001
        return SheetReader(self.options)


def header_of(path: str, sheet: str | None = None) -> list[str]:
    """Header cells without trailing blanks; a blank or repeated name is an error."""
    names = next((cells for _, cells in sheet_rows(path, sheet)), [])
    while names and not names[-1]:
        names.pop()
    if not names or "" in names or len(set(names)) < len(names):
        raise ValueError(f"blank or repeated header in {path}: {names}")
    return names


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """The sheet's columns as text, with ``_row_no``."""
    names = header_of(path, sheet)
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    spark.dataSource.register(SheetSource)
    reader = spark.read.format("gramspan_xlsx").option("path", path)
    raw = (reader.option("sheet", sheet) if sheet is not None else reader).load()
    top = next(n for n, _ in sheet_rows(path, sheet))
    return raw.where(F.col("_row_no") > top).select("_row_no", *[F.coalesce(F.get("cells", F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)])


def write_sheet(df: DataFrame, path: str, sheet: str = "Sheet1", color_by: str | None = None) -> None:
    """One sheet with a filled header, frozen first row, widths, and rows filled by the value of ``color_by``."""
    write_book({sheet: df}, path, color_by)


def _kept(df: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, int]:
    """The rows in their order, in partitions that the driver can take one at a time, and their number."""
    named = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    named = named.withColumns({c: F.col(c).cast("string") for c, t in named.dtypes if t == "void"})
    rows = scratch.keep(named.withColumn("at", F.monotonically_increasing_id()), name)
    chars = sum([F.coalesce(F.length(c), F.lit(0)) for c, t in rows.dtypes if t == "string"], F.lit(0))
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(chars), F.lit(0))).first()
    return rows.repartitionByRange(1 + max(n // AT_ONCE, size // CHARS), "at").sortWithinPartitions("at").drop("at"), n


def _write_rows(z: zipfile.ZipFile, names: list[str], columns: list[str], rows: Iterator, color_by: str | None, main: str) -> None:
    """The next rows, as many as a sheet holds, as one part of the file for each of ``names``."""
    style = {k: i + 1 for i, k in enumerate(FILLS)}
    by = columns.index(color_by) if color_by else 0
    letters = [column_name(k) for k in range(len(columns))]
    cell = lambda k, n, v, s: f'<c r="{letters[k]}{n}" t="inlineStr" s="{s}"><is><t xml:space="preserve">{escape(_BAD.sub("", v))}</t></is></c>'
    widths = "".join(f'<col min="{k + 1}" max="{k + 1}" width="{min(60, max(10, len(c) + 4))}" customWidth="1"/>' for k, c in enumerate(columns))
    for name in names:
        with z.open(name, "w", force_zip64=True) as f:
            f.write(f'{_XML}<worksheet {main}><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{widths}</cols><sheetData><row r="1">{"".join(cell(k, 1, c, style["header"]) for k, c in enumerate(columns))}</row>'.encode())
            for n, r in enumerate(islice(rows, MOST_ROWS), 2):
                s = style.get(str(r[by]), 0) if color_by else 0
                f.write(f'<row r="{n}">{"".join(cell(k, n, "" if v is None else str(v), s) for k, v in enumerate(r))}</row>'.encode())
            f.write(b"</sheetData></worksheet>")


def _further(name: str, k: int, taken: set[str]) -> str:
    """A name, not taken yet and with a blank in it, of the sheet that is the ``k``-th of a table."""
    while (found := f"{name[: 30 - len(str(k))]} {k}").lower() in taken:
        k += 1
    taken.add(found.lower())
    return found


def write_book(sheets: dict[str, DataFrame], path: str, color_by: str | None = None) -> None:
    """A workbook of several sheets, each as ``write_sheet`` makes it."""
    scratch = Scratch(next(iter(sheets.values())).sparkSession, "sheets")
    kept = [_kept(df, scratch, f"s{k}") for k, df in enumerate(sheets.values())]
    taken, names, goes_on, of_table = {name.lower() for name in sheets}, [], [], []
    for name, (_, n) in zip(sheets, kept):
        own = [name, *[_further(name, k, taken) for k in range(2, 1 + -(-n // MOST_ROWS))]]
        of_table.append(range(len(names) + 1, len(names) + len(own) + 1))
        if own[1:]:
            refs = ",".join("'" + x.replace("'", "''") + "'!$A$1" for x in own[1:])
            goes_on.append(f'<definedName name="{_MORE}" localSheetId="{len(names)}" hidden="1">{escape(refs)}</definedName>')
        names += own
    fills = ["", "", *FILLS.values()]
    main, ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', "http://schemas.openxmlformats.org"
    solid = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="FF{f}"/></patternFill></fill>' for f in fills[2:])
    xfs = "".join(f'<xf fillId="{k + 2}" applyFill="1"/>' for k in range(len(FILLS)))
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    of = [f"sheet{k + 1}" for k in range(len(names))]
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{ns}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{"".join(f'<Override PartName="/xl/worksheets/{x}.xml" ContentType="{kind}.worksheet+xml"/>' for x in of)}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{ns}/package/2006/relationships"><Relationship Id="rId1" Type="{ns}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook {main} xmlns:r="{ns}/officeDocument/2006/relationships"><sheets>{"".join(f'<sheet name="{escape(name)}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, name in enumerate(names))}</sheets>{f"<definedNames>{''.join(goes_on)}</definedNames>" if goes_on else ""}</workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{ns}/package/2006/relationships">{"".join(f'<Relationship Id="rId{k + 1}" Type="{ns}/officeDocument/2006/relationships/worksheet" Target="worksheets/{x}.xml"/>' for k, x in enumerate(of))}<Relationship Id="rId{len(of) + 1}" Type="{ns}/officeDocument/2006/relationships/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {main}><fonts count="1"><font/></fonts><fills count="{len(FILLS) + 2}"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{solid}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{len(FILLS) + 1}"><xf/>{xfs}</cellXfs></styleSheet>',
    }
    made = f"{path}.{uuid.uuid4().hex[:8]}"
    try:
        with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in parts.items():
                z.writestr(name, _XML + text)
            for ks, df, (rows, _) in zip(of_table, sheets.values(), kept):
                _write_rows(z, [f"xl/worksheets/sheet{k}.xml" for k in ks], df.columns, rows.toLocalIterator(), color_by, main)
        os.replace(made, path)
    finally:
        if os.path.exists(made):
            os.remove(made)
    scratch.drop()
