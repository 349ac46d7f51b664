"""Worksheets: read by Spark from any path that its readers can open, and written within the format's limits."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks

#: Limits of the worksheet format (fixed values): rows with the header, characters in a cell.
MAX_ROWS, MAX_CELL = 1_048_576, 32_767
_BATCH = 5000


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _column(ref: str) -> int:
    """Position (from 0) that a reference such as AB12 names."""
    number = 0
    for letter in re.match("[A-Z]+", ref)[0]:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _texts(element) -> str:
    return "".join(x.text or "" for x in element.iter() if _tag(x) == "t")


def _sheet_path(z: zipfile.ZipFile, sheet: str | int) -> str:
    sheets = [x for x in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if _tag(x) == "sheet"]
    found = sheets[sheet] if isinstance(sheet, int) and sheet < len(sheets) else next((s for s in sheets if s.get("name") == sheet), None)
    if found is None:
        raise ValueError(f"no sheet {sheet!r}; there are {[s.get('name') for s in sheets]}")
    link = next(v for k, v in found.attrib.items() if k.endswith("}id"))
    target = next(r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")) if r.get("Id") == link)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def rows_of(data: bytes, sheet: str | int = 0):
    """(row number from 1, cells as text or None) of a sheet's rows, parsed as a stream."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as f:
                for _, element in ElementTree.iterparse(f):
                    if _tag(element) == "si":
                        shared.append(_texts(element))
                        element.clear()
        with z.open(_sheet_path(z, sheet)) as f:
            number = 0
            for _, element in ElementTree.iterparse(f):
                if _tag(element) != "row":
                    continue
                number = int(element.get("r") or number + 1)
                cells: list[str | None] = []
                for cell in element:
                    at = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (at - len(cells))
                    kind = cell.get("t")
                    value = next((x.text for x in cell if _tag(x) == "v"), None)
                    if kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind == "inlineStr":
                        value = _texts(cell)
                    elif kind == "b" and value is not None:
                        value = "TRUE" if value == "1" else "FALSE"
                    cells.append(value)
                yield number, cells
                element.clear()


def read_workbook(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """All columns as text under the first row's headers, with FILA_EXCEL (the row's number in its sheet).

    path may name many files: each is one task's work (a sheet holds MAX_ROWS rows at most); all must have the
    first one's headers. Empty headers become COL_<n>; empty rows are left out.
    """

    def parse(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = []
                for row in rows_of(data, sheet):
                    held.append((name, *row))
                    if len(held) == _BATCH:
                        yield _rows_batch(held)
                        held = []
                if held:
                    yield _rows_batch(held)

    cells = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, "path string, FILA_EXCEL bigint, cells array<string>")
    heads = cells.groupBy("path").agg(F.min_by("cells", "FILA_EXCEL").alias("cells")).select("cells").distinct().limit(2).collect()
    if not heads:
        raise ValueError(f"no rows in {path}")
    if len(heads) > 1:
        raise ValueError("the files differ in their headers")
    header, seen = [], set()
    for i, h in enumerate(heads[0]["cells"]):
        name = (h or "").strip() or f"COL_{i + 1}"
        if name in seen:
            raise ValueError(f"the header {name!r} stands twice")
        seen.add(name)
        header.append(name)
    first = cells.groupBy("path").agg(F.min("FILA_EXCEL").alias("first"))
    body = cells.join(F.broadcast(first), "path").filter(F.col("FILA_EXCEL") > F.col("first")).filter(F.exists("cells", lambda x: x.isNotNull() & (x != "")))
    return body.select(*[F.get("cells", F.lit(i)).alias(h) for i, h in enumerate(header)], "FILA_EXCEL")


def _rows_batch(held) -> pa.RecordBatch:
    names, numbers, cells = zip(*held)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int64()), pa.array(cells, pa.list_(pa.string()))], ["path", "FILA_EXCEL", "cells"])


#: The parts of a workbook besides its sheets (fixed formats).
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_KIND = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def _letters(i: int) -> str:
    found = ""
    while i >= 0:
        found, i = chr(65 + i % 26) + found, i // 26 - 1
    return found


def _xml_row(number: int, values) -> str:
    cells = "".join(f'<c r="{_letters(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for i, v in enumerate(values) if v is not None)
    return f'<row r="{number}">{cells}</row>'


def write_sheets(target, sheets: dict[str, tuple[list[str], object]]) -> None:
    """Writes name -> (headers, rows of texts) as a workbook; rows are taken as a stream."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_KIND}.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{_KIND}.sheet.main+xml"/>{over}</Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n[:31], {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_RELS}"><sheets>{listed}</sheets></workbook>')
        linked = "".join(f'<Relationship Id="rId{i}" Type="{_RELS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">{linked}</Relationships>')
        for i, (headers, rows) in enumerate(sheets.values(), 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                f.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{_xml_row(1, headers)}'.encode())
                for number, row in enumerate(rows, 2):
                    f.write(_xml_row(number, row).encode("utf-8"))
                f.write(b"</sheetData></worksheet>")


def write_workbook(tables: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Each table as a sheet of one local workbook, or, beyond the format's limits, as CSV.gz beside it with a LEEME sheet that says so.

    Returns table -> "sheet" or the CSV folder. Sheets pass through the driver row by row; their number is checked first.
    """
    sheets, placed, notes = {}, {}, []
    for name, df in tables.items():
        text = df.select(*[sinks.neutralise(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])
        longest = F.greatest(F.lit(0), *[F.coalesce(F.max(F.length(f"`{c}`")), F.lit(0)) for c in df.columns])
        size = text.agg(F.count(F.lit(1)).alias("n"), longest.alias("longest")).first()
        if size["n"] >= MAX_ROWS or size["longest"] > MAX_CELL:
            placed[name] = f"{path}.{name}.csv.gz"
            text.write.mode("overwrite").option("header", True).option("compression", "gzip").option("lineSep", "\n").option("escape", '"').csv(placed[name])
            notes.append((name, str(size["n"]), placed[name]))
        else:
            placed[name] = "sheet"
            sheets[name] = (df.columns, (tuple(r) for r in text.toLocalIterator()))
    if notes:
        sheets["LEEME"] = (["tabla", "filas", "archivo"], notes)
    write_sheets(path, sheets)
    return placed
