"""XLSX workbooks: one task reads one file, Spark spreads the files.

Only what the dated files hold: text, numbers and dates of one sheet whose first row is
the header. A sheet has at most 1,048,576 rows, so a file is a bounded piece of work.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from vaultline.sources.delimited import header_contract

# Fixed values of the file format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
EPOCH = datetime(1899, 12, 30)
EPOCH_1904 = datetime(1904, 1, 1)
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])

ROWS_PER_BATCH = 5_000


def _root(book: zipfile.ZipFile, name: str) -> ElementTree.Element:
    return ElementTree.fromstring(book.read(name))


def _text(node: ElementTree.Element) -> str:
    """The text of a string item, without its phonetic hints."""
    parts = [node.findtext(f"{MAIN}t") or ""]
    parts += [run.findtext(f"{MAIN}t") or "" for run in node.findall(f"{MAIN}r")]
    return "".join(parts)


def _sheet_member(book: zipfile.ZipFile, sheet: str) -> tuple[str, datetime]:
    workbook = _root(book, "xl/workbook.xml")
    properties = workbook.find(f"{MAIN}workbookPr")
    from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    wanted = [node for node in workbook.iter(f"{MAIN}sheet") if node.get("name") == sheet]
    if not wanted:
        raise ValueError(f"no sheet {sheet!r}")
    targets = {node.get("Id"): node.get("Target") for node in _root(book, "xl/_rels/workbook.xml.rels")}
    target = targets[wanted[0].get(RELATION)]
    member = posixpath.normpath(posixpath.join("/xl", target)).lstrip("/")
    return member, EPOCH_1904 if from_1904 else EPOCH


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """The cell styles that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    styles = _root(book, "xl/styles.xml")
    dates = set(DATE_FORMATS)
    for node in styles.iter(f"{MAIN}numFmt"):
        code = node.get("formatCode", "").lower()
        if any(letter in code.split(";")[0] for letter in "ydh"):
            dates.add(int(node.get("numFmtId")))
    formats = styles.find(f"{MAIN}cellXfs")
    return {
        i
        for i, node in enumerate(formats if formats is not None else [])
        if int(node.get("numFmtId", 0)) in dates
    }


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - ord("A") + 1
    return number - 1


def sheet_rows(content: bytes, sheet: str) -> Iterator[list[str | None]]:
    """The rows of a sheet as text; dates as ``yyyy-MM-dd HH:mm:ss``.

    Rows below the header are skipped if no cell has a value; a zero is no value.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        member, epoch = _sheet_member(book, sheet)
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(node) for node in _root(book, "xl/sharedStrings.xml")]
        dates = _date_styles(book)
        with book.open(member) as stream:
            header = True
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{MAIN}row":
                    continue
                cells: list[str | None] = []
                filled = header
                for cell in row.findall(f"{MAIN}c"):
                    at = _column_number(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    kind, value = cell.get("t", "n"), cell.findtext(f"{MAIN}v")
                    if kind == "inlineStr":
                        value = _text(cell.find(f"{MAIN}is"))
                    elif kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind == "d" and value is not None:
                        value = str(datetime.fromisoformat(value).replace(tzinfo=None, microsecond=0))
                    zero = kind in ("n", "b") and value and float(value) == 0
                    if kind == "n" and value and int(cell.get("s", 0)) in dates:
                        moment = epoch + timedelta(seconds=round(float(value) * 86_400))
                        value, zero = moment.strftime("%Y-%m-%d %H:%M:%S"), False
                    filled = filled or (bool(value) and not zero)
                    cells[at] = value
                row.clear()
                if filled:
                    yield cells
                header = False


def workbook_rows(files: DataFrame, sheet: str, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows of the named sheet of each workbook in ``path, content``.

    ``columns`` are header names, with types if it is a mapping; all text by default. The
    job fails on a workbook without the sheet or with a column missing.
    """
    types = dict(columns) if isinstance(columns, Mapping) else dict.fromkeys(columns, "string")
    names = list(types)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = sheet_rows(content, sheet)
                header = next(rows, [])
                header_contract([name for name in header if name], names, path)
                places = [header.index(name) for name in names]
                pending: list[list[str | None]] = []
                for row in rows:
                    pending.append([row[i] if i < len(row) else None for i in places])
                    if len(pending) == ROWS_PER_BATCH:
                        yield pd.DataFrame(pending, columns=names, dtype=object)
                        pending = []
                if pending:
                    yield pd.DataFrame(pending, columns=names, dtype=object)

    text = files.select("path", "content").mapInPandas(
        read, ", ".join(f"`{name}` string" for name in names)
    )
    return text.selectExpr(
        *[f"cast(`{name}` as {kind}) as `{name}`" for name, kind in types.items()]
    )


def scan_workbook(
    spark: SparkSession, path: str, sheet: str, columns: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """One workbook, or all in a folder."""
    return workbook_rows(spark.read.format("binaryFile").load(path), sheet, columns)
