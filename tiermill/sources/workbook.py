"""Workbook scan: xlsx files to a grid of text cells.

Spark has no reader for the format, so each file is decoded inside a task from its zip
and XML parts. Rows are streamed out in batches; one sheet is never held whole.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree.ElementTree import iterparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.sources.curated_csv import NULL_TOKENS

GRID = (
    "file string, sheet string, sheet_pos int, row_idx int, cells array<string>, error string"
)
# Row index of the one row that announces a sheet, also an empty one.
SHEET_MARK = -1
_BATCH = 5000
_LETTERS = re.compile(r"[A-Z]+")


def workbook_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed workbooks as (path, content); Spark spreads the files over tasks."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx")
    return reader.load(path).select("path", "content")


def workbook_scan(files: DataFrame) -> DataFrame:
    """Decode (path, content) rows to grid rows. A file that cannot be read gives a
    single row with ``error`` set instead of failing the job."""
    return files.select("path", "content").mapInPandas(_decode, GRID)


def readable(grid: DataFrame) -> DataFrame:
    """Rows of the files that decoded to the end; a file with an error is left out whole."""
    good = grid.filter(F.col("error").isNull()).drop("error")
    return good.join(unreadable(grid).select("file").distinct(), "file", "left_anti")


def unreadable(grid: DataFrame) -> DataFrame:
    return grid.filter(F.col("error").isNotNull()).select("file", "error")


def _decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["file", "sheet", "sheet_pos", "row_idx", "cells", "error"]
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            rows: list[tuple] = []
            try:
                for row in _workbook_rows(content):
                    rows.append((path, *row, None))
                    if len(rows) >= _BATCH:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            except Exception as problem:  # any damage makes the file unreadable
                rows.append((path, None, None, None, None, f"{type(problem).__name__}: {problem}"))
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def _workbook_rows(content: bytes) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = _shared_strings(book) if "xl/sharedStrings.xml" in names else []
        for position, (sheet, part) in enumerate(_sheets(book)):
            yield sheet, position, SHEET_MARK, None
            with book.open(part) as stream:
                for index, cells in _sheet_rows(stream, shared):
                    yield sheet, position, index, cells


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _attribute(element, name: str) -> str | None:
    for key, value in element.attrib.items():
        if key.rsplit("}", 1)[-1] == name:
            return value
    return None


def _text(element) -> str:
    """Text of a string item without its phonetic hints."""
    out = []
    for child in element:
        if _tag(child) == "t":
            out.append(child.text or "")
        elif _tag(child) == "r":
            out.extend(t.text or "" for t in child if _tag(t) == "t")
    return "".join(out)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    strings = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, element in iterparse(stream):
            if _tag(element) == "si":
                strings.append(_text(element))
                element.clear()
    return strings


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Sheet names in workbook order with the part that holds each."""
    targets = {}
    with book.open("xl/_rels/workbook.xml.rels") as stream:
        for _, element in iterparse(stream):
            if _tag(element) == "Relationship":
                targets[element.get("Id")] = element.get("Target")
    found = []
    with book.open("xl/workbook.xml") as stream:
        for _, element in iterparse(stream):
            if _tag(element) == "sheet":
                target = targets[_attribute(element, "id")]
                part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
                found.append((element.get("name"), part))
    return found


def _column(reference: str | None, default: int) -> int:
    match = _LETTERS.match(reference or "")
    if match is None:
        return default
    number = 0
    for letter in match.group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _cell(element, shared: list[str]) -> str | None:
    """Text of a cell; errors and the texts for a missing value read as null."""
    kind = element.get("t")
    if kind == "inlineStr":
        value = next((_text(c) for c in element if _tag(c) == "is"), None)
    else:
        value = next((c.text for c in element if _tag(c) == "v"), None)
    if value is None or kind == "e":
        return None
    if kind == "s":
        value = shared[int(value)]
    elif kind == "b":
        value = "True" if value == "1" else "False"
    return None if value in NULL_TOKENS else value


def _sheet_rows(stream, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    """Rows by zero-based position; positions the file leaves out are simply absent."""
    position = -1
    for event, element in iterparse(stream, events=("start", "end")):
        if event == "start" and _tag(element) == "sheetData":
            parent = element
        if event == "end" and _tag(element) == "row":
            declared = element.get("r")
            position = int(declared) - 1 if declared else position + 1
            cells: list[str | None] = []
            for cell in element:
                at = _column(cell.get("r"), len(cells))
                cells.extend([None] * (at + 1 - len(cells)))
                cells[at] = _cell(cell, shared)
            yield position, cells
            parent.clear()
