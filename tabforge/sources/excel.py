"""Excel workbooks (.xlsx) without a spreadsheet library.

A workbook is cut into its sheets, still packed, and a sheet is the unit of work: sheets are spread over tasks and each is
parsed as a stream of XML events inside ``mapInPandas`` (``zipfile`` and ``iterparse`` of the standard library); rows
leave in small batches. A task unpacks the shared strings of a workbook once for the sheets it gets in a row. Numbers, shared and inline strings and
booleans are read as text; numbers whose cell style has a date or time format become ISO dates and times by the
workbook's epoch.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import partitions_for
from .folder import files_of, relative_path

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "p": "http://schemas.openxmlformats.org/package/2006/relationships"}
SHEET_SCHEMA = "path STRING, sheet_name STRING, sheet_pos BIGINT, sheet BINARY, shared BINARY, dates ARRAY<STRING>, mac BOOLEAN, failed BOOLEAN"
OUT_SCHEMA = "path STRING, sheet_name STRING, sheet_pos BIGINT, row_number BIGINT, header ARRAY<STRING>, cells ARRAY<STRING>, failed BOOLEAN"
BATCH_ROWS = 5000


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _tag(name: str) -> str:
    return f"{{{NS['m']}}}{name}"


_HEAD = struct.Struct("<HI")  # how a part is packed, checksum


def _packed(z: zipfile.ZipFile, name: str) -> bytes:
    """A part of the archive as it is stored, so that it can be unpacked elsewhere."""
    info = z.getinfo(name)
    if info.flag_bits & 1 or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"{name} is encrypted or packed in an unknown way")
    z.fp.seek(info.header_offset)
    local = z.fp.read(30)  # the lengths of the name and of the extra field end the fixed part of a local header
    z.fp.seek(sum(struct.unpack("<HH", local[26:30])), io.SEEK_CUR)
    return _HEAD.pack(info.compress_type, info.CRC) + z.fp.read(info.compress_size)


class _Unpacked(io.RawIOBase):
    """Reads a packed part in pieces; a wrong checksum or a part cut short is an error at its end."""

    def __init__(self, packed: bytes):
        kind, self.crc = _HEAD.unpack_from(packed)
        self.data, self.at, self.sum = memoryview(packed), _HEAD.size, 0
        self.inflate = zlib.decompressobj(-15) if kind == zipfile.ZIP_DEFLATED else None

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        n, got = len(out), b""
        while not got:
            if self.inflate is None:
                got, self.at = bytes(self.data[self.at:self.at + n]), self.at + n
            else:
                rest = self.inflate.unconsumed_tail
                if not rest:
                    rest, self.at = self.data[self.at:self.at + n], self.at + n
                got = self.inflate.decompress(rest, n)
                if not got and len(rest) and not self.inflate.eof:
                    continue
                if not got and not self.inflate.eof:
                    raise zipfile.BadZipFile("a part ends early")
            if not got:
                if self.sum != self.crc:
                    raise zipfile.BadZipFile("wrong checksum")
                return 0
        self.sum = zlib.crc32(got, self.sum)
        out[:len(got)] = got
        return len(got)


def _open(packed: bytes) -> io.BufferedReader:
    return io.BufferedReader(_Unpacked(packed), 1 << 16)


def _shared_strings(packed: bytes | None) -> list[str]:
    out = []
    if packed is not None:
        for _, si in ET.iterparse(_open(packed)):
            if si.tag == _tag("si"):
                out.append("".join(t.text or "" for t in si.iter(_tag("t"))))
                si.clear()
    return out


# fixed values: numbers of the built-in formats for dates and times
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _date_styles(z: zipfile.ZipFile) -> set[str]:
    """Indices of cell styles whose number format shows a date or a time."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    styles = ET.fromstring(z.read("xl/styles.xml"))
    own = {f.get("numFmtId"): re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", f.get("formatCode", "").lower()).split(";")[0]
           for f in styles.iter(_tag("numFmt"))}
    xfs = styles.find("m:cellXfs", NS)
    ids = [x.get("numFmtId", "0") for x in (xfs.findall("m:xf", NS) if xfs is not None else [])]
    return {str(i) for i, n in enumerate(ids) if (re.search("[ymdhs]", own[n]) and "general" not in own[n] if n in own else int(n) in DATE_FORMATS)}


def _moment(serial: str, epoch: datetime) -> str:
    """A serial number of days as date, date and time, or (below one day) time."""
    days = float(serial)
    if epoch.year == 1899 and 1 <= days < 60:  # the calendar of this epoch has a 29 February 1900
        days += 1
    at = epoch + timedelta(seconds=round(days * 86400))
    return at.strftime("%H:%M:%S") if 0 <= days < 1 else at.strftime("%Y-%m-%d" if at.time() == datetime.min.time() else "%Y-%m-%d %H:%M:%S")


class Book:
    """What the cells of a workbook refer to."""

    def __init__(self, shared: list[str], dates: Sequence[str], mac: bool):
        self.shared, self.dates = shared, set(dates)
        self.epoch = datetime(1904, 1, 1) if mac else datetime(1899, 12, 30)


def _text(cell, book: Book) -> str | None:
    kind, v = cell.get("t"), cell.find("m:v", NS)
    if kind == "inlineStr":
        return "".join(x.text or "" for x in cell.iter(_tag("t")))
    if v is None or v.text is None:
        return None
    if kind in (None, "n") and cell.get("s") in book.dates:
        return _moment(v.text, book.epoch)
    return book.shared[int(v.text)] if kind == "s" else ("True" if v.text == "1" else "False") if kind == "b" else v.text


def _rows(sheet: bytes, book: Book) -> Iterator[dict[int, str | None]]:
    """The rows of a packed sheet as cells by their column number; a cell without a place stands right of the one before it."""
    with _open(sheet) as f:
        for _, row in ET.iterparse(f):
            if row.tag == _tag("row"):
                out, at = {}, -1
                for c in row.findall("m:c", NS):
                    at = _col_index(c.get("r")) if c.get("r") else at + 1
                    out[at] = _text(c, book)
                yield out
                row.clear()


def workbook_sheets(data: bytes, sheets: Sequence[str | int] | None = (0,)) -> Iterator[tuple]:
    """(sheet name, position, packed sheet, packed shared strings, styles of dates, epoch of 1904) of the chosen sheets (None = all)."""
    z = zipfile.ZipFile(io.BytesIO(data))
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    props = wb.find("m:workbookPr", NS)
    mac = props is not None and props.get("date1904") in ("1", "true")
    shared = _packed(z, "xl/sharedStrings.xml") if "xl/sharedStrings.xml" in z.namelist() else None
    dates = sorted(_date_styles(z))
    rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")).findall("p:Relationship", NS)}
    for at, entry in enumerate(wb.find("m:sheets", NS).findall("m:sheet", NS)):
        name, target = entry.get("name"), rels[entry.get(f"{{{NS['r']}}}id")].lstrip("/")
        if sheets is None or at in sheets or name in sheets:
            yield name, at, _packed(z, target if target.startswith("xl/") else "xl/" + target), shared, dates, mac


def parse_sheet(sheet: bytes, book: Book) -> Iterator[tuple[int, list, list | None]]:
    """Yield (data row number, header, cells) of a packed sheet; without data it is one row -1 without cells.

    A sheet is as wide as its widest row: columns without a header cell are named ``Unnamed: n``."""
    first, width = {}, 0
    for n, cells in enumerate(_rows(sheet, book)):
        if not n:
            first = cells
        width = max(width, max((i for i, v in cells.items() if v or not n), default=-1) + 1)
    header = [first.get(i) or f"Unnamed: {i}" for i in range(width)]
    n = 0
    for cells in islice(_rows(sheet, book), 1, None):
        if any(v is not None for v in cells.values()):
            yield n, header, [cells.get(i) for i in range(width)]
            n += 1
    if not n:
        yield -1, header, None


def parse_workbook(data: bytes, sheets: Sequence[str | int] | None = (0,)) -> Iterator[tuple[str, int, int, list, list | None]]:
    """Yield (sheet name, sheet position, *row of :func:`parse_sheet`) for the chosen sheets of one workbook in memory."""
    for name, at, sheet, shared, dates, mac in workbook_sheets(data, sheets):
        for row in parse_sheet(sheet, Book(_shared_strings(shared), dates, mac)):
            yield name, at, *row


def _cut(sheets: Sequence[str | int] | None):
    names = ["path", "sheet_name", "sheet_pos", "sheet", "shared", "dates", "mac", "failed"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    for row in workbook_sheets(bytes(content), sheets):
                        yield pd.DataFrame([(path, *row, False)], columns=names)
                except Exception:  # whatever a damaged workbook raises, it fails alone
                    yield pd.DataFrame([(path, None, None, None, None, None, None, True)], columns=names)
    return run


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["path", "sheet_name", "sheet_pos", "row_number", "header", "cells", "failed"]
    last, book = None, None
    for b in batches:
        for path, name, at, sheet, shared, dates, mac, failed in b.itertuples(index=False):
            out = []
            try:
                if failed:
                    raise ValueError("not a workbook")
                if path != last:
                    last, book = path, Book(_shared_strings(shared), dates, mac)
                for row in parse_sheet(sheet, book):
                    out.append((path, name, at, *row, False))
                    if len(out) == BATCH_ROWS:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            except Exception:  # one bad sheet fails its workbook, and only that
                last = None
                out.append((path, None, None, None, None, None, True))
            if out:
                yield pd.DataFrame(out, columns=names)


def read_excel_folder(spark: SparkSession, root: str, sheets: Sequence[str | int] | None = (0,),
                      recursive: bool = True) -> DataFrame:
    """The rows of every chosen sheet of every .xlsx under ``root``; an unreadable workbook is one row or more with
    ``failed``. Packed sheets are spread over tasks, in order of path within each."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
             .option("pathGlobFilter", "*.[xX][lL][sS][xX]").load(root))
    cut = files.select("path", "content").mapInPandas(_cut(sheets), SHEET_SCHEMA)
    spread = cut.repartition(partitions_for(files), "path", "sheet_pos").sortWithinPartitions("path", "sheet_pos")
    rows, listed = spread.mapInPandas(_parse, OUT_SCHEMA), files_of(spark, root, "xlsx", recursive)
    if listed is None:
        return rows
    # a scan leaves out files without bytes; listed paths are URIs
    empty = listed.join(files.select(F.col("_metadata.file_path").alias("path")), "path", "left_anti")
    empty = empty.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"), F.lit(True).alias("failed"))
    return rows.unionByName(empty, allowMissingColumns=True)


def excel_cells(rows: DataFrame, root_uri: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of :func:`read_excel_folder` -> (cells, headers) in the form of the CSV scan, a sheet being a split, and status rows."""
    named = rows.withColumn("source_file", relative_path(F.col("path"), root_uri)).withColumn("layout", F.xxhash64("header"))
    cells = named.where("cells IS NOT NULL").select("source_file", "sheet_name", F.col("sheet_pos").alias("blk"), F.col("row_number").alias("mid"), "layout", "cells", "failed")
    headers = named.where("header IS NOT NULL").groupBy("source_file", "sheet_name", "layout").agg(F.first("header").alias("header"))
    return cells, headers, named.select("source_file", "failed", F.col("cells").isNotNull().cast("long").alias("rows"))
