"""Workbooks (zipped spreadsheet XML) and archives as DataFrames, read from bytes inside tasks."""

from __future__ import annotations

import io
import re
import struct
import zipfile
from functools import cache
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import legacy

MAX_ROWS, MAX_COLS = 20_000, 80
GRID = "file string, sheet_no int, sheet string, row_no int, cells array<string>, error string, size int"
_REF = re.compile(r"([A-Z]+)(\d+)")
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_T = _NS + "t"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def file_kind(content: Column) -> Column:
    """By the first bytes, whatever the name says."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(head.startswith("504B"), "zip").when(head == "D0CF11E0", "ole").when(F.length(content) == 0, "empty").otherwise("other")


def zip_problem(content: bytes) -> str | None:
    """Why an archive can't be read, or null."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            if not z.namelist():
                return "empty"
            bad = z.testzip()
            return f"damaged {bad}" if bad else None
    except (zipfile.BadZipFile, OSError, RuntimeError) as e:
        return str(e)[:80]


def is_complete(content: Column) -> Column:
    """Whether the end-of-directory mark stands in the last 64 KiB."""
    tail = F.hex(F.substring(content, F.greatest(F.length(content) - 65_557, F.lit(0)) + 1, F.lit(65_600)))
    return (F.hex(F.substring(content, 1, 2)) == "504B") & (F.instr(tail, "504B0506") > 0)


def members(content: bytes) -> list[tuple[str, bytes]]:
    """Workbooks inside an archive; hidden ones are skipped, names that recur are numbered."""
    out, seen = [], {}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for n in z.namelist():
            base = n.rsplit("/", 1)[-1]
            if not base or base.startswith((".", "~")) or "__" in n.split("/")[0] or not re.search(r"\.xls[xmb]?$", base, re.I):
                continue
            k = seen[base] = seen.get(base, 0) + 1
            out.append((base if k == 1 else re.sub(r"(\.\w+)$", rf"_{k}\1", base), z.read(n)))
    return out


def _text(x) -> str:
    return "".join(t.text or "" for t in x.iter(_NS + "t"))


def _inline(c) -> str:
    """``_text`` of a cell, at once where it holds one text."""
    if len(c) == 1 and len(c[0]) == 1 and c[0][0].tag == _T and not len(c[0][0]) and c[0].tag != _T:
        return c[0][0].text or ""
    return _text(c)


@cache
def _place(letters: str) -> int:
    col = 0
    for ch in letters:
        col = col * 26 + ord(ch) - 64
    return col - 1


def sheets(content: bytes, max_rows: int = MAX_ROWS, max_cols: int = MAX_COLS) -> list[tuple[str, list[list[str]]]]:
    """(sheet, rows of cell texts) of a workbook: values only, whole numbers without a fraction."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_NS + "sheet"):
            target = rels[s.get(_REL)].lstrip("/")
            rows = []
            for r in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(_NS + "row"):
                at = int(r.get("r") or len(rows) + 1)
                if at > max_rows:
                    break
                while len(rows) < at:
                    rows.append([])
                line = rows[at - 1]
                for c in r.iter(_NS + "c"):
                    m = _REF.match(c.get("r") or "")
                    col = _place(m.group(1)) if m else len(line)
                    if col >= max_cols:
                        continue
                    kind = c.get("t")
                    if kind == "inlineStr":
                        cell = _inline(c)
                    else:
                        v = c.find(_NS + "v")
                        raw = v.text or "" if v is not None else ""
                        cell = shared[int(raw)] if kind == "s" and raw else re.sub(r"\.0+$", "", raw) if "." in raw else raw
                    line.extend([""] * (col + 1 - len(line)))
                    line[col] = cell
            out.append((s.get("name"), rows))
    return out


def any_sheets(content: bytes) -> list[tuple[str, list[list[str]]]]:
    """Sheets of a workbook of either kind, by its first bytes, whatever its name says."""
    return legacy.sheets(content, MAX_ROWS, MAX_COLS) if content[:8] == legacy.MAGIC else sheets(content)


_UNREADABLE = (zipfile.BadZipFile, KeyError, ElementTree.ParseError, OSError, ValueError, struct.error)


def _told(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:200]


def _books(path: str, content: bytes) -> list[tuple[str, bytes]]:
    """(file, content) of a workbook, or of an archive's members."""
    if content[:8] != legacy.MAGIC:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            if "xl/workbook.xml" not in z.namelist():
                return [(f"{path}!{n}", c) for n, c in members(content)]
    return [(path, content)]


def _grids(batches):
    for b in batches:
        for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
            cols = {k.split()[0]: [] for k in GRID.split(", ")}
            try:
                for name, raw in _books(path, content):
                    for k, (sheet, rows) in enumerate(any_sheets(raw)):
                        for i, cells in enumerate(rows):
                            for c, v in zip(cols.values(), (name, k, sheet, i, cells, None, len(raw))):
                                c.append(v)
            except _UNREADABLE as e:
                for c, v in zip(cols.values(), (path, None, None, None, None, _told(e), len(content))):
                    c.append(v)
            yield pa.RecordBatch.from_pydict(cols, pa.schema([("file", pa.string()), ("sheet_no", pa.int32()), ("sheet", pa.string()), ("row_no", pa.int32()), ("cells", pa.list_(pa.string())), ("error", pa.string()), ("size", pa.int32())]))


def problems(batches):
    """(path, reason) of files (path, content, reason) that have a reason, no content, or can't be read."""
    for b in batches:
        out = []
        for path, content, reason in zip(*(b.column(c).to_pylist() for c in ("path", "content", "reason"))):
            if reason is None and content is None:
                reason = "it has no content"
            elif reason is None:
                try:
                    for _, raw in _books(path, content):
                        any_sheets(raw)
                except _UNREADABLE as e:
                    reason = _told(e)
            if reason is not None:
                out.append((path, reason))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in (0, 1)], names=["path", "reason"])


def grids(files: DataFrame) -> DataFrame:
    """All cells of files (path, content), members of archives as ``path!member``; a file that can't be read gives its reason in ``error``."""
    return files.select("path", "content").mapInArrow(_grids, GRID)


def read(spark: SparkSession, path: str, glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """(grid of all cells, files that couldn't be read with the reason)."""
    every = grids(spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path))
    return every.where("error is null").drop("error", "size"), every.where("error is not null").select("file", "error")


_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{types}</Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{sheets}</sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>',
}


@cache
def _column(i: int) -> str:
    return (_column(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)


def book_bytes(sheets: list[tuple[str, list[list]]]) -> bytes:
    """A workbook of (name, rows): numbers as values, everything else as inline text, empty cells left out."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        numbered = [(i, escape(n, {'"': "&quot;"})) for i, (n, _) in enumerate(sheets, 1)]
        fill = {
            "types": "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i, _ in numbered),
            "sheets": "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in numbered),
            "rels": "".join(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in numbered),
        }
        for name, part in _PARTS.items():
            for k, v in fill.items():
                part = part.replace(f"{{{k}}}", v)
            z.writestr(name, part)
        for i, (_, rows) in enumerate(sheets, 1):
            lines = []
            for r, row in enumerate(rows, 1):
                cells = [(f"{_column(c)}{r}", v) for c, v in enumerate(row) if v is not None and v != ""]
                lines.append(f'<row r="{r}">' + "".join(f'<c r="{at}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>' for at, v in cells) + "</row>")
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    return out.getvalue()


def archive_bytes(files: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in files:
            z.writestr(name, content)
    return out.getvalue()
