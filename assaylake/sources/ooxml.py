"""Word and Excel files and archives from their bytes, with the standard library only.

Files come as (path, content) rows, as spark.read.format("binaryFile") gives them; each file is one
row and is opened by itself, so a broken file becomes an issue row instead of a failed job.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: What an archive may hold before it is set apart.
MAX_MEMBERS, MAX_BYTES, MAX_RATIO = 2000, 512 << 20, 200

CELL_SCHEMA = "path string, table_no int, row int, column int, text string, span int, origin_row int, origin_column int, inherited boolean, issue string"


def cell_text(cell: ElementTree.Element) -> str:
    return "\n".join("".join(t.text or "" for t in p.iter(f"{WORD}t")) for p in cell.iter(f"{WORD}p"))


def attribute(node: ElementTree.Element | None, default: str) -> str | None:
    return None if node is None else node.get(f"{WORD}val", default)


def grid(table: ElementTree.Element) -> list[tuple]:
    """(row, column, text, span, origin_row, origin_column, inherited, issue) for each grid place of a Word table.

    A continued vertical merge takes its text from the cell above only if that one starts in the same column with the same span
    and the continued cell is empty or repeats it; else the place has an issue and no text.
    """
    out: list[tuple] = []
    above: dict[int, tuple] = {}  # column -> (origin row, origin column, span, text)
    width = len(table.findall(f"./{WORD}tblGrid/{WORD}gridCol"))
    for r, line in enumerate(table.findall(f"./{WORD}tr")):
        column = int(attribute(line.find(f"./{WORD}trPr/{WORD}gridBefore"), "0") or 0)
        here: dict[int, tuple] = {}
        for cell in line.findall(f"./{WORD}tc"):
            properties = f"./{WORD}tcPr/{WORD}"
            span = max(1, int(attribute(cell.find(f"{properties}gridSpan"), "1") or 1))
            mode = attribute(cell.find(f"{properties}vMerge"), "continue")
            text, issue, inherited = cell_text(cell), None, False
            origin = (r, column, span, text)
            if mode == "continue":
                prior = above.get(column)
                if prior is None or prior[1:3] != (column, span) or (text.strip() and text != prior[3]):
                    issue = "INVALID_VERTICAL_MERGE"
                else:
                    origin, inherited = prior, True
            elif mode not in (None, "restart"):
                issue = "UNKNOWN_VERTICAL_MERGE_MODE"
            for c in range(column, column + span):
                out.append((r, c, None if issue else origin[3], span, None if issue else origin[0], None if issue else origin[1], inherited, issue))
            if mode is not None and issue is None:
                here[column] = origin
            column += span
        column += int(attribute(line.find(f"./{WORD}trPr/{WORD}gridAfter"), "0") or 0)
        if width and column != width:
            out.append((r, column, None, 0, None, None, False, "GRID_WIDTH_MISMATCH"))
        above = here
    return out


def docx_cells(files: DataFrame) -> DataFrame:
    """Grid places of all tables of Word files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        tree = ElementTree.fromstring(z.read("word/document.xml"))
                except Exception as error:  # noqa: BLE001  a broken file is a row, not a failed job
                    rows.append((path, None, None, None, None, None, None, None, None, f"UNREADABLE:{type(error).__name__}"))
                    continue
                for n, table in enumerate(tree.iter(f"{WORD}tbl"), 1):
                    rows += [(path, n, *place) for place in grid(table)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in CELL_SCHEMA.split(", ")]).astype(object)

    return files.select("path", "content").mapInPandas(run, CELL_SCHEMA)


def docx_blocks(files: DataFrame) -> DataFrame:
    """(path, ordinal, kind, text): paragraphs outside tables, tables, figures in document order."""

    def blocks(content: bytes) -> list[tuple[str, str]]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{WORD}body")
        out = []
        for node in body if body is not None else ():
            if node.tag == f"{WORD}tbl":
                out.append(("table", "\n".join(cell_text(c) for c in node.iter(f"{WORD}tc"))))
            elif node.tag == f"{WORD}p":
                if any(x.tag.endswith("}drawing") or x.tag.endswith("}pict") for x in node.iter()):
                    out.append(("figure", ""))
                if text := "".join(t.text or "" for t in node.iter(f"{WORD}t")):
                    out.append(("text", text))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows += [(path, i, k, t) for i, (k, t) in enumerate(blocks(content))]
                except Exception as error:  # noqa: BLE001
                    rows.append((path, -1, "issue", f"UNREADABLE:{type(error).__name__}"))
            yield pd.DataFrame(rows, columns=["path", "ordinal", "kind", "text"])

    return files.select("path", "content").mapInPandas(run, "path string, ordinal long, kind string, text string")


def workbook_cells(content: bytes) -> Iterator[tuple[str, str, str]]:
    """(sheet, reference, value) of every filled cell of an Excel file, with its cached value."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{SHEET}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")]
        targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{SHEET}sheet"):
            target = targets[sheet.get(RELATION)].lstrip("/")
            for cell in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{SHEET}c"):
                value = cell.find(f"{SHEET}v")
                inline = cell.find(f"{SHEET}is")
                if inline is not None:
                    yield sheet.get("name", ""), cell.get("r", ""), "".join(t.text or "" for t in inline.iter(f"{SHEET}t"))
                elif value is not None and value.text is not None:
                    yield sheet.get("name", ""), cell.get("r", ""), shared[int(value.text)] if cell.get("t") == "s" else value.text


def xlsx_cells(files: DataFrame) -> DataFrame:
    """(path, sheet, reference, value, issue)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows += [(path, *c, None) for c in workbook_cells(content)]
                except Exception as error:  # noqa: BLE001
                    rows.append((path, None, None, None, f"UNREADABLE:{type(error).__name__}"))
            yield pd.DataFrame(rows, columns=["path", "sheet", "reference", "value", "issue"])

    return files.select("path", "content").mapInPandas(run, "path string, sheet string, reference string, value string, issue string")


def archive_defects(content: bytes) -> list[str]:
    """Names of what makes an archive unsafe, in order; empty for a safe one."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            members = z.infolist()
    except zipfile.BadZipFile:
        return ["NOT_AN_ARCHIVE"]
    names = [m.filename.replace("\\", "/") for m in members]
    found = {
        "TOO_MANY_MEMBERS": len(members) > MAX_MEMBERS,
        "PATH_TRAVERSAL": any(n.startswith("/") or ".." in n.split("/") or n[1:2] == ":" for n in names),
        "DUPLICATE_MEMBER": len({n.casefold() for n in names}) != len(names),
        "ENCRYPTED_MEMBER": any(m.flag_bits & 1 for m in members),
        "COMPRESSION_RATIO": any(m.file_size > MAX_RATIO * max(1, m.compress_size) for m in members),
        "TOTAL_SIZE": sum(m.file_size for m in members) > MAX_BYTES,
    }
    return [k for k, bad in found.items() if bad]


def archive_safety(files: DataFrame) -> DataFrame:
    """(path, status, defects): SAFE or QUARANTINED."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [archive_defects(c) for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], "status": ["QUARANTINED" if f else "SAFE" for f in found], "defects": [",".join(f) for f in found]})

    return files.select("path", "content").mapInPandas(run, "path string, status string, defects string")


class OneFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WorkbookReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[OneFile]:
        return [OneFile(p) for p in self.paths]

    def read(self, partition: OneFile) -> Iterator[tuple]:
        with open(partition.path, "rb") as f:
            content = f.read()
        for sheet, reference, value in workbook_cells(content):
            yield partition.path, sheet, reference, value


class WorkbookSource(DataSource):
    """spark.read.format("workbook").load(paths): cells of Excel files on a path that all executors can open; else use `xlsx_cells`."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return "path string, sheet string, reference string, value string"

    def reader(self, schema) -> WorkbookReader:
        import json

        paths = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        return WorkbookReader(paths)


CHART = "{http://schemas.openxmlformats.org/drawingml/2006/chart}"


def chart_points(content: bytes) -> Iterator[tuple[str, int, str | None, float | None, float | None, float | None]]:
    """(series, place, category, value, minus, plus) of the cached values of a native chart part."""
    for series in ElementTree.fromstring(content).iter(f"{CHART}ser"):
        name = "".join(v.text or "" for v in series.iterfind(f"{CHART}tx//{CHART}v"))

        def cached(tag: str, series: ElementTree.Element = series) -> dict[int, str]:
            node = series.find(tag)
            return {} if node is None else {int(p.get("idx", "0")): v.text or "" for p in node.iter(f"{CHART}pt") for v in p.iterfind(f"{CHART}v")}

        category = cached(f"{CHART}cat") or cached(f"{CHART}xVal")
        value = cached(f"{CHART}val") or cached(f"{CHART}yVal")
        minus, plus = cached(f"{CHART}errBars/{CHART}minus"), cached(f"{CHART}errBars/{CHART}plus")
        number = lambda d, i: float(d[i]) if d.get(i) else None
        for i in sorted(value):
            yield name, i, category.get(i), number(value, i), number(minus, i), number(plus, i)


def native_charts(files: DataFrame) -> DataFrame:
    """(path, part, series, place, category, value, minus, plus, issue) of all chart parts of Word and Excel files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for part in sorted(n for n in z.namelist() if "/charts/chart" in n and n.endswith(".xml")):
                            rows += [(path, part, *p, None) for p in chart_points(z.read(part))]
                except Exception as error:  # noqa: BLE001
                    rows.append((path, None, None, None, None, None, None, None, f"UNREADABLE:{type(error).__name__}"))
            yield pd.DataFrame(rows, columns=["path", "part", "series", "place", "category", "value", "minus", "plus", "issue"]).astype(object)

    return files.select("path", "content").mapInPandas(run, "path string, part string, series string, place long, category string, value double, minus double, plus double, issue string")
