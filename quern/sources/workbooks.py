"""Workbooks (.xlsx) to pages of Markdown, one sheet a page, with the standard library only."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import ship

MAX_ROWS, MAX_COLS, MAX_CELL = 300, 40, 200
PAGES = "doc_name string, source_path string, num_pages int, backend string, page_number int, text string, sheet_title string, error string"

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_letter(n: int) -> str:
    """1 is A, 26 is Z, 27 is AA."""
    out = ""
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def cell_text(v: object, longest: int = MAX_CELL) -> str:
    s = "" if v is None else ("TRUE" if v else "FALSE") if isinstance(v, bool) else " ".join(str(v).split())
    return s if len(s) <= longest else s[: longest - 1] + "…"


def sheet_markdown(title: str, rows: list[list], n_rows: int, n_cols: int, max_rows: int = MAX_ROWS, max_cols: int = MAX_COLS) -> str:
    """A title, a header A, B, C ..., and at most ``max_rows`` x ``max_cols`` cells."""
    height, width = min(n_rows, max_rows), min(n_cols, max_cols)
    head = f"# Sheet: {title}"
    if not height or not width:
        return f"{head}\n(empty sheet)"
    line = lambda cells: "| " + " | ".join(cells) + " |"
    body = [line(cell_text(c) for c in [*r, *[None] * width][:width]) for r in [*rows, *[[]] * height][:height]]
    cut = ["", f"(truncated to {height} rows × {width} cols)"] if n_rows > height or n_cols > width else []
    return "\n".join([head, line(column_letter(k + 1) for k in range(width)), line(["---"] * width), *body, *cut])


def _cell(c: ElementTree.Element, shared: list[str]) -> object:
    kind, v = c.get("t"), c.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return v.text == "1"
    if kind in ("str", "e"):
        return v.text
    number = float(v.text)
    return int(number) if re.fullmatch(r"[+-]?\d+", v.text) else number


def sheets(content: bytes) -> Iterator[tuple[str, list[list], int, int]]:
    """(title, rows, number of rows, number of columns) of each sheet, in workbook order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        targets = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            target = targets[s.get(_REL)]
            cells, high, wide = {}, 0, 0
            for c in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{_MAIN}c"):
                letters, row = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r")).groups()
                col = 0
                for x in letters:
                    col = col * 26 + ord(x) - 64
                cells[int(row), col] = _cell(c, shared)
                high, wide = max(high, int(row)), max(wide, col)
            yield s.get("name"), [[cells.get((r, k)) for k in range(1, wide + 1)] for r in range(1, high + 1)], high, wide


def parse_workbooks(spark: SparkSession, path: str, max_rows: int = MAX_ROWS, max_cols: int = MAX_COLS) -> DataFrame:
    """A row for each sheet of each workbook under ``path``; a broken file gives one row with its error."""
    files = ship(spark).read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)
    files = files.filter(~F.col("path").rlike(r"/(\.|~\$)[^/]*$")).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"]):
                name = p.rsplit("/", 1)[-1]
                try:
                    pages = [(k, sheet_markdown(t, r, h, w, max_rows, max_cols), t) for k, (t, r, h, w) in enumerate(sheets(content), 1)]
                    rows = [(name, p, len(pages), "xlsx", *x, None) for x in pages]
                except Exception as e:  # noqa: BLE001 - one bad file must not end the scan
                    rows = [(name, p, 0, "xlsx", None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["doc_name", "source_path", "num_pages", "backend", "page_number", "text", "sheet_title", "error"]).astype({"page_number": "Int64"})

    return files.mapInPandas(run, PAGES)


def cell_column(v: Column, longest: int = MAX_CELL) -> Column:
    """:func:`cell_text` for string columns."""
    s = F.trim(F.regexp_replace(F.coalesce(v, F.lit("")), r"(?U)\s+", " "))
    return F.when(F.length(s) > longest, F.concat(F.substring(s, 1, longest - 1), F.lit("…"))).otherwise(s)


def table_markdown(cells: DataFrame) -> DataFrame:
    """(table, markdown) of string cells (table, r, c, value). The first row is the header if all
    its cells have text and there are more rows; else columns are named by number."""
    rows = cells.groupBy("table", "r").agg(F.transform(F.array_sort(F.collect_list(F.struct("c", cell_column(F.col("value")).alias("v")))), lambda x: x["v"]).alias("v"))
    line = lambda a: F.concat(F.lit("| "), F.array_join(a, " | "), F.lit(" |"))
    whole = rows.groupBy("table").agg(F.array_sort(F.collect_list(F.struct("r", "v"))).alias("rows"))
    first = F.col("rows")[0]["v"]
    headed = F.forall(first, lambda x: x != "") & (F.size("rows") > 1)
    names = F.when(headed, first).otherwise(F.transform(first, lambda x, i: (i + 1).cast("string")))
    body = F.when(headed, F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(1)))).otherwise(F.col("rows"))
    text = F.concat_ws("\n", line(names), line(F.transform(first, lambda x: F.lit("---"))), F.array_join(F.transform(body, lambda r: line(r["v"])), "\n"))
    return whole.select("table", text.alias("markdown"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """(row, cells) of the first sheet of a workbook: ``cells`` maps each title of the first row to the
    cell's text; rows without any are left out."""
    files = ship(spark).read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                _, rows, *_ = next(sheets(content))
                titles = [" ".join(str(x).split()) if x is not None else "" for x in (rows or [[]])[0]]
                text = lambda v: None if v is None else str(v)
                each = [(k, {t: text(v) for t, v in zip(titles, r) if t}) for k, r in enumerate(rows[1:], 1) if any(v is not None for v in r)]
                yield pd.DataFrame(each, columns=["row", "cells"])

    return files.mapInPandas(run, "row int, cells map<string,string>")


#: Rows that a sheet can have.
SHEET_ROWS = 1_048_576


def workbook_bytes(title: str, rows: list[list[str | None]]) -> bytes:
    """A workbook of one sheet of text cells."""
    main, rel = _MAIN.strip("{}"), _REL.strip("{").split("}")[0]
    cell = lambda v, r, c: "" if v is None else f'<c r="{column_letter(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
    body = "".join(f'<row r="{r}">' + "".join(cell(v, r, c) for c, v in enumerate(row, 1)) + "</row>" for r, row in enumerate(rows, 1))
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(title, {chr(34): "&quot;"})}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def write_table(df: DataFrame, path: str, order: str, title: str = "Sheet1") -> None:
    """``df`` as one workbook of text cells, with its column names as the first row; the rows stand in the order of
    the column ``order``, which is not written itself.

    A sheet has at most SHEET_ROWS rows; a larger table is refused."""
    spark = df.sparkSession
    titles = [c for c in df.columns if c != order]
    rows = df.orderBy(order).limit(SHEET_ROWS).select(*[F.col(f"`{c}`").cast("string") for c in titles]).collect()
    if len(rows) >= SHEET_ROWS:
        raise ValueError("the table has more rows than a sheet can hold")
    content = workbook_bytes(title, [titles, *map(list, rows)])
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


class _Cells(HTMLParser):
    """The cells of a page's tables: (table, row, column, text); cells of a table inside a cell are its own table's."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[int, int, int, str]] = []
        self.open: list[list] = []  # table number, row, column, text of the open cell or None
        self.tables = 0

    def end_cell(self) -> None:
        if self.open and self.open[-1][3] is not None:
            number, row, column, text = self.open[-1]
            self.out.append((number, row, column, " ".join("".join(text).split())))
            self.open[-1][3] = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append([self.tables, -1, -1, None])
            self.tables += 1
        elif self.open and tag == "tr":
            self.end_cell()
            self.open[-1][1:3] = self.open[-1][1] + 1, -1
        elif self.open and tag in ("td", "th"):
            self.end_cell()
            row = self.open[-1]
            row[1], row[2], row[3] = max(row[1], 0), row[2] + 1, []

    def handle_endtag(self, tag):
        if self.open and tag in ("td", "th", "tr", "table"):
            self.end_cell()
            if tag == "table":
                self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1][3] is not None:
            self.open[-1][3].append(data)


def html_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, number, markdown) of every table in each page's HTML, numbered in page order."""
    source = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).filter(F.lower("html").contains("<table"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, html in zip(batch["id"], batch["html"]):
                page = _Cells()
                page.feed(html)
                page.close()
                while page.open:
                    page.handle_endtag("table")
                rows += [(i, *x) for x in page.out]
            yield pd.DataFrame(rows, columns=["id", "number", "r", "c", "value"])

    kind = source.schema["id"].dataType.simpleString()
    cells = source.mapInPandas(run, f"id {kind}, number int, r int, c int, value string")
    made = table_markdown(cells.select(F.struct("id", "number").alias("table"), "r", "c", "value"))
    return made.select(F.col("table.id").alias(id_col), "table.number", "markdown")
