"""Tables of PDF pages: cells from ruling lines, else from columns that gaps leave."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import ship
from quern.sources import pdf
from quern.sources.workbooks import table_markdown

#: Points by which rules of one line may differ.
NEAR = 2.0
NONE_FOUND = "No tables found."
Grid = list[list[str]]
_Word = tuple[float, float, float, str]  # from, to, height, text


def words_of(line: list[pdf.Piece]) -> list[_Word]:
    """The words of a line; parts of one word in several pieces are put together."""
    out: list[_Word] = []
    open_at = None
    for p in line:
        if open_at is not None and p.x[0] - open_at[1] > 0.2 * p.size:
            out.append(open_at)
            open_at = None
        for k, c in enumerate(p.chars):
            if not c.strip():
                out += [open_at] if open_at else []
                open_at = None
            elif open_at is None:
                open_at = (p.x[k], p.x[k + 1], p.y + 0.3 * p.size, c)
            else:
                open_at = (open_at[0], max(open_at[1], p.x[k + 1]), open_at[2], open_at[3] + c)
    return out + ([open_at] if open_at else [])


class _Sets:
    def __init__(self, n: int):
        self.of = list(range(n))

    def find(self, k: int) -> int:
        while self.of[k] != k:
            self.of[k] = k = self.of[self.of[k]]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.of[b] = a


def _apart(values: list[float]) -> list[float]:
    """Sorted values, those within NEAR of the one before left out."""
    out: list[float] = []
    for v in sorted(values):
        if not out or v - out[-1] > NEAR:
            out.append(v)
    return out


def ruled(rules: list[tuple], words: list[_Word]) -> list[tuple[float, Grid, tuple]]:
    """(top, cells, box) of each net of crossing rules with two lines each way at least.

    Cells that no rule parts are one; its words stand in its first cell, the others are empty."""
    flat = [r for r in rules if r[3] - r[1] <= r[2] - r[0]]
    upright = [r for r in rules if r[3] - r[1] > r[2] - r[0]]
    nets = _Sets(len(flat) + len(upright))
    for i, h in enumerate(flat):
        for j, v in enumerate(upright):
            if h[0] - NEAR <= v[0] <= h[2] + NEAR and v[1] - NEAR <= h[1] <= v[3] + NEAR:
                nets.join(i, len(flat) + j)
    found = []
    for net in {nets.find(k) for k in range(len(nets.of))}:
        hs, vs = ([r for k, r in enumerate(part, at) if nets.find(k) == net] for part, at in ((flat, 0), (upright, len(flat))))
        xs, ys = _apart([v[0] for v in vs]), _apart([h[1] for h in hs])[::-1]
        if len(xs) < 2 or len(ys) < 2:
            continue
        rows, columns = len(ys) - 1, len(xs) - 1
        cells = _Sets(rows * columns)
        for i in range(rows):
            for j in range(columns):
                x, y = (xs[j] + xs[j + 1]) / 2, (ys[i] + ys[i + 1]) / 2
                if j + 1 < columns and not any(abs(v[0] - xs[j + 1]) <= NEAR and v[1] <= y <= v[3] for v in vs):
                    cells.join(i * columns + j, i * columns + j + 1)
                if i + 1 < rows and not any(abs(h[1] - ys[i + 1]) <= NEAR and h[0] <= x <= h[2] for h in hs):
                    cells.join(i * columns + j, (i + 1) * columns + j)
        held: dict[int, list[str]] = {}
        for x0, x1, y, text in words:
            i, j = sum(y < e for e in ys) - 1, sum((x0 + x1) / 2 > e for e in xs) - 1
            if 0 <= i < rows and 0 <= j < columns:
                held.setdefault(cells.find(i * columns + j), []).append(text)
        grid = [[" ".join(held.get(i * columns + j, [])) for j in range(columns)] for i in range(rows)]
        if held:
            found.append((ys[0], grid, (xs[0], ys[-1], xs[-1], ys[0])))
    return found


def gapped(lines: list[list[_Word]], sizes: list[float], least: int = 3) -> list[tuple[float, Grid]]:
    """(top, cells) of runs of ``least`` or more lines whose words stand in two columns or more.

    Words further apart than the letters' size and a fifth are in two cells; a column is what no gap of all lines parts.
    A line with one cell belongs to a run only between lines with more."""
    cut: list[list[_Word]] = []
    for line, size in zip(lines, sizes):
        cells: list[_Word] = []
        for w in line:
            if cells and w[0] - cells[-1][1] <= 1.2 * size:
                cells[-1] = (cells[-1][0], w[1], w[2], f"{cells[-1][3]} {w[3]}")
            else:
                cells.append(w)
        cut.append(cells)
    found, k = [], 0
    while k < len(cut):
        end = k
        while end < len(cut) and (len(cut[end]) > 1 or (end > k and len(cut[end]) == 1 and end + 1 < len(cut) and len(cut[end + 1]) > 1)):
            if end > k and cut[end - 1][0][2] - cut[end][0][2] > 3 * sizes[end]:
                break
            end += 1
        run = cut[k:end]
        if sum(len(x) > 1 for x in run) >= least:
            columns: list[list[float]] = []
            for x0, x1 in sorted((w[0], w[1]) for x in run for w in x):
                if columns and x0 <= columns[-1][1]:
                    columns[-1][1] = max(columns[-1][1], x1)
                else:
                    columns.append([x0, x1])
            if len(columns) > 1:
                place = lambda w: sum(w[0] > c[1] for c in columns)
                grid = [[" ".join(w[3] for w in x if place(w) == j) for j in range(len(columns))] for x in run]
                found.append((run[0][0][2], grid))
        k = max(end, k + 1)
    return found


def page_tables(page: pdf.Page) -> list[Grid]:
    """The tables of a page from its top."""
    lines = pdf.lines_of(page)
    words = [words_of(x) for x in lines]
    found = ruled(page.rules, [w for x in words for w in x])
    boxes = [b for *_, b in found]
    free = [[w for w in x if not any(b[0] <= w[0] <= b[2] and b[1] <= w[2] <= b[3] for b in boxes)] for x in words]
    kept = [(x, max(p.size for p in line)) for x, line in zip(free, lines) if x]
    tables = [(top, grid) for top, grid, _ in found] + gapped([x for x, _ in kept], [s for _, s in kept])
    return [grid for _, grid in sorted(tables, key=lambda t: -t[0])]


def table_cells(contents: DataFrame, most: int | None = None) -> DataFrame:
    """(path, page, number, r, c, value) of every cell of the tables in (path, content) of PDF files; a file that can't be read has none."""
    ship(contents.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    for k, page in enumerate(pdf.read_pages(content, most), 1):
                        rows = [(path, k, n, r, c, x) for n, grid in enumerate(page_tables(page)) for r, row in enumerate(grid) for c, x in enumerate(row)]
                        yield pd.DataFrame(rows, columns=["path", "page", "number", "r", "c", "value"])
                except Exception:  # noqa: BLE001, S112 - the scan of its pages has the error
                    continue

    return contents.select("path", "content").mapInPandas(run, "path string, page int, number int, r int, c int, value string")


def pdf_tables(contents: DataFrame, most: int | None = None) -> DataFrame:
    """(path, page, number, markdown) of every table."""
    cells = table_cells(contents, most).select(F.struct("path", "page", "number").alias("table"), "r", "c", "value")
    return table_markdown(cells).select("table.*", "markdown")


def tables_by_file(contents: DataFrame, most: int | None = None) -> DataFrame:
    """(path, markdown) of each file: all its tables by page with an empty line between them, or that none were found."""
    each = F.array_sort(F.collect_list(F.struct("page", "number", "markdown")))
    made = pdf_tables(contents, most).groupBy("path").agg(F.array_join(F.transform(each, lambda x: x["markdown"]), "\n\n").alias("markdown"))
    return contents.select("path").join(made, "path", "left").fillna(NONE_FOUND, ["markdown"])
