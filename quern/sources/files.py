"""Documents that need a parser (PDF and others), behind the PageParser interface."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import Ocr
from quern.plugins import PageParser, PageRenderer
from quern.session import ship
from quern.sources import pdf

PAGES = "doc_name string, source_path string, num_pages int, backend string, page_number int, text string, ocr_used boolean, error string"


#: Characters of pages that a task holds before it passes them on, beyond one file's.
FRAME_CHARS = 1 << 20


def plain_text(path: str, content: bytes) -> list[dict]:
    """The parser for plain files: form feeds end pages."""
    return [{"page_number": k, "text": x} for k, x in enumerate(content.decode("utf-8", "replace").split("\f"), 1)]


def parse_document(path: str, content: bytes) -> Iterator[dict]:
    """The parser for PDF files, known by their first bytes, and plain ones."""
    return iter(pdf.parse_pdf(path, content) if b"%PDF-" in content[:1024] else plain_text(path, content))


def read_again(content: bytes, page: dict, render: PageRenderer, ocr: Callable[[bytes], str], cfg: Ocr) -> tuple[str, bool]:
    """(text, whether it is the OCR's) of a page with little text: the OCR's if there is any and it is no shorter."""
    size = lambda x: len(" ".join((x or "").split()))
    if size(page["text"]) >= cfg.min_chars:
        return page["text"], False
    found = ocr(render(content, page["page_number"], cfg.dpi))
    return (found, True) if size(found) and size(found) >= size(page["text"]) else (page["text"] or "", False)


def parse_files(
    spark: SparkSession, path: str, parser: PageParser = parse_document, glob: str = "*.pdf", backend: str = "parser", max_pages: int | None = None,
    render: PageRenderer | None = None, ocr: Callable[[bytes], str] | None = None, cfg: Ocr = Ocr(),
) -> DataFrame:
    """:func:`parse_contents` of the files of a folder and those below it."""
    return parse_contents(read_contents(spark, path, glob), parser, backend, max_pages, render, ocr, cfg)


def read_contents(spark: SparkSession, path: str | list[str], glob: str = "*.pdf") -> DataFrame:
    """(path, content) of files. Spark's reader leaves out files of no bytes."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "content")


def parse_contents(
    files: DataFrame, parser: PageParser = parse_document, backend: str = "parser", max_pages: int | None = None,
    render: PageRenderer | None = None, ocr: Callable[[bytes], str] | None = None, cfg: Ocr = Ocr(),
) -> DataFrame:
    """A row for each page of (path, content); a file that the parser can't read gives one row with its error.

    With a renderer and an OCR engine, pages with little text are read again from their image. One file is read by
    one task, page by page, ``max_pages`` at most."""
    ship(files.sparkSession)
    most = max_pages if max_pages is not None else cfg.max_pages

    def page_row(content: bytes, page: dict) -> tuple[int, str, bool | None]:
        if render is None or ocr is None:
            return page["page_number"], page["text"], None
        return page["page_number"], *read_again(content, page, render, ocr, cfg)

    names = [x.split()[0] for x in PAGES.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({"page_number": "Int64", "ocr_used": "boolean"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0  # pages of several files go on together, as a frame takes longer to make than a short file to read
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"]):
                name = p.rsplit("/", 1)[-1]
                try:
                    pages = [page_row(content, x) for x in islice(parser(p, content), most)]
                    rows += [(name, p, len(pages), backend, *x, None) for x in pages]
                    size += sum(len(x[1] or "") + 100 for x in pages)
                except Exception as e:  # noqa: BLE001 - one bad file must not end the scan
                    rows.append((name, p, 0, backend, None, None, None, f"{type(e).__name__}: {e}"))
                if size > FRAME_CHARS or len(rows) > 4096:
                    yield frame(rows)
                    rows, size = [], 0
        if rows:
            yield frame(rows)

    return files.select("path", "content").mapInPandas(run, PAGES)


def as_v2(pages: DataFrame) -> DataFrame:
    """Page rows as V2 documents; a broken document keeps its error and has no content."""
    titles = F.col("sheet_title") if "sheet_title" in pages.columns else F.lit(None).cast("string")
    used = F.col("ocr_used") if "ocr_used" in pages.columns else F.lit(None).cast("boolean")
    page = F.struct(F.col("page_number").alias("page_id"), F.col("page_number").alias("page_number"), F.col("text"), used.alias("ocr_used"), titles.alias("sheet_title"), F.lit(None).cast("string").alias("section"))
    return pages.groupBy("doc_name", "source_path").agg(
        F.max("num_pages").alias("num_pages"), F.first("backend").alias("backend"), F.lit(None).cast("string").alias("ocr_model"),
        F.array_sort(F.collect_list(F.when(F.col("page_number").isNotNull(), page))).alias("content"), F.max("error").alias("error"), F.lit(False).alias("interrupted"),
    )
