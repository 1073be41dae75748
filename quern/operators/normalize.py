"""Parsed documents: one canonical form, table pages, and the choice between text layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.config import Ocr
from quern.functions.text import compact, printable, stem

PAGE_V1 = "struct<page:int, content:array<struct<type:string, text:string>>, page_dimensions:map<string,string>>"


def is_v1() -> Column:
    return F.col("metainfo").isNotNull() & F.col("content").isNotNull()


def is_v2() -> Column:
    return F.col("doc_name").isNotNull() & F.col("content").isNotNull()


def page_number(p: Column) -> Column:
    """page_number, or page_id where that is null or 0."""
    return F.coalesce(F.nullif(p["page_number"], F.lit(0)), p["page_id"])


def v2_to_v1(docs: DataFrame) -> DataFrame:
    """(metainfo, content): pages by number, those without a number left out."""
    pages = F.filter(F.transform("content", lambda p: F.struct(page_number(p).alias("n"), F.coalesce(p["text"], F.lit("")).alias("text"))), lambda p: p["n"].isNotNull())
    ordered = F.array_sort(F.transform(pages, lambda p, i: F.struct(p["n"].alias("n"), i.alias("i"), p["text"].alias("text"))))
    content = F.transform(ordered, lambda p: F.struct(p["n"].alias("page"), F.array(F.struct(F.lit("text").alias("type"), p["text"].alias("text"))).alias("content"), F.create_map().cast("map<string,string>").alias("page_dimensions")))
    info = F.struct(stem("doc_name").alias("sha1_name"), F.coalesce(F.nullif(F.col("num_pages"), F.lit(0)), F.size("content")).alias("pages_amount"), F.col("source_path").alias("source_path"), F.col("backend").alias("backend"), F.col("ocr_model").alias("ocr_model"))
    return docs.select(info.alias("metainfo"), content.alias("content"))


def normalize(docs: DataFrame) -> DataFrame:
    """Documents of either form (``schema.PARSED_ANY``) as V1; others are left out."""
    kept = F.transform("content", lambda p: F.struct(p["page"].alias("page"), p["content"].alias("content"), p["page_dimensions"].alias("page_dimensions")))
    v1 = docs.filter(is_v1()).select("metainfo", kept.alias("content"))
    return v1.unionByName(v2_to_v1(docs.filter(is_v2() & ~is_v1())), allowMissingColumns=True)


def pages_of(docs: DataFrame) -> DataFrame:
    """(doc, page, text) of V1 documents: the text items of a page, joined by line feeds."""
    each = docs.select(F.col("metainfo.sha1_name").alias("doc"), F.posexplode("content").alias("i", "p"))
    texts = F.transform(F.filter("p.content", lambda x: x["type"] == "text"), lambda x: x["text"])
    return each.select("doc", F.col("p.page").alias("page"), F.array_join(texts, "\n").alias("text"))


def append_tables(docs: DataFrame, tables: DataFrame) -> DataFrame:
    """V2 documents with the Markdown of (stem, markdown) as one more last page.

    Tables that are missing, blank or say that none were found add nothing."""
    t = tables.filter(F.col("markdown").isNotNull() & (F.trim("markdown") != "") & ~F.contains("markdown", F.lit("No tables found."))).select(F.col("stem").alias("_stem"), F.col("markdown").alias("_md"))
    joined = docs.join(t, stem("doc_name") == F.col("_stem"), "left")
    last = F.coalesce(page_number(F.element_at("content", -1)), F.size("content"))
    more = F.struct((last + 1).alias("page_id"), (last + 1).alias("page_number"), F.col("_md").alias("text"), F.lit(False).alias("ocr_used"), F.lit(None).cast("string").alias("sheet_title"), F.lit("tables_md").alias("section"))
    content = F.when(F.col("_md").isNull(), F.col("content")).otherwise(F.array_append("content", more))
    return joined.withColumn("content", content).withColumn("num_pages", F.when(F.col("_md").isNull(), F.col("num_pages")).otherwise(F.size("content"))).drop("_stem", "_md")


def choose_ocr(text: Column, ocr: Column, cfg: Ocr = Ocr()) -> Column:
    """Of a page with little text, the OCR text if it is not empty and at least as long."""
    better = (F.length(compact(ocr)) > 0) & (F.length(compact(ocr)) >= F.length(compact(text)))
    return F.when((F.length(compact(text)) < cfg.min_chars) & F.coalesce(better, F.lit(False)), ocr).otherwise(F.coalesce(text, F.lit("")))


def choose_by_confidence(text: Column, confidence: Column, ocr: Column, cfg: Ocr = Ocr()) -> tuple[Column, Column]:
    """(text, source): OCR is asked where the text is short or its confidence low, and taken if
    it has at least as many visible characters as the text and as the least number."""
    weak = (F.length(F.coalesce(text, F.lit(""))) < cfg.confident_chars) | (F.coalesce(confidence, F.lit(1.0)) < cfg.min_confidence)
    take = weak & (printable(ocr) >= F.greatest(printable(text), F.lit(cfg.confident_chars)))
    return F.when(take, ocr).otherwise(F.coalesce(text, F.lit(""))), F.when(take, "ocr").otherwise("parser")
