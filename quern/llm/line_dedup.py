"""Site-relative line frequency: lines on too many pages of their host are boilerplate.

Columns only. Every page's distinct lines are counted by (host, line hash) with map-side
sums, so a host that holds a third of all pages costs no more per task than others. The
lines over the ratio are few for each host (at most the mean number of lines on a page
divided by the ratio) and go back to the host's pages as one array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.tables import durable, small

#: A line on more than this share of its host's pages is boilerplate ...
RATIO = 0.1
#: ... if it is on this many pages at least.
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, pages): hash of each boilerplate line and the number of pages that hold it.

    Null texts are pages without lines; pages with a null host form one host; repeated rows are pages of
    their own; an empty table has no boilerplate. Lines are told apart by 64 bits of their hash. A
    ``min_pages`` of 1 leaves the ratio alone to decide, also for hosts of few pages."""
    pages = docs.select(host.alias("host"), F.col(text_col).alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    each = pages.select("host", F.explode(F.array_distinct(F.transform(_lines("text"), lambda x: F.trim(x)))).alias("line")).filter(F.col("line") != "")
    often = each.groupBy("host", F.xxhash64("line").alias("line")).agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    t = totals.withColumnRenamed("host", "of")
    return often.join(t, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("pages") > ratio * F.col("total")).select("host", "line", "pages")


def clean(docs: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and two columns more.

    ``line_dedup`` is a struct of ``n_lines`` (before) and ``n_dropped``. Lines end at line
    feeds and are compared without outer blanks; blank lines are never dropped and pages
    left without lines keep the empty text. Null texts stay null and have no lines; pages with
    a null host form one host. Repeated rows are pages of their own. Other columns stay, in
    their order; one that is named ``line_dedup`` is replaced."""
    # the row travels in a struct, so that its columns' names can't clash with those used here
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), host.alias("host"), F.col(text_col).alias("text"))
    found = boilerplate(packed, F.col("host"), "text", ratio, min_pages)
    lists = small(durable(found.groupBy(F.col("host").alias("of")).agg(F.collect_set("line").alias("bad"))))
    lines = _lines(F.col("text"))
    keep = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains("bad", F.xxhash64(F.trim(x))))
    joined = packed.join(lists, F.col("host").eqNullSafe(F.col("of")), "left").withColumn("kept", F.when(F.col("bad").isNull(), lines).otherwise(keep))
    none = F.lit(0).cast("bigint")
    n, dropped = F.size(lines).cast("bigint"), (F.size(lines) - F.size("kept")).cast("bigint")
    counts = F.struct(F.when(F.col("text").isNull(), none).otherwise(n).alias("n_lines"), F.when(F.col("text").isNull(), none).otherwise(dropped).alias("n_dropped"))
    columns = [(F.array_join("kept", "\n") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns if c != "line_dedup"]
    return joined.select(*columns, counts.alias("line_dedup"))
