"""Pages to chunks: closed forms over columns, no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.config import Chunking, CleanRules
from quern.functions.plan import let, once
from quern.functions.text import LINE_END, clean, is_blank, occurrences, strip
from quern.session import durable, small, spread

CHARS_PER_TOKEN = 4
#: Pages of one numbering block, see :func:`numbered`.
PAGES_PER_BLOCK = 4096


def auto_size(text: Column, cfg: Chunking) -> tuple[Column, Column]:
    """(size, overlap) in tokens for a cleaned text, by how tabular it looks and how long its lines are."""
    # no two of the bullets overlap, so that one pass counts them all
    bullets = F.regexp_count(text, F.lit(r"•|[-–*] "))
    marks = occurrences(text, "\n") * 0.5 + occurrences(text, "|") * 3 + occurrences(text, "\t") * 2 + bullets * 1.5
    lengths = F.transform(F.split(text, LINE_END), lambda x: F.length(strip(x)))
    add = lambda s, n: F.struct((s["n"] + (n > 0).cast("int")).alias("n"), (s["total"] + n).alias("total"))
    lines = F.aggregate(lengths, F.struct(F.lit(0).alias("n"), F.lit(0).alias("total")), add)
    facts = F.struct(lines.alias("lines"), (marks / F.greatest(F.lit(1.0), F.length(text) / 1000.0)).alias("structure"))

    def pick(f: Column) -> Column:
        average = F.when(f["lines"]["n"] > 0, f["lines"]["total"] / f["lines"]["n"]).otherwise(0.0)
        size = F.when(f["structure"] >= 6, cfg.high).when(f["structure"] >= 3, (cfg.low + cfg.high) // 2).otherwise(cfg.low)
        return F.when(average <= 40, F.least(F.lit(cfg.high), (size * 1.2).cast("int"))).when(average >= 140, F.greatest(F.lit(cfg.low), (size * 0.85).cast("int"))).otherwise(size)

    size = let(facts, pick)
    return size, let(size, lambda n: (n * cfg.ratio).cast("int"))


def spans(text: Column, size: Column, overlap: Column) -> Column:
    """All windows of a text as an array of (start, end, text); none for a blank text.

    The text is cut once into pieces of one step; a window is its piece and what it needs of the next
    ones. So the cost is linear in the text, which taking each window from the whole text is not."""
    wide, step = size * CHARS_PER_TOKEN, (size - overlap) * CHARS_PER_TOKEN
    last = lambda n: F.greatest(F.lit(0), F.ceil((n - wide) / step)).cast("int")
    pieces = F.regexp_extract_all(text, F.concat(F.lit("(?s).{1,"), step.cast("string"), F.lit("}")), F.lit(0))
    window = lambda p, k: F.substring(F.array_join(F.slice(p, k + 1, F.ceil(wide / step).cast("int")), ""), F.lit(1), wide)
    each = lambda p, n: F.transform(F.sequence(F.lit(0), last(n)), lambda k: F.struct((k * step).alias("start"), F.least(n, k * step + wide).alias("end"), window(p, k).alias("text")))
    # the length is worked out once, not for each window
    return F.when(~is_blank(text), let(F.length(text), lambda n: let(pieces, lambda p: each(p, n))))


def split_pages(pages: DataFrame, cfg: Chunking, rules: CleanRules = CleanRules()) -> DataFrame:
    """(doc, page, size, overlap, start, end, text) of each chunk of (doc, page, text)."""
    cleaned = once(pages, "t", clean("text", rules)).select("doc", "page", "t")
    size, overlap = auto_size(F.col("t"), cfg) if cfg.mode == "auto" else (F.lit(cfg.size), F.lit(cfg.overlap))
    sized = once(cleaned, "size", size).withColumn("overlap", overlap if cfg.mode != "auto" else (F.col("size") * cfg.ratio).cast("int"))
    return sized.select("doc", "page", "size", "overlap", F.explode(spans(F.col("t"), F.col("size"), F.col("overlap"))).alias("x")).select("doc", "page", "size", "overlap", "x.*")


def distinct_spans(found: Column) -> Column:
    """Of a page's chunks that begin alike (256 characters, outer blanks aside) the first, in the page's
    order; blank chunks go. Sorted twice inside the row, so no text is shuffled."""
    keyed = F.sort_array(F.transform(found, lambda x: F.struct(F.substring(strip(x["text"]), 1, 256).alias("key"), x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"))))
    new = lambda s: F.filter(s, lambda x, i: (x["key"] != "") & ((i == 0) | (x["key"] != F.coalesce(F.get(s, i - 1)["key"], F.lit("")))))
    plain = lambda s: F.sort_array(F.transform(s, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"))))
    return let(keyed, lambda s: plain(new(s)))


def cut_pages(pages: DataFrame, cfg: Chunking, rules: CleanRules = CleanRules()) -> DataFrame:
    """(doc, page, chunks) of each page row: its distinct chunks as one array of (start, end, text)."""
    cleaned = once(pages, "t", clean("text", rules)).select("doc", "page", "t")
    size, overlap = auto_size(F.col("t"), cfg) if cfg.mode == "auto" else (F.lit(cfg.size), F.lit(cfg.overlap))
    sized = once(cleaned, "size", size).withColumn("overlap", overlap if cfg.mode != "auto" else (F.col("size") * cfg.ratio).cast("int"))
    cut = once(sized, "found", spans(F.col("t"), F.col("size"), F.col("overlap"))).select("doc", "page", "found")
    return cut.filter(F.col("found").isNotNull()).select("doc", "page", distinct_spans(F.col("found")).alias("chunks"))


def numbered(cut: DataFrame) -> DataFrame:
    """(row, first): for each page row (row, doc, page, n) the number of its document's chunks before it.

    Numbers are counted inside blocks of pages and shifted by the sizes of the blocks before, so
    that no task has to hold the pages of a whole large document."""
    blocked = cut.withColumn("_block", F.floor(F.col("page") / PAGES_PER_BLOCK))
    before = W.partitionBy("doc").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    shift = blocked.groupBy("doc", "_block").agg(F.sum("n").alias("_c")).select("doc", "_block", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_shift"))
    inside = W.partitionBy("doc", "_block").orderBy("page", "row").rowsBetween(W.unboundedPreceding, -1)
    placed = blocked.withColumn("_before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.join(shift, ["doc", "_block"]).select("row", (F.col("_shift") + F.col("_before")).alias("first"))


def chunk_pages(pages: DataFrame, cfg: Chunking, rules: CleanRules = CleanRules()) -> DataFrame:
    """(doc, chunk_id, page, start, end, text): cleaned, split, without repeats, numbered from 0 in the document.

    Pages are cut once and written; only their chunk counts are shuffled, and go back to the pages
    as a broadcast while they are small."""
    cut = durable(cut_pages(spread(pages), cfg, rules).withColumn("n", F.size("chunks")).withColumn("row", F.monotonically_increasing_id()))
    first = durable(numbered(cut.select("row", "doc", "page", "n")))
    each = cut.join(small(first), "row").select("doc", "page", "first", F.posexplode("chunks").alias("place", "x"))
    return each.select("doc", (F.col("first") + F.col("place")).cast("int").alias("chunk_id"), "page", "x.start", "x.end", "x.text")
