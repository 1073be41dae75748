"""Keeps a table of passages up to date with a growing folder of pages.

    python -m jobs.refresh_passages --source PATH --out PATH --checkpoint PATH [--config PATH]

Takes the files that have come since the last run, cleans and cuts their pages, and appends
passages to ``out/passages``, one folder for each document; then writes the documents' totals
anew to ``out/totals``. What was read is remembered by the stream's checkpoint, and the file sink
commits each batch once, so a run without new files, or one after a stop, changes nothing more."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import read_config
from quern.config import Chunking
from quern.operators.chunk import cut_pages

log = logging.getLogger("jobs.refresh_passages")
PASSAGE = "page bigint, place int, start_pos int, end_pos int, text string, doc string"


def passages(spark: SparkSession, out: str) -> DataFrame:
    """(page, place, start_pos, end_pos, text, doc) of all runs so far."""
    return spark.read.schema(PASSAGE).parquet(f"{out}/passages")


def cut(pages: DataFrame, config: dict) -> DataFrame:
    """Passages of pages of any columns; ``config`` says which are the document, the page and the text."""
    named = pages.select(*[F.expr(config[c]).alias(c) for c in ("doc", "page", "text")])
    found = cut_pages(named, Chunking(**config["chunking"])).select("doc", "page", F.posexplode("chunks").alias("place", "x"))
    columns = {"page": F.col("page"), "place": F.col("place"), "start_pos": F.col("x.start"), "end_pos": F.col("x.end"), "text": F.col("x.text"), "doc": F.col("doc")}
    kinds = dict(c.split(" ") for c in PASSAGE.split(", "))
    return found.select(*[c.cast(kinds[k]).alias(k) for k, c in columns.items()])


def refresh(spark: SparkSession, source: str, out: str, checkpoint: str, config: dict) -> dict[str, int]:
    """One run. ``source`` is a folder of page files (or one file), whose columns are taken from the files there.

    A page without text has no passages; null documents share a folder; a page that comes in two files is
    two pages, as the files are the unit of what is new."""
    kind = config["format"]
    schema = spark.read.format(kind).load(source).schema
    # a stream takes a folder or a pattern: as a pattern, a single file is found as well
    pattern = source if any(c in source for c in "*?[{") else f"{source.rstrip('/')[:-1]}[{source.rstrip('/')[-1]}]"
    new = spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", config["files_per_batch"]).load(pattern)
    query = (
        cut(new, config).writeStream.format("parquet").partitionBy("doc").option("path", f"{out}/passages")
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    read = sum(p["numInputRows"] for p in query.recentProgress)
    log.info("read %d new pages of %s in %d batches", read, source, sum(p["numInputRows"] > 0 for p in query.recentProgress))
    totals = passages(spark, out).groupBy("doc").agg(F.count_distinct("page").alias("pages"), F.count("*").alias("passages"), F.sum(F.length("text")).alias("chars"))
    totals.coalesce(1).write.mode("overwrite").parquet(f"{out}/totals")
    held = spark.read.parquet(f"{out}/totals").agg(F.count("*"), F.coalesce(F.sum("passages"), F.lit(0))).first()
    log.info("%s/passages now holds %d passages of %d documents", out, held[1], held[0])
    return {"read": read, "documents": held[0], "passages": held[1]}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("source", "out", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("refresh-passages").getOrCreate()
    try:
        refresh(spark, args.source, args.out, args.checkpoint, read_config(spark, args.config, "refresh_passages"))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
