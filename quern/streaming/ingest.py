"""Incremental ingestion: new page files of a folder are chunked as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quern.config import AUTO, Chunking
from quern.operators.chunk import chunk_pages

PAGES = "doc string, page bigint, text string"


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, text) of Parquet files that appear in a folder."""
    return spark.readStream.schema(PAGES).parquet(path)


def ingest(pages: DataFrame, out: str, checkpoint: str, cfg: Chunking = AUTO) -> StreamingQuery:
    """Chunks each batch of new documents and appends them; the checkpoint remembers which files
    were read, so a restart repeats none. A batch holds whole documents."""
    def write(batch: DataFrame, number: int) -> None:
        chunk_pages(batch, cfg).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
