"""From raw documents to token counts: five stages, each writing a table the next one reads.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; ``sf_dir`` holds the
side tables (labels, benchmark). All stages but the last return the columns of documents, in their order; other
columns are left out at the first stage. An empty table passes through all stages as an empty table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, decontaminate, line_dedup, near_dup, quality
from quern.llm.queries import RANKS
from quern.llm.tables import shared_folder, table
from quern.session import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained views accept. Null texts count as empty; nulls in lang, source and
    n_chars are values of their own; repeated rows are judged alike and all stay or go."""
    ship(spark)
    return quality.drop_rejected(docs, quality.fit(docs, table(spark, sf_dir, "labels"))).select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that too many documents of their source hold. No document goes: one of which
    nothing is left keeps the empty text. Null texts stay null, null sources are one source, and ``n_chars`` is
    counted anew (null for null texts). Repeated rows count as documents of their own."""
    ship(spark)
    cleaned = line_dedup.clean(docs.select(*COLUMNS), F.col("source"))
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the least id. Documents without words (null and empty
    texts among them) and documents with a null id all stay; of repeated rows one stays; if an id repeats with
    different texts, each row is judged by its own."""
    ship(spark)
    return near_dup.drop_near_duplicates(docs.select(*COLUMNS))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items. Null and empty texts stay; repeated rows stay
    or go together; an empty benchmark drops nothing."""
    ship(spark)
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document row, as a count and digests of ids and decoded bytes. A null text counts as
    empty and has no ids; null and repeated ids are kept."""
    ship(spark)
    found = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("byte-level BPE", tokens),
]

#: The classifier, the signatures and the tokenizer cannot be said in SQL. Tests hold the stages against the operators, which
#: have tests of their own; the quality stage against the labels of made documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's table is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(gone)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}")
    return docs
