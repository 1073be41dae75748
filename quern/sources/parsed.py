"""Scans of parsed documents, questions, answers and run folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import schema
from quern.operators import values as V
from quern.operators.questions import REQUIRED, checked
from quern.sources.workbooks import read_table


def read_parsed(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Documents of either form, one JSON object a file, or one a line as :func:`write_parsed` writes
    them; broken ones give null rows."""
    return spark.read.schema(schema.PARSED_ANY).option("multiLine", not lines).option("mode", "PERMISSIVE").json(path)


def latest_parsed(spark: SparkSession, path: str) -> DataFrame:
    """Of documents in several runs' files (one a line) the newest of each source, with the time of its file as ``cached_at``."""
    rows = spark.read.schema(schema.PARSED_ANY).option("mode", "PERMISSIVE").json(path).select("*", F.col("_metadata.file_modification_time").alias("cached_at"))
    key = F.coalesce("source_path", "metainfo.source_path")
    newest = rows.groupBy(key.alias("_of")).agg(F.max("cached_at").alias("_newest"))
    return rows.withColumn("_source", key).join(newest, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("cached_at") == F.col("_newest"))).drop("_source", "_of", "_newest")


def parse_cache(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`cache_decisions` asks of parsed documents, by source path."""
    rows = latest_parsed(spark, path).filter("source_path is not null")
    return rows.select(F.col("source_path").alias("name"), "cached_at", "error", "interrupted", "num_pages", F.size("content").alias("n_content"), F.lit(True).alias("readable"))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """(qid, relevant_chunks, v) of a file with a JSON array of answer records, or of a folder
    with one a line as :func:`write_answers` writes them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    folder = len(found) == 1 and found[0].isDirectory()
    rows = spark.read.schema(schema.ANSWER).option("multiLine", not folder).json(path)
    return rows.select(F.col("question_id").alias("qid"), "relevant_chunks", V.from_variant("answer").alias("v"))


def read_runs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(qid, run, v) of several answer files, run from 1 in the given order; rows without an
    integer id are left out, and so are files that are missing or no JSON."""
    out = None
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for k, path in enumerate(paths, 1):
        p = hadoop.Path(path)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            rows = read_answers(spark, path).filter(F.col("qid").isNotNull()).select("qid", F.lit(k).alias("run"), "v")
            out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], f"qid bigint, run int, v {schema.VALUE}") if out is None else out


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Questions from CSV or a workbook (by suffix) or JSON, header names in any case."""
    if path.lower().endswith(".xlsx"):
        cells = read_table(spark, path)
        first = cells.limit(1).collect()
        titles = list(first[0].cells) if first else list(REQUIRED)
        return checked(cells.select(*[F.col("cells")[t].alias(t) for t in titles]))
    rows = spark.read.option("header", True).csv(path) if path.endswith(".csv") else spark.read.option("multiLine", True).json(path)
    return checked(rows)


def read_companies(spark: SparkSession, path: str, column: str = "company_name") -> DataFrame:
    """Company names of a CSV, as :func:`quern.operators.questions.company_mentions` takes them."""
    rows = spark.read.option("header", True).csv(path)
    name = column if column in rows.columns else rows.columns[0]
    return rows.select(F.col(f"`{name}`").alias("company")).filter("company is not null").distinct()


def cache_reason(cached: Column | None = None) -> Column:
    """Why a parse cache row (error, interrupted, num_pages, n_content, cached_at, changed_at,
    readable) can't be used, or that it can."""
    return (
        F.when(F.col("cached_at").isNull(), "no cache").when(~F.coalesce("readable", F.lit(True)), "bad json").when(F.coalesce(F.length("error"), F.lit(0)) > 0, "has error")
        .when(F.coalesce("interrupted", F.lit(False)), "interrupted").when(F.col("n_content").isNull() | ((F.coalesce("num_pages", F.lit(0)) != 0) & (F.col("n_content") != F.col("num_pages"))), "incomplete content")
        .when(F.col("cached_at") < F.col("changed_at"), "outdated").otherwise("cached up-to-date")
    )


def cache_decisions(sources: DataFrame, parsed: DataFrame) -> DataFrame:
    """(name, reason, ok) of each source (name, changed_at) against parsed rows by name."""
    joined = sources.join(parsed, "name", "left").withColumn("reason", cache_reason())
    return joined.select("name", "reason", (F.col("reason") == "cached up-to-date").alias("ok"))


def to_parse(sources: DataFrame, parsed: DataFrame) -> DataFrame:
    """The sources that have to be parsed again."""
    return sources.join(cache_decisions(sources, parsed).filter("ok").select("name"), "name", "left_anti")


def list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(name, path, changed_at) of files, dot and lock files left out; no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(name.alias("name"), "path", F.col("modificationTime").alias("changed_at")).filter(~F.col("name").rlike(r"^(\.|~\$)"))


def locate(hits: DataFrame, files: DataFrame) -> DataFrame:
    """(qid, path) of the file behind each question's best hit that has one: exact name first,
    then a name that starts alike; ties by path."""
    f = files.select(F.lower(F.regexp_replace("name", r"\.[^.]+$", "")).alias("_stem"), "path")
    asked = hits.select("qid", "rank", F.lower(F.regexp_replace("doc", r"\.(?i:pdf|xlsx)$", "")).alias("_doc"))
    exact = asked.join(f, F.col("_doc") == F.col("_stem")).select("qid", "rank", "path", F.lit(0).alias("how"))
    # stems that start alike: every file under its beginnings of the few lengths that are asked for
    lengths = sorted(r[0] for r in asked.select(F.length("_doc")).distinct().collect() if r[0] is not None)
    shorter = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n < F.length("_stem"))
    begun = f.select("path", F.explode(F.transform(shorter, lambda n: F.left("_stem", n))).alias("_doc"))
    like = asked.join(begun, "_doc").select("qid", "rank", "path", F.lit(1).alias("how"))
    return exact.union(like).groupBy("qid").agg(F.min_by("path", F.struct("rank", "how", "path")).alias("path"))
