"""Writers. Each writes a folder; none collects rows to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import values as V


def write_parsed(docs: DataFrame, path: str, more: bool = False) -> None:
    """One document a line; with ``more`` beside those that are there."""
    docs.write.mode("append" if more else "overwrite").json(path)


def write_index(df: DataFrame, path: str) -> None:
    """A table of an index, one folder for each document, so that questions to one document read one."""
    df.write.mode("overwrite").partitionBy("doc").parquet(path)


#: Tables of an index.
INDEX = ("chunks", "vectors", "vocabulary", "weights", "info")


def save_index(tables: dict[str, DataFrame], path: str) -> None:
    """All tables of an index under one folder."""
    for name in INDEX:
        write_index(tables[name], f"{path}/{name}")


def load_index(spark: SparkSession, path: str, docs: list[str] | None = None, keep: bool = False) -> dict[str, DataFrame]:
    """The tables of an index, or only those of some documents, whose folders alone are read. ``keep``
    caches them in the executors, for many questions one after the other."""
    out = {}
    for name in INDEX:
        df = spark.read.parquet(f"{path}/{name}")
        df = df.withColumn("doc", F.col("doc").cast("string"))
        out[name] = df if docs is None else df.filter(F.col("doc").isin(docs))
        out[name] = out[name].cache() if keep else out[name]
    return out


def answer_json(v: Column) -> Column:
    return V.to_variant(v)


def write_answers(answers: DataFrame, path: str) -> None:
    """Answers (qid, v, relevant_chunks) as JSON lines."""
    chunks = F.col("relevant_chunks") if "relevant_chunks" in answers.columns else F.array().cast("array<struct<document_name:string,page_number:int>>")
    answers.select(F.col("qid").alias("question_id"), chunks.alias("relevant_chunks"), answer_json(F.col("v")).alias("answer")).write.mode("overwrite").json(path)


def repair_answers(answers: DataFrame) -> DataFrame:
    """Answers with numeric strings turned into numbers."""
    return answers.withColumn("v", V.repair_number(F.col("v")))


def write_changes(merged: DataFrame, changes: DataFrame, path: str) -> None:
    write_answers(merged, f"{path}/answers")
    show = changes.select("qid", V.to_variant(F.col("original")).alias("original_answer"), F.transform("candidates", V.to_variant).alias("candidates"), V.to_variant(F.col("selected")).alias("selected_answer"), "reason", "frequency", "combination", "unique_count", "original_type", "coerced_type")
    show.write.mode("overwrite").json(f"{path}/changes")


def write_markdown(tables: DataFrame, path: str) -> None:
    tables.select("stem", "markdown").write.mode("overwrite").partitionBy("stem").text(path)


def write_debug(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
