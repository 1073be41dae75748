"""The programs: build the indexes of a folder, answer the questions of a file, merge runs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import AUTO, Chunking, CleanRules, Hybrid, Rerank, Retriever
from quern.functions.plan import once
from quern.functions.text import stem
from quern.operators import merge, normalize, questions
from quern.plans import corpus
from quern.plugins import Answerer, Embedder, PageParser, QuestionRewriter, Scorer, extractive_answer, overlap_score, rewrite_by_rule
from quern.session import durable
from quern.sources import files, parsed, pdf_tables, sinks, workbooks


@dataclass(frozen=True)
class Build:
    """What a build does; what is skipped is taken from an earlier one."""

    parse_files: bool = True
    parse_workbooks: bool = True
    index: bool = True
    tables: bool = False  # tables of PDF files as one more page of each
    again: bool = False  # parse files anew whose parse is up to date
    files_per_batch: int = 10_000  # files after whose parse the result is written
    glob: str = "*.pdf"


def require(spark: SparkSession, *paths: str) -> None:
    """Raises if one of the paths is missing, before any work is done."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        p = hadoop.Path(path)
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            raise FileNotFoundError(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def parse_new(spark: SparkSession, source: str, out: str, what: Build = Build(), parser: PageParser = files.parse_document, **parsing) -> list[str]:
    """Parses the files of a folder that have no good parse in ``out`` yet: new and changed ones, and those whose parse
    failed, broke off or lacks pages. Results are added batch by batch, so a run that is stopped is gone on with by the
    next; readers take the newest parse of a file. Gives the paths that were parsed."""
    listed = durable(parsed.list_files(spark, source, what.glob).select(F.col("path").alias("name"), "changed_at"))
    wanted = listed if what.again or not exists(spark, out) else parsed.to_parse(listed, parsed.parse_cache(spark, out))
    paths = sorted(r.name for r in wanted.select("name").collect())
    for at in range(0, len(paths), what.files_per_batch):
        escaped = [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths[at : at + what.files_per_batch]]
        contents = files.read_contents(spark, escaped, what.glob)
        documents = files.as_v2(files.parse_contents(contents, parser, **parsing))
        if what.tables:
            found = pdf_tables.tables_by_file(contents, parsing.get("max_pages"))
            documents = normalize.append_tables(documents, found.select(stem("path").alias("stem"), "markdown"))
        sinks.write_parsed(documents, out, more=True)
    return paths


def build(
    spark: SparkSession, source: str, out: str, what: Build = Build(), parser: PageParser = files.parse_document, chunking: Chunking = AUTO,
    rules: CleanRules = CleanRules(), embed: Embedder | None = None, hybrid: Hybrid = Hybrid(), **parsing,
) -> dict[str, DataFrame]:
    """Parses ``source`` to ``out``/parsed, indexes that to ``out``/index, and gives the index."""
    require(spark, source)
    if what.parse_files:
        parse_new(spark, source, f"{out}/parsed/files", what, parser, **parsing)
    if what.parse_workbooks:
        sinks.write_parsed(files.as_v2(workbooks.parse_workbooks(spark, source)), f"{out}/parsed/workbooks")
    if what.index:
        documents = parsed.latest_parsed(spark, f"{out}/parsed/*")
        sinks.save_index(corpus.build_index(documents, chunking, rules, embed, hybrid), f"{out}/index")
    return sinks.load_index(spark, f"{out}/index")


def answer_file(
    spark: SparkSession, index: str, asked: str, out: str, cfg: Retriever = Retriever(unique_by_page=False, top_k=20), rerank: Rerank = Rerank(pre_k=100, dense=0.15, llm=0.85),
    rewrite: QuestionRewriter | None = rewrite_by_rule, embed: Embedder | None = None, score: Scorer = overlap_score, answerer: Answerer = extractive_answer,
) -> DataFrame:
    """Answers the questions of a file from an index, writes them, and gives them.

    Questions may be rewritten before the search. All are answered in one plan, in parallel; the output keeps their order."""
    require(spark, index, asked)
    wanted = parsed.read_questions(spark, asked)
    if rewrite is not None:
        new = questions.augment(once(wanted, "_new", rewrite(F.col("question"))), F.col("_new"))
        wanted = new.select("qid", F.col("augmented").alias("question"), "answer_type")
    wanted = durable(wanted)
    tables = sinks.load_index(spark, index)
    hits = durable(corpus.search(tables, wanted, cfg, rerank, embed, score))
    found = corpus.answer(hits, wanted, answerer)
    chunk = F.struct(F.col("doc").alias("document_name"), F.col("page").cast("int").alias("page_number"))
    none = F.array().cast("array<struct<document_name:string,page_number:int>>")
    found = durable(found.select("qid", "v", F.when(F.col("doc").isNotNull(), F.array(chunk)).otherwise(none).alias("relevant_chunks")))
    sinks.write_answers(found.orderBy("qid"), out)
    return found


def merge_files(spark: SparkSession, base: str, runs: list[str], out: str) -> tuple[DataFrame, DataFrame]:
    """Merges answer files into those of ``base``; writes answers and changes."""
    require(spark, base)
    first = parsed.read_answers(spark, base).select("qid", "v")
    merged, changes = merge.merge(first, parsed.read_runs(spark, runs))
    merged, changes = durable(merged), durable(changes)
    sinks.write_changes(merged, changes, out)
    return merged, changes


def augment_workbook(spark: SparkSession, source: str, out: str, rewrite: QuestionRewriter = rewrite_by_rule) -> DataFrame:
    """A copy of a question workbook with its question column rewritten; gives the rows that changed (row, question, augmented)."""
    cells = durable(workbooks.read_table(spark, source))
    first = cells.limit(1).collect()
    titles = list(first[0].cells) if first else []
    if not titles:
        workbooks.write_table(cells.select("row"), out, "row")
        return cells.select("row", F.lit("").alias("question"), F.lit("").alias("augmented")).limit(0)
    name = questions.question_column(titles)
    wide = cells.select("row", *[F.col("cells")[t].alias(t) for t in titles])
    new = durable(questions.augment(once(wide, "_new", rewrite(F.col(f"`{name}`"))), F.col("_new"), f"`{name}`"))
    copy = [F.col("augmented").alias(t) if t == name else F.col(f"`{t}`") for t in titles]
    workbooks.write_table(new.select("row", *copy), out, "row")
    return new.filter("changed").select("row", F.col(f"`{name}`").alias("question"), "augmented")
