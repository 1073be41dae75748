"""The three entry plans: corpus build, question answering, merge of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.config import AUTO, Chunking, CleanRules, Hybrid, Rerank, Retriever
from quern.functions.plan import once
from quern.operators import answers as A
from quern.operators import index, merge, retrieve
from quern.operators import values as V
from quern.operators.chunk import chunk_pages
from quern.operators.normalize import normalize, pages_of
from quern.session import durable
from quern.plugins import Answerer, Embedder, Scorer, extractive_answer, hashed_embedding, overlap_score


def build_index(parsed: DataFrame, cfg: Chunking = AUTO, rules: CleanRules = CleanRules(), embed: Embedder | None = None, hybrid: Hybrid = Hybrid()) -> dict[str, DataFrame]:
    """Parsed documents to chunks, unit vectors, vocabulary and TF-IDF weights."""
    return index_pages(pages_of(normalize(parsed)), cfg, rules, embed, hybrid)


def index_pages(pages: DataFrame, cfg: Chunking = AUTO, rules: CleanRules = CleanRules(), embed: Embedder | None = None, hybrid: Hybrid = Hybrid()) -> dict[str, DataFrame]:
    chunks = durable(chunk_pages(pages, cfg, rules))
    counts = index.term_counts(chunks)
    vocab = index.vocabulary(counts, chunks, hybrid.max_features)
    vectors = once(chunks, "vector", (embed or hashed_embedding())(F.col("text"))).select("doc", "chunk_id", "vector")
    return {"chunks": chunks, "vectors": vectors, "vocabulary": vocab, "weights": index.tfidf(counts, vocab), "info": chunks.groupBy("doc").agg(F.count("*").alias("chunks"))}


def search(tables: dict[str, DataFrame], questions: DataFrame, cfg: Retriever = Retriever(unique_by_page=False, top_k=20), rerank: Rerank | None = None, embed: Embedder | None = None, score: Scorer = overlap_score) -> DataFrame:
    """Ranked hits (qid, rank, doc, chunk_id, page, text, scores) of questions (qid, question)."""
    depth = max(rerank.pre_k, cfg.top_k) if rerank and rerank.enable else cfg.top_k
    asked = once(questions, "vector", (embed or hashed_embedding())(F.col("question"))).select("qid", "vector")
    dense = retrieve.dense_top_k(tables["vectors"], asked, depth)
    dense = durable(dense) if cfg.hybrid.enable else dense
    lexical = None
    if cfg.hybrid.enable:  # an index without weights has them worked out for the candidates' chunks
        weights = tables["weights"] if "weights" in tables else index.tfidf_of(tables["chunks"], dense, tables["vocabulary"])
        lexical = index.cosine(weights, index.query_weights(questions, tables["vocabulary"]), dense)
    hits = retrieve.hybrid(dense, lexical, cfg.hybrid)
    hits = retrieve.top_k(hits, depth).drop("rank")
    full = hits.join(tables["chunks"].select("doc", "chunk_id", "page", "text"), ["doc", "chunk_id"]).join(questions.select("qid", "question"), "qid")
    ranked = retrieve.rerank(full, score(F.col("question"), F.col("text")), rerank, cfg.top_k) if rerank and rerank.enable else retrieve.top_k(full, cfg.top_k)
    return retrieve.unique_by_page(ranked) if cfg.unique_by_page else ranked


def answer(hits: DataFrame, questions: DataFrame, answerer: Answerer = extractive_answer, max_chunks: int = 10) -> DataFrame:
    """(qid, v, support, doc, page) for every question, in the question's type; the supporting
    hit is the answerer's, else the first that holds the answer."""
    top = hits.filter(F.col("rank") <= max_chunks).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("h"))
    asked = questions.join(top, "qid", "left").withColumn("h", F.coalesce("h", F.array().cast("array<struct<rank:int,text:string>>")))
    replied = once(asked, "r", answerer(F.col("question"), F.col("answer_type"), F.col("h")))
    typed = once(replied, "v", A.default_answer(V.coerce_answer(F.col("r.answer"), F.col("answer_type")), F.col("answer_type"))).select("qid", F.size("h").alias("n"), "v", F.col("r.support").alias("said"))
    guessed = A.support_literal(hits.filter(F.col("rank") <= max_chunks), typed.filter(F.col("v.kind") != "null"))
    joined = typed.join(guessed.withColumnRenamed("support", "guess"), "qid", "left")
    supported = joined.select("qid", "v", F.coalesce(A.clamp_support(F.col("said"), F.col("n"), max_chunks), "guess").alias("support"))
    return A.relevant_chunks(supported, hits)


def merge_runs(base: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    return merge.merge(base, runs)
