"""The vocabulary cut and the search by shared words against plain loops."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.config import Hybrid
from quern.operators import index, retrieve


def texts(seed, docs=3, chunks=40, words=60):
    rng = random.Random(seed)
    return [(f"d{d}", c, [f"w{min(rng.randrange(words), rng.randrange(words))}" for _ in range(rng.randrange(12))]) for d in range(docs) for c in range(chunks if d else 4 * chunks)]


@pytest.mark.parametrize("most", [1, 7, 23, 1000])
def test_vocabulary_cut(spark, most):
    rows = texts(1)
    chunks = spark.createDataFrame([(d, c, " ".join(w)) for d, c, w in rows], "doc string, chunk_id int, text string").repartition(5)
    want = set()
    for doc in {d for d, _, _ in rows}:
        total = Counter(x for d, _, w in rows if d == doc for x in w)
        want |= {(doc, t) for t in sorted(total, key=lambda t: (-total[t], t))[:most]}
    found = index.vocabulary(index.term_counts(chunks), chunks, most)
    got = [(r.doc, r.term) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_vocabulary_is_whole_by_default(spark):
    counts = spark.range(200_003).select(F.lit("d").alias("doc"), F.lit(0).alias("chunk_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"), F.lit(1).alias("tf"))
    chunks = spark.createDataFrame([("d", 0)], "doc string, chunk_id int")
    assert index.vocabulary(counts, chunks).count() == 200_003
    assert Hybrid().max_features is None


def test_vocabulary_cut_sorts_no_whole_document(spark):
    """The terms of one document at the edge are put in order by several tasks."""
    df = spark.range(5000).select(F.lit("d").alias("doc"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"), F.lit(1).alias("df"), F.when(F.col("id") < 10, 2).otherwise(1).alias("total"))
    found = index.most_frequent(df, 1000)
    want = {f"t{k}" for k in range(10)} | set(sorted(f"t{k}" for k in range(10, 5000))[:990])
    assert {r.term for r in found.collect()} == want


@pytest.mark.parametrize("blocks", [1, 3])
def test_shared_words(spark, monkeypatch, blocks):
    rows = texts(2)
    asked = [(q, sorted({f"w{random.Random(q).randrange(60 + q)}" for _ in range(q)} | {f"w{q}"} if q else set())) for q in range(9)]
    monkeypatch.setattr(retrieve, "MAX_QUERIES", -(-8 // blocks))
    monkeypatch.setattr(retrieve, "WORD_BLOCK", 16)
    chunks = spark.createDataFrame([(d, c, sorted(set(w))) for d, c, w in rows], "doc string, chunk_id int, terms array<string>").repartition(4)
    found = retrieve.shared_words_top_k(chunks, spark.createDataFrame(asked, "qid bigint, words array<string>"), 5)
    got = {(r.qid, r.doc, r.chunk_id, r.dense) for r in found.collect()}
    want = set()
    for q, words in asked:
        for doc in {d for d, _, _ in rows}:
            scored = [(-len(set(words) & set(w)) / len(words), c) for d, c, w in rows if d == doc and set(words) & set(w)]
            want |= {(q, doc, c, -s) for s, c in sorted(scored)[:5]}
    assert got == want


def test_shared_words_of_empty_tables(spark):
    chunks = spark.createDataFrame([], "doc string, chunk_id int, terms array<string>")
    asked = spark.createDataFrame([(1, ["a"]), (2, [])], "qid bigint, words array<string>")
    assert retrieve.shared_words_top_k(chunks, asked, 3).count() == 0
    assert retrieve.shared_words_top_k(spark.createDataFrame([("d", 1, ["a"])], chunks.schema), asked.limit(0), 3).count() == 0


def test_tasks_pass_on_their_best_chunks_once(spark):
    """However many blocks of chunks a task reads, it passes on ``k`` rows of a question and document."""
    import numpy as np
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"doc": ["a", "b", None, "a"] * 250, "chunk_id": list(range(1000)), "terms": [["x"] if c % 3 else ["x", "y"] for c in range(1000)]})
    run = retrieve._shared(2, np.array([7]), pa.array(["x", "y"]), np.array([0, 0]), np.array([0, 1, 2]), np.array([2]))
    old, retrieve.VECTOR_BLOCK = retrieve.VECTOR_BLOCK, 100
    try:
        got = [r for b in run(iter([rows.slice(at, 50) for at in range(0, 1000, 50)])) for r in b.to_pylist()]
    finally:
        retrieve.VECTOR_BLOCK = old
    best = {d: sorted((-1.0 if c % 3 == 0 else -0.5, c) for c in range(1000) if ("a", "b", None, "a")[c % 4] == d)[:2] for d in ("a", "b", None)}
    assert sorted((str(r["doc"]), -r["dense"], r["chunk_id"]) for r in got) == sorted((str(d), *x) for d, xs in best.items() for x in xs)


def test_cosine_totals_equal_the_sums_of_pairs(spark, monkeypatch):
    rows = texts(3)
    chunks = spark.createDataFrame([(d, c, " ".join(w)) for d, c, w in rows], "doc string, chunk_id int, text string").repartition(3)
    asked = spark.createDataFrame([(q, " ".join(f"w{(q * k) % 70}" for k in range(q + 1))) for q in range(6)], "qid bigint, question string")
    counts = index.term_counts(chunks)
    vocab = index.vocabulary(counts, chunks)
    q = index.query_weights(asked, vocab)
    pairs = index.cosine(index.tfidf(counts, vocab), q).groupBy("qid", "doc").agg(F.count("*").alias("n"), F.sum("lex").alias("total"), F.max("lex").alias("best"))
    want = {(r.qid, r.doc): (r.n, round(r.total, 9), round(r.best, 9)) for r in pairs.collect()}
    monkeypatch.setattr(index, "TOTAL_ROWS", 16)
    got = {(r.qid, r.doc): (r.n, round(r.total, 9), round(r.best, 9)) for r in index.cosine_totals(counts, vocab, q).collect()}
    assert got == want and len(got) > 10
