"""Top-k retrieval: dense, hybrid, reranked. All questions in one plan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.config import Hybrid, Rerank
from quern.session import durable, small

#: Questions that go to a task at once, vectors that it reads at once, and questions of one matrix product.
MAX_QUERIES, VECTOR_BLOCK, QUERY_BLOCK = 20_000, 16_384, 128
#: Chunks whose words are compared with the questions' at once, and numbers (chunks by questions) that are ranked at once.
WORD_BLOCK, CELLS = 1024, 1 << 22
#: Rows of best chunks that a task holds.
HELD = 1 << 20
#: Digits of a score that decide on a rank; sums over a shuffle may differ in the last ones.
DIGITS = 9


def rank_by(keys: list[str], *order: Column | str) -> Column:
    return F.row_number().over(W.partitionBy(*keys).orderBy(*order))


class Held:
    """Of rows (q, doc, chunk_id, dense) the ``k`` best of each question and document so far, ties to the smaller chunk.

    What a task passes on grows with its questions and documents then, not with its blocks. More than HELD rows that are
    all among the best are passed on at once."""

    def __init__(self, k: int, names: list[str]):
        self.k, self.names, self.codes, self.docs = k, names, {}, []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def code(self, doc: pa.Array) -> np.ndarray:
        """Numbers of documents, the same for all blocks of a task."""
        found = doc.dictionary_encode(null_encoding="encode")
        for x in found.dictionary.to_pylist():
            if x not in self.codes:
                self.codes[x] = len(self.docs)
                self.docs.append(x)
        self.kind = doc.type
        return np.array([self.codes[x] for x in found.dictionary.to_pylist()], np.int64)[found.indices.to_numpy()]

    def add(self, q: np.ndarray, code: np.ndarray, chunk: np.ndarray, dense: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((q, code, chunk, dense))
        self.n += len(q)
        if self.n > HELD:
            self._prune()
            if self.n > HELD // 2:
                yield from self.rest()

    def _prune(self) -> None:
        q, code, chunk, dense = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((chunk, -dense, code, q))
        new = np.flatnonzero(np.append(True, (np.diff(q[order]) != 0) | (np.diff(code[order]) != 0)))
        place = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
        top = order[place < self.k]
        self.parts, self.n = [(q[top], code[top], chunk[top], dense[top])], len(top)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            self._prune()
            q, code, chunk, dense = self.parts[0]
            docs = pa.array(self.docs, self.kind)
            for at in range(0, len(q), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(q[cut]), docs.take(pa.array(code[cut])), pa.array(chunk[cut]), pa.array(dense[cut])], self.names)
        self.parts, self.n = [], 0


def _by_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _groups(code: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(code, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(code[order])) + 1)


def _best(k: int, qids: np.ndarray, qv: np.ndarray):
    """(q, doc, chunk_id, dense): the ``k`` best chunks of each document for each question, by blocks of vectors."""
    def block(rows: pa.Table, held: Held) -> Iterator[pa.RecordBatch]:
        v = rows.column("vector").combine_chunks().flatten().to_numpy().astype(float).reshape(rows.num_rows, -1)
        chunk = rows.column("chunk_id").to_numpy()
        code = held.code(rows.column("doc").combine_chunks())
        for mine in _groups(code):
            for at in range(0, len(qv), QUERY_BLOCK):
                q = qv[at : at + QUERY_BLOCK]
                s = q @ v[mine].T
                n = min(k, len(mine))
                edge = np.partition(s, len(mine) - n, axis=1)[:, -n][:, None]
                # single sums may differ in the last bits: what can't be told from the last is added up again, part by part
                r, c = np.nonzero(s >= edge - 1e-9 * np.maximum(1, np.abs(edge)))
                exact = np.zeros(len(r))
                for j in range(v.shape[1]):
                    exact += q[r, j] * v[mine[c], j]
                yield from held.add(qids[at + r], code[mine[c]], chunk[mine[c]], exact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(k, ["q", "doc", "chunk_id", "dense"])
        for rows in _by_blocks(batches, VECTOR_BLOCK):
            yield from block(rows, held)
        yield from held.rest()

    return run


def dense_top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(qid, doc, chunk_id, dense): of each document the ``k`` chunks with the largest inner product, ties to
    the smaller chunk.

    Questions go to the tasks as matrices of MAX_QUERIES rows at most, so they stay small however many there are. A
    task multiplies blocks of vectors with them and keeps its best ``k`` of each document and question, so
    pairs never become rows; a window over those decides."""
    asked = durable(queries.select("qid", "vector").withColumn("_n", F.monotonically_increasing_id()))
    n = asked.count()
    blocks = max(1, -(-n // MAX_QUERIES))
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    out = None
    for b in range(blocks):
        q = asked.filter(F.pmod(F.xxhash64("_n"), F.lit(blocks)) == b).select("_n", F.col("vector").cast("array<double>").alias("vector")).orderBy("_n").toArrow()
        qv = q.column("vector").combine_chunks().flatten().to_numpy().reshape(max(1, q.num_rows), -1)[: q.num_rows]
        best = _best(k, q.column("_n").to_numpy(), qv)
        found = vectors.select("doc", "chunk_id", "vector").mapInArrow(best, f"q bigint, doc {kinds['doc']}, chunk_id {kinds['chunk_id']}, dense double")
        top = found.withColumn("_r", rank_by(["q", "doc"], F.desc("dense"), "chunk_id")).filter(F.col("_r") <= k).drop("_r")
        out = top if out is None else out.unionByName(top)
    names = asked.select("qid", F.col("_n").alias("q"))
    return out.join(small(names), "q").select("qid", "doc", "chunk_id", "dense")


def _shared(k: int, names: np.ndarray, terms: pa.Array, owner: np.ndarray, first: np.ndarray, sizes: np.ndarray):
    """(_n, doc, chunk_id, dense) of a block: of each document and question the ``k`` chunks that hold most of its words.

    Question q has the number ``names[q]`` and ``sizes[q]`` words. Question words are numbered; the questions of word w are ``owner[first[w] : first[w + 1]]``."""
    def shared(words: pa.ListArray) -> np.ndarray:
        """How many of each question's words each row has."""
        row = words.value_parent_indices().to_numpy()
        number = pc.index_in(words.flatten(), terms).fill_null(-1).to_numpy()
        row, number = row[number >= 0], number[number >= 0]
        times = first[number + 1] - first[number]
        at = np.repeat(first[number] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        return np.bincount(np.repeat(row, times) * len(sizes) + owner[at], minlength=len(words) * len(sizes)).reshape(-1, len(sizes))

    def block(rows: pa.Table, held: Held) -> Iterator[pa.RecordBatch]:
        words = rows.column("terms").combine_chunks()
        n = np.concatenate([shared(words.slice(at, WORD_BLOCK)).astype(np.int32) for at in range(0, len(words), WORD_BLOCK)])
        chunk = rows.column("chunk_id").to_numpy()
        code = held.code(rows.column("doc").combine_chunks())
        for mine in _groups(code):
            mine = mine[np.argsort(chunk[mine], kind="stable")]
            # more words first, then smaller chunks; no two are equal
            key = n[mine].T.astype(np.int64) * len(mine) - np.arange(len(mine))
            best = np.argpartition(-key, k, axis=1)[:, :k] if len(mine) > k else np.broadcast_to(np.arange(len(mine)), key.shape)
            q, r = np.repeat(np.arange(len(best)), best.shape[1]), mine[best.ravel()]
            some = n[r, q] > 0
            q, r = q[some], r[some]
            yield from held.add(names[q], code[r], chunk[r], n[r, q] / sizes[q])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(k, ["_n", "doc", "chunk_id", "dense"])
        for rows in _by_blocks(batches, max(1, min(VECTOR_BLOCK, CELLS // max(1, len(sizes))))):
            if len(sizes):
                yield from block(rows, held)
        yield from held.rest()

    return run


def shared_words_top_k(chunks: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """(qid, doc, chunk_id, dense): of each document the ``k`` chunks with the largest share of a question's distinct
    words, ties to the smaller chunk; chunks without any of them don't count.

    ``chunks`` is (doc, chunk_id, terms), ``questions`` (qid, words), both without repeats in a row. As in
    :func:`dense_top_k`, MAX_QUERIES questions at most go to the tasks at once; each task scores its blocks of chunks with them
    and passes on its ``k`` best of a document and question, so pairs are neither joined nor shuffled."""
    asked = durable(questions.filter(F.size("words") > 0).withColumn("_n", F.monotonically_increasing_id()))
    blocks = max(1, -(-asked.count() // MAX_QUERIES))
    kinds = {f.name: f.dataType.simpleString() for f in chunks.schema}
    out = None
    for b in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("_n"), F.lit(blocks)) == b).select("_n", "words").orderBy("_n").toArrow()
        words = mine.column("words").combine_chunks()
        coded = words.flatten().dictionary_encode()
        order = np.argsort(coded.indices.to_numpy(), kind="stable")
        number = coded.indices.to_numpy()[order]
        owner = words.value_parent_indices().to_numpy()[order]
        first = np.searchsorted(number, np.arange(len(coded.dictionary) + 1))
        sizes = pc.list_value_length(words).to_numpy()
        schema = f"_n bigint, doc {kinds['doc']}, chunk_id {kinds['chunk_id']}, dense double"
        found = chunks.select("doc", "chunk_id", "terms").mapInArrow(_shared(k, mine.column("_n").to_numpy(), coded.dictionary, owner, first, sizes), schema)
        top = found.withColumn("_r", rank_by(["_n", "doc"], F.desc("dense"), "chunk_id")).filter(F.col("_r") <= k).drop("_r")
        out = top if out is None else out.unionByName(top)
    return out.join(small(asked.select("qid", "_n")), "_n").select("qid", "doc", "chunk_id", "dense")


def hybrid(candidates: DataFrame, lexical: DataFrame | None, cfg: Hybrid = Hybrid()) -> DataFrame:
    """With ``lex`` and ``score``: lexical scores re-weigh the dense candidates, they add none."""
    if lexical is None or not cfg.enable:
        return candidates.withColumn("lex", F.lit(None).cast("double")).withColumn("score", F.col("dense"))
    joined = candidates.join(lexical, ["qid", "doc", "chunk_id"], "left").withColumn("lex", F.coalesce("lex", F.lit(0.0)))
    return joined.withColumn("score", cfg.dense * F.col("dense") + cfg.lexical * F.col("lex"))


def top_k(hits: DataFrame, k: int, score: str = "score") -> DataFrame:
    """The ``k`` best hits of each question with ``rank`` from 1; ties by document and chunk."""
    return hits.withColumn("rank", rank_by(["qid"], F.round(score, DIGITS).desc(), "doc", "chunk_id")).filter(F.col("rank") <= k)


def rerank(hits: DataFrame, scorer: Column, cfg: Rerank, k: int) -> DataFrame:
    """Cut to ``pre_k``, score the rest with ``scorer`` (0 to 1), blend and cut to ``k``.

    The cut is a stage of its own, so the costly scorer sees ``pre_k`` rows a question at most."""
    if not cfg.enable:
        return top_k(hits, k)
    cut = top_k(hits, cfg.pre_k).drop("rank").withColumn("llm", F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scorer)), F.lit(0.0)))
    return top_k(cut.withColumn("final", cfg.dense * F.col("score") + cfg.llm * F.col("llm")), k, "final")


def unique_by_page(hits: DataFrame) -> DataFrame:
    """The best hit of each page, after the cut, so there may be fewer; ranks are kept."""
    return hits.withColumn("_r", rank_by(["qid", "doc", "page"], "rank")).filter(F.col("_r") == 1).drop("_r")


def model_score(reply: Column) -> Column:
    """The first number of a scorer's reply, within 0 and 1; 0 if there is none."""
    number = F.regexp_extract(F.coalesce(reply, F.lit("")), r"[-+]?\d*\.?\d+", 0).try_cast("double")
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number)), F.lit(0.0))
