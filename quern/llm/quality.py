"""Document quality by co-training two views.

One classifier sees the text's content (hashed byte 4-grams and how much repeats), the
other its metadata (language, source, recorded length and page layout). In each
round both score the whole corpus, and each hands the documents it is surest of, with its own
verdict as label, to the other. At last the views are calibrated and combined on
out-of-fold predictions of the labelled rows, and all documents are scored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.llm.linear import fit_logistic, logit, out_of_fold, predict
from quern.llm.tables import durable, pieces, text_bytes
from quern.llm.words import U64, hashes

#: Labelled rows used at most; documents that a view hands over for each class and round; rounds.
MAX_LABELLED, EXCHANGE, ROUNDS = 6_000, 300, 2
#: A view hands over only documents whose probability is this near to 0 or 1.
CONFIDENT = 0.05
GRAMS, LANGS, SOURCES = 1024, 16, 64
#: Rows whose features are held as one dense matrix.
VIEW_ROWS = 1024
FOLDS, STEPS, L2_TEXT, L2_META = 5, 300, 3e-5, 3e-5
#: A document is kept if its score reaches the cut: at most one half, and low enough (but not
#: under the second number) to keep this share of the labelled good documents out of fold.
CUT, LEAST_CUT, KEEP_GOOD = 0.5, 0.1, 0.998

_CLASSES = np.zeros(256, np.int64)  # byte classes of the layout: letters, capitals, digits, blanks, other ASCII, above ASCII
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = 5 if _b > 127 else 1 if "A" <= _c <= "Z" else 0 if "a" <= _c <= "z" else 2 if "0" <= _c <= "9" else 3 if _c in " \t\r\n" else 4


def _row_of(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[new], minlength=n)


def text_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Content features of each row: L2-normed log counts of 4-grams, and repetition shares."""
    n = len(offsets) - 1
    base = int(offsets[0])
    d, o = data[base : int(offsets[-1])].astype(np.uint32), offsets - base
    x = np.zeros((n, GRAMS), np.float32)
    if len(d) >= 4:
        key = d[:-3] | (d[1:-2] << 8) | (d[2:-1] << 16) | (d[3:] << 24)
        key = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - 10)
        row = _row_of(o)[: len(key)]
        inside = o[1:][row] - np.arange(len(key)) >= 4
        x += np.bincount(row[inside] * GRAMS + key[inside], minlength=n * GRAMS).reshape(n, GRAMS)
    filled = (x > 0).sum(1)
    x = np.log1p(x)
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-6)
    word, b = hashes(data, offsets)
    count = np.diff(b)
    row = _row_of(b)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    unique = _distinct(row, word, n)
    size = np.diff(o)
    many = np.maximum(count, 1)
    stats = np.column_stack([
        unique / many,
        np.log1p(count) - np.log1p(unique),
        np.bincount(row[same], minlength=n) / many,
        filled / np.maximum(1, np.minimum(size, GRAMS)),
        np.log1p(np.maximum(0, np.log1p(count) - 1.3 * np.log1p(unique))),
    ])
    return np.column_stack([3 * x, stats.astype(np.float32)]).astype(np.float32)


def meta_view(data: np.ndarray, offsets: np.ndarray, lang: list, source: list, n_chars: list) -> np.ndarray:
    """Metadata features of each row; null values have slots of their own."""
    n = len(offsets) - 1
    base = int(offsets[0])
    d, o = data[base : int(offsets[-1])], offsets - base
    size = np.maximum(np.diff(o), 1)
    row = _row_of(o)
    kinds = np.bincount(row * 6 + _CLASSES[d], minlength=n * 6).reshape(n, 6) / size[:, None]
    breaks = np.bincount(row[d == 10], minlength=n)
    known = np.array([-1 if c is None else c for c in n_chars], float)
    out = np.zeros((n, LANGS + SOURCES), np.float32)
    for slots, first, values in ((LANGS, 0, lang), (SOURCES, LANGS, source)):
        for i, v in enumerate(values):
            raw = np.frombuffer(("\0" if v is None else str(v) + "\1").encode(), np.uint8)
            h = 0
            for byte in raw.tolist():
                h = (h * 1000003 ^ byte) & 0xFFFFFFFF
            out[i, first + (h >> 7) % slots] = 0.5
    stats = np.column_stack([3 * kinds, 10 * np.minimum(kinds[:, 4], 0.1), 10 * np.minimum(kinds[:, 1], 0.1), np.log1p(np.maximum(known, 0)) / 10, known < 0, np.log1p(breaks) / 5, np.log1p(size / (breaks + 1)) / 10])
    return np.column_stack([out, stats.astype(np.float32)]).astype(np.float32)


@dataclass
class Views:
    text: np.ndarray
    meta: np.ndarray
    mix: np.ndarray | None = None  # weights of the views' logits, and a bias
    cut: float = CUT

    def score(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t, m = _views(part)
        a, b = predict(t, self.text), predict(m, self.meta)
        both = a if self.mix is None else predict(np.column_stack([logit(a), logit(b)]), self.mix)
        return a, b, both


def _views(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(part.column("text"))
    return text_view(data, offsets), meta_view(data, offsets, *(part.column(c).to_pylist() for c in ("lang", "source", "n_chars")))


def _source(docs: DataFrame) -> DataFrame:
    have = {c.lower() for c in docs.columns}
    meta = [F.col(c).cast(k).alias(c) if c in have else F.lit(None).cast(k).alias(c) for c, k in (("lang", "string"), ("source", "string"), ("n_chars", "bigint"))]
    return docs.select(F.col("doc_id").alias("id"), "text", *meta)


def _sample(source: DataFrame, ids: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Views, label and a fold by text of ``most`` documents at most with the few given (_id, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", rows=VIEW_ROWS):
                t, m = _views(part)
                word, b = hashes(*text_bytes(part.column("text")))
                total = np.concatenate([[U64(0)], np.cumsum(word, dtype=U64)])
                key = (total[b[1:]] - total[b[:-1]]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in t.astype(np.float16)], pa.binary()), pa.array([x.tobytes() for x in m], pa.binary()), pa.array(key), part.column("y")], ["t", "m", "key", "y"])

    got = source.join(F.broadcast(ids), F.col("id") == F.col("_id")).select("text", "lang", "source", "n_chars", F.col("y").cast("double").alias("y"))
    rows = got.mapInArrow(run, "t binary, m binary, key bigint, y double").orderBy(F.xxhash64("key", "m", "y")).limit(most).toArrow()  # as ids may repeat
    key = rows.column("key").to_numpy()
    order = np.lexsort((rows.column("y").to_numpy(), key))
    width_t, width_m = GRAMS + 5, LANGS + SOURCES + 12
    t = np.array([np.frombuffer(x, np.float16) for x in rows.column("t").to_pylist()], np.float32).reshape(-1, width_t)[order]
    m = np.array([np.frombuffer(x, np.float32) for x in rows.column("m").to_pylist()], np.float32).reshape(-1, width_m)[order]
    return t, m, rows.column("y").to_numpy()[order], key[order]


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, exchange: int = EXCHANGE) -> Views:
    """Both views, co-trained over the whole corpus, and their combination.

    The labelled rows are the first ``max_labelled`` by a hash of the id; null labels are left
    out, repeated labels of an id are averaged and rounded. Without labels, or with one
    class, every document gets that class's (or an even) score."""
    source = _source(docs)
    marked = labels.filter(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    picked = durable(marked.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    t, m, y, key = _sample(source, picked, max_labelled)
    fold = (key.view(U64) % U64(FOLDS)).astype(int)
    none = (np.zeros((0, t.shape[1]), np.float32), np.zeros(0)), (np.zeros((0, m.shape[1]), np.float32), np.zeros(0))
    for_text, for_meta = none
    used = picked.select("_id")
    for step in range(rounds + 1):
        views = Views(fit_logistic(np.concatenate([t, for_text[0]]), np.concatenate([y, for_text[1]]), L2_TEXT, STEPS), fit_logistic(np.concatenate([m, for_meta[0]]), np.concatenate([y, for_meta[1]]), L2_META, STEPS))
        if step == rounds or len(np.unique(y)) < 2:
            break
        pool = durable(_scored(source, views).join(F.broadcast(used), F.col("id") == F.col("_id"), "left_anti").filter(F.col("id").isNotNull()).select("id", "p_text", "p_meta"))
        handed = []
        for view, other in (("p_text", "meta"), ("p_meta", "text")):
            for label, order in ((0.0, F.col(view)), (1.0, -F.col(view))):
                sure = pool.filter(F.col(view) <= CONFIDENT) if label == 0 else pool.filter(F.col(view) >= 1 - CONFIDENT)
                top = sure.orderBy(order, F.xxhash64("id"), "id").limit(exchange).select(F.col("id").alias("_id"), F.lit(label).alias("y"), F.lit(other).alias("to"))
                handed.append(top)
        new = handed[0].union(handed[1]).union(handed[2]).union(handed[3])
        new = durable(new)
        # one pass reads all handed documents; what each goes to is in the label: 0/1 to text, 2/3 to meta
        coded = new.select("_id", (F.col("y") + F.when(F.col("to") == "meta", 2).otherwise(0)).alias("y"))
        t_new, m_new, code, _ = _sample(source, coded, 4 * exchange)
        to_meta = code >= 2
        for_text = np.concatenate([for_text[0], t_new[~to_meta]]), np.concatenate([for_text[1], code[~to_meta]])
        for_meta = np.concatenate([for_meta[0], m_new[to_meta]]), np.concatenate([for_meta[1], code[to_meta] - 2])
        used = durable(used.union(new.select("_id")).distinct())
    a = out_of_fold(t, y, fold, L2_TEXT, STEPS, for_text)
    b = out_of_fold(m, y, fold, L2_META, STEPS, for_meta)
    both = np.column_stack([logit(a), logit(b)])
    views.mix = fit_logistic(both, y, 1e-4, 400)
    if (y == 1).any():
        views.cut = float(np.clip(np.quantile(predict(both, views.mix)[y == 1], 1 - KEEP_GOOD), LEAST_CUT, CUT))
    return views


def _scored(source: DataFrame, views: Views, keep: str = "id") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", rows=VIEW_ROWS):
                p = views.score(part)
                yield pa.RecordBatch.from_arrays([part.column(keep), *map(pa.array, p)], [keep, "p_text", "p_meta", "score"])

    kind = source.schema[keep].dataType.simpleString()
    return source.mapInArrow(run, f"{keep} {kind}, p_text double, p_meta double, score double")


def score(docs: DataFrame, views: Views) -> DataFrame:
    """(doc_id, p_text, p_meta, score, keep) of each document row; ``score`` is the combined
    probability of good quality, ``keep`` whether it reaches the cut.

    Null texts count as empty. Repeated rows are scored each. Columns lang, source and
    n_chars may be null or missing; others are not read."""
    return _scored(_source(docs), views).withColumnRenamed("id", "doc_id").withColumn("keep", F.col("score") >= views.cut)


def drop_rejected(docs: DataFrame, views: Views) -> DataFrame:
    """The rows of ``docs`` that the combined views keep, with all their columns.

    Null texts count as empty; repeated rows are judged each, and alike; an empty table stays empty."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    have = {c.lower() for c in docs.columns}
    meta = [F.col(c).cast(k).alias(c) if c in have else F.lit(None).cast(k).alias(c) for c, k in (("lang", "string"), ("source", "string"), ("n_chars", "bigint"))]
    found = _scored(docs.select(row, "text", *meta), views, "row")
    return found.filter(F.col("score") >= views.cut).select("row.*")
