"""Toxicity by a classifier chain.

Categories are predicted one after the other; each linear model sees the words of the text,
what they begin with, and the probabilities of the categories before it. In training these are out-of-fold
predictions, so that a model sees the earlier ones as uncertain as they will be.

The categories are the label columns that are named, in their order; the last one decides. Where only one
is at hand, narrower kinds of it come first: the toxic texts fall into KINDS clusters by their
telling words, and to be toxic and of a cluster is a category. No word list is used."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.linear import fit_logistic, logit, out_of_fold, predict
from quern.llm.tables import durable, pieces, text_bytes
from quern.llm.words import U64, hashes

#: Clusters of the toxic texts that are categories of their own where there is but one label column.
KINDS = 2
#: Labelled rows that the models are fitted on at most, and words (by chi-square) that they see.
MAX_LABELLED, MAX_WORDS = 6_000, 1_500
#: Besides whole words, their first so many bytes are features, for words that share a stem.
PREFIXES = (4, 5, 6, 7)
#: A word is a feature only if its chi-square against the label would be reached by chance, among all words that are
#: tested, with this probability at most; but the LEAST_WORDS best words always are.
CHANCE, LEAST_WORDS = 1e-4, 60
#: Texts that hold (or lack) a word at least, for it to be tested.
LEAST_TEXTS = 3
#: Bytes of word sets that the driver receives at most; of more labelled rows the first by a hash of their words.
MAX_BYTES = 256 << 20
#: Rows whose features are held as one dense matrix.
VIEW_ROWS = 1024
FOLDS, L2, STEPS = 5, 1e-4, 400
CUTS = (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2)


@dataclass
class Chain:
    names: tuple[str, ...]
    words: np.ndarray  # sorted hashes
    weights: list[np.ndarray]
    cut: float = 0.5  # of the last category's probability, by F1 out of fold

    def features(self, bounds: np.ndarray, *kinds: np.ndarray) -> np.ndarray:
        x = np.zeros((len(bounds) - 1, len(self.words)), np.float32)
        for value in kinds if len(self.words) else ():
            at = np.minimum(np.searchsorted(self.words, value), len(self.words) - 1)
            hit = np.flatnonzero(self.words[at] == value)
            x[np.searchsorted(bounds, hit, "right") - 1, at[hit]] = 1
        return x

    def read(self, texts: pa.Array) -> np.ndarray:
        word, bounds, *begun = hashes(*text_bytes(texts), PREFIXES)
        return self.features(bounds, word, *begun)

    def score(self, x: np.ndarray) -> np.ndarray:
        got = np.zeros((len(x), 0))
        for w in self.weights:
            got = np.column_stack([got, predict(np.column_stack([x, logit(got)]), w)])
        return got


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text", rows=VIEW_ROWS):
            word, bounds, *begun = hashes(*text_bytes(part.column("text")), PREFIXES)
            sets = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                every = np.unique(np.concatenate([word[a:b], *[x[a:b] for x in begun]]))
                sets.append(every[every != 0].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), part.column("y")], ["words", "y"])


def _one_of_each_family(label: dict[bytes, np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """Word sets and labels with near copies of a text left out: else a family of copies
    with a wrong label would make features of its own words. Texts are taken as of one
    family if the two least hashes among their rarer words agree."""
    sets = sorted(label)
    words = [np.frombuffer(k, U64) for k in sets]
    seen, df = np.unique(np.concatenate(words), return_counts=True) if words else (np.zeros(0, U64), np.zeros(0))
    common = seen[df > max(5, len(sets) // 100)]
    families: dict[bytes, list[bytes]] = {}
    for k, w in zip(sets, words):
        rare = np.setdiff1d(w, common, assume_unique=True)[:2]  # sorted by hash
        families.setdefault(rare.tobytes() if len(rare) == 2 else k, []).append(k)
    mean = {members[0]: np.mean([label[k] for k in members], axis=0) for members in families.values()}
    first = sorted(mean)
    return first, np.array([mean[k] >= 0.5 for k in first], float)


def _clusters(x: np.ndarray, k: int, rounds: int = 30) -> np.ndarray:
    """The cluster of each row by k-means from the rows that lie farthest apart; always the same."""
    centre = x[[int(np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1)))]]
    away = lambda c: (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)
    while len(centre) < k:
        centre = np.concatenate([centre, x[[int(np.argmax(away(centre).min(axis=1)))]]])
    of = np.argmin(away(centre), axis=1)
    for _ in range(rounds):
        centre = np.array([x[of == c].mean(axis=0) if (of == c).any() else centre[c] for c in range(k)])
        new = np.argmin(away(centre), axis=1)
        if (new == of).all():
            break
        of = new
    return of


def _telling(of: np.ndarray, flat: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hashes of the words that tell most about the label, by chi-square, in order of the hash."""
    seen, code = np.unique(flat, return_inverse=True)
    n, pos = len(y), y.sum()
    df = np.bincount(code, minlength=len(seen)).astype(float)
    both = np.bincount(code, weights=y[of] if n else None, minlength=len(seen))
    share = pos / max(n, 1)
    spread = df * share * (1 - share) * (1 - df / max(n, 1)) + 1e-9
    tested = np.minimum(df, n - df) >= LEAST_TEXTS
    chi2 = (both - df * share) ** 2 / spread * tested
    # beyond x, chi-square with one degree of freedom has about exp(-x / 2) of its mass, and less
    cut = 2 * np.log(max(1, tested.sum()) / CHANCE)
    best = np.argsort(-chi2, kind="stable")[:MAX_WORDS]
    good = (chi2[best] >= cut) | ((np.arange(len(best)) < LEAST_WORDS) & (chi2[best] > 0))
    return np.sort(seen[best[good]])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_cols: tuple[str, ...] = ("toxic",), max_labelled: int = MAX_LABELLED
) -> Chain:
    """A chain fitted on at most ``max_labelled`` labelled document rows, the first by a hash of the id; on fewer where their
    word sets have over MAX_BYTES together.

    Rows with a null label and labels without a document are left out; repeated labels of an id are
    averaged and rounded; texts with the same words count once. Without a toxic label
    nothing is called toxic."""
    given = labels
    for c in label_cols:
        given = given.filter(F.col(c).isNotNull())
    mean = [(F.avg(c) >= 0.5).cast("int").alias(f"_y{k}") for k, c in enumerate(label_cols)]
    picked = given.groupBy(F.col(id_col).alias("_id")).agg(*mean).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    picked = picked.select("_id", F.array(*[f"_y{k}" for k in range(len(label_cols))]).alias("y"))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = source.join(F.broadcast(picked), F.col("id") == F.col("_id")).select("text", "y").mapInArrow(_distinct_words, "words binary, y array<int>")
    joined = durable(joined)
    n, size = joined.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()
    most = max_labelled if size <= MAX_BYTES else max(1, int(min(n, max_labelled) * MAX_BYTES / size))
    rows = joined.orderBy(F.xxhash64("words"), "y").limit(most).toArrow()  # as ids may repeat
    y_of: dict[bytes, list[list[int]]] = {}
    for words, y in zip(rows.column("words").to_pylist(), rows.column("y").to_pylist()):
        y_of.setdefault(words, []).append(y)
    kept, target = _one_of_each_family({k: np.mean(v, axis=0) for k, v in y_of.items()})
    target = target.reshape(-1, len(label_cols))
    n, y = len(kept), target[:, -1]
    sets = [np.frombuffer(k, U64) for k in kept]
    flat = np.concatenate(sets) if sets else np.zeros(0, U64)
    of = np.repeat(np.arange(n), [len(s) for s in sets]).astype(np.int64)
    names = list(label_cols)
    chain = Chain((), _telling(of, flat, y), [])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    x = chain.features(bounds, flat)
    if len(label_cols) == 1:
        kinds = np.zeros((n, KINDS))
        toxic = np.flatnonzero(y)
        if len(toxic) >= KINDS and x.shape[1]:
            kinds[toxic, _clusters(x[toxic], KINDS)] = 1
        target, names = np.column_stack([kinds, y]), [*(f"{names[0]}_kind_{k + 1}" for k in range(KINDS)), *names]
    chain.names = tuple(names)
    fold = np.array([int(s[0] % U64(FOLDS)) if len(s) else 0 for s in sets], int)
    held = np.zeros((n, 0))
    for k in range(len(names)):
        inputs = np.column_stack([x, logit(held)])
        chain.weights.append(fit_logistic(inputs, target[:, k], L2, STEPS))
        held = np.column_stack([held, out_of_fold(inputs, target[:, k], fold, L2, STEPS)])
    if not y.any():
        chain.cut = 1.1  # no toxic label was seen: nothing is called toxic
    else:
        called = [held[:, -1] >= c for c in CUTS]
        f1 = [2 * (y * p).sum() / (y.sum() + p.sum()) for p in called]
        chain.cut = CUTS[int(np.argmax(np.array(f1) > max(f1) - 1e-9))]
    return chain


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_<category> ..., toxic) of each document row, by its whole text; ``toxic`` is whether
    the last category's probability reaches the chain's cut.

    Null and empty texts get the probabilities of a text without known words. Repeated rows
    are scored each; other columns are not read."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = [f"p_{c}" for c in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", rows=VIEW_ROWS):
                p = chain.score(chain.read(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(p[:, j]) for j in range(len(names))]], ["id", *names])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, " + ", ".join(f"{x} double" for x in names)).withColumnRenamed("id", id_col).withColumn("toxic", F.col(names[-1]) >= chain.cut)
