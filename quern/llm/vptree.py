"""Approximate nearest neighbours by vantage-point trees, a tree for each shard.

The largest inner product of a query q is the largest ``|x| cos(q, x)``. Trees are built over the
vectors' directions, whose distances obey the triangle inequality; with the range of
lengths inside a branch this bounds every inner product in it. A branch is passed over if its bound is
under the k-th best score found. ``factor`` stretches the distance that the bound rests on: 1 is
exact search, larger factors prune more. Lengths don't enter the distances, so one
long vector does not blunt the others' bounds.

Shards follow the directions too: the upper levels of one tree are drawn from a bounded sample,
every vector is placed in one of its cells, and a cell of many vectors is dealt into shards by a
hash of the id. A query searches its own cell first; its k-th score then decides, by the
same bound, which other cells it is sent to."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.tables import durable, small

#: Vectors of a shard on average, vectors of a leaf, and queries searched at once.
SHARD, LEAF, BLOCK = 8192, 128, 256
#: Vectors that the cells' borders are drawn from at most (all vectors are indexed), and a cell's least share of them.
SAMPLE, OF_CELL = 20_000, 16
#: Queries that one task answers from a shard; more are dealt to copies of the shard.
ASKED = 65_536
#: Relaxation of the pruning; the recall it gives is measured in the tests.
FACTOR = 4.0
#: What rounding can add to a cosine or a distance, generously.
EPS = 1e-12


def directions(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and lengths; neither overflows on the way."""
    most = np.abs(v).max(axis=1, keepdims=True)
    u = v / most
    size = np.sqrt((u * u).sum(axis=1, keepdims=True))
    return u / size, np.minimum(most * size, np.finfo(float).max)[:, 0]


def _apart(u: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(((u - point) ** 2).sum(axis=1))


def _vantage(u: np.ndarray) -> int:
    """The row farthest from the mean; it sees the widest range of distances."""
    return int(np.argmax(((u - u.mean(axis=0)) ** 2).sum(axis=1)))


def bound(gap: np.ndarray, factor: float, least: np.ndarray | float, most: np.ndarray | float) -> np.ndarray:
    """The largest length times cosine at a distance of ``gap`` or more, for lengths from least to most."""
    cosine = 1 - np.minimum(np.maximum(gap - EPS, 0) * factor, 2) ** 2 / 2 + EPS
    return np.where(cosine >= 0, most * cosine, least * cosine)


class Cells:
    """The upper levels of a tree: borders between cells, drawn from sampled directions."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.n = 0
        self.root = self._build(sample, cells)

    def _build(self, u: np.ndarray, cells: int):
        if cells > 1 and len(u) >= 2 * OF_CELL:
            point = u[_vantage(u)]
            d = _apart(u, point)
            cut = float(np.median(d))
            inner = d <= cut
            if not inner.all():
                return point, cut, self._build(u[inner], cells // 2), self._build(u[~inner], cells - cells // 2)
        self.n += 1
        return self.n - 1

    def place(self, u: np.ndarray) -> np.ndarray:
        out = np.zeros(len(u), np.int32)

        def go(node, rows: np.ndarray) -> None:
            if not isinstance(node, tuple):
                out[rows] = node
            elif len(rows):
                inner = _apart(u[rows], node[0]) <= node[1]
                go(node[2], rows[inner])
                go(node[3], rows[~inner])

        go(self.root, np.arange(len(u)))
        return out

    def gaps(self, u: np.ndarray) -> np.ndarray:
        """(directions, cells): the least distance at which a cell's vectors can be."""
        out = np.zeros((len(u), self.n))

        def go(node, gap: np.ndarray) -> None:
            if not isinstance(node, tuple):
                out[:, node] = gap
            else:
                over = _apart(u, node[0]) - node[1]
                go(node[2], np.maximum(gap, over))
                go(node[3], np.maximum(gap, -over))

        go(self.root, np.zeros(len(u)))
        return out


class Tree:
    """A vantage-point tree over a shard; each branch has ranges of distances and lengths."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.v, self.ids = v, ids
        self.u, length = directions(v)
        self.scale = length.max()
        self.length = length / self.scale
        self.order = np.arange(len(v))
        self.root = self._build(0, len(v), leaf)

    def _build(self, lo: int, hi: int, leaf: int):
        if hi - lo <= leaf:
            return lo, hi
        rows = self.order[lo:hi]
        vantage = rows[_vantage(self.u[rows])]
        d = _apart(self.u[rows], self.u[vantage])
        near = np.argsort(d, kind="stable")
        self.order[lo:hi], d = rows[near], d[near]
        mid = (hi - lo) // 2
        sides = []
        for a, b in ((0, mid), (mid, hi - lo)):
            size = self.length[self.order[lo + a : lo + b]]
            sides.append((d[a], d[b - 1], size.min(), size.max(), self._build(lo + a, lo + b, leaf)))
        return vantage, *sides

    def search(self, q: np.ndarray, q_ids: np.ndarray, k: int, factor: float, least: np.ndarray) -> np.ndarray:
        """Length times cosine, as a share of the longest (queries, rows); minus infinity where a
        query did not look, and for rows of its own id. ``least``: scores that are known already."""
        found = np.full((len(q), len(self.v)), -np.inf)
        best = np.full((len(q), k), -np.inf)
        best[:, 0] = least
        self._visit(self.root, np.arange(len(q)), q, q_ids, k, factor, least, found, best)
        return found

    def _visit(self, node, who, q, q_ids, k, factor, least, found, best):
        if len(who) == 0:
            return
        if len(node) == 2:
            rows = self.order[node[0] : node[1]]
            s = (q[who] @ self.u[rows].T) * self.length[rows]
            s[q_ids[who][:, None] == self.ids[rows]] = -np.inf
            found[np.ix_(who, rows)] = s
            both = np.concatenate([best[who], s], axis=1)
            best[who] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            return
        vantage, inner, outer = node
        d = _apart(q[who], self.u[vantage])
        gap = [np.maximum(np.maximum(side[0] - d, d - side[1]), 0) for side in (inner, outer)]
        first_in = gap[0] <= gap[1]
        for turn in (0, 1):
            for s, side in enumerate((inner, outer)):
                reach = np.maximum(best[who].min(axis=1), least[who])
                go = (first_in == (s == turn)) & (bound(gap[s], factor, side[2], side[3]) >= reach)
                self._visit(side[4], who[go], q, q_ids, k, factor, least, found, best)

    def answers(self, q_ids: np.ndarray, v: np.ndarray, k: int, factor: float, least: np.ndarray) -> pa.RecordBatch:
        """The k best of each query; ``least`` is a score that a result must reach, divided by the query's length."""
        q, _ = directions(v)
        found = self.search(q, q_ids, k, factor, least / self.scale - EPS)
        # rounding may have put these in a wrong order: all that can't be told from the last are scored again
        slack = EPS * self.length
        n = min(k, found.shape[1])
        edge = np.partition(found - slack, found.shape[1] - n, axis=1)[:, -n][:, None]
        r, c = np.nonzero((found + slack >= edge) & (found > -np.inf))
        exact = np.zeros(len(r))
        for at in range(0, len(r), 1 << 16):
            a, b = v[r[at : at + (1 << 16)]], self.v[c[at : at + (1 << 16)]]
            for j in range(v.shape[1]):  # in one fixed order, so that equal vectors get equal scores
                exact[at : at + (1 << 16)] += a[:, j] * b[:, j]
        exact = np.where(np.isnan(exact), -np.inf, exact)
        order = np.lexsort((self.ids[c], -exact, r))
        r, c, exact = r[order], c[order], exact[order]
        top = np.arange(len(r)) - np.searchsorted(r, r) < k
        return pa.RecordBatch.from_arrays([pa.array(q_ids[r[top]]), pa.array(self.ids[c[top]]), pa.array(exact[top])], ["query_id", "id", "score"])


def _usable(v: Column) -> Column:
    """Not null, without null or non-finite components, not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Each batch's rows of one dimension, with their vectors as a matrix."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            for at in range(0, part.num_rows, 1 << 13):
                rows = part.slice(at, 1 << 13)
                yield dim, rows, rows.column("v").flatten().to_numpy().reshape(-1, dim)


def _placed(vectors: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """(dim, id, v) with the cell and the length of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, v in _by_dim(batches):
            u, length = directions(v)
            cell = cells[dim].place(u) if dim in cells else np.zeros(len(u), np.int32)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("dim", "id", "v")), pa.array(cell), pa.array(length)], ["dim", "id", "v", "cell", "length"])

    return vectors.select("dim", "id", "v").mapInArrow(run, "dim int, id bigint, v array<double>, cell int, length double")


def _sent(asked: DataFrame, cells: dict[int, Cells], lengths: dict[int, tuple[np.ndarray, np.ndarray]], factor: float) -> DataFrame:
    """A row (dim, cell, id, v, least) for each cell besides its own where a query may find more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part, v in _by_dim(batches):
            if dim not in cells:
                continue
            low, high = lengths[dim]
            least, own = part.column("least").to_numpy(), part.column("cell").to_numpy()
            for at in range(0, len(v), BLOCK):
                gap = cells[dim].gaps(directions(v[at : at + BLOCK])[0])
                go = bound(gap, factor, low, high) >= least[at : at + BLOCK, None] - EPS * high
                go &= (np.arange(cells[dim].n)[None] != own[at : at + BLOCK, None]) & (high > 0)
                r, c = np.nonzero(go)
                rows = part.slice(at, BLOCK).take(pa.array(r))
                yield pa.RecordBatch.from_arrays([rows.column("dim"), pa.array(c.astype(np.int32)), *(rows.column(x) for x in ("id", "v", "least"))], ["dim", "cell", "id", "v", "least"])

    return asked.select("dim", "id", "v", "cell", "least").mapInArrow(run, "dim int, cell int, id bigint, v array<double>, least double")


def _search(k: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, vectors, tree = None, [], [], None
        for batch in batches:
            key = np.column_stack([batch.column(c).to_numpy() for c in ("dim", "cell", "sub", "turn", "kind")])
            new = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *new], [*new, len(key)]):
                part = batch.slice(lo, hi - lo)
                dim, *_, kind = where = key[lo].tolist()
                if here != where[:4]:
                    here, ids, vectors, tree = where[:4], [], [], None
                v = part.column("v").flatten().to_numpy().reshape(-1, dim)
                if kind == 0:
                    ids.append(part.column("id").to_numpy())
                    vectors.append(v)
                    continue
                if tree is None and ids:
                    tree = Tree(np.concatenate(vectors), np.concatenate(ids))
                q_ids, least = part.column("id").to_numpy(), part.column("least").to_numpy()
                for at in range(0, len(v) if tree is not None else 0, BLOCK):
                    yield tree.answers(q_ids[at : at + BLOCK], v[at : at + BLOCK], k, factor, least[at : at + BLOCK])

    return run


def _found(placed: DataFrame, asked: DataFrame, shards: DataFrame, k: int, factor: float) -> DataFrame:
    """(query_id, id, score) of queries (dim, cell, id, v, least) from the vectors of their cells.

    A task holds one shard, whose vectors come first, and at most about ASKED queries at a time."""
    turns = durable(asked.groupBy("dim", "cell").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("turns")))
    asked = asked.join(small(turns), ["dim", "cell"]).join(small(shards), ["dim", "cell"])
    turn = F.pmod(F.xxhash64("id", "v"), F.col("turns")).cast("int")
    asked = asked.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), turn.alias("turn"), F.lit(1).alias("kind"), "id", "v", "least")
    sub = F.pmod(F.xxhash64("id"), F.col("subs")).cast("int")
    held = placed.join(small(shards), ["dim", "cell"]).join(small(turns), ["dim", "cell"])
    held = held.select("dim", "cell", sub.alias("sub"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(0).alias("kind"), "id", "v", F.lit(0.0).alias("least"))
    key = ["dim", "cell", "sub", "turn"]
    dealt = held.union(asked).repartition(*key).sortWithinPartitions(*key, "kind", "id")
    return dealt.mapInArrow(_search(k, factor), "query_id bigint, id bigint, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    factor: float = FACTOR, shard: int = SHARD, sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found for each query row, by largest
    inner product in double precision, ties to the smaller id; the query's own id is no
    candidate.

    Vectors that are null, zero, or hold null or non-finite components, and rows with a null
    id, take no part; vectors are compared within their dimension. Equal vectors are
    searched once: of each set of equal ones the k + 1 smallest ids are kept, which no result
    can miss. Rows that repeat an id and vector count once. With fewer than ``k`` candidates all
    are returned; an empty table gives an empty result. Other columns are not read. To the driver go
    ``sample`` vectors at most, and two lengths for each cell drawn from them."""
    source = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asks"))
    source = source.filter(F.col("id").isNotNull() & _usable(F.col("v"))).withColumn("dim", F.size("v"))
    equal = W.partitionBy("v").orderBy("id")
    rows = source.dropDuplicates(["id", "v"])
    held = durable(rows.withColumn("n", F.row_number().over(equal)).filter(F.col("n") <= k + 1).select("dim", "id", "v"))
    large = {r.dim: r.n for r in held.groupBy("dim").agg(F.count("*").alias("n")).filter(F.col("n") > shard).collect()}
    drawn = held.filter(F.col("dim").isin(list(large))).orderBy(F.xxhash64("id", "v"), "id").limit(sample).toArrow() if large else None
    cells = {}
    for dim, n in large.items():
        mine = drawn.filter(pa.array(drawn.column("dim").to_numpy() == dim))
        u = directions(mine.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim))[0]
        cells[dim] = Cells(u, min(-(-n // shard), max(1, len(u) // OF_CELL)))
    placed = durable(_placed(held, cells))
    shards = durable(placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard).cast("int").alias("subs"), F.min("length").alias("low"), F.max("length").alias("high")))
    asked = durable(_placed(rows.filter("asks"), cells))
    first = _found(placed.select("dim", "cell", "id", "v"), asked.select("dim", "cell", "id", "v", F.lit(float("-inf")).alias("least")), shards.select("dim", "cell", "subs"), k, factor)
    first = _top(first, k)
    if any(c.n > 1 for c in cells.values()):
        first = durable(first)
        lengths = {dim: (np.zeros(c.n), np.zeros(c.n)) for dim, c in cells.items()}
        for r in shards.filter(F.col("dim").isin(list(cells))).collect():
            lengths[r.dim][0][r.cell], lengths[r.dim][1][r.cell] = r.low, r.high
        last = first.filter(F.col("rank") == k).select(F.col("query_id").alias("_q"), F.col("score").alias("_s"))
        least = F.when(F.col("_s").isNull(), F.lit(float("-inf"))).otherwise(F.col("_s") / F.col("length"))
        sent = durable(_sent(asked.join(last, F.col("id") == F.col("_q"), "left").withColumn("least", least), cells, lengths, factor))
        more = _found(placed.select("dim", "cell", "id", "v"), sent, shards.select("dim", "cell", "subs"), k, factor)
        first = _top(first.select("query_id", "id", "score").union(more), k)
    return first.select("query_id", "rank", F.col("id").alias(id_col), "score")
