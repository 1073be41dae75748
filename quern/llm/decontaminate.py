"""Benchmark decontamination by winnowing.

From every run of ``WINDOW - GRAM + 1`` successive word k-grams the smallest hash is
kept as a fingerprint. A shared span of WINDOW words holds one whole such run, so it
leaves the same fingerprint in the document and in the item: none is missed. A document's
fingerprint that the benchmark may have is extended to the windows of WINDOW words around it,
each window is a key, and the keys are joined with those of the items: where they are equal,
the document's words are hit. Items of fewer words are one window and are looked up by their own length.

The documents are read once, whatever the benchmark's size. Which fingerprints and windows the
benchmark may have is told by two bit maps of bounded size; a larger benchmark makes them fuller, so that
more windows go into the join, which alone decides. A window that a document repeats is one
key with its places, so repeated words cost no more than others."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tables import durable, pieces, small, text_bytes
from quern.llm.words import U64, grams, hashes, mix, multipliers

#: Words of a window, and of a k-gram that is fingerprinted.
WINDOW, GRAM = 13, 8
#: Bytes of a bit map at most, and bits of it for each key while it is smaller.
MAP_BYTES, BITS_A_KEY = 32 << 20, 32


def _slide(x: np.ndarray, n: int, f) -> np.ndarray:
    """f over each n successive values; len(x) - n + 1 of them."""
    out = x[: len(x) - n + 1].copy()
    for j in range(1, n):
        f(out, x[j : j + len(out)], out=out)
    return out


def winnow(word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints of each row of at least WINDOW words."""
    run = WINDOW - GRAM + 1
    if len(word) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    count = np.diff(bounds)
    left = np.repeat(bounds[1:], count) - np.arange(len(word))
    gram = grams(word, GRAM)
    low = _slide(gram, run, np.minimum)  # by first k-gram of a run
    low[left[: len(low)] < WINDOW] = 0  # a run across rows keeps nothing
    padded = np.concatenate([np.zeros(run - 1, U64), low, np.zeros(run - 1, U64)])
    # k-gram i is kept if it is the least of a run that holds it; the largest least of its runs is then its own
    kept = np.flatnonzero((_slide(padded, run, np.maximum) == gram) & (gram != 0))
    return kept, gram[kept]


def _window(word: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Keys of the ``n`` words from each place; keys of different lengths differ."""
    m = multipliers(n)
    out = np.full(len(at), U64(n))
    for j in range(n):
        out += word[at + j] * m[j]
    return mix(out)


class Bits:
    """A set of 64-bit keys with false members but none missing."""

    def __init__(self, keys: DataFrame, column: str, most: int):
        n = keys.count()
        self.size = max(64, min(8 * most, 1 << (BITS_A_KEY * n).bit_length()))
        place = F.pmod(F.col(column), F.lit(self.size)) + 1
        rows = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
        self.bits = np.zeros(-(-self.size // 32768) * 4096, np.uint8)
        for r in rows:
            self.bits[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)

    def may_hold(self, key: np.ndarray) -> np.ndarray:
        place = key.view(np.int64) % self.size
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def _item_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, n, window, print): an item's windows; of its fingerprints one in each such row while there are any."""
    for batch in batches:
        for part in pieces(batch, "text"):
            word, bounds = hashes(*text_bytes(part.column("text")))
            count = np.diff(bounds)
            full = np.flatnonzero(np.repeat(bounds[1:], count) - np.arange(len(word)) >= WINDOW)
            keys, rows, sizes = [_window(word, full, WINDOW)], [np.searchsorted(bounds, full, "right") - 1], [np.full(len(full), WINDOW)]
            for n in np.unique(count[(count > 0) & (count < WINDOW)]).tolist():
                mine = np.flatnonzero(count == n)
                keys.append(_window(word, bounds[:-1][mine], n))
                rows.append(mine)
                sizes.append(np.full(len(mine), n))
            found = np.unique(winnow(word, bounds)[1])  # each is the least of a window, so there are no more than windows
            fill = np.zeros(sum(map(len, rows)), np.int64)
            fill[: len(found)] = found.view(np.int64)
            item = part.column("id").take(pa.array(np.concatenate(rows)))
            columns = [item, pa.array(np.concatenate(sizes), pa.int32()), pa.array(np.concatenate(keys).view(np.int64)), pa.array(fill, mask=np.arange(len(fill)) >= len(found))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "n", "window", "print"])


def _candidates(prints: Bits, windows: Bits, short: list[int]):
    """(id, n_words, found) of each document; ``found`` lists windows that an item may have, with their places."""
    kind = pa.list_(pa.struct([("window", pa.int64()), ("n", pa.int32()), ("places", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                word, bounds = hashes(*text_bytes(part.column("text")))
                count = np.diff(bounds)
                left = np.repeat(bounds[1:], count) - np.arange(len(word))
                at, found = winnow(word, bounds)
                at = at[prints.may_hold(found)]
                first = np.repeat(bounds[:-1], count)
                near = np.unique((at[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
                near = near[near >= 0]
                starts, keys, sizes = [near[(left[near] >= WINDOW)]], [], []
                keys.append(_window(word, starts[0], WINDOW))
                sizes.append(np.full(len(keys[0]), WINDOW))
                for n in short:
                    starts.append(np.flatnonzero(left >= n))
                    keys.append(_window(word, starts[-1], n))
                    sizes.append(np.full(len(starts[-1]), n))
                start, key, n = (np.concatenate(x) for x in (starts, keys, sizes))
                held = np.flatnonzero(windows.may_hold(key))
                start, key, n = start[held], key[held].view(np.int64), n[held]
                row = np.searchsorted(bounds, start, "right") - 1
                order = np.lexsort((start, key, n, row))
                start, key, n, row = start[order], key[order], n[order], row[order]
                new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (n[1:] != n[:-1])])) if len(row) else np.zeros(0, np.int64)
                places = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array((start - first[start]).astype(np.int32)))
                each = pa.StructArray.from_arrays([pa.array(key[new]), pa.array(n[new].astype(np.int32)), places], ["window", "n", "places"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[new], np.arange(part.num_rows + 1)), pa.int32()), each)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(count, pa.int64()), lists.cast(kind)], ["id", "n_words", "found"])

    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, starts, ends): the merged spans of each row's windows."""
    for batch in batches:
        out = [], []
        for windows in batch.column("windows").to_pylist():
            start = np.concatenate([np.array(w["places"], np.int64) for w in windows])
            end = np.concatenate([np.array(w["places"], np.int64) + w["n"] for w in windows])
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order])
            first = np.concatenate([[True], start[1:] > end[:-1]])
            out[0].append(start[first])
            out[1].append(end[np.concatenate([first[1:], [True]])])
        yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(x, pa.list_(pa.int64())) for x in out)], ["row", "starts", "ends"])


class _Benchmark:
    """The keys of the items' windows, as a table, and what tells which keys they may hold."""

    def __init__(self, benchmark: DataFrame, item_col: str, text_col: str, most: int):
        items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).distinct()
        self.held = durable(items.mapInArrow(_item_keys, "item string, n int, window bigint, print bigint").distinct())
        self.windows = self.held.select("window", "n")
        short = [r.n for r in self.windows.filter(F.col("n") < WINDOW).select("n").distinct().collect()]
        prints = Bits(self.held.filter(F.col("print").isNotNull()).select("print"), "print", most)
        self.candidates = _candidates(prints, Bits(self.windows, "window", most), sorted(short))

    def find(self, source: DataFrame) -> DataFrame:
        """(id, n_words, found) of texts (id, text)."""
        kind = source.schema["id"].dataType.simpleString()
        return source.mapInArrow(self.candidates, f"id {kind}, n_words bigint, found array<struct<window:bigint,n:int,places:array<int>>>")

    def hits(self, found: DataFrame) -> DataFrame:
        """(row, starts, ends, item_ids) of the durable rows (row, found) that are hit, by a join of the keys."""
        kind = found.schema["row"].dataType.simpleString()
        each = found.filter(F.size("found") > 0).select("row", F.explode("found").alias("x")).select("row", "x.window", "x.n", "x.places")
        real = durable(each.join(small(self.windows), ["window", "n"], "left_semi"))
        spans = real.groupBy("row").agg(F.collect_list(F.struct("n", "places")).alias("windows")).mapInArrow(_spans, f"row {kind}, starts array<bigint>, ends array<bigint>")
        named = self.held.select("window", "n", "item").filter(F.col("item").isNotNull())
        named = real.select("row", "window", "n").join(small(named), ["window", "n"]).groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
        return durable(spans.join(named, "row", "left"))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = MAP_BYTES) -> DataFrame:
    """(id, n_words, starts, ends, item_ids) of each document row.

    ``starts``/``ends``: merged half-open word spans that lie inside an occurrence of an
    item's window; ``item_ids``: the items with such windows, sorted as strings. Null or
    empty texts have no words. Benchmark rows without words take no part; an item whose
    id is null hits words but is not listed. Rows that repeat are judged each; other
    columns are not read. ``block_bytes`` bounds each of the two bit maps that go to the tasks; it does not
    change the result. Texts are not shuffled."""
    items = _Benchmark(benchmark, item_col, item_text_col, block_bytes)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = durable(items.find(source).withColumn("row", F.monotonically_increasing_id()))
    out = found.select("row", "id", "n_words").join(small(items.hits(found)), "row", "left")
    none = lambda c, t: F.coalesce(c, F.array().cast(f"array<{t}>")).alias(c)
    return out.select(F.col("id").alias(id_col), "n_words", none("starts", "bigint"), none("ends", "bigint"), none("item_ids", "string"))


def judged(found: DataFrame) -> DataFrame:
    """With n_hit, and ``contaminated``: hit words are at least a twentieth of all words."""
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = MAP_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    A row is judged by its text alone, so null and repeated ids and clashing names do no harm; a
    null text has no words and stays. Repeated rows stay or go together."""
    items, digest = _Benchmark(benchmark, "item_id", "text", block_bytes), F.md5(text_col)
    found = items.find(docs.select(digest.alias("id"), F.col(text_col).alias("text"))).filter(F.size("found") > 0)
    found = durable(found.dropDuplicates(["id"]).withColumnRenamed("id", "row"))  # copies of a text are judged once
    gone = judged(found.select("row", "n_words").join(small(items.hits(found)), "row")).filter("contaminated")
    gone = durable(gone.select(F.col("row").alias("_text")))
    return docs.join(small(gone), digest == gone["_text"], "left_anti")
