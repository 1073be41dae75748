"""Near-duplicate classes by BagMinHash, banding and verified multiset overlap.

A document is the multiset of its five-word shingles; two are near duplicates if the
weighted Jaccard similarity of their multisets is 0.8 or more, and classes are the
connected components of these links.

*Signatures.* The weight of a shingle (its count) is cut at powers of two into ranges, which are read
one by one up to the weight and not split further. Each
(shingle, range) has a Poisson process on the range times the time axis; a point belongs to
the document if its place on the weight axis lies under the document's weight, and carries a
random register. A register's signature is its earliest point. As the processes do not
depend on the document, registers of two documents agree with a probability equal to their
weighted Jaccard similarity.

*Candidates.* Texts with equal word sequences are one node. Nodes that share a band are
linked by a star to the node of the band that shares most bands with others, which for a
family of copies is the text they stem from. Nodes of bands that then lie in more than one
component are compared across the components, where an exact bound from their
rarest shingles allows the similarity at all. So no link that a band shows is lost, and no
family is expanded into its pairs.

*Verification.* Each candidate pair's similarity is computed from the whole multisets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from quern.llm.components import components
from quern.llm.tables import durable, pieces, small, text_bytes
from quern.llm.words import U64, hashes, mix, multipliers, shingles

SHINGLE, SIMILARITY = 5, 0.8
#: Bands and registers of a band: at similarity 0.8 a pair shares no band in 5 of 100,000 cases.
BANDS, ROWS = 25, 5

#: Rows of one key that go to one task in a join.
HOT = 256

_GOLDEN = U64(0x9E3779B97F4A7C15)


def _runs(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, value) in order, and how often each occurs."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.append(at, len(row)))


def bag_min_hash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """Signatures, (n_rows, m) times as float bits; rows without elements have infinity."""
    top = np.floor(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1  # ranges [0,1), [1,2), [2,4) ...
    at = np.repeat(np.arange(len(row)), top + (weight > 2 ** (top - 1)))
    first = np.concatenate([[0], np.cumsum(top + (weight > 2 ** (top - 1)))[:-1]]) if len(row) else np.zeros(0, np.int64)
    level = np.arange(len(at)) - first[at] if len(at) else np.zeros(0, np.int64)
    # level 0 is [0, 1); level k is [2^(k-1), 2^k)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    rate = np.maximum(low, 1.0)
    doc, limit = row[at], weight[at].astype(float)
    state = mix(element[at] ^ (level.astype(U64) * U64(0xD1B54A32D192ED03)))
    mass = np.bincount(row, weights=weight, minlength=n_rows)
    out = np.full(n_rows * m, np.inf)
    time = np.zeros(len(at))
    horizon = np.where(mass > 0, m / np.maximum(mass, 1) * (np.log(m) + 4), 0.0)
    live = np.arange(len(at))
    while len(live):
        going, parked = live, []
        while len(going):
            ahead = state[going] + _GOLDEN
            draw = mix(ahead)
            u = ((draw >> U64(11)).astype(float) + 0.5) * 2.0**-53
            when = time[going] - np.log(u) / rate[going]
            inside = when <= horizon[doc[going]]
            parked.append(going[~inside])  # their next point is drawn again if it is needed
            going, draw, when = going[inside], draw[inside], when[inside]
            state[going], time[going] = ahead[inside], when
            where = mix(draw)
            place = low[going] + rate[going] * (where >> U64(40)).astype(float) * 2.0**-24
            taken = place < limit[going]
            register = ((where & U64(0xFFFFFFFF)) * U64(m)) >> U64(32)
            np.minimum.at(out, (doc[going] * m + register.astype(np.int64))[taken], when[taken])
        full = np.isfinite(out.reshape(n_rows, m)).all(axis=1)
        live = np.concatenate(parked)
        live = live[~full[doc[live]]]
        horizon[~full] *= 2  # rows with a register still open look further
    return out.reshape(n_rows, m)


def _digest(word: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits of each row's word sequence, as two columns."""
    n = np.diff(bounds)
    out = np.zeros((len(n), 2), U64)
    place = np.arange(bounds[0], bounds[-1]) - np.repeat(bounds[:-1], n)
    for k, salt in enumerate((0x8CB92BA72F3D8DD7, 0xAAAAAAAAAAAAAAAB)):
        term = mix(word[bounds[0] : bounds[-1]] ^ mix((place.astype(U64) + U64(1)) * U64(salt)))
        total = np.concatenate([[U64(0)], np.cumsum(term, dtype=U64)])
        out[:, k] = mix((total[bounds[1:] - bounds[0]] - total[bounds[:-1] - bounds[0]]) ^ n.astype(U64))
    return out


def _bytes(rows: np.ndarray, keep: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    return pa.array([x.tobytes() if k else None for x, k in zip(flat, keep)], pa.binary())


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = multipliers(rows)
        for batch in batches:
            for part in pieces(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                word, bounds = hashes(data, offsets)
                shingle, of = shingles(word, bounds, SHINGLE)
                doc, element, weight = _runs(of, shingle)
                sig = bag_min_hash(doc, element, weight, part.num_rows, bands * rows).view(U64).reshape(-1, bands, rows)
                band = mix((sig * m[:rows]).sum(axis=2, dtype=U64) ^ mix(np.arange(bands, dtype=U64)))
                some = np.diff(bounds) > 0
                band_lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * bands, pa.int32()), pa.array(band.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), _bytes(_digest(word, bounds), some), pa.array(np.bincount(of, minlength=part.num_rows), pa.int64()), band_lists], ["id", "node", "size", "bands"]
                )

    return run


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles): sorted 64-bit hashes of (shingle, number of its occurrence)."""
    for batch in batches:
        for part in pieces(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            word, bounds = hashes(data, offsets)
            node = _bytes(_digest(word, bounds), np.diff(bounds) > 0)
            shingle, of = shingles(word, bounds, SHINGLE)
            doc, element, weight = _runs(of, shingle)
            number = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            each = mix(np.repeat(element, weight) ^ (number.astype(U64) * U64(0xD6E8FEB86659FD93)))
            doc = np.repeat(doc, weight)
            order = np.lexsort((each, doc))
            cut = np.searchsorted(doc[order], np.arange(part.num_rows + 1))
            each = each[order]
            yield pa.RecordBatch.from_arrays([node, pa.array([each[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["node", "shingles"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y")):
            a, b = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            common = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
            keep.append(common >= SIMILARITY * (len(a) + len(b) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _spread_join(many: DataFrame, one: DataFrame, key: str, salt: Column) -> DataFrame:
    """``many`` joined to the one row that ``one`` has for each key. A key with more than HOT rows is dealt
    by ``salt`` to several tasks, which get a copy of its row each."""
    hot = durable(many.groupBy(key).agg(F.ceil(F.count("*") / HOT).cast("int").alias("_parts")).filter(F.col("_parts") > 1))
    parts = F.coalesce("_parts", F.lit(1))
    left = many.join(small(hot), key, "left").withColumn("_part", F.pmod(salt, parts).cast("int")).drop("_parts")
    right = one.join(small(hot), key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left.join(right, [key, "_part"]).drop("_part")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that reach the similarity; ``pairs`` is durable."""
    x = texts.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = texts.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = _spread_join(pairs, y, "b", F.xxhash64("a")).join(x, "a")
    return both.select("a", "b", "x", "y").mapInArrow(_verify, "a binary, b binary")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, node, class_id) of each document row.

    ``node`` names the text's word sequence (128-bit digest; equal for copies), ``class_id``
    is the least id of the class. Words are those of :mod:`quern.llm.words`; a text of one to
    four words is one shingle. Null texts and texts without words have a null node and
    are a class by themselves. Repeated rows fall into one class; if ids repeat, each row is
    still judged by its own text. Null ids are allowed and never name a class unless it has
    no other. An empty table gives an empty result; other columns are not read."""
    return _rooted(docs, id_col, text_col, bands, rows).drop("root")


def _rooted(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """:func:`classes`, and in ``root`` a node that names the class also where ids repeat."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = durable(source.mapInArrow(_sign(bands, rows), f"id {kind}, node binary, size bigint, bands array<bigint>"))
    nodes = durable(signed.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("bands").alias("bands")))

    # bands that more than one node has, and how many band mates each node has
    each = nodes.select("node", F.explode("bands").alias("band"))
    shared = durable(each.groupBy("band").agg(F.count("*").alias("n")).filter(F.col("n") > 1))
    inside = durable(each.join(small(shared), "band"))
    weight = inside.groupBy("node").agg(F.sum("n").alias("mates"))
    hub = inside.join(weight, "node").groupBy("band").agg(F.max_by("node", F.struct("mates", "node")).alias("b"))
    stars = durable(inside.select("band", F.col("node").alias("a")).join(hub, "band").filter(F.col("a") != F.col("b")).select("a", "b").distinct())

    # multisets of the nodes in question only
    wanted = durable(nodes.select("node", "id", "size").join(inside.select("node").distinct(), "node"))
    texts = source.join(small(wanted.select(F.col("id").alias("want"))), F.col("id").eqNullSafe(F.col("want")), "left_semi").select("text").mapInArrow(_multisets, "node binary, shingles binary")
    texts = durable(texts.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")))
    links = durable(_linked(stars, texts))

    # bands that hold several components yet
    root = components(links)
    placed = inside.select("band", "node").join(wanted.select("node", "size"), "node").join(root, "node", "left").select("band", "node", "size", F.coalesce("root", "node").alias("root"))
    split = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter(F.col("lo") != F.col("hi")).select("band")
    loose = durable(placed.join(split, "band").select("node", "size", "root").distinct())
    rest = durable(_linked(durable(_possible(loose, texts)), texts))
    if not rest.isEmpty():
        root = components(links.union(rest))

    # the class of every row
    root = durable(root)
    least = nodes.join(root, "node").groupBy("root").agg(F.min("id").alias("class_id"))
    of_root = _spread_join(root, least, "root", F.xxhash64("node")).select("node", "root", "class_id")
    of_node = nodes.select("node", "id").join(of_root, "node", "left")
    of_node = of_node.select("node", F.coalesce("root", "node").alias("root"), F.coalesce("class_id", "id").alias("class_id"))
    of_text = _spread_join(signed.filter(F.col("node").isNotNull()).select("id", "node"), of_node, "node", F.xxhash64("id"))
    alone = signed.filter(F.col("node").isNull()).select("id", "node", F.col("id").alias("class_id"), F.col("node").alias("root"))
    return of_text.select("id", "node", "class_id", "root").union(alone).withColumnRenamed("id", id_col)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, node): the node of each row's text."""
    for batch in batches:
        for part in pieces(batch, "text"):
            word, bounds = hashes(*text_bytes(part.column("text")))[:2]
            yield pa.RecordBatch.from_arrays([part.column("row"), _bytes(_digest(word, bounds), np.diff(bounds) > 0)], ["row", "node"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (h, node) for each shingle of a multiset."""
    for batch in batches:
        for part in pieces(batch, "shingles"):
            data, offsets = text_bytes(part.column("shingles"))
            of = np.repeat(np.arange(part.num_rows), np.diff(offsets) // 8)
            h = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), part.column("node").take(pa.array(of))], ["h", "node"])


def _possible(loose: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different roots that can reach the similarity; none that does is missing.

    A node can't if over a fifth of its shingles are its own. The shingles of the others are
    ordered from rare to common; two nodes that reach the similarity share one early in both
    orders, and from where the first shared one stands their overlap has a bound. Text that a
    whole family shares is common and stands late, so members are not paired for it."""
    spread = lambda nodes: texts.join(nodes.select("node"), "node", "left_semi").select("node", "shingles").mapInArrow(_spread, "h bigint, node binary")
    single = spread(loose).groupBy("h").agg(F.count("*").alias("n"), F.first("node").alias("node")).filter(F.col("n") == 1)
    own = single.groupBy("node").agg(F.count("*").alias("own"))
    able = durable(loose.join(own, "node", "left").filter(F.coalesce("own", F.lit(0)) <= (1 - SIMILARITY) * F.col("size") + 1e-6).drop("own"))
    each = durable(spread(able))
    common = each.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    node = W.partitionBy("node")
    placed = each.join(common, "h").withColumn("rank", F.row_number().over(node.orderBy("n", "h"))).withColumn("among", F.count("*").over(node))
    early = placed.join(able, "node").withColumn("place", F.col("size") - F.col("among") + F.col("rank") - 1).filter(F.col("place") <= (1 - SIMILARITY) * F.col("size") + 1e-6)
    early = durable(early.select("h", "node", "root", "size", "place"))
    p, q = early.alias("p"), early.alias("q")
    needed = SIMILARITY / (1 + SIMILARITY) * (F.col("p.size") + F.col("q.size")) - 1e-6
    bound = (F.col("p.size") - F.col("p.place") >= needed) & (F.col("q.size") - F.col("q.place") >= needed)
    pairs = p.join(q, (F.col("p.h") == F.col("q.h")) & (F.col("p.root") < F.col("q.root")) & bound)
    return pairs.select(F.col("p.node").alias("a"), F.col("q.node").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with all its columns: that of the least id, and of rows of the
    class that repeat this id any one. Rows whose text is null or has no words, and rows with a null
    id, all stay. If an id repeats with different texts, each row is judged by its own text."""
    found = durable(_rooted(docs, id_col, text_col).select(F.col(id_col).alias("_id"), "node", "class_id", "root"))
    gone = durable(found.filter(F.col("_id") != F.col("class_id")).select("_id").distinct())
    kept = docs.join(small(gone), docs[id_col] == gone["_id"], "left_anti")
    twice = durable(found.filter(F.col("_id").isNotNull()).groupBy("_id").count().filter(F.col("count") > 1).select("_id"))
    if twice.isEmpty():
        return kept
    single = kept.join(small(twice), kept[id_col] == twice["_id"], "left_anti")
    repeated = docs.join(small(twice), docs[id_col] == twice["_id"], "left_semi")
    # the row travels in a struct, so that its columns' names can't clash with those used here
    packed = repeated.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    named = packed.mapInArrow(_named, StructType([packed.schema["row"], StructField("node", BinaryType())])).select("row", F.col("row")[id_col].alias("_id"), "node")
    named = durable(named)
    first = found.filter(F.col("node").isNotNull() & (F.col("_id") == F.col("class_id"))).join(small(twice), "_id", "left_semi").select("_id", "node", "root").distinct()
    chosen = named.join(first, ["_id", "node"]).dropDuplicates(["root"])
    columns = [F.col("row")[c].alias(c) for c in docs.columns]
    return single.union(named.filter(F.col("node").isNull()).select(columns)).union(chosen.select(columns))
