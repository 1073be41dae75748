"""Alignment of two tokenizers' tokens over a corpus, by id-striped dense count matrices.

Tokens of both sides (A, B) are laid over the same bytes. Where the byte ranges of an A and a B
token overlap, the two are linked. B ids are dealt round robin to STRIPES stripes; the counts of a
stripe's id pairs fill one dense block (its B ids x all A ids), which np.add.at adds up and whose
row maxima are the best partners. Links travel to the stripe of their B id, next to its block, and
are scored there.

Documents are read in flushes of a few MB. Each sends one row for each stripe: its distinct pairs
with their numbers, and for each pair the documents that hold it. So a pair that fills a third of a
corpus is one entry a flush. A task holds one block and the sums of at most ROUND flushes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm.tables import durable, pieces

#: Blocks of the count matrix; a block has every STRIPES-th B id.
STRIPES = 512
#: Stripes are scored in so many groups; a document's sums come from each group once.
GROUPS = 32
#: Bytes of text and rows of one flush, beyond which it is sent on.
FLUSH_BYTES, FLUSH_ROWS = 4 << 20, 4096
#: Flushes that are scored in one round: a task holds two numbers for each of their documents.
ROUND = 512
#: Flushes whose counts one task adds to a block; more go over one more level.
FAN_IN = 4096
#: What splits a text before the merges of a byte-level tokenizer; fixed value.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BEYOND_LATIN = regex.compile(r"[^\x00-ɏ]")
_SHIFT = 12  # bits of a row within a flush


def byte_of_character() -> dict[str, int]:
    """What each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the
    other bytes in their order from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Side A: a byte-level BPE tokenizer file (JSON).

    Texts of Latin characters are encoded by the same merges as ranks, several times as fast; characters beyond
    them, whose classes may differ between the two libraries' Unicode versions, go through the file's own library.
    The ranks are used only if the file is plain byte-level BPE whose merges are in the order of their ids."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        self.own = Tokenizer.from_str(content.decode())
        self.own.encode_special_tokens = True
        back = byte_of_character()
        vocabulary = spec["model"]["vocab"]
        self.bytes = [b""] * (max([*vocabulary.values(), *[x["id"] for x in spec["added_tokens"]]]) + 1)
        for token, k in vocabulary.items():
            self.bytes[k] = bytes(back[c] for c in token)
        merges = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        before = spec["pre_tokenizer"]
        plain = before["type"] == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True) and not spec["normalizer"]
        self.fast = None
        if plain and all(vocabulary.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)):
            ranks = {x: k for k, x in enumerate(self.bytes) if x}
            self.fast = tiktoken.Encoding("side-a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        slow = []
        for k, x in enumerate(texts):
            if self.fast is None or _BEYOND_LATIN.search(x):
                slow.append(k)
            else:
                out[k] = self.fast.encode_to_numpy(x, disallowed_special=()).astype(np.int64)
        for k in slow:  # one by one: a batch would take all cores
            out[k] = np.array(self.own.encode(texts[k], add_special_tokens=False).ids, np.int64)
        return out


class Pieces:
    """Side B: a sentencepiece model file, which puts a space before the text itself."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(k) for k in range(n)]
        self.bytes = [bytes([int(x[3:5], 16)]) if self.model.is_byte(k) else x.replace("▁", " ").encode() for k, x in enumerate(names)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


class Sides:
    """Both tokenizers, the sizes of their tokens, and where a pair of ids stands in the striped matrix."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.size_a, self.size_b = (np.array([len(x) for x in s.bytes], np.int64) for s in (self.a, self.b))
        self.n_a, self.n_b = len(self.size_a), len(self.size_b)
        self.rows = -(-self.n_b // STRIPES)
        # Decimal ids with the mark after them: , or | on side A, then , or ; on side B.
        marked = [f"{k}{m}".encode() for n, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for m in marks for k in range(n)]
        self.marked, self.marked_size = np.array(marked), np.array([len(x) for x in marked], np.int64)

    def place(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((b % STRIPES) * self.rows + b // STRIPES) * self.n_a + a


_SIDES: dict[int, Sides] = {}


def sides(a: bytes, b: bytes) -> Sides:
    """Both tokenizers, once for each Python worker."""
    key = hash((a, b))
    if key not in _SIDES:
        _SIDES.clear()
        _SIDES[key] = Sides(a, b)
    return _SIDES[key]


class Aligned:
    """Groups and links of some texts; a text whose tokens don't spell out space + text has none."""

    def __init__(self, s: Sides, texts: list[str]):
        n = len(texts)
        self.count = np.zeros((4, n), np.int64)  # A tokens, B tokens, groups, links
        self.digest, self.groups = [""] * n, [""] * n
        self.link_doc = self.link_place = np.zeros(0, np.int64)
        some = [k for k in range(n) if texts[k]]
        raw = [b" " + texts[k].encode() for k in some]
        got_a, got_b = s.a.encode([" " + texts[k] for k in some]), s.b.encode([texts[k] for k in some])
        spelt = [
            all(b"".join(map(side.bytes.__getitem__, x.tolist())) == r for side, x in ((s.a, x), (s.b, y))) for x, y, r in zip(got_a, got_b, raw)
        ]
        docs = np.array([k for k, ok in zip(some, spelt) if ok], np.int64)
        if len(docs):
            self._lay(s, docs, [x for x, ok in zip(got_a, spelt) if ok], [x for x, ok in zip(got_b, spelt) if ok])

    def _lay(self, s: Sides, docs: np.ndarray, got_a: list[np.ndarray], got_b: list[np.ndarray]) -> None:
        a, b = np.concatenate(got_a), np.concatenate(got_b)
        n_a, n_b = np.array([len(x) for x in got_a]), np.array([len(x) for x in got_b])
        end_a, end_b = np.cumsum(s.size_a[a]), np.cumsum(s.size_b[b])
        doc_end = end_a[np.cumsum(n_a) - 1]
        mark = np.zeros(int(doc_end[-1]) + 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        # Between two neighbouring ends of either side lies one A and one B token: a link.
        bound = np.flatnonzero(mark)
        ends = mark[bound]
        is_a, is_b, cut = (ends & 1) > 0, ends > 1, ends == 3
        of_a, of_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
        group = np.cumsum(cut) - cut
        links = np.diff(np.searchsorted(bound, doc_end, "right"), prepend=0)
        groups = np.diff(np.searchsorted(bound[cut], doc_end, "right"), prepend=0)
        self.count[:, docs] = n_a, n_b, groups, links
        self.link_doc, self.link_place = np.repeat(docs, links), s.place(a[of_a], b[of_b])
        # Tokens by group, A before B, each with the mark that follows it.
        group_a, group_b = group[is_a], group[is_b]
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        upto_a, upto_b = (np.cumsum(np.bincount(g)) for g in (group_a, group_b))
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.where(group_a > 0, upto_b[group_a - 1], 0)] = a + last_a * s.n_a
        order[np.arange(len(b)) + upto_a[group_b]] = b + 2 * s.n_a + last_b * s.n_b
        letters = s.marked[order].view(np.uint8)
        letters = letters[letters != 0]
        stop = np.cumsum(s.marked_size[order])[np.cumsum(n_a + n_b) - 1].tolist()
        for doc, lo, hi in zip(docs.tolist(), [0, *stop], stop):
            self.groups[doc] = letters[lo : hi - 1]
            self.digest[doc] = hashlib.sha256(self.groups[doc]).hexdigest()


def _pack(*arrays: np.ndarray) -> bytes:
    raw = b"".join(x.tobytes() for x in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


class Flush:
    """Links of some documents, gathered until they are sent on as one row for each stripe."""

    def __init__(self, number: int):
        self.number, self.rows, self.bytes, self.keys = number, 0, 0, []

    def add(self, found: Aligned, n: int, size: int) -> None:
        self.keys.append(found.link_place << _SHIFT | (found.link_doc + self.rows))
        self.rows += n
        self.bytes += size

    def stripes(self, s: Sides) -> Iterator[tuple[int, bytes, bytes]]:
        key = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        if not len(key):
            return
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times = np.diff(np.append(first, len(key)))
        place, doc = key[first] >> _SHIFT, (key[first] & ((1 << _SHIFT) - 1)).astype(np.uint16)
        pair = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        run, total, place = np.diff(np.append(pair, len(place))), np.add.reduceat(times, pair), place[pair]
        block = s.rows * s.n_a
        cut = np.searchsorted(place, np.arange(STRIPES + 1) * block)
        at = np.append(pair, len(doc))[cut]
        for k in np.flatnonzero(np.diff(cut)).tolist():
            p, e = slice(cut[k], cut[k + 1]), slice(at[k], at[k + 1])
            counts = _pack((place[p] - k * block).astype(np.uint32), total[p])
            yield k, counts, _pack(run[p].astype(np.uint32), times[e].astype(np.uint32), doc[e])


_RAW = "flush bigint, at int, id {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, stripe int, counts binary, links binary"


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def raw_links(docs: DataFrame, a: bytes, b: bytes, id_col: str, text_col: str, groups: bool) -> DataFrame:
    """One row for each document (its numbers and digest), and one for each flush and stripe (its links)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, part, serial = sides(a, b), TaskContext.get().partitionId(), 0
        schema = None
        flush = Flush(part << 32)

        def rows(**have) -> pa.RecordBatch:
            n = len(next(iter(have.values())))
            return pa.RecordBatch.from_arrays([have[f.name] if f.name in have else pa.nulls(n, f.type) for f in schema], schema=schema)

        def sent() -> Iterator[pa.RecordBatch]:
            for k, counts, links in flush.stripes(s):
                yield rows(flush=pa.array([flush.number], pa.int64()), stripe=pa.array([k], pa.int32()), counts=pa.array([counts], pa.binary()), links=pa.array([links], pa.binary()))

        for batch in batches:
            if schema is None:
                long, text = pa.int64(), pa.string()
                fields = {"flush": long, "at": pa.int32(), "id": batch.schema.field("id").type, "n_a": long, "n_b": long, "n_groups": long, "n_links": long, "groups_sha256": text, "groups": text, "stripe": pa.int32()}
                schema = pa.schema([*fields.items(), ("counts", pa.binary()), ("links", pa.binary())])
            for piece in pieces(batch, "text", rows=FLUSH_ROWS // 4):
                found = Aligned(s, [x or "" for x in piece.column("text").to_pylist()])
                n = piece.num_rows
                n_a, n_b, n_groups, n_links = (pa.array(x, pa.int64()) for x in found.count)
                shown = {"groups": pa.array([x.tobytes().decode() if len(x) else "" for x in found.groups])} if groups else {}
                yield rows(
                    flush=pa.array(np.full(n, flush.number)), at=pa.array(np.arange(flush.rows, flush.rows + n, dtype=np.int32)), id=piece.column("id"), n_a=n_a, n_b=n_b, n_groups=n_groups,
                    n_links=n_links, groups_sha256=pa.array(found.digest, pa.string()), **shown,
                )
                flush.add(found, n, piece.nbytes)
                if flush.bytes >= FLUSH_BYTES or flush.rows + FLUSH_ROWS // 4 > FLUSH_ROWS:
                    yield from sent()
                    serial += 1
                    flush = Flush(part << 32 | serial)
        if schema is not None:
            yield from sent()

    return durable(source.mapInArrow(run, _RAW.format(id=kind)))


def _blocks(parts: DataFrame, keys: list[str], size: int) -> DataFrame:
    """One row for each value of ``keys`` (stripe first): the sums of its counts, added in a dense block."""
    schema = pa.schema([(k, pa.int32()) for k in keys] + [("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now = None, None

        def row() -> pa.RecordBatch:
            at = np.flatnonzero(block)
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int32()) for x in now], pa.array([_pack(at.astype(np.uint32), block[at])], pa.binary())], schema=schema)

        for batch in batches:
            for *key, data in zip(*[batch.column(k).to_pylist() for k in keys], batch.column("counts")):
                if key != now:
                    if now is not None:
                        yield row()
                    block, now = np.zeros(size, np.int64), key
                at, n = read_counts(data.as_py())
                np.add.at(block, at, n)
        if now is not None:
            yield row()

    by = parts.select(*keys, "counts").repartition(*keys).sortWithinPartitions(*keys)
    return by.mapInArrow(run, ", ".join(f"{k} int" for k in keys) + ", counts binary")


def read_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places within a block, and the number at each."""
    raw = _unpack(data)
    n = len(raw) // 12
    return np.frombuffer(raw, np.uint32, n), np.frombuffer(raw, np.int64, n, 4 * n)


def stripe_counts(raw: DataFrame, size: int, flushes: int) -> DataFrame:
    """(stripe, counts): how many links of the corpus hold each pair of ids."""
    parts = raw.filter("stripe is not null").select("stripe", "counts", "flush")
    fan = -(-flushes // FAN_IN)
    if fan > 1:
        parts = _blocks(parts.withColumn("fan", F.pmod(F.xxhash64("flush"), F.lit(fan)).cast("int")), ["stripe", "fan"], size)
    return durable(_blocks(parts, ["stripe"], size))


def _scores(raw: DataFrame, counts: DataFrame, n_a: int, size: int, flushes: int) -> DataFrame:
    """(flush, at, n_best, count_sum), some for each document, to be added up."""
    rounds = max(1, -(-flushes // ROUND))
    links = raw.filter("stripe is not null").select(F.pmod(F.xxhash64("flush"), F.lit(rounds)).cast("int").alias("round"), "stripe", "flush", "counts", "links")
    blocks = counts.select(F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"), "stripe", F.lit(-1).cast("bigint").alias("flush"), "counts", F.lit(None).cast("binary").alias("links"))
    both = links.unionByName(blocks).withColumn("group", F.col("stripe") % GROUPS)
    both = both.repartition("round", "group").sortWithinPartitions("round", "group", "stripe", "flush")  # the block is flush -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, most, now = np.zeros(size, np.int64), None, None
        held: dict[int, np.ndarray] = {}  # by flush: best and sum of each of its rows

        def rows() -> Iterator[pa.RecordBatch]:
            for flush, (best, total) in held.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), flush)), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])], ["flush", "at", "n_best", "count_sum"])

        for batch in batches:
            for key, flush, data, links in zip(zip(*[batch.column(k).to_pylist() for k in ("round", "group")]), batch.column("flush").to_pylist(), batch.column("counts"), batch.column("links")):
                if key != now:
                    yield from rows()
                    held, now = {}, key
                place, n = read_counts(data.as_py())
                if flush < 0:
                    block[:] = 0
                    np.add.at(block, place, n)
                    most = block.reshape(-1, n_a).max(axis=1)
                    continue
                raw = _unpack(links.as_py())
                run_of = np.frombuffer(raw, np.uint32, len(place))
                entries = (len(raw) - 4 * len(place)) // 6
                times = np.frombuffer(raw, np.uint32, entries, 4 * len(place)).astype(np.int64)
                doc = np.frombuffer(raw, np.uint16, entries, 4 * (len(place) + entries))
                count = block[place]
                if flush not in held:
                    held[flush] = np.zeros((2, FLUSH_ROWS), np.int64)
                best, total = held[flush]
                np.add.at(best, doc, np.repeat(count == most[place // n_a], run_of) * times)
                np.add.at(total, doc, np.repeat(count, run_of) * times)
        yield from rows()

    return both.mapInArrow(run, "flush bigint, at int, n_best bigint, count_sum bigint")


class Alignment:
    """The alignment of the texts of ``docs`` by two tokenizer files of the driver (under 3 MB together).

    * :meth:`documents`: for each row of ``docs`` (also if ids repeat or are null) the numbers of tokens, groups and
      links, a digest of its groups (and with ``groups`` their text, ``a1,a2|b1;a3|b2``), how many of its links are the
      best of their B id in the corpus (ties included), and the sum of their counts.
    * :meth:`pairs`: (a_id, b_id, count, best) of every pair of ids that is linked anywhere.

    Null and empty texts, and texts that either side doesn't spell out byte for byte, have no tokens:
    zeros and an empty digest. An empty table gives no rows. Other columns are not read. The whole text
    counts, whatever its length; one text is held by one task. Costs: a pass that encodes, one shuffle of the
    flushes' distinct pairs, and one of the links, both packed."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False):
        a, b = _read(a_path), _read(b_path)
        both = sides(a, b)
        self.n_a, self.n_b, self.rows, self.id_col, self.with_groups = both.n_a, both.n_b, both.rows, id_col, groups
        self.raw = raw_links(docs, a, b, id_col, text_col, groups)
        self.flushes = self.raw.filter("at = 0").count()
        self.counts = stripe_counts(self.raw, self.rows * self.n_a, self.flushes)

    def pairs(self) -> DataFrame:
        n_a, rows = self.n_a, self.rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for stripe, data in zip(batch.column("stripe").to_pylist(), batch.column("counts")):
                    place, n = read_counts(data.as_py())
                    most = np.zeros(rows, np.int64)
                    np.maximum.at(most, place // n_a, n)
                    a, b = (place % n_a).astype(np.int64), (place // n_a).astype(np.int64) * STRIPES + stripe
                    for at in range(0, len(n), 1 << 16):
                        cut = slice(at, at + (1 << 16))
                        yield pa.RecordBatch.from_arrays([pa.array(a[cut]), pa.array(b[cut]), pa.array(n[cut]), pa.array(n[cut] == most[place[cut] // n_a])], ["a_id", "b_id", "count", "best"])

        return self.counts.mapInArrow(run, "a_id bigint, b_id bigint, count bigint, best boolean")

    def documents(self) -> DataFrame:
        sums = _scores(self.raw, self.counts, self.n_a, self.rows * self.n_a, self.flushes).groupBy("flush", "at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        facts = self.raw.filter("at is not null").drop("stripe", "counts", "links", *[] if self.with_groups else ["groups"])
        out = facts.join(sums, ["flush", "at"], "left").withColumnRenamed("id", self.id_col)
        return out.fillna(0, ["n_best", "count_sum"]).drop("flush", "at")
