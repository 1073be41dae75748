"""Byte-level BPE encoding and decoding by prefix dynamic programming.

Every byte prefix of a piece has exactly one valid last token: the last token of
the prefix's own BPE encoding. The table of these tokens is filled from left to
right; a token that ends at byte i is the valid one if it is the whole prefix or
if it may follow the last token of the prefix before it. Reading the table
backwards gives the encoding. Appending bytes only appends entries, and after an
edit the entries before it stay as they are (:class:`PrefixTable`). The tables of many short
pieces are filled side by side (:class:`Lattice`)."""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.tables import pieces

#: Distinct pieces whose encoding one Python worker remembers at most; then rare ones are forgotten.
CACHE_PIECES = 250_000
#: Token pairs whose verdict one Python worker remembers at most.
CACHE_PAIRS = 300_000
#: Pieces of at most so many bytes are encoded side by side; longer ones each by a table of its own.
SHORT = 64


class IntTable:
    """Non-negative 64-bit keys to 32-bit numbers, by open addressing; looked up for whole arrays."""

    def __init__(self, size: int):
        self.bits = max(8, (4 * size - 1).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.used = 0

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def put(self, key: np.ndarray, value: np.ndarray) -> None:
        """Adds distinct keys that are not in the table yet."""
        self.used += len(key)
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]
            mine = self.keys[slot] == key
            self.values[slot[mine]] = value[mine]
            key, value, slot = key[~mine], value[~mine], (slot[~mine] + 1) & self.mask

    def get(self, key: np.ndarray) -> np.ndarray:
        """The numbers of the keys, -1 for unknown ones."""
        slot = self._slot(key)
        held = self.keys[slot]
        out = self.values[slot]
        other = np.flatnonzero(held != key)
        out[other] = -1
        other = other[held[other] >= 0]
        while len(other):
            slot_other = slot[other] = (slot[other] + 1) & self.mask
            held = self.keys[slot_other]
            same = held == key[other]
            out[other[same]] = self.values[slot_other[same]]
            other = other[(held >= 0) & ~same]
        return out


class Vocabulary:
    """Ranks of byte strings, as in the lines ``base64 rank`` of a rank file."""

    def __init__(self, rank_file: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file.splitlines() if x)}
        self.bytes = dict(zip(self.rank.values(), self.rank.keys()))
        self.pairs: dict[int, bool] = {}  # by left << 32 | right
        # How merging builds each token; a token that merging never builds has no entry.
        self.built: dict[int, tuple[int, int] | None] = {}
        for token, r in sorted(self.rank.items(), key=lambda x: x[1]):
            parts = self.merge(token, r)
            if len(parts) == 1:
                self.built[r] = None
            elif len(parts) == 2:
                self.built[r] = (self.rank[parts[0]], self.rank[parts[1]])
        self.usable = {token: r for token, r in self.rank.items() if r in self.built}
        #: The longest token that ends with three given bytes.
        self.reach: dict[bytes, int] = {}
        for token in self.usable:
            self.reach[token[-3:]] = max(len(token), self.reach.get(token[-3:], 2))

    def merge(self, piece: bytes, below: int) -> list[bytes]:
        """Merges of rank under ``below``, lowest rank first, leftmost on ties."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1], below)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging ``left + right`` would leave exactly these two tokens.

        Walks the seam back in time: of the two tokens at the seam the one made last is
        taken apart, and no merge across the seam may have come before the merge undone."""
        known = self.pairs.get(left << 32 | right)
        if known is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[left << 32 | right] = self._seam(left, right)
        return known

    def _seam(self, left: int, right: int) -> bool:
        until = 1 << 62  # merges across the seam of a lower key come first
        rank, text, built = self.rank, self.bytes, self.built
        a, b = left, right
        while True:
            across = rank.get(text[a] + text[b])
            # at equal rank the leftmost merge comes first: 2r before 2r + 1
            if across is not None and 2 * across < until:
                return False
            undo_a, undo_b = built[a], built[b]
            if undo_a is None and undo_b is None:
                return True
            if undo_b is None or (undo_a is not None and a > b):
                until, a = 2 * a, undo_a[1]
            else:
                until, b = 2 * b + 1, undo_b[0]


class PrefixTable:
    """The valid last token of each prefix of a growing piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> "PrefixTable":
        start = len(self.data)
        self.data += more
        data, last, v = self.data, self.last, self.vocabulary
        token_of, may_follow, pairs, reach = v.usable.get, v.may_follow, v.pairs, v.reach.get
        for end in range(start + 1, len(data) + 1):
            for at in range(max(0, end - reach(data[end - 3 : end], 2)) if end > 2 else 0, end):
                token = token_of(data[at:end])
                if token is not None:
                    if at == 0:
                        break
                    ok = pairs.get(last[at - 1] << 32 | token)
                    if may_follow(last[at - 1], token) if ok is None else ok:
                        break
            else:
                raise ValueError(f"no token ends at byte {end} of {data!r}")
            last.append(token)
        return self

    def replace(self, start: int, end: int, new: bytes) -> "PrefixTable":
        """As if bytes start..end had been ``new``; what lies before stays."""
        rest = self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        return self.append(new + rest)

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        size = self.vocabulary.bytes
        while at:
            out.append(self.last[at - 1])
            at -= len(size[out[-1]])
        return out[::-1]


class Lattice:
    """The prefix tables of many pieces at once: step ``at`` finds, in a trie of the tokens, all that
    begin at byte ``at`` of any piece, and enters each where it ends if it may follow the last token
    of the prefix before it. That token is known by then, as it began earlier."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        arcs: dict[int, int] = {}
        token = [-1]
        for text, r in vocabulary.usable.items():
            node = 0
            for byte in text:
                node = arcs.setdefault(node << 8 | byte, len(token))
                if node == len(token):
                    token.append(-1)
            token[node] = r
        self.token = np.array(token, np.int32)
        self.arcs = IntTable(len(arcs))
        self.arcs.put(np.fromiter(arcs.keys(), np.int64, len(arcs)), np.fromiter(arcs.values(), np.int32, len(arcs)))
        self.size = np.zeros(max(vocabulary.bytes) + 1, np.int64)
        for r, text in vocabulary.bytes.items():
            self.size[r] = len(text)
        self.pairs = IntTable(CACHE_PAIRS)

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        known = self.pairs.get(key)
        new = np.flatnonzero(known < 0)
        if len(new):
            keys, at = np.unique(key[new], return_inverse=True)
            seam = self.vocabulary._seam
            verdict = np.array([seam(k >> 32, k & 0xFFFFFFFF) for k in keys.tolist()], np.int32)
            if self.pairs.used + len(keys) > CACHE_PAIRS:
                self.pairs = IntTable(CACHE_PAIRS)
            self.pairs.put(keys[:CACHE_PAIRS], verdict[:CACHE_PAIRS])
            known[new] = verdict[at]
        return known > 0

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        length = np.array([len(x) for x in pieces], np.int64)
        order = np.argsort(-length, kind="stable")
        n = length[order]
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        first = (np.cumsum(length) - length)[order]
        base = np.cumsum(n + 1) - n - 1  # where a piece's table begins; entry k is for its first k bytes
        last = np.full(int((n + 1).sum()), -1, np.int32)
        for at in range(int(n[0]) if len(n) else 0):
            piece = np.arange(np.searchsorted(-n, -at, "left"))  # those of more than ``at`` bytes
            before = last[base[piece] + at]
            if at and (before < 0).any():
                raise ValueError(f"no token ends at byte {at} of {pieces[order[np.argmin(before)]]!r}")
            node, end = np.zeros(len(piece), np.int64), at
            while len(piece):
                node = self.arcs.get(node << 8 | data[first[piece] + end])
                some = np.flatnonzero(node >= 0)
                piece, node = piece[some], node[some].astype(np.int64)
                end += 1
                token, place = self.token[node], base[piece] + end
                hit = np.flatnonzero((token >= 0) & (last[place] < 0))
                if at and len(hit):
                    hit = hit[self.may_follow(before[piece[hit]], token[hit])]
                last[place[hit]] = token[hit]
                longer = np.flatnonzero(n[piece] > end)
                piece, node = piece[longer], node[longer]
        return self._read(last, base, n, order)

    def _read(self, last: np.ndarray, base: np.ndarray, n: np.ndarray, order: np.ndarray) -> list[bytes]:
        found, owner, piece, end = [], [], np.flatnonzero(n > 0), n[n > 0]
        while len(piece):
            token = last[base[piece] + end]
            if (token < 0).any():
                raise ValueError("a piece has no encoding")
            found.append(token)
            owner.append(piece)
            end = end - self.size[token]
            piece, end = piece[end > 0], end[end > 0]
        if not found:
            return [b""] * len(n)
        owner = order[np.concatenate(owner[::-1])]
        turn = np.argsort(owner, kind="stable")  # tokens were read from the last to the first
        ids = np.concatenate(found[::-1])[turn].astype("<u4").tobytes()
        cut = (4 * np.searchsorted(owner[turn], np.arange(len(n) + 1))).tolist()
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]


class Codec:
    """Texts to token ids and back. A piece that is itself in the ranks is one token.

    The empty text has no ids. Encodings of pieces are remembered, CACHE_PIECES at most; what is forgotten is
    worked out again, so the bound changes the time and never the result."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.vocabulary = Vocabulary(rank_file)
        self.lattice = Lattice(self.vocabulary)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def learn(self, found: set[str]) -> None:
        """Encodings of new pieces. Long ones are taken in byte order: the table of one piece is cut
        back to what the next piece shares with it and then appended to."""
        rank, known = self.vocabulary.rank, self.known
        short, long = [], []
        for piece in found:
            raw = piece.encode()
            whole = rank.get(raw)
            if whole is not None:
                known[piece] = struct.pack("<I", whole)
            else:
                (short if len(raw) <= SHORT else long).append((raw, piece))
        for (_, piece), ids in zip(short, self.lattice.encode([raw for raw, _ in short])):
            known[piece] = ids
        table = PrefixTable(self.vocabulary)
        for raw, piece in sorted(long):
            same = 0
            for x, y in zip(raw, table.data):
                if x != y:
                    break
                same += 1
            ids = table.replace(same, len(table.data), raw[same:]).tokens()
            known[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHE_PIECES:  # common pieces have few tokens and stay
            self.known = {k: v for k, v in self.known.items() if len(v) <= 8}
            if len(self.known) > CACHE_PIECES // 2:
                self.known.clear()
        found = [self.find(x) for x in texts]
        self.learn(set().union(*found) - self.known.keys())
        return [b"".join(map(self.known.__getitem__, x)) for x in found]

    def decode(self, ids: bytes) -> bytes:
        if struct.pack("=I", 1) != b"\1\0\0\0":
            ids = struct.pack(f"={len(ids) // 4}I", *struct.unpack(f"<{len(ids) // 4}I", ids))
        return b"".join(map(self.vocabulary.bytes.__getitem__, array("I", ids)))


_CODECS: dict[int, Codec] = {}


def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec for each vocabulary and Python worker."""
    key = hash((rank_file, pattern))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(rank_file, pattern)
    return _CODECS[key]


def read_ranks(spark: SparkSession, path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) of each row: its text's token ids (little-endian
    unsigned 32-bit), and the bytes decoded from them.

    ``ranks`` is the path of a rank file on the driver; its content (under 1 MB) goes to
    the tasks. A null or empty text has no tokens. Rows stay apart, also if ids repeat or
    are null; other columns are not read."""
    rank_file = read_ranks(docs.sparkSession, ranks)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(rank_file, pattern)
        for batch in batches:
            for part in pieces(batch, "text"):
                ids = c.encode([x or "" for x in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.binary())],
                    ["id", "n_tokens", "ids", "decoded"],
                )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary, decoded binary").withColumnRenamed("id", id_col)
