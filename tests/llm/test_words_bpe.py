"""Word hashes, and BPE against the tiktoken library."""

import base64
import hashlib
import random
import re
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import bpe
from quern.llm.tables import pieces, text_bytes
from quern.llm.words import hashes, shingles

RAW = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
CODEC = bpe.Codec(RAW, P.PATTERN)
TRUTH = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in (x.split() for x in RAW.splitlines())}, special_tokens={})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ids(text):
    raw = CODEC.encode([text])[0]
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encodes_as_tiktoken(text):
    assert ids(text) == TRUTH.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode([text])[0]) == text.encode()


def test_token_joins_encode_as_tiktoken():
    random.seed(5)
    tokens = list(CODEC.vocabulary.rank)
    for _ in range(3000):
        text = b"".join(random.choices(tokens, k=random.randint(1, 4))).decode("utf-8", "replace")
        assert ids(text) == TRUTH.encode_ordinary(text)


def test_appends_and_edits():
    random.seed(6)
    v = CODEC.vocabulary
    for _ in range(200):
        data = bytes(random.choices(b"abcdehinoprstu", k=random.randint(1, 40)))
        table = bpe.PrefixTable(v)
        for b in data:
            table.append(bytes([b]))
        assert table.tokens() == bpe.PrefixTable(v, data).tokens()
        i, j = sorted(random.choices(range(len(data) + 1), k=2))
        assert table.replace(i, j, b"ing").tokens() == bpe.PrefixTable(v, data[:i] + b"ing" + data[j:]).tokens()


def test_messy_rows(messy, nothing):
    rows = bpe.encode_decode(messy, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert len(rows) == messy.count()
    texts = [r.text or "" for r in messy.select("text").collect()]
    assert sorted(hashlib.sha256(bytes(r.decoded)).hexdigest() for r in rows) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts)
    assert sorted(r.n_tokens for r in rows) == sorted(len(TRUTH.encode_ordinary(t)) for t in texts)
    assert bpe.encode_decode(nothing, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("aB é中1 .\n", max_size=40)), min_size=1, max_size=8))
def test_word_hashes_name_words(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    h, bounds, four = hashes(data, offsets, (4,))
    words = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(flat)) == len(set(h.tolist())) and len(set(zip(flat, h.tolist()))) == len(set(flat))
    assert [x != 0 for x in four] == [len(w.encode()) > 4 for w in flat]
    s, of = shingles(h, bounds, 5)
    assert np.bincount(of, minlength=len(texts)).tolist() == [max(len(w) - 4, 1) if w else 0 for w in words]


def test_long_rows_are_cut_between_words():
    text = "ab " * 5000 + "c" * 9000 + " d"
    data, offsets = text_bytes(pa.array(["x y", text, "z"]))
    whole, cut = hashes(data, offsets), hashes(data, offsets, limit=1000)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()


def test_pieces_cover_the_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 3000, 1, 0, 2000, 7)] + [None])], ["text"])
    parts = list(pieces(batch, "text", 1500))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist() and len(parts) > 2
