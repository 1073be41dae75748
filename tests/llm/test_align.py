"""Cross-tokenizer alignment against a plain loop over token spans."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quern.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox, it's 12345 jumping!", "", None, "Über naïve Straßen — déjà vu", "  two  spaces\n\n\ttab \r\n end ", "日本語のテキスト 😀😀 mixed", "a<|endoftext|>b <s> </s> <unk> <0x41>", "x", " ",
    "▁under▁lines", "nul \x00 and \x1f and \x85 and \xa0 odd", "The quick brown fox, it's 12345 jumping!", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "ﬁ ﷺ Ⅷ ²", "the the the the the of of of", "'s 't've 'LL d'accord l'été",
]


def plain(texts):
    """The contract's rows by loops: token spans, all overlapping pairs, counts over the corpus."""
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    back = align.byte_of_character()
    rows, links = [], []
    for text in texts:
        rows.append([0, 0, 0, 0, "", ""])
        links.append([])
        if not text:
            continue
        a, b = own.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        bytes_a = [bytes(back[c] for c in own.id_to_token(k)) for k in a]
        names = [model.id_to_piece(k) for k in b]
        bytes_b = [bytes.fromhex(x[3:5]) if model.is_byte(k) else x.replace("▁", " ").encode() for k, x in zip(b, names)]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            continue
        spans = []
        for parts in (bytes_a, bytes_b):
            at = np.cumsum([0, *map(len, parts)]).tolist()
            spans.append(list(zip(at, at[1:])))
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        shown = []
        for lo, hi in zip([0, *cuts], cuts):
            shown.append("|".join(",".join(str(k) for k, (s, e) in zip(ids, sp) if lo <= s and e <= hi) for ids, sp in ((a, spans[0]), (b, spans[1]))))
        pairs = [(x, y) for x, (s, e) in zip(a, spans[0]) for y, (s2, e2) in zip(b, spans[1]) if s < e2 and s2 < e]
        links[-1] = pairs
        text = ";".join(shown)
        rows[-1] = [len(a), len(b), len(cuts), len(pairs), hashlib.sha256(text.encode()).hexdigest(), text]
    count = Counter(p for x in links for p in x)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(*r, sum(count[p] == most[p[1]] for p in x), sum(count[p] for p in x)) for r, x in zip(rows, links)], count, most


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("small", [False, True])
def test_equal_to_plain_loops(spark, monkeypatch, small):
    if small:  # many flushes, rounds and levels
        for name, value in (("FLUSH_BYTES", 64), ("ROUND", 2), ("FAN_IN", 2), ("GROUPS", 3)):
            monkeypatch.setattr(align, name, value)
        monkeypatch.setattr("quern.llm.tables.PIECE_ROWS", 2)
    texts = TEXTS * 3
    want, count, most = plain(texts)
    found = align.Alignment(frame(spark, texts).repartition(3), A, B, groups=True)
    got = found.documents().orderBy("doc_id").collect()
    keys = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "n_best", "count_sum")
    assert [tuple(r[k] for k in keys) for r in got] == want
    assert want[TEXTS.index("▁under▁lines")][0] == 0 < want[6][0]
    pairs = {(r.a_id, r.b_id): (r["count"], r.best) for r in found.pairs().collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in count.items()}


def test_ranks_equal_the_file(spark):
    """The fast path gives the ids of the file's own library on texts of Latin characters."""
    s = align.ByteLevel(open(A, "rb").read())
    assert s.fast is not None
    rng = np.random.default_rng(5)
    alphabet = [chr(c) for c in range(0x250) if c != 0xAD] + list("  \n\n''stdm") * 30
    texts = ["".join(rng.choice(alphabet, 400)) for _ in range(300)] + ["a" * 5000, " " * 100_000, "\n" * 70_000 + "x", "<|endoftext|>" * 9]
    for text, got in zip(texts, s.encode(texts)):
        assert got.tolist() == s.own.encode(text, add_special_tokens=False).ids


def test_messy_rows(spark, messy, nothing):
    got = align.Alignment(messy, A, B).documents()
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    rows = got.collect()
    assert len(rows) == messy.count()
    want, _, _ = plain([r.text for r in messy.filter("doc_id is null or doc_id <> 6").collect()])
    assert sorted((r.n_a, r.n_b, r.n_links, r.groups_sha256) for r in rows if r.doc_id != 6) == sorted((w[0], w[1], w[3], w[4]) for w in want)
    assert align.Alignment(nothing, A, B).documents().count() == 0
    assert align.Alignment(nothing, A, B).pairs().count() == 0
