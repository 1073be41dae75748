"""Cleaning and chunking against plain Python models, on texts the tables do not hold."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.session import durable
from quern.config import AUTO, Chunking, CleanRules, env_truthy
from quern.functions import text as T
from quern.operators import chunk

ODD = [
    "", " ", "\t\n", "a\tb\rc", "a  b", "x  \n\n\n\ny", " lead ", "one\n\n\n\n\ntwo", "a  \n b", "• one\n- two\n– three\n* four", "| a | b |\n" * 40,
    "short\n" * 300, "x" * 5000, ("word " * 60 + "\n") * 20, "line sep\u0085next", "\x00\x01bad\x1f", "Привет, мир \n\n конец ", "\U0001f600" * 700,
]


def model_clean(t):
    t = "".join(c for c in (t or "") if c == "\n" or c >= " ")
    t = re.sub(r"[ \t]+", " ", t).replace(" ", " ")
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"\s+\n", "\n", t)).strip()


def model_size(t, cfg):
    score = (t.count("\n") / 2 + 3 * t.count("|") + 2 * t.count("\t") + 1.5 * sum(t.count(b) for b in ("•", "- ", "– ", "* "))) / max(1, len(t) / 1000)
    lengths = [len(x.strip()) for x in t.splitlines() if x.strip()]
    mean = sum(lengths) / len(lengths) if lengths else 0
    size = cfg.high if score >= 6 else (cfg.low + cfg.high) // 2 if score >= 3 else cfg.low
    return min(cfg.high, int(size * 1.2)) if mean <= 40 else max(cfg.low, int(size * 0.85)) if mean >= 140 else size


def model_spans(t, size, overlap):
    at, out = 0, []
    while t.strip():
        end = min(len(t), at + 4 * size)
        out.append((at, end, t[at:end]))
        if end == len(t):
            break
        at = end - 4 * overlap
    return out


def model_chunks(pages, cfg):
    ids, out = {}, []
    for doc, page, raw in sorted(pages, key=lambda p: (p[0], p[1])):
        t = model_clean(raw)
        size = model_size(t, cfg) if cfg.mode == "auto" else cfg.size
        seen = set()
        for start, end, text in model_spans(t, size, int(size * cfg.ratio) if cfg.mode == "auto" else cfg.overlap):
            key = text.strip()[:256]
            if key and key not in seen:
                seen.add(key)
                ids[doc] = ids.get(doc, -1) + 1
                out.append((doc, ids[doc], page, start, end, text))
    return out


@pytest.mark.parametrize("cfg", [AUTO, Chunking("fixed", 50, 10), Chunking("fixed", 10, 0)])
def test_chunks_match_the_model(spark, cfg):
    pages = [(f"d{i % 3}", i, t) for i, t in enumerate(ODD)] + [("d0", 5000, "later block " * 40), ("d1", 9000, "x" * 3000)]
    found = chunk.chunk_pages(spark.createDataFrame(pages, "doc string, page bigint, text string"), cfg).collect()
    assert sorted(map(tuple, found)) == sorted(model_chunks(pages, cfg))


def test_clean_matches_the_model(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None])], "i int, text string").select("i", T.clean("text"), T.strip_control("text")).collect()
    assert all(r[1] == model_clean([*ODD, None][r[0]]) for r in rows)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x85\x1c\x1d\x1e  "), max_size=200), min_size=20, max_size=40))
def test_clean_property(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", T.clean("text").alias("c")).collect()
    assert all(r.c == model_clean(texts[r.i]) for r in rows)


def test_fixed_windows_cover_the_text(spark):
    text = "".join(chr(97 + k % 26) for k in range(1003))
    found = sorted(chunk.split_pages(spark.createDataFrame([("d", 1, text)], "doc string, page int, text string"), Chunking("fixed", 25, 5)).select("start", "text").collect())
    seen = ""
    for r in found:
        assert r.start <= len(seen)
        seen = seen[: r.start] + r.text
    assert seen == text


def test_settings_are_checked():
    for bad in (dict(size=10, overlap=10), dict(mode="other"), dict(low=5, high=4), dict(size=0)):
        with pytest.raises(ValueError):
            Chunking(**bad)
    assert env_truthy(" Yes ") and not env_truthy("0") and env_truthy(None, True)


def test_rules_and_counts(spark):
    df = spark.createDataFrame([(" a\tb ", "abcde", "dir/a.b.pdf")], "t string, n string, f string")
    r = df.select(T.clean("t", CleanRules(False, True)), T.clean("t", CleanRules(True, False)), T.approx_tokens("n"), T.approx_tokens(F.lit("")), T.stem("f"), T.low_text("t", 4), T.printable("t")).first()
    assert tuple(r) == ("a b", " ab ", 2, 0, "a.b", True, 2)


def test_cutting_a_long_text_is_linear(spark):
    """The length of the text is not worked out again for each window: 1.2 million characters took over 20 seconds."""
    import time

    text = durable(spark.range(1).select(F.repeat(F.lit("déf ghi jkl "), 100_000).alias("t")))
    began = time.time()
    found = text.select(F.explode(chunk.spans(F.col("t"), F.lit(130), F.lit(26))).alias("x")).select("x.*").collect()
    assert time.time() - began < 8
    plain = "déf ghi jkl " * 100_000
    assert [(r.start, r.end) for r in found] == [(k, min(len(plain), k + 520)) for k in range(0, len(plain) - 520 + 416, 416)]
    assert all(r.text == plain[r.start : r.end] for r in found)
