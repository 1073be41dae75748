"""Interfaces to models outside Spark, with deterministic offline stand-ins.

The stand-ins are columns, so plans that use them stay inside Spark. A real model is wrapped
with :func:`text_udf`, which hands it Arrow batches of texts and never fails the job."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.plan import let
from quern.functions.text import strip, tokens
from quern.operators.index import counted
from quern.operators.questions import rule_rewrite


class Embedder(Protocol):
    def __call__(self, text: Column) -> Column: ...


class Scorer(Protocol):
    """Relevance of a text to a question, 0 to 1."""

    def __call__(self, question: Column, text: Column) -> Column: ...


class Answerer(Protocol):
    """(answer, support) from a question, its type and its ranked hits."""

    def __call__(self, question: Column, kind: Column, hits: Column) -> Column: ...


class Judge(Protocol):
    """A reply with ``chosen``, ``final_answer`` and ``reason`` to the JSON of a question and its candidates."""

    def __call__(self, request: Column) -> Column: ...


class QuestionRewriter(Protocol):
    def __call__(self, question: Column) -> Column: ...


class OcrEngine(Protocol):
    def __call__(self, image: Column) -> Column: ...


class PageRenderer(Protocol):
    def __call__(self, document: bytes, page: int, dpi: int) -> bytes: ...


class PageParser(Protocol):
    """Pages of a document as dicts with page_number and text."""

    def __call__(self, path: str, content: bytes) -> Iterable[dict]: ...


def hashed_embedding(dim: int = 64) -> Embedder:
    """Token counts in ``dim`` buckets, signed, by the first 16 bits of the token's MD5; of length one."""
    def embed(text: Column) -> Column:
        slots = F.transform(tokens(text), lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int"), F.lit(2 * dim)))
        sums = lambda found: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda k: F.coalesce(F.element_at(found, k), F.lit(0)) - F.coalesce(F.element_at(found, k + dim), F.lit(0)))
        by_slot = lambda s: F.map_from_entries(F.transform(counted(s), lambda x: F.struct(x["term"], x["tf"].cast("int"))))
        none = F.create_map().cast("map<int,int>")
        norm = lambda r: F.struct(r.alias("r"), (F.sqrt(F.aggregate(r, F.lit(0), lambda a, x: a + x * x).cast("double")) + 1e-12).alias("n"))
        unit = lambda z: F.transform(z["r"], lambda x: (x / z["n"]).cast("float"))
        raw = let(F.coalesce(by_slot(slots), none), sums)
        return let(let(raw, norm), unit)

    return embed


def overlap_score(question: Column, text: Column) -> Column:
    """Share of the question's distinct tokens that the text has."""
    asked = F.array_distinct(tokens(question))
    return F.when(F.size(asked) == 0, 0.0).otherwise(F.size(F.array_intersect(asked, F.array_distinct(tokens(text)))) / F.size(asked))


def extractive_answer(question: Column, kind: Column, hits: Column) -> Column:
    """The first number of the first hit that has one; for text its line with most question tokens."""
    number = r"[-+]?[0-9]+(?:[.,][0-9]+)?"
    with_number = F.filter(hits, lambda h: h["text"].rlike("[0-9]"))
    first = F.get(with_number, F.lit(0))
    asked = F.array_distinct(tokens(question))
    top = F.get(hits, F.lit(0))
    lines = F.filter(F.transform(F.split(top["text"], "\n"), lambda x: strip(x)), lambda x: x != "")
    scored = F.transform(lines, lambda x, i: F.struct(F.size(F.array_intersect(asked, tokens(x))).alias("n"), (-i).alias("i"), x.alias("line")))
    numeric = F.lower(F.trim(kind)).isin("int", "float")
    return F.struct(F.when(numeric, F.regexp_extract(first["text"], number, 0)).otherwise(F.array_max(scored)["line"]).alias("answer"), F.when(numeric, first["rank"]).otherwise(top["rank"]).alias("support"))


rewrite_by_rule: QuestionRewriter = rule_rewrite


def no_ocr(image: Column) -> Column:
    return F.lit("")


def longer_candidate(request: Column) -> Column:
    """Chooses the longer candidate, the text's on ties."""
    said = lambda k: F.coalesce(F.get_json_object(request, f"$.candidates.{k}"), F.lit(""))
    vision = F.length(said("vision")) > F.length(said("text"))
    return F.to_json(F.struct(F.when(vision, "vision").otherwise("text").alias("chosen"), F.when(vision, said("vision")).otherwise(said("text")).alias("final_answer"), F.lit("longer").alias("reason")))


def with_retries(call: Callable[[str], str], default: str = "", tries: int = 4, wait: float = 1.0) -> Callable[[str], str]:
    """``call`` with back-off 1, 2, 4 ... times ``wait``; the default after the last failure."""
    def run(text: str) -> str:
        for k in range(tries):
            try:
                return call(text)
            except Exception:  # noqa: BLE001 - any failure of a remote model counts as one
                if k + 1 < tries:
                    time.sleep(wait * 2**k)
        return default

    return run


def text_udf(make: Callable[[], Callable[[Sequence[str]], Sequence[str]]], kind: str = "string"):
    """A model as a column function; ``make`` builds the client once in each Python worker."""
    client: list = []

    def run(texts: pd.Series) -> pd.Series:
        if not client:
            client.append(make())
        return pd.Series(list(client[0](texts.fillna("").tolist())))

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, kind)
