"""Answers of several models: a chain with fallbacks, a judge over two candidates, and page images."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.plan import once
from quern.operators import answers as A
from quern.operators import values as V
from quern.plugins import Answerer, Judge, PageRenderer, extractive_answer, longer_candidate
from quern.session import durable, ship

# Fixed values.
CHOICES = ("text", "vision", "synth")
#: Hits whose page may be shown to a model, and dots an inch of its image.
IMAGE_HITS, IMAGE_DPI = 5, 220


def first_good_reply(*replies: Column) -> Column:
    """(answer, support, raw) of the first reply that is there, is no refusal, and holds a JSON object.

    The replies are those of the model, of its fallback, and of the fallback without the image, in this order."""
    def usable(raw: Column) -> Column:
        # as it holds an object that is JSON, none has to be recovered
        parsed = A.reply_fields(A.plain_object(raw))
        holds = F.try_parse_json(F.nullif(F.regexp_extract(raw, r"(?s)\{.*\}", 0), F.lit(""))).isNotNull()
        good = raw.isNotNull() & ~A.looks_like_refusal(raw) & holds
        return F.when(good, F.struct(parsed["answer"].alias("answer"), parsed["support"].alias("support"), raw.alias("raw")))

    return F.coalesce(*map(usable, replies))


def judge_request(question: Column, kind: Column, context: Column, text: Column, vision: Column) -> Column:
    """The JSON that a judge is asked with."""
    said = lambda c: F.coalesce(c, F.lit(""))
    return F.to_json(F.struct(question.alias("question"), kind.alias("answer_type"), context.alias("context_snippets"), F.struct(said(text).alias("text"), said(vision).alias("vision")).alias("candidates")))


def parse_verdict(reply: Column) -> Column:
    """(final_answer, chosen, reason, raw) of a judge's reply; a choice that is none counts as text."""
    obj = F.try_parse_json(A.strip(reply))
    obj = F.when(F.schema_of_variant(obj).startswith("OBJECT"), obj)
    get = lambda k: F.try_variant_get(obj, f"$.{k}", "string")
    chosen = F.when(get("chosen").isin(*CHOICES), get("chosen")).otherwise("text")
    return F.struct(get("final_answer").alias("final_answer"), chosen.alias("chosen"), F.coalesce(get("reason"), F.lit("")).alias("reason"), reply.alias("raw"))


def judged(candidates: DataFrame, judge: Judge = longer_candidate) -> DataFrame:
    """(qid, final_answer, chosen, reason, raw) of (qid, question, answer_type, context, text, vision): what a judge makes of two
    candidates. Each question is asked about once, also if the judge is a costly model; a reply that can't be read, or names
    neither candidate, leaves the text's, and so does a verdict without an answer."""
    request = judge_request(F.col("question"), F.col("answer_type"), F.col("context"), F.col("text"), F.col("vision"))
    replied = once(once(candidates, "_request", request).select("qid", "text", "_request"), "_reply", judge(F.col("_request")))
    told = once(replied, "_v", parse_verdict(F.col("_reply"))).select("qid", "text", "_v")
    return told.select("qid", F.coalesce("_v.final_answer", "text").alias("final_answer"), "_v.chosen", "_v.reason", "_v.raw")


def ensemble(
    hits: DataFrame, questions: DataFrame, answerer: Answerer = extractive_answer, images: DataFrame | None = None, max_chunks: int = 8,
    vision: DataFrame | None = None, judge: Judge = longer_candidate, max_chars: int = 1800,
) -> DataFrame:
    """(qid, v, chosen, reason, support, candidate, image_used): the text model's answer in the question's type.

    Where the model names no hit, the first one that holds the answer supports it, else the first hit.
    ``images`` (qid, image) says which questions had a page image. With ``vision`` (qid, candidate), the answers of a model that sees
    the image, a judge decides for the questions that have such an answer; for all others the text's stands."""
    top = hits.filter(F.col("rank") <= max_chunks).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("h"))
    none = F.array().cast("array<struct<rank:int,text:string>>")
    asked = questions.join(top, "qid", "left").withColumn("h", F.coalesce("h", none))
    asked = once(asked, "r", answerer(F.col("question"), F.col("answer_type"), F.col("h")))
    answer, chosen, reason = F.col("r.answer"), F.lit("text"), F.lit("")
    if vision is not None:
        asked = durable(asked)
        said = asked.select("qid", "question", "answer_type", F.col("r.answer").alias("text"))
        both = said.join(vision.filter(F.col("candidate").isNotNull()).select("qid", F.col("candidate").alias("vision")), "qid")
        told = judged(both.join(A.context_block(hits, max_chunks, max_chars), "qid", "left").withColumn("context", F.coalesce("context", F.lit(A.NO_CONTEXT))), judge)
        asked = asked.join(told.select("qid", F.col("final_answer").alias("_final"), F.col("chosen").alias("_chosen"), F.col("reason").alias("_reason")), "qid", "left")
        answer, chosen, reason = F.coalesce("_final", answer), F.coalesce("_chosen", chosen), F.coalesce("_reason", reason)
    asked = once(asked, "v", V.coerce_answer(answer, F.col("answer_type")))
    guessed = F.filter("h", lambda x: F.contains(x["text"], V.as_text(F.col("v"))))
    guess = F.when(F.col("v.kind") != "null", F.get(guessed, F.lit(0))["rank"])
    support = F.coalesce(A.clamp_support(F.col("r.support"), F.size("h"), max_chunks), guess, F.when(F.size("h") > 0, 1))
    seen = F.lit(False)
    if images is not None:
        asked = asked.join(images.filter(F.col("image").isNotNull()).select("qid", F.lit(True).alias("_seen")), "qid", "left")
        seen = F.coalesce("_seen", F.lit(False))
    return asked.select("qid", "v", chosen.alias("chosen"), reason.alias("reason"), support.alias("support"), F.col("r.answer").alias("candidate"), seen.alias("image_used"))


def first_pages(hits: DataFrame, files: DataFrame, most: int = IMAGE_HITS) -> DataFrame:
    """(qid, path, page) of the best of a question's first hits whose document is among the files (name, path)."""
    f = files.select(F.lower(F.regexp_replace("name", r"\.[^.]+$", "")).alias("_stem"), "path")
    asked = hits.filter(F.col("rank") <= most).select("qid", "rank", "page", F.lower(F.regexp_replace("doc", r"\.(?i:pdf|xlsx)$", "")).alias("_stem"))
    return asked.join(f, "_stem").groupBy("qid").agg(F.min(F.struct("rank", "path", "page")).alias("x")).select("qid", "x.path", "x.page")


def page_images(spark: SparkSession, found: DataFrame, folder: str, render: PageRenderer, dpi: int = IMAGE_DPI, glob: str = "*.pdf") -> DataFrame:
    """(qid, image): the page of (qid, path, page) in base64; null where the renderer fails.

    Only files that are asked for are read, and each task renders its own."""
    files = ship(spark).read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for content, page in zip(batch["content"], batch["page"]):
                try:
                    out.append(base64.b64encode(render(content, int(page), dpi)).decode())
                except Exception:  # noqa: BLE001 - a page that can't be shown is no reason to stop
                    out.append(None)
            yield pd.DataFrame({"qid": batch["qid"], "image": out})

    kind = found.schema["qid"].dataType.simpleString()
    return found.join(files, "path").select("qid", "page", "content").mapInPandas(run, f"qid {kind}, image string")
