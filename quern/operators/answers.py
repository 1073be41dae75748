"""Context blocks, model replies, and the passage that supports an answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import BLANK, strip
from quern.operators import values as V
from quern.operators.recovery import json_object

# Fixed values.
REFUSALS = ("i'm sorry", "i am sorry", "can't assist", "cannot assist")
TEXT_FIELDS = ("chunk_text", "text", "snippet", "content", "body")
SEPARATOR, NO_CONTEXT = "\n\n---\n\n", "(no context)"

NUMBER = r"[-+]?[0-9]{1,3}(?:[ \x{A0}.,][0-9]{3})*(?:[.,][0-9]+)?|[-+]?[0-9]+(?:[.,][0-9]+)?"


def hit_text(columns: list[str], limit: int | None = None) -> Column:
    """The first of a hit's text fields that is not blank, cut to ``limit`` characters with an ellipsis."""
    text = F.coalesce(*[F.when(strip(c) != "", strip(c)) for c in TEXT_FIELDS if c in columns], F.lit(""))
    return text if limit is None else F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 1), F.lit("…"))).otherwise(text)


def context_block(hits: DataFrame, max_chunks: int = 8, max_chars: int = 1800) -> DataFrame:
    """(qid, context): the best hits (qid, rank, text), numbered and cut."""
    cut = F.when(F.length("text") > max_chars, F.concat(F.substring("text", 1, max_chars), F.lit("…"))).otherwise(F.coalesce("text", F.lit("")))
    rows = hits.filter(F.col("rank") <= max_chunks).select("qid", "rank", F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), cut).alias("t"))
    joined = rows.groupBy("qid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "t"))), lambda x: x["t"]), SEPARATOR).alias("context"))
    return joined.withColumn("context", F.when(F.col("context") == "", NO_CONTEXT).otherwise(F.col("context")))


def messages(system: Column, question: Column, context: Column) -> Column:
    user = F.concat(F.lit("Question:\n"), question, F.lit("\n\nContext:\n"), context)
    return F.to_json(F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content"))))


def looks_like_refusal(reply: Column) -> Column:
    low = F.lower(F.coalesce(reply, F.lit("")))
    return F.greatest(*[F.contains(low, F.lit(x)) for x in REFUSALS])


def plain_object(reply: Column) -> Column:
    """A reply's JSON object, from its first brace to its last; null where that is no JSON."""
    whole = F.try_parse_json(strip(reply))
    part = F.try_parse_json(F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit("")))
    return F.when(F.schema_of_variant(whole).startswith("OBJECT"), whole).otherwise(part)


def reply_fields(usable: Column) -> Column:
    """(answer, support) of an object."""
    support = F.try_variant_get(usable, "$.support", "string")
    return F.struct(F.try_variant_get(usable, "$.answer", "string").alias("answer"), F.when(support.rlike(r"\A[0-9]+\z"), support.try_cast("int")).alias("support"))


def parse_reply(reply: Column) -> Column:
    """(answer, support) from a reply's JSON object, from its first brace to its last; where that is no JSON,
    from the first object that can be read from the reply."""
    plain = plain_object(reply)
    return reply_fields(F.coalesce(plain, F.try_parse_json(json_object(F.when(plain.isNull() & F.contains(reply, F.lit("{")), reply)))))


def clamp_support(support: Column, n_hits: Column, max_chunks: int = 8) -> Column:
    return F.when(support.between(F.lit(1), F.least(n_hits, F.lit(max_chunks))), support)


def support_literal(hits: DataFrame, answers: DataFrame) -> DataFrame:
    """(qid, support): rank of the first hit that holds the answer's text, else 1; of answers
    (qid, v) that have hits."""
    joined = hits.join(answers.select("qid", V.as_text(F.col("v")).alias("needle")), "qid")
    return joined.groupBy("qid").agg(F.coalesce(F.min(F.when(F.contains(F.coalesce("text", F.lit("")), F.col("needle")), F.col("rank"))), F.lit(1)).alias("support"))


def to_number(s: Column) -> Column:
    """Blanks go; with both marks the comma groups thousands, alone it is the decimal mark."""
    t = F.regexp_replace(s, "[ \\x{A0}]", "")
    both = F.contains(t, F.lit(".")) & F.contains(t, F.lit(","))
    return F.when(both, F.replace(t, F.lit(","), F.lit(""))).otherwise(F.replace(t, F.lit(","), F.lit("."))).try_cast("double")


def support_near(hits: DataFrame, answers: DataFrame) -> DataFrame:
    """(qid, support) of numeric answer strings (qid, answer): the first hit that holds the answer;
    else the hit with the nearest number, if it is near enough."""
    text = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), BLANK + "+", " "))
    target = to_number(F.col("answer"))
    joined = hits.join(answers.filter(F.col("answer").rlike(r"\A[-+]?[0-9]+(?:\.[0-9]+)?\z")), "qid").select("qid", "rank", "answer", text.alias("t"), target.alias("target"))
    gap = lambda x: F.abs(x - F.col("target"))
    found = F.filter(F.transform(F.regexp_extract_all("t", F.lit(NUMBER), F.lit(0)), lambda m: to_number(m)), lambda x: x.isNotNull())
    near = F.array_min(F.transform(found, lambda x: gap(x) + 0.5 * (gap(x) / (F.abs(F.col("target")) + 1e-9))))
    scored = joined.select("qid", "rank", "target", F.contains("t", F.col("answer")).alias("exact"), near.alias("near"))
    best = scored.groupBy("qid").agg(F.min(F.when(F.col("exact"), F.col("rank"))).alias("first"), F.min(F.when(F.col("near").isNotNull(), F.struct("near", "rank"))).alias("best"), F.first("target").alias("target"))
    enough = (F.col("best.near") < 0.25) | ((F.abs("target") >= 10) & (F.col("best.near") < 1.5))
    return best.select("qid", F.coalesce("first", F.when(enough, F.col("best.rank"))).alias("support")).filter(F.col("support").isNotNull())


def support_overlap(hits: DataFrame, answers: DataFrame) -> DataFrame:
    """(qid, support) of text answers (qid, answer): 2.5 for the whole phrase plus the share of its
    words in the hit; the best hit with one half or more, ties to the first."""
    phrase = F.regexp_replace(F.regexp_replace(F.lower(strip("answer")), '\\A"+|"+\\z', ""), "\\A'+|'+\\z", "")
    words = F.filter(F.split(phrase, r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 2)
    asked = answers.select("qid", phrase.alias("phrase"), words.alias("words")).filter(F.col("phrase") != "")
    asked = asked.withColumn("words", F.when(F.size("words") == 0, F.array("phrase")).otherwise(F.col("words")))
    text = F.lower(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), BLANK + "+", " ")))
    joined = hits.join(asked, "qid").select("qid", "rank", "phrase", "words", text.alias("t")).filter(F.col("t") != "")
    score = F.when(F.contains("t", F.col("phrase")), 2.5).otherwise(0.0) + F.size(F.filter("words", lambda w: F.contains(F.col("t"), w))) / F.size("words")
    best = joined.select("qid", "rank", score.alias("score")).groupBy("qid").agg(F.max(F.struct("score", -F.col("rank"))).alias("b"))
    return best.filter(F.col("b.score") >= 0.5).select("qid", (-F.col("b.col2")).alias("support"))


def relevant_chunks(answers: DataFrame, hits: DataFrame) -> DataFrame:
    """Answers (qid, v, support) with document and page of the supporting hit; text questions without
    an answer get "N/A"."""
    at = hits.select("qid", F.col("rank").alias("support"), "doc", "page")
    return answers.join(at, ["qid", "support"], "left")


def default_answer(v: Column, kind: Column) -> Column:
    return F.when((v["kind"] == "null") & (F.lower(F.trim(kind)) == "str"), V.value("str", s=F.lit("N/A"))).otherwise(v)
