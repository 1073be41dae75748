"""Merging the answers of several runs: votes, maxima, list unions, change report.

Everything is a keyed aggregate with map-side combination; only the distinct items of a
combined list come together in one row, as the list is the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.functions.plan import once
from quern.functions.text import strip
from quern.operators import values as V
from quern.session import durable

_SPLIT = r"(?iu)[;,/]|(?U:\s+\-\s+)|(?U:\s+и\s+)|(?U:\s+and\s+)"


def split_enumeration(s: Column) -> Column:
    parts = F.transform(F.split(F.replace(s, F.lit("\n"), F.lit(",")), _SPLIT), lambda p: V.unquote(strip(p)))
    return F.filter(parts, lambda p: p != "")


def looks_like_enumeration(s: Column) -> Column:
    return s.rlike("[,;/]") | F.contains(s, F.lit(" - ")) | F.lower(s).rlike(r"(?<![\p{L}\p{N}_])и(?![\p{L}\p{N}_])")


def distinct_candidates(candidates: DataFrame) -> DataFrame:
    """(qid, ord, v): of equal answers of a question the first; questions with one are left out."""
    kept = candidates.groupBy("qid", F.col("v.marker").alias("_m")).agg(F.min("ord").alias("ord"), F.min_by("v", "ord").alias("v"))
    return kept.withColumn("_n", F.count("*").over(W.partitionBy("qid"))).filter(F.col("_n") > 1).select("qid", "ord", "v")


def frequency_vote(candidates: DataFrame) -> DataFrame:
    """(qid, v, frequency): most votes, then the longest text, then the first seen."""
    keyed = once(candidates, "k", V.vote_key(F.col("v")))
    counted = keyed.groupBy("qid", F.col("k.number").alias("_n"), F.col("k.text").alias("_t")).agg(F.count("*").alias("frequency"), F.min("ord").alias("ord"), F.min_by("v", "ord").alias("v"))
    order = F.struct(-F.col("frequency"), -F.length(V.as_text(F.col("v"))), "ord")
    return counted.groupBy("qid").agg(F.min_by("v", order).alias("v"), F.min_by("frequency", order).alias("frequency"))


def numeric_max(candidates: DataFrame) -> DataFrame:
    """(qid, v) where every answer is numeric: the largest, in the form first seen."""
    n = V.number_of(F.col("v"))
    return candidates.groupBy("qid").agg(F.bool_and(n.isNotNull()).alias("all"), F.max_by("v", F.struct(n, -F.col("ord"))).alias("v")).filter("all").drop("all")


def list_union(candidates: DataFrame) -> DataFrame:
    """(qid, combined, unique_count, combined_from) where two or more answers are lists and their union
    has more items than each: by frequency, then first appearance, in the first casing."""
    lists = candidates.filter(F.col("v.kind") == "str").select("qid", "ord", F.col("v.s").alias("s")).filter(looks_like_enumeration(F.col("s")))
    lists = once(lists, "items", split_enumeration(F.col("s")))
    per = lists.groupBy("qid").agg(F.count("*").alias("lists"), F.max(F.size(F.array_distinct(F.transform("items", lambda x: F.lower(x))))).alias("widest"), F.transform(F.array_sort(F.collect_list(F.struct("ord", "s"))), lambda x: x["s"]).alias("combined_from"))
    each = lists.select("qid", "ord", F.posexplode("items").alias("place", "item"))
    items = each.groupBy("qid", F.lower("item").alias("key")).agg(F.count("*").alias("n"), F.min(F.struct("ord", "place", "item")).alias("first"))
    joined = items.groupBy("qid").agg(F.count("*").alias("unique_count"), F.array_sort(F.collect_list(F.struct(-F.col("n"), F.col("first.ord"), F.col("first.place"), F.col("first.item").alias("item")))).alias("x"))
    text = F.array_join(F.transform("x", lambda i: i["item"]), ", ")
    return joined.join(per, "qid").filter((F.col("lists") >= 2) & (F.col("unique_count") > F.col("widest"))).select("qid", text.alias("combined"), "unique_count", "combined_from")


def substring_collapse(candidates: DataFrame) -> DataFrame:
    """(qid, longest): the first longest string, where it holds all the others in any case."""
    texts = candidates.filter(F.col("v.kind") == "str").select("qid", "ord", F.col("v.s").alias("s"))
    longest = texts.groupBy("qid").agg(F.max_by("s", F.struct(F.length("s"), -F.col("ord"))).alias("longest"), F.max_by("ord", F.struct(F.length("s"), -F.col("ord"))).alias("_o"))
    others = texts.join(longest, "qid").filter(F.col("ord") != F.col("_o"))
    return others.groupBy("qid").agg(F.first("longest").alias("longest"), F.bool_and(F.contains(F.lower("longest"), F.lower("s"))).alias("all")).filter("all").drop("all")


def _facts(v: Column) -> Column:
    """What a non-empty answer says to each way of choosing."""
    items = split_enumeration(v["s"])
    listed = (v["kind"] == "str") & looks_like_enumeration(v["s"])
    return F.struct(
        V.is_empty(v).alias("empty"), V.vote_key(v).alias("key"), V.number_of(v).alias("number"),
        F.when(v["kind"] == "str", v["s"]).alias("text"), F.when(listed, items).alias("items"),
    )


def select_best(candidates: DataFrame, combine_lists: bool = True, prefer_max: bool = True) -> DataFrame:
    """(qid, v, reason, frequency, combination, unique_count, candidates) of each question: nothing if
    all answers are empty, else the numeric maximum, the union of lists, the string that holds the
    others, or the vote. ``candidates`` are the answers in their order.

    One shuffle by question: the longest text comes from a window, and each answer then counts once as
    a vote and once for each item of its list, in one keyed aggregate and one by question."""
    rows = once(candidates, "f", _facts(F.col("v"))).select("qid", "ord", "v", "f.*")
    text = F.when(~F.col("empty"), F.col("text"))
    size = F.when(text.isNotNull(), F.struct(F.length(text), -F.col("ord")))
    rows = rows.withColumn("longest", F.max_by(text, size).over(W.partitionBy("qid")))
    vote, item = F.lit(1), F.lit(2)
    plain = F.struct(F.when(F.col("empty"), 0).otherwise(vote).alias("way"), F.lit(-1).alias("place"), F.lit(None).cast("string").alias("item"))
    listed = F.transform(F.when(~F.col("empty"), F.col("items")), lambda x, i: F.struct(item.alias("way"), i.alias("place"), x.alias("item")))
    none = F.array().cast("array<struct<way:int,place:int,item:string>>")
    rows = rows.withColumn("x", F.explode(F.concat(F.array(plain), F.coalesce(listed, none)))).select("*", "x.*")
    is_vote, is_item = F.col("way") == vote, F.col("way") == item
    distinct_items = F.size(F.array_distinct(F.transform("items", lambda x: F.lower(x))))
    of_vote = lambda c: F.when(is_vote, c)
    grouped = rows.groupBy(
        "qid", "way", of_vote(F.col("key.number")).alias("_n"), of_vote(F.col("key.text")).alias("_t"), F.lower("item").alias("_i")
    ).agg(
        F.count("*").alias("frequency"), F.min("ord").alias("ord"), F.min_by("v", "ord").alias("v"),
        F.min(F.struct("ord", "place", "item")).alias("first"),
        F.count(of_vote(F.col("items"))).alias("lists"), F.max(of_vote(distinct_items)).alias("widest"),
        F.bool_and(F.col("number").isNotNull()).alias("numeric"),
        F.max(F.struct("number", -F.col("ord"))).alias("largest_at"), F.max_by("v", F.struct("number", -F.col("ord"))).alias("largest"),
        F.first("longest").alias("longest"), F.count("text").alias("texts"),
        F.bool_and(F.contains(F.lower("longest"), F.lower("text"))).alias("held"),
        F.collect_list(F.when(~is_item, F.struct("ord", "v"))).alias("said"),
    )
    order = of_vote(F.struct(-F.col("frequency"), -F.length(V.as_text(F.col("v"))), "ord"))
    ranked = F.when(is_item, F.struct(-F.col("frequency"), F.col("first.ord"), F.col("first.place"), F.col("first.item").alias("item")))
    out = grouped.groupBy("qid").agg(
        F.min_by("v", order).alias("voted"), F.min_by("frequency", order).alias("frequency"),
        F.bool_and(of_vote(F.col("numeric"))).alias("numeric"), F.max_by("largest", of_vote(F.col("largest_at"))).alias("largest"),
        F.sum(of_vote(F.col("lists"))).alias("lists"), F.max(of_vote(F.col("widest"))).alias("widest"), F.count(F.when(is_item, 1)).alias("items"),
        F.array_sort(F.collect_list(ranked)).alias("union"), F.first("longest", ignorenulls=True).alias("longest"),
        F.sum(of_vote(F.col("texts"))).alias("texts"), F.bool_and(of_vote(F.col("held"))).alias("held"),
        F.array_sort(F.flatten(F.collect_list("said"))).alias("said"),
    )
    use_max = F.col("numeric") if prefer_max else F.lit(False)
    use_list = (F.col("lists") >= 2) & (F.col("items") > F.col("widest")) if combine_lists else F.lit(False)
    use_longest = (F.col("texts") > 1) & F.col("held")
    way = (
        F.when(F.col("voted").isNull(), "all_empty").when(use_max, "numeric_max").when(use_list, "list_union")
        .when(use_longest, "substring_collapse").otherwise("frequency_vote")
    )
    out = once(out, "way", way)
    is_way = lambda *w: F.col("way").isin(*w)
    combined = F.array_join(F.transform("union", lambda i: i["item"]), ", ")
    v = (
        F.when(is_way("all_empty"), V.null_value()).when(is_way("numeric_max"), F.col("largest"))
        .when(is_way("list_union"), V.value("str", s=combined)).when(is_way("substring_collapse"), V.value("str", s=F.col("longest")))
        .otherwise(F.col("voted"))
    )
    return once(out, "v", v).select(
        "qid", "v", F.when(is_way("all_empty", "numeric_max", "frequency_vote"), F.col("way")).alias("reason"),
        F.when(is_way("frequency_vote"), F.col("frequency")).alias("frequency"), F.when(is_way("list_union", "substring_collapse"), F.col("way")).alias("combination"),
        F.when(is_way("list_union"), F.col("items")).alias("unique_count"), F.transform("said", lambda x: x["v"]).alias("candidates"),
    )


def merge(base: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, changes) of base (qid, v) and the runs' answers (qid, run, v), run from 1.

    The base answer is the first candidate. Answers are judged once, for both tables, and kept. ``merged`` is base with selected answers in the
    kind of the original; ``changes`` has the questions whose answer differs."""
    asked = runs.join(base.select("qid"), "qid", "left_semi").select("qid", F.col("run").alias("ord"), "v")
    candidates = base.select("qid", F.lit(0).alias("ord"), "v").unionByName(asked)
    best = select_best(distinct_candidates(candidates)).withColumnRenamed("v", "selected")
    joined = base.join(best, "qid", "left").withColumn("original_type", F.when(F.col("v.kind") != "null", F.col("v.kind")))
    new = F.when(F.col("selected").isNotNull(), V.coerce_to(F.col("selected"), F.col("original_type"))).otherwise(F.col("v"))
    joined = durable(once(joined, "new", new))  # both results come from it
    changed = joined.filter(F.col("selected").isNotNull() & ~V.same(F.col("new"), F.col("v")))
    changes = changed.select(
        "qid", F.col("v").alias("original"), "candidates", F.col("new").alias("selected"), "reason", "frequency", "combination", "unique_count",
        "original_type", F.col("new.kind").alias("coerced_type"),
    )
    return joined.select("qid", F.col("new").alias("v")), changes


def summary(base: DataFrame, several: DataFrame, changes: DataFrame) -> DataFrame:
    return base.agg(F.count("*").alias("total")).crossJoin(several.agg(F.countDistinct("qid").alias("clarified"))).crossJoin(changes.agg(F.count("*").alias("changed")))
