"""URL verdicts by rules and, where none fits, by gradient-boosted trees on lexical features.

Columns and Spark's own tree learner only: no Python runs on the executors."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.tables import durable, small

#: Labelled URLs that the trees are fitted on at most.
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 20, 4, 20
#: Words of a host name that mark a site as unwanted, for labelling where no labels are at hand.
UNWANTED = ("casino", "bets", "betting", "poker", "pills", "pharma", "viagra", "adult", "porn", "xxx", "spam", "malware", "phishing", "warez", "crack", "escort", "payday")

FEATURES = (
    "n_url", "n_host", "n_path", "n_query", "depth", "labels", "longest_label", "digits", "host_digits", "hyphens", "marks", "entropy", "host_entropy", "params", "vowels",
    "suffix_pages", "suffix_digits", "suffix_hyphens", "suffix_entropy", "top_pages",
)


def parts(url: Column) -> dict[str, Column]:
    """host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up
    to ``?``, ``#`` or the end; both empty for null or without ``://``. query: what follows ``?``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.when(has, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"host": host, "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), "query": F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1)}


def ruled(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. ``rules``: ``host/path`` to verdict; a
    rule fits its host and all subdomains if the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, said in sorted(rules.items(), key=lambda x: (len(x[0]), x[0])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    n = F.greatest(F.length(text), F.lit(1))
    p = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(F.filter(F.array_distinct(F.split(text, "")), lambda c: c != ""), F.lit(0.0), lambda s, c: s - p(c) * F.log2(p(c)))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def features(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, query and the numbers in FEATURES in a struct ``_url``.

    A suffix is the last two labels of a host; its statistics are taken over all rows."""
    p = parts(F.col(url_col))
    url = F.coalesce(F.col(url_col), F.lit(""))
    base = pages.withColumn("_url", F.struct(url.alias("url"), *[c.alias(n) for n, c in p.items()]))
    u = lambda n: F.col(f"_url.{n}")
    share = lambda n, t: n / F.greatest(F.length(t), F.lit(1))
    numbers = {
        "n_url": F.length(u("url")), "n_host": F.length(u("host")), "n_path": F.length(u("path")), "n_query": F.length(u("query")),
        "depth": _count(u("path"), "/[^/]"), "labels": F.size(F.split(u("host"), r"\.")),
        "longest_label": F.array_max(F.transform(F.split(u("host"), r"\."), lambda x: F.length(x))),
        "digits": share(_count(u("url"), "[0-9]"), u("url")), "host_digits": share(_count(u("host"), "[0-9]"), u("host")), "hyphens": _count(u("host"), "-"),
        "marks": share(_count(u("url"), "[^A-Za-z0-9]"), u("url")), "entropy": _entropy(u("url")), "host_entropy": _entropy(u("host")),
        "params": F.when(u("query") == "", 0.0).otherwise(_count(u("query"), "&") + 1), "vowels": share(_count(u("host"), "[aeiou]"), u("host")),
    }
    label = F.split(u("host"), r"\.")
    base = base.withColumn("_num", F.struct(*[c.cast("double").alias(n) for n, c in numbers.items()]))
    base = base.withColumn("_suffix", F.array_join(F.slice(label, F.greatest(F.size(label) - 1, F.lit(1)), 2), ".")).withColumn("_top", F.element_at(label, -1))
    n = lambda c: F.col(f"_num.{c}")
    suffix = durable(base.groupBy(F.col("_suffix").alias("_s")).agg(F.log1p(F.count("*")).alias("suffix_pages"), F.avg(n("host_digits")).alias("suffix_digits"), F.avg(n("hyphens")).alias("suffix_hyphens"), F.avg(n("host_entropy")).alias("suffix_entropy")))
    top = durable(base.groupBy(F.col("_top").alias("_t")).agg(F.log1p(F.count("*")).alias("top_pages")))
    both = base.join(small(suffix), F.col("_suffix") == F.col("_s")).join(small(top), F.col("_top") == F.col("_t"))
    found = F.struct(*[F.col(f"_url.{c}").alias(c) for c in ("host", "path", "query")], *[(n(c) if c in numbers else F.col(c)).alias(c) for c in FEATURES])
    return both.select(*[F.col(f"`{c}`") for c in pages.columns if c != "_url"], found.alias("_url"))


def weak_labels(host: Column) -> Column:
    """1 for hosts with an unwanted word between marks, else 0."""
    return host.rlike(r"(?:^|[^a-z])(?:" + "|".join(UNWANTED) + r")(?:$|[^a-z])").cast("double")


def fit(found: DataFrame, label: Column, max_labelled: int = MAX_LABELLED):
    """Trees fitted on at most ``max_labelled`` rows with a label (the first by a hash of the URL's
    parts); None if there are not both classes."""
    rows = found.select(*[F.col(f"_url.{c}").alias(c) for c in FEATURES], label.alias("label"), F.xxhash64("_url").alias("_h")).filter(F.col("label").isNotNull()).dropDuplicates(["_h"])
    rows = durable(rows.orderBy("_h").limit(max_labelled).drop("_h"))
    if rows.select("label").distinct().count() < 2:
        return None
    learner = GBTClassifier(featuresCol="_f", labelCol="label", predictionCol="_p", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    return learner.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="_f").transform(rows))


def judge(pages: DataFrame, rules: dict[str, str], label: Column | None = None, url_col: str = "url", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``pages`` with host, path, rule, verdict and p_block in a struct ``judged``.

    verdict is the longest fitting rule's; else "block" where the trees give one half or more,
    "allow" otherwise. ``label`` (1 block, 0 allow, null unknown) may use the pages' columns;
    without it hosts are labelled by UNWANTED. Null URLs and URLs without ``://`` have an empty host
    and path and no rule. Repeated rows are judged each; an empty table, or labels of one
    class, give "allow" where no rule fits. A column ``judged`` of the input is replaced."""
    # the row travels in a struct, so that its columns' names can't clash with those used here
    given = weak_labels(parts(F.col(url_col))["host"]) if label is None else label
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), F.col(url_col).alias("url"), given.cast("double").alias("_y"))
    found = features(packed, "url")
    model = fit(found, F.col("_y"), max_labelled)
    if model is None:
        scored = found.withColumn("_p1", F.lit(0.0))
    else:
        flat = found.select("*", *[F.col(f"_url.{c}").alias(f"_x_{c}") for c in FEATURES])
        model.setRawPredictionCol("_r").setProbabilityCol("_q")
        scored = model.transform(VectorAssembler(inputCols=[f"_x_{c}" for c in FEATURES], outputCol="_f").transform(flat)).withColumn("_p1", vector_to_array("_q")[1])
    rule, verdict = ruled(F.col("_url.host"), F.col("_url.path"), rules)
    judged = F.struct(F.col("_url.host").alias("host"), F.col("_url.path").alias("path"), rule.alias("rule"), F.coalesce(verdict, F.when(F.col("_p1") >= 0.5, "block").otherwise("allow")).alias("verdict"), F.col("_p1").alias("p_block"))
    return scored.select(*[F.col("_row")[c].alias(c) for c in pages.columns if c != "judged"], judged.alias("judged"))
