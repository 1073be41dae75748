"""Secrets in texts: wide candidates, and a random forest that drops false positives.

Columns and Spark's own forest learner only: no Python runs on the executors. Candidates are
runs of key characters with a digit or after an assignment, and any shorter or mixed value that a
key word is assigned. The forest sees their length,
character transitions, dictionary coverage, path marks and neighbouring words. It is trained
here, on labelled findings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.plan import let, once
from quern.llm.tables import durable

#: Characters of a candidate at least; words of the dictionary; labelled findings made for training.
SHORTEST, DICTIONARY, LABELLED = 16, 1000, 6000
#: Characters of a value at least that a key word is assigned.
SHORT_VALUE = 6
#: Characters on either side of a candidate that its features see.
AROUND = 160
TREES, DEPTH, SEED = 40, 8, 8

_RUN = r"[A-Za-z0-9+/_\-]{%d,}={0,2}" % SHORTEST
_LIKELY = r"(?=[A-Za-z+/_\-]*[0-9])" + _RUN + r"|[=:]\s*[\"']?" + _RUN
_KEYWORD = r"(?i)(token|secret|passw|pwd|api[_\-]?key|apikey|access[_\-]?key|private|credential|auth|bearer)"
#: A key word's assignment up to the value; the value is quoted (and may hold blanks) or goes on to the
#: next blank, quote, or separator before another assignment. No group repeats but possessively: Java recurses otherwise.
_HEAD = _KEYWORD.replace("(token", "(?:token") + r"[\w.\-]{0,40}+\\?[\"'\]]*+\s*+(?>=>|:=|[=:])\s*+(?>(?:bearer|basic|token)\s++)?+"
_NEXT = r"[&;,](?!\\?[\"']?[\w.\-]+\\?[\"']?\s*[=:]|\s|$|[\"'}\])])"
_VALUE = _HEAD + r"\\?(?:\"([^\"\n]{%d,}?)\\?\"|'([^'\n]{%d,}?)\\?'|[\"']?+((?:[^\s\"'&;,\\]|\\(?![\"'])|%s){%d,}+))" % (SHORT_VALUE, SHORT_VALUE, _NEXT, SHORT_VALUE)
FEATURES = ("length", "digits", "uppers", "symbols", "letter_digit", "lower_upper", "hex", "distinct", "entropy", "covered", "longest_letters", "slashes", "dots", "path", "mail", "keyword_near", "keyword_in", "assigned", "quoted", "only_digits", "dashes")


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """The ``size`` words of four or more letters that most documents hold; over all documents."""
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(r"[a-z]{4,}"), F.lit(0)))).alias("w"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size)
    return [r.w for r in top.collect()]


#: Items whose running values are worked out together, see :func:`_running`.
BLOCK = 256


def _running(items: Column, first: Callable[[], Column], add: Callable[[Column, Column], Column]) -> Column:
    """For each item what ``add`` has made of ``first()`` and the items before it, as an array.

    An array grows by copying, so all at once would cost the square of the items. Here arrays grow within blocks of BLOCK items
    and over the blocks' results: 100,000 items cost 13 million short copies."""
    grown = lambda xs, start: F.aggregate(
        xs, F.struct(start.alias("now"), F.slice(F.array(start), 1, 0).alias("before")),
        lambda s, x: F.struct(add(s["now"], x).alias("now"), F.array_append(s["before"], s["now"]).alias("before")),
    )

    def over(blocks: Column) -> Column:
        starts = F.aggregate(
            blocks, F.struct(first().alias("now"), F.slice(F.array(first()), 1, 0).alias("before")),
            lambda s, b: F.struct(F.aggregate(b, s["now"], add).alias("now"), F.array_append(s["before"], s["now"]).alias("before")),
        )["before"]
        return let(F.struct(blocks.alias("blocks"), starts.alias("starts")), lambda x: F.flatten(F.transform(x["blocks"], lambda b, i: grown(b, F.get(x["starts"], i))["before"])))

    cut = F.transform(F.sequence(F.lit(0), F.ceil(F.size(items) / BLOCK).cast("int") - 1), lambda i: F.slice(items, i * BLOCK + 1, BLOCK))
    return F.when(F.size(items) > 0, let(cut, over)).otherwise(F.slice(F.array(first()), 1, 0))


def _spans(pattern: str) -> Column:
    """An array of all matches in the text: ``hit``, the characters (``offset``) and runs of blanks
    (``position``) before it, and the text around it back to the last match and up to the next."""
    gaps, hits = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    blanks = lambda x: F.regexp_count(x, F.lit(r"\s+"))

    def pairs(both: Column) -> Column:
        gap = lambda k: F.coalesce(F.get(both["gaps"], k), F.lit(""))
        hit = lambda k: F.coalesce(F.get(both["hits"], k), F.lit(""))
        return F.transform(both["hits"], lambda h, k: F.struct(
            h.alias("hit"), F.length(gap(k)).alias("skipped"), blanks(gap(k)).alias("blanks"), F.length(h).alias("long"), blanks(h).alias("inner"),
            F.right(F.concat(hit(k - 1), gap(k)), F.lit(AROUND)).alias("lead"), F.left(F.concat(gap(k + 1), hit(k + 1)), F.lit(AROUND)).alias("rest"),
        ))

    def placed(found: Column) -> Column:
        none = lambda: F.struct(F.lit(0).alias("offset"), F.lit(0).alias("position"))
        add = lambda s, x: F.struct((s["offset"] + x["skipped"] + x["long"]).alias("offset"), (s["position"] + x["blanks"] + x["inner"]).alias("position"))
        span = lambda x, s: F.struct(x["hit"].alias("hit"), (s["offset"] + x["skipped"]).alias("offset"), (s["position"] + x["blanks"]).alias("position"), x["lead"].alias("lead"), x["rest"].alias("rest"))
        return F.zip_with(found, _running(found, none, add), span)

    return let(let(F.struct(gaps.alias("gaps"), hits.alias("hits")), pairs), placed)


def _outside(runs: Column, values: Column) -> Column:
    """Runs, and the values that are inside none, by their offsets: one pass over both with the farthest end of a run so far."""
    marked = lambda xs, kind: F.transform(xs, lambda x: F.struct(x["offset"].alias("offset"), F.lit(kind).alias("kind"), (x["offset"] + F.length(x["hit"])).alias("end"), x.alias("x")))

    def kept(every: Column) -> Column:
        ends = _running(every, lambda: F.lit(-1), lambda s, x: F.greatest(s, F.when(x["kind"] == 0, x["end"]).otherwise(-1)))
        both = F.zip_with(every, ends, lambda x, end: F.struct(x["kind"].alias("kind"), (x["end"] > end).alias("out"), x["x"].alias("x")))
        return F.transform(F.filter(both, lambda b: (b["kind"] == 0) | b["out"]), lambda b: b["x"])

    return let(F.array_sort(F.concat(marked(runs, 0), marked(values, 1))), kept)


def _value(x: Column) -> Column:
    """The span of the value in a span of its whole assignment."""
    head = F.regexp_extract(x["hit"], "^" + _HEAD + r"\\?[\"']?", 0)
    value = F.concat(*[F.regexp_extract(x["hit"], _VALUE, k) for k in (1, 2, 3)])
    close = F.substr(x["hit"], F.length(head) + F.length(value) + 1)
    return F.struct(
        value.alias("hit"), (x["offset"] + F.length(head)).alias("offset"), (x["position"] + F.regexp_count(head, F.lit(r"\s+"))).alias("position"),
        F.right(F.concat(x["lead"], head), F.lit(AROUND)).alias("lead"), F.left(F.concat(close, x["rest"]), F.lit(AROUND)).alias("rest"),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, position, offset, finding, word, lead, rest, before, last, after), a row for each run, and for each
    assigned value that is not inside such a run (a value may hold a run): ``position``
    is the number of the blank-separated word, ``offset`` that of the finding's first character in the text,
    both from 0; ``word`` is the finding with what stands around it without a blank, ``lead`` and
    ``rest`` (up to the neighbouring runs); ``before``, ``last`` and ``after`` are neighbouring words.

    Null and empty texts have no rows; repeated rows give theirs each; ids may be null; other columns are not read. The cost is
    linear in a text's length, and grows with its findings n as n * (BLOCK + n / BLOCK ** 2) short copies."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").rlike(_LIKELY) | F.col("text").rlike(_VALUE))
    texts = once(once(texts, "runs", _spans(_RUN)), "values", F.transform(_spans(_VALUE), _value)).withColumn("words", F.split("text", r"\s+"))
    at = lambda x, d: F.coalesce(F.get("words", x["position"] + d), F.lit(""))
    beside = lambda x, side, k: F.element_at(F.split(x[side], r"\s", -1), k)
    likely = lambda x: x["hit"].rlike("[0-9]") | at(x, -1).rlike(r"[=:]$") | beside(x, "lead", -1).rlike(r"[=:][\"']?$")
    texts = once(texts, "found", _outside(F.filter("runs", likely), F.col("values")))
    around = F.transform("found", lambda x: F.struct(
        x["position"].alias("position"), x["offset"].alias("offset"), x["hit"].alias("finding"), beside(x, "lead", -1).alias("lead"), beside(x, "rest", 1).alias("rest"),
        F.concat_ws(" ", at(x, -3), at(x, -2), at(x, -1)).alias("before"), at(x, -1).alias("last"), at(x, 1).alias("after"),
    ))
    return texts.select("id", F.explode(around).alias("x")).select("id", "x.*").withColumn("word", F.concat("lead", "finding", "rest"))


def _count(text: str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def features(found: DataFrame, words: list[str]) -> DataFrame:
    n = F.length("finding").cast("double")
    chars = F.filter(F.split("finding", ""), lambda c: c != "")
    p = lambda c: (F.length("finding") - F.length(F.replace(F.col("finding"), c, F.lit("")))) / n
    runs = F.regexp_extract_all(F.lower("finding"), F.lit("[a-z]{4,}"), F.lit(0))
    known = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    numbers = {
        "length": n, "digits": _count("finding", "[0-9]") / n, "uppers": _count("finding", "[A-Z]") / n, "symbols": _count("finding", "[^A-Za-z0-9]") / n,
        "letter_digit": _count("finding", "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / n, "lower_upper": _count("finding", "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])") / n,
        "hex": F.col("finding").rlike("^[0-9a-fA-F]+$"), "distinct": F.size(F.array_distinct(chars)),
        "entropy": F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s - p(c) * F.log2(p(c))),
        "covered": F.aggregate(F.filter(runs, lambda r: F.array_contains(known, r)), F.lit(0.0), lambda s, r: s + F.length(r)) / n,
        "longest_letters": F.coalesce(F.array_max(F.transform(F.regexp_extract_all("finding", F.lit("[A-Za-z]+"), F.lit(0)), lambda r: F.length(r))), F.lit(0)) / n,
        "slashes": _count("word", "/"), "dots": _count("word", r"\."), "path": F.col("word").rlike(r"^[\"'(]?(?:[a-z]+:/)?/|\\\\|/[^/]+/"), "mail": F.col("word").rlike("@"),
        "keyword_near": F.col("before").rlike(_KEYWORD), "keyword_in": F.concat_ws(" ", "lead", "rest").rlike(_KEYWORD) | F.col("word").rlike(r"(?i)(AKIA|ghp_|sk-|xox)"),
        "assigned": F.col("last").rlike(r"[=:]$") | F.col("word").rlike(r"^[A-Za-z_]+[=:]") | F.col("lead").rlike(r"[=:][\"']?$"), "quoted": F.col("lead").rlike("[\"']$"), "only_digits": F.col("finding").rlike("^[0-9]+$"), "dashes": _count("finding", "[-_]"),
    }
    return found.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"_x_{k}") for k, c in numbers.items()])


def labelled_findings(spark: SparkSession, n: int = LABELLED) -> DataFrame:
    """(id, text, label): ``n`` lines around real-looking secrets (1) and look-alikes (0), made by
    hashing 0 .. n - 1; the same at every call."""
    i = F.col("id").cast("string")
    hexed = lambda salt, k: F.substring(F.sha2(F.concat(F.lit(salt), i), 256), 1, k)
    b64 = lambda salt, k: F.substring(F.translate(F.base64(F.unhex(F.sha2(F.concat(F.lit(salt), i), 256))), "+/=", "aZ9"), 1, k)
    digits = lambda salt, k: F.substring(F.regexp_replace(F.sha2(F.concat(F.lit(salt), i), 512), "[a-f]", ""), 1, k)
    word = lambda salt, k: F.substring(F.translate(F.sha2(F.concat(F.lit(salt), i), 256), "0123456789", "einrtoslau"), 1, k)
    kind = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(34))
    lead, tail = F.concat(word("l", 5), F.lit(" "), word("m", 7), F.lit(" ")), F.concat(F.lit(" "), word("t", 6), F.lit(" "), word("u", 4))
    q = F.lit('"')
    cases = [
        (1, F.concat(F.lit("token = "), q, hexed("a", 40), q)), (1, F.concat(F.lit("TOKEN = "), q, F.upper(hexed("a2", 40)), q)), (1, F.concat(F.lit("api_key: "), b64("b", 32))),
        (1, F.concat(F.lit("password = "), q, b64("c", 18), q)), (1, F.concat(F.lit("AKIA"), F.upper(b64("d", 16)))), (1, F.concat(F.lit("Authorization: Bearer "), b64("e", 40))),
        (1, F.concat(F.lit("secret="), hexed("f", 32))), (1, F.concat(F.lit("access_key = "), q, b64("g", 40), q)), (1, F.concat(F.lit("auth_token: "), hexed("h", 40))), (1, F.concat(F.lit("ghp_"), b64("h2", 36))),
        (0, F.concat(F.lit("commit "), hexed("i", 40))), (0, F.concat(hexed("j", 8), F.lit("-"), hexed("k", 4), F.lit("-4"), hexed("l2", 3), F.lit("-a"), hexed("m2", 3), F.lit("-"), hexed("n", 12))),
        (0, F.concat(F.lit("card "), digits("o", 16))), (0, F.concat(F.lit("order = "), digits("p", 18))), (0, F.concat(F.lit("/usr/lib/"), word("q", 7), F.lit("/"), word("r", 9), F.lit("-"), digits("q2", 2), F.lit(".so"))),
        (0, F.concat(F.lit("https://"), word("s", 7), F.lit(".example.com/"), word("t2", 8), F.lit("/"), digits("r2", 4))), (0, F.concat(word("u2", 12), F.lit("."), digits("s2", 2), F.lit("@mail"), digits("t3", 1), F.lit(".example.com"))),
        (0, F.concat(F.lit("sha256: "), hexed("v", 64))), (0, F.concat(F.lit("token = "), q, F.repeat(F.lit("x"), 20), q)), (0, F.concat(F.lit("password = "), q, F.lit("your-password-here-"), digits("w", 1), q)),
        (0, F.concat(word("x", 10), word("y", 9), digits("u3", 1))), (0, F.concat(F.lit("= "), word("z", 18))), (0, F.concat(F.lit("chapter_"), word("z2", 6), F.lit("_"), digits("v2", 2), F.lit("_draft"))), (0, F.concat(F.lit("2024-01-"), digits("w2", 2), F.lit("-"), word("z3", 9))),
        (1, F.concat(F.lit("password = "), q, F.initcap(word("a3", 6)), digits("a4", 4), F.lit("!"), q)), (1, F.concat(F.lit("api_key: "), hexed("a5", 10))), (1, F.concat(F.lit("pwd="), b64("a6", 4), F.lit("#"), b64("a7", 5), F.lit("%"), digits("a8", 2))),
        (1, F.concat(F.lit('"secret":'), q, b64("a9", 9), F.lit("$"), q)), (1, F.concat(F.lit("password: "), word("b2", 5), F.lit("@"), digits("b3", 3), F.lit("."), b64("b4", 9))),
        (0, F.concat(F.lit("password: "), word("b5", 8))), (0, F.concat(F.lit("auth = "), q, word("b6", 9), q)), (0, F.concat(F.lit("secret: "), F.initcap(word("b7", 7)), F.lit("."))),
        (0, F.concat(F.lit("access_key = ${"), F.upper(word("b8", 6)), F.lit("_"), F.upper(word("b9", 3)), F.lit("}"))), (0, F.concat(F.lit("password="), q, F.lit("<your-"), word("c2", 5), F.lit(">"), q)),
    ]
    # an array of all cases, of which each row takes one: nested conditions would make one method too long to compile
    case = F.element_at(F.array(*[F.struct(F.lit(float(y)).alias("label"), body.alias("body")) for y, body in cases]), (kind + 1).cast("int"))
    return once(spark.range(n), "case", case).select("id", F.concat(lead, F.col("case.body"), tail).alias("text"), F.col("case.label").alias("label"))


def fit(labelled: DataFrame, words: list[str]):
    """The forest, fitted on the candidates in labelled (id, text, label) rows; None without both classes.

    Rows whose text is null or holds no candidate teach nothing; of repeated ids every row counts; labels are few
    (some thousand) and go to every task."""
    labelled = durable(labelled.select("id", "text", "label"))  # the plan that made it would be copied into each feature
    rows = features(candidates(labelled, "id", "text"), words).join(F.broadcast(labelled.select(F.col("id").alias("_id"), "label")), F.col("id") == F.col("_id"))
    rows = durable(rows.select(*[f"_x_{c}" for c in FEATURES], "label"))
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="_f", labelCol="label", predictionCol="_p", rawPredictionCol="_r", probabilityCol="_q", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(VectorAssembler(inputCols=[f"_x_{c}" for c in FEATURES], outputCol="_f").transform(rows))


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", words: list[str] | None = None) -> DataFrame:
    """(id, position, offset, finding, p_secret, is_secret): every candidate of every document row.

    Null texts and texts without candidates have no rows; repeated rows are scanned each;
    other columns are not read. ``labelled``: at most some thousand (id, text, label) rows;
    by default those of :func:`labelled_findings`."""
    known = dictionary(docs, text_col) if words is None else words
    model = fit(labelled_findings(docs.sparkSession) if labelled is None else labelled, known)
    found = features(candidates(docs, id_col, text_col), known)
    if model is None:
        scored = found.withColumn("p_secret", F.lit(0.0))
    else:
        scored = model.transform(VectorAssembler(inputCols=[f"_x_{c}" for c in FEATURES], outputCol="_f").transform(found)).withColumn("p_secret", vector_to_array("_q")[1])
    return scored.select(F.col("id").alias(id_col), "position", "offset", "finding", "p_secret", (F.col("p_secret") >= 0.5).alias("is_secret"))
