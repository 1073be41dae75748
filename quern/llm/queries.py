"""Registered queries of the training-data operators, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import align, bpe, decontaminate, html_extract, line_dedup, lm, near_dup, quality, secret_scan, toxicity, url_filter, vptree
from quern.llm.tables import table

#: Rank file of the tokenizer that op9 and the pipeline use.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


#: Exact similarities of all pairs that share a shingle, and what can be reached over links.
OP1_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
each AS (SELECT doc_id, unnest(list_transform(generate_series(1, greatest(1, len(w) - 4)), lambda i: list_aggregate(w[i : i + 4], 'string_agg', ' '))) AS s FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, s, count(*) AS c FROM each GROUP BY 1, 2),
size AS (SELECT doc_id, sum(c) AS size FROM n GROUP BY 1),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS common FROM n x JOIN n y USING (s) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE common >= 0.8::DOUBLE * (p.size + q.size - common)),
arc AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT a, b FROM arc UNION SELECT reach.a, arc.b FROM reach JOIN arc ON reach.b = arc.a)
SELECT doc_id, least(doc_id, coalesce(min(b), doc_id)) AS class_id FROM documents LEFT JOIN reach ON a = doc_id GROUP BY doc_id
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.clean(table(spark, sf_dir, "documents"), F.col("source"))
    return found.select("doc_id", "text", F.col("line_dedup.n_lines").alias("n_lines"), F.col("line_dedup.n_dropped").alias("n_dropped"))


OP2_SQL = """
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
each AS (SELECT source, unnest(list_distinct(list_transform(lines, lambda x: trim(x)))) AS line FROM d),
total AS (SELECT source, count(*) AS total FROM documents GROUP BY 1),
often AS (SELECT source, line, count(*) AS pages FROM each WHERE line <> '' GROUP BY 1, 2),
bad AS (SELECT source, list(line) AS bad FROM often JOIN total USING (source) WHERE pages >= 5 AND pages > 0.1::DOUBLE * total GROUP BY 1),
kept AS (SELECT doc_id, lines, list_filter(lines, lambda x: trim(x) = '' OR NOT coalesce(list_contains(bad, trim(x)), false)) AS k FROM d LEFT JOIN bad USING (source))
SELECT doc_id, coalesce(array_to_string(k, chr(10)), '') AS text, len(lines)::BIGINT AS n_lines, (len(lines) - len(k))::BIGINT AS n_dropped FROM kept
"""


#: Rules of op3: host and path, and their verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge(table(spark, sf_dir, "pages"), RULES)
    return found.select("page_id", *[F.col(f"judged.{c}").alias(c) for c in ("host", "path", "rule", "verdict", "p_block")])


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: Exact search: the default factor finds all of it on these tables (its recall elsewhere is measured in the tests).
OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE embedding IS NOT NULL),
u AS (SELECT DISTINCT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, u.vec_id, list_dot_product(q.e, u.e) AS score FROM u, u q WHERE q.vec_id % 20 = 0 AND q.vec_id <> u.vec_id AND len(q.e) = len(u.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


OP6_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, least(13, len(w)) AS n, unnest(list_transform(generate_series(1, greatest(1, len(w) - 12)), lambda i: list_aggregate(w[i : i + 12], 'string_agg', ' '))) AS win
       FROM b WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, n, win FROM iw),
sizes AS (SELECT DISTINCT n FROM items),
dw AS (SELECT doc_id, n, i, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN items USING (win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_decode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


#: Tokenizer files of op11, sides A and B.
SIDES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.Alignment(table(spark, sf_dir, "documents"), *SIDES).documents()
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_toxicity": op5_toxicity,
    "op6_decontaminate": op6_decontaminate,
    "op7_html_extraction": op7_html_extraction,
    "op8_secret_scan": op8_secret_scan,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_lm_scoring": op12_lm_scoring,
}
SQL: dict[str, str] = {
    "op1_near_dedup": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op4_nearest_neighbours": OP4_SQL,
    "op6_decontaminate": OP6_SQL,
}
