"""SQL that gives the rows of the registered queries, for an independent engine."""

from __future__ import annotations

from quern.functions.text import BLANK, LINE_END, TOKEN
from quern.operators.answers import NUMBER
from quern.operators.questions import QUANTITY_MARKERS, QUESTION_STEMS
from quern.operators.values import EMPTY, FALSE_WORDS, SIMPLE_NUMBER, TRUE_WORDS
from quern.queries import _STARTS, BILINGUAL

NL = "chr(10)"
HARD, UNSEEN = r"[ \x{A0}]", r"[\p{Z}\p{C}]"


def listed(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def sub(x: str, pattern: str, new: str = "''") -> str:
    return f"regexp_replace({x}, '{pattern}', {new}, 'g')"


def strip(x: str) -> str:
    return sub(x, rf"\A{BLANK}+|{BLANK}+\z")


def clean(x: str) -> str:
    out = sub(f"coalesce({x}, '')", r"[\x00-\x09\x0B-\x1F]")
    out = sub(sub(out, r"[ \t]+", "' '"), r"\x{A0}", "' '")
    return strip(sub(sub(out, rf"{BLANK}+\n", NL), r"\n{3,}", f"{NL} || {NL}"))


def compact(x: str) -> str:
    return f"trim({sub(f"coalesce({x}, '')", BLANK + '+', "' '")})"


def count_of(x: str, part: str) -> str:
    return f"((length({x}) - length(replace({x}, {part}, ''))) // length({part}))"


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '{TOKEN}')"


_SIZED = f"""
t AS (SELECT source AS doc, doc_id AS page, {clean('text')} AS t FROM documents),
m AS (SELECT *, length(t) AS n, list_filter(list_transform(regexp_split_to_array(t, '{LINE_END}'), lambda x: length({strip('x')})), lambda k: k > 0) AS lines,
  ({count_of('t', NL)} * 0.5::DOUBLE + {count_of('t', "'|'")} * 3 + {count_of('t', "chr(9)")} * 2 + ({count_of('t', "'•'")} + {count_of('t', "'- '")} + {count_of('t', "'– '")} + {count_of('t', "'* '")}) * 1.5::DOUBLE) / greatest(1.0::DOUBLE, length(t) / 1000.0::DOUBLE) AS structure FROM t),
b AS (SELECT *, coalesce(list_sum(lines)::DOUBLE / nullif(len(lines), 0), 0.0) AS avg_line, CASE WHEN structure >= 6 THEN 300 WHEN structure >= 3 THEN 215 ELSE 130 END AS base FROM m),
z AS (SELECT *, CASE WHEN avg_line <= 40 THEN least(300, trunc(base * 1.2::DOUBLE)::INT) WHEN avg_line >= 140 THEN greatest(130, trunc(base * 0.85::DOUBLE)::INT) ELSE base END AS size FROM b),
sized AS (SELECT doc, page, t, n, size, trunc(size * 0.2::DOUBLE)::INT AS overlap FROM z)"""

_RAW = """
k AS (SELECT *, 4 * size AS wide, 4 * (size - overlap) AS step FROM sized WHERE t <> ''),
e AS (SELECT *, unnest(generate_series(0, greatest(0, ceil((n - wide) / step::DOUBLE))::BIGINT)) AS i FROM k),
raw AS (SELECT doc, page, i * step AS start_pos, least(n, i * step + wide) AS end_pos, substring(t, i * step + 1, wide) AS text FROM e)"""

_CHUNKS = f"""{_SIZED},{_RAW},
keyed AS (SELECT *, left({strip('text')}, 256) AS key FROM raw),
kept AS (SELECT * FROM keyed WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY doc, page, key ORDER BY start_pos) = 1),
chunks AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page, start_pos) - 1 AS chunk_id FROM kept)"""

_LEX = f"""{_CHUNKS},
each AS (SELECT doc, chunk_id, unnest({tokens('text')}) AS term FROM chunks),
tf AS (SELECT doc, chunk_id, term, count(*) AS tf FROM each GROUP BY ALL),
nd AS (SELECT doc, count(*) AS n FROM chunks GROUP BY 1),
vocab AS (SELECT doc, term, ln((1.0::DOUBLE + any_value(n)) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf FROM tf JOIN nd USING (doc) GROUP BY ALL),
rw AS (SELECT doc, chunk_id, term, tf * idf AS w FROM tf JOIN vocab USING (doc, term)),
weights AS (SELECT doc, chunk_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc, chunk_id)) AS weight FROM rw),
qt AS (SELECT item_id AS qid, unnest({tokens('text')}) AS term FROM benchmark),
qtf AS (SELECT qid, term, count(*) AS tf FROM qt GROUP BY ALL),
qr AS (SELECT qid, doc, term, tf * idf AS w FROM qtf JOIN vocab USING (term)),
qw AS (SELECT qid, doc, term, w / sqrt(sum(w * w) OVER (PARTITION BY qid, doc)) AS weight FROM qr),
lex AS (SELECT qid, doc, chunk_id, sum(qw.weight * weights.weight) AS lex FROM weights JOIN qw USING (doc, term) GROUP BY ALL)"""

def _hits(per_doc: int) -> str:
    return f"""{_LEX},
sizes AS (SELECT qid, count(*) AS n FROM qtf GROUP BY 1),
bag AS (SELECT qid, doc, chunk_id, count(*) / any_value(n)::DOUBLE AS dense FROM tf JOIN qtf USING (term) JOIN sizes USING (qid) GROUP BY qid, doc, chunk_id),
cand AS (SELECT * FROM bag QUALIFY row_number() OVER (PARTITION BY qid, doc ORDER BY dense DESC, chunk_id) <= {per_doc}),
hits AS (SELECT qid, doc, chunk_id, dense, coalesce(lex, 0.0) AS lex, round(0.7::DOUBLE * dense + 0.3::DOUBLE * coalesce(lex, 0.0), 9) AS score FROM cand LEFT JOIN lex USING (qid, doc, chunk_id)),
cut AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc, chunk_id) AS r FROM hits),
llm AS (SELECT cut.*, page, text, least(1.0, length(text) / 2000.0::DOUBLE) AS llm FROM cut JOIN chunks USING (doc, chunk_id) WHERE r <= 30),
ranked AS (SELECT *, 0.15::DOUBLE * score + 0.85::DOUBLE * llm AS final FROM llm),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(final, 9) DESC, doc, chunk_id) AS rank FROM ranked) WHERE rank <= 20)"""


_HITS = _hits(30)

def _extracted(top: str) -> str:
    """The first number of the first hit that has one, or the first hit's line with most words of the question."""
    return f"""
number AS (SELECT qid, min(rank) AS rank, try_cast(replace(regexp_extract(arg_min(text, rank), '{_NUMBER}'), ',', '.') AS DOUBLE) AS x FROM {top} WHERE regexp_matches(text, '[0-9]') GROUP BY 1),
question AS (SELECT item_id AS qid, list_distinct({tokens('text')}) AS tokens FROM benchmark),
lines AS (SELECT qid, tokens, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT qid, tokens, list_filter(list_transform(string_split(text, {NL}), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM {top} JOIN question USING (qid) WHERE rank = 1)),
best AS (SELECT qid, line FROM lines QUALIFY row_number() OVER (PARTITION BY qid ORDER BY len(list_intersect(tokens, {tokens('line')})) DESC, i) = 1),
final AS (SELECT item_id AS qid, CASE WHEN item_id % 2 = 0 THEN coalesce(line, 'N/A') WHEN abs(x) < 9.2e18 THEN trunc(x)::BIGINT::VARCHAR ELSE 'None' END AS answer, CASE WHEN item_id % 2 = 0 THEN 1 ELSE number.rank END AS support
  FROM benchmark LEFT JOIN number ON number.qid = item_id LEFT JOIN best ON best.qid = item_id)"""


_NUMBER = "[-+]?[0-9]+(?:[.,][0-9]+)?"

#: The end-to-end plan over the offline models: bucketed token counts as vectors, shared tokens as the
#: reranker, the first number or the best line as the answer.
_ANSWERED = f"""{_LEX},
said AS (SELECT 0 AS is_q, doc, chunk_id, 0 AS qid, term FROM each UNION ALL SELECT 1, '', 0, qid, term FROM qt),
slot AS (SELECT is_q, doc, chunk_id, qid, ('0x' || left(md5(term), 4))::INT % 128 AS s FROM said),
part AS (SELECT is_q, doc, chunk_id, qid, s % 64 AS k, sum(CASE WHEN s < 64 THEN 1 ELSE -1 END) AS c FROM slot GROUP BY ALL),
one AS (SELECT 0 AS is_q, doc, chunk_id, 0 AS qid FROM chunks UNION ALL SELECT 1, '', 0, item_id FROM benchmark),
grid AS (SELECT is_q, doc, chunk_id, qid, k, coalesce(c, 0) AS c FROM one CROSS JOIN (SELECT unnest(range(64)) AS k) LEFT JOIN part USING (is_q, doc, chunk_id, qid, k)),
vec AS (SELECT is_q, doc, chunk_id, qid, list(c::DOUBLE ORDER BY k) AS c, sqrt(sum(c * c)::DOUBLE) + 1e-12 AS n FROM grid GROUP BY ALL),
unit AS (SELECT is_q, doc, chunk_id, qid, list_transform(c, lambda x: (x / n)::FLOAT::DOUBLE) AS v FROM vec),
dense AS (SELECT q.qid, c.doc, c.chunk_id, list_dot_product(q.v, c.v) AS dense FROM unit q, unit c WHERE q.is_q = 1 AND c.is_q = 0),
cand AS (SELECT * FROM dense QUALIFY row_number() OVER (PARTITION BY qid, doc ORDER BY dense DESC, chunk_id) <= 100),
hits AS (SELECT qid, doc, chunk_id, 0.7::DOUBLE * dense + 0.3::DOUBLE * coalesce(lex, 0.0) AS score FROM cand LEFT JOIN lex USING (qid, doc, chunk_id)),
cut AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc, chunk_id) <= 100),
asked AS (SELECT item_id AS qid, list_distinct({tokens('text')}) AS words FROM benchmark),
judged AS (SELECT qid, doc, chunk_id, page, text, words, score, CASE WHEN len(words) = 0 THEN 0.0 ELSE len(list_intersect(words, {tokens('text')})) / len(words)::DOUBLE END AS llm FROM cut JOIN chunks USING (doc, chunk_id) JOIN asked USING (qid)),
placed AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(0.15::DOUBLE * score + 0.85::DOUBLE * llm, 9) DESC, doc, chunk_id) AS rank FROM judged),
top AS (SELECT * FROM placed WHERE rank <= 10),{_extracted('top')}"""

_VECTORS = """
v AS (SELECT label AS doc, vec_id AS chunk_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (SELECT doc, chunk_id, list_transform(e, lambda x: x / (sqrt(list_dot_product(e, e)) + 1e-12)) AS vector FROM v),
s AS (SELECT q.chunk_id AS qid, u.doc, u.chunk_id, list_dot_product(u.vector, q.vector) AS dense FROM u, u q WHERE q.chunk_id % 100 = 0)"""

_V2 = """
g AS (SELECT doc_id // 20 AS g, doc_id, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE doc_id % 20 + 1 END AS page_number, text FROM documents),
docs AS (SELECT g, 'report_' || g || '.v1' AS stem, count(*) AS n, max(doc_id) AS last_id, arg_max(page_number, doc_id) AS last_number, arg_min(text, doc_id) AS first_text FROM g GROUP BY g)"""

_QUOTE = """['"«»]""".replace("'", "''")
_QUOTED = rf"\A{_QUOTE}([^\n]*?){_QUOTE}\z"


def unquote(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{_QUOTED}') THEN {strip(f"regexp_extract({x}, '{_QUOTED}', 1)")} ELSE {x} END"


def number(x: str) -> str:
    core = f"replace(replace({strip(x)}, ' ', ''), ',', '.')"
    return f"CASE WHEN {strip(x)} <> '' AND NOT ends_with({strip(x)}, '%') AND regexp_matches({core}, '{SIMPLE_NUMBER}') THEN try_cast({core} AS DOUBLE) END"


def is_list(x: str) -> str:
    return rf"(regexp_matches({x}, '[,;/]') OR contains({x}, ' - ') OR regexp_matches(lower({x}), '(^|[^\p{{L}}\p{{N}}_])и($|[^\p{{L}}\p{{N}}_])'))"


def items(x: str) -> str:
    parts = rf"regexp_split_to_array(replace({x}, {NL}, ','), '(?i)[;,/]|{BLANK}+-{BLANK}+|{BLANK}+и{BLANK}+|{BLANK}+and{BLANK}+')"
    return f"list_filter(list_transform({parts}, lambda p: {unquote(strip('p'))}), lambda p: p <> '')"


_ANSWERS = f"""
e0 AS (SELECT event_id, user_id || ':' || (event_id // 500) || ':' || CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS qid, event_id % 9 AS k, floor(value)::BIGINT AS n, event_type AS t FROM events),
a AS (SELECT event_id, event_id AS ord, qid,
  CASE k WHEN 0 THEN 'int' WHEN 1 THEN 'float' WHEN 7 THEN 'null' ELSE 'str' END AS kind, CASE WHEN k = 0 THEN n END AS i, CASE WHEN k = 1 THEN n + 0.5::DOUBLE END AS d,
  CASE k WHEN 2 THEN n || ',5' WHEN 3 THEN ' N/A ' WHEN 4 THEN t || ', item ' || (n % 5) WHEN 5 THEN t || ' / Item ' || (n % 3) WHEN 6 THEN upper(t) WHEN 8 THEN '«' || t || '»' END AS s FROM e0),
b AS (SELECT *, coalesce(s, i::VARCHAR, d::VARCHAR, 'None') AS text, kind || ':' || coalesce(s, i::VARCHAR, d::VARCHAR, '') AS marker,
  CASE kind WHEN 'int' THEN i::DOUBLE WHEN 'float' THEN d WHEN 'str' THEN {number('s')} END AS num,
  CASE WHEN kind = 'null' THEN true WHEN kind = 'str' THEN lower({unquote(f"lower({strip('s')})")}) IN {listed(EMPTY)} ELSE coalesce(i::DOUBLE, d) = 0.0 END AS empty,
  CASE WHEN kind = 'str' THEN {number(unquote(strip('s')))} ELSE coalesce(i::DOUBLE, d) END AS key_number,
  CASE WHEN kind = 'str' THEN trim({sub(f"lower({unquote(strip('s'))})", BLANK + '+', "' '")}) END AS key_low FROM a),
v AS (SELECT *, CASE WHEN kind = 'null' THEN '__none__' WHEN key_number IS NOT NULL THEN '__num__' ELSE key_low END AS key_text FROM b),
f AS (SELECT * FROM v WHERE NOT empty)"""


def votes(src: str) -> str:
    return f"""(SELECT qid, text AS answer, kind, frequency, i, d, s FROM (SELECT qid, key_number, key_text, count(*) AS frequency, min(ord) AS ord, arg_min(text, ord) AS text, arg_min(kind, ord) AS kind, arg_min(i, ord) AS i, arg_min(d, ord) AS d, arg_min(s, ord) AS s FROM {src} GROUP BY ALL)
 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY frequency DESC, length(text) DESC, ord) = 1)"""


def unions(src: str) -> str:
    return f"""(WITH l AS (SELECT qid, ord, {items('s')} AS items FROM {src} WHERE kind = 'str' AND {is_list('s')}),
 per AS (SELECT qid, count(*) AS lists, max(len(list_distinct(list_transform(items, lambda x: lower(x))))) AS widest FROM l GROUP BY 1),
 x AS (SELECT qid, ord, unnest(items) AS item, generate_subscripts(items, 1) AS place FROM l),
 c AS (SELECT qid, lower(item) AS key, count(*) AS n, arg_min(item, (ord, place)) AS item, min((ord, place)) AS first FROM x GROUP BY 1, 2)
 SELECT qid, string_agg(item, ', ' ORDER BY n DESC, first) AS combined, count(*) AS unique_count FROM c JOIN per USING (qid) GROUP BY qid, lists, widest HAVING lists >= 2 AND count(*) > widest)"""


def collapses(src: str) -> str:
    return f"""(WITH x AS (SELECT qid, ord, s FROM {src} WHERE kind = 'str'), l AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY qid ORDER BY length(s) DESC, ord) = 1)
 SELECT l.qid, any_value(l.s) AS longest FROM x JOIN l USING (qid) WHERE x.ord <> l.ord GROUP BY l.qid HAVING bool_and(contains(lower(l.s), lower(x.s))))"""


_SELECT = f"""{_ANSWERS},
dd AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY qid, marker ORDER BY ord) = 1),
many AS (SELECT * FROM dd WHERE qid IN (SELECT qid FROM dd GROUP BY 1 HAVING count(*) > 1)),
full_ AS (SELECT * FROM many WHERE NOT empty),
mx AS (SELECT qid, arg_max(text, (num, -ord)) AS text, arg_max(kind, (num, -ord)) AS kind, arg_max(i, (num, -ord)) AS i, arg_max(d, (num, -ord)) AS d, arg_max(s, (num, -ord)) AS s FROM full_ GROUP BY 1 HAVING bool_and(num IS NOT NULL)),
best AS (SELECT q.qid, CASE WHEN vo.qid IS NULL THEN 'all_empty' WHEN mx.qid IS NOT NULL THEN 'numeric_max' WHEN un.qid IS NOT NULL THEN 'list_union' WHEN co.qid IS NOT NULL THEN 'substring_collapse' ELSE 'frequency_vote' END AS way,
  mx.text AS m_text, mx.kind AS m_kind, mx.i AS m_i, mx.d AS m_d, mx.s AS m_s, vo.answer AS v_text, vo.kind AS v_kind, vo.frequency, vo.i AS v_i, vo.d AS v_d, vo.s AS v_s, combined, un.unique_count, longest
  FROM (SELECT DISTINCT qid FROM many) q LEFT JOIN {votes('full_')} vo USING (qid) LEFT JOIN mx USING (qid) LEFT JOIN {unions('full_')} un USING (qid) LEFT JOIN {collapses('full_')} co USING (qid)),
picked AS (SELECT qid, CASE way WHEN 'all_empty' THEN 'None' WHEN 'numeric_max' THEN m_text WHEN 'list_union' THEN combined WHEN 'substring_collapse' THEN longest ELSE v_text END AS answer,
  CASE way WHEN 'all_empty' THEN 'null' WHEN 'numeric_max' THEN m_kind WHEN 'frequency_vote' THEN v_kind ELSE 'str' END AS kind,
  CASE WHEN way IN ('all_empty', 'numeric_max', 'frequency_vote') THEN way END AS reason, CASE WHEN way = 'frequency_vote' THEN frequency END AS frequency,
  CASE WHEN way IN ('list_union', 'substring_collapse') THEN way END AS combination, CASE WHEN way = 'list_union' THEN unique_count END AS unique_count,
  CASE way WHEN 'numeric_max' THEN m_i WHEN 'frequency_vote' THEN v_i END AS i, CASE way WHEN 'numeric_max' THEN m_d WHEN 'frequency_vote' THEN v_d END AS d FROM best)"""

#: What must come of each of the bilingual rewrites.
_EXPANDED = (
    "Какова прибыль ТОО Делойт (Deloitte) за %s?", "Who is John Smith (Джон Смит) in %s?", "Who is John Smith in %s?", "Сколько людей в Алматы за %s?",
    "Что платят физические лица за %s?", "Где Народный банк (Halyk Bank) %s?", "Где Народный банк %s?", "Где Народный банк %s?",
)
_RUSSIAN = f"""
q AS (SELECT doc_id AS qid, [{', '.join("'" + x + "'" for x in _STARTS)}][(doc_id % 6 + 1)::INT] || CASE WHEN doc_id % 4 = 0 THEN 'всего ' ELSE '' END || text || '?' AS question FROM documents),
n AS (SELECT *, {strip("lower(question)")} <> '' AND ({' OR '.join(f"starts_with(lower(question), '{x}')" for x in QUESTION_STEMS)}) AND NOT ({' OR '.join(f"contains(lower(question), '{x}')" for x in QUANTITY_MARKERS)}) AS needs FROM q)"""

_KIND_OF = "['int', 'float', 'str', 'bool'][(event_id % 4 + 1)::INT]"

SQL: dict[str, str] = {
    "clean_text": f"SELECT doc_id, {clean('text')} AS cleaned FROM documents",
    "low_text_pages": f"SELECT doc_id, length({compact('text')}) < 1000 AS low, length({compact('text')}) AS n FROM documents",
    "approx_token_count": "SELECT source, sum(CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE greatest(1, (length(text) + 3) // 4) END)::BIGINT AS n_tokens, count(*) AS n_pages FROM documents GROUP BY 1",
    "auto_chunk_size": f"WITH {_SIZED} SELECT page AS doc_id, size, overlap FROM sized",
    "chunk_auto": f"WITH {_SIZED},{_RAW} SELECT * FROM raw",
    "chunk_fixed": f"WITH t AS (SELECT source AS doc, doc_id AS page, {clean('text')} AS t FROM documents), sized AS (SELECT doc, page, t, length(t) AS n, 100 AS size, 20 AS overlap FROM t),{_RAW} SELECT doc, page, count(*) AS n, sum(length(text))::BIGINT AS chars, max(end_pos) AS last_end FROM raw GROUP BY 1, 2",
    "chunk_index": f"WITH {_CHUNKS} SELECT doc, chunk_id, page, start_pos, end_pos, md5(text) AS text_md5 FROM chunks",
    "chunk_counts": f"WITH {_CHUNKS} SELECT doc, count(*) AS chunks FROM chunks GROUP BY 1",
    "unit_vectors": f"WITH {_VECTORS} SELECT doc, chunk_id, round(list_dot_product(vector, vector), 6) AS norm2, round(vector[1], 6) AS first FROM u",
    "dense_topk_per_doc": f"WITH {_VECTORS} SELECT qid, doc, chunk_id, rank, round(dense, 6) AS dense FROM (SELECT *, row_number() OVER (PARTITION BY qid, doc ORDER BY dense DESC, chunk_id) AS rank FROM s) WHERE rank <= 10",
    "dense_topk_global": f"WITH {_VECTORS} SELECT qid, rank, doc, chunk_id, round(dense, 6) AS dense FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dense DESC, doc, chunk_id) AS rank FROM s) WHERE rank <= 20",
    "tfidf_vocabulary": f"WITH {_LEX} SELECT doc, term, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights": f"WITH {_LEX} SELECT doc, chunk_id, count(*) AS n_terms, round(sum(weight), 5) AS total, round(max(weight), 6) AS largest FROM weights GROUP BY 1, 2",
    "tfidf_query_cosine": f"WITH {_LEX} SELECT qid, doc, count(*) AS n, round(sum(lex), 5) AS total, round(max(lex), 6) AS best FROM lex GROUP BY 1, 2",
    "hybrid_score": f"WITH {_hits(20)} SELECT qid, r AS rank, doc, chunk_id, round(dense, 6) AS dense, round(lex, 6) AS lex, score FROM cut WHERE r <= 20",
    "rerank_blend": f"WITH {_HITS} SELECT qid, rank, doc, chunk_id, page, round(llm, 6) AS llm, round(final, 6) AS final FROM top",
    "unique_by_page": f"WITH {_HITS} SELECT qid, rank, doc, page FROM top QUALIFY row_number() OVER (PARTITION BY qid, doc, page ORDER BY rank) = 1",
    "context_block": f"WITH {_HITS} SELECT qid, string_agg('[' || rank || '] ' || CASE WHEN length(text) > 1800 THEN left(text, 1800) || '…' ELSE text END, {NL} || {NL} || '---' || {NL} || {NL} ORDER BY rank) AS context FROM top WHERE rank <= 8 GROUP BY 1",
    "support_literal": f"WITH {_HITS}, n AS (SELECT item_id AS qid, {tokens('text')}[-1] AS needle FROM benchmark) SELECT qid, coalesce(min(rank) FILTER (contains(text, needle)), 1) AS support FROM top JOIN n USING (qid) GROUP BY 1",
    "support_token_overlap": rf"""WITH {_HITS}, p AS (SELECT item_id AS qid, {sub(sub(f"lower({strip("split_part(text, '.', 1)")})", '\\A"+|"+\\z'), "\\A''+|''+\\z")} AS phrase FROM benchmark),
w AS (SELECT qid, phrase, list_filter(regexp_split_to_array(phrase, '[^\p{{L}}\p{{N}}_]+'), lambda x: length(x) >= 2) AS words FROM p WHERE phrase <> ''),
sc AS (SELECT qid, rank, lower({compact('text')}) AS t, phrase, CASE WHEN len(words) = 0 THEN [phrase] ELSE words END AS words FROM top JOIN w USING (qid)),
sx AS (SELECT qid, rank, CASE WHEN contains(t, phrase) THEN 2.5::DOUBLE ELSE 0.0::DOUBLE END + len(list_filter(words, lambda x: contains(t, x))) / len(words)::DOUBLE AS score FROM sc WHERE t <> '')
SELECT qid, rank AS support FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rank) AS o FROM sx) WHERE o = 1 AND score >= 0.5""",
    "support_numeric_nearest": rf"""WITH n AS (SELECT source AS qid, doc_id, text, {compact('text')} AS t FROM documents WHERE regexp_matches(text, '[0-9]{{2,}}')),
a AS (SELECT qid, (arg_min(regexp_extract(text, '[0-9]{{2,9}}', 0)::BIGINT, doc_id) + 1)::VARCHAR AS answer FROM n GROUP BY 1),
h AS (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY doc_id) AS rank, t, answer, answer::DOUBLE AS target FROM n JOIN a USING (qid)),
x AS (SELECT *, list_transform(regexp_extract_all(t, '{NUMBER}'), lambda m: {sub('m', HARD)}) AS found FROM h),
y AS (SELECT *, list_filter(list_transform(found, lambda m: try_cast(CASE WHEN contains(m, '.') AND contains(m, ',') THEN replace(m, ',', '') ELSE replace(m, ',', '.') END AS DOUBLE)), lambda v: v IS NOT NULL) AS nums FROM x),
z AS (SELECT qid, rank, target, contains(t, answer) AS exact, list_min(list_transform(nums, lambda v: abs(v - target) + 0.5::DOUBLE * (abs(v - target) / (abs(target) + 1e-9::DOUBLE)))) AS near FROM y),
b AS (SELECT qid, any_value(target) AS target, min(rank) FILTER (exact) AS first, min(near) AS near, arg_min(rank, (near, rank)) FILTER (near IS NOT NULL) AS best FROM z GROUP BY 1)
SELECT qid, coalesce(first, best) AS support FROM b WHERE first IS NOT NULL OR near < 0.25 OR (abs(target) >= 10 AND near < 1.5)""",
    "v2_to_v1": f"WITH {_V2} SELECT 'report_' || g || '.v1' AS doc, CASE WHEN page_number = 0 THEN doc_id ELSE page_number END AS page, text FROM g",
    "append_table_page": f"""WITH {_V2}, x AS (SELECT *, length(first_text) % 2 = 0 AS has, CASE WHEN last_number = 0 THEN last_id ELSE last_number END AS last FROM docs)
SELECT stem || '.pdf' AS doc_name, n + has::INT AS num_pages, CASE WHEN has THEN last + 1 ELSE last_number END AS last_page, CASE WHEN has THEN 'tables_md' END AS section FROM x""",
    "ocr_select": f"""WITH o AS (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN text || ' read' WHEN 1 THEN left(text, 10) ELSE '' END AS ocr FROM documents),
p AS (SELECT doc_id, ocr, CASE WHEN length({compact('text')}) < 1000 AND length({compact('ocr')}) > 0 AND length({compact('ocr')}) >= length({compact('text')}) THEN ocr ELSE coalesce(text, '') END AS t FROM o)
SELECT doc_id, md5(t) AS text_md5, t = ocr AS is_ocr FROM p""",
    "ocr_by_confidence": rf"""WITH o AS (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN text || ' read' ELSE left(text, 50) END AS ocr, doc_id % 7 = 0 AS unsure FROM documents),
p AS (SELECT *, length({sub('ocr', UNSEEN)}) AS seen_ocr, length({sub('text', UNSEEN)}) AS seen FROM o),
t AS (SELECT *, (length(text) < 200 OR unsure) AND seen_ocr >= greatest(seen, 200) AS take FROM p)
SELECT doc_id, length(CASE WHEN take THEN ocr ELSE text END) AS n, CASE WHEN take THEN 'ocr' ELSE 'parser' END AS ocr_source FROM t""",
    "cache_decision": """WITH c AS (SELECT o_orderkey AS k, epoch(o_orderdate)::BIGINT AS changed, o_orderkey % 4 <> 0 AS has, epoch(o_orderdate)::BIGINT + CASE WHEN o_orderkey % 5 = 0 THEN -1 ELSE 1 END AS cached FROM orders),
r AS (SELECT k AS name, CASE WHEN NOT has THEN 'no cache' WHEN k % 7 = 0 THEN 'has error' WHEN k % 11 = 0 THEN 'interrupted' WHEN k % 13 = 0 THEN 'incomplete content' WHEN cached < changed THEN 'outdated' ELSE 'cached up-to-date' END AS reason FROM c)
SELECT name, reason, reason = 'cached up-to-date' AS ok FROM r""",
    "sheet_cells": f"SELECT doc_id, CASE WHEN length({compact('text')}) > 200 THEN left({compact('text')}, 199) || '…' ELSE {compact('text')} END AS cell FROM documents",
    "needs_augmentation": f"WITH {_RUSSIAN} SELECT qid, needs FROM n",
    "augment_questions": f"""WITH {_RUSSIAN}, r AS (SELECT *, {strip("CASE qid % 5 WHEN 0 THEN question || ' now' WHEN 1 THEN 'Quite a lot of words in front: ' || question ELSE ' New ' || question END")} AS new FROM n),
o AS (SELECT qid, question, CASE WHEN NOT needs OR NOT ends_with(new, '?') OR length(new) > length(question) + 25 THEN question ELSE new END AS augmented FROM r)
SELECT qid, md5(augmented) AS augmented_md5, augmented <> question AS changed FROM o""",
    "company_mentions": """WITH n AS (SELECT n_name AS company FROM nation UNION SELECT r_name FROM region UNION SELECT c_mktsegment FROM customer),
q AS (SELECT c_custkey AS qid, 'Revenue of ' || lower(n_name) || ' and ' || c_mktsegment || 's, or ' || c_mktsegment || '?' AS question FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT qid, company FROM q, n WHERE regexp_matches(question, '(?i)' || company || '([^A-Za-z0-9_]|$)')""",
    "heuristic_empty": f"WITH {_ANSWERS} SELECT event_id, empty FROM v",
    "vote_key": f"WITH {_ANSWERS} SELECT event_id, key_number AS number, key_text AS text FROM v",
    "numeric_parse": f"WITH {_ANSWERS} SELECT event_id, num AS number, kind IN ('int', 'float') AS is_number FROM v",
    "answer_vote": f"WITH {_ANSWERS} SELECT qid, answer, frequency FROM {votes('f')}",
    "numeric_max": f"WITH {_ANSWERS} SELECT qid, arg_max(num, (num, -ord)) AS largest, arg_max(kind, (num, -ord)) AS kind FROM f GROUP BY 1 HAVING bool_and(num IS NOT NULL)",
    "enumeration_split": f"WITH {_ANSWERS} SELECT event_id, {is_list('s')} AS is_list, array_to_string({items('s')}, '|') AS items FROM v WHERE kind = 'str'",
    "list_union": f"WITH {_ANSWERS} SELECT * FROM {unions('f')}",
    "substring_collapse": f"WITH {_ANSWERS} SELECT * FROM {collapses('f')}",
    "answer_select": f"WITH {_SELECT} SELECT qid, CASE WHEN kind <> 'float' THEN answer END AS answer, kind, reason, frequency, combination, unique_count FROM picked",
    "coerce_original_type": f"""WITH {_ANSWERS}, w AS (SELECT *, {_KIND_OF} AS want, lower({strip('s')}) AS word FROM v),
c AS (SELECT *, CASE WHEN kind = 'null' THEN kind WHEN want = 'int' AND (kind IN ('int', 'float') OR num = floor(num)) THEN 'int' WHEN want = 'float' AND num IS NOT NULL THEN 'float' WHEN want = 'str' THEN 'str'
  WHEN want = 'bool' AND (kind IN ('int', 'float') OR word IN {listed(TRUE_WORDS + FALSE_WORDS)}) THEN 'bool' ELSE kind END AS new FROM w)
SELECT event_id, new AS kind, CASE WHEN new = 'int' THEN CASE WHEN kind = 'int' THEN i ELSE round_even(num, 0)::BIGINT END END AS i, CASE WHEN new = 'bool' THEN CASE WHEN kind IN ('int', 'float') THEN num <> 0 ELSE word IN {listed(TRUE_WORDS)} END END AS b, CASE WHEN new = 'float' THEN num END AS d FROM c""",
    "numeric_fix": f"""WITH x AS (SELECT event_id, floor(value)::BIGINT || CASE event_id % 3 WHEN 0 THEN ',5 %' WHEN 1 THEN ' 000' ELSE ' тенге' END AS s FROM events),
y AS (SELECT *, replace({sub(sub(strip('s'), BLANK + r'*%\z'), r'[\x{A0}\x{202F} _]')}, ',', '.') AS core FROM x),
z AS (SELECT *, CASE WHEN regexp_matches(core, '{SIMPLE_NUMBER}') THEN try_cast(core AS DOUBLE) END AS num FROM y)
SELECT event_id, CASE WHEN num IS NULL THEN 'str' WHEN num = floor(num) THEN 'int' ELSE 'float' END AS kind, CASE WHEN num = floor(num) THEN num::BIGINT END AS i, CASE WHEN num <> floor(num) THEN num END AS d, CASE WHEN num IS NULL THEN s END AS s FROM z""",
    "coerce_answer": f"""WITH x AS (SELECT doc_id, text, ['int', 'float', 'str'][(doc_id % 3 + 1)::INT] AS want, try_cast(replace(regexp_extract(text, '[-+]?[0-9]+(?:[.,][0-9]+)?', 0), ',', '.') AS DOUBLE) AS num FROM documents),
y AS (SELECT *, CASE WHEN want = 'str' THEN 'str' WHEN num IS NULL OR (want = 'int' AND abs(num) >= 9.2e18) THEN 'null' ELSE want END AS kind FROM x)
SELECT doc_id, kind, CASE WHEN kind = 'int' THEN trunc(num)::BIGINT END AS i, CASE WHEN kind = 'float' THEN num END AS d, CASE WHEN kind = 'str' THEN md5({strip('text')}) END AS s_md5 FROM y""",
    "merge_changes": f"""WITH {_SELECT},
base AS (SELECT qid, arg_min(kind, ord) AS kind, arg_min(marker, ord) AS marker, arg_min(coalesce(i::DOUBLE, d), ord) AS num FROM v GROUP BY 1),
c AS (SELECT qid, p.kind AS picked_kind, p.answer, CASE WHEN p.kind = 'int' THEN p.i::DOUBLE WHEN p.kind = 'float' THEN p.d WHEN p.kind = 'str' THEN {number('p.answer')} END AS num, p.reason, p.combination, nullif(base.kind, 'null') AS original_type, base.marker, base.kind AS base_kind, base.num AS base_num FROM picked p JOIN base USING (qid)),
n AS (SELECT *, CASE WHEN original_type IS NULL OR picked_kind = 'null' THEN picked_kind WHEN original_type = 'int' AND (picked_kind IN ('int', 'float') OR num = floor(num)) THEN 'int' WHEN original_type = 'float' AND num IS NOT NULL THEN 'float' WHEN original_type = 'str' THEN 'str' ELSE picked_kind END AS coerced_type FROM c),
s AS (SELECT *, CASE WHEN coerced_type IN ('int', 'float') AND base_kind IN ('int', 'float') THEN CASE WHEN coerced_type = 'int' THEN round_even(num, 0) ELSE num END = base_num ELSE coerced_type || ':' || CASE WHEN coerced_type = 'null' THEN '' ELSE answer END = marker END AS same FROM n)
SELECT s.qid, (SELECT count(*) FROM many WHERE many.qid = s.qid)::INT AS n_candidates, reason, combination, original_type, coerced_type FROM s WHERE NOT same""",
    "reply_parse": """SELECT event_id, CASE WHEN event_id % 3 < 2 THEN event_type END AS answer, CASE WHEN event_id % 3 = 0 AND event_id % 9 BETWEEN 1 AND 6 THEN event_id % 9 END AS support, event_id % 3 = 2 AS refusal FROM events""",
    "dialogue_context": f"SELECT conv_id AS qid, string_agg('[' || (turn + 1) || '] ' || CASE WHEN length(text) > 1800 THEN left(text, 1800) || '…' ELSE coalesce(text, '') END, {NL} || {NL} || '---' || {NL} || {NL} ORDER BY turn) AS context FROM conversations WHERE turn < 8 GROUP BY 1",
    "question_answering": f"WITH {_ANSWERED} SELECT f.qid, answer, support::INT AS support, doc, page FROM final f LEFT JOIN top ON top.qid = f.qid AND top.rank = f.support",
    "ensemble_answer": f"""WITH {_HITS}, eight AS (SELECT * FROM top WHERE rank <= 8),{_extracted('eight')}
SELECT qid, answer, 'text' AS chosen, coalesce(support, 1)::INT AS support, false AS image_used FROM final""",
    "bilingual_expansion": f"SELECT c_custkey AS qid, replace({list(_EXPANDED)}[(c_custkey % {len(BILINGUAL)} + 1)::INT], '%s', c_custkey::VARCHAR) AS expanded FROM customer",
    "fallback_reply": """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type WHEN event_id % 3 > 0 THEN upper(event_type) WHEN event_id % 5 = 0 THEN 'last' END AS answer,
CASE WHEN event_id % 4 = 0 OR event_id % 3 > 0 OR event_id % 5 = 0 THEN 3 END AS support FROM events""",
    "judge_verdict": """SELECT event_id, CASE WHEN event_id % 7 > 0 THEN (event_id % 10)::VARCHAR END AS final_answer,
CASE WHEN event_id % 7 = 0 THEN 'text' ELSE ['text', 'vision', 'synth', 'text'][(event_id % 4 + 1)::INT] END AS chosen, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS reason FROM events""",
    "html_tables": f"""SELECT c_custkey AS page_id, 0 AS number, CASE WHEN c_custkey % 3 = 0 THEN '| key | segment & name |' || {NL} || '| --- | --- |'
ELSE '| 1 | 2 |' || {NL} || '| --- | --- |' || {NL} || '|  | x |' END || {NL} || '| ' || c_custkey || ' | ' || c_mktsegment || ' ' || c_name || ' |' AS markdown FROM customer""",
    "pdf_pages": f"""WITH l AS (SELECT doc_id, list_transform(string_split(text, {NL}), lambda x: {strip('x')}) AS lines FROM documents),
p AS (SELECT doc_id, lines, ceil(len(lines) / 20.0)::INT AS num_pages, unnest(generate_series(1, ceil(len(lines) / 20.0)::BIGINT))::INT AS page_number FROM l)
SELECT doc_id, page_number, num_pages, md5(coalesce(array_to_string(list_filter(lines[20 * page_number - 19 : 20 * page_number], lambda x: x <> ''), {NL}), '')) AS text_md5, NULL::VARCHAR AS error FROM p""",
    "pdf_tables_by_file": f"""WITH c AS (SELECT c_custkey // 25 AS g, c_custkey AS k, '| ' || c_custkey || ' | ' || c_name || ' | ' || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END || ' |' AS line FROM customer),
b AS (SELECT g, string_agg(line, {NL} ORDER BY k) AS body FROM c GROUP BY 1)
SELECT g, CASE WHEN g % 2 = 0 THEN '| 1 | 2 | 3 |' || {NL} || '| --- | --- | --- |' || {NL} || '| Customers of group ' || g || ' |  |  |' || {NL} || '| key | name | segment |'
ELSE '| key | name | segment |' || {NL} || '| --- | --- | --- |' END || {NL} || body AS markdown FROM b""",
    "object_recovery": "SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 5 < 4 THEN md5(text) END AS answer_md5, CASE WHEN (conv_id + turn) % 5 < 4 THEN 2 END AS support FROM conversations",
    # a name that is taken ends the part of its word before it, for names whose turn is later
    "document_mentions": r"""WITH RECURSIVE names AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}{4,}')) AS name FROM benchmark),
w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents),
d AS (SELECT DISTINCT word FROM w),
ends AS (SELECT word, unnest(generate_series(1, length(word))) AS stop FROM d),
parts AS (SELECT word, stop, name FROM (SELECT word, stop, unnest(list_transform(generate_series(1, stop), lambda i: substring(word, i, stop - i + 1))) AS name FROM ends) JOIN names USING (name)),
r AS (SELECT word, length(word) AS stop, 1000000 AS n, '' AS name FROM d
  UNION ALL SELECT word, stop - length(new), length(new), new FROM (
    SELECT r.word, r.stop, arg_max(p.name, length(p.name)) AS new FROM r JOIN parts p ON p.word = r.word AND p.stop = r.stop
    WHERE length(p.name) < r.n OR (length(p.name) = r.n AND p.name > r.name) GROUP BY r.word, r.stop)),
f AS (SELECT DISTINCT doc_id, name FROM w JOIN r USING (word) WHERE name <> '')
SELECT doc_id, count(*) AS n, md5(string_agg(name, ',' ORDER BY name)) AS names_md5 FROM f GROUP BY 1""",
    "locate_documents": """WITH f AS (SELECT lower(c_name) || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '_2024' END AS stem, '/in/' || c_name || CASE WHEN c_custkey % 3 = 0 THEN '.pdf' ELSE '_2024.pdf' END AS path FROM customer WHERE c_custkey % 3 < 2),
a AS (SELECT o_orderkey AS qid, lower(CASE WHEN o_orderkey % 5 = 0 THEN left(c_name, length(c_name) - 1) ELSE c_name END) AS doc FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT qid, arg_min(path, (CASE WHEN stem = doc THEN 0 ELSE 1 END, path)) AS path FROM a JOIN f ON starts_with(stem, doc) GROUP BY 1""",
    "judged_ensemble": f"""WITH q AS (SELECT conv_id, split_part(text, {NL}, 1) AS said FROM conversations WHERE turn = 0),
s AS (SELECT conv_id, CASE conv_id % 3 WHEN 0 THEN role || ' ' || left(text, 60) WHEN 1 THEN '' END AS seen FROM conversations WHERE turn = 1),
j AS (SELECT q.conv_id, said, seen, seen IS NOT NULL AND length(said) % 4 > 0 AND length(seen) > length(said) AS takes FROM q LEFT JOIN s USING (conv_id))
SELECT conv_id AS qid, md5({strip('CASE WHEN takes THEN seen ELSE said END')}) AS answer_md5, CASE WHEN takes THEN 'vision' ELSE 'text' END AS chosen,
CASE WHEN seen IS NULL THEN '' WHEN length(said) % 4 = 0 THEN 'unsure' ELSE 'longer' END AS reason, md5(said) AS candidate_md5, 1 AS support FROM j""",
}
