"""Bilingual rules, fallback replies, the judge, page images, workbook questions, and the entry functions."""

import base64
import json
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.config import Ocr
from quern.operators import ensemble, entities, recovery
from quern.operators import values as V
from quern.plans import entry
from quern.sources import files, parsed, sinks, workbooks

#: (question, rewrite, what may stay)
CASES = [
    ("Какова прибыль АО Kaspi?", 'Какова прибыль АО Kaspi (Каспи)?', "Какова прибыль АО Kaspi?"),  # mixed letters count as Russian: English is due
    ("Какова прибыль ТОО Делойт?", "Какова прибыль ТОО Делойт (Deloitte LLP)?", "Какова прибыль ТОО Делойт (Deloitte)?"),
    ("Кто такой Иван Петров?", "Кто такой Иван Петров (Ivan Petrov)?", "Кто такой Иван Петров (Ivan Petrov)?"),
    ("Who is John Smith?", "Who is John Smith (Джон Смит)?", "Who is John Smith (Джон Смит)?"),
    ("Who is John Smith?", "Who is John Smith (Jon Smit)?", "Who is John Smith?"),  # the wrong language
    ("Сколько людей в Алматы?", "Сколько людей в Алматы (Almaty)?", "Сколько людей в Алматы?"),  # a place
    ("Что платят физические лица?", "Что платят физические лица (individuals)?", "Что платят физические лица?"),  # generic
    ("Это АО или нет?", "Это, АО (JSC) или нет?", "Это, АО или нет?"),  # only a legal form
    ("Где Народный банк?", "Где Народный банк (Halyk Bank | Narodny)?", "Где Народный банк?"),  # two variants
    ("Где Народный банк?", "'Где Народный банк (JSC Halyk Bank)?'", "Где Народный банк (Halyk Bank)?"),
    ("Где Народный банк?", "", "Где Народный банк?"),
    ("Где Народный банк?", None, "Где Народный банк?"),
    ("Плюс КЕГОК?", "Плюс, КЕГОК (KEGOC)?", "Плюс, КЕГОК (KEGOC)?"),
]


def test_bilingual_rules(spark):
    rows = [(i, q, r) for i, (q, r, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, q string, r string").select("i", entities.expanded(F.col("q"), F.col("r")).alias("x"))
    got = {r.i: r.x for r in df.collect()}
    # a rewrite without any translation left is dropped as a whole
    assert [got[i] for i in range(len(CASES))] == [q if "(" not in want else want for q, _, want in CASES]


def test_bilingual_parts(spark):
    row = spark.createDataFrame([("JSC Halyk Bank, LLP",)], "s string").select(
        entities.bare_name(F.lit("JSC LLC Halyk Bank, LLP")).alias("a"), entities.bare_name(F.lit("Акционерное  общество «Казахтелеком»")).alias("b"),
        entities.script_language(F.lit("Қазақтелеком")).alias("c"), entities.anchor_of(F.lit("a, b: c d")).alias("d"), entities.facts(F.lit("АО и ТОО"), F.lit(""))["only_forms"].alias("e"),
        entities.facts(F.lit("123"), F.lit(""))["only_forms"].alias("f"), entities.facts(F.lit("«Физические  лица»"), F.lit(""))["generic"].alias("g"), entities.script_language(F.lit("12")).alias("h"),
    ).first()
    assert tuple(row) == ("Halyk Bank", "Казахтелеком»", "kk", "c d", True, False, True, "unknown")


def test_fallback_replies_and_verdicts(spark):
    rows = [("I'm sorry", '{"answer": "7", "support": 2}', None), ('{"answer": 5}', "x", "y"), (None, "no json", "I cannot assist {}"), ("bad", None, 'say {"answer": "z"} end')]
    got = spark.createDataFrame(rows, "a string, b string, c string").select(ensemble.first_good_reply(F.col("a"), F.col("b"), F.col("c")).alias("r")).collect()
    assert [r.r and (r.r.answer, r.r.support) for r in got] == [("7", 2), ("5", None), None, ("z", None)]
    said = ['{"chosen": "vision", "final_answer": 12, "reason": "r"}', '{"chosen": "other", "final_answer": "a"}', "broken", None]
    got = spark.createDataFrame([(s,) for s in said], "s string").select(ensemble.parse_verdict(F.col("s")).alias("r")).collect()
    assert [(r.r.final_answer, r.r.chosen, r.r.reason) for r in got] == [("12", "vision", "r"), ("a", "text", ""), (None, "text", ""), (None, "text", "")]
    asked = spark.range(1).select(ensemble.judge_request(F.lit("q"), F.lit("int"), F.lit("c"), F.lit("1"), F.lit(None).cast("string")).alias("j")).first().j
    assert json.loads(asked)["candidates"] == {"text": "1", "vision": ""}


@pytest.mark.parametrize("reply, want", [
    ('```json\n{"answer": "a"}\n```', {"answer": "a"}), ("Sure: {'answer': True, 'support': None,}", {"answer": True, "support": None}), ('x {"a": "}"} y', {"a": "}"}),
    ('[{"a": 1}]', {"a": 1}), ("{oops} then {\"a\": 2}", {"a": 2}), ("nothing", None), (None, None), ('{"a": "it\'s"}', {"a": "it's"}), ("it's {answer: 'b\\'c\"', list: [1, 2.5, [],],}", {"answer": "b'c\"", "list": [1, 2.5, []]}),
    ('{"a": {"b": 1}', {"b": 1}), ('{"a": 1, {"b": 2}', {"b": 2}), ("{'a': 'line\nfeed'}", {"a": "line\nfeed"}), ('{"a" 1} {"', None), ("{", None), ("}{", None), ("{}", {}), ("{\"a: 1} {'b': 2}", {"b": 2}), ("{1: 2}", {"1": 2}),
])
def test_recovered(reply, want):
    found = recovery.recovered(reply)
    assert (found and json.loads(found)) == want


_VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.text(), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(), x, max_size=4), max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text(), _VALUES, max_size=4), st.text(st.characters(blacklist_characters="{}")), st.text(), st.booleans())
def test_recovered_from_prose(made, before, after, python):
    """Any object behind any prose without braces is found, as JSON or as Python writes it."""
    found = recovery.recovered(before + (repr(made) if python and "\\" not in repr(made) else json.dumps(made)) + after)
    assert json.loads(found) == made


def test_recovery_is_linear():
    for text in ("{" * 100_000, '{"a": ' * 30_000, "{'a': 1, " * 30_000, "{\"" * 30_000, "{a" * 50_000):
        began = time.time()
        recovery.recovered(text)
        assert time.time() - began < 5


def test_ensemble_and_page_images(spark, tmp_path):
    hits = spark.createDataFrame([(1, 1, "alpha has 5 parts", "A", 3), (1, 2, "beta 7", "B", 4), (2, 1, "no number", "C", 1)], "qid bigint, rank int, text string, doc string, page bigint")
    asked = spark.createDataFrame([(1, "How many parts?", "int"), (2, "Parts?", "int"), (3, "none", "str")], "qid bigint, question string, answer_type string")
    (tmp_path / "b.pdf").write_bytes(b"BB")
    found = ensemble.first_pages(hits, parsed.list_files(spark, str(tmp_path), "*.pdf"))
    assert [(r.qid, r.page) for r in found.collect()] == [(1, 4)]
    images = ensemble.page_images(spark, found, str(tmp_path), lambda content, page, dpi: content + b"%d@%d" % (page, dpi))
    assert [(r.qid, base64.b64decode(r.image)) for r in images.collect()] == [(1, b"BB4@220")]
    got = {r.qid: (r.v.i, r.chosen, r.support, r.image_used) for r in ensemble.ensemble(hits, asked, images=images).collect()}
    assert got == {1: (5, "text", 1, True), 2: (None, "text", 1, False), 3: (None, "text", None, False)}


def test_pages_with_little_text_are_read_again(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"A page with enough text to be kept as it is.\fshort\f")
    read = {2: "text that the engine reads from the image", 3: ""}
    df = files.parse_files(spark, str(tmp_path), render=lambda content, page, dpi: b"%d" % page, ocr=lambda image: read[int(image)], cfg=Ocr(min_chars=20))
    assert [(r.page_number, r.text[:10], r.ocr_used) for r in df.orderBy("page_number").collect()] == [(1, "A page wit", False), (2, "text that ", True), (3, "", False)]
    content = files.as_v2(df).first().content
    assert [p.ocr_used for p in content] == [False, True, False]
    assert files.parse_files(spark, str(tmp_path), cfg=Ocr(max_pages=1)).count() == 1


def test_question_workbooks(spark, tmp_path):
    rows = spark.createDataFrame([(2, "12", "Сколько дней?", "int"), (1, "11", "Кто <он> & \"она\"?", "str")], "o int, ID string, Full_Question string, answer_type string")
    workbooks.write_table(rows, str(tmp_path / "q.xlsx"), "o")
    got = parsed.read_questions(spark, str(tmp_path / "q.xlsx")).collect()
    assert [tuple(r) for r in got] == [(11, "Кто <он> & \"она\"?", "str"), (12, "Сколько дней?", "int")]
    changed = entry.augment_workbook(spark, str(tmp_path / "q.xlsx"), str(tmp_path / "new.xlsx")).collect()
    assert [(r.question, r.augmented) for r in changed] == [("Сколько дней?", "Сколько всего дней?")]
    assert [r.question for r in parsed.read_questions(spark, str(tmp_path / "new.xlsx")).collect()] == ["Кто <он> & \"она\"?", "Сколько всего дней?"]


def test_html_tables(spark):
    html = "<p>x</p><table><tr><th>a<th>b</tr><tr><td>1</td><td>2 <b>x</b></td></tr></table><TABLE><tr><td>only &amp; one"
    got = {r.number: r.markdown for r in workbooks.html_tables(spark.createDataFrame([(1, html), (2, "none"), (3, None)], "page_id int, html string")).collect()}
    assert got == {0: "| a | b |\n| --- | --- |\n| 1 | 2 x |", 1: "| 1 |\n| --- |\n| only & one |"}


def test_build_answer_and_merge_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.pdf").write_bytes("Revenue was 125 million tenge.\fThe auditor was Deloitte.".encode())
    (tmp_path / "in" / "two.pdf").write_bytes("Weather was fine all year.".encode())
    index = entry.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), entry.Build(parse_workbooks=False))
    assert {r.doc: r.chunks for r in index["info"].collect()} == {"one": 2, "two": 1}
    assert sinks.load_index(spark, str(tmp_path / "out" / "index"), ["two"])["chunks"].count() == 1
    (tmp_path / "q.json").write_text(json.dumps([{"id": 1, "full_question": "Revenue million tenge", "answer_type": "int"}, {"id": 2, "full_question": "auditor was", "answer_type": "str"}]))
    entry.answer_file(spark, str(tmp_path / "out" / "index"), str(tmp_path / "q.json"), str(tmp_path / "answers"))
    base = parsed.read_answers(spark, str(tmp_path / "answers"))
    got = {r.qid: (V_text(r.v), [(c.document_name, c.page_number) for c in r.relevant_chunks]) for r in base.collect()}
    assert got == {1: ("125", [("one", 1)]), 2: ("The auditor was Deloitte.", [("one", 2)])}
    (tmp_path / "run.json").write_text(json.dumps([{"question_id": 1, "relevant_chunks": [], "answer": 130}]))
    _, changes = entry.merge_files(spark, str(tmp_path / "answers"), [str(tmp_path / "run.json"), str(tmp_path / "missing.json")], str(tmp_path / "merged"))
    assert [(r.qid, r.selected.i, r.reason) for r in changes.collect()] == [(1, 130, "numeric_max")]
    with pytest.raises(FileNotFoundError):
        entry.build(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"))


def V_text(v) -> str:
    return v.s if v.s is not None else str(v.i)


def test_values_to_json_and_back(spark):
    assert spark.range(1).select(V.to_variant(V.value("int", i=F.lit(3))).cast("int").alias("x")).first().x == 3


def test_judge_between_two_candidates(spark):
    hits = spark.createDataFrame([(q, 1, f"alpha {q}5 parts") for q in (1, 2, 3, 4, 5)], "qid bigint, rank int, text string")
    asked = spark.createDataFrame([(q, "How many parts?", "int") for q in (1, 2, 3, 4, 5)], "qid bigint, question string, answer_type string")
    seen = spark.createDataFrame([(1, "777"), (2, "8"), (3, None), (5, "9")], "qid bigint, candidate string")
    replies = {1: '{"chosen": "vision", "final_answer": 777, "reason": "clear"}', 2: '{"chosen": "both", "final_answer": "12"}', 5: "no verdict"}
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def judge(request):
        calls.add(1)
        said = json.loads(request)
        assert said["question"] == "How many parts?" and said["context_snippets"].startswith("[1] alpha")
        return replies[{"777": 1, "8": 2, "9": 5}[said["candidates"]["vision"]]]

    got = {r.qid: (r.v.i, r.chosen, r.reason, r.candidate) for r in ensemble.ensemble(hits, asked, vision=seen, judge=judge).collect()}
    assert got == {1: (777, "vision", "clear", "15"), 2: (12, "text", "", "25"), 3: (35, "text", "", "35"), 4: (45, "text", "", "45"), 5: (55, "text", "", "55")}
    assert calls.value == 3  # each once, and only where there are two candidates


def test_good_replies_need_no_python(spark):
    from quern.operators import ensemble

    df = spark.createDataFrame([('{"answer": "a", "support": 2}',), ("I\'m sorry {}",), ("none",)], "x string").select(ensemble.first_good_reply(F.col("x")).alias("r"))
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.r and (r.r.answer, r.r.support) for r in df.collect()] == [("a", 2), None, None]
