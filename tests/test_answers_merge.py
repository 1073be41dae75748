"""Answer values, votes and merging, with recorded outcomes and a plain Python model."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quern.operators import answers as A
from quern.operators import merge, questions, recovery
from quern.operators import values as V
from quern.schema import VALUE


def val(x):
    kind = "null" if x is None else "bool" if isinstance(x, bool) else "int" if isinstance(x, int) else "float" if isinstance(x, float) else "str"
    own = {"str": x, "int": x, "float": x, "bool": x}.get(kind)
    return (kind, own if kind == "str" else None, own if kind == "int" else None, own if kind == "float" else None, own if kind == "bool" else None, f"{kind}:{'' if x is None else str(x).lower() if kind == 'bool' else x}")


def plain(v):
    return None if v is None or v["kind"] == "null" else {"str": v["s"], "int": v["i"], "float": v["d"], "bool": v["b"]}[v["kind"]]


def frame(spark, rows):
    return spark.createDataFrame([(q, o, val(x)) for q, o, x in rows], f"qid bigint, ord int, v {VALUE}")


RECORDED = {
    52: (["N/A", "Caspian Fiber Optic Company B.V"], "Caspian Fiber Optic Company B.V", "frequency_vote"), 80: ([None, 3], 3, "numeric_max"), 94: ([0, 11, 2], 11, "numeric_max"),
    103: (["N/A", "ТОО «Делойт»"], "ТОО «Делойт»", "frequency_vote"), 107: (["ноль тенге", "не раскрыто", "ноль"], "не раскрыто", "frequency_vote"), 118: ([0, 22927], 22927, "numeric_max"),
}


def test_recorded_merges(spark):
    base = spark.createDataFrame([(q, val(c[0])) for q, (c, _, _) in RECORDED.items()] + [(1, val("kept"))], f"qid bigint, v {VALUE}")
    runs = spark.createDataFrame([(q, k, val(x)) for q, (c, _, _) in RECORDED.items() for k, x in enumerate(c[1:], 1)] + [(1, 1, val("kept")), (999, 1, val("no base"))], f"qid bigint, run int, v {VALUE}")
    merged, changes = merge.merge(base, runs)
    got = {r.qid: plain(r.v) for r in merged.collect()}
    assert got == {**{q: x for q, (_, x, _) in RECORDED.items()}, 1: "kept"}
    rows = {r.qid: r for r in changes.collect()}
    assert {q: r.reason for q, r in rows.items()} == {q: w for q, (_, _, w) in RECORDED.items()}
    assert all([plain(v) for v in rows[q].candidates] == c for q, (c, _, _) in RECORDED.items())


def select(spark, cands):
    r = merge.select_best(frame(spark, [(1, k, x) for k, x in enumerate(cands)])).first()
    return plain(r.v), r.reason or r.combination


@pytest.mark.parametrize(
    "cands, want",
    [
        (["a, b", "B; c"], ("b, a, c", "list_union")), (["x and y", "Y / z", "y, x, z"], ("x and y", "frequency_vote")), (["Bank", "the bank of X", "BANK"], ("the bank of X", "substring_collapse")),
        (["N/A", None, 0, "—", "«нет данных»"], (None, "all_empty")), (["0", "5"], ("5", "numeric_max")), (["1 000", "1000,5", "7"], ("1000,5", "numeric_max")), (["5%", 4], ("5%", "frequency_vote")),
        (["yes", "Yes ", "nope!"], ("yes", "frequency_vote")), ([3, 3.0, "3"], (3, "numeric_max")), ([True, "x"], (True, "frequency_vote")),
    ],
)
def test_selection(spark, cands, want):
    assert select(spark, cands) == want


def test_coercion(spark):
    cases = [(2.5, "int", 2), (3.5, "int", 4), ("12", "int", 12), ("1,5", "float", 1.5), (7, "str", "7"), ("да", "bool", True), ("no", "bool", False), (0, "bool", False), ("x", "int", "x"), (None, "int", None), (5, None, 5)]
    df = spark.createDataFrame([(i, val(x), k) for i, (x, k, _) in enumerate(cases)], f"i int, v {VALUE}, k string")
    got = {r.i: plain(r.c) for r in df.select("i", V.coerce_to(F.col("v"), F.col("k")).alias("c")).collect()}
    assert got == {i: w for i, (_, _, w) in enumerate(cases)}
    assert all(type(got[i]) is type(w) for i, (_, _, w) in enumerate(cases))


def test_number_repair(spark):
    cases = [("12,5 %", 12.5), ("1 234", 1234), ("1_000", 1000), ("abc 5", "abc 5"), ("5 тенге", "5 тенге"), ("7.0", 7), ("", ""), (4, 4), (None, None), ("+3", 3)]
    df = spark.createDataFrame([(i, val(x)) for i, (x, _) in enumerate(cases)], f"i int, v {VALUE}")
    once = {r.i: plain(r.c) for r in df.select("i", V.repair_number(F.col("v")).alias("c")).collect()}
    assert once == {i: w for i, (_, w) in enumerate(cases)}


def test_typed_answers(spark):
    cases = [("about 1 234", "int", 1), ("12.7", "int", 12), ("-3,9", "int", -3), ("x", "int", None), ("x 2,5", "float", 2.5), (" t ", "str", "t"), (None, "str", None), ("z", "odd", "z")]
    df = spark.createDataFrame([(i, x, k) for i, (x, k, _) in enumerate(cases)], "i int, x string, k string")
    assert {r.i: plain(r.c) for r in df.select("i", V.coerce_answer(F.col("x"), F.col("k")).alias("c")).collect()} == {i: w for i, (_, _, w) in enumerate(cases)}


def test_variants_round_trip(spark):
    texts = ["1", "2.5", '"a b"', "true", "null", "0.0", "0"]
    df = spark.createDataFrame([(t,) for t in texts], "j string").select("j", V.from_variant(F.parse_json("j")).alias("v"))
    got = {r.j: (plain(r.v), r.v.kind, r.back) for r in df.withColumn("back", F.to_json(V.to_variant(F.col("v")))).collect()}
    assert {t: k for t, (_, k, _) in got.items()} == {"1": "int", "2.5": "float", '"a b"': "str", "true": "bool", "null": "null", "0.0": "float", "0": "int"}
    assert got["2.5"][0] == 2.5 and got['"a b"'][2] == '"a b"' and got["1"][2] == "1" and got["true"][2] == "true"


def test_support(spark):
    hits = spark.createDataFrame([(1, 1, "nothing here"), (1, 2, "total 1 234 units"), (2, 1, "rate 12,4"), (2, 2, "rate 99"), (3, 1, "alpha beta"), (3, 2, "Gamma delta alpha")], "qid int, rank int, text string")
    numbers = spark.createDataFrame([(1, "1234"), (2, "12.5")], "qid int, answer string")
    assert sorted(map(tuple, A.support_near(hits, numbers).collect())) == [(1, 2), (2, 1)]
    texts = spark.createDataFrame([(3, '"gamma delta"'), (1, "missing words")], "qid int, answer string")
    assert sorted(map(tuple, A.support_overlap(hits, texts).collect())) == [(3, 2)]
    said = spark.createDataFrame([(1, val("units")), (3, val("zeta"))], f"qid int, v {VALUE}")
    assert sorted(map(tuple, A.support_literal(hits, said).collect())) == [(1, 2), (3, 1)]


def test_replies(spark):
    df = spark.createDataFrame([('{"answer": "x", "support": 2}',), ('so: {"answer": 5} ok',), ("I'm sorry",), ('```{"a": "}"} tail {',), (None,)], "r string")
    rows = df.select(A.parse_reply(F.col("r")).alias("p"), A.looks_like_refusal(F.col("r")).alias("no"), recovery.json_object("r").alias("o")).collect()
    assert [r.p.answer for r in rows[:2]] == ["x", "5"] and rows[0].p.support == 2 and rows[2].no and rows[3].o == '{"a": "}"}' and rows[4].o is None


def test_questions(spark):
    df = spark.createDataFrame([("Сколько стран?",), ("Сколько всего стран?",), (" Сколько",), ("",), (None,), ("Какова сумма?",)], "q string")
    assert [r[0] for r in df.select(questions.needs_augmentation("q")).collect()] == [True, False, False, False, False, True]
    v = spark.createDataFrame([("a?", "b?"), ("a?", "b"), ("a", ""), ("a", "x" * 40), ("a", None)], "o string, n string")
    assert [r[0] for r in v.select(questions.validated(F.col("o"), F.col("n"))).collect()] == ["b?", "a?", "a", "a", "a"]
    q = spark.createDataFrame([(1, "Acme Corp and acme!"), (2, "Acmeism"), (3, None)], "qid int, question string")
    assert sorted(map(tuple, questions.company_mentions(q, spark.createDataFrame([("acme",), ("Acme Corp ",), ("acme",), (" ",), (None,)], "n string")).collect())) == [(1, "Acme Corp"), (1, "acme")]
    with pytest.raises(ValueError):
        questions.checked(q)
    assert questions.checked(spark.createDataFrame([(1, "x", " INT ")], "ID int, Full_Question string, answer_type string")).first().answer_type == "int"


def test_repeated_candidates_change_nothing(spark):
    random.seed(3)
    pool = ["a, b", "b; c", "Bank", "bank", 5, 5.0, "7", None, "N/A", "x y z"]
    rows = [(q, k, random.choice(pool)) for q in range(30) for k in range(4)]
    once = {r.qid: plain(r.v) for r in merge.select_best(merge.distinct_candidates(frame(spark, rows))).collect()}
    again = {r.qid: plain(r.v) for r in merge.select_best(merge.distinct_candidates(frame(spark, rows + [(q, k + 10, x) for q, k, x in rows]))).collect()}
    assert once == again


def test_mentions_equal_a_plain_search(spark):
    """The automaton against one search for each name, longest first, each taking what it finds."""
    rng = random.Random(7)
    names = sorted({"".join(rng.choice("ab B-é") for _ in range(rng.randrange(1, 5))).strip() for _ in range(60)} - {""})
    texts = ["".join(rng.choice("abAB -éÉ_1") for _ in range(rng.randrange(40))) for _ in range(200)] + [None, "", "İab İ a"]
    want = set()
    for k, text in enumerate(texts):
        rest = text or ""
        for name in sorted(names, key=lambda n: (-len(n), n)):
            new = re.sub(re.escape(name) + r"(?![^\W\x00])", lambda m: "\x00" * len(m[0]), rest, flags=re.I)
            if new != rest:
                want.add((k, name))
            rest = new
    q = spark.createDataFrame(list(enumerate(texts)), "qid bigint, question string")
    got = questions.company_mentions(q, spark.createDataFrame([(n,) for n in names], "name string")).collect()
    assert len(got) == len(set(got)) and {(r.qid, r.company) for r in got} == want
    assert questions.company_mentions(q, spark.createDataFrame([], "name string")).count() == 0


def test_mentions_of_very_many_names(spark, monkeypatch):
    names = spark.range(100_000).select(F.concat(F.lit("Company "), F.col("id").cast("string")).alias("name"))
    q = spark.createDataFrame([(1, "company 99999 and COMPANY 12, not company 123456789"), (2, "Companies")], "qid bigint, question string")
    assert {tuple(r) for r in questions.company_mentions(q, names).collect()} == {(1, "Company 99999"), (1, "Company 12")}
    monkeypatch.setattr(questions, "MOST_NAME_BYTES", 1000)
    with pytest.raises(ValueError):
        questions.company_mentions(q, names)
