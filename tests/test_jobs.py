"""The jobs: growing input, repeated runs, their command lines."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import jobs
from jobs import merge_runs, refresh_passages

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PAGES = "doc_id bigint, text string, source string, other int"


def pages(spark, ids):
    body = {0: "A short page.", 1: "", 2: None, 3: "One line of a page that is longer than the others.\n" * 60}
    rows = [(k, body[k % 4] if k % 4 < 3 else f"{k} {body[3]}", None if k % 7 == 0 else f"s{k % 3}", k) for k in ids]
    return spark.createDataFrame(rows, PAGES).coalesce(1)


def rows(df):
    return sorted(map(repr, df.collect()))


def files(spark, path):
    return {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}


def test_passages_of_growing_input(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("pages", "out", "mark"))
    config = jobs.own_config("refresh_passages") | {"files_per_batch": 1}
    pages(spark, range(0, 30)).write.parquet(source)
    first = refresh_passages.refresh(spark, source, out, checkpoint, config)
    held = files(spark, f"{out}/passages")
    pages(spark, range(30, 40)).write.mode("append").parquet(source)
    pages(spark, range(40, 50)).write.mode("append").parquet(source)
    second = refresh_passages.refresh(spark, source, out, checkpoint, config)
    assert (first["read"], second["read"]) == (30, 20)  # only what is new
    assert held < files(spark, f"{out}/passages")  # what was there stays
    third = refresh_passages.refresh(spark, source, out, checkpoint, config)
    assert third == second | {"read": 0}
    want = refresh_passages.cut(pages(spark, range(50)), config)
    assert rows(refresh_passages.passages(spark, out)) == rows(want)
    totals = {r.doc: (r.pages, r.passages) for r in spark.read.parquet(f"{out}/totals").collect()}
    assert totals == {r.doc: (r.pages, r.passages) for r in want.groupBy("doc").agg(F.count_distinct("page").alias("pages"), F.count("*").alias("passages")).collect()}
    assert None in totals


def test_passages_after_a_stop(spark, tmp_path, monkeypatch):
    """A run that dies in its second batch leaves the first; the next run goes on from there, without repeats."""
    source, out, checkpoint = (str(tmp_path / x) for x in ("pages", "out", "mark"))
    config = jobs.own_config("refresh_passages") | {"files_per_batch": 1}
    pages(spark, range(0, 8)).write.parquet(source)
    refresh_passages.refresh(spark, source, out, checkpoint, config)
    pages(spark, range(8, 16)).write.mode("append").parquet(source)
    broken = config | {"text": "case when doc_id = 11 then raise_error('stop') else text end"}
    with pytest.raises(Exception, match="stop"):
        refresh_passages.refresh(spark, source, out, checkpoint, broken)
    assert rows(refresh_passages.passages(spark, out)) == rows(refresh_passages.cut(pages(spark, range(8)), config))
    refresh_passages.refresh(spark, source, out, checkpoint, config)
    assert rows(refresh_passages.passages(spark, out)) == rows(refresh_passages.cut(pages(spark, range(16)), config))


def test_passages_of_an_empty_table(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("pages", "out", "mark"))
    pages(spark, []).write.parquet(source)
    assert refresh_passages.refresh(spark, source, out, checkpoint, jobs.own_config("refresh_passages")) == {"read": 0, "documents": 0, "passages": 0}


CONFIG = {"format": "parquet", "period": "day", "question": "q", "order": "run", "answer": "said", "answer_path": "$", "combine_lists": True, "prefer_max_for_numeric": True}
SAID = [
    ("d1", "a", 1, "0"), ("d1", "a", 2, "11"), ("d1", "a", 3, "2"), ("d1", "b", 1, '"N/A"'), ("d1", "b", 2, '"Caspian"'), ("d1", "c", 1, '"same"'), ("d2", "a", 1, '"x, y"'), ("d2", "a", 2, '"y, z"'),
    ("d2", "b", 1, "not json"), ("d2", "b", 2, "3"), ("d3", "a", 1, "2.5"), (None, "a", 1, "1"), ("d3", None, 1, "1"), ("d3", "e", 1, None), ("d3", "e", 2, "null"),
]
WANT = {
    ("d1", "a"): ("int", "11", True, "numeric_max"), ("d1", "b"): ("str", "Caspian", True, "frequency_vote"), ("d1", "c"): ("str", "same", False, None), ("d2", "a"): ("str", "y, x, z", True, "list_union"),
    ("d2", "b"): ("int", "3", True, "numeric_max"), ("d3", "a"): ("float", "2.5", False, None), ("d3", "e"): ("null", None, False, None),
}


def said(spark, periods):
    return spark.createDataFrame([r for r in SAID if r[0] in periods], "day string, q string, run int, said string")


def test_merge_by_period(spark, tmp_path):
    source, out = str(tmp_path / "said"), str(tmp_path / "out")
    said(spark, ("d1", "d2", None)).write.parquet(source)
    merge_runs.merge_runs(spark, source, out, CONFIG)
    early = {f for f in files(spark, f"{out}/merged") if "period=d1" in f}
    said(spark, ("d3",)).write.mode("append").parquet(source)
    wrote = merge_runs.merge_runs(spark, source, out, CONFIG, since="d2")
    assert wrote["periods"] == 2 and early < files(spark, f"{out}/merged")  # the earlier period was not written again
    found = merge_runs.merged(spark, out)
    assert {(r.period, r.question): (r.kind, r.answer, r.changed, r.reason) for r in found.collect()} == WANT
    once = rows(found)
    merge_runs.merge_runs(spark, source, out, CONFIG)
    assert rows(merge_runs.merged(spark, out)) == once
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_answers_are_judged_once_a_run(spark, tmp_path, monkeypatch):
    """What was merged and what changed come from one table of judged answers; it was worked out for each of them."""
    from quern.operators import merge

    source, kept = str(tmp_path / "said"), []
    said(spark, ("d1", "d2", "d3")).write.parquet(source)
    for module in (merge, merge_runs):
        monkeypatch.setattr(module, "durable", lambda df, f=module.durable: kept.append("said" in df._jdf.queryExecution().optimizedPlan().toString() and "max_by" in df._jdf.queryExecution().optimizedPlan().toString()) or f(df))
    merge_runs.merge_runs(spark, source, str(tmp_path / "out"), CONFIG)
    assert kept.count(True) == 1
    assert {(r.period, r.question): (r.kind, r.answer, r.changed, r.reason) for r in merge_runs.merged(spark, str(tmp_path / "out")).collect()} == WANT


def test_command_lines(spark, tmp_path):
    source, said_at = str(tmp_path / "pages"), str(tmp_path / "said")
    pages(spark, range(12)).write.parquet(source)
    said(spark, ("d1",)).write.parquet(said_at)
    (tmp_path / "own.json").write_text(__import__("json").dumps(CONFIG))
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    for args in (
        ["jobs.refresh_passages", "--source", source, "--out", str(tmp_path / "o1"), "--checkpoint", str(tmp_path / "c1")],
        ["jobs.merge_runs", "--answers", said_at, "--out", str(tmp_path / "o2"), "--config", str(tmp_path / "own.json")],
    ):
        done = subprocess.run([sys.executable, "-m", *args], env=env, cwd=ROOT, capture_output=True, text=True, timeout=240)
        assert done.returncode == 0, done.stderr[-2000:]
        assert " read " in done.stderr and ("wrote" in done.stderr or "now holds" in done.stderr)
    assert rows(refresh_passages.passages(spark, str(tmp_path / "o1"))) == rows(refresh_passages.cut(pages(spark, range(12)), jobs.own_config("refresh_passages")))
    assert merge_runs.merged(spark, str(tmp_path / "o2")).count() == 3


@pytest.mark.parametrize("name", sorted(jobs.QUERIES))
def test_registered(spark, name):
    found = jobs.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and name in jobs.SQL


def test_entry_imports_without_a_session():
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
