"""Parsed documents, workbooks, sinks, caches, streaming, and the end-to-end plan."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from quern.config import Ocr, Rerank, Retriever
from quern.operators import normalize
from quern.operators import values as V
from quern.plans import corpus
from quern.sources import files, parsed, sinks, workbooks
from quern.streaming import ingest


def v2(name, pages, **more):
    return {"doc_name": name, "source_path": "/in", "num_pages": len(pages), "backend": "b", "ocr_model": None, "content": [{"page_id": i, "page_number": n, "text": t} for i, n, t in pages], **more}


def test_normalising(spark, tmp_path):
    docs = [v2("a.b.pdf", [(1, 2, "two"), (2, 1, "one"), (7, 0, "seven")]), {"metainfo": {"sha1_name": "v1", "pages_amount": 1}, "content": [{"page": 4, "content": [{"type": "text", "text": "x"}, {"type": "pic", "text": "no"}, {"type": "text", "text": "y"}]}]}, {"other": 1}]
    for k, d in enumerate(docs):
        (tmp_path / f"{k}.json").write_text(json.dumps(d))
    (tmp_path / "bad.json").write_text("{not json")
    found = normalize.normalize(parsed.read_parsed(spark, str(tmp_path)))
    assert sorted(map(tuple, normalize.pages_of(found).collect())) == [("a.b", 1, "one"), ("a.b", 2, "two"), ("a.b", 7, "seven"), ("v1", 4, "x\ny")]


def test_ocr_choice(spark):
    df = spark.createDataFrame([("short", "longer text"), ("short", ""), ("short", "s"), ("x" * 100, "y" * 200), (None, "got it"), ("a", None)], "t string, o string")
    assert [r[0] for r in df.select(normalize.choose_ocr(F.col("t"), F.col("o"), Ocr(min_chars=64))).collect()] == ["longer text", "short", "short", "x" * 100, "got it", "a"]


def workbook(sheets, shared=()):
    out = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, (n, _) in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<R>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(len(sheets))) + "</R>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        for k, (_, cells) in enumerate(sheets):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {ns}><sheetData><row>{cells}</row></sheetData></worksheet>")
    return out.getvalue()


def test_workbooks(spark, tmp_path):
    cells = '<c r="A1" t="s"><v>0</v></c><c r="B1"><v>2</v></c><c r="A2" t="b"><v>1</v></c><c r="C2"><v>1.50</v></c><c r="B2" t="inlineStr"><is><t>in  line</t></is></c>'
    (tmp_path / "w.xlsx").write_bytes(workbook([("One", cells), ("Empty", "")], ["head er"]))
    (tmp_path / "~$w.xlsx").write_bytes(b"lock")
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    rows = workbooks.parse_workbooks(spark, str(tmp_path)).orderBy("doc_name", "page_number").collect()
    assert len(rows) == 3 and rows[0].doc_name == "bad.xlsx" and "BadZipFile" in rows[0].error
    assert rows[1].text == "# Sheet: One\n| A | B | C |\n| --- | --- | --- |\n| head er | 2 |  |\n| TRUE | in line | 1.5 |"
    assert rows[2].text == "# Sheet: Empty\n(empty sheet)" and rows[2].sheet_title == "Empty"
    docs = files.as_v2(workbooks.parse_workbooks(spark, str(tmp_path)))
    assert {r.doc_name: (r.num_pages, r.error is None) for r in docs.collect()} == {"w.xlsx": (2, True), "bad.xlsx": (0, False)}


def test_sheet_limits():
    text = workbooks.sheet_markdown("t", [[1, 2, 3]] * 5, 5, 3, 2, 2)
    assert text.endswith("\n\n(truncated to 2 rows × 2 cols)") and text.count("\n| 1 | 2 |") == 2
    assert workbooks.column_letter(28) == "AB" and len(workbooks.cell_text("x" * 500)) == 200


def test_table_markdown(spark):
    cells = spark.createDataFrame([("t", 0, 0, "h1"), ("t", 0, 1, "h2"), ("t", 1, 0, "a"), ("t", 1, 1, None), ("u", 0, 0, ""), ("u", 0, 1, "x")], "table string, r int, c int, value string")
    got = {r.table: r.markdown for r in workbooks.table_markdown(cells).collect()}
    assert got["t"] == "| h1 | h2 |\n| --- | --- |\n| a |  |" and got["u"] == "| 1 | 2 |\n| --- | --- |\n|  | x |"


def test_plain_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ftwo")
    assert [(r.page_number, r.text) for r in files.parse_files(spark, str(tmp_path), glob="*.txt").orderBy("page_number").collect()] == [(1, "one"), (2, "two")]
    assert parsed.list_files(spark, str(tmp_path), "*.txt").first().name == "a.txt"


def test_answers_files(spark, tmp_path):
    runs = [[{"question_id": 1, "relevant_chunks": [{"document_name": "d", "page_number": 2}], "answer": 5}, {"question_id": 2, "answer": 1.5}], [{"question_id": 1, "answer": "x"}, {"question_id": "bad", "answer": 1}]]
    for k, r in enumerate(runs):
        (tmp_path / f"r{k}.json").write_text(json.dumps(r))
    found = parsed.read_runs(spark, [f"file://{tmp_path}/r0.json", f"file://{tmp_path}/none.json", f"file://{tmp_path}/r1.json"])
    assert sorted((r.qid, r.run, r.v.kind) for r in found.collect()) == [(1, 1, "int"), (1, 3, "str"), (2, 1, "float")]
    sinks.write_answers(found.filter("run = 1"), str(tmp_path / "out"))
    back = {r.qid: r.v for r in spark.read.schema("question_id bigint, answer variant").json(str(tmp_path / "out")).select(F.col("question_id").alias("qid"), V.from_variant("answer").alias("v")).collect()}
    assert back[1].i == 5 and back[2].d == 1.5


def test_cache(spark):
    s = spark.createDataFrame([(n, 10) for n in "abcdef"], "name string, changed_at int")
    p = spark.createDataFrame([("a", 11, None, False, 2, 2, True), ("b", 9, None, False, 2, 2, True), ("c", 11, "x", False, 2, 2, True), ("d", 11, None, True, 2, 2, True), ("e", 11, None, False, 2, 1, True)], "name string, cached_at int, error string, interrupted boolean, num_pages int, n_content int, readable boolean")
    assert {r.name: r.reason for r in parsed.cache_decisions(s, p).collect()} == {"a": "cached up-to-date", "b": "outdated", "c": "has error", "d": "interrupted", "e": "incomplete content", "f": "no cache"}
    assert sorted(r.name for r in parsed.to_parse(s, p).collect()) == list("bcdef")


def test_question_answering_and_index_files(spark, tmp_path):
    pages = spark.createDataFrame([("d1", 1, "The plant made 120 tons of steel in spring."), ("d1", 2, "Nothing about it."), ("d2", 1, "Rivers run to the sea.\nThe Volga is long.")], "doc string, page bigint, text string")
    tables = corpus.index_pages(pages)
    sinks.write_index(tables["chunks"], str(tmp_path / "chunks"))
    assert spark.read.parquet(str(tmp_path / "chunks")).count() == 3
    q = spark.createDataFrame([(1, "How many tons of steel?", "int"), (2, "Which river is long, Volga?", "str"), (3, "zzz", "str")], "qid bigint, question string, answer_type string")
    hits = corpus.search(tables, q, Retriever(unique_by_page=True, top_k=5), Rerank(pre_k=10))
    got = {r.qid: r for r in corpus.answer(hits, q).collect()}
    assert (got[1].v.i, got[1].doc, got[1].page) == (120, "d1", 1)
    assert (got[2].v.s, got[2].doc) == ("The Volga is long.", "d2") and set(got) == {1, 2, 3}


def test_locate(spark):
    hits = spark.createDataFrame([(1, 1, "none"), (1, 2, "Rep.pdf"), (2, 1, "rep")], "qid int, rank int, doc string")
    f = spark.createDataFrame([("rep_long.pdf", "/p/rep_long.pdf"), ("rep.pdf", "/p/rep.pdf")], "name string, path string")
    assert sorted(map(tuple, parsed.locate(hits, f).collect())) == [(1, "/p/rep.pdf"), (2, "/p/rep.pdf")]
    plan = parsed.locate(hits, f)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert parsed.locate(hits.limit(0), f).count() == 0


def test_streaming_ingest(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    one = spark.createDataFrame([("d1", 1, "first page text")], ingest.PAGES)
    one.write.parquet(src)
    ingest.ingest(ingest.stream_pages(spark, src), out, check).awaitTermination()
    spark.createDataFrame([("d2", 1, "second page text")], ingest.PAGES).write.mode("append").parquet(src)
    ingest.ingest(ingest.stream_pages(spark, src), out, check).awaitTermination()
    assert sorted((r.doc, r.text) for r in spark.read.parquet(f"{out}/batch=*").collect()) == [("d1", "first page text"), ("d2", "second page text")]
