"""PDF pages and tables against the texts and cells that files were made from."""

import base64
import os
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.config import Ocr
from quern.plans import entry
from quern.sources import files, parsed, pdf, pdf_tables, pdf_write


def by_hand(bodies, trailer=b"/Root 1 0 R", broken=False):
    """A file of numbered objects behind a table."""
    out, places = bytearray(b"%PDF-1.4\n"), []
    for k, body in enumerate(bodies, 1):
        places.append(len(out))
        out += b"%d 0 obj\n" % k + body + b"\nendobj\n"
    at = len(out) + (7 if broken else 0)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(bodies) + 1) + b"".join(b"%010d 00000 n \n" % (p + 3 * broken) for p in places)
    return bytes(out + b"trailer\n<< /Size %d %s >>\nstartxref\n%d\n%%%%EOF" % (len(bodies) + 1, trailer, at))


def stream(data, more=b""):
    return b"<< /Length %d %s >>\nstream\n" % (len(data), more) + data + b"\nendstream"


def one_page(content, fonts=b"/F1 << /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>", more=(), **how):
    page = b"<< /Type /Page /Parent 2 0 R /Contents 4 0 R >>"
    tree = b"<< /Type /Pages /Count 1 /Kids [3 0 R] /Resources << /Font << " + fonts + b" >> /XObject << /X1 5 0 R >> >> >>"
    return by_hand([b"<< /Type /Catalog /Pages 2 0 R >>", tree, page, content if content.startswith(b"<<") else stream(content), *more], **how)


def text_of(data):
    return [x["text"] for x in pdf.parse_pdf("", data)]


def test_operators_strings_and_gaps():
    content = b"""BT /F1 10 Tf 14 TL 1 0 0 1 50 700 Tm (Plain \\(nested (brackets)\\) \\101\\n) Tj T* [(Ker) -50 (ned) -600 (apart)] TJ
    (next) ' 2 1 (quoted) " 0 Tw 0 Tc 0 -20 TD <48 65 6C6c6F> Tj ET q 1 0 0 1 0 -100 cm BT /F1 10 Tf 50 700 Td (moved) Tj 120 0 Td (right) Tj ET Q % comment
    BI /W 1 /H 1 ID \x00(Tj) EI BT /F1 10 Tf 50 500 Td (after image \xe9\x80) Tj ET unknown (x) 5 Tf"""
    assert text_of(one_page(content)) == ["Plain (nested (brackets)) A\nKerned apart\nnext\nquoted\nHello\nmoved right\nafter image é€"]


def test_encodings():
    fonts = b"""/F1 << /Type /Font /Subtype /Type1 /BaseFont /A /Encoding << /BaseEncoding /MacRomanEncoding /Differences [65 /eacute /Zcaron /afii10017 /afii10071 /uni4E2D /fi /one 97 /nowhere] >> >>
    /F2 << /Type /Font /Subtype /TrueType /BaseFont /B /FirstChar 32 /Widths [250 300] /ToUnicode 5 0 R >>"""
    told = stream(b"1 begincodespacerange <00> <ff> endcodespacerange 1 beginbfrange <41> <43> <0430> endbfrange 1 beginbfrange <44> <45> [<0066006C> <D83DDE00>] endbfrange 1 beginbfchar <46> <0021> endbfchar")
    content = b"BT /F1 10 Tf 50 700 Td (ABCDEFG\x8ea) Tj /F2 10 Tf 0 -20 Td (ABCDEF) Tj ET"
    assert text_of(one_page(content, fonts, [told])) == ["éŽАё中fi1é�\nабвfl😀!"]


def test_filters_forms_and_repair():
    shown = b"BT /F1 10 Tf 50 700 Td (inside) Tj ET"
    rows = [shown[k : k + 10].ljust(10) for k in range(0, len(shown), 10)]
    before, up = bytes(10), b""
    for r in rows:
        up += b"\x02" + bytes((a - b) & 255 for a, b in zip(r, before))
        before = r
    form = stream(zlib.compress(up), b"/Type /XObject /Subtype /Form /Matrix [1 0 0 1 0 -50] /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 10 >>")
    outer = stream(base64.a85encode(b"BT /F1 10 Tf 50 700 Td (outer) Tj ET /X1 Do") + b"~>", b"/Filter [/ASCII85Decode]")
    for broken in (False, True):
        assert text_of(one_page(outer, more=[form], broken=broken)) == ["outer\ninside"]
    with pytest.raises(ValueError, match="encrypted"):
        text_of(one_page(b"", trailer=b"/Root 1 0 R /Encrypt << /V 1 >>"))
    with pytest.raises(ValueError):
        text_of(b"%PDF-1.7 nothing else")
    packed = pdf_write.write_pdf(pdf_write.text_sheets("kept in packs\nof objects"), packed=True)
    assert text_of(packed[: packed.rindex(b"startxref")]) == ["kept in packs\nof objects"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs", "Cc", "Zs", "Zl", "Zp")), min_size=1, max_size=12), min_size=1, max_size=40), st.booleans(), st.integers(1, 9))
def test_round_trip(words, packed, per_page):
    lines = [" ".join(words[k : k + 3]) for k in range(0, len(words), 3)]
    found = text_of(pdf_write.write_pdf(pdf_write.text_sheets("\n".join(lines), per_page), packed))
    assert found == ["\n".join(lines[k : k + per_page]) for k in range(0, len(lines), per_page)]


def sheet(rows, xs, top, rules):
    texts = [(x + 3, top - 15 * i, c) for i, row in enumerate(rows) for x, c in zip(xs, row) if c]
    return texts, rules


def grid_rules(xs, top, n, without=()):
    ys = [top + 11 - 15 * i for i in range(n + 1)]
    flat = [(xs[j], y, xs[j + 1], y) for i, y in enumerate(ys) for j in range(len(xs) - 1) if ("below", i - 1, j) not in without]
    upright = [(x, ys[i + 1], x, ys[i]) for j, x in enumerate(xs) for i in range(n) if ("right", i, j - 1) not in without]
    return flat + upright


def tables(sheets):
    return [pdf_tables.page_tables(p) for p in pdf.read_pages(pdf_write.write_pdf(sheets))]


def test_ruled_cells_merged_and_empty():
    xs = (40, 140, 260, 400)
    rows = [("Title over all", "", ""), ("a", "b c", "d"), ("tall", "", "x"), ("", "y", "z")]
    without = {("right", 0, 0), ("right", 0, 1), ("below", 2, 0)}
    above, below = [(40.0, 780.0, "Text above the table, in one line.")], [(40.0, 400.0, "Below.")]
    texts, rules = sheet(rows, xs, 740, grid_rules(xs, 740, 4, without))
    second = sheet([("p", "q"), ("r", "")], (40, 200, 300), 600, grid_rules((40, 200, 300), 600, 2))
    assert tables([(above + texts + second[0] + below, rules + second[1])]) == [[[list(r) for r in rows], [["p", "q"], ["r", ""]]]]


def test_boxes_drawn_as_rectangles():
    cell = lambda x, y, t: f"{x} {y} 80 20 re S BT /F1 10 Tf {x + 5} {y + 6} Td ({t}) Tj ET\n"
    content = "".join(cell(50 + 80 * j, 600 - 20 * i, f"c{i}{j}") for i in range(2) for j in range(2)).encode()
    assert [pdf_tables.page_tables(p) for p in pdf.read_pages(one_page(content))] == [[[["c00", "c01"], ["c10", "c11"]]]]


def test_columns_by_gaps():
    rows = [("name", "first quarter", "second"), ("alpha beta", "1 200", "3"), ("gamma", "", "4"), ("delta", "5", ""), ("", "total", "12")]
    plain = [(40.0, 500.0 - 15 * k, "Prose without any gap in its lines.") for k in range(5)]
    assert tables([(sheet(rows, (40, 200, 330), 740, [])[0] + plain, [])]) == [[[list(r) for r in rows]]]
    assert tables([(plain, [])]) == [[]]


def test_scan_errors_limits_ocr_and_tables(spark, tmp_path):
    xs = (40, 140, 260)
    table = sheet([("k", "v"), ("1", "2")], xs, 500, grid_rules(xs, 500, 2))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.pdf").write_bytes(pdf_write.write_pdf([([(40, 700, "first page"), *table[0]], table[1]), ([(40, 700, "second")], []), ([], [])]))
    (tmp_path / "in" / "none.pdf").write_bytes(pdf_write.write_pdf([([(40, 700, "no table here")], [])]))
    (tmp_path / "in" / "bad.pdf").write_bytes(b"%PDF-1.4 broken")
    (tmp_path / "in" / "empty.pdf").write_bytes(b"")  # Spark's reader leaves out files of no bytes
    source = str(tmp_path / "in")
    got = {(r.doc_name, r.page_number): r for r in files.parse_files(spark, source).collect()}
    assert got["good.pdf", 1].text == "first page\nk v\n1 2" and got["good.pdf", 3].text == "" and got["good.pdf", 1].num_pages == 3
    assert got["bad.pdf", None].error.startswith("ValueError") and not any(k[0] == "empty.pdf" for k in got)
    assert files.parse_files(spark, source, max_pages=1).filter("doc_name = 'good.pdf'").count() == 1
    read = files.parse_files(spark, source, render=lambda content, page, dpi: b"image", ocr=lambda image: "what the image says", cfg=Ocr(min_chars=8))
    assert {(r.page_number, r.text, r.ocr_used) for r in read.filter("doc_name = 'good.pdf'").collect()} == {(1, "first page\nk v\n1 2", False), (2, "what the image says", True), (3, "what the image says", True)}
    found = {r.path.rsplit("/", 1)[-1]: r.markdown for r in pdf_tables.tables_by_file(files.read_contents(spark, source)).collect()}
    assert found == {"good.pdf": "| k | v |\n| --- | --- |\n| 1 | 2 |", "none.pdf": pdf_tables.NONE_FOUND, "bad.pdf": pdf_tables.NONE_FOUND}
    index = entry.build(spark, source, str(tmp_path / "out"), entry.Build(parse_workbooks=False, tables=True))
    rows = spark.read.json(str(tmp_path / "out" / "parsed" / "files"))
    assert {(r.doc_name, r.num_pages) for r in rows.collect()} == {("good.pdf", 4), ("none.pdf", 1), ("bad.pdf", 0)}
    assert index["chunks"].filter(F.contains("text", F.lit("---"))).count() == 1


def test_second_build_parses_only_what_is_due(spark, tmp_path):
    """New, changed and failed files are parsed by the next build, others not; a stopped one is gone on with."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    put = lambda name, text: (source / name).write_bytes(pdf_write.write_pdf(pdf_write.text_sheets(text)))
    names = ["a.pdf", "b [1]{x}*.pdf", "c d.pdf"]
    for name in names:
        put(name, f"text of {name}")
    (source / "bad.pdf").write_bytes(b"%PDF-1.4 broken")
    what = entry.Build(parse_workbooks=False, files_per_batch=2)
    parse = lambda **more: [p.rsplit("/", 1)[-1] for p in entry.parse_new(spark, str(source), out, what, **more)]
    held = lambda: {r.doc_name: (r.content[0].text if r.content else r.error) for r in parsed.latest_parsed(spark, out).collect()}

    def stopped(path, content):  # the worker dies in the second batch
        if path.endswith("c d.pdf"):
            os._exit(1)
        return files.parse_document(path, content)

    with pytest.raises(Exception, match="(?s).*"):
        parse(parser=stopped)
    assert set(held()) == {"a.pdf", "b [1]{x}*.pdf"}
    assert parse() == ["bad.pdf", "c d.pdf"]
    assert parse() == ["bad.pdf"]  # what failed is tried again
    time.sleep(1.1)
    put("a.pdf", "changed")
    put("bad.pdf", "mended")
    put("new.pdf", "new")
    assert parse() == ["a.pdf", "bad.pdf", "new.pdf"]
    assert parse() == []
    assert held() == {"a.pdf": "changed", "bad.pdf": "mended", "new.pdf": "new"} | {n: f"text of {n}" for n in names[1:]}
    assert len(entry.parse_new(spark, str(source), out, entry.Build(again=True))) == 5


def test_reading_a_plain_page_is_quick_and_files_share_frames(spark):
    """Characters of one width are read line by line, not one by one, and a short file is no frame of its own; texts and places are as before."""
    line = "Ein Satz über Größe, привет, 中文 und so fort " * 40
    sheets = pdf_write.text_sheets("\n".join(line + str(k) for k in range(400)), 20)
    data = pdf_write.write_pdf(sheets)
    began = time.process_time()
    found = list(pdf.read_pages(data))
    took = time.process_time() - began
    assert [pdf.page_text(p) for p in found] == ["\n".join(x[2].strip() for x in texts) for texts, _ in sheets]
    slow = pdf.Font.fixed
    pdf.Font.fixed = lambda self, data: None
    try:
        began = time.process_time()
        assert list(pdf.read_pages(data)) == found
        assert 1.5 * took < time.process_time() - began
    finally:
        pdf.Font.fixed = slow
    made = pdf_write.write_pdf(pdf_write.text_sheets("one\ntwo"))
    rows = spark.createDataFrame([(f"/in/{k}.pdf", made) for k in range(30)], "path string, content binary").coalesce(1)
    frames = []
    taken = type(rows).mapInPandas

    class Caught(Exception):
        pass

    def caught(self, run, schema):
        batch = rows.toPandas()
        frames.extend(run(iter([batch.iloc[:10], batch.iloc[10:]])))
        raise Caught

    type(rows).mapInPandas = caught
    try:
        with pytest.raises(Caught):
            files.parse_contents(rows)
    finally:
        type(rows).mapInPandas = taken
    assert [len(x) for x in frames] == [30] and set(frames[0]["text"]) == {"one\ntwo"}
