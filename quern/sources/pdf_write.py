"""Plain PDF files of positioned text and rules: reports for people, and input for the reader."""

from __future__ import annotations

import zlib

#: A page: (x, y, text) and (x0, y0, x1, y1) in points from the lower left.
Sheet = tuple[list[tuple[float, float, str]], list[tuple[float, float, float, float]]]
_ADVANCE = 600


def _content(texts: list[tuple[float, float, str]], rules: list, codes: dict[int, int], size: float) -> bytes:
    out = [f"{x0:g} {y0:g} m {x1:g} {y1:g} l S" for x0, y0, x1, y1 in rules]
    out += ["BT", f"/F1 {size:g} Tf"]
    for x, y, text in texts:
        for c in dict.fromkeys(text):
            codes.setdefault(ord(c), len(codes) + 1)
        shown = text.translate(codes).encode("utf-16-be", "surrogatepass").hex()
        out.append(f"1 0 0 1 {x:g} {y:g} Tm <{shown}> Tj")
    return "\n".join([*out, "ET"]).encode()


def _unicode_map(codes: dict[int, int]) -> bytes:
    each = [f"<{k:04x}> <{chr(c).encode('utf-16-be').hex()}>" for c, k in codes.items()]
    parts = [each[k : k + 100] for k in range(0, len(each), 100)]
    body = "\n".join(f"{len(p)} beginbfchar\n" + "\n".join(p) + "\nendbfchar" for p in parts)
    return f"begincmap\n1 begincodespacerange\n<0000> <ffff>\nendcodespacerange\n{body}\nendcmap".encode()


def write_pdf(sheets: list[Sheet], packed: bool = False, size: float = 10.0) -> bytes:
    """A file of fixed-width text in any script. ``packed`` puts its objects in an object stream behind a
    cross-reference stream, as newer files do; else they stand alone behind a table."""
    codes: dict[int, int] = {}
    pages = [_content(*sheet, codes, size) for sheet in sheets]
    bodies = {1: b"<< /Type /Catalog /Pages 2 0 R >>"}
    streams: dict[int, tuple[bytes, bytes]] = {6: (b"", _unicode_map(codes))}
    kids = [7 + 2 * k for k in range(len(pages))]
    bodies[2] = f"<< /Type /Pages /Count {len(kids)} /Kids [{' '.join(f'{k} 0 R' for k in kids)}] /Resources << /Font << /F1 3 0 R >> >> /MediaBox [0 0 612 792] >>".encode()
    bodies[3] = b"<< /Type /Font /Subtype /Type0 /BaseFont /Fixed /Encoding /Identity-H /DescendantFonts [4 0 R] /ToUnicode 6 0 R >>"
    bodies[4] = f"<< /Type /Font /Subtype /CIDFontType2 /BaseFont /Fixed /DW {_ADVANCE} /FontDescriptor 5 0 R >>".encode()
    bodies[5] = b"<< /Type /FontDescriptor /FontName /Fixed /Flags 4 >>"
    for k, data in zip(kids, pages):
        bodies[k] = f"<< /Type /Page /Parent 2 0 R /Contents {k + 1} 0 R >>".encode()
        streams[k + 1] = (b"", data)
    out, places = bytearray(b"%PDF-1.5\n"), {}

    def put(number: int, body: bytes) -> None:
        places[number] = len(out)
        out.extend(b"%d 0 obj\n" % number + body + b"\nendobj\n")

    def stream(more: bytes, data: bytes) -> bytes:
        data = zlib.compress(data, 1)
        return b"<< /Length %d /Filter /FlateDecode %s >>\nstream\n" % (len(data), more) + data + b"\nendstream"

    for number, (more, data) in streams.items():
        put(number, stream(more, data))
    last = max([*bodies, *streams]) + 1
    if not packed:
        for number, body in bodies.items():
            put(number, body)
        at = len(out)
        out += b"xref\n0 %d\n0000000000 65535 f \n" % last + b"".join(b"%010d 00000 n \n" % places[k] for k in range(1, last))
        return bytes(out + b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (last, at))
    head, body = [], b""
    for number, x in bodies.items():
        head.append(f"{number} {len(body)}")
        body += x + b"\n"
    first = " ".join(head).encode() + b"\n"
    put(last, stream(b"/Type /ObjStm /N %d /First %d" % (len(bodies), len(first)), first + body))
    order, at = list(bodies), len(out)
    rows = [(0, 0, 65535)] + [(2, last, order.index(k)) if k in bodies else (1, places[k], 0) for k in range(1, last + 1)] + [(1, at, 0)]
    raw = b"".join(a.to_bytes(1, "big") + b.to_bytes(4, "big") + c.to_bytes(2, "big") for a, b, c in rows)
    put(last + 1, stream(b"/Type /XRef /Size %d /W [1 4 2] /Root 1 0 R" % len(rows), raw))
    return bytes(out + b"startxref\n%d\n%%%%EOF\n" % at)


def text_sheets(text: str, per_page: int = 60, size: float = 10.0) -> list[Sheet]:
    """The lines of a text, ``per_page`` on a page, one under the other."""
    lines = text.split("\n")
    return [([(40.0, 760.0 - 1.2 * size * k, x) for k, x in enumerate(lines[at : at + per_page]) if x], []) for at in range(0, len(lines), per_page)]
