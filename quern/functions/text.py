"""Text expressions: cleaning, blanks, tokens. Columns only.

Character classes are spelled out, as the regular expressions of Java, Python and RE2 differ
in what ``\\s`` and ``\\w`` mean beyond ASCII."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.config import CleanRules

#: White space as Python's str knows it.
BLANK = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same as characters.
BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: What ends a line for Python's splitlines, after control characters are gone.
LINE_END = r"[\n\x{85}\x{2028}\x{2029}]"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.btrim(col(x), F.lit(BLANKS))


def is_blank(x: Column | str) -> Column:
    return F.coalesce(~col(x).rlike(r"[^\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"), F.lit(True))


def strip_control(x: Column | str) -> Column:
    """Without characters under U+0020 but the line feed; tabs vanish, they don't become blanks."""
    return F.regexp_replace(col(x), r"[\x00-\x09\x0B-\x1F]", "")


def normalize_blanks(x: Column | str) -> Column:
    out = F.regexp_replace(col(x), r"[ \t]{2,}|\t", " ")  # single blanks stay as they are
    out = F.replace(out, F.lit("\xa0"), F.lit(" "))  # after runs are collapsed, so runs of these stay runs
    # blanks before a line feed go, and with them empty lines
    lines = F.filter(F.transform(F.split(out, "\n"), lambda line: F.rtrim(line, F.lit(BLANKS))), lambda line: line != "")
    return strip(F.array_join(lines, "\n"))


def clean(x: Column | str, rules: CleanRules = CleanRules()) -> Column:
    out = F.coalesce(col(x), F.lit(""))
    out = strip_control(out) if rules.strip_control_chars else out
    return normalize_blanks(out) if rules.normalize_spaces else out


def compact(x: Column | str) -> Column:
    """White-space runs as one blank, outer ones gone."""
    return F.trim(F.regexp_replace(F.coalesce(col(x), F.lit("")), BLANK + "+", " "))


def low_text(x: Column | str, least: int = 64) -> Column:
    return F.length(compact(x)) < least


def occurrences(x: Column | str, part: str) -> Column:
    x = col(x)
    return F.floor((F.length(x) - F.length(F.replace(x, F.lit(part), F.lit("")))) / len(part))


def approx_tokens(x: Column | str) -> Column:
    n = F.length(col(x))
    return F.when(F.coalesce(n, F.lit(0)) == 0, 0).otherwise(F.greatest(F.lit(1), F.floor((n + 3) / 4))).cast("int")


def tokens(x: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(col(x), F.lit(""))), F.lit(TOKEN), F.lit(0))


def stem(name: Column | str) -> Column:
    """A file name without folders and without its last suffix."""
    return F.regexp_replace(F.regexp_replace(col(name), r"^.*/", ""), r"(?<=.)\.[^.]+$", "")


def printable(x: Column | str) -> Column:
    """Number of visible characters."""
    return F.length(F.regexp_replace(F.coalesce(col(x), F.lit("")), r"(?U)[^\p{Graph}]", ""))
