"""Answers of mixed type, as a tagged struct; parsing, emptiness, vote keys and coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import BLANK, col, strip
from quern.schema import VALUE

# Fixed values.
EMPTY = ("", "n/a", "na", "none", "null", "нет данных", "не указано", "not specified", "no data", "-", "—")
TRUE_WORDS = ("true", "yes", "да", "1")
FALSE_WORDS = ("false", "no", "нет", "0")
QUOTES = "'\"«»"

SIMPLE_NUMBER = r"\A[+\-]?[0-9]+(?:[.,][0-9]+)?\z"
_QUOTED = rf"\A[{QUOTES}]([^\n]*?)[{QUOTES}]\z"


def value(kind: str | Column, s=None, i=None, d=None, b=None) -> Column:
    """A value; ``marker`` is equal for answers that are the same JSON."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    s, i, d, b = (F.lit(None).cast(t) if x is None else x.cast(t) for x, t in ((s, "string"), (i, "bigint"), (d, "double"), (b, "boolean")))
    marker = F.concat(kind, F.lit(":"), F.coalesce(s, i.cast("string"), d.cast("string"), b.cast("string"), F.lit("")))
    return F.struct(kind.alias("kind"), s.alias("s"), i.alias("i"), d.alias("d"), b.alias("b"), marker.alias("marker"))


def from_variant(v: Column | str) -> Column:
    """A value from a VARIANT: integers, other numbers, strings, booleans; all else is null."""
    v = col(v)
    kind = F.schema_of_variant(v)
    is_number = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    name = F.when(kind == "BIGINT", "int").when(is_number, "float").when(kind == "STRING", "str").when(kind == "BOOLEAN", "bool").otherwise("null")
    get = lambda t, on: F.when(on, F.try_variant_get(v, "$", t))
    return value(name, get("string", kind == "STRING"), get("bigint", kind == "BIGINT"), get("double", is_number), get("boolean", kind == "BOOLEAN"))


def to_variant(v: Column) -> Column:
    json = F.when(v["kind"] == "str", F.to_json(F.array(v["s"]))).when(v["kind"] == "int", F.concat(F.lit("["), v["i"].cast("string"), F.lit("]"))).when(v["kind"] == "float", F.to_json(F.array(v["d"]))).when(v["kind"] == "bool", F.to_json(F.array(v["b"]))).otherwise("[null]")
    return F.try_variant_get(F.parse_json(json), "$[0]", "variant")


def null_value() -> Column:
    return value("null").cast(VALUE)


def as_text(v: Column) -> Column:
    return F.coalesce(v["s"], v["i"].cast("string"), v["d"].cast("string"), F.when(v["b"], "True").when(~v["b"], "False"), F.lit("None"))


def unquote(s: Column) -> Column:
    """Without one quote on each side (they need not match), and outer blanks inside them."""
    return F.when(s.rlike(_QUOTED), strip(F.regexp_extract(s, _QUOTED, 1))).otherwise(s)


def parse_number(s: Column) -> Column:
    """For votes and maxima: blanks inside are dropped, a comma is a point; percents are no numbers."""
    t = strip(s)
    core = F.replace(F.replace(t, F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return F.when((t != "") & ~t.endswith("%") & core.rlike(SIMPLE_NUMBER), core.try_cast("double"))


def number_of(v: Column) -> Column:
    """The number of a numeric value or numeric string, else null; booleans are not numbers."""
    return F.when(v["kind"] == "int", v["i"].cast("double")).when(v["kind"] == "float", v["d"]).when(v["kind"] == "str", parse_number(v["s"]))


def is_number(v: Column) -> Column:
    return v["kind"].isin("int", "float")


def is_empty(v: Column) -> Column:
    """Null, a numeric 0, or a string that says nothing; the string "0" and booleans are answers."""
    text = F.lower(unquote(F.lower(strip(v["s"]))))
    return F.when(v["kind"] == "null", True).when(v["kind"] == "str", text.isin(*EMPTY)).when(is_number(v), number_of(v) == 0.0).otherwise(False)


def vote_key(v: Column) -> Column:
    """(number, text): answers with equal keys are one vote."""
    s = unquote(strip(v["s"]))
    number = F.when(v["kind"] == "str", parse_number(s)).otherwise(number_of(v))
    text = F.when(v["kind"] == "null", "__none__").when(number.isNotNull(), "__num__").when(v["kind"] == "str", F.trim(F.regexp_replace(F.lower(s), BLANK + "+", " "))).otherwise(F.lower(as_text(v)))
    return F.struct(number.alias("number"), text.alias("text"))


def repair_number(v: Column) -> Column:
    """Numeric strings become numbers: one percent sign, blanks (also hard ones) and underscores
    go, a comma is a point; integral ones become integers. All else stays."""
    t = F.regexp_replace(strip(v["s"]), rf"{BLANK}*%\z", "")
    core = F.replace(F.regexp_replace(t, "[\\x{A0}\\x{202F} _]", ""), F.lit(","), F.lit("."))
    number = F.when((v["kind"] == "str") & core.rlike(SIMPLE_NUMBER), core.try_cast("double"))

    def typed(n: Column) -> Column:
        whole = F.when((n == F.floor(n)) & (F.abs(n) < 9.2e18), n.cast("bigint"))
        return F.when(whole.isNotNull(), value("int", i=whole)).when(n.isNotNull(), value("float", d=n)).otherwise(v)

    return F.transform(F.array(number), typed)[0]


def coerce_answer(raw: Column, kind: Column) -> Column:
    """A model's text as int (truncated), float or trimmed string; the first number counts, and
    digits after a blank are not part of it."""
    kind = F.lower(F.trim(F.coalesce(kind, F.lit("str"))))
    number = F.replace(F.regexp_extract(raw, r"[-+]?[0-9]+(?:[.,][0-9]+)?", 0), F.lit(","), F.lit(".")).try_cast("double")
    as_int = F.when(F.abs(number) < 9.2e18, value("int", i=number.cast("bigint")))
    as_float = F.when(number.isNotNull(), value("float", d=number))
    return F.when(raw.isNull(), null_value()).when(kind == "int", F.coalesce(as_int, null_value())).when(kind == "float", F.coalesce(as_float, null_value())).otherwise(value("str", s=strip(raw)))


def coerce_to(v: Column, original: Column) -> Column:
    """The answer in the kind of the original one; integers round half to even."""
    number = number_of(v)
    to_int = F.when(is_number(v), F.rint(number)).when((v["kind"] == "str") & (number == F.floor(number)), number)
    word = F.lower(strip(v["s"]))
    to_bool = F.when(v["kind"] == "bool", v["b"]).when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).when(is_number(v), number != 0)
    return (
        F.when(original.isNull() | (v["kind"] == "null"), v)
        .when((original == "int") & to_int.isNotNull(), value("int", i=to_int))
        .when((original == "float") & number.isNotNull(), value("float", d=number))
        .when((original == "str") & (v["kind"] != "str"), value("str", s=as_text(v)))
        .when((original == "bool") & to_bool.isNotNull(), value("bool", b=to_bool))
        .otherwise(v)
    )


def same(a: Column, b: Column) -> Column:
    """Equal answers; 0 and 0.0 are."""
    return F.when(is_number(a) & is_number(b), number_of(a) == number_of(b)).otherwise(a["marker"] == b["marker"])
