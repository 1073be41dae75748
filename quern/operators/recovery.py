"""JSON objects in a model's free text, also where they are only nearly JSON.

Tokens drive a small table of what may follow what, for objects and arrays alike. Accepted beyond
JSON: Python's words, single quotes, bare keys, a comma before a closing mark. What doesn't fit
drops all that is open, and reading goes on behind it; so a text is read about once."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TOKEN = re.compile(r"""\s*("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|[\[\]{}:,"']|[^\s\[\]{}:,"']+)""", re.DOTALL)
_WORDS = {"true": True, "True": True, "false": False, "False": False, "null": None, "None": None}
KEY, COLON, VALUE, MORE = range(4)


class _Open:
    """An object or array that is being read, and what may come next."""

    def __init__(self, mark: str):
        self.made = {} if mark == "{" else []
        self.key, self.next = None, KEY if mark == "{" else VALUE

    def put(self, value) -> None:
        if isinstance(self.made, dict):
            self.made[self.key] = value
        else:
            self.made.append(value)
        self.next = MORE

    def closed_by(self, mark: str) -> bool:
        """A closing mark may stand for the first item, after an item, or after a comma."""
        return (mark == "}" and isinstance(self.made, dict) and self.next in (KEY, MORE)) or (mark == "]" and isinstance(self.made, list) and self.next in (VALUE, MORE))


def _unquoted(token: str) -> str:
    body = token[1:-1]
    if token[0] == "'":
        body = re.sub(r'\\.|"', lambda m: {"\\'": "'", '"': '\\"'}.get(m[0], m[0]), body, flags=re.DOTALL)
    try:
        return json.loads(f'"{body}"', strict=False)
    except ValueError:
        return body


def _literal(token: str) -> tuple[bool, object]:
    """Whether a token is a value by itself, and the value."""
    if token[0] in "\"'" and len(token) > 1:
        return True, _unquoted(token)
    if token in _WORDS:
        return True, _WORDS[token]
    try:
        return True, json.loads(token)
    except ValueError:
        return False, token


def recovered(text: str | None) -> str | None:
    """The first object in ``text`` as JSON; of one that breaks off, the first whole one in it. Null if there is none."""
    text = text or ""
    stack: list[_Open] = []
    inner: dict | None = None  # the first whole object inside those that are open
    at = text.find("{")
    while 0 <= at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:
            break
        token, fits = m[1], False
        at = m.end()
        top = stack[-1] if stack else None
        if token in "{[":
            fits = top is None or top.next == VALUE
            if fits:
                stack.append(_Open(token))
        elif token in "}]":
            fits = top.closed_by(token)
            if fits:
                done = stack.pop().made
                if not stack:
                    return json.dumps(done, ensure_ascii=False)
                inner = done if inner is None and isinstance(done, dict) else inner
                stack[-1].put(done)
        elif token == ":":
            fits = top.next == COLON
            top.next = VALUE if fits else top.next
        elif token == ",":
            fits = top.next == MORE
            top.next = (KEY if isinstance(top.made, dict) else VALUE) if fits else top.next
        else:
            whole, value = _literal(token)
            if top.next == KEY:
                fits = token not in "\"'"
                top.key, top.next = (value if isinstance(value, str) else token), COLON
            elif top.next == VALUE and whole:
                fits = True
                top.put(value)
        if not fits:
            if inner is not None:
                break
            stack = []
            at = text.find("{", m.start(1) + (token != "{"))
    return None if inner is None else json.dumps(inner, ensure_ascii=False)


@F.pandas_udf(StringType())
def json_object(replies: pd.Series) -> pd.Series:
    """:func:`recovered` of replies that the plain parser can't read, by Arrow batches; null stays null."""
    return replies.map(recovered, na_action="ignore")
