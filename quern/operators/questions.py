"""Questions: which need a quantity word, whether a rewrite may stand, company mentions."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import col, strip
from quern.session import durable, ship

#: Bytes of names that one automaton may be built from.
MOST_NAME_BYTES = 24 << 20

# Fixed values.
QUANTITY_MARKERS = ("всего", "итого", "общее", "общая", "общий", "совокуп", "aggregate", "total")
QUESTION_STEMS = ("сколько", "какова", "каков", "число", "количество", "на какую дату")
TERMINAL, MAX_GROWTH = "?!.…", 25
REQUIRED = ("id", "full_question", "answer_type")


def needs_augmentation(q: Column | str) -> Column:
    """Starts with a question stem and names no quantity yet; not for blank questions."""
    low = F.lower(F.coalesce(col(q), F.lit("")))
    starts = F.greatest(*[low.startswith(x) for x in QUESTION_STEMS])
    named = F.greatest(*[F.contains(low, F.lit(x)) for x in QUANTITY_MARKERS])
    return (strip(low) != "") & starts & ~named


def validated(original: Column, rewritten: Column) -> Column:
    """The rewrite, unless it is empty, loses the closing mark or grows too much."""
    new = strip(F.coalesce(rewritten, F.lit("")))
    end = F.substring(strip(original), -1, 1)
    lost = F.greatest(*[(end == c) & ~new.endswith(c) for c in TERMINAL])
    return F.when((new == "") | lost | (F.length(new) > F.length(original) + MAX_GROWTH), original).otherwise(new)


def augment(questions: DataFrame, rewrite: Column, text: str = "question") -> DataFrame:
    """With ``augmented``, and whether it ``changed``; ``rewrite`` is only asked where it is needed."""
    new = F.when(needs_augmentation(text), validated(F.col(text), rewrite)).otherwise(F.col(text))
    return questions.withColumn("augmented", new).withColumn("changed", ~F.col("augmented").eqNullSafe(F.col(text)))


def rule_rewrite(q: Column | str) -> Column:
    """The offline rewriter: a quantity word after the leading question word."""
    return F.regexp_replace(col(q), r"(?iu)\A(сколько|какова|каков|число|количество|на какую дату)(?=[\s?!.…]|\z)", "$1 всего")


def question_column(columns: list[str]) -> str:
    """The first column whose name holds "question" or "вопрос", else the first."""
    return next((c for c in columns if "question" in c.lower() or "вопрос" in c.lower()), columns[0])


def checked(questions: DataFrame) -> DataFrame:
    """(qid, question, answer_type) from columns named in any case; raises if one is missing."""
    names = {c.strip().lower(): c for c in questions.columns}
    missing = [c for c in REQUIRED if c not in names]
    if missing:
        raise ValueError(f"questions lack the columns {missing}")
    return questions.select(F.col(f"`{names['id']}`").cast("bigint").alias("qid"), F.col(f"`{names['full_question']}`").alias("question"), F.lower(F.trim(F.col(f"`{names['answer_type']}`"))).alias("answer_type"))


def _one_by_one(text: str) -> str:
    """Lower case, a character for each character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


class Mentions:
    """Names in texts by one automaton for all of them."""

    def __init__(self, names: list[str]):
        self.names = sorted(names, key=lambda c: (-len(c), c))
        self.automaton = ahocorasick.Automaton()
        for k, name in enumerate(self.names):
            key = _one_by_one(name)
            self.automaton.add_word(key, [*self.automaton.get(key, []), k])
        if self.names:
            self.automaton.make_automaton()

    def found(self, text: str) -> list[str]:
        low = _one_by_one(text)
        # by the order of names, then of places; what a name takes is a gap that no other name spans
        hits = [] if not self.names else sorted((k, end + 1 - len(self.names[k]), end + 1) for end, ks in self.automaton.iter(low) for k in ks)
        taken, out = bytearray(len(low)), []
        for k, start, end in hits:
            free = end == len(low) or taken[end] or not (low[end].isalnum() or low[end] == "_")
            if free and not any(taken[start:end]):
                taken[start:end] = b"\1" * (end - start)
                if not out or out[-1] != self.names[k]:
                    out.append(self.names[k])
        return out


def company_mentions(questions: DataFrame, companies: DataFrame) -> DataFrame:
    """(qid, company): names in a question, in any case, before a non-word character or the end.

    Longer names come first and take their text, of equal ones the first in order. ``companies`` is one column of names;
    blanks around them, blank ones and repeats don't count. All names go to every task, as one automaton, so a text is read
    once however many there are; beyond MOST_NAME_BYTES of them the call is refused. Null texts mention nothing."""
    names = companies.select(strip(F.col(f"`{companies.columns[0]}`")).alias("name")).filter("name <> ''").distinct()
    names = durable(names)
    if (names.agg(F.sum(F.octet_length("name") + 16)).first()[0] or 0) > MOST_NAME_BYTES:
        raise ValueError(f"the names have over {MOST_NAME_BYTES} bytes")
    sent = ship(questions.sparkSession).sparkContext.broadcast(names.toArrow().column("name").to_pylist())
    held: list[Mentions] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not held:
                held.append(Mentions(sent.value))
            each = [held[0].found(x) if x else [] for x in batch.column("question").to_pylist()]
            row = np.repeat(np.arange(len(each)), [len(x) for x in each])
            yield pa.RecordBatch.from_arrays([batch.column("qid").take(pa.array(row)), pa.array([x for found in each for x in found], pa.string())], ["qid", "company"])

    kind = questions.schema["qid"].dataType.simpleString()
    return questions.select("qid", "question").mapInArrow(run, f"qid {kind}, company string")
