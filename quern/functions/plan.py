"""Plan helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once for each row.

    Spark merges projections, and would work a costly expression out again wherever its result
    is used, even for every pair of a join. A one-element explode keeps it apart, without a shuffle."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]
