"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.tables import durable


def _star(arcs: DataFrame, large: bool) -> DataFrame:
    """Joins each node's neighbours to the least node around it.

    The least is a partial aggregate and the join's large keys can be split, so a hub's
    neighbours never gather in one place."""
    sides = arcs.union(arcs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else arcs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = sides.join(least, "a")
    if large:
        new = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return new.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``root`` is the least node it is connected to.

    ``links``: columns a and b of one orderable type. Links of a node to itself, repeated
    links and either direction are allowed; null ends are left out. An empty table gives an
    empty result. Nothing is collected but two numbers a round."""
    arcs = durable(links.select("a", "b").filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())
    before = None
    while True:
        arcs = durable(_star(_star(arcs, True), False))
        state = arcs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return arcs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(arcs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
