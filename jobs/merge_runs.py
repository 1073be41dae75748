"""Merges the answers of several runs over the same questions, period by period.

    python -m jobs.merge_runs --answers PATH --out PATH [--since PERIOD] [--config PATH]

A question's first answer is the original, later ones are candidates. The merged answer keeps the
original's type; ``out/merged`` has one folder for each period, with what changed and why. A run
writes the folders of the periods it has read and no others, so that it may be repeated, for all
periods or from ``--since`` on, with the same result."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import read_config
from quern.operators import merge
from quern.operators import values as V
from quern.session import durable

log = logging.getLogger("jobs.merge_runs")
MERGED = "question string, kind string, answer string, number double, changed boolean, reason string, n_candidates int, original string, period string"
_MARK = "|"


def merged(spark: SparkSession, out: str) -> DataFrame:
    """(question, kind, answer, number, changed, reason, n_candidates, original, period) of all periods."""
    return spark.read.schema(MERGED).parquet(f"{out}/merged")


def answers(rows: DataFrame, config: dict) -> DataFrame:
    """(qid, ord, v) of rows of any columns; ``config`` says how a row's period, question, place in the
    order of runs and answer (in a JSON text, at ``answer_path``) come from them. Rows without a period or question go."""
    key = F.concat(F.expr(config["period"]), F.lit(_MARK), F.expr(config["question"]))
    value = F.expr(f"try_variant_get(try_parse_json({config['answer']}), '{config['answer_path']}', 'variant')")
    named = rows.select(key.alias("qid"), F.expr(config["order"]).alias("ord"), value.alias("answer"))
    return named.filter("qid is not null").select("qid", "ord", V.from_variant("answer").alias("v"))


def merge_runs(spark: SparkSession, source: str, out: str, config: dict, since: str | None = None) -> dict[str, int]:
    """One run over the periods from ``since`` on (all, if null). Answers that are no JSON count as null; of equal
    places in the order the result takes either."""
    rows = spark.read.format(config["format"]).load(source)
    if since is not None:
        rows = rows.filter(F.expr(config["period"]) >= since)
    given = durable(answers(rows, config))
    base = given.groupBy("qid").agg(F.min_by("v", "ord").alias("v"), F.min("ord").alias("first"))
    later = given.join(base.select("qid", "first"), "qid").filter(F.col("ord") > F.col("first")).select("qid", F.col("ord").alias("run"), "v")
    base = base.select("qid", "v")
    result, changes = merge.merge(base, later)
    why = changes.select("qid", F.lit(True).alias("changed"), F.coalesce("reason", "combination").alias("reason"), F.size("candidates").alias("n_candidates"), V.as_text(F.col("original")).alias("original"))
    v = F.col("v")
    number = F.when(v.kind == "int", v.i.cast("double")).when(v.kind == "float", v.d)
    text = F.when(v.kind != "null", V.as_text(v))
    columns = {
        "question": F.substring_index("qid", _MARK, -1), "kind": v.kind, "answer": text, "number": number, "changed": F.coalesce("changed", F.lit(False)), "reason": F.col("reason"),
        "n_candidates": F.coalesce("n_candidates", F.lit(0)), "original": F.col("original"), "period": F.substring_index("qid", _MARK, 1),
    }
    done = result.join(why, "qid", "left").select(*[c.alias(k) for k, c in columns.items()])
    # dynamic: folders of other periods stay as they are
    done.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(f"{out}/merged")
    read = given.count()
    wrote = merged(spark, out).filter(F.lit(True) if since is None else F.col("period") >= since).agg(F.count("*"), F.count_distinct("period"), F.sum(F.col("changed").cast("int"))).first()
    log.info("read %d answers of %s", read, source)
    log.info("wrote %d questions of %d periods to %s/merged, %d of them changed", wrote[0], wrote[1], out, wrote[2] or 0)
    return {"read": read, "questions": wrote[0], "periods": wrote[1], "changed": wrote[2] or 0}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("answers", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--since")
    parser.add_argument("--config")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("merge-runs").getOrCreate()
    try:
        merge_runs(spark, args.answers, args.out, read_config(spark, args.config, "merge_runs"), args.since)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
