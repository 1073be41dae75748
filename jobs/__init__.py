"""Runnable jobs, and the same jobs as queries over the given tables.

Each job is a function that takes a session and plain paths; its module has a command line and a
small config file beside it. The registered queries run the function twice into one new folder."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.oracle import _CHUNKS, _SELECT, number
from quern.session import shared_folder


def own_config(name: str) -> dict:
    """The config file that lies beside a job."""
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.json"), encoding="utf-8") as f:
        return json.load(f)


def read_config(spark: SparkSession, path: str | None, name: str) -> dict:
    """A config file from any store that Spark reads; without a path the job's own."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if path else own_config(name)


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def job1_refresh_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobs import refresh_passages as job

    folder, config = _new_folder(spark, "job1"), own_config("refresh_passages")
    for _ in range(2):
        job.refresh(spark, f"{sf_dir}/documents.parquet", f"{folder}/out", f"{folder}/checkpoint", config)
    return job.passages(spark, f"{folder}/out").select("doc", "page", "place", "start_pos", "end_pos", F.md5("text").alias("text_md5"))


JOB1_SQL = f"""WITH {_CHUNKS}
SELECT doc, page, (row_number() OVER (PARTITION BY doc, page ORDER BY start_pos) - 1)::INT AS place, start_pos, end_pos, md5(text) AS text_md5 FROM chunks"""


def job2_merge_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from jobs import merge_runs as job

    folder, config = _new_folder(spark, "job2"), own_config("merge_runs")
    for _ in range(2):
        job.merge_runs(spark, f"{sf_dir}/events.parquet", f"{folder}/out", config)
    found = job.merged(spark, f"{folder}/out")
    return found.select("period", "question", "kind", F.when(F.col("kind") != "float", F.col("answer")).alias("answer"), F.round("number", 6).alias("number"), "changed", "reason", "n_candidates")


#: The questions of a period, in place of the groups that the other queries over events judge.
_PERIODS = _SELECT.replace("user_id || ':' || (event_id // 500) || ':' || CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS qid", "strftime(ts, '%Y-%m-%d') || '|' || user_id AS qid")
JOB2_SQL = f"""WITH {_PERIODS},
base AS (SELECT qid, arg_min(kind, ord) AS kind, arg_min(marker, ord) AS marker, arg_min(text, ord) AS text, arg_min(coalesce(i::DOUBLE, d), ord) AS num FROM v GROUP BY 1),
c AS (SELECT base.qid, p.kind AS picked_kind, p.answer, CASE WHEN p.kind = 'int' THEN p.i::DOUBLE WHEN p.kind = 'float' THEN p.d WHEN p.kind = 'str' THEN {number('p.answer')} END AS num,
  coalesce(p.reason, p.combination) AS way, nullif(base.kind, 'null') AS original_type, base.marker, base.kind AS base_kind, base.num AS base_num, base.text AS base_text FROM base LEFT JOIN picked p USING (qid)),
n AS (SELECT *, CASE WHEN picked_kind IS NULL THEN base_kind WHEN original_type IS NULL OR picked_kind = 'null' THEN picked_kind WHEN original_type = 'int' AND (picked_kind IN ('int', 'float') OR num = floor(num)) THEN 'int'
  WHEN original_type = 'float' AND num IS NOT NULL THEN 'float' WHEN original_type = 'str' THEN 'str' ELSE picked_kind END AS kind FROM c),
s AS (SELECT *, picked_kind IS NOT NULL AND NOT (CASE WHEN kind IN ('int', 'float') AND base_kind IN ('int', 'float') THEN CASE WHEN kind = 'int' THEN round_even(num, 0) ELSE num END = base_num
  ELSE kind || ':' || CASE WHEN kind = 'null' THEN '' ELSE answer END = marker END) AS changed FROM n)
SELECT split_part(qid, '|', 1) AS period, split_part(qid, '|', 2) AS question, kind,
  CASE WHEN kind = 'null' THEN NULL WHEN picked_kind IS NULL THEN CASE WHEN kind <> 'float' THEN base_text END WHEN kind = 'int' THEN round_even(num, 0)::BIGINT::VARCHAR WHEN kind <> 'float' THEN answer END AS answer,
  round(CASE WHEN kind = 'int' THEN round_even(coalesce(num, base_num), 0) WHEN kind = 'float' THEN coalesce(num, base_num) END, 6) AS number, changed, CASE WHEN changed THEN way END AS reason,
  CASE WHEN changed THEN (SELECT count(*) FROM many WHERE many.qid = s.qid)::INT ELSE 0 END AS n_candidates FROM s"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_refresh_passages": job1_refresh_passages, "job2_merge_runs": job2_merge_runs}
SQL: dict[str, str] = {"job1_refresh_passages": JOB1_SQL, "job2_merge_runs": JOB2_SQL}
