"""Which files to process again, and which outputs have lost their source, by comparing manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ("task", "source_size", "source_mtime", "tokenizer_hash")


def changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """Files of ``now`` that no sound entry of ``before`` matches in size, time (seconds) and tokenizer.

    A null in an entry of ``before`` matches nothing (an unreadable manifest); one of ``now`` is new. Repeated rows count once.
    """
    done = before.where("status = 'ok'").select(*KEY).distinct() if "status" in before.columns else before.select(*KEY).distinct()
    return now.select("task", "path", *KEY[1:]).distinct().join(done, list(KEY), "left_anti").select("task", "path", *KEY[1:])


def orphans(now: DataFrame, before: DataFrame) -> DataFrame:
    """Tasks that were done before and have no source now: only such outputs may be removed."""
    return before.select("task").where("task is not null").distinct().join(now.select("task").distinct(), "task", "left_anti")


def failures(run: DataFrame) -> DataFrame:
    """Tasks whose every entry in a run failed; their earlier output stays as it is."""
    return run.groupBy("run_no", "task").agg(F.bool_or(F.coalesce(F.col("status") == "ok", F.lit(False))).alias("ok"), F.count("*").cast("bigint").alias("entries")).where("not ok").drop("ok")
