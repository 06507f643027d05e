"""Cutting lineage in a folder that all executors share, so that a lost executor costs no recomputation."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def durable(df: DataFrame) -> DataFrame:
    """The rows, written to the folder that the cluster names in spark.checkpoint.dir (read from the session; set to a
    temporary folder only where it is unset and Spark runs in one process, as in tests) and read from there."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = sc.getConf().get("spark.checkpoint.dir")
        if where is None:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            where = tempfile.mkdtemp(prefix="checkpoint-")
        sc.setCheckpointDir(where)
    return df.checkpoint(eager=True)


#: Rows that a table may have to be broadcast.
SMALL = 200_000


def durable_with(df: DataFrame, **what: Column) -> tuple[DataFrame, dict]:
    """``durable``, and aggregates of the rows that are taken as they are written."""
    seen = Observation()
    kept = durable(df.observe(seen, *[v.alias(k) for k, v in what.items()]))
    return kept, seen.get


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is made and run within are removed when it ended, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)
