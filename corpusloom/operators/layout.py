"""Where rows lie in the flat token stream, metadata of the data set, and the width of exported ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_offsets(rows: DataFrame) -> DataFrame:
    """inst_start and resp_start of each row in its task's stream, in the order of row_id. ``rows``: task, row_id, inst_len, resp_len (null: 0).

    Rows are summed by blocks of 4,096 ids first, so that no task's rows are sorted in one place.
    """
    total = F.coalesce("inst_len", F.lit(0)) + F.coalesce("resp_len", F.lit(0))
    r = rows.withColumn("_b", F.expr("row_id div 4096")).withColumn("_t", total)
    blocks = r.groupBy("task", "_b").agg(F.sum("_t").alias("_n")).withColumn("_before", F.sum("_n").over(Window.partitionBy("task").orderBy("_b")) - F.col("_n")).drop("_n")
    within = F.sum("_t").over(Window.partitionBy("task", "_b").orderBy("row_id")) - F.col("_t")
    at = r.withColumn("_w", within).join(blocks, ["task", "_b"]).withColumn("inst_start", (F.col("_before") + F.col("_w")).cast("bigint"))
    return at.withColumn("resp_start", F.col("inst_start") + F.coalesce("inst_len", F.lit(0))).drop("_b", "_t", "_w", "_before")


def task_offsets(rows: DataFrame) -> DataFrame:
    """task, length, base: where each task's stream begins when all are laid one after the other by name; of unclipped lengths."""
    n = rows.groupBy("task").agg(F.sum(F.coalesce("inst_len", F.lit(0)) + F.coalesce("resp_len", F.lit(0))).cast("bigint").alias("length"))
    # One row for each task (file): few enough for one window.
    return n.withColumn("base", (F.sum("length").over(Window.partitionBy(F.lit(0)).orderBy("task")) - F.col("length")).cast("bigint"))


def metadata(drawn: DataFrame, *, epochs: int, context: int = 4097) -> DataFrame:
    """One row: max_seq_len, total_length (mean tokens an epoch, halves to even; 0 without epochs). ``drawn``: draws, or rows with ``cov``."""
    times = F.col("cov") if "cov" in drawn.columns else F.lit(1)
    t = F.coalesce(F.sum((F.col("inst_len") + F.col("resp_len")) * times), F.lit(0))
    return drawn.agg(t.alias("t")).select(F.lit(context).alias("max_seq_len"), (F.bround(F.col("t").cast("decimal(38,4)") / epochs, 0).cast("bigint") if epochs else F.lit(0).cast("bigint")).alias("total_length"))


def id_type(vocabulary: int | None) -> str:
    """The narrowest type by the vocabulary's size: uint8 to 255, uint16 to 65,535, else (and unknown) int32."""
    if vocabulary is None:
        return "int32"
    return "uint8" if vocabulary <= 255 else "uint16" if vocabulary <= 65535 else "int32"
