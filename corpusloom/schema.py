"""The canonical record, its tags, and the contracts that a record must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tags of a condition.
TAGS = ("direct", "cot", "noisy", "synth")
RECORD = T.StructType([T.StructField(x, T.StringType()) for x in ("condition", "instruction", "response")])
LINEAGE = T.StructType([T.StructField("task", T.StringType()), T.StructField("row_id", T.LongType())])


def violation(condition: Column, instruction: Column, response: Column) -> Column:
    """Which contract a record breaks first; null if none."""
    tags = F.split(condition, ",")
    return (
        F.when(condition.isNull() | (condition == ""), "no_condition")
        .when(F.exists(tags, lambda t: ~t.isin(*TAGS)), "unknown_tag")
        .when(instruction.isNull(), "null_instruction")
        .when(response.isNull(), "null_response")
    )


def quarantine(df: DataFrame, *, null_as_empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sound records, and the others with a column ``violation``. With ``null_as_empty`` null texts are empty ones."""
    if null_as_empty:
        df = df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("instruction", "response")})
    v = df.withColumn("violation", violation(F.col("condition"), F.col("instruction"), F.col("response")))
    return v.where("violation is null").drop("violation"), v.where("violation is not null")
