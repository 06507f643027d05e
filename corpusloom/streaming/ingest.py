"""Records of new files as a stream: cleaned by a recipe, and written by task as they come.

A file source sees new files only; changed and removed ones are the business of ``operators.incremental``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.recipes import RECIPES
from corpusloom.schema import violation


def clean_stream(spark: SparkSession, source: str, recipe: str, *, fmt: str = "json", files_per_trigger: int = 1000) -> DataFrame:
    """A recipe over the files that appear below ``source``. A recipe without tasks has its name as the task."""
    r = RECIPES[recipe]
    out = r(spark.readStream.schema(r.schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(source))
    return out if "task" in out.columns else out.withColumn("task", F.lit(recipe))


def write_stream(records: DataFrame, out: str, checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Appends sound records to ``out/records`` by task, and others to ``out/quarantine``; each batch exactly once."""

    def put(batch: DataFrame, number: int) -> None:
        v = batch.withColumn("violation", violation(F.col("condition"), F.col("instruction"), F.col("response")))
        for name, part in (("records", v.where("violation is null").drop("violation")), ("quarantine", v.where("violation is not null"))):
            # The batch's number is a folder, so a batch that is run again replaces itself.
            part.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "task").parquet(f"{out}/{name}")

    w = records.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()
