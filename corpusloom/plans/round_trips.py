"""Queries that go out through a sink and come back through a reader, whole tables each, with the SQL of what must come back.

What they write lies in the shared folder of spark.checkpoint.dir (a temporary one only where it is unset and Spark runs in one process, as in tests).
"""

from __future__ import annotations

import io
import os
import tarfile
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import sampling
from corpusloom.plans import queries as Q
from corpusloom.schema import RECORD
from corpusloom.sources import exports, readers

query, read = Q.query, Q.read


def scratch(s: SparkSession) -> str:
    """A new folder that all executors share."""
    root = s.sparkContext.getConf().get("spark.checkpoint.dir")
    if root is None:
        if not s.sparkContext.master.startswith("local[") and s.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="trips-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def local(path: str) -> str:
    """The same folder as a path of the operating system (token arrays and archives are written there)."""
    return path.removeprefix("file://").removeprefix("file:")


def _lines(s, d):
    out = scratch(s)
    exports.json_lines(read(s, d, "json_rows").select(*RECORD.names), out)
    return readers.json_lines(s, out)


@query("SELECT condition, instruction, response FROM json_rows WHERE condition IS NOT NULL AND instruction IS NOT NULL AND response IS NOT NULL")
def trip_json_lines(s, d):
    return _lines(s, d)[0].select(*RECORD.names)


@query("SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN condition IS NULL THEN 'condition_not_text' WHEN instruction IS NULL THEN 'instruction_not_text' WHEN response IS NULL THEN 'response_not_text' END AS reason FROM json_rows) WHERE reason IS NOT NULL GROUP BY reason")
def trip_json_lines_refused(s, d):
    return _lines(s, d)[1].groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT task, rec_id, instruction, response FROM json_rows")
def trip_clustered(s, d):
    out = scratch(s)
    exports.clustered(read(s, d, "json_rows").select("task", "rec_id", "instruction", "response"), out)
    return readers.parquet(s, out).select("task", "rec_id", "instruction", "response")


@query("SELECT nullif(task, '') AS task, nullif(path, '') AS path, nullif(status, '') AS status FROM file_manifest")
def trip_csv(s, d):
    out = scratch(s)
    read(s, d, "file_manifest").select("task", "path", "status").write.option("header", True).csv(out)
    return readers.csv_by_place(s, out, "task", "path", "status")


@query("SELECT source, target_share FROM mix_targets")
def trip_json_array(s, d):
    out = scratch(s)
    # Seventeen rows at every scale, in one array.
    read(s, d, "mix_targets").agg(F.to_json(F.collect_list(F.struct("source", "target_share"))).alias("value")).coalesce(1).write.text(out)
    return s.read.schema("source string, target_share double").option("multiLine", True).json(out).select("source", "target_share")


@query(f"SELECT trim(regexp_replace(instruction, '[\\r\\n]', ' ', 'g'), '{Q.W}') AS instruction, trim(regexp_replace(response, '[\\r\\n]', ' ', 'g'), '{Q.W}') AS response FROM json_rows WHERE instruction IS NOT NULL AND response IS NOT NULL")
def trip_alternating_lines(s, d):
    out = scratch(s)
    flat = lambda k: F.regexp_replace(k, "[\\r\\n]", " ")
    rows = read(s, d, "json_rows").where("instruction is not null and response is not null")
    rows.select(F.explode(F.array(flat("instruction"), flat("response"))).alias("value")).write.text(out)
    return readers.alternating_lines(s, out).select("instruction", "response")


@query("SELECT CAST(item_id AS VARCHAR) || '.txt' AS path, question FROM eval_items")
def trip_tar(s, d):
    out = local(scratch(s))
    os.makedirs(out)
    with tarfile.open(f"{out}/items.tar.gz", "w:gz") as tar:
        for r in read(s, d, "eval_items").select("item_id", "question").toLocalIterator():
            body = (r.question or "").encode()
            head = tarfile.TarInfo(f"{r.item_id}.txt")
            head.size = len(body)
            tar.addfile(head, io.BytesIO(body))
    return readers.tar_members(s, f"file://{out}/items.tar.gz").select("path", F.col("content").cast("string").alias("question"))


@query(f"{Q._ALL}, p AS (SELECT epoch, row_number() OVER (PARTITION BY epoch ORDER BY md5(concat_ws('|', '{Q.SEED}', CAST(epoch AS VARCHAR), task, CAST(draw AS VARCHAR))), task, draw) - 1 AS place, inst_start, resp_len FROM drawn) SELECT epoch, CAST(place AS BIGINT) AS place, inst_start, CAST(resp_len AS BIGINT) AS resp_len FROM p")
def trip_epoch_arrays(s, d):
    out = local(scratch(s))
    placed = sampling.shuffled(Q._drawn(s, d).where("inst_start is not null and inst_len is not null and resp_start is not null"), seed=Q.SEED)
    exports.epoch_arrays(placed, out)
    rows = readers.npy_column(s, f"file://{out}")
    part = lambda i: F.element_at(F.split("file", "/"), i)
    side = lambda name: F.max(F.when(part(-1) == f"{name}.npy", F.col("value")))
    by = rows.groupBy(F.regexp_extract(part(-2), r"epoch_(\d+)", 1).cast("int").alias("epoch"), "place")
    return by.agg(side("inst_start").alias("inst_start"), side("resp_len").alias("resp_len"))
