"""Stages from the command line: ``python -m corpusloom.pipeline STAGE key=value ...``.

clean recipe=.. source=.. out=.. [format=parquet]     raw rows to records by task, others to quarantine
tokenize roots=a,b tokenizer=tokenizer.json info=info.json out=..   changed files to token rows by task, with offsets
sample index=.. policy=.. out=.. [epochs seed context least]   epochs, coverage report, metadata
Unknown keys are an error.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, fields

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import incremental, layout, report, sampling, tokenize
from corpusloom.operators.recipes import RECIPES
from corpusloom.schema import RECORD, quarantine
from corpusloom.sources import exports, readers


@dataclass(frozen=True)
class Clean:
    recipe: str
    source: str
    out: str
    format: str = "parquet"


@dataclass(frozen=True)
class Tokenize:
    roots: str
    tokenizer: str
    info: str
    out: str


@dataclass(frozen=True)
class Sample:
    index: str
    policy: str
    out: str
    epochs: int = 10
    seed: int = 0
    context: int = sampling.CONTEXT
    least: int = sampling.LEAST_RESPONSE


def options(kind: type, args: list[str]):
    types = {f.name: f.type for f in fields(kind)}
    given = dict(a.split("=", 1) for a in args)
    if extra := set(given) - set(types):
        raise SystemExit(f"unknown: {', '.join(sorted(extra))}")
    return kind(**{k: int(v) if types[k] in (int, "int") else v for k, v in given.items()})


def clean(spark: SparkSession, o: Clean) -> None:
    r = RECIPES[o.recipe]
    out = r(spark.read.schema(r.schema).format(o.format).load(o.source))
    out = out if "task" in out.columns else out.withColumn("task", F.lit(o.recipe))
    good, bad = quarantine(out)
    exports.clustered(good, f"{o.out}/records")
    exports.parquet(bad, f"{o.out}/quarantine")


#: Files that one job takes.
BATCH = 1000


def tokenized(spark: SparkSession, o: Tokenize) -> dict[str, list[str]]:
    """Token rows of every file that is new, changed, or was done with another tokenizer; outputs whose source is gone are
    removed, and only those. A file that can't be read, or holds a broken row, keeps its old output and is tried again next time.

    Files are taken ``BATCH`` at a time, each batch in one job. ``info``: JSON with the ids boq, eoq, eoa and the tags' ids (condition_mapping).
    Gives tasks done, failed and removed.
    """
    info = readers.tokenizer_info(o.info)
    spec = tokenize.Spec(o.tokenizer, info["boq"], info["eoq"], info["eoa"], info["condition_mapping"])
    with open(o.tokenizer, "rb") as f:
        now = readers.listing(spark, *o.roots.split(",")).withColumn("tokenizer_hash", F.lit(hashlib.md5(f.read()).hexdigest()))
    kept = f"{o.out}/manifest.json"
    old = json.loads(exports.read_text(spark, kept) or "[]")
    before = spark.createDataFrame([tuple(x) for x in old], "task string, path string, source_size bigint, source_mtime bigint, tokenizer_hash string, status string")
    gone = [r.task for r in incremental.orphans(now, before).collect()]
    for t in gone:
        exports.remove(spark, f"{o.out}/rows/task={t}")
    files = sorted(incremental.changed(now, before).collect(), key=lambda r: r.task)  # files, not rows
    done, failed = [], []
    for kind in (".jsonl", ".parquet"):
        mine = [r for r in files if r.path.endswith(kind)]
        for at in range(0, len(mine), BATCH):
            bad = _batch(spark, mine[at : at + BATCH], kind, spec, f"{o.out}/rows")
            for path, why in bad.items():
                print(f"{path}: {why}", file=sys.stderr)
            failed += [r for r in mine[at : at + BATCH] if r.path in bad]
            done += [r for r in mine[at : at + BATCH] if r.path not in bad]
    again = {r.task for r in done + failed}
    rest = [x for x in old if x[0] not in again and x[0] not in gone]
    exports.write_text(spark, kept, json.dumps(rest + [[*r, "ok"] for r in done] + [[*r, "failed"] for r in failed]))
    return {"done": sorted(r.task for r in done), "failed": sorted(r.task for r in failed), "removed": sorted(gone)}


def _batch(spark: SparkSession, files: list, kind: str, spec: tokenize.Spec, out: str) -> dict[str, str]:
    """Writes the rows of the files; those that can't be, with the reason. Broken rows are found first, so that a file is written whole or not at all."""
    task = spark.createDataFrame([(_plain(r.path), r.task, r.path) for r in files], "_p string, task string, path string")
    bad: dict[str, str] = {}
    try:
        if kind == ".parquet":
            bad = _unreadable(spark, [r.path for r in files])
            if len(bad) == len(files):
                return bad
        raw, odd = _raw(spark, [r.path for r in files if r.path not in bad], kind)
        sound, broken = quarantine(raw, null_as_empty=True)
        wrong = broken.select("_p", F.col("violation").alias("why"))
        wrong = wrong.unionByName(odd) if odd is not None else wrong
        for r in wrong.groupBy("_p").agg(F.min("why").alias("why")).join(task, "_p").collect():  # at most a row for each file of the batch
            bad[r.path] = r.why
        good = task.where(~F.col("path").isin(list(bad))) if bad else task
        if len(bad) < len(files):
            rows = readers.with_row_ids_in_blocks(sound.join(F.broadcast(good.select("_p", "task")), "_p"), "_at").select("task", "row_id", *RECORD.names)
            exports.clustered(layout.row_offsets(tokenize.tokenized(rows, spec)), out)
        return bad
    except Exception as e:  # noqa: BLE001
        if len(files) == 1:
            return {files[0].path: str(e)[:300]}
        # A file that can't be read at all: the batch is halved until it stands alone.
        half = len(files) // 2
        return _batch(spark, files[:half], kind, spec, out) | _batch(spark, files[half:], kind, spec, out)


def _plain(path: str) -> str:
    """A path as Spark names it in a row's metadata, without the slashes that differ."""
    from urllib.parse import quote

    return re.sub(r"^file:/+", "file:/", quote(path, safe="/:=+@,~!$&'()*;"))


def _raw(spark: SparkSession, paths: list[str], kind: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the file (_p) and their order in it (_at); and lines that are no records (_p, why)."""
    p = F.regexp_replace("path", "^file:/+", "file:/").alias("_p")
    if kind == ".jsonl":
        good, bad = readers.json_lines(spark, *paths)
        return good.select(p, *RECORD.names, F.monotonically_increasing_id().alias("_at")), bad.select(p, F.concat_ws(": ", "reason", F.substring("line", 1, 100)).alias("why"))
    return spark.read.schema(RECORD).parquet(*paths).select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("_p"), *RECORD.names, F.col("_metadata.row_index").alias("_at")), None


def _unreadable(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Parquet files whose footer can't be read or lacks a column, with the reason; looked at where the executors are."""

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for f in frames:
            why = []
            for p in f.path:
                try:
                    with readers.random_access(p) as body:
                        lacks = set(RECORD.names) - set(pq.read_schema(body).names)
                    why.append(f"no column {min(lacks)}" if lacks else None)
                except Exception as e:  # noqa: BLE001
                    why.append(str(e)[:200])
            yield pd.DataFrame({"path": f.path, "why": why})

    df = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 64))
    return {r.path: r.why for r in df.mapInPandas(look, "path string, why string").where("why is not null").collect()}  # of one batch


def sample(spark: SparkSession, o: Sample) -> str:
    index = sampling.latest(spark.read.parquet(o.index))
    with open(o.policy) as f:
        rules = readers.policy_yaml(spark, f.read())
    base = layout.task_offsets(index)
    policy = sampling.policies(index, rules)
    few = sampling.few(policy)
    clipped = sampling.clip(index, policy, context=o.context, least=o.least, broadcast=few)
    drawn = sampling.draws(clipped, epochs=o.epochs, seed=o.seed, broadcast=few)
    placed = sampling.shuffled(drawn, seed=o.seed).join(base.select("task", "base"), "task").withColumns({"inst_start": F.col("inst_start") + F.col("base"), "resp_start": F.col("resp_start") + F.col("base")})
    placed.drop("base").write.mode("overwrite").partitionBy("epoch").parquet(f"{o.out}/epochs")
    back = spark.read.parquet(f"{o.out}/epochs")
    meta = layout.metadata(back, epochs=o.epochs, context=o.context).first()
    exports.sidecar(f"{o.out}/metadata.json", max_seq_len=meta.max_seq_len, total_length=meta.total_length)
    return report.render(report.coverage_report(sampling.planned_coverage(clipped, epochs=o.epochs, seed=o.seed, broadcast=few)))


def main(args: list[str]) -> None:
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    stage, rest = args[0], args[1:]
    if stage == "clean":
        clean(spark, options(Clean, rest))
    elif stage == "tokenize":
        if (got := tokenized(spark, options(Tokenize, rest)))["failed"]:
            raise SystemExit(f"failed: {got['failed']}")
    elif stage == "sample":
        print(sample(spark, options(Sample, rest)))
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
