"""Sinks: records, clustered tables, token arrays as .npy, metadata and manifests."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.layout import id_type


def json_lines(df: DataFrame, path: str) -> None:
    """One object a line; nulls are written."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def clustered(df: DataFrame, path: str, by: str = "task") -> None:
    """A folder for each task; tasks that aren't in ``df`` stay as they are (dynamic overwrite)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def flat_tokens(rows: DataFrame, path: str, *, vocabulary: int | None = None, tokens: str = "tokens", start: str = "start") -> None:
    """One .npy file of all tokens: ``rows`` have their ids and the place of the first in the whole stream.

    The file is laid out first, then every partition writes its rows at their places; ``path`` must be on a file
    system that all executors share. Rows don't pass the driver.
    """
    total = rows.agg(F.max(F.col(start) + F.size(tokens))).first()[0] or 0
    kind = id_type(vocabulary)
    np.lib.format.open_memmap(path, "w+", kind, (int(total),)).flush()

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = 0
        if total:
            out = np.load(path, mmap_mode="r+")
            for f in frames:
                for at, ids in zip(f[start], f[tokens]):
                    out[at : at + len(ids)] = ids
                    n += len(ids)
            out.flush()
        yield pd.DataFrame({"n": [n]})

    rows.select(start, tokens).mapInPandas(write, "n bigint").agg(F.sum("n")).collect()


def epoch_arrays(drawn: DataFrame, path: str) -> None:
    """For each epoch a folder with inst_start, inst_len, resp_start, resp_len as .npy (int64), in the order of ``pos``.

    The files are laid out first; then one pass over ``drawn`` writes all epochs, every partition at its rows' places.
    """
    names = ("inst_start", "inst_len", "resp_start", "resp_len")
    where = lambda epoch, name: os.path.join(path, f"epoch_{epoch}", f"{name}.npy")
    for r in drawn.groupBy("epoch").agg(F.count("*").alias("n")).collect():  # one row for each epoch
        os.makedirs(os.path.join(path, f"epoch_{r.epoch}"), exist_ok=True)
        for name in names:
            np.lib.format.open_memmap(where(r.epoch, name), "w+", "int64", (r.n,)).flush()

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for epoch, part in f.groupby("epoch"):
                for name in names:
                    out = np.load(where(epoch, name), mmap_mode="r+")
                    out[part.pos.to_numpy()] = part[name].to_numpy()
                    out.flush()
        yield pd.DataFrame({"n": [0]})

    drawn.select("epoch", "pos", *names).mapInPandas(write, "n bigint").agg(F.sum("n")).collect()


def sidecar(path: str, **values) -> None:
    """Metadata or tokenizer information as JSON, in place at once."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path + ".new", "w") as f:
        json.dump(values, f)
    os.replace(path + ".new", path)


def tokenizer_files(body: str, out: str, *, boq: str, eoq: str, eoa: str, conditions: dict[str, str], source: str = "tokenizer.json", model_type: str = "qwen3") -> None:
    """A given tokenizer's files, as those who train or download one leave them: tokenizer.json (indented); for byte-pair models config.json, which says no more
    than the kind; and tokenizer_info.json with the special tokens, the tokens of conditions, and the vocabulary's size. Nothing is trained."""
    t = json.loads(body)
    known = t["model"]["vocab"]
    size = len(known) + sum(x["content"] not in known for x in t.get("added_tokens", [])) if isinstance(known, dict) else len(known)
    os.makedirs(out, exist_ok=True)
    with open(os.path.join(out, "tokenizer.json"), "w") as f:
        json.dump(t, f, indent=2, ensure_ascii=False)
    if t["model"].get("type", "BPE") == "BPE":
        sidecar(os.path.join(out, "config.json"), model_type=model_type)
    sidecar(os.path.join(out, "tokenizer_info.json"), tokenizer_path=source, boq=boq, eoq=eoq, eoa=eoa, condition_mapping=conditions, vocab_size=size)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of any Hadoop file system; None if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    body = fs.open(p)
    try:
        return bytes(body.readAllBytes()).decode()
    finally:
        body.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and then moved there."""
    jvm = spark.sparkContext._jvm
    p, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".new")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(new, p):
        raise OSError(f"{path}: not written")


def remove(spark: SparkSession, path: str) -> None:
    """A folder with all in it; nothing if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"{path}: not removed")


def manifest(df: DataFrame, path: str) -> None:
    """The manifest of a run, beside the earlier ones: a folder for each run."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_no").parquet(path)
