"""Readers of raw sources. Every one has a declared schema; nothing is inferred."""

from __future__ import annotations

import io
import json
import re
import tarfile
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as X
from corpusloom.schema import RECORD


def parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Tables, splits or configurations, united by name; missing columns are null."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def json_array(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Files that hold one JSON array (or object) each, with the file's base name as ``file``."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path).withColumn("file", F.col("_metadata.file_name"))


def json_lines(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """Records of JSONL files, strictly: lines that aren't JSON, or whose three fields aren't strings, come in the second DataFrame with the line and the reason."""
    raw = spark.read.text(list(paths)).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path")).where(X.strip(F.col("line")) != "")
    v = F.try_parse_json("line")
    of = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    kind = lambda k: F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant"))
    bad = F.when(v.isNull(), "not_json")
    for k in RECORD.names:
        bad = bad.when(kind(k).isNull(), f"no_{k}").when(kind(k) != "STRING", f"{k}_not_text")
    all_ = raw.select("path", "line", bad.alias("reason"), *[of(k).alias(k) for k in RECORD.names])
    return all_.where("reason is null").select("path", *RECORD.names), all_.where("reason is not null").select("path", "line", "reason")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Canonical records of a .parquet or .jsonl file or folder, by its suffix."""
    if path.rstrip("/").endswith(".jsonl"):
        return json_lines(spark, path)[0].select(*RECORD.names)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select(*RECORD.names)
    raise ValueError(f"{path}: neither .parquet nor .jsonl")


def csv_by_place(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """CSV with a header that is skipped; columns by place, as text."""
    return spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).option("header", True).option("enforceSchema", True).csv(path)


def alternating_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files of a question and an answer in turn: subset (folder), file, pair, instruction, response; both stripped.

    A file with an odd number of lines gives no rows (see ``odd_files``). Files are read in blocks and put together by the numbers of their lines.
    """
    t, files = _lines(spark, path)
    side = lambda i: F.max(F.when(F.col("n") % 2 == i, F.col("value")))
    pairs = t.withColumn("pair", F.expr("cast(n div 2 as int)")).groupBy("p", "pair").agg(side(0).alias("q"), side(1).alias("a"))
    even = files.where("n % 2 = 0").select("p", "subset", "file")
    return pairs.join(even, "p").select("subset", "file", "pair", X.strip(F.col("q")).alias("instruction"), X.strip(F.col("a")).alias("response"))


def odd_files(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path)[1].where("n % 2 = 1").select("subset", "file", "n")


def _lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lines with their number (n, from 0) in the file (p), and files with how many they have. Only the lines of a block are put in order together."""
    m = F.col("_metadata")
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path).select("value", m.file_path.alias("p"), m.file_block_start.alias("b"), F.monotonically_increasing_id().alias("m"))
    size = raw.groupBy("p", "b").agg(F.count("*").alias("k"))
    before = size.withColumn("before", F.sum("k").over(Window.partitionBy("p").orderBy("b")) - F.col("k"))
    within = F.row_number().over(Window.partitionBy("p", "b").orderBy("m")) - 1
    lines = raw.withColumn("w", within).join(before.select("p", "b", "before"), ["p", "b"]).select("p", (F.col("before") + F.col("w")).alias("n"), "value")
    part = lambda i: F.element_at(F.split("p", "/"), i)
    return lines, size.groupBy("p").agg(F.sum("k").alias("n")).select("p", part(-2).alias("subset"), part(-1).alias("file"), "n")


def tar_members(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """Regular files with a suffix in .tar.gz archives: path, content. One archive is one task's work, read as a stream from where it lies, member by member;
    no archive is held in memory."""

    def untar(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p in f.path:
                with _open(p) as body, tarfile.open(fileobj=body, mode="r|*") as tar:
                    names, data, size = [], [], 0
                    for m in tar:
                        if m.isfile() and m.name.endswith(suffix) and (x := tar.extractfile(m)) is not None:
                            names.append(m.name)
                            data.append(x.read())
                            size += m.size
                            if size > 16_000_000:
                                yield pd.DataFrame({"path": names, "content": data})
                                names, data, size = [], [], 0
                    yield pd.DataFrame({"path": names, "content": data})

    return spark.read.format("binaryFile").load(path).select("path").mapInPandas(untar, "path string, content binary")


def _open(uri: str):
    """A stream of a file, in whatever file system the library knows by its URI."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return system.open_input_stream(path, compression=None)


def random_access(uri: str):
    """A file that can be read from any place on, by its URI."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return system.open_input_file(path)


def listing(spark: SparkSession, *roots: str) -> DataFrame:
    """All .parquet and .jsonl files below the roots: task (relative path with ``__``), path, source_size, source_mtime (seconds).

    The same relative path below two roots is an error: both would be one task.
    """
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    rows = []
    for root in roots:
        p = fs.Path(root)
        found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        base = found.makeQualified(p).toString().rstrip("/") + "/"
        it = found.listFiles(p, True)
        while it.hasNext():
            f = it.next()
            name = f.getPath().toString()
            if name.endswith((".parquet", ".jsonl")):
                rows.append((name.removeprefix(base).replace("/", "__").replace("\\", "__"), name, f.getLen(), f.getModificationTime() // 1000))
    if twice := sorted(x for x, n in Counter(r[0] for r in rows).items() if n > 1):
        raise ValueError(f"the same task below two roots: {twice[:5]}")
    return spark.createDataFrame(rows, "task string, path string, source_size bigint, source_mtime bigint")


def policy_yaml(spark: SparkSession, text: str) -> DataFrame:
    """Rules of a policy file (a list of ``prefix`` and options), with their order. Unknown options are an error."""
    try:
        import yaml

        items = yaml.safe_load(text) or []
    except ImportError:
        items = _simple_yaml(text)
    rows = []
    for i, x in enumerate(items):
        if extra := set(x) - {"prefix", "max_per_file", "long_context", "repeat"}:
            raise ValueError(f"rule {i}: unknown {sorted(extra)}")
        if x.get("long_context", "truncate") not in ("truncate", "drop"):
            raise ValueError(f"rule {i}: long_context {x['long_context']!r}")
        rows.append((i, x["prefix"], x.get("max_per_file"), x.get("long_context", "truncate"), x.get("repeat", 1)))
    return spark.createDataFrame(rows, "ord int, prefix string, max_per_file bigint, long_context string, repeat int")


def _simple_yaml(text: str) -> list[dict]:
    """A list of flat mappings, for where no YAML library is installed."""
    out: list[dict] = []
    for line in text.splitlines():
        line = line.split("#", 1)[0].rstrip()
        if not line.strip():
            continue
        if line.lstrip().startswith("- "):
            out.append({})
            line = line.replace("- ", "", 1)
        k, v = (x.strip() for x in line.split(":", 1))
        v = v.strip("\"'")
        out[-1][k] = int(v.replace("_", "")) if v.replace("_", "").lstrip("-").isdigit() else v
    return out


def tokenizer_info(path: str) -> dict:
    with open(path) as f:
        return json.load(f)


def sized(df: DataFrame) -> DataFrame:
    """Adds what file names like ``12__name.jsonl`` say: rsize (12) and name; ``packed__name.jsonl`` has a name only; null for other names."""
    at = lambda i: F.nullif(F.regexp_extract(F.col("_metadata.file_name"), r"^(?:(\d+)|packed)__(.*)$", i), F.lit(""))
    return df.select("*", at(1).cast("bigint").alias("rsize"), at(2).alias("name"))


def npy_column(spark: SparkSession, path: str) -> DataFrame:
    """One-dimensional .npy files as rows: file, place, value (bigint)."""
    import numpy as np

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p, body in zip(f.path, f.content):
                x = np.load(io.BytesIO(body))
                for at in range(0, len(x), 1_000_000):
                    part = x[at : at + 1_000_000].astype("int64")
                    yield pd.DataFrame({"file": p, "place": np.arange(at, at + len(part)), "value": part})

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npy").load(path).select("path", "content").mapInPandas(read, "file string, place bigint, value bigint")


def with_row_ids(df: DataFrame, *order: str) -> DataFrame:
    """row_id from 0 in each task, in the order of the columns given."""
    return df.withColumn("row_id", (F.row_number().over(Window.partitionBy("task").orderBy(*order)) - 1).cast("bigint"))


def with_row_ids_in_blocks(df: DataFrame, at: str) -> DataFrame:
    """As with_row_ids, by one column of whole numbers: numbered within blocks of 4,096 of them, after the rows of the blocks before, so
    that no task's rows are sorted in one place."""
    r = df.withColumn("_b", F.expr(f"{at} div 4096"))
    blocks = r.groupBy("task", "_b").agg(F.count("*").alias("_n")).withColumn("_before", F.sum("_n").over(Window.partitionBy("task").orderBy("_b")) - F.col("_n")).drop("_n")
    within = F.row_number().over(Window.partitionBy("task", "_b").orderBy(at)) - 1
    return r.withColumn("_w", within).join(blocks, ["task", "_b"]).withColumn("row_id", (F.col("_before") + F.col("_w")).cast("bigint")).drop("_b", "_w", "_before")
