"""Records as token ids: tags, the layout of a row, and the pieces before merging."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pattern that cuts text into pieces; Unicode classes need the flag in Java.
PIECES = r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Spec:
    """Ids that frame a row, and of each tag. ``path``: a tokenizer.json of the ``tokenizers`` library."""

    path: str
    boq: int
    eoq: int
    eoa: int
    tags: dict[str, int] = field(default_factory=dict)


@lru_cache(2)
def _tokenizer(body: str):
    """One for each worker process, with a few threads of its own: where a file is one row group, and so one task, the other cores would be idle."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", "4")
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(body)
    t.encode_special_tokens = True
    return t


def tag_ids(condition: Column, tags: dict[str, int]) -> Column:
    """Ids of the tags, in order; an unknown tag (and an empty condition) stops the query."""
    ids = F.create_map(*[F.lit(x) for kv in tags.items() for x in kv])
    return F.transform(F.split(condition, ","), lambda t: F.coalesce(ids[t], F.raise_error(F.concat(F.lit("unknown tag: "), t)).cast("int")))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Composed form; null for null."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x), na_action="ignore")


def pieces(c: Column) -> Column:
    """The pieces of a (composed) text, with nothing left out."""
    return F.regexp_extract_all(c, F.lit("(?U)" + PIECES), F.lit(0))


def piece_counts(df: DataFrame, text: str) -> DataFrame:
    """piece, n: how often each piece occurs. Partial sums come before the shuffle."""
    return df.select(F.explode(pieces(nfc(F.col(text)))).alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))


def _ids(t, texts: pa.Array) -> pa.Array:
    """Lists of ids; each text of a batch is encoded once, however often it comes, and without offsets."""
    once = texts.dictionary_encode()
    got = [x.ids for x in t.encode_batch_fast([x or "" for x in once.dictionary.to_pylist()], add_special_tokens=False)]
    place = once.indices.to_numpy(zero_copy_only=False)
    place = np.where(np.isnan(place), -1, place).astype(np.int64) if once.indices.null_count else place
    rows = [got[i] if i >= 0 else [] for i in place.tolist()]
    n = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(n.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))


def detokenized(rows: DataFrame, spec: Spec) -> DataFrame:
    """The columns of ``tokenized`` rows but for the tokens and their lengths, with instruction and response as the ids say: what frames them is taken off."""
    body = rows.sparkSession.sparkContext.broadcast(open(spec.path).read())  # one tokenizer file
    extra = [f for f in rows.schema if f.name not in ("inst_tokens", "resp_tokens", "inst_len", "resp_len")]
    tags = 1 + F.size(F.split("condition", ","))
    src = rows.select(*[f.name for f in extra], F.slice("inst_tokens", tags + 1, F.size("inst_tokens") - tags - 1).alias("_i"), F.slice("resp_tokens", F.lit(1), F.size("resp_tokens") - 1).alias("_r"))
    schema = src.drop("_i", "_r").schema.add("instruction", T.StringType()).add("response", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(body.value)
        for b in batches:
            texts = [pa.array(t.decode_batch(b.column(len(extra) + i).to_pylist(), skip_special_tokens=False), pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(extra))), *texts], [*(f.name for f in extra), "instruction", "response"])

    return src.mapInArrow(run, schema)


def tokenized(records: DataFrame, spec: Spec) -> DataFrame:
    """Rows with inst_tokens ([boq, tags, instruction, eoq]) and resp_tokens ([response, eoa]), and their lengths.

    Strings that look like special tokens are text. ``records`` should have passed the quarantine; null texts are empty.
    """
    body = records.sparkSession.sparkContext.broadcast(open(spec.path).read())  # one tokenizer file
    extra = [f for f in records.schema if f.name not in ("instruction", "response")]
    src = records.select(*[f.name for f in extra], "instruction", "response")
    schema = src.drop("instruction", "response").schema.add("_i", T.ArrayType(T.IntegerType())).add("_r", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(body.value)
        for b in batches:
            cols = [b.column(i) for i in range(len(extra))]
            for name in ("instruction", "response"):
                cols.append(_ids(t, b.column(b.schema.get_field_index(name))))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in extra] + ["_i", "_r"])

    rows = src.mapInArrow(run, schema)
    inst = F.concat(F.array(F.lit(spec.boq)), tag_ids(F.col("condition"), spec.tags), "_i", F.array(F.lit(spec.eoq)))
    return rows.select(*[f.name for f in extra], inst.alias("inst_tokens"), F.concat("_r", F.array(F.lit(spec.eoa))).alias("resp_tokens")).withColumns({"inst_len": F.size("inst_tokens").cast("bigint"), "resp_len": F.size("resp_tokens").cast("bigint")})
