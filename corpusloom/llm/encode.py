"""Encoding of texts with a public byte-level BPE vocabulary, exactly as the public libraries do it.

Method: a text is cut into pieces by the vocabulary's pattern. Over a piece's bytes lies a segment tree of the ranks of
adjacent pairs; every node holds the lowest rank below it and, of equal ones, the leftmost. The root names the next
merge; the merged pair's neighbours get new ranks, each by a walk from a leaf to the root, until the root has none.
So a piece of n bytes takes n log n steps, however long it is. Pieces met before come from a cache of bounded size.

Strings that look like special tokens are ordinary text. Null and empty texts have the empty list. Repeated rows give
repeated results; extra columns are ignored; whole texts are encoded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.words import column, groups

#: Pieces that a worker remembers at most, and the longest of them.
CACHE, CACHED = 300_000, 64
NONE = 1 << 62


def vocabulary(path: str | None = None) -> tuple[bytes, str]:
    """The file of ranks (token in base 64, rank) and the pattern that cuts texts. Without a path: the installed public one."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


class Encoder:
    def __init__(self, ranks: bytes, pattern: str) -> None:
        import regex

        self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        self.cut = regex.compile(pattern).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def piece(self, p: bytes) -> tuple[int, ...]:
        """Ids of one piece. A whole piece that is a token is what its merges lead to."""
        rank = self.rank
        if (whole := rank.get(p)) is not None:
            return (whole,)
        n = len(p)
        end = list(range(1, n + 1))  # where the part that begins here ends
        before = list(range(-1, n - 1))  # where the part before begins
        size = 1
        while size < n - 1:
            size *= 2
        # A node is rank * 2**32 + place, so the least is the leftmost of the lowest.
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            r = rank.get(p[i : i + 2])
            if r is not None:
                tree[size + i] = r << 32 | i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1

        while (top := tree[1]) < NONE:
            i = top & 0xFFFFFFFF
            j = end[i]
            k = end[i] = end[j]  # the part at j joins that at i
            if k < n:
                before[k] = i
                r = rank.get(p[i : end[k]])
                put(i, NONE if r is None else r << 32 | i)
            else:
                put(i, NONE)
            if j < n - 1 or n - 1 == j and size + j < 2 * size:
                put(j, NONE)
            h = before[i]
            if h >= 0:
                r = rank.get(p[h:k])
                put(h, NONE if r is None else r << 32 | h)
        out, i = [], 0
        while i < n:
            out.append(rank[p[i : end[i]]])
            i = end[i]
        return tuple(out)

    def ids(self, text: str | None) -> list[int]:
        out: list[int] = []
        cache = self.cache
        for p in self.cut(text) if text else ():
            got = cache.get(p)
            if got is None:
                got = self.piece(p.encode())
                if len(p) <= CACHED:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[p] = got
            out += got
        return out


@lru_cache(2)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def encode(df: DataFrame, *, id_col: str, text: str, path: str | None = None) -> DataFrame:
    """doc_id, ids: the token ids of every row's text."""
    known = df.sparkSession.sparkContext.broadcast(vocabulary(path))  # one file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(*known.value)
        for b in batches:
            ids = b.column(0)
            for first, g in groups(column(b, "text"), 400_000):
                got = [e.ids(t) for t in g]
                n = np.fromiter(map(len, got), np.int64, len(got))
                flat = np.fromiter((x for r in got for x in r), np.int32, int(n.sum()))
                yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(first, len(g)), "ids": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))})

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(ids: DataFrame, *, path: str | None = None) -> DataFrame:
    """doc_id, text: what the ids stand for. The inverse of ``encode``, whose null texts come back empty."""
    known = ids.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: b for b, i in _encoder(*known.value).rank.items()}
        for b in batches:
            body = [b"".join(map(token.__getitem__, x or [])).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "text": pa.array(body, pa.string())})

    return ids.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def token_counts(df: DataFrame, *, id_col: str, text: str, also: str | None = None, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens of every row's text (0 for null and empty ones); with ``also`` the tokens of a second column count too, and
    alone as ``n_also``."""
    known = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(*known.value)
        for b in batches:
            n = [np.fromiter((len(e.ids(t)) for t in column(b, name)), np.int64, b.num_rows) for name in b.schema.names[1:]]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_tokens": pa.array(sum(n))} | ({"n_also": pa.array(n[1])} if also else {}))

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *([F.col(also).cast("string").alias("also")] if also else []))
    return src.mapInArrow(run, "doc_id long, n_tokens long" + (", n_also long" if also else ""))
