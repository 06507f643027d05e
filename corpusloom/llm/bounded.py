"""Tables of a fixed size gathered over all data: counts by hash bucket, and sets as bit tables.

The size is a parameter and doesn't follow the data, so the result may be collected
and broadcast. Every task adds into its own table and sends it in chunks; chunks are
summed in groups of at most ``FAN``, level by level, so no task gets more than
``FAN`` chunks however many tasks there are, and the driver gets at most four.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK, FAN = 1 << 15, 128
SCHEMA = "part bigint, chunk int, body binary"


def _pack(part: int, table: np.ndarray) -> pa.RecordBatch:
    used = [i for i in range(0, len(table), CHUNK) if table[i : i + CHUNK].any()]
    return pa.RecordBatch.from_pydict(
        {"part": pa.array([part] * len(used), pa.int64()), "chunk": pa.array([i // CHUNK for i in used], pa.int32()), "body": pa.array([zlib.compress(table[i : i + CHUNK].tobytes(), 1) for i in used], pa.binary())}
    )


def _sum(rows: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, np.int64)
    bodies = rows.column("body")
    for i in range(rows.num_rows):
        x = np.frombuffer(zlib.decompress(bodies[i].as_py()), np.int64)
        total[: len(x)] += x
    first = rows.slice(0, 1)
    return pa.table({"part": first.column("part"), "chunk": first.column("chunk"), "body": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def gather(df: DataFrame, buckets: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], size: int) -> np.ndarray:
    """How often each bucket 0..size-1 comes out of ``buckets`` over all rows. An empty df gives zeros."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.zeros(size, np.int64)
        for x in buckets(batches):
            np.add.at(table, x, 1)
        yield _pack(TaskContext.get().partitionId(), table)

    parts = df.mapInArrow(count, SCHEMA)
    most = max(1, df.rdd.getNumPartitions())
    while most > 4:
        parts = parts.selectExpr(f"part div {FAN} as part", "chunk", "body").groupBy("part", "chunk").applyInArrow(_sum, SCHEMA)
        most = -(-most // FAN)
    out = np.zeros(-(-size // CHUNK) * CHUNK, np.int64)
    for r in parts.selectExpr("chunk", "body").collect():
        x = np.frombuffer(zlib.decompress(r.body), np.int64)
        out[r.chunk * CHUNK : r.chunk * CHUNK + len(x)] += x
    return out[:size]
