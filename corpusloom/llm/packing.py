"""Filling containers of fixed capacity with texts, with little unused space and no text split that fits.

Method: vector bin packing under limits on tokens, segments and loss-bearing tokens at once, by the dot-product
heuristic: an open container takes, of the texts that fit, the one whose demands have the greatest weighted dot product
with what is left; a dimension weighs as much as all texts ask of it on average. When none fits the container is closed.

Texts longer than a container are cut into parts of one container each and a rest, which is packed like a text. All
other texts go, by a hash of the id, to shards of about ``SHARD`` containers' worth of tokens, packed independently:
the unused space of a shard's last container is one part in ``SHARD`` of it. No shard depends on the size of a source.

Texts without tokens (null, empty) need no place: their container is null. Repeated rows are repeated texts and each
gets a place. An empty table has no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD = 400


def pack(demand: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Container of each item (from 0) and its place in the order of filling. No item may ask more than the capacity."""
    d = demand / capacity
    n = len(d)
    weight = d.mean(0) if n else np.ones(len(capacity))
    box, turn = np.full(n, -1), np.zeros(n, np.int64)
    # Items of equal demands are alike: one row for each kind, with how many are left.
    kinds, of = np.unique(demand, axis=0, return_inverse=True)
    of = of.ravel()
    stock = np.bincount(of, minlength=len(kinds))
    queue = np.argsort(of, kind="stable")
    head = np.cumsum(stock) - stock
    share = kinds / capacity * weight
    live = np.flatnonzero(stock)
    k = placed = 0
    left = capacity.astype(np.float64).copy()
    while placed < n:
        fits = live[(kinds[live] <= left).all(1)]
        if not len(fits):
            k += 1
            left = capacity.astype(np.float64).copy()
            continue
        best = fits[np.argmax(share[fits] @ (left / capacity))]
        i = queue[head[best]]
        head[best] += 1
        stock[best] -= 1
        box[i], turn[i] = k, placed
        placed += 1
        left -= kinds[best]
        if not stock[best]:
            live = live[live != best]
    return box, turn


def containers(sizes: DataFrame, *, id_col: str = "doc_id", tokens: str = "n_tokens", loss: str | None = None, capacity: int = 4097, segments: int = 256, loss_capacity: int | None = None) -> DataFrame:
    """doc_id, part, n_tokens, loss (loss-bearing tokens), container, segment (from 0 in the container), start (its first token there).

    ``loss``: column of loss-bearing tokens; without one every token but a text's first bears loss.
    """
    from corpusloom.llm.durable import durable

    limit = loss_capacity or capacity
    src = sizes.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(tokens).cast("long"), F.lit(0)).alias("n"), (F.col(loss).cast("long") if loss else F.greatest(F.col(tokens).cast("long") - 1, F.lit(0))).alias("loss"))
    src = durable(src)  # counting tokens is the dear part, and is needed twice
    total = src.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-int(total) // (SHARD * capacity)))
    parts = src.where("n > 0").select("doc_id", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1)).alias("part"), "n", "loss")
    parts = parts.select("doc_id", "part", F.least(F.lit(capacity), F.col("n") - F.col("part") * capacity).alias("n_tokens"), "n", "loss")
    # A part bears its share of the text's loss; no part more than a container may.
    parts = parts.withColumn("loss", F.least(F.lit(limit), F.ceil(F.coalesce("loss", F.lit(0)) * F.col("n_tokens") / F.col("n"))).cast("long"))
    full = parts.where(F.col("n_tokens") == capacity).select("doc_id", "part", "n_tokens", "loss", F.concat(F.lit("t"), "doc_id", F.lit("-"), "part", F.lit("-"), F.monotonically_increasing_id()).alias("container"), F.lit(0).alias("segment"), F.lit(0).cast("long").alias("start"))
    rest = parts.where(F.col("n_tokens") < capacity).withColumn("shard", F.pmod(F.xxhash64("doc_id", "part", F.lit(11)), F.lit(shards)))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "part"], kind="stable").reset_index(drop=True)
        box, turn = pack(np.stack([pdf.n_tokens.to_numpy(), np.ones(len(pdf), np.int64), pdf.loss.to_numpy()], 1), np.array([capacity, segments, limit]))
        pdf["box"], pdf["turn"] = box, turn
        pdf = pdf.sort_values(["box", "turn"], kind="stable")
        by = pdf.groupby("box", sort=False)
        pdf["segment"] = by.cumcount().astype("int32")
        pdf["start"] = by.n_tokens.cumsum() - pdf.n_tokens
        pdf["container"] = "s" + pdf.shard.astype(str) + "-" + pdf.box.astype(str)
        return pdf[["doc_id", "part", "n_tokens", "loss", "container", "segment", "start"]]

    schema = "doc_id long, part int, n_tokens long, loss long, container string, segment int, start long"
    packed = rest.select("doc_id", "part", "n_tokens", "loss", "shard").repartition(max(1, min(shards, 100_000)), "shard").groupBy("shard").applyInPandas(fill, schema)
    nothing = src.where("n <= 0").select("doc_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("loss"), F.lit(None).cast("string").alias("container"), F.lit(0).alias("segment"), F.lit(0).cast("long").alias("start"))
    return packed.unionByName(full).unionByName(nothing)


def fill_report(placed: DataFrame, capacity: int = 4097, segments: int = 256, loss_capacity: int | None = None) -> DataFrame:
    """One row: parts, containers, tokens, unused tokens, the shares of all containers' tokens, segments and loss-bearing tokens that are used (null without
    containers), and how many containers each of the three limits has filled (98 % or more)."""
    loss = loss_capacity or capacity
    by = placed.where("container is not null").groupBy("container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"), F.sum("loss").alias("l"))
    n, full = F.count("*"), lambda x, most: F.coalesce(F.sum((F.col(x) >= 0.98 * most).cast("long")), F.lit(0))
    return by.agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("parts"), n.alias("containers"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"), F.coalesce(F.sum(F.lit(capacity) - F.col("t")), F.lit(0)).alias("unused"),
        (F.sum("t") / (n * capacity)).alias("used_share"), (F.sum("k") / (n * segments)).alias("segment_share"), (F.sum("l") / (n * loss)).alias("loss_share"), full("t", capacity).alias("full_tokens"), full("k", segments).alias("full_segments"), full("l", loss).alias("full_loss"),
    )


def checks(placed: DataFrame, capacity: int = 4097) -> DataFrame:
    """One row: texts, and how many containers hold more than they may, texts are in parts though they fit, and parts don't begin where the one before ends."""
    texts = placed.groupBy("doc_id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("t"))
    a = texts.agg(F.count("*").alias("texts"), F.coalesce(F.sum(((F.col("parts") > 1) & (F.col("t") <= capacity)).cast("long")), F.lit(0)).alias("needless_parts"))
    b = placed.where("container is not null").withColumn("at", F.coalesce(F.lag(F.col("start") + F.col("n_tokens")).over(Window.partitionBy("container").orderBy("segment")), F.lit(0)))
    c = b.groupBy("container").agg(F.sum("n_tokens").alias("t"), F.sum((F.col("start") != F.col("at")).cast("long")).alias("w"))
    d = c.agg(F.coalesce(F.sum((F.col("t") > capacity).cast("long")), F.lit(0)).alias("overfull"), F.coalesce(F.sum("w"), F.lit(0)).alias("wrong_starts"))
    return a.crossJoin(F.broadcast(d)).select("texts", "overfull", "needless_parts", "wrong_starts")  # one row each
