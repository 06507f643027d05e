"""Drawing files so that every source contributes its target share of the tokens.

Method: hash-threshold histograms. A draw is a row in a pass; a file may be passed over as often as its rule's ``repeat``
says. Every draw has a hash, so a set of draws is a threshold for each source (the pass and the hash up to which draws
are in). Rows and tokens are summed once by file, pass and the hash's first ``BITS`` bits. A file's ``max_per_file`` rows a
pass and a source's budget of tokens are both thresholds on running sums of that histogram; only the bucket in which a
threshold lies is refined (by the next bits, and what is left of it by the hashes themselves). Draws are then filtered;
nothing else is sorted, and larger budgets contain smaller ones.

The budgets are shares of one total: the largest at which every source reaches its target, and at most the tokens of all rows
(``total="all"``: always the tokens of all rows, so that sources which lack rows give all they may and fall short, and the others
get more than their share). Sources without any rows are left out of that bound. Of the draw on the boundary of a budget it
is taken whether the source comes closer with or without it. Rules match by prefix, the lowest ``ord`` first; a null cap is none, a
null repeat is 1 (as without a rule).

The latest row of (task, row_id) holds. Rows with null length, task or row id, and rows of no source in the targets, are
not drawn. Targets given twice count once (the greatest share). Empty tables give no draws, and a report of zero tokens.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.durable import SMALL, durable, durable_with
from corpusloom.operators import sampling

BITS = 12
SEED = 4


def _cell(level: int) -> Column:
    """Bits of the hash (of 60 in all)."""
    return F.shiftright(F.col("h"), 60 - BITS * (level + 1)).bitwiseAND((1 << BITS) - 1)


def _boundary(hist: DataFrame, keys: list[str], order: list[str], size: str) -> DataFrame:
    """keys, order, used (sum before), of the first bucket in which the running sum of ``size`` passes ``budget``."""
    run = F.sum(size).over(Window.partitionBy(*keys).orderBy(*order))
    over = hist.withColumn("used", run - F.col(size)).where(F.col("used") + F.col(size) > F.col("budget"))
    return over.groupBy(*keys).agg(F.min_by(F.struct(*order, "used", "budget"), F.struct(*order)).alias("b")).select(*keys, "b.*")


def _last(rows: DataFrame, keys: list[str], size: str, *, closest: bool) -> DataFrame:
    """keys, last: (hash, task, row_id) of the last draw in, or null if none of the bucket is. ``rows``: of the boundary buckets, with what was
    ``used`` before them and ``budget``. A second histogram leaves one part in 2**BITS of a bucket to be put in order."""
    hist = rows.groupBy(*keys, _cell(1).alias("c2"), "used", "budget").agg(F.sum(size).alias("here"))
    run = F.sum("here").over(Window.partitionBy(*keys).orderBy("c2"))
    edge = hist.withColumn("before", F.col("used") + run - F.col("here")).where("before + here > budget").groupBy(*keys).agg(F.min_by(F.struct("c2", "before"), "c2").alias("e")).select(*keys, "e.*")
    place = F.struct("h", "task", "row_id")
    part = rows.join(edge, keys).where(_cell(1) <= F.col("c2")).withColumn("at", _cell(1) == F.col("c2"))
    w = Window.partitionBy(*keys).orderBy("h", "task", "row_id")
    fine = part.where("at").withColumn("upto", F.col("before") + F.sum(size).over(w))
    ok = F.col("upto") <= F.col("budget")
    if closest:
        ok = ok | ((F.col("upto") - F.col(size) <= F.col("budget")) & (F.col("upto") - F.col("budget") < F.col("budget") - (F.col("upto") - F.col(size))))
    # Up to the edge's bucket everything is in; within it, what ``ok`` says.
    below = part.where("not at").groupBy(*keys).agg(F.max(place).alias("last"))
    within = fine.where(ok).groupBy(*keys).agg(F.max(place).alias("last"))
    best = below.unionByName(within).groupBy(*keys).agg(F.max("last").alias("last"))
    return edge.select(*keys).join(best, keys, "left")


def _drawable(index: DataFrame, targets: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame, int, Callable[[DataFrame], DataFrame]]:
    """Every draw there could be; the targets; tokens of all rows; and how to mark a table that has a row for each file and pass, or
    fewer: for broadcast, if the count of these says that it is small, else not at all."""
    latest = index.where("task is not null and row_id is not null").groupBy("task", "row_id").agg(F.max(F.struct("indexed_at", "resp_len")).alias("r"))
    rows = latest.select("task", "row_id", F.col("r.resp_len").alias("resp_len"), F.split("task", "__", 2)[0].alias("source")).where("resp_len is not null and resp_len >= 0")
    rows, seen = durable_with(rows, total=F.sum("resp_len"))
    share = targets.where("source is not null").groupBy("source").agg(F.coalesce(F.max("target_share"), F.lit(0.0)).alias("target_share"))
    policy = sampling.policies(rows, rules).where("repeat > 0").select("task", F.when(F.col("max_per_file") < 0, 0).otherwise(F.col("max_per_file")).alias("cap"), "repeat")
    policy, size = durable_with(policy, passes=F.sum("repeat"))
    mark = F.broadcast if (size["passes"] or 0) <= SMALL else (lambda x: x)
    d = rows.join(share.select("source"), "source").join(mark(policy), "task")
    d = d.withColumn("pass", F.explode(F.expr("sequence(0, repeat - 1)")))
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(SEED)), "task", F.col("row_id").cast("string"), F.col("pass").cast("string"))), 1, 15)
    return d.select("source", "task", "row_id", "pass", "resp_len", "cap", F.conv(digits, 16, 10).cast("long").alias("h")), share, int(seen["total"] or 0), mark


def draws(index: DataFrame, targets: DataFrame, rules: DataFrame, *, total: str = "even") -> DataFrame:
    """source, task, row_id, pass (from 0), resp_len: a row for every draw."""
    if total not in ("even", "all"):
        raise ValueError(total)
    d, share, every, mark = _drawable(index, targets, rules)
    one = d.withColumn("one", F.lit(1).cast("long")).withColumn("c1", _cell(0))
    hist = durable(one.groupBy("source", "task", "cap", "pass", "c1").agg(F.sum("one").alias("n"), F.sum("resp_len").alias("t")))
    # Rows of each file and pass.
    keys = ["task", "pass"]
    capped = mark(_boundary(hist.where("cap is not null").withColumn("budget", F.col("cap")), keys, ["c1"], "n"))
    edge = durable(one.join(capped, [*keys, "c1"]))
    limit = mark(durable(_last(edge, keys, "one", closest=False).join(capped.select(*keys, "c1"), keys)))
    kept = edge.join(limit.select(*keys, "last"), keys).where(F.struct("h", "task", "row_id") <= F.col("last"))
    by = hist.join(capped.select(*keys, F.col("c1").alias("cut")), keys, "left").where("cut is null or c1 < cut").select("source", "pass", "c1", "t")
    by = by.unionByName(kept.select("source", "pass", "c1", F.col("resp_len").alias("t")))
    by = durable(by.groupBy("source", "pass", "c1").agg(F.sum("t").alias("t")))
    # Tokens of each source: a row each, so the least of them may come to the driver.
    supply = by.groupBy("source").agg(F.sum("t").alias("s")).join(share, "source").where("s > 0 and target_share > 0")
    reach = supply.agg(F.min(F.col("s") / F.col("target_share"))).first()[0]
    whole = float(every) if total == "all" or reach is None else min(float(every), reach)
    budget = by.join(share.select("source", (F.col("target_share") * whole).alias("budget")), "source")
    bound = mark(_boundary(budget, ["source"], ["pass", "c1"], "t"))
    allowed = one.join(limit.select(*keys, F.col("c1").alias("cut"), F.col("last").alias("most"), F.lit(True).alias("_l")), keys, "left")
    place = F.struct("h", "task", "row_id")
    allowed = allowed.where(F.col("_l").isNull() | (F.col("c1") < F.col("cut")) | ((F.col("c1") == F.col("cut")) & F.coalesce(place <= F.col("most"), F.lit(False)))).drop("cut", "most", "_l")
    rim = durable(allowed.join(bound, ["source", "pass", "c1"]))
    last = _last(rim, ["source"], "resp_len", closest=True)
    ends = mark(last.join(bound, "source").select("source", F.col("pass").alias("p"), F.col("c1").alias("cut"), "last", F.lit(True).alias("_e")))
    first = F.struct("pass", "c1")
    edge_of = F.struct(F.col("p").alias("pass"), F.col("cut").alias("c1"))
    got = allowed.join(ends, "source", "left")
    got = got.where(F.col("_e").isNull() | (first < edge_of) | ((first == edge_of) & F.coalesce(place <= F.col("last"), F.lit(False))))
    return got.select("source", "task", "row_id", "pass", "resp_len")


def shares(drawn: DataFrame, index: DataFrame, targets: DataFrame) -> DataFrame:
    """A row for each target: source, target_share, tokens, draws, rows (different ones), actual_share (of what was drawn; null if nothing
    was), all_share (of the tokens of all rows)."""
    rows = index.where("task is not null and row_id is not null").groupBy("task", "row_id").agg(F.max(F.struct("indexed_at", "resp_len")).alias("r"))
    every = rows.where("r.resp_len >= 0").agg(F.coalesce(F.sum("r.resp_len"), F.lit(0)).alias("every"))
    by = drawn.groupBy("source", "task", "row_id").agg(F.sum("resp_len").alias("t"), F.count("*").alias("n")).groupBy("source").agg(F.sum("t").alias("tokens"), F.sum("n").alias("draws"), F.count("*").alias("rows"))
    share = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"))
    out = durable(share.join(by, "source", "left").na.fill(0, ["tokens", "draws", "rows"]))  # a row for each source
    both = out.agg(F.sum("tokens").alias("drawn")).crossJoin(F.broadcast(every))  # one row
    part = lambda x: F.when(F.col(x) > 0, F.col("tokens") / F.col(x))
    return out.crossJoin(F.broadcast(both)).select("source", "target_share", "tokens", "draws", "rows", part("drawn").alias("actual_share"), part("every").alias("all_share"))
