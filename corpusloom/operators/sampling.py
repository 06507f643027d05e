"""Policies by prefix, clipping, and the sampler of several epochs without replacement, in closed form.

A task of n rows gives R = min(cap, n) * repeat draws an epoch. Draw k (from 0) is slot k mod n of pass k div n and
belongs to epoch k div R; a pass is all rows in the order of md5(seed|task|pass|row_id). So nothing is carried over from
epoch to epoch, every epoch can be made alone, and a row is drawn floor or ceil of E * R / n times.

Orders are numbered without sorting a whole task in one place: rows are numbered within buckets of the hash's first
digits, and the buckets' sizes are added up.

Policies and plans have one row for each file. Where a count says that these are few (``few``) they are broadcast, so that the index is
joined where it lies, however much of it one file has; else Spark chooses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTEXT, LEAST_RESPONSE = 4097, 2
#: Files whose policies are broadcast.
FILES = 200_000


def few(policy: DataFrame, most: int = FILES) -> bool:
    """Has the policy so few rows (one for each file) that it, and a plan made from it, may be broadcast?"""
    return policy.limit(most + 1).count() <= most


def numbered(df: DataFrame, keys: list[str], by: str, ties: list[str], to: str, *, digits: int = 3) -> DataFrame:
    """``to``: the place (from 0) of each row in its group in the order of the hex string ``by``, then ``ties``. A group's rows are
    put in order in 16 ** ``digits`` parts."""
    df = df.withColumn("_b", F.substring(by, 1, digits))
    sizes = df.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_b")) - F.col("_n")).drop("_n")
    place = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(by, *ties)) - 1
    return df.withColumn("_k", place).join(before, [*keys, "_b"]).withColumn(to, (F.col("_before") + F.col("_k")).cast("bigint")).drop("_b", "_before", "_k")


def policies(tasks: DataFrame, rules: DataFrame) -> DataFrame:
    """Of each task: the first rule (lowest ord) whose prefix it begins with, else the default; ``hits``: how many match.

    task, max_per_file (null: no cap), long_context (truncate unless said), repeat (1 unless said), hits. Null prefixes match nothing.
    """
    names = tasks.select("task").where("task is not null").distinct()
    r = rules.where("prefix is not null").select("ord", "prefix", "max_per_file", "long_context", "repeat")
    j = names.join(r, F.expr("startswith(task, prefix)"), "left")  # tasks and rules are few
    best = j.groupBy("task").agg(F.min_by(F.struct("max_per_file", "long_context", "repeat"), "ord").alias("p"), F.count("ord").alias("hits"))
    return best.select("task", "p.max_per_file", F.coalesce("p.long_context", F.lit("truncate")).alias("long_context"), F.coalesce("p.repeat", F.lit(1)).alias("repeat"), "hits")


def latest(index: DataFrame) -> DataFrame:
    """Of each (task, row_id) the row that was indexed last."""
    rest = [x for x in ("inst_start", "inst_len", "resp_start", "resp_len") if x in index.columns]
    return index.groupBy("task", "row_id").agg(F.max_by(F.struct(*rest), F.struct("indexed_at", "resp_len", "inst_start")).alias("r")).select("task", "row_id", "r.*")


def clip(index: DataFrame, policy: DataFrame, *, context: int = CONTEXT, least: int = LEAST_RESPONSE, broadcast: bool = False) -> DataFrame:
    """Rows that fit; responses cut to what the instruction leaves where the policy truncates.

    The least length is tested before the cut, so a kept response may end shorter. Null lengths don't fit.
    """
    allowed = F.lit(context) - F.least("inst_len", F.lit(context))
    cut = F.col("long_context") == "truncate"
    ok = (F.col("resp_len") >= least) & F.when(cut, allowed >= 1).otherwise(F.col("resp_len") <= allowed)
    p = policy.select("task", "max_per_file", "long_context", "repeat")
    j = index.join(F.broadcast(p) if broadcast else p, "task").where(ok)
    return j.withColumn("resp_len", F.when(cut, F.least("resp_len", allowed)).otherwise(F.col("resp_len")).cast("bigint"))


def _planned(clipped: DataFrame, epochs: int, broadcast: bool) -> DataFrame:
    """Rows with n (rows of the file), R (draws an epoch) and D (in all); files without draws are left out."""
    n = clipped.groupBy("task").agg(F.count("*").alias("n"), F.first("max_per_file").alias("cap"), F.first("repeat").alias("rep"))
    per = F.least(F.coalesce("cap", F.col("n")), F.col("n")) * F.col("rep")
    plan = n.withColumn("R", per.cast("bigint")).withColumn("D", F.col("R") * epochs).where("D > 0").select("task", "n", "R", "D")
    return clipped.join(F.broadcast(plan) if broadcast else plan, "task")


def _order(seed: int, number: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), "task", F.col(number).cast("string"), F.col("row_id").cast("string")))


def draws(clipped: DataFrame, *, epochs: int, seed: int = 0, broadcast: bool = False) -> DataFrame:
    """Every draw: task, row_id, draw (k), epoch, and the index columns. ``clipped``: as from ``clip``."""
    rows = _planned(clipped, epochs, broadcast)
    passes = rows.withColumn("pass", F.explode(F.expr("sequence(0L, cast(ceil(D / n) as bigint) - 1)")))
    passes = passes.withColumn("_h", _order(seed, "pass"))
    slots = numbered(passes, ["task", "pass"], "_h", ["row_id"], "slot")
    k = slots.withColumn("draw", F.col("pass") * F.col("n") + F.col("slot")).where("draw < D")
    out = [x for x in ("inst_start", "inst_len", "resp_start", "resp_len") if x in clipped.columns]
    return k.select("task", "row_id", "draw", F.expr("draw div R").cast("int").alias("epoch"), *out)


def shuffled(drawn: DataFrame, *, seed: int = 0) -> DataFrame:
    """``pos``: the place of each draw in its epoch, in an order by hash."""
    h = drawn.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), "task", F.col("draw").cast("string"))))
    return numbered(h, ["epoch"], "_h", ["task", "draw"], "pos", digits=5).drop("_h")


def coverage(clipped: DataFrame, drawn: DataFrame) -> DataFrame:
    """How often each row is drawn, with rows that never are."""
    n = drawn.groupBy("task", "row_id").agg(F.count("*").alias("cov"))
    return clipped.join(n, ["task", "row_id"], "left").withColumn("cov", F.coalesce("cov", F.lit(0)).cast("bigint"))


def planned_coverage(clipped: DataFrame, *, epochs: int, seed: int = 0, broadcast: bool = False) -> DataFrame:
    """What ``coverage`` says of ``draws``, without the draws: all passes but the last give each row once, and the last one gives it to
    the rows that come first in its order. Only that order is numbered."""
    n = clipped.groupBy("task").agg(F.count("*").alias("_n"), F.first("max_per_file").alias("_cap"), F.first("repeat").alias("_rep"))
    D = F.least(F.coalesce("_cap", F.col("_n")), F.col("_n")) * F.col("_rep") * epochs
    plan = n.select("task", F.greatest(D, F.lit(0)).cast("bigint").alias("_D"), "_n").select("task", F.expr("_D div _n").alias("_full"), F.expr("_D % _n").alias("_rest"))
    rows = clipped.join(F.broadcast(plan) if broadcast else plan, "task")
    even = rows.where("_rest = 0").withColumn("cov", F.col("_full"))
    h = rows.where("_rest > 0").withColumn("_h", _order(seed, "_full"))
    odd = numbered(h, ["task"], "_h", ["row_id"], "_slot").withColumn("cov", F.col("_full") + (F.col("_slot") < F.col("_rest")).cast("bigint"))
    return even.select(*clipped.columns, "cov").unionByName(odd.select(*clipped.columns, "cov"))


def training_sample(records: DataFrame, policy: DataFrame, *, factor: int = 10, chars: int = 10_000, seed: int = 0, broadcast: bool = False) -> DataFrame:
    """Documents for a tokenizer's statistics: instruction and response of each record, cut to ``chars`` code points, and
    of each task a uniform sample of ``factor * max_per_file`` of them at most (all without a cap). task, row_id, side, text."""
    docs = records.select("task", "row_id", F.posexplode(F.array("instruction", "response")).alias("side", "text")).where("text is not null")
    p = policy.select("task", "max_per_file")
    j = docs.join(F.broadcast(p) if broadcast else p, "task").withColumn("text", F.left("text", F.lit(chars)))
    h = j.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), "task", F.col("row_id").cast("string"), F.col("side").cast("string"))))
    return numbered(h, ["task"], "_h", ["row_id", "side"], "_p").where(F.col("max_per_file").isNull() | (F.col("_p") < F.col("max_per_file") * factor)).select("task", "row_id", "side", "text")
