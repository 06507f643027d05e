"""Coverage report by task, category and overall, and its rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X

COUNTS = ("rows", "toks", "inst_toks", "resp_toks", "cov_rows", "cov_toks", "cov_inst", "cov_resp", "unique_cov_rows", "unique_cov_toks")


def coverage_report(covered: DataFrame) -> DataFrame:
    """level (task, category, global), name, the ten counts, and their percentage of all (``pct_``; of at least one).

    ``covered``: as from sampling.coverage. One pass with grouping sets. No rows give an empty report.
    """
    t = covered.select("task", X.category(F.col("task")).alias("category"), F.col("inst_len").cast("bigint").alias("i"), F.col("resp_len").cast("bigint").alias("r"), "cov")
    seen = F.col("cov") > 0
    aggs = [F.count("*"), F.sum(F.col("i") + F.col("r")), F.sum("i"), F.sum("r"), F.sum("cov"), F.sum((F.col("i") + F.col("r")) * F.col("cov")), F.sum(F.col("i") * F.col("cov")), F.sum(F.col("r") * F.col("cov")), F.sum(seen.cast("int")), F.sum(F.when(seen, F.col("i") + F.col("r")).otherwise(0))]
    by = t.groupingSets([["category", "task"], ["category"], []], "category", "task").agg(F.grouping_id().alias("g"), *[F.coalesce(a, F.lit(0)).cast("bigint").alias(n) for a, n in zip(aggs, COUNTS)])
    named = by.select(F.when(F.col("g") == 0, "task").when(F.col("g") == 1, "category").otherwise("global").alias("level"), F.when(F.col("g") == 0, F.col("task")).when(F.col("g") == 1, F.col("category")).otherwise("GLOBAL").alias("name"), *COUNTS)
    whole = named.where("level = 'global'").select(*[F.greatest(F.lit(1), F.col(x)).alias("_" + x) for x in COUNTS])
    return named.crossJoin(F.broadcast(whole)).select("level", "name", *COUNTS, *[(F.col(x) / F.col("_" + x)).alias("pct_" + x) for x in COUNTS])  # one row


def render(report: DataFrame) -> str:
    """Markdown of the report (a row for each task: as many as files)."""
    rows = {k: [] for k in ("category", "task", "global")}
    for r in report.orderBy("name").toLocalIterator():
        rows[r.level].append(r)
    if not rows["global"]:
        return "\nNothing to report."
    whole = rows["global"][0]
    shown = ("rows", "toks", "cov_rows", "cov_toks", "cov_inst", "cov_resp")
    out = []
    # Headings and formats of the report's text.
    for title, part in (("Category", sorted([*rows["category"], whole], key=lambda r: r["name"])), ("Task", rows["task"])):
        out += [f"\n### {title} Coverage Stats", "| Name | Rows (%) | Tokens (%) | Cov Rows (%) | Cov Toks (%) | Cov IToks (%) | Cov RToks (%) |", "|------|" + "---|" * 6]
        out += [f"| **{r['name']}** | " + " | ".join(f"{r[x]:,} ({r[x] / max(1, whole[x]):.1%})" for x in shown) + " |" for r in part]
    u, t = whole["unique_cov_toks"], whole["toks"]
    v, n = whole["unique_cov_rows"], whole["rows"]
    return "\n".join([*out, "\n### Global Summary", f"**Total Unique Tokens Sampled:** {u:,} out of {t:,} ({u / max(1, t):.2%})", f"**Total Unique Rows Sampled:** {v:,} out of {n:,} ({v / max(1, n):.2%})\n"])
