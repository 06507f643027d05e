"""Queries of the training-data operators, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import defects, encode, languages, leaks, mixing, neardup, oracles, packing, quality


def _read(s: SparkSession, d: str, t: str) -> DataFrame:
    return s.read.parquet(f"{d}/{t}.parquet")


def p1_found(s: SparkSession, d: str) -> DataFrame:
    got = neardup.near_pairs(_read(s, d, "json_rows"), "rec_id", "instruction", least=20, similarity=0.5)
    return got.select(F.col("id_a").alias("rec_id_a"), F.col("id_b").alias("rec_id_b"))


def p1_classes(s: SparkSession, d: str) -> DataFrame:
    """One row for each record; one without an instruction of 20 or more words is a class of its own, with no links."""
    rows = _read(s, d, "json_rows")
    got = neardup.near_classes(rows, "rec_id", "instruction", least=20, similarity=0.5)
    every = rows.select(F.col("rec_id").cast("long").alias("rec_id")).where("rec_id is not null").distinct()
    return every.join(got, "rec_id", "left").select("rec_id", F.coalesce("class_id", "rec_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def p1_links(s: SparkSession, d: str) -> DataFrame:
    return neardup.near_links(_read(s, d, "json_rows"), "rec_id", "instruction", least=20, similarity=0.5)


def p1_groups(s: SparkSession, d: str) -> DataFrame:
    """One row for each record: the least id that a chain of similar instructions leads to; its own where there is none."""
    rows = _read(s, d, "json_rows")
    got = neardup.near_groups(rows, "rec_id", "instruction", least=20, similarity=0.5)
    every = rows.select(F.col("rec_id").cast("long").alias("rec_id")).where("rec_id is not null").distinct()
    return every.join(got, "rec_id", "left").select("rec_id", F.coalesce("group_id", "rec_id").alias("group_id"))


def p2_found(s: SparkSession, d: str) -> DataFrame:
    return p2_leaks(s, d).where("exact").select("rec_id", "item_id").distinct()


def p2_leaks(s: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(_read(s, d, "json_rows"), _read(s, d, "eval_items"), id_col="rec_id", fields=("instruction", "response"), item_id="item_id", question="question", run=16, edits=1)


def p3_found(s: SparkSession, d: str) -> DataFrame:
    known = languages.profiles(_read(s, d, "lang_samples"))
    return languages.wrong_labels(_read(s, d, "json_rows"), known, id_col="rec_id", fields=("instruction", "response"), label="lang", least=6)


def p3_segments(s: SparkSession, d: str) -> DataFrame:
    known = languages.profiles(_read(s, d, "lang_samples"))
    return languages.language_segments(_read(s, d, "json_rows"), known, id_col="rec_id", fields=("instruction", "response"), label="lang")


def p4_draws(s: SparkSession, d: str) -> DataFrame:
    return mixing.draws(_read(s, d, "task_indices"), _read(s, d, "mix_targets"), _read(s, d, "prefix_config"))


def p4_shares(s: SparkSession, d: str) -> DataFrame:
    return mixing.shares(p4_draws(s, d), _read(s, d, "task_indices"), _read(s, d, "mix_targets"))


def p5_found(s: SparkSession, d: str) -> DataFrame:
    samples = _read(s, d, "lang_samples")
    known, model = languages.profiles(samples, bayes=True), defects.declining_model(samples)
    return defects.defects(_read(s, d, "json_rows"), known, model, id_col="rec_id", instruction="instruction", response="response").dropDuplicates(["rec_id"])


def p6_ids(s: SparkSession, d: str) -> DataFrame:
    return encode.encode(_read(s, d, "documents"), id_col="doc_id", text="text")


def p7_places(s: SparkSession, d: str) -> DataFrame:
    return packing.containers(encode.token_counts(_read(s, d, "documents"), id_col="doc_id", text="text"))


def p7_fill(s: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p7_places(s, d))


def p6_texts(s: SparkSession, d: str) -> DataFrame:
    """The texts that the ids of p6_ids stand for."""
    return encode.decode(p6_ids(s, d))


def p7_checks(s: SparkSession, d: str) -> DataFrame:
    return packing.checks(p7_places(s, d))


#: Limits of a container of instruction records: tokens, records, and loss-bearing tokens (those of the responses).
PAIRS = {"capacity": 4097, "segments": 24, "loss_capacity": 1792}


def p7_pairs(s: SparkSession, d: str) -> DataFrame:
    """Instruction records in containers, with the tokens of the response as loss-bearing ones: all three limits hold at once."""
    sizes = encode.token_counts(_read(s, d, "json_rows"), id_col="rec_id", text="instruction", also="response")
    return packing.containers(sizes, loss="n_also", **PAIRS)


def p7_pairs_fill(s: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p7_pairs(s, d), **PAIRS)


def p8_found(s: SparkSession, d: str) -> DataFrame:
    return p8_statistics(s, d).where("kind <> 'prose'").select("doc_id", "kind")


def p8_statistics(s: SparkSession, d: str) -> DataFrame:
    return quality.quality(_read(s, d, "documents"), id_col="doc_id", text="text")


def p8_measures(s: SparkSession, d: str) -> DataFrame:
    return quality.measures(_read(s, d, "documents"), id_col="doc_id", text="text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_classes, p1_links, p1_groups, p2_found, p2_leaks, p3_found, p3_segments, p4_draws, p4_shares, p5_found, p6_ids, p6_texts, p7_places, p7_fill, p7_checks, p7_pairs, p7_pairs_fill, p8_found, p8_statistics, p8_measures)}


def oracle_sql() -> dict[str, str]:
    """Queries without one (languages, defects, kinds) can't be said in SQL; the tests hold them against brute force and held-out samples."""
    return dict(oracles.SQL)
