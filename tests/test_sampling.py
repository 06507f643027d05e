import hashlib
import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import layout, report, sampling

POLICY = "task string, max_per_file bigint, long_context string, repeat int"
INDEX = "task string, row_id bigint, inst_start bigint, inst_len bigint, resp_start bigint, resp_len bigint"


def tasks(spark, sizes):
    rows = [(t, i, i * 10, 5, i * 10 + 5, 4) for t, n, *_ in sizes for i in range(n)]
    policy = spark.createDataFrame([(t, cap, "truncate", rep) for t, _, cap, rep in sizes], POLICY)
    return sampling.clip(spark.createDataFrame(rows, INDEX), policy)


@pytest.mark.parametrize("n, cap, rep, epochs", [(5, None, 1, 3), (5, 2, 1, 4), (5, 3, 2, 2), (4, 10, 3, 1), (0, 5, 2, 2), (5, 0, 1, 2), (5, 2, 1, 0)])
def test_invariants(spark, n, cap, rep, epochs):
    clipped = tasks(spark, [("t", n, cap, rep), ("u", 3, None, 1)])
    drawn = sampling.draws(clipped, epochs=epochs, seed=3).where("task = 't'").collect()
    R = min(cap if cap is not None else n, n) * rep
    assert len(drawn) == R * epochs
    assert all(v == R for v in Counter(r.epoch for r in drawn).values())
    every = sorted(map(tuple, sampling.coverage(clipped, sampling.draws(clipped, epochs=epochs, seed=3)).select("task", "row_id", "cov").collect()))
    for b in (False, True):
        assert every == sorted(map(tuple, sampling.planned_coverage(clipped, epochs=epochs, seed=3, broadcast=b).select("task", "row_id", "cov").collect()))
    cov = {r.row_id: r["cov"] for r in sampling.coverage(clipped, sampling.draws(clipped, epochs=epochs, seed=3)).where("task = 't'").collect()}
    assert len(cov) == n
    if n:
        low, more = divmod(R * epochs, n)
        assert sum(v == low + 1 for v in cov.values()) == more and set(cov.values()) <= {low, low + 1}
    assert sorted(r.draw for r in drawn) == list(range(R * epochs))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 40), st.one_of(st.none(), st.integers(1, 50)), st.integers(1, 3)), min_size=1, max_size=3), st.integers(1, 3))
def test_like_one_by_one(spark, sizes, epochs):
    sizes = [(f"t{i}", *x) for i, x in enumerate(sizes)]
    got = {(r.task, r.draw): (r.row_id, r.epoch) for r in sampling.draws(tasks(spark, sizes), epochs=epochs).collect()}
    want = {}
    for t, n, cap, rep in sizes:
        R = min(cap or n, n) * rep
        for p in range(math.ceil(R * epochs / n)):
            order = sorted(range(n), key=lambda i: (hashlib.md5(f"0|{t}|{p}|{i}".encode()).hexdigest(), i))
            for slot, i in enumerate(order):
                if (k := p * n + slot) < R * epochs:
                    want[t, k] = (i, k // R)
    assert got == want


def test_shuffle_is_a_permutation(spark):
    drawn = sampling.draws(tasks(spark, [("t", 30, None, 1), ("u", 20, 5, 2)]), epochs=2)
    pos = [(r.epoch, r.pos) for r in sampling.shuffled(drawn).collect()]
    assert sorted(pos) == [(e, i) for e in range(2) for i in range(40)]


def test_numbering_in_buckets_is_the_whole_order(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"), F.md5((F.col("id") % 4000).cast("string")).alias("h"))
    got = {(r.g, r.k): r.id for r in sampling.numbered(df, ["g"], "h", ["id"], "k").collect()}
    rows = df.collect()
    for g in range(3):
        mine = sorted((r.h, r.id) for r in rows if r.g == g)
        assert [got[g, i] for i in range(len(mine))] == [x for _, x in mine]


@pytest.mark.parametrize("inst, resp, truncate, drop", [(10, 5, 5, 5), (4095, 9, 2, None), (4096, 9, 1, None), (4097, 9, None, None), (5000, 3, None, None), (10, 1, None, None), (10, None, None, None)])
def test_clip(spark, inst, resp, truncate, drop):
    index = spark.createDataFrame([("t", 0, 0, inst, 0, resp)], INDEX)
    for mode, want in (("truncate", truncate), ("drop", drop)):
        got = [r.resp_len for r in sampling.clip(index, spark.createDataFrame([("t", None, mode, 1)], POLICY)).collect()]
        assert got == ([] if want is None else [want])


def test_policies(spark):
    names = spark.createDataFrame([("flan__cot_a",), ("flan__z",), ("numinamath.jsonl",), (None,)], "task string")
    rules = spark.createDataFrame([(0, "flan__cot_", None, None, None), (1, "flan__", 5000, "drop", 2), (2, None, 1, "drop", 9)], "ord int, prefix string, max_per_file bigint, long_context string, repeat int")
    got = {r.task: tuple(r)[1:] for r in sampling.policies(names, rules).collect()}
    assert got == {"flan__cot_a": (None, "truncate", 1, 2), "flan__z": (5000, "drop", 2, 1), "numinamath.jsonl": (None, "truncate", 1, 0)}


def test_training_sample(spark):
    rec = spark.createDataFrame([("t", i, "ab" * 10, "cd") for i in range(20)] + [("u", 0, None, "x")], "task string, row_id bigint, instruction string, response string")
    pol = spark.createDataFrame([("t", 2, "truncate", 1), ("u", None, "truncate", 1)], POLICY)
    got = sampling.training_sample(rec, pol, factor=3, chars=5).collect()
    assert Counter(r.task for r in got) == {"t": 6, "u": 1} and max(len(r.text) for r in got) <= 5


def test_layout(spark):
    rows = spark.createDataFrame([("f1", 0, 6, 2), ("f1", 1, 3, 4), ("f1", 9000, 1, 1), ("f2", 0, 6, 1), ("f2", 1, None, 3)], "task string, row_id bigint, inst_len bigint, resp_len bigint")
    got = {(r.task, r.row_id): (r.inst_start, r.resp_start) for r in layout.row_offsets(rows).collect()}
    assert got == {("f1", 0): (0, 6), ("f1", 1): (8, 11), ("f1", 9000): (15, 16), ("f2", 0): (0, 6), ("f2", 1): (7, 7)}
    assert {r.task: (r.length, r.base) for r in layout.task_offsets(rows).collect()} == {"f1": (17, 0), "f2": (10, 17)}
    assert [layout.id_type(v) for v in (255, 256, 65535, 65536, None)] == ["uint8", "uint16", "uint16", "int32", "int32"]


def test_metadata_and_report(spark):
    clipped = tasks(spark, [("a__x", 4, None, 1), ("a__y", 6, 2, 1), ("b", 1, None, 2)])
    drawn = sampling.draws(clipped, epochs=2)
    assert layout.metadata(drawn, epochs=2).first().total_length == (4 + 2 + 2) * 9
    assert layout.metadata(drawn.limit(0), epochs=0).first().total_length == 0
    r = {x["name"]: x for x in report.coverage_report(sampling.coverage(clipped, drawn)).collect()}
    assert r["GLOBAL"]["rows"] == 11 and r["GLOBAL"]["cov_rows"] == 16 and r["a"]["rows"] == 10 and r["a__y"]["unique_cov_rows"] == 4
    text = report.render(report.coverage_report(sampling.coverage(clipped, drawn)))
    assert "| **GLOBAL** | 11 (100.0%) |" in text and "Total Unique Rows Sampled:** 9 out of 11 (81.82%)" in text
    assert report.coverage_report(sampling.coverage(clipped, drawn).limit(0)).count() == 0


def test_small_policies_are_broadcast(spark):
    index = tasks(spark, [("t", 30, None, 1), ("u", 20, 5, 2)])
    policy = index.select("task", "max_per_file", "long_context", "repeat").distinct()
    assert sampling.few(policy) and not sampling.few(policy, 1)
    rows = index.drop("max_per_file", "long_context", "repeat")
    drawn = sampling.draws(sampling.clip(rows, policy, broadcast=True), epochs=2, broadcast=True)
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") >= 2 and "leftHint" not in plan
