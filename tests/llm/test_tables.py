from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import mixing, packing, queries

T0 = datetime(2025, 1, 1)
INDEX = "task string, row_id bigint, resp_len bigint, indexed_at timestamp, source string"
RULES = "ord int, prefix string, max_per_file bigint, long_context string, repeat int"


def index(spark, files):
    rows = [(t, i, n, T0, "x") for t, sizes in files.items() for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, INDEX)


def check(drawn, files, caps, repeats):
    by = defaultdict(Counter)
    for r in drawn:
        by[r.task, r["pass"]][r.row_id] += 1
        assert r.resp_len == files[r.task][r.row_id]
    for (task, p), rows in by.items():
        assert set(rows.values()) == {1} and p < repeats.get(task, 1) and len(rows) <= caps.get(task, 10**9)


def test_mixture(spark):
    files = {"a__x": [10] * 300, "a__y": [7] * 200, "b": [20] * 10, "c": [1] * 50 + [None] * 3, "e": [5] * 10}
    targets = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.15), ("d", 0.05), (None, 0.1)], "source string, target_share double")
    rules = spark.createDataFrame([(0, "a__x", 90, None, 2), (1, "a__", None, None, None), (2, "b", 4, None, 3), (3, None, 1, None, 9)], RULES)
    ix = index(spark, files)
    drawn = mixing.draws(ix, targets, rules).collect()
    check(drawn, files, {"a__x": 90, "b": 4}, {"a__x": 2, "b": 3})
    # The largest total at which all sources reach their targets: that of the scarcest. The source without rows is left out.
    supply = {"a": 300 * 0 + 90 * 2 * 10 + 200 * 7, "b": 4 * 3 * 20, "c": 50}
    total = min(supply["a"] / 0.5, supply["b"] / 0.3, supply["c"] / 0.15)
    tokens = Counter()
    for r in drawn:
        tokens[r.source] += r.resp_len
    assert abs(tokens["a"] - total * 0.5) <= 10 and abs(tokens["b"] - total * 0.3) <= 20 and tokens["c"] == 50 and not tokens["e"]
    # Of the tokens of all rows: sources that lack rows give all they may.
    more = mixing.draws(ix, targets, rules, total="all").collect()
    check(more, files, {"a__x": 90, "b": 4}, {"a__x": 2, "b": 3})
    total = sum(x or 0 for v in files.values() for x in v)
    tokens = Counter()
    for r in more:
        tokens[r.source] += r.resp_len
    assert abs(tokens["a"] - total * 0.5) <= 10  # within one row
    assert tokens["b"] == 4 * 3 * 20 and tokens["c"] == 50 and not tokens["e"]
    assert {(r.task, r.row_id, r["pass"]) for r in drawn} <= {(r.task, r.row_id, r["pass"]) for r in more}
    shares = {r.source: r for r in mixing.shares(mixing.draws(ix, targets, rules), ix, targets).collect()}
    assert set(shares) == {"a", "b", "c", "d"} and shares["d"].tokens == 0 and abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9


def test_latest_and_odd_rows(spark):
    rows = [("a", 1, 5, T0, ""), ("a", 1, 9, datetime(2025, 1, 2), ""), ("a", 1, 9, datetime(2025, 1, 2), ""), ("a", 2, None, T0, ""), (None, 1, 5, T0, ""), ("a", None, 5, T0, ""), ("a", 3, 0, T0, "")]
    targets = spark.createDataFrame([("a", 1.0), ("a", 0.5)], "source string, target_share double")
    rules = spark.createDataFrame([], RULES)
    ix = spark.createDataFrame(rows, INDEX)
    assert {(r.row_id, r.resp_len) for r in mixing.draws(ix, targets, rules).collect()} == {(1, 9), (3, 0)}
    assert mixing.draws(ix.limit(0), targets, rules).count() == 0 and mixing.draws(ix, targets.limit(0), rules).count() == 0
    r = mixing.shares(mixing.draws(ix.limit(0), targets, rules), ix.limit(0), targets).collect()
    assert len(r) == 1 and r[0].tokens == 0 and r[0].actual_share is None


def test_thresholds_in_few_buckets(spark, monkeypatch):
    """All hashes in one bucket of the first histogram, then of the second too: what is drawn stays what the order of hashes says."""
    files = {"a__x": list(range(1, 120)), "b": [3] * 40}
    targets = spark.createDataFrame([("a", 0.4), ("b", 0.6)], "source string, target_share double")
    rules = spark.createDataFrame([(0, "a__x", 70, None, 2)], RULES)
    ix = index(spark, files)
    want = sorted(map(tuple, mixing.draws(ix, targets, rules).collect()))
    assert want
    for bits in (1, 4):
        monkeypatch.setattr(mixing, "BITS", bits)
        assert sorted(map(tuple, mixing.draws(ix, targets, rules).collect())) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(0, 20)), max_size=60), st.integers(1, 8))
def test_pack(items, segments):
    cap = np.array([50, segments, 20])
    demand = np.array([[a, 1, b] for a, b in items], np.int64).reshape(-1, 3)
    box, turn = packing.pack(demand, cap)
    assert (box >= 0).all() and sorted(turn) == list(range(len(items)))
    for k in range(box.max() + 1 if len(box) else 0):
        mine = demand[box == k].sum(0)
        assert (mine <= cap).all() and (box == k).any()


def test_places(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 4)
    rng = np.random.default_rng(1)
    sizes = {i: int(n) for i, n in enumerate(rng.integers(1, 120, 400))} | {1000: 250, 1001: 100, 1002: 300, 1003: 0, 1004: None}
    df = spark.createDataFrame([(i, n, "x") for i, n in sizes.items()], "doc_id bigint, n_tokens bigint, part string")
    placed = packing.containers(df, capacity=100, segments=6)
    rows = placed.collect()
    parts, boxes = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append((r.part, r.n_tokens))
        boxes[r.container].append((r.start, r.n_tokens, r.segment))
    assert {r.doc_id for r in rows if r.container is None} == {1003, 1004}
    assert sorted(parts[1000]) == [(0, 100), (1, 100), (2, 50)] and parts[1001] == [(0, 100)] and len(parts[1002]) == 3
    assert all(sum(n for _, n in p) == (sizes[i] or 0) and (len(p) == 1) == ((sizes[i] or 0) <= 100) for i, p in parts.items())
    for k, v in boxes.items():
        if k is not None:
            at = 0
            for i, (start, n, seg) in enumerate(sorted(v, key=lambda x: x[2])):
                assert start == at and seg == i
                at += n
            assert at <= 100 and len(v) <= 6
    f = packing.fill_report(placed, 100).first()
    assert f.tokens == sum(x or 0 for x in sizes.values()) and f.used_share > 0.8 and f.unused == f.containers * 100 - f.tokens
    assert packing.containers(df.limit(0)).count() == 0 and packing.fill_report(packing.containers(df.limit(0))).first().containers == 0
    assert packing.containers(df.union(df), capacity=100).count() == 2 * len(rows)


def test_three_limits(spark, monkeypatch):
    """Records with many loss-bearing tokens, with few tokens, and with many: each limit fills containers."""
    monkeypatch.setattr(packing, "SHARD", 3)
    rng = np.random.default_rng(2)
    rows = [(i, int(n), int(n * x)) for i, (n, x) in enumerate(zip(rng.choice([2, 3, 25], 900), rng.choice([0.1, 0.9], 900)))]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, n_loss bigint")
    args = dict(capacity=200, segments=10, loss_capacity=100)
    placed = packing.containers(df, loss="n_loss", **args)
    by = defaultdict(lambda: np.zeros(3, int))
    for r in placed.collect():
        by[r.container] += (r.n_tokens, 1, r.loss)
    assert len(by) and all((v <= (200, 10, 100)).all() for v in by.values()) and sum(v[1] for v in by.values()) == 900
    f = packing.fill_report(placed, **args).first()
    assert f.full_segments > 0 and f.full_loss > 0 and 0 < f.loss_share <= 1
    c = packing.checks(placed, 200).first()
    assert tuple(c) == (900, 0, 0, 0)
    assert tuple(packing.checks(packing.containers(df.limit(0))).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_queries_run(spark, name):
    import os

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    columns = {"p1_found": ["rec_id_a", "rec_id_b"], "p2_found": ["rec_id", "item_id"], "p3_found": ["rec_id", "field", "lang"], "p5_found": ["rec_id", "defect"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id", "kind"]}
    df = queries.queries()[name](spark, d)
    rows = df.collect()
    assert rows and df.columns == columns.get(name, df.columns)
    if name.endswith("_found"):
        assert len({tuple(r) for r in rows}) == len(rows)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_like_sql(spark, name):
    import glob
    import os

    import duckdb

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    con = duckdb.connect()
    for f in glob.glob(f"{d}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.queries()[name](spark, d)
    names = sorted(df.columns)
    rel = con.sql(queries.oracle_sql()[name])
    at = [rel.columns.index(c) for c in names]
    assert sorted(rel.columns) == names
    assert sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
