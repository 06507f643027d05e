import random
import re
import time
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import bounded, declining, defects, encode, languages, leaks, neardup, quality, queries, words

VOCAB = [a + b + c for a in "bdfglmnprst" for b in "aeiou" for c in ("n", "r", "st", "x", "m")]


def plain_words(t):
    if t is None:
        return []
    t = "".join(c for c in unicodedata.normalize("NFKC", t.replace("\0", " ")) if unicodedata.category(c) != "Cf").lower()
    return "".join(c if c.isalnum() else " " for c in t).split()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text(alphabet="aé İß١²­‍ﬁ-_.0\n", max_size=30)), max_size=5))
def test_words(texts):
    w = words.words(texts)
    got = [[] for _ in texts]
    for d, s, n in zip(w.doc, w.start, w.length):
        got[d].append("".join(map(chr, w.codes[s : s + n])))
    assert got == [plain_words(t) for t in texts]
    same = {}
    for h, x in zip(w.hashes.tolist(), (x for g in got for x in g)):
        assert same.setdefault(x, h) == h
    assert len(set(same.values())) == len(same)


def test_groups_hold_all():
    texts = ["a" * n for n in (3, 10, 1, 0, 25, 2)] + [None]
    back = [(i, t) for first, g in words.groups(texts, 10) for i, t in enumerate(g, first)]
    assert back == list(enumerate(texts)) and list(words.groups([])) == []


def test_gather(spark):
    df = spark.range(0, 5000, 1, 300)
    got = bounded.gather(df, lambda it: (b.column(0).to_numpy() % 70_000 for b in it), 70_000)
    assert got.sum() == 5000 and got[:5000].min() == 1 and got[5000:].sum() == 0
    assert bounded.gather(df.limit(0), lambda it: (b.column(0).to_numpy() for b in it), 10).sum() == 0


# --- Near duplicates.


def similar(a, b):
    s, t = (set(zip(x, x[1:], x[2:])) for x in (plain_words(a), plain_words(b)))
    return len(s & t) * 2 >= len(s | t)


def brute(rows):
    ok = [(i, t) for i, t in dict(rows).items() if i is not None and len(plain_words(t)) >= 20]
    return {(min(i, j), max(i, j)) for k, (i, a) in enumerate(ok) for j, b in ok[:k] if similar(a, b)}


def edited(r, text, n):
    w = text.split()
    for _ in range(n):
        k, at = r.choice(["sub", "del", "ins", "move"]), r.randrange(len(w))
        if k == "sub":
            w[at] = r.choice(VOCAB)
        elif k == "del" and len(w) > 25:
            del w[at]
        elif k == "ins":
            w.insert(at, r.choice(VOCAB))
        else:
            b = r.randrange(len(w))
            w[at:], w[b:] = w[at:], w[b:]
            w = w[at:] + w[:at]
    return " ".join(w)


@pytest.fixture(scope="module")
def near_rows():
    r = random.Random(5)
    rows = []
    for _ in range(60):
        base = " ".join(r.choice(VOCAB) for _ in range(r.randint(20, 120)))
        rows.append(base)
        rows += [edited(r, base, r.randint(1, max(1, len(base.split()) // 14))) for _ in range(2)]
    rows += [rows[0]] * 3 + [rows[0].upper(), rows[3].replace(" ", "  ,")]
    rows += [None, "", "  ", "a b c", "same " * 30, "same " * 25, " ".join(VOCAB[:19])]
    long = " ".join(r.choice(VOCAB) for _ in range(2500))
    rows += [long, edited(r, long, 60), " ".join(r.choice(VOCAB) for _ in range(2600)), long + " " + " ".join(r.choice(VOCAB) for _ in range(900))]
    return list(enumerate(rows))


def test_near_pairs(spark, near_rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in near_rows], "rec_id bigint, instruction string, text string, id int").repartition(3)
    got = [tuple(r) for r in neardup.near_pairs(df, "rec_id", "instruction").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(near_rows) and len(got) > 100
    # Repeated rows are one record; an empty table has no pairs; a null id is no record.
    again = df.union(df).unionByName(df.where("rec_id = 0").selectExpr("cast(null as bigint) rec_id", "instruction", "text", "id"))
    assert {tuple(r) for r in neardup.near_pairs(again, "rec_id", "instruction").collect()} == set(got)
    assert neardup.near_pairs(df.limit(0), "rec_id", "instruction").count() == 0


@pytest.mark.parametrize("boundary", [0, 4, 10**9])
def test_heavy_shingles(spark, near_rows, monkeypatch, boundary):
    """Nearly all shingles are heavy: all sets are large, some, or none."""
    counts = neardup.costs
    monkeypatch.setattr(neardup, "costs", lambda *a: (counts(*a)[0], neardup.Cost(1, 0, boundary, 1 << 14)))
    rows = [(i, t) for i, t in near_rows if len(t or "") < 5000]
    df = spark.createDataFrame(rows, "rec_id bigint, instruction string")
    assert {tuple(r) for r in neardup.near_pairs(df, "rec_id", "instruction").collect()} == brute(rows)


def test_boundary_follows_the_cost():
    counts = np.zeros(1000, np.int64)
    counts[:10] = 4000
    cost = neardup.choose(counts, light=100)
    assert cost.spare == 40 and cost.boundary == 1 + 2 * 3960 // neardup.POSTING
    counts[:10] *= 10
    assert neardup.choose(counts, light=100).boundary > 9 * cost.boundary
    assert neardup.choose(np.ones(1000, np.int64)).boundary == 1


@pytest.mark.parametrize("boundary", [0, 30, 10**9])
def test_both_sides_find_rows(spark, monkeypatch, boundary):
    """A family whose common shingles are all heavy: found by subsets alone, by lists alone, and by both."""
    r = random.Random(13)
    base = [r.choice(VOCAB) for _ in range(60)]
    texts = [" ".join(w if k % 9 or (k + i) % 2 else f"s{i}x{k}" for k, w in enumerate(base[: 40 + 20 * (i % 2)])) for i in range(80)]
    rows = list(enumerate(texts))
    counts = neardup.costs
    monkeypatch.setattr(neardup, "costs", lambda *a: (counts(*a)[0], neardup.Cost(8, 0, boundary, 25)))
    df = spark.createDataFrame(rows, "rec_id bigint, instruction string").repartition(3)
    known, cost = neardup.costs(df, "instruction", 20)
    w = words.words(texts)
    d, k, *_ = neardup.keys(w, np.ones(w.n, bool), neardup.coded(known), cost, 0.5)
    assert bool(((k & np.uint64(1)) == 1).any()) == (boundary > 0)
    want = brute(rows)
    assert len(want) > 1000 and {tuple(x) for x in neardup.near_pairs(df, "rec_id", "instruction").collect()} == want


def test_postings_follow_the_texts():
    """Where all shingles are heavy, as in large tables, a text is sent once for each shingle of its prefix and not for each two of them."""
    r = random.Random(17)
    w = words.words([" ".join(r.choice(VOCAB) for _ in range(r.randint(40, 120))) for _ in range(200)])
    keep = np.ones(w.n, bool)
    d, g = neardup._shingles(w, keep)
    counts = np.zeros(neardup.BUCKETS, np.int64)
    counts[neardup._bucket(words.mix(g ^ neardup.LARGE))] = 10_000
    sent, *_ = neardup.keys(w, keep, neardup.coded(counts), neardup.choose(counts), 0.5)
    prefix = np.bincount(d) - np.ceil(0.5 * np.bincount(d)) + 1
    assert (np.bincount(sent, minlength=w.n) <= 1.1 * prefix).all() and (np.bincount(sent, minlength=w.n) >= prefix).all()


def test_rounds(spark, near_rows, monkeypatch):
    """Postings of several rounds give the same pairs; rounds are as many as keep each within the bound; no shuffle file stays."""
    rows = [(i, t) for i, t in near_rows if len(t or "") < 5000][:90]
    df = spark.createDataFrame(rows, "rec_id bigint, instruction string")
    size, texts, postings = 600_000, 1000, 50_000
    n = neardup.needed(size, texts, postings, 10_000)
    bound = neardup.ROUND * size
    most = neardup.POSTED + neardup.SIGNED
    assert n > 2 and 0.98 * postings * most / n <= bound < postings * most / (n - 1)
    assert neardup.needed(0, 0, 0, 4) == 1 and neardup.needed(size, texts, texts, 10_000) == 1
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in str(disk.getAllFiles().mkString(" ")).split() if "/shuffle_" in x}
    before = files()
    monkeypatch.setattr(neardup, "rounds", lambda *a: 3)
    ids, similar = neardup.similar_texts(df, "rec_id", "instruction", least=20, similarity=0.5)
    for _ in range(100):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left
    got = {tuple(x) for x in neardup.near_pairs(df, "rec_id", "instruction").collect()}
    assert got == brute(rows) and len(got) > 30


def test_unlike_sets_of_one_list_are_told_apart():
    """Sets of 100 to 200 elements with nothing in common but a key: hardly any two pass the signature."""
    r = np.random.default_rng(4)
    size = np.sort(r.integers(100, 200, 300))
    g = r.integers(0, 1 << 63, size.sum()).astype(np.uint64)
    sign = neardup._signature(np.repeat(np.arange(300), size), g, 300)
    x = {"key": np.zeros(300, np.int64), "left": size, "text": np.arange(300), "size": size} | {f"s{i}": sign[:, i] for i in range(8)}
    met = list(neardup._meet(iter([pa.RecordBatch.from_pydict(x)]), 0.5))
    assert sum(b.num_rows for b in met) < 10


def test_coded_counts():
    x = np.array([0, 1, 2, 127, 128, 129, 1000, 10**6, 10**10])
    back = neardup.DECODED[neardup.coded(x)]
    assert (back[:5] == x[:5]).all() and (back <= x).all() and (back * 1.2 >= x).all() and (np.diff(neardup.DECODED) > 0).all()


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(25)] + [(200, i) for i in range(201, 260)] + [(7, 7)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in neardup.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert neardup.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_groups_of_records(spark, near_rows):
    df = spark.createDataFrame(near_rows, "rec_id bigint, instruction string")
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in sorted(brute(near_rows)):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x.rec_id: x.group_id for x in neardup.near_groups(df, "rec_id", "instruction").collect()}
    assert got == {i: find(i) for i, t in near_rows if len(plain_words(t)) >= 20}


def test_family_beyond_a_light_list(spark, monkeypatch):
    r = random.Random(11)
    base = [r.choice(VOCAB) for _ in range(90)]
    texts = [" ".join(w if (k + 1) % 12 else f"slot{i}x{k}" for k, w in enumerate(base)) for i in range(300)]  # Jaccard 0.615, no 12 words in a row in common
    df = spark.createDataFrame(list(enumerate(texts)), "rec_id bigint, instruction string").repartition(3)
    assert similar(texts[0], texts[1])
    every = {(i, j) for i in range(300) for j in range(i + 1, 300)}
    assert {tuple(x) for x in neardup.near_pairs(df, "rec_id", "instruction").collect()} == every
    assert {x.links for x in neardup.near_classes(df, "rec_id", "instruction").collect()} == {299}
    monkeypatch.setattr(neardup, "LIST", 70)  # lists are cut into parts, pairs sent in pieces
    monkeypatch.setattr(neardup, "SENT", 1000)
    assert {tuple(x) for x in neardup.near_pairs(df, "rec_id", "instruction").collect()} == every


def test_short_texts_with_spread_edits(spark):
    r = random.Random(12)
    rows = []
    for n, places in ((20, (6, 13)), (29, (7, 14, 21)), (38, (8, 15, 22, 29))):
        for _ in range(40):
            base = [r.choice(VOCAB) for _ in range(n)]
            rows += [" ".join(base), " ".join(f"edit{k}" if k in places else w for k, w in enumerate(base))]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "rec_id bigint, instruction string")
    got = {tuple(x) for x in neardup.near_pairs(df, "rec_id", "instruction").collect()}
    assert got == brute(rows) and len(got) == 120


def test_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PART", 7)  # copies are cut into parts
    r = random.Random(2)
    base = [r.choice(VOCAB) for _ in range(40)]
    rows = [(i, " ".join(base)) for i in range(60)] + [(100 + i, " ".join([*base[:20], VOCAB[i], *base[20:]])) for i in range(20)] + [(200 + i, " ".join(r.choice(VOCAB) for _ in range(30))) for i in range(60)]
    got = {tuple(x) for x in neardup.near_pairs(spark.createDataFrame(rows, "rec_id bigint, instruction string"), "rec_id", "instruction").collect()}
    assert got == brute(rows)


def test_classes(spark, near_rows):
    df = spark.createDataFrame(near_rows, "rec_id bigint, instruction string")
    got = {r.rec_id: (r.class_id, r.links) for r in neardup.near_classes(df, "rec_id", "instruction").collect()}
    same = {i: tuple(plain_words(t)) for i, t in near_rows if len(plain_words(t)) >= 20}
    first = {}
    for i in sorted(same):
        first.setdefault(same[i], i)
    assert {i: c for i, (c, _) in got.items()} == {i: first[w] for i, w in same.items()}
    pairs = brute(near_rows)
    links = {i: {first[same[b if a == i else a]] for a, b in pairs if i in (a, b)} - {first[same[i]]} for i in same}
    assert {i: n for i, (_, n) in got.items()} == {i: len(v) for i, v in links.items()}


def test_classes_of_all_records(spark, near_rows, tmp_path):
    spark.createDataFrame(near_rows, "rec_id bigint, instruction string").write.parquet(f"{tmp_path}/json_rows.parquet")
    got = {r.rec_id: (r.class_id, r.links) for r in queries.p1_classes(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, _ in near_rows}
    assert all(got[i] == (i, 0) for i, t in near_rows if len(plain_words(t)) < 20)
    links = {tuple(r) for r in queries.p1_links(spark, str(tmp_path)).collect()}
    assert links == {(min(a, b), max(a, b)) for a, b in ((got[i][0], got[j][0]) for i, j in brute(near_rows)) if a != b}


def test_signature_bound():
    r = random.Random(3)
    for n in (40, 95, 96, 150, 400):
        a = [r.choice(VOCAB) for _ in range(n)]
        b = a[: n // 2] + [r.choice(VOCAB) for _ in range(7)] + a[n // 2 + 3 :]
        w = words.words([" ".join(a), " ".join(b)])
        d, g = neardup._shingles(w, np.ones(2, bool))
        s = neardup._signature(d, g, 2).view(np.uint64)
        x, y = (set(g[d == i].tolist()) for i in range(2))
        low = s[0, :4] ^ s[1, :4]
        assert np.bitwise_count(low).sum() <= len(x ^ y)
        if min(len(x), len(y)) >= neardup.WIDE:
            up = s[0, 4:] ^ s[1, 4:]
            assert np.bitwise_count(up).sum() + np.bitwise_count(up ^ low).sum() <= len(x ^ y)


# --- Leaks.


def test_leaks(spark):
    r = random.Random(4)
    say = lambda n: " ".join(r.choice(VOCAB) for _ in range(n))
    q = {1: say(40), 2: say(16), 3: say(15), 4: None, 5: "", 6: say(30), 7: say(60)}
    w = {k: (v or "").split() for k, v in q.items()}
    typo = w[6][:]
    typo[9] = typo[9][:-1]  # one letter is missing
    rows = [
        (1, say(30) + " " + q[1] + " " + say(20), None), (2, say(9), say(5) + "\n" + " ".join(w[1][10:26]).upper() + "! " + say(4)), (3, " ".join(w[1][10:25]) + " " + say(9), ""),
        (4, q[2], q[2]), (5, q[3], q[3]), (6, say(8) + " " + " ".join(typo) + " " + say(9), None), (7, "- " + ", ".join(w[7][20:50]), None), (8, None, None), (9, "", " "), (10, "x" + q[2], q[2] + "x"),
    ]
    corpus = spark.createDataFrame([(*x, "q", 5) for x in rows], "rec_id bigint, instruction string, response string, question string, item_id int").repartition(2)
    items = spark.createDataFrame([(k, v, "z") for k, v in q.items()] + [(1, q[1], "again")], "item_id bigint, question string, instruction string")
    args = dict(id_col="rec_id", fields=("instruction", "response"), item_id="item_id", question="question")
    got = leaks.leaks(corpus, items, **args).collect()
    exact = {(x.rec_id, x.item_id, x.field): x.words for x in got if x.exact}
    assert exact == {(1, 1, "instruction"): 40, (2, 1, "response"): 16, (4, 2, "instruction"): 16, (4, 2, "response"): 16, (7, 7, "instruction"): 30} | ({(6, 6, "instruction"): 20} if len(typo) - 10 >= 16 else {})
    near = {(x.rec_id, x.item_id, x.distance) for x in got if not x.exact}
    assert (10, 2, 1) in near and all(x[2] <= 1 for x in near)
    assert leaks.leaks(corpus.limit(0), items, **args).count() == 0 and leaks.leaks(corpus, items.limit(0), **args).count() == 0
    assert leaks.leaks(corpus.union(corpus), items, **args).count() == len(got)


def test_leaks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK", 2)
    r = random.Random(6)
    q = [" ".join(r.choice(VOCAB) for _ in range(20)) for _ in range(5)]
    corpus = spark.createDataFrame([(i, "a b " + t) for i, t in enumerate(q)], "id bigint, t string")
    items = spark.createDataFrame(list(enumerate(q)), "i bigint, t string")
    assert sorted((x.rec_id, x.item_id) for x in leaks.leaks(corpus, items, id_col="id", fields=("t",), item_id="i", question="t").collect()) == [(i, i) for i in range(5)]


def _find(x, texts, run):
    table = np.zeros(1 << leaks.TABLE_BITS, bool)
    table[(x.probe & np.uint64((1 << leaks.TABLE_BITS) - 1)).astype(np.int64)] = True
    return leaks.find(x, leaks.prepare(texts, run), table, run)


def test_long_items_in_pieces(monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 600)
    r = random.Random(8)
    text = " ".join(r.choice(VOCAB) for _ in range(300))
    x = leaks.build([(9, text.replace(" ", " - ; - "))], 16, 1)  # blanks divide more than words
    assert len(x.item) > 3
    parts = [" ".join(text.split()[i : i + 16]) for i in range(285)]
    assert {d for d, i, *_ in _find(x, parts, 16) if i == 9} == set(range(285))


def test_one_scan_for_many_items(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK", 50)
    monkeypatch.setattr(leaks, "TOGETHER", 200)
    items = spark.createDataFrame([(i, " ".join(VOCAB[(i * 7 + k * k) % len(VOCAB)] for k in range(18))) for i in range(1000)], "i bigint, t string")
    df = leaks.leaks(items, items, id_col="i", fields=("t",), item_id="i", question="t")
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {(x.rec_id, x.item_id) for x in df.where("exact").collect()} >= {(i, i) for i in range(1000)}


def test_alignment_decides(monkeypatch):
    r = random.Random(9)
    q = [" ".join(r.choice(VOCAB) for _ in range(24)) for _ in range(6)]
    x = leaks.build(list(enumerate(q)), 16, 1)
    texts = ["a " + q[0] + " b", q[1].replace(" ", "  ").upper(), q[2][:-3], "z" + q[3]]
    assert {(d, i, e) for d, i, _, e, _ in _find(x, texts, 16)} == {(k, k, True) for k in range(4)}
    monkeypatch.setattr(leaks, "distances", lambda a, first, *z: (np.full(len(first), 9), np.zeros(len(first), np.int64)))
    assert _find(x, texts, 16) == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.text("ab", max_size=12), st.integers(-3, 12)), min_size=1, max_size=6), st.integers(0, 2))
def test_distances_in_a_band(pairs, most):
    def brute_distance(a, b, at):
        best = min(most + 1, len(a))
        for i in range(max(0, at - 2 * most), min(len(b), at + 2 * most) + 1):
            row = {j: j - i for j in range(i, len(b) + 1)}
            for k, ch in enumerate(a):
                new = {}
                for j in range(i, len(b) + 1):
                    new[j] = min([row[j] + 1, *([row[j - 1] + (b[j - 1] != ch), new[j - 1] + 1] if j > i else [])])
                row = new
            best = min(best, *row.values())
        return best

    a = "".join(x for x, _, _ in pairs)
    b = "".join(y for _, y, _ in pairs)
    codes = lambda s: np.frombuffer(s.encode("utf-32-le"), np.uint32)
    size = np.array([len(x) for x, _, _ in pairs])
    long = np.array([len(y) for _, y, _ in pairs])
    lo = np.cumsum(long) - long
    at = lo + np.array([k for *_, k in pairs])
    got, _ = leaks.distances(codes(a), np.cumsum(size) - size, size, codes(b) if b else np.zeros(1, np.uint32), at, lo, lo + long, most)
    for n, (x, y, k) in zip(got.tolist(), pairs):
        want = brute_distance(x, y, k)
        assert n >= want  # the band holds every way that keeps within it
        if 0 <= k <= len(y) - len(x) and y[k : k + len(x)] == x:
            assert n == 0


# --- Languages and defects.

SAY = {
    "en": ["The old motor slows the narrow canal before the next break because the water is cold.", "There were many boxes in the hall at the start, but only a few were left in the evening.", "Nobody expected the wagon to last longer than the bridge."],
    "de": ["Der alte Motor bremst den engen Kanal vor der nächsten Pause, weil das Wasser kalt ist.", "Am Anfang waren viele Kisten in der Halle, aber am Abend blieben nur wenige übrig.", "Niemand hat erwartet, dass der Wagen länger hält als die Brücke."],
    "fr": ["Le vieux moteur freine le canal étroit avant la prochaine pause parce que l'eau est froide.", "Au début il y avait beaucoup de caisses dans la salle, mais le soir il n'en restait que peu.", "Personne ne pensait que la voiture durerait plus longtemps que le pont."],
}


@pytest.fixture(scope="module")
def samples():
    return [(k, t) for k, v in SAY.items() for t in v]


def test_labels():
    assert [languages.named(x) for x in ("en", " EN", "en-GB", "de_AT", "deu", "German", "zxx", "und", "", None, "  ", "?", "pt-BR")] == ["en", "en", "en", "de", "de", "de", None, None, None, None, None, None, "pt"]


@pytest.mark.parametrize("make", [languages.fit, languages.fit_bayes])
def test_segments(samples, make):
    x = make(samples)
    sym = languages.symbols(x.symbol)
    mixed = SAY["en"][1] + " " + SAY["de"][0] + " $x = 5$ " + SAY["de"][2] + "\n" + SAY["fr"][1]
    doc, lang, n, conf, every = languages.segments(x, sym, [None, "", "$x^2 + y$ 12", SAY["fr"][0], mixed, "The word “Gleichgewicht” is used before the break."])
    got = [(int(d), x.languages[k]) for d, k in zip(doc, lang)]
    assert got == [(3, "fr"), (4, "en"), (4, "de"), (4, "fr"), (5, "en")] and (conf > 0.9).all()


def test_long_text_is_one_segment(samples):
    x = languages.fit(samples)
    doc, lang, n, *_ = languages.segments(x, languages.symbols(x.symbol), [" ".join(SAY["de"] * 100)])
    assert len(doc) == 1 and x.languages[lang[0]] == "de" and n[0] > 4000


def test_short_passages_wherever_they_are():
    """Passages of six to ten words of samples, set into English inline and by themselves, on sound samples."""
    import os

    import pyarrow.parquet as pq

    p = "/root/testdata/sf0.01/lang_samples.parquet"
    if not os.path.exists(p):
        pytest.skip("no test data")
    rows = sorted((x["lang"], x["text"]) for x in pq.read_table(p).to_pylist() if x["lang"] and x["text"])
    x = languages.fit(rows)
    sym, r = languages.symbols(x.symbol), random.Random(2)
    en = [t for k, t in rows if k == "en"]
    for n, least in ((6, 0.8), (7, 0.9), (8, 0.95), (10, 0.97)):
        for sep in (" ", ". "):
            texts, want = [], []
            for k, t in rows:
                w = t.split()
                if k != "en" and len(w) >= n:
                    at, e = r.randrange(len(w) - n + 1), " ".join(r.sample(en, 9)).split()
                    texts.append(" ".join(e[:40]) + sep + " ".join(w[at : at + n]).strip(".,;:") + sep + " ".join(e[40:80]))
                    want.append(k)
            got = [set() for _ in texts]
            for d, lang, m, _, every in zip(*languages.segments(x, sym, texts)):
                if every >= 6 and m >= languages.LETTERED:
                    got[d].add(x.languages[lang])
            assert sum(k in g for k, g in zip(want, got)) >= least * len(texts) and sum(bool(g - {k, "en"}) for k, g in zip(want, got)) <= 2


def test_numbers_count_in_passages(samples):
    x = languages.fit(samples)
    doc, lang, n, _, every = languages.segments(x, languages.symbols(x.symbol), ["Niemand hat 93 Wagen und 17 Kisten erwartet, 8"])
    assert len(doc) == 1 and n[0] == 6 and every[0] == 8


def test_wrong_labels(spark, samples):
    known = languages.profiles(spark.createDataFrame(samples, "lang string, text string"))
    en, de = SAY["en"][0], SAY["de"][0]
    rows = [(1, en, de, "en-US"), (2, en, en, "de"), (3, en, None, None), (4, en + " " + de, "", "English"), (5, "Der Hund", "5", "en"), (6, None, None, "en")]
    df = spark.createDataFrame([(*x, "k", 1) for x in rows], "rec_id bigint, instruction string, response string, lang string, label string, field int")
    args = dict(id_col="rec_id", fields=("instruction", "response"), label="lang")
    got = {tuple(r) for r in languages.wrong_labels(df, known, **args).collect()}
    assert got == {(1, "response", "de"), (2, "instruction", "en"), (2, "response", "en"), (3, "instruction", "en"), (4, "instruction", "de")}
    assert languages.wrong_labels(df.limit(0), known, **args).count() == 0
    s = languages.language_segments(df.union(df), known, **args).where("rec_id = 4").collect()
    assert len(s) == 4 and {(r.segment, r.lang, r.label) for r in s} == {(0, "en", "en"), (1, "de", "en")}


EMPTY = [None, "", "  \n", "\xa0", "...", "—", "####", "n/a", "N/A", "[no response]", "TBD", "None", "null", "$$", "\\boxed{}", "{}", "```\n```", "<think>\n</think>", "Answer:", "**Answer:** ", "A:", "​", "﻿", "<br><br>"]
SOUND = ["A", "7", "-3.5", "$x = 9$", "x**9", "True", "\\boxed{9}", "49 litres", "Answer: 2.5 litres", "The water is cold.", "The water is cold", "Is the water cold?", "He said “no”.", "The water is cold.\n#### 7", "So it is cold.\n- x = 4\n- x = 5", "It is so.\n\n```python\nprint(1)\n```", "It is so. \\[ 1 + 1 = 2 \\]", "It is so.\n\nAnswer: C", "The clerk said “I can't help you with that”, so the group counted again. It was cold and the water was high.", "I cannot draw a figure here, yet the steps below settle the question. The old motor slows the canal and the water rises before the break."]
CUT = ["It is cold. The old mot", "It is cold. Therefore we get a", "It is cold. The water and,", "It is cold. $x = \\sqrt{18", "It is cold. \\[ 195 +", "It is so.\n```python\ndef f(x):\n    return", "It is cold. \\boxed{97", "It is so.\n1. The water is cold.\n2.", "It is cold. He took the ("]
REFUSAL = ["I'm sorry, but I can't help with that request today.", "As an assistant, I won’t be giving a solution for this task. Please consult a qualified teacher instead.", "Leider bin ich nicht in der Lage, dazu eine Lösung zu geben.", "Je préfère ne pas donner de réponse à ce sujet.", "Lamentablemente no me es posible responder a esta pregunta.", "Preferisco non fornire una risposta su questo argomento.", "Ik geef liever geen antwoord op dit soort verzoeken.", "Wolę nie udzielać odpowiedzi na ten temat."]


def test_defects(spark, samples):
    known = languages.profiles(spark.createDataFrame(samples, "lang string, text string"), bayes=True)
    ask, copy = SAY["en"][0] + " What is left?", "Copy this paragraph without any change.\n" + SAY["en"][1]
    want = [(ask, r, "empty") for r in EMPTY] + [(ask, r, None) for r in SOUND] + [(ask, r, "truncated") for r in CUT] + [(ask, r, "refusal") for r in REFUSAL]
    want += [(ask, ask, "copy"), (ask, "“" + ask.lower() + "”", "copy"), (copy, SAY["en"][1], None), (ask, SAY["de"][0], "other_language"), ("Translate into German: " + ask, SAY["de"][0], None), (SAY["de"][1], SAY["de"][0], None), (None, "Cold.", None), (None, None, "empty"), ("", SAY["de"][0], None)]
    df = spark.createDataFrame([(i, a, b, "x", 0) for i, (a, b, _) in enumerate(want)], "rec_id bigint, instruction string, response string, i string, r int").repartition(2)
    model = defects.declining_model(spark.createDataFrame(samples, "lang string, text string"))
    got = {r.rec_id: r.defect for r in defects.defects(df, known, model, id_col="rec_id", instruction="instruction", response="response").collect()}
    assert {i: (b, got.get(i)) for i, (a, b, d) in enumerate(want) if got.get(i) != d} == {}
    assert defects.defects(df.limit(0), known, model, id_col="rec_id", instruction="instruction", response="response").count() == 0


def test_long_responses_are_judged_whole(monkeypatch):
    likely = np.zeros(1 + 2 * len(defects.ROWS) * defects.ENDS, np.int64)
    much = "\n".join([SAY["en"][0]] * 50)
    line = much.replace("\n", " ")
    assert len(line) > 3000
    for t in ("It is cold. $$ x = 1\n" + much, "It is cold. \\[ x = 1\n" + much, "It is cold. \\( x = 1\n" + much, "It is cold. $x = " + line):
        assert defects.is_cut(t, likely), t[:30]
    at = line[-2995:]  # a formula over the place that lies 3,000 characters before the end
    for t in (line, "$$ x = 1 $$\n" + much, "\\[ x = 1 \\]\n" + much, line + " $x = 1 + 2 + 3$" + at, "$$ x \\\\[2pt] y $$\n" + much):
        assert not defects.is_cut(t, likely), t[:30]
    # Marks of sentences far before the end count as well.
    monkeypatch.setattr(defects, "likelihood", lambda *a: 0.5)
    plain = line.replace(".", "")
    assert defects.is_cut("It is cold. " + plain, likely) and not defects.is_cut(plain, likely)


def test_declining_by_a_model(samples):
    model = declining.fit([t for _, t in samples])
    ask = "Translate into English: „Ich kann am Freitag nicht zu deinem Fest kommen.“"
    for t in ("That one I will leave to somebody else.", "I'd rather someone else dealt with this question.", "Sorry. This I cannot answer for you. Please ask a teacher.", "Deze opdracht kan ik niet oplossen."):
        assert defects.is_refusal(t, ask, model) and len(defects.may_decline(words.words([t]), model)) == 1, t
    for t in ("I cannot come to your party on Friday.", "The bridge could not be opened.", "The word is “I can't help you with that request”.", "I can't answer that exactly, but the steps below lead to the number of boxes: add all sides, then take a third."):
        assert not defects.is_refusal(t, ask, model), t


def test_likelihood_decides_on_ends_without_marks(monkeypatch):
    likely = np.zeros(1 + 2 * len(defects.ROWS) * defects.ENDS, np.int64)
    t = "The pump is old. The water in the tank is cold"
    for share, cut in ((0.0, True), (1.0, False)):
        monkeypatch.setattr(defects, "likelihood", lambda *a, v=share: v)
        assert defects.is_cut(t, likely) == cut


def test_short_copies(samples):
    x = languages.fit_bayes(samples)
    likely = np.zeros(1 + 2 * len(defects.ROWS) * defects.ENDS, np.int64)
    pairs = [("Name one cold canal.", "name one cold canal", "copy"), ("Solve it.", "Solve it.", "copy"), ("Repeat this: red.", "Repeat this: red.", None), ("Is it 7?", "Is it 8?", None), ("7 + x", "7 + x", None), ("Is it so?", "So it is.", None)]
    got = defects.find(x, languages.symbols(x.symbol), likely, declining.fit([]), [a for a, _, _ in pairs], [b for _, b, _ in pairs])
    assert [g if g == "copy" else None for g in got] == [d for _, _, d in pairs]


# --- Encoding.


@pytest.fixture(scope="module")
def library():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t, encode.Encoder(*encode.vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="aeiou ntsr'\n", max_size=120)))
def test_encode_like_the_library(library, text):
    t, e = library
    assert e.ids(text) == t.encode(text, add_special_tokens=False).ids


def test_encode_long_pieces_and_specials(library):
    t, e = library
    r = random.Random(1)
    for text in ("x" * 5000, "".join(r.choice("abcdefgh") for _ in range(3000)), "<|endoftext|> a <|im_start|>", "ab" * 700, "é" * 300, "日本" * 200, " " * 500, "\U0001f600" * 50):
        assert e.ids(text) == t.encode(text, add_special_tokens=False).ids
    for n in range(1, 40):
        p = "".join(r.choice("qzxjkv") for _ in range(n))
        assert list(e.piece(p.encode())) == t.encode(p, add_special_tokens=False).ids


def test_decode(spark):
    rows = [(1, "Ünïcode — <|endoftext|>\n\n  12"), (2, ""), (3, None), (4, "a" * 3000 + "😀")]
    ids = encode.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), id_col="doc_id", text="text")
    assert {r.doc_id: r.text for r in encode.decode(ids).collect()} == {i: t or "" for i, t in rows}
    assert encode.decode(ids.limit(0)).count() == 0


def test_encode_rows(spark, library):
    df = spark.createDataFrame([(1, "a b", 7), (2, None, 8), (3, "", 9), (1, "a b", 7)], "doc_id bigint, text string, ids int")
    got = sorted((r.doc_id, r.ids) for r in encode.encode(df, id_col="doc_id", text="text").collect())
    ids = library[0].encode("a b").ids
    assert got == [(1, ids), (1, ids), (2, []), (3, [])]
    assert {(r.doc_id, r.n_tokens) for r in encode.token_counts(df, id_col="doc_id", text="text").collect()} == {(1, 2), (2, 0), (3, 0)}
    assert encode.encode(df.limit(0), id_col="doc_id", text="text").count() == 0


# --- Quality.

PROSE = "The old motor slows the narrow canal before the next break. There were many boxes in the hall at the start of the week, but only a few of them were left."
KINDS = {
    "prose": [PROSE, PROSE.lower().replace(".", ""), "1. " + PROSE + "\n2. " + PROSE, "\n".join(PROSE[i : i + 45] for i in range(0, len(PROSE), 45)), PROSE + "\n- red boat\n- blue boat\n- old sail", PROSE + " " + "x" * 400, "Hello there.", "$x = 5$ " + PROSE, "    " + PROSE.replace(" ", "  ")],
    "list": ["\n".join(f"- {a} boat ({i})" for i, a in enumerate("red blue old new tall".split())), PROSE[:59] + "\n" + "\n".join(f"({x}) {x} narrow valve" for x in "abcdefghijk"), "\n".join("- [x] der alte Motor" for _ in range(9)), "\n".join(f"Old boat {i}: {i * 7} metres" for i in range(8))],
    "table": ["\n".join("| a | b | 5 |" for _ in range(5)), "\n".join("boat\t5%\t-\tvalve" for _ in range(6)), "\n".join("Yared,11%,-,208.8" for _ in range(6)), "\n".join("basin         weir          5.0" for _ in range(6)), "a & b & c \\\\\n" * 6, "+-----+-----+\n|boat |5    |\n+-----+-----+\n|sail |6    |\n+-----+-----+"],
    "junk": ["tower " * 60, "Next | Login | Print | >> | Home | >> | Menu", "undefined\nNaN NaN\nclick here\n<br><br>\nloading\n???", "[15:25:59] W3184 0x6aba err=43 ret=-2\n[16:46:37] W9440 0xc92f err=65 ret=8\n[16:47:37] W9441 0xc93f err=6 ret=8", "hak[ubei;fmf]pux/fd]tvq;jc;n gv[cz w;mg]hv q[kn z]af;bq " * 4, "ab12CD34ef" * 30, "#%$ @!~ ^&* ()_ {}[] |\\"],
}


def test_symbols_and_words_of_whole_texts(spark):
    rows = [(1, "→ ★ ■"), (2, "one two three ∑∑∑∑∑∑ four five six seven eight nine →→→→→"), (3, "The sum $x + y = 12$ is `print(z)` of both."), (4, "１２ ﬁne caf\u0065\u0301 \u00adx")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in quality.quality(df, id_col="doc_id", text="text").collect()}
    assert got[1].kind == "junk" and got[1].symbol_ratio == 3.0
    assert got[2].words == 9 and got[2].symbol_ratio == 11 / 9
    assert got[3].words == 10 and got[4].words == 4 and got[4].symbol_ratio == 0
    plain = {r.doc_id: r for r in quality.measures(df.union(df.limit(0)), id_col="doc_id", text="text").collect()}
    assert {k: (v.words, v.symbol_ratio, v.mean_word_length) for k, v in plain.items()} == {k: (v.words, v.symbol_ratio, v.mean_word_length) for k, v in got.items()}
    assert plain[1].fails == "mean_word_length,symbol_ratio,few_common_words,unpunctuated_lines"


def test_reasons_are_thresholds(spark):
    df = spark.createDataFrame([(i, t) for i, (k, v) in enumerate(KINDS.items()) for t in v], "doc_id bigint, text string")
    for r in quality.quality(df, id_col="doc_id", text="text").collect():
        assert set(r.reasons) <= {*quality.PUBLISHED, "repeated_words", "unreadable_sentences", "few_sentences", "many_entries", "many_rows"}
        assert r.kind == "prose" or set(r.reasons) & set(quality.PUBLISHED)
        assert r.sentences + r.entries + r.rows + r.noise <= 1.001


def test_quality(spark):
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, v in KINDS.items() for t in v)]
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (902, " \n\xa0​", "x")], "doc_id bigint, text string, kind string")
    got = {r.doc_id: r for r in quality.quality(df, id_col="doc_id", text="text").collect()}
    assert {t: got[i].kind for i, t, k in rows if got[i].kind != k} == {} and not {900, 901, 902} & set(got)
    assert all(r.reasons for r in got.values() if r.kind != "prose") and got[0].reasons == []
    first = got[0]
    ws = re.findall(r"\w+", PROSE)
    assert first.words == len(ws) and abs(first.mean_word_length - sum(map(len, ws)) / len(ws)) < 1e-9 and first.punctuated_lines == 1.0
    assert quality.quality(df.limit(0), id_col="doc_id", text="text").count() == 0 and quality.quality(df.union(df), id_col="doc_id", text="text").count() == 2 * len(rows)
