"""Passages of evaluation items inside a corpus, exactly or with a few character edits.

Method: q-gram lemma filtering over the words of both sides joined by single spaces.

1. *Probes.* A passage of ``run`` words with at most ``edits`` edits still holds at least one of any ``edits + 1``
   q-grams of it that don't overlap. Of every passage of every item so many are taken, the rarest among the items.
   Every text is searched for all probes at once.
2. *Bands.* A probe found at place p of a text and i of an item lies on diagonal p - i. The band about it is ``edits``
   diagonals wide on either side, and overlaps those of its neighbours, so a match with edits lies whole in one.
   In each band the shared q-grams of every passage that holds the probe are counted; by the lemma a passage of L
   characters must share at least L - q + 1 - edits * q. Others are dropped.
3. *Alignment.* What is left is aligned, character by character, within the band; nothing is reported that wasn't. The edit
   distance must be ``edits`` at most; an exact passage has distance 0 and begins and ends with a word.

The items are the query set, against all rows. They come in blocks of at most ``BLOCK`` items and ``BLOCK_CHARS`` characters (a longer
item is taken in pieces that overlap by ``run`` words less one), and ``TOGETHER`` blocks, a broadcast of bounded size, go through
the corpus in one scan, so neither side is held whole anywhere.

Nulls and texts or items of fewer than ``run`` words have no leak. Repeated rows give one result. Empty tables give
none. Extra columns, also of the same name on both sides, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.words import U, column, groups, mix, words

Q = 16  # a power of two
BLOCK, BLOCK_CHARS, TOGETHER, TABLE_BITS = 4096, 4_000_000, 16, 22
#: Alignments that are done at once.
ALIGNED = 50_000
SCHEMA = "rec_id long, item_id long, field string, distance int, exact boolean, words int"


def qgrams(c: np.ndarray) -> np.ndarray:
    """A hash of the Q characters from each place on, by doubling."""
    h, n = mix(c.astype(U) + U(77)), 1
    while n < Q:
        b = U(pow(0x9E3779B97F4A7C15, n, 1 << 64))
        h = h[: max(0, len(h) - n)] * b + h[n:]
        n *= 2
    return mix(h)


@dataclass
class Index:
    """Items' characters one after the other; each passage as [first, end) in them; probes sorted by hash."""

    item: np.ndarray  # id of each piece
    chars: np.ndarray
    grams: np.ndarray
    passage: np.ndarray  # (n, 2), with the blank after its last word
    of: np.ndarray  # passages of piece k: of[k] to of[k+1]
    probe: np.ndarray
    place: np.ndarray
    piece: np.ndarray
    edits: int


def _pieces(rows: list[tuple[int, str]], run: int) -> tuple[list[int], list[str]]:
    ids, texts = [], []
    for i, t in rows:
        if len(t) <= BLOCK_CHARS:
            ids.append(i)
            texts.append(t)
            continue
        parts = words([t]).normal()[0].tobytes().decode("utf-32-le").split()
        step = max(4 * run, BLOCK_CHARS // 8)  # words
        for at in range(0, max(1, len(parts) - run + 1), step):
            ids.append(i)
            texts.append(" ".join(parts[at : at + step + run - 1]))
    return ids, texts


def build(rows: list[tuple[int, str]], run: int, edits: int) -> Index:
    ids, texts = _pieces(rows, run)
    w = words(texts)
    c, at = w.normal()
    g = qgrams(c)
    # Places in the order of their q-grams' number among the items, then of hash and place.
    _, inv, n = np.unique(g, return_inverse=True, return_counts=True)
    by = np.lexsort((np.arange(len(g)), g, n[inv])) if len(g) else np.zeros(0, np.int64)
    rank = np.empty(len(g) + 1, np.int64)
    rank[by], rank[-1] = np.arange(len(g)), len(g)
    counts = w.counts()
    of_word = np.cumsum(counts) - counts
    end = np.append(at, len(c))
    # Passages by piece: ``run`` words from each on that has as many left.
    each = np.maximum(0, counts - run + 1)
    piece_of, first_word = _flat(of_word, each)
    a, b = end[first_word], end[first_word + run]
    # The best q-gram of what is left of each passage, ``edits + 1`` times; what overlaps it is no longer left.
    lo, hi = a[:, None], b[:, None] - Q
    places, pieces = [], []
    for _ in range(edits + 1):
        if not len(lo) or not len(g):
            break
        open_ = hi > lo
        spans = np.stack([np.where(open_, lo, len(g)), np.where(open_, hi, len(g))], -1)
        low = np.minimum.reduceat(rank, spans.reshape(-1))[::2].reshape(lo.shape)
        low[~open_] = len(g)
        k = low.argmin(1)
        best = low[np.arange(len(low)), k]
        ok = best < len(g)
        p = by[np.where(ok, best, 0)]
        places.append(p[ok])
        pieces.append(piece_of[ok])
        # The interval that held it becomes what is before and what is after.
        row = np.arange(len(lo))
        after = np.where(ok, np.minimum(p + Q, hi[row, k]), hi[row, k])
        stop = hi[row, k].copy()
        hi = hi.copy()
        hi[row, k] = np.where(ok, np.maximum(lo[row, k], p - Q + 1), hi[row, k])
        lo, hi = np.column_stack([lo, after]), np.column_stack([hi, stop])
    both = np.unique(np.stack([np.concatenate(places), np.concatenate(pieces)], 1), axis=0) if places else np.zeros((0, 2), np.int64)
    place = both[:, 0]
    h = g[place] if len(place) else np.zeros(0, U)
    s = np.argsort(h, kind="stable")
    return Index(np.array(ids, np.int64), c, g, np.stack([a, b], 1).astype(np.int64).reshape(-1, 2), np.append(0, np.cumsum(each)), h[s], place[s], both[s, 1], edits)


def distances(a: np.ndarray, first: np.ndarray, size: np.ndarray, b: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of many pairs at once: the edit distance (``most`` + 1 stands for more) of a[first : first + size] to the best stretch of b
    within [lo, hi) whose characters lie at most 2 * most off the diagonal that begins at ``at``; and where the best stretch ends off it."""
    n, wide = len(first), 4 * most + 1
    o = np.argsort(-size, kind="stable")
    first, size, at, lo, hi = first[o], size[o], at[o] - 2 * most, lo[o], hi[o]
    off = np.arange(wide)
    row = np.zeros((n, wide), np.int16)  # it begins anywhere in the band
    live = np.searchsorted(-size, -np.arange(int(size[0]) if n else 0), "left")
    far = np.full((n, 1), most + 1, np.int16)
    for i, m in enumerate(live.tolist()):
        place = (at[:m] + i)[:, None] + off
        inside = (place >= lo[:m, None]) & (place < hi[:m, None])
        same = inside & (b[np.clip(place, 0, len(b) - 1)] == a[first[:m] + i][:, None])
        up = np.concatenate([row[:m, 1:], far[:m]], 1) + 1
        now = np.minimum(row[:m] + ~same, up) - off
        row[:m] = np.minimum.accumulate(now, axis=1) + off
    best = np.empty((2, n), np.int64)
    best[0, o], best[1, o] = np.minimum(row.min(1), most + 1), row.argmin(1) - 2 * most
    return best[0], best[1]


def _flat(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs first, first + 1, ... of n each: which run, and the values."""
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[of]


@dataclass
class Prepared:
    """A group of texts: characters, q-grams, and where each text begins and ends in them."""

    chars: np.ndarray
    grams: np.ndarray
    lo: np.ndarray
    hi: np.ndarray


def prepare(texts: list[str | None], run: int) -> Prepared | None:
    w = words(texts)
    if len(w.hashes) < run:
        return None
    c, at = w.normal()
    counts, end = w.counts(), np.append(at, len(c))
    return Prepared(c, qgrams(c), end[np.cumsum(counts) - counts], end[np.cumsum(counts)])


def find(x: Index, t: Prepared, table: np.ndarray, run: int) -> list[tuple[int, int, int, bool, int]]:
    """Text, item, distance, exact, and words of the passage (the most, if exact), for all texts of a group."""
    c, g, lo, hi = t.chars, t.grams, t.lo, t.hi
    p = np.flatnonzero(table[(g & U((1 << TABLE_BITS) - 1)).astype(np.int64)])
    left = np.searchsorted(x.probe, g[p], "left")
    h, hit = _flat(left, np.searchsorted(x.probe, g[p], "right") - left)
    if not len(h):
        return []
    p, place, piece = p[h], x.place[hit], x.piece[hit]
    doc, diagonal = np.searchsorted(hi, p, "right"), p - place
    # The passages that hold the probe, and the places of the item that they cover.
    first = np.maximum(x.of[piece], np.searchsorted(x.passage[:, 1], place + Q, "left"))
    last = np.minimum(x.of[piece + 1], np.searchsorted(x.passage[:, 0], place, "right"))
    begin = x.passage[first, 0]
    span = x.passage[last - 1, 1] - begin - Q + 1
    of, spot = _flat(begin, span)
    base = np.cumsum(span) - span
    r, j = _flat(first, last - first)
    size = x.passage[j, 1] - x.passage[j, 0]
    at0 = base[r] + x.passage[j, 0] - begin[r]
    at1 = at0 + size - Q + 1
    mine, from_, to = x.grams[spot], lo[doc][of], hi[doc][of] - Q
    shared = np.zeros(len(spot), bool)
    for s in range(-x.edits, x.edits + 1):  # the band about the probe's diagonal; bands of near probes overlap
        q = spot + diagonal[of] + s
        same = (q >= from_) & (q <= to)
        same[same] = g[q[same]] == mine[same]
        shared |= same
    total = np.concatenate([[0], np.cumsum(shared, dtype=np.int32)])
    ok = np.flatnonzero(total[at1] - total[at0] >= np.maximum(1, size - Q + 1 - x.edits * Q))
    if not len(ok):
        return []
    # Every region that is left is aligned; many probes lead to the same one.
    region = np.unique(np.stack([doc[r[ok]], diagonal[r[ok]], j[ok], piece[r[ok]]], 1), axis=0)
    out: dict[tuple[int, int], tuple[int, bool, int]] = {}
    exact = []
    for k in range(0, len(region), ALIGNED):
        d, diag, j, of_piece = region[k : k + ALIGNED].T
        at = x.passage[j, 0] + diag
        far, off = distances(x.chars, x.passage[j, 0], x.passage[j, 1] - x.passage[j, 0], c, at, lo[d], hi[d], x.edits)
        start = at + off
        whole = (far == 0) & ((start == lo[d]) | (c[np.maximum(start - 1, 0)] == 32))
        exact.append(np.stack([d, of_piece, diag + off, j], 1)[whole])
        far = np.where((far == 0) & ~whole, 1, far)  # another word ends like the first
        for i in np.flatnonzero((far <= x.edits) & ~whole).tolist():
            key = (int(d[i]), int(x.item[of_piece[i]]))
            if key not in out or far[i] < out[key][0]:
                out[key] = (int(far[i]), False, run)
    e = np.unique(np.concatenate(exact), axis=0)
    if len(e):
        new = np.ones(len(e), bool)
        new[1:] = (e[1:, :3] != e[:-1, :3]).any(1) | (e[1:, 3] != e[:-1, 3] + 1)
        starts = np.flatnonzero(new)
        most: dict[tuple[int, int], int] = {}
        for k, n in zip(starts.tolist(), np.diff(np.append(starts, len(e))).tolist()):
            key = (int(e[k, 0]), int(x.item[e[k, 1]]))
            most[key] = max(most.get(key, 0), n + run - 1)
        out |= {key: (0, True, n) for key, n in most.items()}
    return [(d, i, *v) for (d, i), v in out.items()]


def leaks(corpus: DataFrame, items: DataFrame, *, id_col: str, fields: tuple[str, ...], item_id: str, question: str, run: int = 16, edits: int = 1) -> DataFrame:
    """A row for each record, field and item of which a passage of ``run`` words leaked, with at most ``edits`` edits.

    Columns rec_id, item_id, field, distance (edits of the best passage), exact (run words in a row are the same),
    words (how many in a row, if exact).
    """
    src = corpus.select(F.col(id_col).cast("long").alias("rec_id"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)]).where("rec_id is not null")
    query = items.select(F.col(item_id).cast("long").alias("i"), F.col(question).alias("q")).where("i is not null and q is not null").dropDuplicates(["i"])
    scans, blocks, now, chars = [], [], [], 0
    for r in query.toLocalIterator():  # the driver holds what one scan takes
        now.append((r.i, r.q))
        chars += len(r.q)
        if len(now) == BLOCK or chars >= BLOCK_CHARS:
            blocks.append(build(now, run, edits))
            now, chars = [], 0
        if len(blocks) == TOGETHER:
            scans.append(_scan(src, fields, blocks, run))
            blocks = []
    if now:
        blocks.append(build(now, run, edits))
    if blocks or not scans:
        scans.append(_scan(src, fields, blocks, run))
    # The best passage of each record, field and item (a long item comes in pieces).
    best = F.min_by(F.struct("distance", "exact", "words"), F.struct("distance", -F.col("words"))).alias("b")
    return reduce(DataFrame.unionByName, scans).groupBy("rec_id", "item_id", "field").agg(best).select("rec_id", "item_id", "field", "b.*")


def _scan(src: DataFrame, fields: tuple[str, ...], blocks: list[Index], run: int) -> DataFrame:
    known = src.sparkSession.sparkContext.broadcast(blocks)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = [x for x in known.value if len(x.probe)]
        tables = []
        for x in every:
            tables.append(np.zeros(1 << TABLE_BITS, bool))
            tables[-1][(x.probe & U((1 << TABLE_BITS) - 1)).astype(np.int64)] = True
        for b in batches:
            ids = b.column(0).to_pylist()
            for i, f in enumerate(fields):
                for first, g in groups(column(b, f"f{i}")):
                    t = prepare(g, run)
                    got = [z for x, table in zip(every, tables) for z in find(x, t, table, run)] if t else []
                    yield pa.RecordBatch.from_pydict(
                        {
                            "rec_id": pa.array([ids[first + d] for d, *_ in got], pa.int64()), "item_id": pa.array([r[1] for r in got], pa.int64()), "field": pa.array([f] * len(got), pa.string()),
                            "distance": pa.array([r[2] for r in got], pa.int32()), "exact": pa.array([r[3] for r in got], pa.bool_()), "words": pa.array([r[4] for r in got], pa.int32()),
                        }
                    )

    return src.mapInArrow(search, SCHEMA)
