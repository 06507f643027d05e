"""Near-duplicate records: all pairs whose sets of three-word sequences (shingles) are similar.

Method: a size-aware heavy-light join, exact for every similarity.

Every text's shingles are put into one order of all data, the rarest first (by a count table of ``BUCKETS`` numbers, taken
over all texts). Of n shingles, two similar sets have at least need = ceil(similarity * n) in common, so the first k
that they have in common are among the first n - need + k of each (the prefix of k). A shingle in more than ``LIGHT``
texts is heavy; light ones come first in the order.

* The first common shingle is **light**: the two meet in its inverted list, which is short. (A shingle that the counts
  find in one text only can't be common and gets no list. Of the subsets below, one with a light shingle needs
  no place of its own: this list holds all that it could.)
* It is heavy, and both sets are **small**: then the first two common shingles are heavy and lie in both prefixes of 2,
  so the two meet in one of the **subsets of fixed size 2** that every small set enumerates of the heavy shingles there.
* It is heavy, and one set is **large**: they meet in its inverted list, in which large sets are held against all others
  (small ones stand there to be found, but aren't held against each other).

A set is large if it has more heavy shingles to choose from than the **boundary**, which **cost** chooses: with h of them, the
subsets cost h (h - 1) / 2 postings and the lists h * L comparisons, L being the mean length of a heavy list in these data.
Subsets also take disk, so a set of more than ``SUBSETS`` heavy shingles to choose from is large in any case.

Postings carry signatures and are larger than the texts. They are sent in **rounds** by the hashes of their keys, as many as it takes
(by a sample of the texts) for a round's to be at most ``ROUND`` times the texts; a round's are removed before the next is sent.

Two texts of a list are held against their sizes and positions (from the first common shingle on, both must have as
many left as the similarity asks for), then against a parity signature (similar sets differ in few elements, hence in few
parity bits), and at last against the exact similarity. Each bound is provable. A heavy list, or a subset's, is cut
into parts of about ``LIST`` texts by the texts' hashes, and each two parts meet in a task of their own. No list is dropped.

Exact copies count as one text until the end: a text is represented once, whatever the number of its copies, and pairs of
records are made from pairs of texts. What is complete: every similar pair (of texts told apart by hashes of 64 bits).

Nulls and texts of fewer than ``least`` words are in no pair. Repeated rows with the same id are one record. An empty
table gives no pairs. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bounded import gather
from corpusloom.llm.durable import durable, shuffles_freed
from corpusloom.llm.words import LINK, U, Words, chains, column, groups, mix, words

SHINGLE = 3
BUCKETS, MARKS, RECENT = 1 << 23, 1 << 23, 1 << 20
#: Sets of so many shingles have signatures of 512 bits, smaller ones of 256. (At 128, sets of 65 to 127 and larger ones passed
#: by chance at 256 bits: pairs to check that grow with the square of the data.)
WIDE = 64
LARGE = U(0x5BF03635F0935AD1)
#: Records of one text that a task holds together.
PART = 4096
#: A shingle in more texts is heavy; texts of one list in a part of it at most.
LIGHT, LIST = 1024, 1 << 14
#: What sending and sorting a posting costs, in comparisons of two texts of a list (measured).
POSTING = 80
#: Heavy shingles at most of a set whose subsets are sent: with h of them these are h (h - 1) / 2 postings, and the lists h.
SUBSETS = 4
#: Bytes written of a posting, and of the text's size and signature where it is the text's first in its partition (they fit 53 bytes a posting, measured with 20 a text and 15 partitions);
#: bytes of a round's postings at most, in bytes of the texts; shingles of the sample by which rounds are counted.
POSTED, SIGNED, ROUND, SAMPLED = 17, 64, 2, 2_000_000
#: Postings that are paired at once, and pairs that are sent on at once.
TOGETHER, SENT = 150_000, 500_000


@dataclass(frozen=True)
class Cost:
    """``light``: texts of a light list at most. ``spare``: what a bucket's count holds beside any one shingle (its mean).
    ``boundary``: heavy shingles of a small set at most. ``part``: texts of one list in one part. ``subsets``: bounds ``boundary`` by disk."""

    light: int
    spare: int
    boundary: int
    part: int
    subsets: int = 1 << 62


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - BUCKETS.bit_length() + 1)).astype(np.int64)  # of BUCKETS


def _texts(w: Words) -> np.ndarray:
    """A hash of all words of each text, in order."""
    out = np.zeros(w.n, U)
    if len(w.hashes):
        n = w.counts()
        first = np.cumsum(n) - n
        place = np.arange(len(w.doc)) - first[w.doc]
        has = np.flatnonzero(n)
        out[has] = np.add.reduceat(mix(w.hashes ^ mix(place.astype(U) + LINK)), first[has])
    return mix(out + w.counts().astype(U))


def _shingles(w: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of the texts to keep, by text: text, shingle."""
    g, one = chains(w, SHINGLE)
    ok = one & keep[w.doc[: len(g)]]
    d, g = w.doc[: len(g)][ok], g[ok]
    # One sort of one number where the text's place fits beside enough of the hash.
    o = np.argsort(d.astype(U) << U(50) | g >> U(14)) if w.n <= 1 << 14 else np.lexsort((g, d))
    d, g = d[o], g[o]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    return d[new], g[new]


def _signature(d: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    """Parity bits of each set: two sets' bits differ in no more places than the sets in elements.

    The first four numbers hold 256 bits; the others, of sets from WIDE on, the upper half of 512 bits, of which the
    first four are the two halves folded together. So any two signatures can be compared, at the lower width.
    """
    h = mix(g)
    bits = np.bincount(d * 512 + (h & U(511)).astype(np.int64), minlength=n * 512).astype(np.uint8) & 1
    both = np.packbits(bits.reshape(n, 512), axis=1).view(np.int64)
    both[:, :4] ^= both[:, 4:]
    both[np.bincount(d, minlength=n) < WIDE, 4:] = 0
    return both


def _fresh(batches: Iterator[pa.RecordBatch], text: str, least: int) -> Iterator[tuple[np.ndarray, Words, np.ndarray, np.ndarray]]:
    """Texts with enough words that didn't come before in this task: their places in the group, words, text hashes."""
    seen: set[int] = set()
    for b in batches:
        for _, g in groups(column(b, text)):
            w = words(g)
            h = _texts(w)
            keep = np.zeros(w.n, bool)
            for i in np.flatnonzero(w.counts() >= least).tolist():
                x = int(h[i])
                if x not in seen:
                    seen.add(x)
                    keep[i] = True
            yield keep, w, h


def costs(df: DataFrame, text: str, least: int) -> tuple[np.ndarray, Cost]:
    """How often each bucket of shingles occurs, counted over all data, and the boundary that follows."""

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for keep, w, _ in _fresh(batches, text, least):
            g, one = chains(w, SHINGLE)
            yield _bucket(mix(g ^ LARGE)[one & keep[w.doc[: len(g)]]])

    counts = gather(df.select(text), buckets, BUCKETS)
    return counts, choose(counts)


def choose(counts: np.ndarray, light: int | None = None, part: int | None = None) -> Cost:
    """The boundary: with so many heavy shingles, a set's subsets cost as much as the heavy lists that it would scan."""
    light, part, spare = light or LIGHT, part or LIST, int(counts.mean())
    heavy = (counts[counts > light + spare] - spare).astype(np.float64)
    mean = float((heavy**2).sum() / heavy.sum()) if len(heavy) else 0.0  # of the list of a heavy shingle as texts meet it
    return Cost(light, spare, 1 + int(2 * mean / POSTING), part, SUBSETS)


def rounds(df: DataFrame, known: Broadcast, cost: Cost, least: int, similarity: float, shingles: int) -> int:
    """In how many rounds the postings of ``df`` (text) go out, by a sample of about ``SAMPLED`` of its ``shingles``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, texts, postings = 0, 0, 0

        def sized() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for b in batches:
                size += pc.sum(pc.binary_length(b.column(0))).as_py() or 0
                yield b

        for keep, w, _ in _fresh(sized(), "text", least):
            texts += int(keep.sum())
            postings += len(keys(w, keep, known.value, cost, similarity)[0])
        yield pa.RecordBatch.from_pydict({"size": pa.array([size]), "texts": pa.array([texts]), "postings": pa.array([postings])})

    some = df.select("text") if shingles <= SAMPLED else df.select("text").sample(SAMPLED / shingles, seed=1)
    size, texts, postings = some.mapInArrow(measure, "size long, texts long, postings long").agg(F.sum("size"), F.sum("texts"), F.sum("postings")).first()
    return needed(size or 0, texts or 0, postings or 0, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def needed(size: int, texts: int, postings: int, partitions: int) -> int:
    """Rounds in which so many postings of texts of so many bytes take ``ROUND`` times these bytes each at most."""
    n = 1
    while postings and n * texts < postings:
        each = postings / texts / n
        if texts * (each * POSTED + partitions * (1 - (1 - 1 / partitions) ** each) * SIGNED) <= ROUND * size:
            break
        n += 1
    return n


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts in a byte each: exact below 128, then four steps to every doubling (rounded down)."""
    big = np.floor(4 * np.log2(np.maximum(counts, 128) / 128))
    return np.where(counts < 128, counts, 128 + np.minimum(big, 127)).astype(np.uint8)


#: What a byte stands for.
DECODED = np.array([*range(128), *(int(128 * 2 ** (i / 4)) for i in range(128))], np.int64)


def keys(w: Words, keep: np.ndarray, counts: np.ndarray, cost: Cost, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, key, and shingles from this one on (in the order of all data) of every meeting point; size and signature by text. ``counts``: coded.

    A key's last bit is set where a small set stands in a heavy list.
    """
    d, g = _shingles(w, keep)
    size = np.bincount(d, minlength=w.n)
    sign = _signature(d, g, w.n)
    h = mix(g ^ LARGE)
    count = DECODED[counts[_bucket(h)]]
    o = np.lexsort((h, count, d))
    d, h, count = d[o], h[o], count[o]
    left = size[d] - (np.arange(len(d)) - np.searchsorted(d, d))
    need = np.ceil(similarity * size[d] - 1e-9).astype(np.int64)
    two = left >= need - 1
    d, h, count, left, need = d[two], h[two], count[two], left[two], need[two]
    one, guess = left >= need, np.maximum(count - cost.spare, 1)
    heavy = guess > cost.light
    light = one & ~heavy & (count > 1)
    out = [(d[light], h[light] & ~U(1), left[light])]
    if heavy.any():
        texts = _texts(w)
        many = np.bincount(d[heavy], minlength=w.n)
        # A set of which one common shingle is enough has no subsets.
        large = (many > min(cost.boundary, cost.subsets)) | (np.ceil(similarity * size - 1e-9) < 2)
        at = np.flatnonzero(heavy & one)
        out.append(_parts(d[at], h[at], left[at], guess[at], texts, cost.part, (~large[d[at]]).astype(U)))
        # The subsets: every heavy shingle (of the prefix of 1) with each later one (of the prefix of 2).
        at = np.flatnonzero(heavy & ~large[d])
        later = np.searchsorted(d[at], d[at], "right") - np.arange(len(at)) - 1
        i = np.repeat(np.arange(len(at)), later)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
        i, j = at[i], at[j]
        i, j = i[one[i]], j[one[i]]
        out.append(_parts(d[i], mix(h[i] * LINK + h[j]), left[j] + 1, np.minimum(guess[i], guess[j]), texts, cost.part, U(0)))
    return *(np.concatenate(x) for x in zip(*out)), size, sign


def _parts(d: np.ndarray, h: np.ndarray, left: np.ndarray, most: np.ndarray, texts: np.ndarray, part: int, flag: np.ndarray | U) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, key and left of lists that are cut where they may have more than ``part`` texts: a text's part of a list meets each part, its own too."""
    parts = 1 + (most - 1) // part
    flag = np.broadcast_to(flag, len(d))
    if not len(d) or parts.max() == 1:
        return d, h & ~U(1) | flag, left
    mine = (mix(texts[d] ^ h) % parts.astype(U)).astype(np.int64)
    times = parts
    other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    mine = np.repeat(mine, times)
    both = np.minimum(mine, other) * np.repeat(times, times) + np.maximum(mine, other)
    key = np.where(np.repeat(times, times) > 1, mix(np.repeat(h, times) ^ mix(both.astype(U) + LINK)), np.repeat(h, times))
    return np.repeat(d, times), key & ~U(1) | np.repeat(flag, times), np.repeat(left, times)


def _meet(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and size. Pairs of different texts with a common key that pass the bounds."""
    names = ("key", "left", "text", "size", *(f"s{i}" for i in range(8)))
    rest: list[np.ndarray] | None = None
    recent = np.zeros((RECENT, 2), np.int64)  # pairs that were sent, so that most go out once
    share = similarity / (1 + similarity)  # of both sizes together, that similar sets have in common

    def send(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate(z) for z in zip(*found))
        a, b = np.minimum(a, b), np.maximum(a, b)
        o = np.lexsort((b, a))
        ab = np.stack([a[o], b[o]], 1)
        ab = ab[np.append(True, (ab[1:] != ab[:-1]).any(axis=1))]
        at = (mix(ab[:, 0].astype(U) ^ mix(ab[:, 1].astype(U))) & U(RECENT - 1)).astype(np.int64)
        new = (recent[at] != ab).any(axis=1)
        recent[at[new]] = ab[new]
        return pa.RecordBatch.from_pydict({"a": pa.array(ab[new, 0]), "b": pa.array(ab[new, 1])})

    def pairs(x: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, left, text, size = x[:4]
        need = share * size - 5e-10
        # Of what follows in a list, sizes up to the one of which the rest of this text is the share; small sets come last in a
        # heavy list and are held against large ones only, from the least size that is similar to the large one's.
        run = np.cumsum(np.append(0, key[1:] != key[:-1])) << 32
        place, most = run + size, np.clip(np.floor((left + 1e-9) / share - size), -1, (1 << 31) - 1).astype(np.int64)
        upto = np.searchsorted(place, run + most, "right")
        own = np.arange(len(key)) + 1
        yield from held(x, need, own, np.where(key & 1, 0, upto - own))
        small = np.searchsorted(key, key | 1)
        at = np.flatnonzero((key & 1 == 0) & (small < len(key)))
        at = at[key[small[at]] == key[at] | 1]
        if len(at):
            there, first, after = run[small[at]], own.copy(), np.zeros(len(key), np.int64)
            first[at] = np.searchsorted(place, there + np.ceil(similarity * size[at] - 1e-9).astype(np.int64))
            after[at] = np.searchsorted(place, there + most[at], "right") - first[at]
            yield from held(x, need, first, after)

    def held(x: list[np.ndarray], need: np.ndarray, first: np.ndarray, after: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Each posting against the ``after`` ones from ``first`` on."""
        left, text, size = x[1:4]
        found, n, step = [], 0, 0
        at = np.flatnonzero(after >= 1)
        while len(at):
            b = first[at] + step
            ok = (np.minimum(left[at], left[b]) >= need[at] + need[b]) & (text[at] != text[b])
            ai, bi = at[ok], b[ok]
            total = size[ai] + size[bi]
            most = total - 2 * np.ceil(total * share - 1e-9)
            low = [x[k][ai] ^ x[k][bi] for k in range(4, 8)]
            hit = sum(np.bitwise_count(v.view(U)).astype(np.int64) for v in low) <= most
            ai, bi, low, most = ai[hit], bi[hit], [v[hit] for v in low], most[hit]
            up = [x[k][ai] ^ x[k][bi] for k in range(8, 12)]
            wide = (size[ai] >= WIDE) & (size[bi] >= WIDE)
            hit = ~wide | (sum(np.bitwise_count(v.view(U)).astype(np.int64) + np.bitwise_count((v ^ w).view(U)) for v, w in zip(up, low)) <= most)
            if hit.any():
                found.append((text[ai[hit]], text[bi[hit]]))
                n += len(found[-1][0])
            if n >= SENT:
                yield send(found)
                found, n = [], 0
            step += 1
            at = at[after[at] > step]
        if found:
            yield send(found)

    def collected() -> Iterator[list[np.ndarray]]:
        some: list[pa.RecordBatch] = []
        for batch in batches:
            some.append(batch)
            if sum(b.num_rows for b in some) >= TOGETHER:
                yield [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in some]) for i in range(len(names))]
                some = []
        if some:
            yield [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in some]) for i in range(len(names))]

    for x in collected():
        if rest is not None:
            x = [np.concatenate([r, y]) for r, y in zip(rest, x)]
        if not len(x[0]):
            continue
        cut = int(np.searchsorted(x[0], x[0][-1] & -2))  # the last key may go on in the next batch
        rest = [y[cut:] for y in x]
        if cut:
            yield from pairs([y[:cut] for y in x])
    if rest is not None:
        yield from pairs(rest)


def similar_texts(df: DataFrame, id_col: str, text: str, *, least: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Records with enough words by text (id, text: a hash of its words), and the pairs of similar texts (a, b)."""
    df = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    with shuffles_freed(df.sparkSession):
        return _similar_texts(df, least, similarity)


def _similar_texts(df: DataFrame, least: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    counts, cost = costs(df, "text", least)
    spark = df.sparkSession
    known = spark.sparkContext.broadcast(coded(counts))  # BUCKETS bytes
    n = rounds(df, known, cost, least, similarity, int(counts.sum()))

    def meet(i: int) -> DataFrame:
        def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for keep, w, h in _fresh(batches, "text", least):
                d, k, left, size, sign = keys(w, keep, known.value, cost, similarity)
                if n > 1:
                    now = mix(k >> U(1)) % U(n) == U(i)
                    d, k, left = d[now], k[now], left[now]
                # What differs within a text comes first: the rest of a row repeats the row before, and compresses to a few bytes.
                yield pa.RecordBatch.from_pydict({"key": pa.array(k.view(np.int64)), "left": pa.array(left.astype(np.int32)), "text": pa.array(h[d].view(np.int64)), "size": pa.array(size[d].astype(np.int32))} | {f"s{i}": pa.array(sign[d, i]) for i in range(8)})

        posted = df.select("text").mapInArrow(post, "key long, left int, text long, size int, " + ", ".join(f"s{i} long" for i in range(8)))
        return posted.repartition(F.shiftright("key", 1)).sortWithinPartitions("key", "size").mapInArrow(lambda it: _meet(it, similarity), "a long, b long")

    met = durable(meet(0).distinct())
    if n > 1:  # a pair may meet in more than one
        met = durable(reduce(DataFrame.unionByName, [met, *(durable(meet(i).distinct()) for i in range(1, n))]).distinct())

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for b in batches:
            for i in range(2):
                yield (b.column(i).to_numpy(zero_copy_only=False).view(U) >> U(64 - MARKS.bit_length() + 1)).astype(np.int64)

    wanted = spark.sparkContext.broadcast(np.packbits(gather(met.select("a", "b"), marks, MARKS) > 0))  # MARKS bits

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, seen = wanted.value, np.zeros(0, U)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for first, g in groups(column(b, "text")):
                w = words(g)
                keep = w.counts() >= least
                h = _texts(w)
                m = (h >> U(64 - MARKS.bit_length() + 1)).astype(np.int64)
                need = keep & ((marked[m >> 3] >> (7 - (m & 7)).astype(np.uint8)) & 1).astype(bool)
                # The set of a text goes out once from each task, however many its copies.
                once = np.zeros(w.n, bool)
                once[np.unique(h, return_index=True)[1]] = True
                need &= once & ~np.isin(h, seen)
                seen = np.union1d(seen, h[need])
                d, s = _shingles(w, need)
                n = np.bincount(d, minlength=w.n)
                at = pa.array(np.concatenate([[0], np.cumsum(n)])[np.append(np.flatnonzero(keep), w.n)].astype(np.int32))
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids[first : first + w.n][keep]), "text": pa.array(h[keep].view(np.int64)), "set": pa.ListArray.from_arrays(at, pa.array(s.view(np.int64)))})

    of = durable(df.mapInArrow(members, "id long, text long, set array<long>"))
    sets = of.where("size(set) > 0").groupBy("text").agg(F.min_by("set", "id").alias("set"))
    both = met.join(sets.withColumnsRenamed({"text": "a", "set": "sa"}), "a").join(sets.withColumnsRenamed({"text": "b", "set": "sb"}), "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    similar = both.select("a", "b", inter.alias("i"), (F.size("sa") + F.size("sb") - inter).alias("u")).where(F.col("i") >= F.col("u") * similarity).select("a", "b")
    return of.select("id", "text").distinct(), durable(similar)


def near_classes(df: DataFrame, id_col: str, text: str, *, least: int = 20, similarity: float = 0.5) -> DataFrame:
    """rec_id, class_id, links: of every record with ``least`` or more words, the least id of its text's copies and how many
    other texts are similar to it. Copies aren't made into pairs, so a text of any number of copies costs a row each."""
    ids, similar = similar_texts(df, id_col, text, least=least, similarity=similarity)
    links = similar.select(F.explode(F.array("a", "b")).alias("text")).groupBy("text").agg(F.count("*").alias("links"))
    texts = ids.groupBy("text").agg(F.min("id").alias("class_id")).join(links, "text", "left")
    return ids.join(texts, "text").select(F.col("id").alias("rec_id"), "class_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def near_links(df: DataFrame, id_col: str, text: str, *, least: int = 20, similarity: float = 0.5) -> DataFrame:
    """``class_a``, ``class_b`` (smaller first): the similar pairs of different texts, each text as the class of near_classes."""
    ids, similar = similar_texts(df, id_col, text, least=least, similarity=similarity)
    of = ids.groupBy("text").agg(F.min("id").alias("c"))
    both = similar.join(of.withColumnsRenamed({"text": "a", "c": "ca"}), "a").join(of.withColumnsRenamed({"text": "b", "c": "cb"}), "b")
    # One record may come with two texts, so that both have it as their class.
    return both.select(F.least("ca", "cb").alias("class_a"), F.greatest("ca", "cb").alias("class_b")).where("class_a < class_b").distinct()


def near_groups(df: DataFrame, id_col: str, text: str, *, least: int = 20, similarity: float = 0.5) -> DataFrame:
    """rec_id, group_id: of every record with ``least`` or more words, the least id that a chain of similar texts (or copies) leads to."""
    ids, similar = similar_texts(df, id_col, text, least=least, similarity=similarity)
    of = durable(ids.groupBy("text").agg(F.min("id").alias("c")))
    edges = similar.join(of.withColumnsRenamed({"text": "a", "c": "u"}), "a").join(of.withColumnsRenamed({"text": "b", "c": "v"}), "b").select("u", "v")
    lead = components(edges)
    texts = of.join(lead, of.c == lead.node, "left").select("text", F.coalesce("root", "c").alias("group_id"))
    return ids.join(texts, "text").groupBy(F.col("id").alias("rec_id")).agg(F.min("group_id").alias("group_id"))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of its connected component, for every node with an edge to another. ``edges``: u, v (long).

    Large and small stars in turn (each a minimum by node and a join): the larger neighbours of a node are linked to its least neighbour,
    then the smaller ones, until nothing changes. Every round is written down; only a count and a sum come to the driver.
    """
    now = durable(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = durable(small)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state


def near_pairs(df: DataFrame, id_col: str, text: str, *, least: int = 20, similarity: float = 0.5) -> DataFrame:
    """``id_a``, ``id_b`` (smaller first): every pair of records with ``least`` or more words each whose shingle sets
    have a Jaccard similarity of at least ``similarity``. See the module for what is complete, and for nulls and copies.
    """
    ids, similar = similar_texts(df, id_col, text, least=least, similarity=similarity)
    # Pairs of records: of similar texts, and of the copies of one text. A text with many copies is cut into parts of
    # about PART records, and what meets it goes to each part, so no task holds all copies.
    parts = ids.groupBy("text").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"), F.count("*").alias("n"))
    placed = ids.join(parts, "text").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))

    def to_parts(df: DataFrame, text: str) -> DataFrame:
        k = parts.select(F.col("text").alias(text), "parts")
        return df.join(k, text).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def side(text: str, to: str) -> DataFrame:
        return placed.select(F.col("id").alias(to), F.col("text").alias(text), "part")

    across = to_parts(similar, "a").join(side("a", "x"), ["a", "part"]).drop("part")
    across = to_parts(across, "b").join(side("b", "y"), ["b", "part"]).select("x", "y")
    copies = placed.where("n > 1")
    within = to_parts(copies.select("id", "text"), "text").withColumnRenamed("id", "x").join(copies.select("text", "part", F.col("id").alias("y")), ["text", "part"]).where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).where("id_a < id_b").distinct()
