"""The language of texts and of each segment of texts that mix languages, with a confidence.

Method: hyperdimensional profiles. Every letter has a random vector of ``DIM`` signs. A trigram of a word (its edges
count as a letter) is bound from its letters' vectors, permuted by their place: roll(a, 2) * roll(b, 1) * c. Trigrams
are bundled, i.e. added up, into vectors of languages (from labelled samples, each trigram weighed by how much likelier it is
there than elsewhere) and of texts, and those are compared by cosine, after the languages' common part is taken off.

A cosine is linear in a text's trigrams, so the products of every possible trigram with every language are a table of
fixed size, (ALPHABET ** 3) x languages, made once; only the table goes to the workers. A word has the sum of its
trigrams; the best sequence of languages over the words of a text, with a cost for each change (less at the end of a
sentence), gives the segments (Viterbi). Formulas, code, links and numbers hold no language and count as no words.

Null and blank texts, and those without letters, have no language and give no row. Whole texts are read, and the best sequence is that of
the whole text, however long. Repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.words import column, groups, tables

ALPHABET, DIM, SMOOTH = 64, 16384, 0.5
#: Cost of a change of language within and at the end of a sentence (an average word leads by one): the highest with which passages of six words
#: set into English are found, which is far above what English itself reaches. A word counts for at most CLIP either way.
SWITCH, SENTENCE, CLIP = 1.5, 0.75, 2.0
#: Words with letters that a passage needs; its other words may be numbers.
LETTERED = 4
#: Rows of the labelled samples that are used at most, by language; the only bound on what is fitted.
SAMPLES = 5000
FORMULA = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`|\$\$.*?\$\$|\$[^$\n]*\$|\\\[.*?\\\]|\\\(.*?\\\)|\\[a-zA-Z]+(?:\{[^{}\n]*\})*|<[^<>\n]*>|https?://\S+|\S+@\S+", re.S)

# Letters that are words in the languages.
LONE = np.array([ord(x) for x in "aeiouywzàèéìòóùá"], np.uint32)
# Names of languages in labels.
NAMES = {
    "en": ("eng", "english"), "de": ("deu", "ger", "german"), "fr": ("fra", "fre", "french"), "es": ("spa", "spanish"), "it": ("ita", "italian"), "nl": ("nld", "dut", "dutch"), "pl": ("pol", "polish"),
    "pt": ("por", "portuguese"), "sv": ("swe", "swedish"), "da": ("dan", "danish"), "fi": ("fin", "finnish"), "cs": ("ces", "cze", "czech"), "ru": ("rus", "russian"), "tr": ("tur", "turkish"), "ro": ("ron", "rum", "romanian"),
}


def named(label: str | None) -> str | None:
    """The two-letter code that a label names: case, region, three-letter codes and English names make no difference."""
    x = re.split(r"[-_]", (label or "").strip().lower())[0].strip()
    if x in NAMES:
        return x
    return next((k for k, v in NAMES.items() if x in v), None)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@dataclass
class Profiles:
    languages: list[str]
    symbol: dict[int, int]  # code point: 1..ALPHABET-2; 0 is a word's edge, ALPHABET-1 any other letter
    table: np.ndarray  # (ALPHABET ** 3, languages)
    spread: float  # cosine of a text with its language, about


def _split(text: str) -> str:
    return FORMULA.sub("   ", text) if any(x in text for x in "$\\`<@") or "http" in text else text


def trigrams(texts: list[str | None], symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram ids of all letters; of each word the first letter, the text, whether a sentence ended before it, and how many words
    of any kind (numbers, letters alone) begin up to it."""
    s = "\0".join(_split(t.replace("\0", " ")) if t else "" for t in texts)
    if not s.isascii():
        s = unicodedata.normalize("NFKC", s)
        raw = np.frombuffer(s.encode("utf-32-le"), np.uint32)
        s = raw[~tables()[1][raw]].tobytes().decode("utf-32-le")
    c = np.frombuffer(s.lower().encode("utf-32-le"), np.uint32)
    a = _letters()[c]
    edge = np.diff(a.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    some = tables()[0][c]
    every = np.cumsum(np.diff(some.astype(np.int8), prepend=np.int8(0)) == 1)
    # A letter alone is a variable, unless it is a word somewhere.
    ok = (end - start > 1) | np.isin(c[start], LONE)
    a[start[~ok]] = False
    start, end = start[ok], end[ok]
    n = end - start
    at = np.flatnonzero(a)
    sym = symbol[c[at]].astype(np.int32)
    first = np.cumsum(n) - n
    before, after = np.roll(sym, 1), np.roll(sym, -1)
    before[first] = 0
    after[first + n - 1] = 0
    stop = np.cumsum((c == 46) | (c == 33) | (c == 63) | (c == 10) | (c == 0x2028) | (c == 58) | (c == 59))
    ends = np.diff(stop[start], prepend=0) > 0
    return (before * ALPHABET + sym) * ALPHABET + after, first, np.cumsum(c == 0)[start], ends, every[start]


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Profiles:
    """Profiles from (language, text) rows."""
    sym = fit_symbols(rows)
    table = symbols(sym)
    langs = sorted({k for k, _ in rows})
    n = np.zeros((ALPHABET**3, len(langs)), np.float32)
    for i, k in enumerate(langs):
        g, *_ = trigrams([t for lang, t in rows if lang == k], table)
        n[:, i] = np.bincount(g, minlength=ALPHABET**3)
    used = np.flatnonzero(n.any(1))
    weight = np.log((n[used] + SMOOTH) / (n.sum(0) + SMOOTH * max(1, len(used))))
    weight -= weight.mean(1, keepdims=True)
    rng = np.random.default_rng(seed)
    base = rng.choice(np.array([-1, 1], np.float32), (ALPHABET, DIM))
    two, one = np.roll(base, 2, 1), np.roll(base, 1, 1)
    bundle = np.zeros((len(langs), DIM), np.float32)
    for at in range(0, len(used), 1024):
        g = used[at : at + 1024]
        bundle += weight[at : at + 1024].T @ (two[g // ALPHABET**2] * one[g // ALPHABET % ALPHABET] * base[g % ALPHABET])
    bundle -= bundle.mean(0)
    bundle /= np.linalg.norm(bundle, axis=1, keepdims=True) + 1e-9
    # The products of all trigrams that begin with one letter with all languages are one product of matrices.
    last = (base[:, None, :] * bundle[None]).reshape(-1, DIM).T
    out = np.concatenate([(two[i] * one) @ last for i in range(ALPHABET)]).reshape(ALPHABET**3, len(langs))
    return Profiles(langs, sym, out, _scale(out, rows, langs, table))


def fit_bayes(rows: list[tuple[str, str]], smooth: float = 0.2) -> Profiles:
    """Like ``fit``, but the table holds the trigrams' log-likelihoods in each language (naive Bayes), scaled the same way."""
    x = fit_symbols(rows)
    table = symbols(x)
    langs = sorted({k for k, _ in rows})
    out = np.zeros((ALPHABET**3, len(langs)), np.float32)
    for i, k in enumerate(langs):
        g, *_ = trigrams([t for lang, t in rows if lang == k], table)
        n = np.bincount(g, minlength=ALPHABET**3) + smooth
        out[:, i] = np.log(n / n.sum())
    out -= out.mean(1, keepdims=True)
    spread = _scale(out, rows, langs, table)
    return Profiles(langs, x, out, spread)


def fit_symbols(rows: list[tuple[str, str]]) -> dict[int, int]:
    """The most frequent letters of the samples; ties by letter."""
    from collections import Counter

    seen = Counter(ch for _, t in rows for ch in unicodedata.normalize("NFC", t).lower() if ch.isalpha())
    return {ord(ch): i + 1 for i, (ch, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[: ALPHABET - 2])}


def _scale(out: np.ndarray, rows: list[tuple[str, str]], langs: list[str], table: np.ndarray) -> float:
    """Scales the table so that an average word leads in its own language by about one; gives the lead before."""
    lead = []
    for i, k in enumerate(langs):
        g, first, *_ = trigrams([t for lang, t in rows if lang == k], table)
        if len(first) and len(langs) > 1:
            w = np.add.reduceat(out[g], first, axis=0)
            lead.append((w[:, i] - np.delete(w, i, 1).mean(1)).mean())
    mean = float(np.mean(lead)) if lead else 1.0
    out /= max(1e-6, mean)
    return mean


def symbols(sym: dict[int, int]) -> np.ndarray:
    x = np.full(0x110000, ALPHABET - 1, np.int8)
    x[list(sym)] = list(sym.values())
    return x


def decode(score: np.ndarray, doc: np.ndarray, ends: np.ndarray, switch: float | None = None) -> np.ndarray:
    """The language of every word: the best sequence within each text."""
    n, k = score.shape
    inside, between = (SWITCH, SENTENCE) if switch is None else (switch, switch / 2)
    if not n:
        return np.zeros(0, np.int8)
    new = np.ones(n, bool)
    new[1:] = doc[1:] != doc[:-1]
    starts = np.flatnonzero(new)
    length = np.diff(np.append(starts, n))
    o = np.argsort(-length, kind="stable")
    starts, length = starts[o], length[o]
    most = int(length[0])
    back = np.zeros((n, k), np.int8)
    v = score[starts].copy()
    live = np.searchsorted(-length, -np.arange(most), "left")  # how many have more than t words
    last = v.copy()
    for t in range(1, most):
        m = live[t]
        at = starts[:m] + t
        v = v[:m]
        best = v.argmax(1)
        move = v[np.arange(m), best] - np.where(ends[at], between, inside)
        stay = v >= move[:, None]
        back[at] = np.where(stay, np.arange(k, dtype=np.int8), best[:, None].astype(np.int8))
        v = np.where(stay, v, move[:, None]) + score[at]
        last[:m] = v
    path = np.zeros(n, np.int8)
    state = last.argmax(1)
    for t in range(most - 1, -1, -1):
        m = live[t]
        at = starts[:m] + t
        path[at] = state[:m]
        state[:m] = back[at, state[:m]] if t else state[:m]
    return path


def segments(x: Profiles, sym: np.ndarray, texts: list[str | None], switch: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every segment in order (a change costs ``switch``; null: SWITCH): text, language (its place in ``x.languages``), words with letters, confidence, and all words."""
    g, first, doc, ends, every = trigrams(texts, sym)
    if not len(first):
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(float), z
    raw = x.table[g]
    score = np.add.reduceat(raw, first, axis=0)
    score = np.clip(score - score.mean(1, keepdims=True), -CLIP, CLIP)
    path = decode(score, doc, ends, switch)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (path[1:] != path[:-1])
    s = np.flatnonzero(new)
    total = np.add.reduceat(score, s, axis=0)
    n = np.diff(np.append(s, len(doc)))
    p = np.exp(total - total.max(1, keepdims=True))
    return doc[s], path[s].astype(np.int64), n, (p / p.sum(1, keepdims=True))[np.arange(len(s)), path[s]], every[s + n - 1] - every[s] + 1


def sampled(samples: DataFrame, lang: str = "lang", text: str = "text") -> list[tuple[str, str]]:
    """(language, text) of labelled samples; of each language at most SAMPLES rows, the first by hash."""
    from pyspark.sql import Window

    of = Window.partitionBy("k").orderBy(F.xxhash64("t"), "t")
    rows = samples.select(F.col(lang).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null").withColumn("n", F.row_number().over(of)).where(F.col("n") <= SAMPLES)
    return sorted((r.k, r.t) for r in rows.select("k", "t").collect())


def profiles(samples: DataFrame, lang: str = "lang", text: str = "text", bayes: bool = False) -> Profiles:
    """Profiles (or naive Bayes tables) from labelled samples."""
    return (fit_bayes if bayes else fit)(sampled(samples, lang, text))


def language_segments(df: DataFrame, known: Profiles, *, id_col: str, fields: tuple[str, ...], label: str | None = None) -> DataFrame:
    """A row for every segment: rec_id, field, segment (from 0), lang, words, lettered (those that aren't numbers or letters alone),
    confidence (0..1), label (what the record's label names, null if nothing). A text in one language is one segment."""
    sent = df.sparkSession.sparkContext.broadcast(known)  # ALPHABET ** 3 numbers a language
    schema = "rec_id long, field string, segment int, lang string, words int, lettered int, confidence double, label string"
    src = df.select(F.col(id_col).cast("long").alias("rec_id"), (F.col(label) if label else F.lit(None)).cast("string").alias("label"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = sent.value
        sym, names = symbols(x.symbol), np.array([*x.languages, ""], object)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            of = {v: named(v) for v in set(column(b, "label"))}
            labels = np.array([of[v] for v in column(b, "label")], object)
            for i, f in enumerate(fields):
                for first, g in groups(column(b, f"f{i}")):
                    doc, lang, n, conf, every = segments(x, sym, g)
                    start = np.searchsorted(doc, doc)
                    at = doc + first
                    yield pa.RecordBatch.from_pydict(
                        {
                            "rec_id": pa.array(ids[at], pa.int64(), from_pandas=True), "field": pa.array([f] * len(doc), pa.string()), "segment": pa.array((np.arange(len(doc)) - start).astype(np.int32)),
                            "lang": pa.array(names[lang], pa.string()), "words": pa.array(every.astype(np.int32)), "lettered": pa.array(n.astype(np.int32)), "confidence": pa.array(conf.astype(np.float64)), "label": pa.array(labels[at], pa.string()),
                        }
                    )

    return src.mapInArrow(run, schema)


def wrong_labels(df: DataFrame, known: Profiles, *, id_col: str, fields: tuple[str, ...], label: str, least: int = 6) -> DataFrame:
    """rec_id, field, lang: texts with a passage of ``least`` or more words in a language that the label doesn't name."""
    s = language_segments(df, known, id_col=id_col, fields=fields, label=label)
    return s.where((F.col("words") >= least) & (F.col("lettered") >= min(least, LETTERED)) & ~F.col("lang").eqNullSafe(F.col("label"))).select("rec_id", "field", "lang").distinct()
