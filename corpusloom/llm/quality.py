"""Statistics of each text, and from them whether it is natural prose, a list, a table or junk.

Method: length, symbol, punctuation, bullet and common-word statistics of all texts of an Arrow batch are computed at once
(NumPy over the characters), then fixed thresholds apply, and every rule that fails is recorded as a reason.

* The rules on a whole text (``PUBLISHED``) are the published ones of large web corpora: mean word length 3 to 10, at most 0.1 symbols a word,
  80 % of words with a letter, two common words, at most 90 % bullet lines, more than 12 % of lines ending in punctuation.
  A text that fails none of them is prose.
* The others are judged by their lines, without formulas and code, weighed by their characters: a line is a row (cells), an entry (few words), a
  sentence or noise. The rules are that sentences hold ``PROSE`` of the characters, that no ``MOST`` of six or more lines are entries or
  rows, that words aren't repeated over and over, and that sentences hold common words. A text that fails one is what most of its
  characters stand in: a list, a table or junk.

Words, symbols and lines are those of the whole text as it is, after NFKC and without format characters.

Null and blank texts (blanks and format characters only) get no row. Repeated rows give repeated results; extra
columns are ignored; whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.languages import FORMULA
from corpusloom.llm.words import column, groups, tables, words

# Frequent words of seven languages.
COMMON = (
    "the of and to in is that it for was on are as with his they be at one have this from or had by not but what all were when we there can an your which their if will each about how up out them then so some would into has more her two like him see could no than first been its who now did get may over only after with because until both so said once "
    "der die das den dem des ein eine einen und ist nicht sich mit auf für von zu im am an als auch es nach wie aus bei dass oder aber vor sind waren noch nur bis ob wenn so weiter etwa dann ohne unter durch hat man "
    "le la les de des du un une et est en que qui dans pas pour au aux sur avec par ce se il elle ne plus son sa ses ou mais on nous sont fait puis sans sous après avant encore si dont soir "
    "el los las una y es por con para se del al lo como más pero sus su este ya entre cuando muy sin sobre también hasta hay donde desde todo unas veces luego si todavía tras bajo que no "
    "il gli uno di da che non è per si dei della nel alla sono più ma anche come ha ne sua tra dopo prima senza sotto poi dal fatto questo ancora se circa volte alla "
    "het een van dat niet zijn op te met aan voor er om dan maar ook bij nog uit naar wordt door over als werd tot onder na geeft ongeveer keer men daarvan "
    "nie się na do jest to że jak ale po od za przez tak już tylko czy przy dla o oraz który która które jego jej ich był była było być może potem około razy jeszcze dlatego dziś pod bez mimo według obok kiedy ile cała cały zanim nich zostało końcu początku"
).split()
# Words that stand for page furniture and missing values.
FURNITURE = "undefined nan null none nbsp loading click here img png jpg gif item items login logout print help home more menu share next back top terms cookie cookies javascript br div span href lt gt amp quot previous prev search subscribe copyright sitemap contact about".split()
BREAKS = np.array([0, 10, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029], np.uint32)
BOX = re.compile(r"^\s*[-+*•]?\s*\[[ xX]?\]\s", re.M)
STOPS = np.array([ord(x) for x in ".!?…。！？\"”’'»:"], np.uint32)
CLOSE = np.array([ord(x) for x in ")]}*_`"], np.uint32)
ENTRY_WORDS, LEAST_LINES, PROSE, READABLE = 5, 3, 0.5, 0.03
#: A list or table below a long sentence: so many entries or rows, of the lines, and of the characters.
MANY, MOST, NEARLY = 6, 0.75, 0.35
MEASURES = "doc_id long, words int, mean_word_length double, symbol_ratio double, punctuated_lines double, bullet_lines double, common_words double"
SCHEMA = MEASURES + ", sentences double, entries double, rows double, noise double, kind string, reasons array<string>"
BULLETS = "-+*•‣◦–—·▪(["


@lru_cache(1)
def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: is it a letter, a digit, a blank."""
    every = list(map(chr, range(0x110000)))
    return tuple(np.fromiter((getattr(x, f)() for x in every), bool, len(every)) for f in ("isalpha", "isdigit", "isspace"))


class Lines:
    """Texts as lines: what both the statistics and the kinds are made of."""

    def __init__(self, texts: list[str | None]) -> None:
        self.w = w = words(texts)
        self.c = c = w.codes
        self.n = len(texts)
        self.brk = np.isin(c, BREAKS)
        self.line = line = np.cumsum(self.brk)  # a break belongs to the line that it opens
        self.k = k = int(line[-1]) + 1 if len(c) else 1
        self.doc_of = np.zeros(k, np.int64)
        self.doc_of[line[np.flatnonzero(c == 0)]] = 1
        self.doc_of = np.cumsum(self.doc_of)
        letter, digit, blank = _classes()
        self.alpha, self.digit, self.space = letter[c], digit[c], blank[c] | (c == 0)
        self.symbol = ~(tables()[0][c] | self.space)
        self.solid = self.per(~self.space)
        self.full = self.solid > 0
        # The last and first characters that aren't blank (or closing).
        edge = np.flatnonzero(~self.space & ~np.isin(c, CLOSE))
        last = np.zeros(k, np.uint32)
        last[line[edge]] = c[edge]
        self.ends = np.isin(last, STOPS) & self.full
        at = np.flatnonzero(~self.space)[::-1]
        self.first, second = np.zeros(k, np.uint32), np.zeros(k, np.uint32)
        self.first[line[at]] = c[at]
        second[line[at]] = np.append(c[1:], 0)[at]
        marks = np.array([ord(x) for x in BULLETS], np.uint32)
        self.bullet = self.full & (np.isin(self.first, marks) | ((self.first >= 48) & (self.first <= 57) & np.isin(second, np.array([46, 41, *range(48, 58)], np.uint32))))
        self.real = (w.length >= 2) & self.alpha[w.start] if len(w.start) else np.zeros(0, bool)

    def per(self, m: np.ndarray) -> np.ndarray:
        return np.bincount(self.line, m, self.k)

    def count(self, m: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc_of, m, self.n)


def statistics(x: Lines, common: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Which texts aren't blank; the statistics of each; and which published rules it fails."""
    w, n = x.w, x.n
    total = w.counts()
    some, lines = np.maximum(total, 1), np.maximum(x.count(x.full), 1)
    real = np.bincount(w.doc, x.real, n)
    usual = np.bincount(w.doc, x.real & np.isin(w.hashes, common), n)
    lettered = np.zeros(n)
    if len(w.start):
        seen = np.concatenate([[0], np.cumsum(x.alpha)])
        lettered = np.bincount(w.doc, seen[w.start + w.length] > seen[w.start], n)
    m = {"words": total, "mean_word_length": np.bincount(w.doc, w.length, n) / some, "symbol_ratio": x.count(x.per(x.symbol)) / some, "punctuated_lines": x.count(x.ends) / lines, "bullet_lines": x.count(x.bullet) / lines, "common_words": usual / np.maximum(real, 1)}
    mean = m["mean_word_length"]
    fails = {"mean_word_length": (mean < 3) | (mean > 10), "symbol_ratio": m["symbol_ratio"] > 0.1, "few_letters": lettered < 0.8 * total, "few_common_words": usual < 2, "bullet_lines": m["bullet_lines"] > 0.9, "unpunctuated_lines": m["punctuated_lines"] <= 0.12}
    return x.count(x.full) > 0, m, fails


PUBLISHED = ("mean_word_length", "symbol_ratio", "few_letters", "few_common_words", "bullet_lines", "unpunctuated_lines")


def _hashes(ws: list[str]) -> np.ndarray:
    return np.unique(words([" ".join(ws)]).hashes)


def measure(texts: list[str | None], common: np.ndarray, furniture: np.ndarray) -> list[tuple]:
    """Of every text with more than blanks: its place, the statistics, shares of kinds of lines, kind and reasons."""
    shown, m, fails = statistics(Lines(texts), common)
    x = Lines([BOX.sub("- ", FORMULA.sub(" ", t) if any(q in t for q in "$\\`<") else t) if t else t for t in texts])
    w, c, n, k, line, doc_of, brk = x.w, x.c, x.n, x.k, x.line, x.doc_of, x.brk
    alpha, digit, space, symbol, per, solid = x.alpha, x.digit, x.space, x.symbol, x.per, x.solid
    letters, digits, symbols = per(alpha), per(digit), per(symbol)
    nxt, prv = np.append(c[1:], 0), np.append(0, c[:-1])
    nsp, psp = np.append(space[1:], True), np.append(True, space[:-1])
    pipes, tabs = per(c == 124), per((c == 9) & ~psp)
    gaps = per((c == 32) & (nxt == 32) & ~psp & ~brk)
    commas = per(((c == 44) | (c == 59)) & ~nsp & ~psp)
    cells = per((c == 38) & (prv == 32) & (nxt == 32))
    # A symbol with a letter on either side, other than what stands between words.
    within = per(symbol & ~np.isin(c, np.array([ord(x) for x in "'’-–—.,:()/\"“”„«»…"], np.uint32)) & (np.append(alpha[1:], False) | np.append(False, alpha[:-1])) & (c != 124))
    damaged = per(np.isin(c, np.array([0xE2, 0xE3, 0x20AC, 0xFFFD], np.uint32)))
    # Words by line.
    wl = line[w.start] if len(w.start) else np.zeros(0, np.int64)
    real = x.real
    usual, fittings = np.isin(w.hashes, common), np.isin(w.hashes, furniture)
    real_n = np.bincount(wl, real, k)
    common_n = np.bincount(wl, usual & real, k)
    fit_n = np.bincount(wl, fittings | ~real, k)
    all_n = np.bincount(wl, minlength=k)
    longest = np.zeros(k)
    np.maximum.at(longest, wl, w.length)
    full, ends, bullet, first = x.full, x.ends, x.bullet, x.first
    share = common_n / np.maximum(real_n, 1)
    sepa = np.maximum.reduce([pipes - 1, tabs, gaps, commas, cells, np.where((first == 43) & (symbols > 0.8 * solid), 3, 0)])
    broken = (within > 0.06 * np.maximum(letters, 1)) & (within >= 2)
    row = full & ~broken & (((pipes >= 2) | (tabs >= 1) | (cells >= 1) | ((gaps >= 1) & (gaps >= 0.4 * (all_n - 1))) | (commas >= 1)) & ((share < 0.15) | (real_n <= 2 * (sepa + 1)) & (share < 0.34)) & (real_n <= 4 * (sepa + 1)) | ((symbols > 0.8 * solid) & (solid > 3) & ((pipes >= 2) | (first == 43) | (first == 124))))
    bad = full & ~row & ((letters == 0) & (digits == 0) | (digits + symbols > letters) & (real_n <= 4) & (digits > 4) & (symbols > 4) | (longest > 45) & ((real_n < 6) | (share < 0.05)) | (all_n > 0) & (fit_n == all_n) & (fit_n > 0) & (np.bincount(wl, fittings, k) > 0) | broken | (damaged > 0.03 * np.maximum(letters, 1)) & (damaged >= 4))
    entry = full & ~row & ~bad & (real_n <= ENTRY_WORDS)
    sentence = full & ~row & ~bad & ~entry
    # The last line of a wrapped sentence may be short.
    goes_on = np.zeros(k, bool)
    goes_on[1:] = entry[1:] & ~bullet[1:] & sentence[:-1] & ~ends[:-1] & (doc_of[1:] == doc_of[:-1])
    entry, sentence = entry & ~goes_on, sentence | goes_on
    # One overlong word counts like a short one.
    weight = np.where(longest > 45, np.maximum(solid - longest, 10), solid)
    weigh = lambda m: np.bincount(doc_of, weight * m, n)
    count = x.count
    total, S, E, T, J = (weigh(m) for m in (full, sentence, entry, row, bad))
    lines, rows, entries = count(full), count(row), count(entry)
    words_n = w.counts()
    real_d, common_d = count(real_n * 1.0), count(common_n * 1.0)
    distinct = np.zeros(n)
    o = np.lexsort((w.hashes, w.doc))
    if len(o):
        d, h = w.doc[o], w.hashes[o]
        new = np.ones(len(o), bool)
        new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
        distinct = np.bincount(d[new], minlength=n)
    said = count(np.where(sentence, real_n, 0.0)), count(np.where(sentence, common_n, 0.0))
    readable = said[1] >= READABLE * np.maximum(said[0], 1)
    out = []
    for i in np.flatnonzero(shown).tolist():
        s, e, r, j = S[i], E[i], T[i], J[i]
        reasons = [name for name in PUBLISHED if fails[name][i]]
        judged = bool(reasons)
        if total[i] == 0:
            s = 1.0  # nothing but formulas
        repeated = words_n[i] >= 20 and distinct[i] < 0.08 * words_n[i]
        if repeated:
            reasons.append("repeated_words")
        if s and not readable[i] and said[0][i] >= 6:
            reasons.append("unreadable_sentences")
            j, s = j + s, 0.0
        if rows[i] < LEAST_LINES and r:
            j, r = j + r, 0.0
        whole = max(total[i], 1e-9)
        many = [(kind, name) for kind, name, k, y in (("list", "many_entries", entries[i], e), ("table", "many_rows", rows[i], r)) if k >= MANY and k >= MOST * lines[i] and y >= NEARLY * total[i]]
        if s < PROSE * whole:
            reasons.append("few_sentences")
        reasons += [name for _, name in many]
        if repeated:
            kind = "junk"
        elif not judged or s >= PROSE * whole and not many:
            kind = "prose"
        else:
            kind = many[0][0] if many else max((("list", e if entries[i] >= LEAST_LINES else 0.0), ("table", r), ("junk", j), ("prose", s)), key=lambda z: z[1])[0]
            if entries[i] < LEAST_LINES and e > max(s, r, j):
                kind = "prose"
        out.append((i, int(m["words"][i]), *(float(m[z][i]) for z in ("mean_word_length", "symbol_ratio", "punctuated_lines", "bullet_lines", "common_words")), *(float(min(1.0, z / whole)) for z in (s, e, r, j)), kind, reasons))
    return out


def measures(df: DataFrame, *, id_col: str, text: str) -> DataFrame:
    """doc_id, words, mean_word_length, symbol_ratio (symbols a word), punctuated_lines and bullet_lines (shares of lines), common_words (share of words of
    two letters and more), fails (the published rules that fail, by comma), of every text not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = _hashes(COMMON)
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for first, g in groups(column(b, "text")):
                shown, m, fails = statistics(Lines(g), common)
                at = np.flatnonzero(shown)
                said = [",".join(name for name in PUBLISHED if fails[name][i]) for i in at.tolist()]
                cols = [pa.array(ids[first + at], pa.int64(), from_pandas=True), pa.array(m["words"][at].astype(np.int32)), *(pa.array(m[z][at].astype(np.float64)) for z in list(m)[1:]), pa.array(said, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *m, "fails"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, MEASURES + ", fails string")


def quality(df: DataFrame, *, id_col: str, text: str) -> DataFrame:
    """What ``measures`` says, with the shares of characters in sentences, entries, rows and noise, kind (prose, list, table, junk) and
    reasons (rules that fail), of every text not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, furniture = _hashes(COMMON), _hashes(FURNITURE)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        types = [pa.int64(), pa.int32(), *[pa.float64()] * 9, pa.string(), pa.list_(pa.string())]
        for b in batches:
            ids = b.column(0).to_pylist()
            for first, g in groups(column(b, "text")):
                got = measure(g, common, furniture)
                cols = [[ids[first + r[0]] for r in got], *([r[i] for r in got] for i in range(1, len(names)))]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types)], names)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA)
