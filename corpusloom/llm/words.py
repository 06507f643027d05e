"""Vectorised words: whole Arrow batches of texts become flat arrays of word hashes and characters.

Words are the maximal runs of letters and digits after NFKC, removal of format
characters (Cf) and lower-casing. A null text has no words.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
#: Texts are worked on in groups of about so many characters, so that memory doesn't follow the batch size.
GROUP_CHARS = 1_500_000
#: Multiplier of the positional hash within a word, and of the combination of words.
STEP, LINK = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter or digit, is it a format character."""
    every = list(map(chr, range(0x110000)))
    alnum = np.fromiter((x.isalnum() for x in every), bool, len(every))
    form = np.fromiter((unicodedata.category(x) == "Cf" for x in every), bool, len(every))
    return alnum, form


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits (public splitmix64 finaliser)."""
    t = x >> U(30)
    x = x ^ t
    x *= U(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, U(27), out=t)
    x *= U(0x94D049BB133111EB)
    x ^= np.right_shift(x, U(31), out=t)
    return x


@dataclass
class Words:
    """``n`` texts; the words of all in order, and for each its text and where it lies in ``codes``."""

    n: int
    codes: np.ndarray  # lower-cased characters, texts divided by 0
    hashes: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)

    def normal(self) -> tuple[np.ndarray, np.ndarray]:
        """The words joined by single spaces (32), and where each begins there."""
        at = np.cumsum(self.length + 1) - (self.length + 1)
        out = np.full(int((self.length + 1).sum()), 32, np.uint32)
        within = np.arange(int(self.length.sum())) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        out[np.repeat(at, self.length) + within] = self.codes[np.repeat(self.start, self.length) + within]
        return out, at


def words(texts: list[str | None]) -> Words:
    """All words of the texts. Surrogates can't occur in Arrow strings; a NUL in a text counts as a blank."""
    alnum, form = tables()
    s = "\0".join((t.replace("\0", " ") if "\0" in t else t) if t else "" for t in texts)
    plain = s.isascii()
    if not plain:
        s = unicodedata.normalize("NFKC", s)
        c = np.frombuffer(s.encode("utf-32-le"), np.uint32)
        if form[c].any():
            s = c[~form[c]].tobytes().decode("utf-32-le")
    s = s.lower()
    c = np.frombuffer(s.encode("ascii"), np.uint8).astype(np.uint32) if plain else np.frombuffer(s.encode("utf-32-le"), np.uint32)
    a = alnum[c]
    edge = np.diff(a.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(len(texts), c, np.zeros(0, U), none, none, none)
    length = end - start
    at = np.flatnonzero(a)
    first = np.cumsum(length) - length
    within = np.arange(len(at)) - np.repeat(first, length)
    power = np.cumprod(np.full(int(length.max()), STEP, U))
    value = mix(c[at].astype(U) + U(0x1234567)) * power[within]
    h = mix(np.add.reduceat(value, first) + length.astype(U))
    return Words(len(texts), c, h, np.cumsum(c == 0)[start], start, length)


def chains(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for k consecutive words from each word on, and whether they lie in one text."""
    n = max(0, len(w.hashes) - k + 1)
    g = np.zeros(n, U)
    for i in range(k):
        g = mix(g * LINK + w.hashes[i : n + i])
    return g, w.doc[:n] == w.doc[k - 1 : n + k - 1]


def groups(texts: Iterable[str | None], most: int = GROUP_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about ``most`` characters, each with the place of its first; a longer text comes alone."""
    now: list[str | None] = []
    first = size = i = 0
    for i, t in enumerate(texts):
        if now and size + len(t or "") > most:
            yield first, now
            now, first, size = [], i, 0
        now.append(t)
        size += len(t or "") + 1
    if now:
        yield first, now


def column(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
