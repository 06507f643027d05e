"""Records whose response is no proper reply to the instruction, with the type of the defect.

Method: language posteriors of instruction and response from character n-gram naive Bayes are compared
(other_language), and the likelihood of ending where it ends, from n-grams of characters before the ends of sentences
in the whole corpus, flags a truncated response that has no mark at its end. A refusal is a response whose sentences, other than
polite ones and the instruction's own, decline the task by a naive Bayes model of words (``declining``). Empty and copying
responses are told by what remains of them when markup or the instruction's own words are taken off.

The first that holds of empty, refusal, copy, other_language, truncated is the record's one defect.

A null or blank response is empty; a null or blank instruction has no language and nothing to copy, so only empty,
refusal and truncated are looked for. Repeated rows give repeated results; extra columns are ignored; an empty table
gives none. Whole texts are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import declining
from corpusloom.llm.bounded import gather
from corpusloom.llm.declining import SURE, Declining
from corpusloom.llm.languages import FORMULA, Profiles, sampled, segments, symbols
from corpusloom.llm.words import GROUP_CHARS, U, Words, chains, column, groups, mix, words

#: Hash buckets; the n-grams before an end: 8 characters, and (0) the last word, of which LETTERS count; two rows of
#: counts, of which the lower holds, for ends and for all words.
ENDS, SUFFIXES, LETTERS, ROWS = 1 << 18, (8, 0), 12, (U(0), U(0x2545F4914F6CDD1D))
#: An n-gram counts as known from so many times the mean of a bucket on; likely to end a sentence from these shares on,
#: where the text's other sentences have no marks, and where they have.
KNOWN, LIKELY, MARKED = 4, 0.2, 0.95
#: A copy has so much of its three-word sequences from the instruction, and covers so much of the instruction's words.
COPY_OWN, COPY_WHOLE = 0.9, 0.5

TAGS = re.compile(r"<[^<>\n]*>|\\boxed\{\s*\}|\\[a-zA-Z]+")
# Replies that stand for none, after punctuation is taken off.
PLACEHOLDERS = frozenset(["na", "n a", "none", "null", "nil", "nan", "tbd", "todo", "tba", "no response", "no answer", "not available", "not applicable", "placeholder", "undefined", "empty", "response", "answer", "output", "solution", "insert answer here", "your answer here", "lorem ipsum", "antwort", "réponse", "respuesta", "risposta", "antwoord", "odpowiedź"])
#: Words in a row that no placeholder has.
FOUR = re.compile(r"[^\W_]+\s+[^\W_]+\s+[^\W_]+\s+[^\W_]")
LABELS = re.compile(r"^(?:a|answer|response|solution|output|antwort|réponse|respuesta|risposta|antwoord|odpowiedź)\s*:", re.I)

#: Cost of a change of language within a pair, which are mostly in one language each; the least words and confidence of a language.
CHANGE, SPOKEN, SURELY = 5.0, ((4, 0.9), (3, 0.99)), ((6, 0.9), (4, 0.99))
POLITE = re.compile(r"\b(?:sorry|apologi[sz]e|my regrets|unfortunately|thank you|i hope you understand|is there anything else|perhaps you could|please (?:consult|ask|try|contact|rephrase)|feel free|let me know|leider|tut mir leid|désolé|malheureusement|lo siento|lamentablemente|mi dispiace|purtroppo|het spijt me|helaas|przykro mi|niestety|proszę|bitte|veuillez|por favor|per favore|alstublieft|consult a)\b", re.I)
QUOTED = re.compile(r"“[^”]*”|\"[^\"\n]*\"|„[^”“]*[”“]|«[^»]*»")
SENTENCE = re.compile(r"(?<=[.!?…])[\"”’')\]*_]*\s+|\n+")
# Asking for the text itself; names of languages in the languages.
ASKS_COPY = re.compile(r"\b(?:repeat|copy|verbatim|word for word|as it stands|without (?:any )?change|unchanged|return the (?:text|passage)|quote|echo|transcribe|proofread|wiederhol|abschreib|wörtlich|unverändert|répét|recopi|mot (?:à|pour) mot|repit|repet|copia|palabra por palabra|ripet|parola per parola|herhaal|kopieer|woord voor woord|letterlijk|powtórz|przepisz|skopiuj|słowo w słowo)", re.I)
LANGUAGE_NAMES = {
    "en": r"english|englisch|anglais|inglés|inglese|engels|angielsk", "de": r"german|deutsch|allemand|alemán|tedesc|duits|niemieck", "fr": r"french|französisch|français|francés|frances|frans\b|francusk",
    "es": r"spanish|spanisch|espagnol|español|castellano|spagnol|spaans|hiszpańsk", "it": r"italian|italienisch|italien|italiano|italiaans|włosk", "nl": r"dutch|niederländisch|holländisch|néerlandais|neerlandés|holandés|olandese|nederlands|niderlandzk|holendersk", "pl": r"polish|polnisch|polonais|polaco|polacc|pools\b|polsk",
}
NAMES = {k: re.compile(rf"\b(?:{v})", re.I) for k, v in LANGUAGE_NAMES.items()}


def is_empty(t: str | None) -> bool:
    """Null, or nothing but blanks, punctuation, markup or a placeholder."""
    if t is None:
        return True
    if not t.startswith("<") and FOUR.search(t):
        return False
    s = TAGS.sub(" ", t).strip()
    s = LABELS.sub(" ", re.sub(r"^[*_#>`\s]+", "", s))
    core = " ".join("".join(c if c.isalnum() else " " for c in s).split()).lower()
    return not core or core in PLACEHOLDERS


def is_refusal(t: str, instruction: str, model: Declining) -> bool:
    """Are there sentences that decline, and nothing but polite ones and the instruction's own beside them?"""
    parts = [s for s in SENTENCE.split(t.replace("’", "'")) if s.strip()]
    no = model.scores([QUOTED.sub(" ", s) for s in parts]) > SURE
    # A refusal that goes on with a solution isn't one.
    rest = sum(len(s.split()) for s, x in zip(parts, no) if not x and not POLITE.search(s) and s.strip() not in instruction)
    return bool(no.any()) and rest < 8


STOPS = np.array([ord(x) for x in ".!?…"], np.uint32)
AFTER = np.array([ord(x) for x in " \t\r\n\"”’')]*_"], np.uint32)


def may_decline(w: Words, model: Declining) -> np.ndarray:
    """The texts that have a sentence which comes near to declining; all words at once."""
    c = w.codes
    if not len(w.hashes):
        return np.zeros(0, np.int64)
    nxt = np.append(c[1:], 0)
    stop = (c == 0) | (c == 10) | (np.isin(c, STOPS) & (np.isin(nxt, AFTER) | (nxt == 0)))
    of = np.cumsum(stop)[w.start]
    pair, one = chains(w, 2)
    one &= of[: len(pair)] == of[1 : 1 + len(pair)]
    total = np.zeros(int(of[-1]) + 1)
    for f, at in ((w.hashes, of), (pair[one], of[: len(pair)][one])):
        k = np.minimum(np.searchsorted(model.known, f), len(model.known) - 1)
        total += np.bincount(at, np.where(model.known[k] == f, model.adds[k], 0.0), len(total))
    return np.unique(w.doc[total[of] > SURE / 2])


def is_cut(t: str, likely: np.ndarray) -> bool:
    """Does it stop before its last sentence, formula, list entry or code block is complete?"""
    if t.count("```") % 2:
        return True
    s = re.sub(r"```.*?```", " Formula. ", t.rstrip(), flags=re.S)
    signs = s.replace("\\\\", "  ").replace("\\$", "")  # the new line of a formula (\\[2pt]) and a dollar open nothing
    if signs.rfind("\\[") > signs.rfind("\\]") or signs.rfind("\\(") > signs.rfind("\\)") or signs.count("$$") % 2:
        return True
    last = s[s.rfind("\n") + 1 :]
    if signs[signs.rfind("\n") + 1 :].replace("$$", "").count("$") % 2:
        return True
    if re.search(r"\\[a-zA-Z]+\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\Z", last):
        return True
    if last.count("(") > last.count(")") and "(" in last[-2:]:
        return True
    if re.fullmatch(r"\s*(?:[-+*•]|\(?\w{1,3}[.)])", last) and "\n" in s.strip():
        return True
    plain = FORMULA.sub(" Formula. ", s).rstrip()
    if not plain:
        return False
    bare = plain.rstrip("\"”’'»)]}*_`> \t")
    if not bare or bare[-1] in ".!?…。！？":
        return False
    if bare[-1] in ",;:([{=+-–—\\/&<^„“«":
        return True
    # No mark ends it: is what stands before the end what stands before ends elsewhere?
    part = re.split(r"[.!?…:;](?!\d)", bare[bare.rfind("\n") + 1 :])[-1]
    n = len(re.findall(r"[^\W\d_]{2,}", part))
    lines = [x for x in plain.split("\n") if x.strip()]
    peers = [x for x in lines[:-1] if ENTRY.match(x)] if ENTRY.match(lines[-1]) else []
    whole = bool(peers) and all(MARK.search(x[-4:]) for x in peers)  # the other entries of its list end with marks
    begun = n == 2 and MARK.search(bare[: -len(part)].rsplit("\n", 1)[-1])  # after a sentence on its line
    if not whole and not begun and n < 3 and not (n and MARK.search(plain) and re.search(r"[^\W\d_]{2,}\Z", part) and plain.rstrip()[-1:] == bare[-1:] and not re.search(r":\s*\w+\Z", plain) and "\n" not in plain[len(plain) - len(part) - 2 :]):
        return False
    marked = whole if peers else MARK.search(plain[: -len(part) or None]) is not None
    return likelihood(bare, likely) < (MARKED if marked else LIKELY)


MARK = re.compile(r"[.!?…](?!\d)")
ENTRY = re.compile(r"\s*(?:[-+*•]|\(?\w{1,3}[.)])\s")


def ending(s: str) -> str:
    return re.sub(r"\s+", " ", re.sub(r"\d", "0", s[-24:].lower()))


def likelihood(s: str, likely: np.ndarray) -> float:
    """The share of ends of sentences among the words that end as s does; 0 if hardly any does."""
    e = ending(s)
    mean = likely[0] / ENDS
    for k in SUFFIXES:
        part = e[-k:] if k else re.split(r"[ .!?…]", e)[-1][-LETTERS:]
        if k <= len(e):
            h = U(k)
            with np.errstate(over="ignore"):
                for ch in part:
                    h = h * U(0x100000001B3) + U(ord(ch))
            at = [int(mix(np.array([h ^ r], U))[0] & U(ENDS - 1)) + 1 + i * 2 * ENDS for i, r in enumerate(ROWS)]
            every = min(int(likely[i + ENDS]) for i in at)
            if every > KNOWN * mean:
                return min(int(likely[i]) for i in at) / every
    return 0.0


def end_counts(df: DataFrame, fields: tuple[str, ...]) -> np.ndarray:
    """Over all texts: how often each n-gram (by hash) stands before the end of a sentence that has a mark, and at the end of any word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        table = np.zeros(0x110000, bool)
        table[[ord(x) for x in ".!?…\n"]] = True
        for b in batches:
            for f in fields:
                for _, g in groups(column(b, f)):
                    s = "\0".join(re.sub(r"\s+", lambda m: "\n" if "\n" in m[0] else " ", t) if t else "" for t in g).lower()
                    c = np.frombuffer(s.encode("utf-32-le"), np.uint32)
                    if len(c) < 20:
                        continue
                    stop = table[c]
                    digit = (c >= 48) & (c <= 57)
                    c = np.where(digit, 48, np.where(c == 10, 32, c)).astype(U)
                    word = np.flatnonzero((c[1:] == 32) | stop[1:]) # the last letter of a word
                    word = word[(c[word] != 32) & ~stop[word] & (word >= 16)]
                    yield np.zeros(len(word), np.int64)
                    gap = np.maximum.accumulate(np.where((c == 32) | stop, np.arange(len(c)), -1))
                    letters = np.minimum(word - gap[word], LETTERS)
                    for k in SUFFIXES:
                        h = np.full(len(word), k, U)
                        for i in range((k or LETTERS) - 1, -1, -1):
                            more = h * U(0x100000001B3) + c[word - i]
                            h = more if k else np.where(i < letters, more, h)
                        for i, r in enumerate(ROWS):
                            at = (mix(h ^ r) & U(ENDS - 1)).astype(np.int64) + 1 + i * 2 * ENDS
                            yield ENDS + at
                            yield at[stop[word + 1]]

    return gather(df.select(*fields), run, 1 + 2 * len(ROWS) * ENDS)


def find(x: Profiles, sym: np.ndarray, likely: np.ndarray, model: Declining, instruction: list[str | None], response: list[str | None]) -> list[str | None]:
    """The defect of each pair, or None."""
    n = len(response)
    out: list[str | None] = [None] * n
    inst = [t or "" for t in instruction]
    for i, t in enumerate(response):
        if is_empty(t):
            out[i] = "empty"
    long = [i for i in range(n) if out[i] is None]
    a = words([response[i] for i in long])
    for k in may_decline(a, model).tolist():
        if is_refusal(response[long[k]], inst[long[k]], model):
            out[long[k]] = "refusal"
    # Copies: shared three-word sequences; of fewer than three such sequences, the same words.
    b = words([inst[i] for i in long])
    ga, oka = chains(a, 3)
    gb, okb = chains(b, 3)
    # The pair's number goes into the hash, so that only sequences of the same pair meet.
    ka = mix(ga + a.doc[: len(ga)].astype(U) * U(0x9E3779B97F4A7C15))[oka]
    kb = mix(gb + b.doc[: len(gb)].astype(U) * U(0x9E3779B97F4A7C15))[okb]
    own = np.bincount(a.doc[: len(ga)][oka], np.isin(ka, kb), len(long))
    back = np.bincount(b.doc[: len(gb)][okb], np.isin(kb, ka), len(long))
    na, nb = np.bincount(a.doc[: len(ga)][oka], minlength=len(long)), np.bincount(b.doc[: len(gb)][okb], minlength=len(long))
    copy = (na >= 3) & (own >= COPY_OWN * na) & (back >= COPY_WHOLE * nb)
    count = a.counts()
    ends_a, ends_b = np.cumsum(count), np.cumsum(b.counts())
    for k in np.flatnonzero((na < 3) & (count > 0) & (count == b.counts())).tolist():
        said = slice(ends_a[k] - count[k], ends_a[k])
        copy[k] = np.array_equal(a.hashes[said], b.hashes[ends_b[k] - count[k] : ends_b[k]])
    for k in np.flatnonzero(copy).tolist():
        # Letters and numbers alone are proper replies.
        if out[long[k]] is None and not ASKS_COPY.search(inst[long[k]]) and re.search(r"[^\W\d_]{2}", response[long[k]]):
            out[long[k]] = "copy"
    # Languages of both: of enough words, or of fewer and surer.
    long = [i for i in long if out[i] is None]
    spoken = []
    for texts, enough in (([response[i] for i in long], SPOKEN), ([inst[i] for i in long], SURELY)):
        doc, lang, m, conf, _ = segments(x, sym, texts, CHANGE)
        of: list[dict[int, int]] = [{} for _ in long]
        for d, k, w, p in zip(doc.tolist(), lang.tolist(), m.tolist(), conf.tolist()):
            if any(w >= least and p >= sure for least, sure in enough):
                of[d][k] = of[d].get(k, 0) + w
        spoken.append(of)
    for k, i in enumerate(long):
        said, asked = spoken[0][k], spoken[1][k]
        if len(said) == 1 and asked and not set(said) & set(asked):
            name = NAMES.get(x.languages[next(iter(said))])
            if name is None or not name.search(inst[i]):
                out[i] = "other_language"
    for i in range(n):
        if out[i] is None and is_cut(response[i], likely):
            out[i] = "truncated"
    return out


def declining_model(samples: DataFrame, lang: str = "lang", text: str = "text") -> Declining:
    """The model of refusals, with labelled samples as ordinary sentences; of each language at most SAMPLES rows."""
    return declining.fit([s for _, t in sampled(samples, lang, text) for s in SENTENCE.split(t) if s.strip()])


def defects(df: DataFrame, known: Profiles, model: Declining, *, id_col: str, instruction: str, response: str) -> DataFrame:
    """rec_id, defect: empty, refusal, copy, other_language or truncated; only defective pairs. ``known``: from fit_bayes; ``model``: from
    declining_model."""
    src = df.select(F.col(id_col).cast("long").alias("rec_id"), F.col(instruction).cast("string").alias("i"), F.col(response).cast("string").alias("r"))
    sc = df.sparkSession.sparkContext
    likely = sc.broadcast(end_counts(src, ("i", "r")))  # 4 * ENDS numbers
    sent = sc.broadcast((known, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, no = sent.value
        sym = symbols(x.symbol)
        for b in batches:
            ids, inst, resp = b.column(0).to_pylist(), column(b, "i"), column(b, "r")
            for first, g in groups(resp, GROUP_CHARS // 3):
                part = slice(first, first + len(g))
                got = find(x, sym, likely.value, no, inst[part], resp[part])
                keep = [k for k, v in enumerate(got) if v]
                yield pa.RecordBatch.from_pydict({"rec_id": pa.array([ids[first + k] for k in keep], pa.int64()), "defect": pa.array([got[k] for k in keep], pa.string())})

    return src.mapInArrow(run, "rec_id long, defect string")
