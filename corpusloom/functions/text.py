"""String functions with the semantics of Python's str methods, as Column expressions (no UDFs).

All give null for null, unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that str.strip() takes off, by rule.
BLANKS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
THINK = r"(?s)<think>.*?</think>"


def strip(c: Column) -> Column:
    """str.strip(): Unicode blanks, not only spaces."""
    return F.btrim(c, F.lit(BLANKS))


def split_last(c: Column, sep: str) -> Column:
    """What follows the last ``sep`` (the whole without one)."""
    return F.substring_index(c, sep, -1)


def split_count(c: Column, sep: str) -> Column:
    """How many parts ``sep`` makes."""
    return F.size(F.split(c, _quote(sep), -1))


def split_first(c: Column, sep: str) -> tuple[Column, Column]:
    """Before and after the first ``sep``; the second is null without one."""
    parts = F.split(c, _quote(sep), 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def remove_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 2**31 - 1)).otherwise(c)


def remove_suffix(c: Column, suffix: str) -> Column:
    """Once, and only at the very end (not before a last newline)."""
    return F.regexp_replace(c, _quote(suffix) + r"\z", "")


def remove_think(c: Column) -> Column:
    """Without closed think blocks; not trimmed."""
    return F.regexp_replace(c, THINK, "")


def count_of(c: Column, s: str) -> Column:
    return split_count(c, s) - 1


def contains_any(c: Column, *words: str) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def letter(i: Column) -> Column:
    """A for 0, B for 1, ..."""
    return F.char((i + 65).cast("bigint"))


def letter_index(c: Column) -> Column:
    return F.ascii(c) - 65


def lettered(choices: Column, sep: str = "\n", clean=lambda x: x) -> Column:
    """``A: first``, ``B: second``, ... joined by ``sep``. Null choices are empty."""
    return F.array_join(F.transform(choices, lambda x, i: F.concat(letter(i), F.lit(": "), clean(F.coalesce(x, F.lit(""))))), sep)


def safe_name(c: Column) -> Column:
    """Other characters than letters, digits and ``_-. `` become ``_``. Not injective."""
    return F.regexp_replace(c, r"[^A-Za-z0-9_\-. ]", "_")


def task_name(path: Column) -> Column:
    """A relative path as the name of a task: separators become ``__``; the extension stays."""
    return F.regexp_replace(path, r"[/\\]", "__")


def category(task: Column) -> Column:
    """What stands before the first ``__``; the whole name without one."""
    return F.get(F.split(task, "__", 2), F.lit(0))


def first_chars(c: Column, n: int) -> Column:
    """The first n code points."""
    return F.left(c, F.lit(n))


def text_or_none(c: Column) -> Column:
    """str() of a value: null is the text None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def number(c: Column) -> Column:
    """{:,} of an integer."""
    return F.format_number(c, 0)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """{:.nd%} of part / max(1, whole)."""
    return F.concat(F.format_number(part / F.greatest(F.lit(1), whole) * 100, digits), F.lit("%"))


def last_boxed(c: Column) -> Column:
    """The stripped content of the last ``\\boxed`` (without any, of the last ``\\fbox``): from the first ``{`` after it to
    the ``}`` that balances it. Null if there is none or it isn't balanced. A stray ``}`` before counts against it.

    One native aggregate over the characters after the mark; texts without a mark aren't touched.
    """
    mark = F.when(F.instr(c, "\\boxed") > 0, F.lit("\\boxed")).when(F.instr(c, "\\fbox") > 0, F.lit("\\fbox"))
    tail = F.when(F.instr(c, "\\boxed") > 0, F.substring_index(c, "\\boxed", -1)).when(F.instr(c, "\\fbox") > 0, F.substring_index(c, "\\fbox", -1))
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit(0).alias("left"), F.lit(0).alias("right"))

    def step(a: Column, x: Column) -> Column:
        i = a["i"] + 1
        depth = a["depth"] + F.when(x == "{", 1).when(x == "}", -1).otherwise(0)
        left = F.when((a["left"] == 0) & (x == "{"), i).otherwise(a["left"])
        right = F.when((a["right"] == 0) & (x == "}") & (depth == 0), i).otherwise(a["right"])
        return F.when(a["right"] > 0, a).otherwise(F.struct(i.alias("i"), depth.alias("depth"), left.alias("left"), right.alias("right")))

    found = F.aggregate(F.split(tail, ""), start, step)
    return F.when(mark.isNotNull() & (found["left"] > 0) & (found["right"] > 0), strip(F.substring(tail, found["left"] + 1, found["right"] - found["left"] - 1)))


def _quote(s: str) -> str:
    """A literal in a regular expression."""
    return "".join("\\" + x if not x.isalnum() and x not in " #_" else x for x in s)
