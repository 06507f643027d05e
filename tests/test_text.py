import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X

ODD = [" \t x y 　\n", "\x1c\x85q ", "", " ", "a.", "a..", "a.\n", "Problem: p Answer: 1 Answer: 2", "x Problem: p", "#### ", "a#### b#### c", "a/b:c", "train-easy__é x", "ok_1-2.3", None, "İstanbul ΣΑΣ", "<think>a\nb</think>\n\nans", "x<think>1</think>y<think>2</think>z", "<think>open", "😀😀a"]


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("s"))).collect()]


@pytest.mark.parametrize(
    "f, g",
    [
        (X.strip, str.strip),
        (lambda c: X.split_last(c, "#### "), lambda s: s.split("#### ")[-1]),
        (lambda c: X.split_count(c, "#### "), lambda s: len(s.split("#### "))),
        (lambda c: X.split_first(c, "Answer:")[0], lambda s: s.split("Answer:", 1)[0]),
        (lambda c: X.split_first(c, "Answer:")[1], lambda s: (s.split("Answer:", 1) + [None])[1]),
        (lambda c: X.remove_suffix(c, "."), lambda s: s.removesuffix(".")),
        (lambda c: X.remove_prefix(c, "Problem:"), lambda s: s.removeprefix("Problem:")),
        (lambda c: X.first_chars(c, 2), lambda s: s[:2]),
        (lambda c: X.count_of(c, "<think>"), lambda s: s.count("<think>")),
        (lambda c: F.lower(c), str.lower),
    ],
)
def test_like_python(spark, f, g):
    assert column(spark, ODD, f) == [None if s is None else g(s) for s in ODD]


def test_think_names_letters(spark):
    assert column(spark, ["<think>a\nb</think>\n\nans", "x<think>1</think>y<think>2</think>z", "<think>open"], X.remove_think) == ["\n\nans", "xyz", "<think>open"]
    assert column(spark, ["a/b:c", "train-easy__é x", "ok_1-2.3"], X.safe_name) == ["a_b_c", "train-easy___ x", "ok_1-2.3"]
    assert column(spark, ["a/b\\c.jsonl"], X.task_name) == ["a__b__c.jsonl"]
    assert column(spark, ["a__b__c", "a"], X.category) == ["a", "a"]
    assert column(spark, ["x"], lambda c: X.lettered(F.array(c, F.lit(None).cast("string"), F.lit("z")))) == ["A: x\nB: \nC: z"]


def test_last_boxed(spark):
    cases = {r"\boxed{1} then \boxed{\frac{1}{2}}": r"\frac{1}{2}", r"\fbox{7}": "7", r"\fbox{7} and \boxed 5": None, r"\boxed{ }": "", r"\boxed{{a}": None, r"\boxed{a}} tail": "a", r"\boxed } {{x}": "{x", r"\boxed 5 {6}": "6", r"\boxedx{9}": "9", "none": None}
    assert column(spark, list(cases), X.last_boxed) == list(cases.values())
    r = random.Random(1)
    many = ["".join(r.choice(["{", "}", "a", " ", "\\boxed", "\\fbox"]) for _ in range(r.randint(0, 14))) for _ in range(400)]
    got = column(spark, many, X.last_boxed)
    # A closing brace before any opening one counts against the depth and may still be balanced later.
    for s, g in zip(many, got):
        at = s.rfind("\\boxed") if "\\boxed" in s else s.rfind("\\fbox")
        want = None
        if at >= 0:
            depth = left = 0
            for i, ch in enumerate(s[at:], at):
                if ch == "{":
                    depth += 1
                    left = left or i
                elif ch == "}":
                    depth -= 1
                    if depth == 0:
                        want = s[left + 1 : i].strip() if left else None
                        break
        assert g == want, s
