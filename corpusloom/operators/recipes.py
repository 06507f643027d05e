"""Recipes: raw sources of questions and answers as canonical records, each a declarative plan.

``recipe(df) -> condition, instruction, response`` (and ``task`` where a source is split into tasks). Raw rows that break
a source's contract (marked in ``contract``) are left out by the recipe; ``broken`` gives them. Columns that a recipe
doesn't name are ignored. Fan-out is one scan with an array of structs, never a union of scans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X

c, lit = F.col, F.lit


def record(condition: Column | str, instruction: Column, response: Column, keep: Column | None = None, task: Column | str | None = None) -> Column:
    cond = lit(condition) if isinstance(condition, str) else condition
    fields = [cond.alias("condition"), instruction.alias("instruction"), response.alias("response")]
    if task is not None:
        fields.append((lit(task) if isinstance(task, str) else task).alias("task"))
    row = F.struct(*fields)
    return row if keep is None else F.when(keep, row)


def fan_out(df: DataFrame, *records: Column) -> DataFrame:
    """A row for each record that is kept (not null)."""
    return df.select(F.explode(F.filter(F.array(*records), lambda r: r.isNotNull())).alias("r")).select("r.*")


def project(df: DataFrame, condition: Column | str, instruction: Column, response: Column) -> DataFrame:
    return df.select((lit(condition) if isinstance(condition, str) else condition).alias("condition"), instruction.alias("instruction"), response.alias("response"))


def no_proof(question: Column) -> Column:
    """Neither asks to prove nor to show that."""
    low = F.lower(question)
    return ~low.contains("prove") & ~low.contains("show that")


@dataclass(frozen=True)
class Recipe:
    name: str
    run: Callable[[DataFrame], DataFrame]
    schema: str
    contract: Callable[[], Column] | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.contract:
            df = df.where(F.coalesce(self.contract(), lit(False)))
        return self.run(df)

    def broken(self, df: DataFrame) -> DataFrame:
        """Raw rows that break the source's contract."""
        return df.where(~F.coalesce(self.contract(), lit(False))) if self.contract else df.limit(0)


RECIPES: dict[str, Recipe] = {}


def recipe(name: str, schema: str, contract: Callable[[], Column] | None = None):
    """Registers a recipe: the way to add a source."""

    def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        RECIPES[name] = Recipe(name, f, schema, contract)
        return f

    return add


@recipe("amps_khan", "problem string, hints array<string>", lambda: c("hints").isNotNull())
def amps_khan(df: DataFrame) -> DataFrame:
    return project(df, "noisy,cot", c("problem"), X.strip(F.array_join("hints", "\n")))


@recipe("gsm8k_train", "question string, answer string", lambda: X.split_count(c("answer"), "#### ") == 2)
def gsm8k(df: DataFrame) -> DataFrame:
    return project(df, "direct", X.strip(c("question")), X.strip(X.split_last(c("answer"), "#### ")))


@recipe("math_train", "problem string, solution string", lambda: c("solution").isNotNull())
def math_train(df: DataFrame) -> DataFrame:
    boxed = X.last_boxed(c("solution"))
    return fan_out(df, record("cot", c("problem"), X.strip(c("solution"))), record("direct", c("problem"), boxed, boxed != ""))


@recipe("natural_reasoning", "question string, reference_answer string", lambda: c("question").isNotNull() & c("reference_answer").isNotNull())
def natural_reasoning(df: DataFrame) -> DataFrame:
    answer = X.strip(c("reference_answer"))
    return project(df.where((answer != "") & no_proof(c("question"))), "noisy,direct", c("question"), answer)


@recipe("no_robots", "messages array<struct<role:string,content:string>>")
def no_robots(df: DataFrame) -> DataFrame:
    """The first turn, after a leading system message. Null contents give null texts, for the quarantine."""
    m = c("messages")
    at = lambda i: F.get(m, i)
    system = F.coalesce(at(lit(0))["role"] == "system", lit(False))
    start = F.when(system, 1).otherwise(0)
    user, reply = at(start), at(start + 1)
    ok = (F.size(m) >= 2) & (F.size(m) > start + 1) & (user["role"] == "user") & (reply["role"] == "assistant")
    return project(df.where(ok), "cot", F.when(system, F.concat(at(lit(0))["content"], lit("\n\n"), user["content"])).otherwise(user["content"]), reply["content"])


@recipe("numinamath", "problem string, solution string, answer string, question_type string, problem_is_valid string, solution_is_valid string, synthetic boolean")
def numinamath(df: DataFrame) -> DataFrame:
    """A null flag ``synthetic`` or type passes, as in Python's ``not`` and ``!=``; null solutions and answers don't."""
    problem, solution, answer = X.strip(c("problem")), X.strip(c("solution")), X.strip(c("answer"))
    # Marks of rows that are left out.
    ok = ~F.coalesce("synthetic", lit(False)) & (c("problem_is_valid") == "Yes") & (c("solution_is_valid") == "Yes") & c("solution").isNotNull() & c("answer").isNotNull()
    ok = ok & ~c("problem").contains("http") & ~c("solution").contains("http") & ~c("solution").contains("Translate the text above into English") & (problem != "") & (solution != "")
    direct = ~c("question_type").eqNullSafe("proof") & ~c("answer").eqNullSafe("proof") & (answer != "")
    return fan_out(df.where(ok), record("noisy,cot", problem, solution), record("noisy,direct", problem, answer, direct))


@recipe("omnimath", "problem string, solution string, answer string", lambda: c("solution").isNotNull() & c("answer").isNotNull())
def omnimath(df: DataFrame) -> DataFrame:
    return fan_out(df, record("cot", c("problem"), X.strip(c("solution"))), record("direct", c("problem"), X.strip(c("answer"))))


@recipe("principia_collection", "problem_statement string, answer string")
def principia(df: DataFrame) -> DataFrame:
    return project(df, "synth,direct", c("problem_statement"), c("answer"))


@recipe("webinstruct_verified", "question string, answer string")
def webinstruct(df: DataFrame) -> DataFrame:
    return project(df, "direct", c("question"), c("answer"))


# Descriptions and conditions by file.
ARB = {"math.json": ("Solve the math problem.", "cot"), "reading.json": ("Solve the reading comprehension problem.", "cot"), "law.json": ("Choose the correct option letter.", "direct"), "science.json": ("Solve the science problem.", "cot"), "physics.json": ("Solve the physics problem.", "cot")}


@recipe("arb", "file string, instruction string, response string")
def arb(df: DataFrame) -> DataFrame:
    """``file``: base name. Files without a description are left out (a broadcast join with five rows)."""
    known = df.sparkSession.createDataFrame([(k, *v) for k, v in ARB.items()], "file string, _text string, _condition string")
    j = df.join(F.broadcast(known), "file")
    return j.select(c("_condition").alias("condition"), F.concat("_text", lit("\n\n"), "instruction").alias("instruction"), "response", F.concat(lit("Platypus__arb_"), "file", lit("l")).alias("task"))


@recipe("openbookqa", "question_stem string, choices struct<text:array<string>>, fact1 string, answerKey string", lambda: X.letter_index(c("answerKey")).between(0, F.size("choices.text") - 1))
def openbookqa(df: DataFrame) -> DataFrame:
    # The template.
    head = "Based on the given fact, which of the following option is the correct answer to the question?\n\n"
    return project(df, "direct", F.concat(lit(head), "question_stem", lit(" \n"), X.lettered(c("choices.text")), lit("\n\nFact: "), "fact1"), c("answerKey"))


@recipe("reclor", "context string, question string, answers array<string>, label int")
def reclor(df: DataFrame) -> DataFrame:
    options = F.when(F.size("answers") > 0, F.concat(lit("\n"), X.lettered(c("answers")))).otherwise("")
    return project(df, "direct", F.concat("question", lit("\n\n"), "context", lit("\n\nOptions:"), options), X.letter(c("label")))


@recipe("scibench", "problem_text string, solution string, answer_latex string, answer_number string")
def scibench(df: DataFrame) -> DataFrame:
    p, s, a, n = (X.strip(F.coalesce(x, lit(""))) for x in ("problem_text", "solution", "answer_latex", "answer_number"))
    answer = F.when(a == F.concat(lit("$"), n, lit("$")), n).otherwise(a)
    return fan_out(df, record("cot", p, s, s != ""), record("direct", p, answer))


@recipe("scienceqa", "question string, lecture string, solution string, choices array<string>, answer int", lambda: c("question").isNotNull() & c("lecture").isNotNull() & c("solution").isNotNull())
def scienceqa(df: DataFrame) -> DataFrame:
    q, lecture, s = X.strip(c("question")), X.strip(c("lecture")), X.strip(c("solution"))
    body = F.concat(q, lit("\nOptions:\n"), X.lettered(c("choices"), clean=X.strip))
    ask = lambda head: F.when(lecture != "", F.concat(lit(head + "\n\n"), body, lit("\n\nLecture: "), lecture)).otherwise(body)
    a = X.letter(c("answer"))
    # The templates.
    return fan_out(
        df,
        record("cot", ask("Solve the following question using the information provided in the lecture."), F.concat(s, lit("\n\nAnswer: "), a), s != ""),
        record("direct", ask("Choose the correct option letter for the following question based on the information from the lecture."), a),
    )


@recipe("theoremqa", "Question string, Answer string, Picture binary")
def theoremqa(df: DataFrame) -> DataFrame:
    return project(df.where("Picture is null"), "direct", c("Question"), c("Answer"))


# Exercises by condition.
SYNTH = {"synth,cot": ("creative writing", "rag", "memorization", "constrained writing", "editing"), "synth,direct": ("math mcq", "mcq"), "synth,noisy,cot": ("math exercise",)}


@recipe("SYNTH", "language string, query_seed_url string, exercise string, query string, constraints string, synthetic_answer string")
def synth(df: DataFrame) -> DataFrame:
    """Three-valued logic: a null in a test drops the row. Other exercises have the condition '', for the quarantine."""
    keep = (c("language") == "en") & ~c("query_seed_url").contains("Pleias self-knowledge") & (c("exercise") != "cooking")
    condition = lit("")
    for k, v in SYNTH.items():
        condition = F.when(c("exercise").isin(*v), k).otherwise(condition)
    return project(df.where(keep), condition, F.when(c("exercise") == "rag", F.concat("query", "constraints")).otherwise(c("query")), c("synthetic_answer"))


@recipe("acereason", "category string, input string, output string", lambda: (c("category") != "math") | (X.count_of(c("output"), "<think>") == 1))
def acereason(df: DataFrame) -> DataFrame:
    return project(df.where("category = 'math'"), "synth,cot", c("input"), X.remove_think(c("output")))


@recipe("ampsmathematica", "path string, content binary")
def ampsmathematica(df: DataFrame) -> DataFrame:
    """Members of an archive: .../mathematica/<topic>/<task>/<file>.txt; others, and texts that aren't UTF-8, are left out."""
    p = F.split(F.btrim("path", lit("/")), "/")
    at = lambda k: F.when(F.size(p) >= k, F.element_at(p, -k))
    ok = c("path").endswith(".txt") & (F.size(p) >= 3) & ((F.size(p) == 3) | (at(4) == "mathematica"))
    body = F.when(F.is_valid_utf8(c("content").cast("string")), c("content").cast("string"))
    q, a = X.split_first(X.remove_prefix(body, "Problem:"), "Answer:")
    q, a = X.strip(q), X.strip(a)
    rows = df.where(ok).select(F.when(at(2).endswith("w_steps"), "noisy,cot").otherwise("noisy,direct").alias("condition"), q.alias("instruction"), a.alias("response"), F.concat(at(3), lit("_"), at(2)).alias("task"))
    return rows.where("instruction <> '' and response <> ''")


@recipe("dmmath", "subset string, file string, instruction string, response string")
def dmmath(df: DataFrame) -> DataFrame:
    """Pairs of lines (see sources.alternating_lines); a task for each file."""
    return df.select(lit("direct").alias("condition"), "instruction", "response", X.safe_name(F.concat("subset", lit("__"), X.remove_suffix(c("file"), ".txt"))).alias("task"))


# Subsets by condition.
FLAN = {"direct": ("dialog_fsopt_data", "flan_fsopt_data", "flan_fsnoopt_data", "niv2_fsopt_data", "t0_fsopt_data", "t0_fsnoopt_data", "dialog_zsopt_data", "flan_zsopt_data", "flan_zsnoopt_data", "niv2_zsopt_data", "t0_zsopt_data", "t0_zsnoopt_data"), "cot": ("cot_fsopt_data", "cot_zsopt_data")}


@recipe("flan", "subset string, _task_name string, inputs string, targets string")
def flan(df: DataFrame) -> DataFrame:
    """Null values are the text None. Tasks whose names become the same are one."""
    kind = F.create_map(*[lit(x) for k, v in FLAN.items() for s in v for x in (s, k)])
    return df.select(kind[c("subset")].alias("condition"), X.text_or_none(c("inputs")).alias("instruction"), X.text_or_none(c("targets")).alias("response"), F.concat("subset", lit("__"), X.safe_name(X.text_or_none(c("_task_name")))).alias("task")).where("condition is not null")


@recipe("openmathinstruct2", "problem string, generated_solution string, expected_answer string, problem_source string")
def openmathinstruct2(df: DataFrame) -> DataFrame:
    """A null source isn't an original one."""
    original = F.coalesce(c("problem_source").isin("math", "gsm8k"), lit(False))
    return fan_out(df, record("synth,cot", c("problem"), c("generated_solution"), task="cot"), record("synth,direct", c("problem"), c("expected_answer"), ~original, "direct"))


# Sources that are left out.
THOUGHTS_WITHOUT = ("dolphin", "evolcodegolf", "glaive", "magicoder", "sharegpt", "codefeedback", "nvidia_math")


def _thoughts_kept() -> Column:
    return ~F.coalesce(c("source").isin(*THOUGHTS_WITHOUT), lit(False))


@recipe("openthoughts2", "source string, conversations array<struct<from:string,value:string>>", lambda: ~_thoughts_kept() | ((F.size("conversations") == 2) & (F.get("conversations", 0)["from"] == "user") & (F.get("conversations", 1)["from"] == "assistant")))
def openthoughts2(df: DataFrame) -> DataFrame:
    q, a = F.get("conversations", 0)["value"], F.get("conversations", 1)["value"]
    code = F.lower(q).contains("python") | F.lower(a).contains("python") | a.contains("```")
    return project(df.where(_thoughts_kept() & ~code), "synth,cot", q, X.remove_think(a))


@recipe("sudoku_extreme", "source string, q string, a string, rating string", lambda: (F.length("q") == 81) & (F.length("a") == 81))
def sudoku(df: DataFrame) -> DataFrame:
    return project(df, "direct", F.concat(lit("Solve the Sudoku\n\n"), F.translate("q", ".", "0")), c("a"))


def tasksource(df: DataFrame, allowed: DataFrame) -> DataFrame:
    """Tasks of ``allowed`` (column task); a last full stop of the response is taken off. The list is a parameter."""
    kept = df.join(F.broadcast(allowed.select("task").distinct()), "task", "left_semi")
    return kept.select(lit("direct").alias("condition"), c("inputs").alias("instruction"), X.remove_suffix(c("targets"), ".").alias("response"), X.safe_name(c("task")).alias("task"))


def tasks_not_found(df: DataFrame, allowed: DataFrame) -> DataFrame:
    return allowed.select("task").distinct().join(df.select("task").distinct(), "task", "left_anti")


@recipe("textbookreasoning", "question string, answer string, reference_answer string", lambda: c("question").isNotNull())
def textbookreasoning(df: DataFrame) -> DataFrame:
    return fan_out(df, record("synth,cot", c("question"), c("answer"), task="cot"), record("noisy,direct", c("question"), c("reference_answer"), no_proof(c("question")), "direct"))
