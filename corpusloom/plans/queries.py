"""Queries of the operators over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators import incremental, layout, recipes, report, sampling, tokenize
from corpusloom.operators.recipes import RECIPES
from corpusloom.schema import violation

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
c, lit = F.col, F.lit
W = X.BLANKS
EPOCHS, SEED, FACTOR = 10, 0, 10
TAG_IDS = {"direct": 1, "cot": 2, "noisy": 3, "synth": 4}


def read(s: SparkSession, d: str, t: str) -> DataFrame:
    return s.read.parquet(f"{d}/{t}.parquet")


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def on(name: str, table: str, sql: str | None, **raw: Column | str) -> None:
    """A query of a recipe, with its raw columns made from a table's."""

    def run(s: SparkSession, d: str) -> DataFrame:
        t = read(s, d, table)
        return RECIPES[name](t.select(*[(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in raw.items()]))

    QUERIES[f"recipe_{name}"] = run
    if sql:
        SQL[f"recipe_{name}"] = sql


# --- Functions.


@query(f"SELECT rec_id, trim(instruction, '{W}') AS stripped, length(trim(instruction, '{W}')) AS n FROM json_rows")
def strip_unicode(s, d):
    t = X.strip(c("instruction"))
    return read(s, d, "json_rows").select("rec_id", t.alias("stripped"), F.char_length(t).cast("bigint").alias("n"))


@query(r"SELECT rec_id, regexp_replace(response, '(?s)<think>.*?</think>', '', 'g') AS plain, len(string_split(response, '<think>')) - 1 AS marks FROM json_rows")
def think_removed(s, d):
    return read(s, d, "json_rows").select("rec_id", X.remove_think(c("response")).alias("plain"), X.count_of(c("response"), "<think>").cast("bigint").alias("marks"))


@query("SELECT rec_id, list_extract(string_split(response, '#### '), -1) AS last, CAST(len(string_split(response, '#### ')) AS BIGINT) AS parts FROM json_rows WHERE response IS NOT NULL")
def split_answer(s, d):
    return read(s, d, "json_rows").where("response is not null").select("rec_id", X.split_last(c("response"), "#### ").alias("last"), X.split_count(c("response"), "#### ").cast("bigint").alias("parts"))


@query("SELECT doc_id, string_split(text, 'Answer')[1] AS before, CASE WHEN contains(text, 'Answer') THEN substring(text, strpos(text, 'Answer') + 6) END AS after FROM documents WHERE text IS NOT NULL")
def first_answer_split(s, d):
    a, b = X.split_first(c("text"), "Answer")
    return read(s, d, "documents").where("text is not null").select("doc_id", a.alias("before"), b.alias("after"))


@query(r"SELECT doc_id, regexp_replace(text, '\.\z', '') AS cut, CASE WHEN starts_with(text, 'Question: ') THEN substring(text, 11) ELSE text END AS rest FROM documents")
def affixes_removed(s, d):
    return read(s, d, "documents").select("doc_id", X.remove_suffix(c("text"), ".").alias("cut"), X.remove_prefix(c("text"), "Question: ").alias("rest"))


@query(r"SELECT DISTINCT path, regexp_replace(path, '[^A-Za-z0-9_\-. ]', '_', 'g') AS safe, regexp_replace(path, '[/\\]', '__', 'g') AS name, string_split(task, '__')[1] AS category FROM file_manifest")
def names(s, d):
    return read(s, d, "file_manifest").select("path", X.safe_name(c("path")).alias("safe"), X.task_name(c("path")).alias("name"), X.category(c("task")).alias("category")).distinct()


@query(
    "SELECT problem_id, chr(CAST(65 + problem_id % 4 AS INTEGER)) AS letter, CAST(ascii(problem) - 65 AS BIGINT) AS place, 'A: ' || coalesce(problem, '') || chr(10) || 'B: ' || coalesce(answer, '') || chr(10) || 'C: ' || coalesce(question_type, '') AS lettered FROM numinamath_raw"
)
def lettered_choices(s, d):
    return read(s, d, "numinamath_raw").select("problem_id", X.letter(c("problem_id") % 4).alias("letter"), X.letter_index(c("problem")).cast("bigint").alias("place"), X.lettered(F.array("problem", "answer", "question_type")).alias("lettered"))


@query(
    r"""WITH s AS (SELECT rec_id, CASE WHEN contains(response, '\boxed') THEN list_extract(string_split(response, '\boxed'), -1) WHEN contains(response, '\fbox') THEN list_extract(string_split(response, '\fbox'), -1) END AS tail FROM json_rows),
t AS (SELECT * FROM s WHERE tail IS NOT NULL), u AS (SELECT rec_id, tail, unnest(generate_series(1, length(tail))) AS i FROM t),
v AS (SELECT *, substring(tail, i, 1) AS ch FROM u), x AS (SELECT *, sum(CASE ch WHEN '{' THEN 1 WHEN '}' THEN -1 ELSE 0 END) OVER (PARTITION BY rec_id ORDER BY i) AS depth FROM v),
e AS (SELECT rec_id, min(CASE WHEN ch = '{' THEN i END) AS l, min(CASE WHEN ch = '}' AND depth = 0 THEN i END) AS r FROM x GROUP BY rec_id)
SELECT t.rec_id, CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN trim(substring(tail, l + 1, greatest(r - l - 1, 0)), '"""
    + W
    + "') END AS boxed FROM t LEFT JOIN e USING (rec_id)"
)
def last_boxed(s, d):
    marked = c("response").contains("\\boxed") | c("response").contains("\\fbox")
    return read(s, d, "json_rows").where(marked).select("rec_id", X.last_boxed(c("response")).alias("boxed"))


@query("SELECT doc_id, left(text, 200) AS head, CAST(length(left(text, 200)) AS BIGINT) AS n, CAST(strlen(text) AS BIGINT) AS bytes FROM documents")
def first_characters(s, d):
    t = X.first_chars(c("text"), 200)
    return read(s, d, "documents").select("doc_id", t.alias("head"), F.char_length(t).cast("bigint").alias("n"), F.octet_length("text").cast("bigint").alias("bytes"))


@query("SELECT source, format('{:,}', count(*) * 1234) AS n, format('{:.1f}%', count(*) / greatest(1, (SELECT count(*) FROM documents)) * 100) AS share FROM documents GROUP BY source")
def formatted(s, d):
    t = read(s, d, "documents")
    return t.groupBy("source").agg(F.count("*").alias("k")).crossJoin(t.agg(F.count("*").alias("all"))).select("source", X.number(c("k") * 1234).alias("n"), X.percent(c("k"), c("all")).alias("share"))


# --- Recipes.

_HAS = "instruction IS NOT NULL AND response IS NOT NULL"
_PROOF = "NOT contains(lower(instruction), 'prove') AND NOT contains(lower(instruction), 'show that')"

on("amps_khan", "no_robots_raw", f"SELECT 'noisy,cot' AS condition, split AS instruction, trim(array_to_string(list_filter(list_transform(messages, lambda m: m.content), lambda x: x IS NOT NULL), chr(10)), '{W}') AS response FROM no_robots_raw WHERE messages IS NOT NULL", problem="split", hints="transform(messages, m -> m.content)")
on("gsm8k_train", "json_rows", f"SELECT 'direct' AS condition, trim(instruction, '{W}') AS instruction, trim(list_extract(string_split(response, '#### '), -1), '{W}') AS response FROM json_rows WHERE len(string_split(response, '#### ')) = 2", question="instruction", answer="response")
on("natural_reasoning", "json_rows", f"SELECT 'noisy,direct' AS condition, instruction, trim(response, '{W}') AS response FROM json_rows WHERE {_HAS} AND trim(response, '{W}') <> '' AND {_PROOF}", question="instruction", reference_answer="response")
on(
    "no_robots", "no_robots_raw",
    "WITH t AS (SELECT messages AS m, CASE WHEN messages[1].role = 'system' THEN 2 ELSE 1 END AS k FROM no_robots_raw) SELECT 'cot' AS condition, CASE WHEN k = 2 THEN m[1].content || chr(10) || chr(10) || m[2].content ELSE m[1].content END AS instruction, m[k + 1].content AS response FROM t WHERE len(m) >= 2 AND len(m) > k AND m[k].role = 'user' AND m[k + 1].role = 'assistant'",
    messages="messages",
)
_NUMINA = f"coalesce(synthetic, false) = false AND problem_is_valid = 'Yes' AND solution_is_valid = 'Yes' AND solution IS NOT NULL AND answer IS NOT NULL AND NOT contains(problem, 'http') AND NOT contains(solution, 'http') AND NOT contains(solution, 'Translate the text above into English') AND trim(problem, '{W}') <> '' AND trim(solution, '{W}') <> ''"
on(
    "numinamath", "numinamath_raw",
    f"SELECT 'noisy,cot' AS condition, trim(problem, '{W}') AS instruction, trim(solution, '{W}') AS response FROM numinamath_raw WHERE {_NUMINA} UNION ALL SELECT 'noisy,direct', trim(problem, '{W}'), trim(answer, '{W}') FROM numinamath_raw WHERE {_NUMINA} AND question_type IS DISTINCT FROM 'proof' AND answer IS DISTINCT FROM 'proof' AND trim(answer, '{W}') <> ''",
    **{k: k for k in ("problem", "solution", "answer", "question_type", "problem_is_valid", "solution_is_valid", "synthetic")},
)
on("omnimath", "numinamath_raw", f"SELECT 'cot' AS condition, problem AS instruction, trim(solution, '{W}') AS response FROM numinamath_raw WHERE solution IS NOT NULL AND answer IS NOT NULL UNION ALL SELECT 'direct', problem, trim(answer, '{W}') FROM numinamath_raw WHERE solution IS NOT NULL AND answer IS NOT NULL", problem="problem", solution="solution", answer="answer")
on("math_train", "json_rows", None, problem="instruction", solution="response")
SQL["recipe_math_train"] = f"WITH b AS ({SQL['last_boxed']}) SELECT 'cot' AS condition, instruction, trim(response, '{W}') AS response FROM json_rows WHERE response IS NOT NULL UNION ALL SELECT 'direct', instruction, boxed FROM json_rows JOIN b USING (rec_id) WHERE boxed <> ''"
on("principia_collection", "numinamath_raw", "SELECT 'synth,direct' AS condition, problem AS instruction, answer AS response FROM numinamath_raw", problem_statement="problem", answer="answer")
on("webinstruct_verified", "numinamath_raw", "SELECT 'direct' AS condition, problem AS instruction, answer AS response FROM numinamath_raw", question="problem", answer="answer")
on(
    "arb", "json_rows",
    "WITH k(file, t, cond) AS (VALUES " + ", ".join(f"('{f}', '{t}', '{k}')" for f, (t, k) in recipes.ARB.items()) + ") SELECT cond AS condition, t || chr(10) || chr(10) || instruction AS instruction, response, 'Platypus__arb_' || file || 'l' AS task FROM json_rows JOIN k ON task = 'Platypus__arb_' || file || 'l'",
    file="regexp_extract(task, '^Platypus__arb_(.*)l$', 1)", instruction="instruction", response="response",
)
_ABC = "'A: ' || coalesce(task, '') || chr(10) || 'B: ' || coalesce(lang, '') || chr(10) || 'C: ' || coalesce(condition, '')"
on(
    "openbookqa", "json_rows",
    f"SELECT 'direct' AS condition, 'Based on the given fact, which of the following option is the correct answer to the question?' || chr(10) || chr(10) || instruction || ' ' || chr(10) || {_ABC} || chr(10) || chr(10) || 'Fact: ' || response AS instruction, chr(CAST(65 + rec_id % 5 AS INTEGER)) AS response FROM json_rows WHERE rec_id % 5 <= 2",
    question_stem="instruction", choices="named_struct('text', array(task, lang, condition))", fact1="response", answerKey="char(65 + rec_id % 5)",
)
on(
    "reclor", "json_rows",
    f"SELECT 'direct' AS condition, instruction || chr(10) || chr(10) || response || chr(10) || chr(10) || 'Options:' || chr(10) || {_ABC} AS instruction, chr(CAST(65 + rec_id % 3 AS INTEGER)) AS response FROM json_rows",
    context="response", question="instruction", answers="array(task, lang, condition)", label="cast(rec_id % 3 as int)",
)
on(
    "scibench", "numinamath_raw",
    f"WITH t AS (SELECT trim(coalesce(problem, ''), '{W}') AS p, trim(coalesce(solution, ''), '{W}') AS s, '$' || trim(coalesce(answer, ''), '{W}') || '$' AS a, trim(coalesce(CASE WHEN problem_id % 2 = 0 THEN answer END, ''), '{W}') AS n FROM numinamath_raw) SELECT 'cot' AS condition, p AS instruction, s AS response FROM t WHERE s <> '' UNION ALL SELECT 'direct', p, CASE WHEN a = '$' || n || '$' THEN n ELSE a END FROM t",
    problem_text="problem", solution="solution", answer_latex=f"concat('$', btrim(coalesce(answer, ''), '{W}'), '$')", answer_number="if(problem_id % 2 = 0, answer, null)",
)


def _science(head: str) -> str:
    return f"CASE WHEN l <> '' THEN '{head}' || chr(10) || chr(10) || body || chr(10) || chr(10) || 'Lecture: ' || l ELSE body END"


on(
    "scienceqa", "numinamath_raw",
    f"WITH r AS (SELECT trim(problem, '{W}') AS q, trim(coalesce(question_type, ''), '{W}') AS l, trim(solution, '{W}') AS s, 'A: ' || trim(coalesce(answer, ''), '{W}') || chr(10) || 'B: ' || trim(coalesce(solution_is_valid, ''), '{W}') AS o, chr(CAST(65 + problem_id % 2 AS INTEGER)) AS a FROM numinamath_raw WHERE solution IS NOT NULL AND problem IS NOT NULL), t AS (SELECT *, q || chr(10) || 'Options:' || chr(10) || o AS body FROM r) "
    f"SELECT 'cot' AS condition, {_science('Solve the following question using the information provided in the lecture.')} AS instruction, s || chr(10) || chr(10) || 'Answer: ' || a AS response FROM t WHERE s <> '' UNION ALL SELECT 'direct', {_science('Choose the correct option letter for the following question based on the information from the lecture.')}, a FROM t",
    question="problem", lecture="coalesce(question_type, '')", solution="solution", choices="array(answer, solution_is_valid)", answer="cast(problem_id % 2 as int)",
)
on("theoremqa", "numinamath_raw", "SELECT 'direct' AS condition, problem AS instruction, answer AS response FROM numinamath_raw WHERE synthetic IS NULL", Question="problem", Answer="answer", Picture="cast(cast(synthetic as string) as binary)")
_EXERCISE = "CASE condition WHEN 'synth,cot' THEN 'rag' WHEN 'direct' THEN 'mcq' WHEN 'noisy,cot' THEN 'math exercise' WHEN 'cot' THEN 'cooking' WHEN 'synth,direct' THEN 'editing' ELSE condition END"
on(
    "SYNTH", "documents",
    f"WITH t AS (SELECT *, {_EXERCISE} AS e FROM documents) SELECT CASE WHEN e IN ('creative writing', 'rag', 'memorization', 'constrained writing', 'editing') THEN 'synth,cot' WHEN e IN ('math mcq', 'mcq') THEN 'synth,direct' WHEN e = 'math exercise' THEN 'synth,noisy,cot' ELSE '' END AS condition, CASE WHEN e = 'rag' THEN text || source ELSE text END AS instruction, source AS response FROM t WHERE lang = 'en' AND NOT contains(source, 'Pleias self-knowledge') AND e <> 'cooking'",
    language="lang", query_seed_url="source", exercise=_EXERCISE, query="text", constraints="source", synthetic_answer="source",
)
_THINK = "'<think>a' || chr(10) || 'b</think>' || response"
on(
    "acereason", "json_rows",
    f"WITH t AS (SELECT *, {_THINK} AS o FROM json_rows) SELECT 'synth,cot' AS condition, instruction, regexp_replace(o, '(?s)<think>.*?</think>', '', 'g') AS response FROM t WHERE lang = 'en' AND len(string_split(o, '<think>')) = 2",
    category="if(lang = 'en', 'math', lang)", input="instruction", output=_THINK.replace("chr(10)", "char(10)"),
)
_PATH = "CASE rec_id % 4 WHEN 0 THEN 'amps/mathematica/' WHEN 1 THEN 'amps/khan/' WHEN 2 THEN '' ELSE 'mathematica/' END || coalesce(condition, '') || CASE rec_id % 2 WHEN 0 THEN '/steps_w_steps/' ELSE '/plain/' END || CAST(rec_id AS {}) || '.txt'"
_BODY = "'Problem:' || instruction || ' Answer: ' || response"
on(
    "ampsmathematica", "json_rows",
    f"WITH a AS (SELECT string_split(trim({_PATH.format('VARCHAR')}, '/'), '/') AS p, substring({_BODY}, 9) AS b FROM json_rows WHERE {_HAS}), t AS (SELECT p[-2] AS sub, p[-3] || '_' || p[-2] AS task, trim(substring(b, 1, strpos(b, 'Answer:') - 1), '{W}') AS q, trim(substring(b, strpos(b, 'Answer:') + 7), '{W}') AS r FROM a WHERE len(p) >= 3 AND (len(p) = 3 OR p[-4] = 'mathematica')) "
    "SELECT CASE WHEN sub LIKE '%w_steps' THEN 'noisy,cot' ELSE 'noisy,direct' END AS condition, q AS instruction, r AS response, task FROM t WHERE q <> '' AND r <> ''",
    path=_PATH.format("STRING"), content=f"cast({_BODY} as binary)",
)
on("dmmath", "json_rows", r"SELECT 'direct' AS condition, instruction, response, regexp_replace(string_split(task, '__')[1] || '__' || task, '[^A-Za-z0-9_\-. ]', '_', 'g') AS task FROM json_rows", subset="split(task, '__')[0]", file="concat(task, '.txt')", instruction="instruction", response="response")
on(
    "flan", "json_rows",
    r"SELECT CASE WHEN rec_id % 3 = 0 THEN 'cot' ELSE 'direct' END AS condition, coalesce(instruction, 'None') AS instruction, coalesce(response, 'None') AS response, CASE rec_id % 3 WHEN 0 THEN 'cot_zsopt_data' ELSE 't0_fsopt_data' END || '__' || regexp_replace(coalesce(lang, 'None'), '[^A-Za-z0-9_\-. ]', '_', 'g') AS task FROM json_rows WHERE rec_id % 3 < 2",
    subset="CASE rec_id % 3 WHEN 0 THEN 'cot_zsopt_data' WHEN 1 THEN 't0_fsopt_data' ELSE 'other' END", _task_name="lang", inputs="instruction", targets="response",
)
on(
    "openmathinstruct2", "numinamath_raw",
    "SELECT 'synth,cot' AS condition, problem AS instruction, solution AS response, 'cot' AS task FROM numinamath_raw UNION ALL SELECT 'synth,direct', problem, answer, 'direct' FROM numinamath_raw WHERE CASE question_type WHEN 'MCQ' THEN 'math' ELSE question_type END IS NULL OR CASE question_type WHEN 'MCQ' THEN 'math' ELSE question_type END NOT IN ('math', 'gsm8k')",
    problem="problem", generated_solution="solution", expected_answer="answer", problem_source="CASE question_type WHEN 'MCQ' THEN 'math' ELSE question_type END",
)
on(
    "openthoughts2", "no_robots_raw",
    "WITH t AS (SELECT messages[1].content AS q, messages[2].content AS a FROM no_robots_raw WHERE (split IS NULL OR split <> 'test') AND len(messages) = 2 AND messages[1].role = 'user' AND messages[2].role = 'assistant') SELECT 'synth,cot' AS condition, q AS instruction, regexp_replace(a, '(?s)<think>.*?</think>', '', 'g') AS response FROM t WHERE NOT contains(lower(q), 'python') AND NOT contains(lower(a), 'python') AND NOT contains(lower(a), '```')",
    source="if(split = 'test', 'sharegpt', split)", conversations="transform(messages, m -> named_struct('from', m.role, 'value', m.content))",
)
on(
    "sudoku_extreme", "json_rows",
    "WITH t AS (SELECT list_extract(string_split(instruction, chr(10)), -1) AS q, response AS a FROM json_rows) SELECT 'direct' AS condition, 'Solve the Sudoku' || chr(10) || chr(10) || replace(q, '.', '0') AS instruction, a AS response FROM t WHERE length(q) = 81 AND length(a) = 81",
    source="task", q="substring_index(instruction, '\n', -1)", a="response", rating="lang",
)
on("textbookreasoning", "json_rows", f"SELECT 'synth,cot' AS condition, instruction, response, 'cot' AS task FROM json_rows WHERE instruction IS NOT NULL UNION ALL SELECT 'noisy,direct', instruction, lang, 'direct' FROM json_rows WHERE instruction IS NOT NULL AND {_PROOF}", question="instruction", answer="response", reference_answer="lang")


@query(r"SELECT 'direct' AS condition, instruction, regexp_replace(response, '\.\z', '') AS response, regexp_replace(task, '[^A-Za-z0-9_\-. ]', '_', 'g') AS task FROM json_rows WHERE task IN (SELECT task FROM file_manifest WHERE starts_with(task, 'tasksource__'))")
def recipe_tasksource(s, d):
    allowed = read(s, d, "file_manifest").where("startswith(task, 'tasksource__')")
    return recipes.tasksource(read(s, d, "json_rows").select("task", c("instruction").alias("inputs"), c("response").alias("targets")), allowed)


@query("SELECT DISTINCT task FROM file_manifest WHERE task IS NOT NULL AND task NOT IN (SELECT task FROM task_indices WHERE task IS NOT NULL)")
def tasks_not_found(s, d):
    return recipes.tasks_not_found(read(s, d, "task_indices"), read(s, d, "file_manifest").where("task is not null"))


@query(
    "SELECT rec_id, CASE WHEN condition IS NULL OR condition = '' THEN 'no_condition' WHEN len(list_filter(string_split(condition, ','), lambda x: x NOT IN ('direct', 'cot', 'noisy', 'synth'))) > 0 THEN 'unknown_tag' WHEN instruction IS NULL THEN 'null_instruction' WHEN response IS NULL THEN 'null_response' END AS violation FROM json_rows"
)
def contracts(s, d):
    return read(s, d, "json_rows").select("rec_id", violation(c("condition"), c("instruction"), c("response")).alias("violation"))


@query("SELECT task, CAST(count(*) AS BIGINT) AS records, CAST(count(response) AS BIGINT) AS answered FROM json_rows GROUP BY task")
def record_counts(s, d):
    return read(s, d, "json_rows").groupBy("task").agg(F.count("*").alias("records"), F.count("response").alias("answered"))


@query("SELECT 'direct' AS part, problem AS instruction FROM numinamath_raw UNION ALL SELECT 'text', text FROM documents UNION ALL SELECT 'record', instruction FROM json_rows")
def united(s, d):
    a = read(s, d, "numinamath_raw").select(lit("direct").alias("part"), c("problem").alias("instruction"))
    return a.unionByName(read(s, d, "documents").select(lit("text").alias("part"), c("text").alias("instruction"))).unionByName(read(s, d, "json_rows").select(lit("record").alias("part"), "instruction"))


# --- Policies, layout, sampling.

_LATEST = "latest AS (SELECT task, row_id, inst_start, inst_len, resp_start, resp_len FROM (SELECT *, row_number() OVER (PARTITION BY task, row_id ORDER BY indexed_at DESC, resp_len DESC NULLS LAST, inst_start DESC NULLS LAST) AS rn FROM task_indices) WHERE rn = 1)"
_POLICY = """hits AS (SELECT t.task, p.ord, p.max_per_file, p.long_context, p.repeat, row_number() OVER (PARTITION BY t.task ORDER BY p.ord) AS rn, count(p.ord) OVER (PARTITION BY t.task) AS hits FROM (SELECT DISTINCT task FROM task_indices WHERE task IS NOT NULL) t LEFT JOIN (SELECT * FROM prefix_config WHERE prefix IS NOT NULL) p ON starts_with(t.task, p.prefix)),
policy AS (SELECT task, max_per_file, coalesce(long_context, 'truncate') AS long_context, coalesce(repeat, 1) AS repeat, CAST(hits AS BIGINT) AS hits FROM hits WHERE rn = 1)"""
_CLIP = """clipped AS (SELECT l.task, l.row_id, l.inst_start, l.inst_len, l.resp_start, CASE WHEN long_context = 'truncate' THEN least(resp_len, 4097 - least(inst_len, 4097)) ELSE resp_len END AS resp_len, max_per_file, long_context, repeat
FROM latest l JOIN policy USING (task) WHERE resp_len >= 2 AND CASE WHEN long_context = 'truncate' THEN 4097 - least(inst_len, 4097) >= 1 ELSE resp_len <= 4097 - least(inst_len, 4097) END)"""
_DRAWS = f"""n AS (SELECT task, count(*) AS n, least(coalesce(any_value(max_per_file), count(*)), count(*)) * any_value(repeat) AS r FROM clipped GROUP BY task),
passes AS (SELECT c.*, n, r, unnest(generate_series(0, CAST(ceil(r * {EPOCHS} / n) AS BIGINT) - 1)) AS pass FROM clipped c JOIN n USING (task)),
slots AS (SELECT *, row_number() OVER (PARTITION BY task, pass ORDER BY md5(concat_ws('|', '{SEED}', task, CAST(pass AS VARCHAR), CAST(row_id AS VARCHAR))), row_id) - 1 AS slot FROM passes),
drawn AS (SELECT task, row_id, pass * n + slot AS draw, CAST((pass * n + slot) // r AS INTEGER) AS epoch, inst_start, inst_len, resp_start, resp_len FROM slots WHERE pass * n + slot < r * {EPOCHS})"""
_ALL = f"WITH {_LATEST}, {_POLICY}, {_CLIP}, {_DRAWS}"


def _index(s, d):
    return sampling.latest(read(s, d, "task_indices"))


def _policy(s, d):
    """The policy of each file, and whether it is small enough to broadcast."""
    policy = sampling.policies(read(s, d, "task_indices"), read(s, d, "prefix_config"))
    return policy, sampling.few(policy)


def _clipped(s, d):
    policy, few = _policy(s, d)
    return sampling.clip(_index(s, d), policy, broadcast=few), few


def _drawn(s, d):
    clipped, few = _clipped(s, d)
    return sampling.draws(clipped, epochs=EPOCHS, seed=SEED, broadcast=few)


def _covered(s, d):
    clipped, few = _clipped(s, d)
    return sampling.planned_coverage(clipped, epochs=EPOCHS, seed=SEED, broadcast=few)


@query(f"WITH {_POLICY} SELECT * FROM policy")
def prefix_policy(s, d):
    return sampling.policies(read(s, d, "task_indices"), read(s, d, "prefix_config"))


@query(f"WITH {_LATEST} SELECT * FROM latest")
def latest_index(s, d):
    return _index(s, d)


@query(f"WITH {_LATEST}, {_POLICY}, {_CLIP} SELECT task, row_id, inst_len, CAST(resp_len AS BIGINT) AS resp_len FROM clipped")
def clipped_rows(s, d):
    return _clipped(s, d)[0].select("task", "row_id", "inst_len", "resp_len")


@query(
    f"WITH {_LATEST}, t AS (SELECT task, row_id, coalesce(inst_len, 0) AS i, coalesce(resp_len, 0) AS r FROM latest), o AS (SELECT *, CAST(coalesce(sum(i + r) OVER (PARTITION BY task ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS inst_start FROM t) SELECT task, row_id, inst_start, inst_start + i AS resp_start FROM o"
)
def row_offsets(s, d):
    return layout.row_offsets(_index(s, d).select("task", "row_id", "inst_len", "resp_len")).select("task", "row_id", "inst_start", "resp_start")


@query(f"WITH {_LATEST}, t AS (SELECT task, CAST(sum(coalesce(inst_len, 0) + coalesce(resp_len, 0)) AS BIGINT) AS length FROM latest GROUP BY task) SELECT task, length, CAST(sum(length) OVER (ORDER BY task) - length AS BIGINT) AS base FROM t")
def task_offsets(s, d):
    return layout.task_offsets(_index(s, d))


@query(f"{_ALL} SELECT task, row_id, CAST(draw AS BIGINT) AS draw, epoch, inst_len, CAST(resp_len AS BIGINT) AS resp_len FROM drawn")
def sample_epochs(s, d):
    return _drawn(s, d).select("task", "row_id", "draw", "epoch", "inst_len", "resp_len")


@query(f"{_ALL} SELECT c.task, c.row_id, CAST(coalesce(k, 0) AS BIGINT) AS cov FROM clipped c LEFT JOIN (SELECT task, row_id, count(*) AS k FROM drawn GROUP BY task, row_id) x ON c.task = x.task AND c.row_id = x.row_id")
def sample_coverage(s, d):
    return _covered(s, d).select("task", "row_id", "cov")


@query(f"{_ALL} SELECT epoch, task, CAST(draw AS BIGINT) AS draw, CAST(row_number() OVER (PARTITION BY epoch ORDER BY md5(concat_ws('|', '{SEED}', CAST(epoch AS VARCHAR), task, CAST(draw AS VARCHAR))), task, draw) - 1 AS BIGINT) AS pos FROM drawn")
def epoch_shuffle(s, d):
    return sampling.shuffled(_drawn(s, d), seed=SEED).select("epoch", "task", "draw", "pos")


_COUNTS = {"rows": "count(*)", "toks": "sum(i + r)", "inst_toks": "sum(i)", "resp_toks": "sum(r)", "cov_rows": "sum(cov)", "cov_toks": "sum((i + r) * cov)", "cov_inst": "sum(i * cov)", "cov_resp": "sum(r * cov)", "unique_cov_rows": "sum(CASE WHEN cov > 0 THEN 1 ELSE 0 END)", "unique_cov_toks": "sum(CASE WHEN cov > 0 THEN i + r ELSE 0 END)"}


@query(
    f"{_ALL}, x AS (SELECT c.task, string_split(c.task, '__')[1] AS category, c.inst_len AS i, c.resp_len AS r, coalesce(k, 0) AS cov FROM clipped c LEFT JOIN (SELECT task, row_id, count(*) AS k FROM drawn GROUP BY task, row_id) y ON c.task = y.task AND c.row_id = y.row_id), "
    f"g AS (SELECT grouping(category, task) AS g, category, task, {', '.join(f'CAST(coalesce({v}, 0) AS BIGINT) AS {k}' for k, v in _COUNTS.items())} FROM x GROUP BY GROUPING SETS ((category, task), (category), ())), w AS (SELECT * FROM g WHERE g = 3) "
    f"SELECT CASE g.g WHEN 0 THEN 'task' WHEN 1 THEN 'category' ELSE 'global' END AS level, CASE g.g WHEN 0 THEN g.task WHEN 1 THEN g.category ELSE 'GLOBAL' END AS name, {', '.join(f'g.{k}' for k in _COUNTS)}, {', '.join(f'g.{k} / greatest(1, w.{k}) AS pct_{k}' for k in _COUNTS)} FROM g, w"
)
def coverage_report(s, d):
    return report.coverage_report(_covered(s, d))


@query(f"{_ALL} SELECT 4097 AS max_seq_len, CAST(round_even(CAST(sum(inst_len + resp_len) AS DOUBLE) / {EPOCHS}, 0) AS BIGINT) AS total_length FROM drawn")
def dataset_metadata(s, d):
    return layout.metadata(_covered(s, d), epochs=EPOCHS)


@query(
    f"WITH {_POLICY}, docs AS (SELECT task, row_id, unnest([0, 1]) AS side, unnest([instruction, response]) AS text FROM (SELECT task, rec_id AS row_id, instruction, response FROM json_rows)), k AS (SELECT task, row_id, side, left(text, 10000) AS text, max_per_file, row_number() OVER (PARTITION BY task ORDER BY md5(concat_ws('|', '0', task, CAST(row_id AS VARCHAR), CAST(side AS VARCHAR))), row_id, side) - 1 AS p FROM docs JOIN policy USING (task) WHERE text IS NOT NULL) SELECT task, row_id, side, text FROM k WHERE max_per_file IS NULL OR p < max_per_file * {FACTOR}"
)
def training_sample(s, d):
    records = read(s, d, "json_rows").select("task", c("rec_id").alias("row_id"), "instruction", "response")
    policy, few = _policy(s, d)
    return sampling.training_sample(records, policy, factor=FACTOR, broadcast=few)


# --- Tokens.


@query("SELECT rec_id, array_to_string(list_transform(string_split(condition, ','), lambda t: CASE t WHEN 'direct' THEN '1' WHEN 'cot' THEN '2' WHEN 'noisy' THEN '3' WHEN 'synth' THEN '4' END), ',') AS ids FROM json_rows WHERE condition IS NOT NULL AND condition <> ''")
def tag_ids(s, d):
    return read(s, d, "json_rows").where("condition is not null and condition <> ''").select("rec_id", F.array_join(tokenize.tag_ids(c("condition"), TAG_IDS).cast("array<string>"), ",").alias("ids"))


@query(r"SELECT piece, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z]+|[0-9]|[^ \t\n\f\rA-Za-z0-9]+|[ \t\n\f\r]+')) AS piece FROM documents) GROUP BY piece")
def piece_counts_plain(s, d):
    t = read(s, d, "documents").select(F.explode(F.regexp_extract_all("text", lit(r"[A-Za-z]+|[0-9]|[^ \t\n\f\rA-Za-z0-9]+|[ \t\n\f\r]+"), lit(0))).alias("piece"))
    return t.groupBy("piece").agg(F.count("*").alias("n"))


# The pattern's only look ahead, of a run of blanks before something else, is said by a mark that ends the run one blank earlier.
_MARK = "\\x{10FFFF}"
_GAP = r"\s\x0b\x85\p{Z}"
_PIECES = rf"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{{L}}\p{{N}}{_MARK}]?\p{{L}}+|\p{{N}}| ?[^{_GAP}\p{{L}}\p{{N}}{_MARK}]+[\r\n]*|[{_GAP}]*[\r\n]+|[{_GAP}]+"


@query(
    rf"""WITH t AS (SELECT regexp_replace(nfc_normalize(text), '([{_GAP}])([\t\x0b\f\x85\p{{Z}}][^{_GAP}])', '\1' || chr(1114111) || '\2', 'g') AS x FROM documents)
SELECT piece, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(regexp_extract_all(x, '{_PIECES.replace("'", "''")}')) AS piece FROM t) GROUP BY piece"""
)
def piece_counts(s, d):
    return tokenize.piece_counts(read(s, d, "documents"), "text")


def _spec():
    import public_tokenizers as P

    return tokenize.Spec(P.path("byte_bpe_50k.json"), 50256, 50256, 50256, TAG_IDS)


def _tokenized(s, d):
    good = read(s, d, "json_rows").where(violation(c("condition"), c("instruction"), c("response")).isNull())
    return tokenize.tokenized(good.select("rec_id", "task", "condition", "instruction", "response"), _spec())


@query()
def tokenized_rows(s, d):
    return _tokenized(s, d).select("rec_id", "inst_tokens", "resp_tokens", "inst_len", "resp_len")


@query("SELECT rec_id, condition, instruction, response FROM json_rows WHERE condition IS NOT NULL AND condition <> '' AND len(list_filter(string_split(condition, ','), lambda x: x NOT IN ('direct', 'cot', 'noisy', 'synth'))) = 0 AND instruction IS NOT NULL AND response IS NOT NULL")
def tokenized_round_trip(s, d):
    return tokenize.detokenized(_tokenized(s, d), _spec()).select("rec_id", "condition", "instruction", "response")


# --- Manifests.

_SAME = " AND ".join(f"b.{k} = n.{k}" for k in incremental.KEY)


@query(f"SELECT DISTINCT task, path, source_size, source_mtime, tokenizer_hash FROM file_manifest n WHERE run_no = 6 AND NOT EXISTS (SELECT 1 FROM file_manifest b WHERE b.run_no = 5 AND b.status = 'ok' AND {_SAME})")
def manifest_changed(s, d):
    m = read(s, d, "file_manifest")
    return incremental.changed(m.where("run_no = 6"), m.where("run_no = 5"))


@query("SELECT DISTINCT task FROM file_manifest WHERE run_no < 6 AND task IS NOT NULL AND task NOT IN (SELECT task FROM file_manifest WHERE run_no = 6 AND task IS NOT NULL)")
def manifest_orphans(s, d):
    m = read(s, d, "file_manifest")
    return incremental.orphans(m.where("run_no = 6"), m.where("run_no < 6"))


@query("SELECT run_no, task, CAST(count(*) AS BIGINT) AS entries FROM file_manifest GROUP BY run_no, task HAVING NOT bool_or(coalesce(status = 'ok', false))")
def manifest_failures(s, d):
    return incremental.failures(read(s, d, "file_manifest"))


def queries() -> dict[str, Query]:
    from corpusloom.plans import round_trips  # noqa: F401  (registers its queries)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from corpusloom.plans import round_trips  # noqa: F401

    return dict(SQL)
