from pyspark.sql import functions as F

from corpusloom.operators import recipes as R
from corpusloom.operators.recipes import RECIPES
from corpusloom.schema import quarantine


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_there():
    assert len(RECIPES) == 24  # and tasksource, whose list is a parameter


def test_every_recipe_on_an_empty_table_and_with_extra_columns(spark):
    for name, r in RECIPES.items():
        out = r(spark.createDataFrame([], r.schema).withColumn("response_", F.lit(1)).withColumn("extra", F.lit("x")))
        assert out.count() == 0 and set(out.columns) >= {"condition", "instruction", "response"}, name
        assert r.broken(spark.createDataFrame([], r.schema)).count() == 0


def test_every_recipe_takes_nulls(spark):
    for name, r in RECIPES.items():
        n = len(spark.createDataFrame([], r.schema).columns)
        df = spark.createDataFrame([tuple([None] * n)] * 2, r.schema)
        good, bad = quarantine(r(df).select("condition", "instruction", "response"))
        assert good.count() + bad.count() <= 4, name


def test_contracts(spark):
    gsm = RECIPES["gsm8k_train"]
    df = spark.createDataFrame([(" q ", "work #### 7 "), ("q", "no mark"), ("q", "#### 1#### 2")], gsm.schema)
    assert rows(gsm(df)) == [("direct", "q", "7")]
    assert gsm.broken(df).count() == 2
    ace = RECIPES["acereason"]
    df = spark.createDataFrame([("math", "q", "<think>a</think> r"), ("math", "q", "none"), ("code", "q", "none")], ace.schema)
    assert rows(ace(df)) == [("synth,cot", "q", " r")] and ace.broken(df).count() == 1


def test_null_is_not_a_source(spark):
    df = spark.createDataFrame([("p", "s", "a", None), ("p", "s", "b", "math"), ("p", "s", "c", "aug")], RECIPES["openmathinstruct2"].schema)
    assert [r.response for r in RECIPES["openmathinstruct2"](df).where("task = 'direct'").orderBy("response").collect()] == ["a", "c"]


def test_chat(spark):
    r = RECIPES["no_robots"]
    m = lambda *x: ([dict(zip(("role", "content"), y)) for y in x],)
    df = spark.createDataFrame([m(("user", "a"), ("assistant", "b"), ("user", "c")), m(("system", "s"), ("user", "a"), ("assistant", "b")), m(("system", "s"), ("user", "a")), m(("assistant", "b"), ("user", "a")), m(), (None,)], r.schema)
    assert rows(r(df)) == [("cot", "a", "b"), ("cot", "s\n\na", "b")]
    t = RECIPES["openthoughts2"]
    chat = lambda s, q, a: (s, [{"from": "user", "value": q}, {"from": "assistant", "value": a}])
    df = spark.createDataFrame([chat("x", "q", "<think>z</think>a"), chat(None, "q", "b"), chat("dolphin", "q", "a"), chat("x", "in Python", "a"), chat("x", "q", "```"), ("x", [])], t.schema)
    assert rows(t(df)) == [("synth,cot", "q", "a"), ("synth,cot", "q", "b")] and t.broken(df).count() == 1


def test_archive_members(spark):
    r = RECIPES["ampsmathematica"]
    df = spark.createDataFrame([("amps/mathematica/alg/sum_w_steps/1.txt", b"Problem: p Answer: 1 Answer: 2"), ("a/b/1.txt", b"x Problem: p Answer: a"), ("x/khan/alg/sum/1.txt", b"Answer: a"), ("a/b/2.txt", b"Problem:Answer: a"), ("a/b/3.txt", b"\xff Answer: b"), ("a/b/4.txt", b"no tag"), ("b/1.txt", b"q Answer: r")], r.schema)
    assert rows(r(df)) == [("noisy,cot", "p", "1 Answer: 2", "alg_sum_w_steps"), ("noisy,direct", "x Problem: p", "a", "a_b")]


def test_synth_and_allowlist(spark):
    r = RECIPES["SYNTH"]
    df = spark.createDataFrame([("en", "u", "rag", "q", "c", "a"), ("en", None, "rag", "q", "c", "a"), ("en", "u", "cooking", "q", "c", "a"), ("en", "u", "poem", "q", "c", "a"), ("de", "u", "mcq", "q", "c", "a")], r.schema)
    out = r(df)
    assert rows(out) == [("", "q", "a"), ("synth,cot", "qc", "a")]
    good, bad = quarantine(out)
    assert good.count() == 1 and bad.first().violation == "no_condition"
    tasks = spark.createDataFrame([("a/b",), ("c",)], "task string")
    raw = spark.createDataFrame([("a/b", "i", "yes."), ("d", "i", "no")], "task string, inputs string, targets string")
    assert rows(R.tasksource(raw, tasks)) == [("direct", "i", "yes", "a_b")]
    assert [x.task for x in R.tasks_not_found(raw, tasks).collect()] == ["c"]


def test_quarantine(spark):
    df = spark.createDataFrame([("direct", "a", "b"), ("", "a", "b"), (None, "a", "b"), ("cot,x", "a", "b"), ("cot", None, "b"), ("cot", "a", None)], "condition string, instruction string, response string")
    good, bad = quarantine(df)
    assert good.count() == 1 and sorted(r.violation for r in bad.collect()) == ["no_condition", "no_condition", "null_instruction", "null_response", "unknown_tag"]
    assert quarantine(df, null_as_empty=True)[0].count() == 3
