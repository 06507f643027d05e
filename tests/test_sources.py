import io
import json
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom import pipeline
from corpusloom.operators import incremental, tokenize
from corpusloom.sources import exports, readers
from corpusloom.streaming import ingest


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_json(spark, tmp_path):
    put(f"{tmp_path}/a/x.json", json.dumps([{"instruction": "i", "response": "r"}, {"instruction": "j", "response": None}]))
    put(f"{tmp_path}/a/b/y.json", json.dumps({"instruction": "k", "response": "s"}))
    got = readers.json_array(spark, f"{tmp_path}/a", "instruction string, response string").collect()
    assert sorted((r.file, r.instruction) for r in got) == [("x.json", "i"), ("x.json", "j"), ("y.json", "k")]
    ok = {"condition": "cot", "instruction": "i", "response": "r", "more": 1}
    lines = [json.dumps(ok), json.dumps(ok | {"response": 5}), json.dumps(ok | {"response": None}), json.dumps({"condition": "cot"}), "{broken", ""]
    put(f"{tmp_path}/l.jsonl", "\n".join(lines))
    good, bad = readers.json_lines(spark, f"{tmp_path}/l.jsonl")
    assert [(r.condition, r.instruction, r.response) for r in good.collect()] == [("cot", "i", "r")]
    assert sorted(r.reason for r in bad.collect()) == ["no_instruction", "not_json", "response_not_text", "response_not_text"]
    assert readers.records(spark, f"{tmp_path}/l.jsonl").count() == 1
    with pytest.raises(ValueError):
        readers.records(spark, "x.txt")


def test_text_csv_tar(spark, tmp_path):
    put(f"{tmp_path}/d/train-easy/a.txt", "q1 \na1\nq2\n a2\n")
    put(f"{tmp_path}/d/train-easy/odd.txt", "q1\na1\nq2")
    put(f"{tmp_path}/d/train-hard/empty.txt", "")
    got = readers.alternating_lines(spark, f"{tmp_path}/d").orderBy("pair").collect()
    assert [(r.subset, r.file, r.pair, r.instruction, r.response) for r in got] == [("train-easy", "a.txt", 0, "q1", "a1"), ("train-easy", "a.txt", 1, "q2", "a2")]
    assert [r.file for r in readers.odd_files(spark, f"{tmp_path}/d").collect()] == ["odd.txt"]
    put(f"{tmp_path}/c.csv", "source,question,answer,rating\ns,1.2,3,4\n")
    assert tuple(readers.csv_by_place(spark, f"{tmp_path}/c.csv", "source", "q", "a", "rating").first()) == ("s", "1.2", "3", "4")
    with tarfile.open(f"{tmp_path}/t.tar.gz", "w:gz") as t:
        for name, body in (("m/a/b/1.txt", b"x"), ("m/a/b/2.bin", b"y"), ("m/a/b/3.txt", b"\xff")):
            i = tarfile.TarInfo(name)
            i.size = len(body)
            t.addfile(i, io.BytesIO(body))
    assert sorted((r.path, bytes(r.content)) for r in readers.tar_members(spark, f"{tmp_path}/t.tar.gz").collect()) == [("m/a/b/1.txt", b"x"), ("m/a/b/3.txt", b"\xff")]


def test_lines_of_files_in_blocks(spark, tmp_path):
    body = [f"{'q' if i % 2 == 0 else 'a'}{i // 2} " + "x" * (i % 90) for i in range(4000)]
    put(f"{tmp_path}/d/s/big.txt", "\r\n".join(body))
    put(f"{tmp_path}/d/s/small.txt", "\n".join(body[:10]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = readers.alternating_lines(spark, f"{tmp_path}/d").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {("big.txt", i, body[2 * i].strip(), body[2 * i + 1].strip()) for i in range(2000)} | {("small.txt", i, body[2 * i].strip(), body[2 * i + 1].strip()) for i in range(5)}
    assert len(got) == len(want) and {(r.file, r.pair, r.instruction, r.response) for r in got} == want


def test_tokenizer_files(tmp_path):
    from tokenizers import Tokenizer, models

    t = Tokenizer(models.BPE({"a": 0, "b": 1, "ab": 2}, [("a", "b")]))
    t.add_special_tokens(["<q>"])
    exports.tokenizer_files(t.to_str(), f"{tmp_path}/t", boq="<q>", eoq="<q>", eoa="<q>", conditions={"cot": "<q>"})
    again = Tokenizer.from_file(f"{tmp_path}/t/tokenizer.json")
    assert again.encode("abb").ids == t.encode("abb").ids and "model_type" in readers.tokenizer_info(f"{tmp_path}/t/config.json")
    info = readers.tokenizer_info(f"{tmp_path}/t/tokenizer_info.json")
    assert info["vocab_size"] == t.get_vocab_size(True) == 4 and info["condition_mapping"] == {"cot": "<q>"}


def test_small_files_by_any_file_system(spark, tmp_path):
    p = f"file:{tmp_path}/f/x.json"
    assert exports.read_text(spark, p) is None
    for text in ("one — ü", "two"):
        exports.write_text(spark, p, text)
        assert exports.read_text(spark, p) == text
    exports.remove(spark, f"file:{tmp_path}/f")
    exports.remove(spark, f"file:{tmp_path}/f")
    assert not os.path.exists(f"{tmp_path}/f")


def test_listing_policy(spark, tmp_path):
    for p in ("r1/a/x.parquet", "r1/y.jsonl", "r1/z.txt", "r2/w.jsonl"):
        put(f"{tmp_path}/{p}", "abc")
    got = readers.listing(spark, f"{tmp_path}/r1", f"{tmp_path}/r2").collect()
    assert sorted((r.task, r.source_size) for r in got) == [("a__x.parquet", 3), ("w.jsonl", 3), ("y.jsonl", 3)]
    put(f"{tmp_path}/r2/y.jsonl", "abc")
    with pytest.raises(ValueError):
        readers.listing(spark, f"{tmp_path}/r1", f"{tmp_path}/r2")
    text = '# order\n- prefix: "a__"\n  max_per_file: 20_000\n- prefix: b\n  repeat: 10\n  long_context: drop\n'
    want = [(0, "a__", 20000, "truncate", 1), (1, "b", None, "drop", 10)]
    assert [tuple(r) for r in readers.policy_yaml(spark, text).collect()] == want
    assert readers._simple_yaml(text)[1] == {"prefix": "b", "repeat": 10, "long_context": "drop"}
    with pytest.raises(ValueError):
        readers.policy_yaml(spark, "- prefix: a\n  cap: 1\n")


def test_arrays(spark, tmp_path):
    rows = spark.createDataFrame([(0, [1, 2, 3]), (3, [9]), (4, [])], "start bigint, tokens array<int>")
    exports.flat_tokens(rows, f"{tmp_path}/tokens.npy", vocabulary=300)
    x = np.load(f"{tmp_path}/tokens.npy")
    assert x.tolist() == [1, 2, 3, 9] and x.dtype == np.uint16
    drawn = spark.createDataFrame([(0, 1, 5, 1, 6, 2), (0, 0, 7, 1, 8, 2), (1, 0, 5, 1, 6, 2)], "epoch int, pos bigint, inst_start bigint, inst_len bigint, resp_start bigint, resp_len bigint")
    exports.epoch_arrays(drawn, f"{tmp_path}/out")
    assert np.load(f"{tmp_path}/out/epoch_0/inst_start.npy").tolist() == [7, 5]
    assert readers.npy_column(spark, f"{tmp_path}/out").where("file like '%epoch_0/inst_start%'").orderBy("place").select("value").collect()[0].value == 7


def test_clustered_keeps_other_tasks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "task string, v string")
    exports.clustered(df, f"{tmp_path}/c")
    exports.clustered(df.where("task = 'a'").withColumn("v", F.lit("z")), f"{tmp_path}/c")
    assert sorted((r.task, r.v) for r in spark.read.parquet(f"{tmp_path}/c").collect()) == [("a", "z"), ("b", "y")]
    exports.sidecar(f"{tmp_path}/m.json", vocab_size=5)
    assert readers.tokenizer_info(f"{tmp_path}/m.json") == {"vocab_size": 5}


def test_manifests(spark):
    m = spark.createDataFrame([(1, "a", "p/a", 1, 1, "h", "ok"), (1, "b", "p/b", 1, 1, "h", "failed"), (1, "gone", "p/g", 1, 1, "h", "ok"), (1, "c", "p/c", None, 1, "h", "ok"), (2, "a", "p/a", 1, 1, "h", "ok"), (2, "a", "p/a", 1, 1, "h", "ok"), (2, "b", "p/b", 1, 1, "h", "ok"), (2, "c", "p/c", None, 1, "h", "ok"), (2, "d", "p/d", 1, 1, None, None)], "run_no int, task string, path string, source_size bigint, source_mtime bigint, tokenizer_hash string, status string")
    now, before = m.where("run_no = 2"), m.where("run_no = 1")
    assert sorted(r.task for r in incremental.changed(now, before).collect()) == ["b", "c", "d"]
    assert [r.task for r in incremental.orphans(now, before).collect()] == ["gone"]
    assert sorted((r.run_no, r.task) for r in incremental.failures(m).collect()) == [(1, "b"), (2, "d")]


def test_tokens(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"a": 128, "b": 129, "c": 130, "?": 131}, unk_token="?"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(f"{tmp_path}/t.json")
    spec = tokenize.Spec(f"{tmp_path}/t.json", 6, 7, 11, {"direct": 1, "cot": 2, "noisy": 3, "synth": 4})
    rec = spark.createDataFrame([(0, "noisy,cot", "a b", "c"), (1, "direct", "", "c c"), (2, "synth", None, None)], "row_id int, condition string, instruction string, response string")
    got = [(r.inst_tokens, r.resp_tokens, r.inst_len) for r in tokenize.tokenized(rec, spec).orderBy("row_id").collect()]
    assert got == [([6, 3, 2, 128, 129, 7], [130, 11], 6), ([6, 1, 7], [130, 130, 11], 3), ([6, 4, 7], [11], 3)]
    for bad in ("", "other"):
        with pytest.raises(Exception, match="unknown tag"):
            tokenize.tokenized(rec.where("row_id = 0").withColumn("condition", F.lit(bad)), spec).collect()


def test_pieces_like_the_library(spark):
    from tokenizers import Regex, pre_tokenizers

    cut = pre_tokenizers.Split(Regex(tokenize.PIECES), "isolated")
    texts = ["It's 12 o'clock,  NOW\n\n ok  x　y", "a\x1cb\x85c", "'RE we'LL", "   ", "x\r\n\r\n  y", "日本語 текст 123", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", tokenize.pieces(F.col("t")).alias("p")).collect():
        assert r.p == [x for x, _ in cut.pre_tokenize_str(r.t)]
    assert {r.piece: r.n for r in tokenize.piece_counts(spark.createDataFrame([("é é",), (None,)], "t string"), "t").collect()} == {"é": 1, " é": 1}


def test_stages_and_stream(spark, tmp_path):
    src = spark.createDataFrame([("q1", "a1"), ("q2", None), ("q3", "a3")], "question string, answer string")
    src.write.json(f"{tmp_path}/in")
    pipeline.clean(spark, pipeline.options(pipeline.Clean, ["recipe=webinstruct_verified", f"source={tmp_path}/in", f"out={tmp_path}/out", "format=json"]))
    assert spark.read.parquet(f"{tmp_path}/out/records").count() == 2 and spark.read.parquet(f"{tmp_path}/out/quarantine").count() == 1
    for _ in range(2):  # the second finds nothing new
        ingest.write_stream(ingest.clean_stream(spark, f"{tmp_path}/in", "webinstruct_verified"), f"{tmp_path}/s", f"{tmp_path}/ck").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/s/records").count() == 2 and spark.read.parquet(f"{tmp_path}/s/quarantine").count() == 1
    with pytest.raises(SystemExit):
        pipeline.options(pipeline.Clean, ["nothing=1"])


def test_sample_stage(spark, tmp_path):
    spark.sql("select 'a__x' task, id row_id, id*9 inst_start, 5L inst_len, id*9+5 resp_start, 4L resp_len, timestamp'2025-01-01' indexed_at from range(10)").write.parquet(f"{tmp_path}/i")
    put(f"{tmp_path}/p.yaml", "- prefix: a__\n  max_per_file: 4\n")
    text = pipeline.sample(spark, pipeline.options(pipeline.Sample, [f"index={tmp_path}/i", f"policy={tmp_path}/p.yaml", f"out={tmp_path}/o", "epochs=2"]))
    assert "8 out of 10" in text and readers.tokenizer_info(f"{tmp_path}/o/metadata.json") == {"max_seq_len": 4097, "total_length": 36}


def test_tokenize_stage(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"a": 10, "b": 11, "?": 12}, unk_token="?"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.save(f"{tmp_path}/t.json")
    exports.sidecar(f"{tmp_path}/info.json", boq=6, eoq=7, eoa=8, condition_mapping={"cot": 1, "direct": 2})
    line = lambda c, i, r: json.dumps({"condition": c, "instruction": i, "response": r}) + "\n"
    put(f"{tmp_path}/in/x.jsonl", line("cot", "a b", "b") + line("direct", "a", "a a"))
    put(f"{tmp_path}/in/sub/y.jsonl", line("cot", "a", "b"))
    put(f"{tmp_path}/in/bad.jsonl", line("odd", "a", "b"))
    put(f"{tmp_path}/in/torn.parquet", "PAR1 no more")
    spark.createDataFrame([("cot", "b")], "condition string, instruction string").coalesce(1).write.parquet(f"{tmp_path}/in/lacks")
    spark.createDataFrame([("cot", "b", None)], "condition string, instruction string, response string").coalesce(1).write.parquet(f"{tmp_path}/in/p")
    o = pipeline.options(pipeline.Tokenize, [f"roots={tmp_path}/in", f"tokenizer={tmp_path}/t.json", f"info={tmp_path}/info.json", f"out={tmp_path}/out"])
    got = pipeline.tokenized(spark, o)
    assert got["failed"][0] == "bad.jsonl" and got["failed"][-1] == "torn.parquet" and len(got["failed"]) == 3 and got["removed"] == [] and len(got["done"]) == 3 and {"x.jsonl", "sub__y.jsonl"} < set(got["done"])
    rows = {(r.task, r.row_id): r for r in spark.read.parquet(f"{tmp_path}/out/rows").collect()}
    x = rows["x.jsonl", 1]
    assert len(rows) == 4 and x.inst_tokens == [6, 2, 10, 7] and x.resp_tokens == [10, 10, 8] and (x.inst_start, x.resp_start) == (7, 11)
    os.remove(f"{tmp_path}/in/sub/y.jsonl")
    os.remove(f"{tmp_path}/in/torn.parquet")
    for f in os.listdir(f"{tmp_path}/in/lacks"):
        os.remove(f"{tmp_path}/in/lacks/{f}")
    put(f"{tmp_path}/in/bad.jsonl", line("cot", "a", "b"))
    again = pipeline.tokenized(spark, o)  # what failed before and is gone now leaves the manifest
    assert again["done"] == ["bad.jsonl"] and again["failed"] == [] and again["removed"] == sorted(["sub__y.jsonl", "torn.parquet", *(x for x in got["failed"] if x.startswith("lacks"))])
    assert {r.task for r in spark.read.parquet(f"{tmp_path}/out/rows").select("task").distinct().collect()} == {"x.jsonl", "bad.jsonl", *(k[0] for k in rows if k[0].startswith("p__"))}
    put(f"{tmp_path}/s/12__more.jsonl", line("cot", "a", "b"))
    assert readers.sized(spark.read.json(f"{tmp_path}/s")).select("rsize", "name").first() == (12, "more.jsonl")


def test_row_ids_in_blocks(spark):
    df = spark.range(0, 30_000, 1, 3).select(F.lit("a").alias("task"), (F.col("id") * 3 + F.expr("id div 10000 * 8589934592")).alias("_at"))
    got = readers.with_row_ids_in_blocks(df, "_at")
    want = {r._at: r.row_id for r in readers.with_row_ids(df, "_at").collect()}
    assert {r._at: r.row_id for r in got.collect()} == want and len(want) == 30_000
    # Only rows of a block are sorted together: every window of the plan that sees rows has the block among its keys.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("_b#" in x for x in plan.splitlines() if "Window [" in x)
