"""Sources and sinks in folders: sources by field, test sets, shards, versions, resumed writers, chunks, annotations."""

import json

import pytest
from pyspark.sql import functions as F

from siltworks.operators import external, parse, relations
from siltworks.sources import files


def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_read_source_takes_a_field_and_caps_prompts(spark, tmp_path):
    put(tmp_path / "in", "b.jsonl", [{"d": {"q": "a prompt of the second file"}}])
    put(tmp_path / "in", "a.jsonl", [{"d": {"q": "short"}}, "no json", "", {"d": {}}, {"d": {"q": [{"role": "user", "content": "a question in a chat"}]}, "odd": [1, {"x": 2}]}])
    path = str(tmp_path / "in" / "*.jsonl")
    got = sorted(r["prompt"] for r in files.read_source(spark, path, "d.q", "mine").collect())
    assert got == ["a prompt of the second file", "a question in a chat"]
    # The cap counts the short prompt, which the length filter takes out later.
    assert [r["prompt"] for r in files.read_source(spark, path, "d.q", "mine", cap=2).collect()] == ["a question in a chat"]
    assert files.read_source(spark, str(tmp_path / "none" / "*"), "q", "x").count() == 0


def test_eval_configs_and_splits(spark, tmp_path):
    for config, split, n in (("one", "test", 3), ("one", "dev", 2), ("two", "test", 4)):
        put(tmp_path / "set" / config / split, "x.jsonl", [{"q": f"{config} {split} {i}"} for i in range(n)])
    folder = str(tmp_path / "set")
    assert files.read_eval(spark, folder, configs="all", splits=["test", "gone"]).count() == 7
    assert files.read_eval(spark, folder, configs=["one"], splits=["test", "dev"]).count() == 5
    assert [r["q"] for r in files.read_eval(spark, folder, configs="all", splits=["test"], most=4).collect()] == ["one test 0", "one test 1", "one test 2", "two test 0"]
    assert files.read_eval(spark, folder, configs="gone") is None and files.read_eval(spark, folder + "/one", splits=["test"]).count() == 3
    assert files.read_export(spark, folder, "gone") is None


def test_numbered_corpus_and_ordered_vectors(spark, tmp_path):
    spark.range(50).select(F.concat(F.lit("text "), F.repeat(F.lit("x"), 100), "id").alias("text")).coalesce(1).write.parquet(str(tmp_path / "c"))
    ids = sorted(r["doc_id"] for r in files.numbered_corpus(spark.read.parquet(str(tmp_path / "c")), "org/set", "text").collect())
    assert ids == sorted(f"org/set:{i}" for i in range(50))
    spark.range(40).select("id", F.array(F.col("id").cast("double")).alias("v")).repartitionByRange(4, "id").write.parquet(str(tmp_path / "v"))
    assert [r["id"] for r in files.read_vectors(spark, str(tmp_path / "v"), "id", "v", ordered=True).collect()] == list(range(40))


def test_shards_stages_and_inputs(spark, tmp_path):
    put(tmp_path / "raw-1", "s2.jsonl", ["{}"])
    put(tmp_path / "raw-1", "s1.jsonl", ["{}"])
    put(tmp_path / "clean", "s1.jsonl", ["{}"])
    raw, clean = str(tmp_path / "raw-1"), str(tmp_path / "clean")
    rows = files.shard_listing(spark, [(raw, None), (clean, "pool")]).orderBy("place").collect()
    assert [(r["tag"], r["shard"].rsplit("/", 1)[1]) for r in rows] == [("raw_1", "s1.jsonl"), ("raw_1", "s2.jsonl"), ("pool", "s1.jsonl")]
    assert files.resolve_inputs(spark, {"one": clean, "two": clean + "x"}, {"one": raw, "two": raw, "three": raw + "x"}) == [("one", clean), ("two", raw)]
    assert files.detect_stage(spark, [("stage3", clean + "x"), ("stage1", raw)]) == "stage1" and files.detect_stage(spark, []) is None


def test_writers_go_on_and_versions_follow(spark, tmp_path):
    out, done = str(tmp_path / "out"), []
    df = spark.range(100).select("id", F.repeat(F.lit("y"), 90).alias("t")).coalesce(1)
    assert files.append_jsonl(df, out, shard_bytes=2000, done=done.append).endswith("shards-00000")
    assert files.append_jsonl(df, out, done=done.append).endswith("shards-00001") and len(done) == 2
    assert files.append_jsonl(df.limit(0), out) is None
    sizes = [p.stat().st_size for p in (tmp_path / "out" / "shards-00000").glob("*.json")]
    assert len(sizes) >= 5 and max(sizes) <= 2300
    assert spark.read.json(out + "/*").count() == 200
    files.write_by_shard(df.withColumn("shard", F.col("id") % 3), "shard", str(tmp_path / "by"))
    assert spark.read.json(str(tmp_path / "by" / "shard=1")).count() == 33
    a = spark.createDataFrame([("p", ["x", "y"])], "prompt_id string, topics array<string>")
    folder = str(tmp_path / "ann")
    assert files.load_annotations(spark, folder) is None
    files.save_annotations(a, folder)
    files.save_annotations(files.load_annotations(spark, folder).unionAll(a), folder)
    assert files.load_annotations(spark, folder).count() == 2 and files.load_annotations(spark, folder).first()["topics"] == ["x", "y"]


def test_imported_answers(spark, tmp_path):
    put(tmp_path, "r.jsonl", [{"prompt_id": "a", "response": "plain"}, {"prompt_id": "b", "response": {"domain": "math"}}, {"response": "x"}, "bad"])
    got = {r["prompt_id"]: r["response"] for r in files.import_answers(spark, str(tmp_path / "r.jsonl")).collect()}
    assert got == {"a": "plain", "b": '{"domain":"math"}'}


def test_token_chunks_cover_the_text(spark):
    text = "\n\n".join(f"Paragraph {i} says that the pump {i} drives the wheel and the mill. It goes on with a second sentence." for i in range(40))
    df = spark.createDataFrame([(1, text), (2, "short"), (3, None), (None, text)], "doc_id long, text string")
    c = parse.token_chunks(df, "doc_id", "text", "/opt/tokenizers/byte_bpe_50k.tiktoken", size=120, overlap=20).orderBy("chunk_no").collect()
    assert {r["doc_id"] for r in c} == {1} and len(c) > 5
    at = 0
    for r in c:
        k = text.find(r["chunk"].strip(), max(0, at - 400))
        assert 0 <= k <= at
        at = k + len(r["chunk"].strip())
    assert at >= len(text.strip()) - 1 and all(r["chunk"].rstrip().endswith((".", "wheel")) for r in c)


def test_generator_output_is_mended(spark):
    rows = ['Sure: ["a prompt that is long enough", "too short"]', '["a prompt that is long enough", ]', '["a prompt that is long enough", "one that brea', 'He said "a prompt that is long enough" twice', "", None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "t string").select(parse.parse_generated(F.col("t"))).collect()]
    assert got == [["a prompt that is long enough"]] * 4 + [[], []]


def test_json_in_fences_comes_first_and_missing_fields_are_null(spark):
    df = spark.createDataFrame([("x {1} ```json\n{\"a\": 1}\n``` {\"a\": 2}",), ("noise {\"a\": 3} noise",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(F.get_json_object(parse.json_object(F.col("t")), "$.a")).collect()] == ["1", "3", None, None]
    n = df.select(F.struct(F.struct(F.lit("v").alias("c")).alias("b")).alias("a"), F.create_map(F.lit("k"), F.lit("w")).alias("m"))
    assert n.select(parse.field(n, "a.b.c"), parse.field(n, "a.x.c"), parse.field(n, "zz"), parse.field(n, "m.k")).first()[:] == ("v", None, None, "w")


def test_annotation_goes_on_where_it_broke_off(spark, tmp_path):
    df = spark.createDataFrame([(f"p{i}", f"prompt {i}") for i in range(9)] + [("p0", "prompt 0"), (None, "x")], "prompt_id string, prompt string")

    def client():
        def ask(p):
            if p == "prompt 3":
                raise RuntimeError
            return '{"domain": "math", "difficulty": "hard", "language": "en", "topics": ["t"], "summary": "s"}'

        return ask

    folder = str(tmp_path / "a")
    first = external.annotate(df.where("prompt_id < 'p5'"), "prompt_id", "prompt", client, folder, every=2, wait=0.01)
    assert first.count() == 5
    rows = {r["prompt_id"]: r for r in external.annotate(df, "prompt_id", "prompt", client, folder, every=100, wait=0.01).collect()}
    assert len(rows) == 9 and rows["p1"]["domain"] == "math" and rows["p3"]["domain"] == "other" and rows["p3"]["difficulty"] == "medium"


def test_overlay_takes_the_last_update(spark):
    base = spark.createDataFrame([("a", "x")], "id string, domain string")
    new = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), (None, "z", 3)], "id string, domain string, at int")
    assert relations.overlay(base, new, "id", {"domain": F.lit("general")}, order="at").first()["domain"] == "new"
    with pytest.raises(ValueError):
        from siltworks.operators import decontam

        decontam.item_grams(new, "id", "at", "domain", n=2, least=5)
