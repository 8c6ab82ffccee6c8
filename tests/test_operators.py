import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.operators import decontam, external, filters, relations, sampling, state, stats, vectors
from siltworks.sources import files
from siltworks.streaming import ingest


def test_first_per_key_and_rates(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None), (None, 0, "z")], "k string, o int, v string")
    assert sorted(map(tuple, relations.first_per_key(df, "k", ["o"]).collect())) == [("a", 1, "y"), ("b", 1, None)]
    assert relations.first_per_key(df.limit(0), "k", ["o"]).count() == 0
    rates = {r["v"]: r["rate"] for r in relations.dedup_rates(df.withColumn("v", F.lit("s")), "k", "v").collect()}
    assert rates["s"] == 50.0


def test_overlay_falls_through_empty_values(spark):
    base = spark.createDataFrame([("a", "math", None), ("b", "", "hard"), ("c", None, "")], "id string, domain string, difficulty string")
    new = spark.createDataFrame([("a", "", "easy"), ("b", "code", None), ("b", "code", None)], "id string, domain string, difficulty string")
    out = relations.overlay(base, new, "id", {"domain": F.lit("general"), "difficulty": F.lit("medium")})
    assert sorted(map(tuple, out.select("id", "domain", "difficulty").collect())) == [("a", "math", "easy"), ("b", "code", "hard"), ("c", "general", "medium")]


def test_union_and_defaults(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    assert sorted(map(tuple, relations.union_all(a, b).collect()), key=str) == [(1, None), (2, "q")]
    assert relations.with_columns_or(a, {"x": F.lit(9), "z": F.lit("d")}).first().asDict() == {"x": 1, "z": "d"}


ITEM = "a1 a2 a3 a4 a5 a6 a7 a8 a9 b1 b2 b3 b4 b5"


def test_decontaminate_matches_brute_force(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 6, 9, 14, 20])))) for i in range(30)]
    pool = [(f"p{i}", " ".join(rng.choices(words, k=25) + (items[i % 30][1].split() if i % 4 == 0 else []))) for i in range(80)] + [(None, ITEM), ("e", ""), ("n", None)]
    n, least = 13, 5
    grams = {}
    for i, t in items:
        t = t.split()
        for g in [t[k : k + n] for k in range(len(t) - n + 1)] or ([t] if len(t) >= least else []):
            grams.setdefault(tuple(g), i)
    want = {}
    for p, t in pool:
        t = (t or "").split()
        for size in sorted({len(g) for g in grams}):
            hit = next((grams[tuple(t[k : k + size])] for k in range(len(t) - size + 1) if tuple(t[k : k + size]) in grams), None)
            if hit is not None and p:
                want[p] = hit
                break
    df, ev = spark.createDataFrame(pool, "id string, text string"), spark.createDataFrame(items, "item int, question string")
    clean, hits = decontam.decontaminate(df, "id", "text", ev, "item", "item", "question")
    assert {r["id"]: r["owner"] for r in hits.collect()} == want
    assert {r["id"] for r in clean.collect()} == {p for p, _ in pool} - set(want)
    grams_, short = decontam.item_grams(ev, "item", "item", "question"), decontam.short_items(ev, "item", "question")
    report = {(r["section"], r["name"]): r["value"] for r in decontam.removal_report(df.withColumn("source", F.lit("s")), hits, "id", "text", "source", grams_, short).collect()}
    assert report["total", "removed"] == report["removed by source", "s"] == len(want) and report["total", "in"] == len(pool)
    audit = decontam.removed_rows(df, hits, "id", "text").collect()
    assert {r["id"]: r["text"] for r in audit} == {p: t for p, t in pool if p in want}
    assert decontam.short_items(ev, "item", "question").agg(F.sum("n")).first()[0] == sum(len(t.split()) < 5 for _, t in items)
    with pytest.raises(ValueError):
        decontam.item_grams(ev, "item", "item", "question", n=3, least=5)


def test_rows_without_a_key_are_cleaned_by_their_text(spark):
    pool = [(None, f"see {ITEM} there"), (None, "nothing of the kind is here"), ("a", ITEM), ("a", "something else of the same key"), ("b", None), (None, None)]
    df, ev = spark.createDataFrame(pool, "id string, text string"), spark.createDataFrame([(1, ITEM)], "item int, question string")
    clean, hits = decontam.decontaminate(df, "id", "text", ev, "item", "item", "question")
    assert sorted(map(tuple, clean.collect()), key=str) == sorted([(None, "nothing of the kind is here"), ("b", None), (None, None)], key=str)
    assert len(hits.collect()) == 2
    assert decontam.decontaminate(df, "id", "text", ev.limit(0), "item", "item", "question")[0].count() == len(pool)


def test_run_state(spark, tmp_path):
    s = state.RunState(spark, str(tmp_path / "run"))
    assert not s.is_complete("one") and s.stages().count() == 0
    s.stage("one", "started")
    s.stage("one", "complete", "12 rows")
    s.stage("two", "started")
    s.stage("two", "failed", "no space")
    assert [tuple(r)[:2] for r in s.stages().collect()] == [("one", "complete"), ("two", "failed")] and s.is_complete("one") and not s.is_complete("two")
    with pytest.raises(ValueError):
        s.stage("one", "odd")
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "item string")
    assert s.pending(items, "one").count() == 4
    s.mark(spark.createDataFrame([("a", "success"), ("b", "failed"), ("c", "skipped")], "item string, status string"), "one")
    assert sorted(r[0] for r in s.pending(items, "one").collect()) == ["b", "d"] and s.pending(items, "two").count() == 4
    s.mark(spark.createDataFrame([("b", "success"), ("a", "failed")], "item string, status string"), "one")
    assert sorted(r[0] for r in s.pending(items, "one").collect()) == ["a", "d"]
    s.publish("s1", {"rows": 5, "removed": 1})
    s.publish("s1", {"rows": 99, "removed": 99})
    s.publish("s2", {"rows": 7, "removed": 0})
    assert dict(map(tuple, s.counters().collect())) == {"rows": 12, "removed": 1}


def test_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    rows = [(i, x[i].tolist(), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = np.stack([unit[np.arange(60) % 3 == k].mean(0) for k in range(3)])
    centre /= np.linalg.norm(centre, axis=1, keepdims=True)
    got = {r["cluster"]: r["centroid"] for r in vectors.centroids(df, "label", "embedding").collect()}
    assert np.allclose([got[k] for k in range(3)], centre, atol=1e-6)
    near = {r["vec_id"]: r["cluster"] for r in vectors.nearest_centre(df, "vec_id", "embedding", vectors.centroids(df, "label", "embedding")).collect()}
    assert [near[i] for i in range(60)] == (unit @ centre.T).argmax(1).tolist()
    top = vectors.search(df.where("vec_id < 3").withColumnRenamed("vec_id", "q"), "q", df, "vec_id", "embedding", 5, block=2)
    want = np.argsort(-np.round(unit[:3] @ unit.T, 6), axis=1, kind="stable")[:, :5]
    assert [[r["vec_id"] for r in sorted(top.where(f"q = {q}").collect(), key=lambda r: r["rank"])] for q in range(3)] == want.tolist()
    missing = spark.createDataFrame([(99, None, 1), (98, [1.0] * 8, None)], "vec_id long, embedding array<float>, label int")
    sims = {r["vec_id"]: r["centroid_sim"] for r in vectors.own_similarity(df.unionByName(missing), "label", "embedding").collect()}
    assert sims[99] == sims[98] == 0.5 and sims[0] == pytest.approx(float(unit[0] @ centre[0]), abs=1e-6)
    assert vectors.search(df.limit(0).withColumnRenamed("vec_id", "q"), "q", df, "vec_id", "embedding", 5).count() == 0


def test_kmeans_separates_clear_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (np.eye(3)[i % 3] * 5 + rng.normal(0, 0.1, 3)).tolist()) for i in range(90)]
    out, _ = vectors.spherical_kmeans(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v", 3, rounds=6, seed=5)
    groups = {}
    for r in out.collect():
        groups.setdefault(r["id"] % 3, set()).add(r["cluster"])
    assert out.count() == 90 and all(len(g) >= 1 for g in groups.values())


def brute_sample(rows, total, seed):
    """Cell by cell, in turn from each shuffled cluster, central rows first and then the outermost inwards."""
    rng, out = random.Random(seed), []
    for d, x, target in sampling.cell_targets(total, {"m": 0.6, "c": 0.4}, {"default": {"e": 0.5, "h": 0.5}}):
        cell = [r for r in rows if r[1] == d and r[2] == x]
        by = {}
        for r in sorted(cell, key=lambda r: (-r[4], r[0])):
            by.setdefault(r[3], []).append(r[0])
        ids = sorted(by)
        rng.shuffle(ids) if ids else None
        queues = [[by[c][0], *reversed(by[c][1:])] for c in ids]
        taken = []
        for turn in range(max(map(len, queues), default=0)):
            taken += [q[turn] for q in queues if turn < len(q)]
        out += taken[:target] if target > 0 else []
    return out


@pytest.mark.parametrize("total", [0, 10, 37, 400])
def test_round_robin_matches_brute_force(spark, total):
    rng = random.Random(3)
    rows = [(f"r{i:03d}", rng.choice("mc"), rng.choice("eh"), rng.randint(-1, 5), rng.choice([0.1, 0.5, 0.9])) for i in range(150)] + [("z", "other", "e", 1, 0.5), ("y", None, None, None, None)]
    df = spark.createDataFrame(rows, "prompt_id string, domain string, difficulty string, cluster_id int, centroid_sim double")
    quotas = {"domains": {"m": 0.6, "c": 0.4}, "difficulties": {"default": {"e": 0.5, "h": 0.5}}}
    got = sampling.quota_round_robin(df, total, "prompt_id", order="python", seed=9, **quotas)
    assert sorted(r["prompt_id"] for r in got.collect()) == sorted(brute_sample(rows[:150], total, 9))
    with pytest.raises(ValueError):
        sampling.cell_targets(10, {"m": 0.5})


def test_statistics(spark):
    df = spark.createDataFrame([("m", "a", [" x ", "y", ""], 1), ("m", "b", ["x"], 1), ("c", "a", None, 2), ("", None, [], -1), (None, "a", ["y"], None)], "domain string, difficulty string, topics array<string>, cluster_id int")
    assert sorted(map(tuple, stats.value_counts(df, "domain").collect())) == [("c", 1), ("m", 2)]
    assert [tuple(r) for r in stats.list_counts(df, "topics", 2).collect()] == [("x", 2), ("y", 2)]
    assert sorted(map(tuple, stats.cross_tab(df, "domain", "difficulty", ["a", "z"]).collect())) == [("c", 1, 0), ("m", 1, 0)]
    assert sorted(map(tuple, stats.cluster_sizes(df).collect())) == [(1, 2), (2, 1)]
    hist = stats.size_histogram(stats.cluster_sizes(df), (0, 2, 5))
    assert sorted(tuple(r)[:3] for r in hist.collect()) == [(0, 2, 1), (2, 5, 1), (5, None, 0)]
    assert stats.histogram_median(hist).first()[0] == 2.0
    assert {r["cluster_id"]: r["domain"] for r in stats.dominant_label(df, "cluster_id", "domain").collect()} == {1: "m", 2: "c"}
    assert all(f(df.limit(0)).count() == 0 for f in (lambda d: stats.value_counts(d, "domain"), stats.cluster_sizes, lambda d: stats.top_per_group(d, "domain", "topics", 3)))


def test_confusion_with_empty_denominators(spark):
    df = spark.createDataFrame([(True, True), (True, True)], "p boolean, g boolean")
    r = filters.confusion(df, F.col("p"), F.col("g")).first()
    assert (r["tn"], r["precision"], r["recall"], r["accuracy"]) == (2, None, None, 1.0)
    assert filters.confusion(df.limit(0), F.col("p"), F.col("g")).first()["tp"] == 0


def test_jsonl_sets_bad_lines_apart(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"prompt_id": "1", "prompt": "x"}\n\n{broken\n{"prompt_id": "2"}\n')
    good, bad = files.read_jsonl(spark, str(tmp_path / "*.jsonl"), files.PROMPT)
    assert sorted(r["prompt_id"] for r in good.collect()) == ["1", "2"] and [r["line"] for r in bad.collect()] == ["{broken"]
    good, bad = files.read_jsonl(spark, str(tmp_path / "none.jsonl"), files.PROMPT)
    assert good.count() == 0 and bad.count() == 0
    assert files.count_lines(spark, str(tmp_path / "a.jsonl")) == 3
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "*.jsonl"), files.PROMPT, strict=True)[0].collect()


def test_corpus_and_writers(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.txt").write_text("t" * 150)
    (src / "b.md").write_text("short")
    (src / "c.jsonl").write_text(json.dumps({"text": "j" * 120}) + "\n" + json.dumps({"text": "k"}) + "\n")
    corpus = files.read_corpus(spark, str(src))
    assert sorted(r["doc_id"].split(":")[0] for r in corpus.collect()) == ["a.txt", "c.jsonl"]
    files.write_jsonl(corpus, str(tmp_path / "out"), shard_bytes=2000, row_bytes=2000)
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    files.write_snapshot(corpus, str(tmp_path / "snap"), {"rows": 2})
    assert spark.read.parquet(str(tmp_path / "snap" / "snapshot.parquet")).count() == 2


def test_final_records_number_rows_without_ids(spark):
    df = spark.createDataFrame([(3, None, "c"), (1, "", "a"), (2, "x", "b"), (4, None, None)], "o int, prompt_id string, prompt string").repartition(3)
    rows = {r["prompt"]: r for r in files.final_records(df, ["o"]).collect()}
    assert rows["a"]["id"] == "gen_0000000000" and rows["c"]["id"] == "gen_0000000001" and rows[""]["id"] == "gen_0000000002" and rows["b"]["id"] == "x"
    assert rows["a"]["domain"] == "general" and rows["a"]["language"] == "en"


def test_new_shards_are_taken_once(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = T.StructType([T.StructField("x", T.LongType())])
    for n in range(2):
        spark.range(n * 5, n * 5 + 5).select(F.col("id").alias("x")).coalesce(1).write.mode("append").json(src)
        ingest.process_new(ingest.new_shards(spark, src, schema), lambda d: d.select("x"), out, check)
        assert sorted(r[0] for r in spark.read.parquet(out).collect()) == list(range(n * 5 + 5))


def test_model_calls(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "id int, prompt string")
    out = {r["id"]: r["output"] for r in external.call_model(df, "id", "prompt", external.echo_client, wait=0).collect()}
    assert out[1] == "<think>The prompt has 3 words.</think><answer>a b c</answer>" and "0 words" in out[2]
    calls = []

    def flaky(x):
        calls.append(x)
        raise OSError

    assert external.with_retries(flaky, attempts=3, wait=0)("q") is None and len(calls) == 3
    assert np.allclose(np.linalg.norm(vectors.hashed_embedding(["a b", "c"]), axis=1), 1)
