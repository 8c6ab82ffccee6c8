"""Vectors at size: blocks of centres, sums without explosion, inverted file, ranks of hot groups, clustering of prompts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltworks.operators import sampling, vectors


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(8, 12)) * 3
    x = np.concatenate([c + rng.normal(size=(60, 12)) for c in centre]).astype(np.float32)
    return x, spark.createDataFrame([(i, x[i].tolist(), i // 60) for i in range(len(x))], "vec_id long, embedding array<float>, label int").cache()


def test_blocks_of_centres_change_nothing(points):
    _, df = points
    c = vectors.centroids(df, "label", "embedding")
    whole, parts = (sorted(tuple(r)[:2] for r in vectors.nearest_centre(df, "vec_id", "embedding", c, block_bytes=b).collect()) for b in (1 << 27, 12 * 8 * 2))
    assert whole == parts


def test_centroids_with_more_clusters_than_a_task_holds(points, monkeypatch):
    x, df = points
    monkeypatch.setattr(vectors, "HELD_CLUSTERS", 3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    frames = pd.DataFrame({"cluster": np.arange(len(x)) % 7, "v": list(x)})
    got = pd.concat(vectors._sums(iter([frames[:200], frames[200:]]), True))
    for c, g in got.groupby("cluster"):
        assert np.allclose(np.sum(g["v"].tolist(), axis=0), unit[np.arange(len(x)) % 7 == c].sum(0)) and g["n"].sum() == (np.arange(len(x)) % 7 == c).sum()
    nulls = df.withColumn("label", F.when(F.col("label") > 2, F.col("label")))
    assert sorted(r["cluster"] for r in vectors.centroids(nulls, "label", "embedding").collect()) == [3, 4, 5, 6, 7]


def test_kmeans_has_no_empty_clusters_and_finds_the_groups(points):
    _, df = points
    near, centres = vectors.spherical_kmeans(df, "vec_id", "embedding", 8)
    got = near.toPandas()
    assert got["cluster"].nunique() == centres.count() == 8
    # Many copies of one vector make empty clusters at the start.
    copies = df.where("label < 2").select("vec_id", "embedding").unionAll(df.where("vec_id = 0").select(F.explode(F.sequence(F.lit(1000).cast("long"), F.lit(1300).cast("long"))).alias("vec_id"), "embedding"))
    near, _ = vectors.spherical_kmeans(copies, "vec_id", "embedding", 4)
    assert near.count() == copies.count()
    e, c = vectors.euclidean_kmeans(df, "vec_id", "embedding", 8)
    assert e.count() == df.count() and c.count() == 8


def test_inverted_file_recall(points):
    _, df = points
    index, centres = vectors.ivf_index(df, "vec_id", "embedding", cells=12)
    assert index.count() == df.count()
    q = df.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = {(r["query_id"], r["vec_id"]) for r in vectors.search(q, "query_id", df, "vec_id", "embedding", 10).collect()}
    for probes, least in ((12, 1.0), (4, 0.9)):
        got = {(r["query_id"], r["vec_id"]) for r in vectors.ivf_search(q, "query_id", index, centres, "vec_id", "embedding", 10, probes=probes).collect()}
        assert len(got & exact) / len(exact) >= least


def test_ranks_of_a_hot_group(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), "hot" if i % 3 else (None if i % 2 else f"g{i % 5}"), float(rng.integers(0, 50))) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    got = sampling.ranked(df, ["g"], ["x", "id"], "r", "n").toPandas()
    for _, part in got.groupby("g", dropna=False):
        part = part.sort_values(["x", "id"])
        assert part["r"].tolist() == list(range(1, len(part) + 1)) and (part["n"] == len(part)).all()
    assert len(got) == 900 and sampling.ranked(df.limit(0), ["g"], ["x", "id"]).count() == 0


def test_cluster_prompts_and_groups(spark):
    rows = [(f"p{i}", f"prove the theorem about the integral number {i}") for i in range(30)] + [(f"q{i}", f"write python code for the function number {i}") for i in range(30)]
    p = spark.createDataFrame(rows, "prompt_id string, prompt string")
    v = vectors.embed(p.where("prompt_id <> 'p3'"), "prompt_id", "prompt")
    out = {r["prompt_id"]: r for r in vectors.cluster_prompts(p, "prompt_id", "prompt", v, "embedding", 2).collect()}
    assert len(out) == 60 and out["p3"]["cluster_id"] == -1 and out["p3"]["centroid_sim"] == 0.5
    assert len({out[f"q{i}"]["cluster_id"] for i in range(30)}) == 1 and {out[f"q{i}"]["domain"] for i in range(30)} == {"code"}
    c = spark.createDataFrame([(i, [float(i % 2), 1.0 - i % 2, 0.01 * i]) for i in range(20)], "cluster long, centroid array<double>")
    groups = vectors.group_centroids(c).collect()
    assert len(groups) == 20 and len({r["topic"] for r in groups}) > 1
    assert vectors.group_centroids(c.limit(1)).first()["topic"] == 0


def test_hashed_embedding_is_unit_and_of_the_last_words():
    a = vectors.hashed_embedding(pd.Series(["one two", "", None, "x " * 600 + "one two"]))
    assert np.allclose(np.linalg.norm(a, axis=1), [1, 0, 0, 1]) and (a[1] == 0).all()
    assert np.allclose(vectors.hashed_embedding(pd.Series(["lead " + "w " * 512])), vectors.hashed_embedding(pd.Series(["w " * 512])))
