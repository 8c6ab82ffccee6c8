"""Vectors: similarities, centroids, nearest centres, k-means, exact and inverted-file search, clustering of prompts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.session import stored


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where either vector is zero, null where one is missing."""
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).when(n == 0, 0.0)


def unit(a: Column, eps: float = 1e-8) -> Column:
    n = F.greatest(norm(a), F.lit(eps))
    return F.transform(a, lambda x: x.cast("double") / n)


#: Clusters whose sums a task holds at once; beyond that it passes them on and starts anew.
HELD_CLUSTERS = 4096


def _sums(batches: Iterator[pd.DataFrame], rows: bool) -> Iterator[pd.DataFrame]:
    """Sums of vectors by cluster: of single rows' unit vectors, or of partial sums."""
    held: dict[int, int] = {}
    total: np.ndarray | None = None
    n = np.zeros(HELD_CLUSTERS, np.int64)

    def out() -> pd.DataFrame:
        return pd.DataFrame({"cluster": list(held), "n": n[: len(held)], "v": list(total[: len(held)])})

    for b in batches:
        if not len(b):
            continue
        x = np.stack(b["v"].to_numpy()).astype(float)
        if rows:
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)
        names, at = np.unique(b["cluster"].to_numpy(), return_inverse=True)
        for lo in range(0, len(names), HELD_CLUSTERS):
            part = names[lo : lo + HELD_CLUSTERS].tolist()
            if held and len(held.keys() | part) > HELD_CLUSTERS:
                yield out()
                held, total, n = {}, None, np.zeros(HELD_CLUSTERS, np.int64)
            if total is None:
                total = np.zeros((HELD_CLUSTERS, x.shape[1]))
            for c in part:
                held.setdefault(c, len(held))
            use = (at >= lo) & (at < lo + HELD_CLUSTERS)
            place = np.array([held[c] for c in part])[at[use] - lo]
            np.add.at(total, place, x[use])
            np.add.at(n, place, 1 if rows else b["n"].to_numpy()[use])
    if held:
        yield out()


def centroids(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """(cluster, centroid): the mean of the unit vectors of each cluster, made unit again. Rows without a cluster or a vector
    are left out. Every task sums its rows by cluster, so a row a task and cluster is shuffled and no cluster is collected."""
    kind = df.schema[cluster].dataType.simpleString()
    rows = df.where(F.col(vector).isNotNull() & F.col(cluster).isNotNull()).select(F.col(cluster).cast("long").alias("cluster"), F.col(vector).alias("v"))
    schema = "cluster long, n long, v array<double>"
    parts = rows.mapInPandas(lambda b: _sums(b, True), schema).repartition("cluster").sortWithinPartitions("cluster")
    sums = parts.mapInPandas(lambda b: _sums(b, False), schema)
    mean = F.transform("v", lambda x: x / F.col("n"))
    return sums.select(F.col("cluster").cast(kind).alias("cluster"), unit(mean).alias("centroid"))


def own_similarity(df: DataFrame, cluster: str, vector: str, default: float = 0.5) -> DataFrame:
    """df with ``centroid_sim``: the cosine to the own cluster's centroid; the default without a vector or a cluster."""
    c = centroids(df.where(F.col(cluster) >= 0), cluster, vector).withColumnRenamed("cluster", cluster)
    return df.join(c, cluster, "left").withColumn("centroid_sim", F.coalesce(cosine(F.col(vector), F.col("centroid")), F.lit(default))).drop("centroid")


def nearest_centre(df: DataFrame, id_col: str, vector: str, centres: DataFrame, block_bytes: int = 1 << 27) -> DataFrame:
    """(id, cluster, sim): the centre of the highest inner product with the unit vector, the lowest cluster on ties.

    Centres are a model, not data: they are sent to the workers as matrices of at most ``block_bytes``, and a batch of
    vectors is one matrix product with each. More centres than fit one block mean more passes, of which the best are kept.
    """
    size = centres.agg(F.count("*").alias("n"), F.max(F.size("centroid")).alias("dims")).first()
    blocks = max(1, -(-(size["n"] * (size["dims"] or 0) * 8) // block_bytes))
    id_type = df.schema[id_col].dataType.simpleString()
    vectors = df.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).alias("v"))

    def against(names: np.ndarray, m: np.ndarray):
        sent = df.sparkSession.sparkContext.broadcast((names, m))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, m = sent.value
            for b in batches:
                if not len(b) or not len(names):
                    continue
                x = np.stack(b["v"].to_numpy()).astype(float)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)
                s = x @ m.T
                k = s.argmax(1)
                yield pd.DataFrame({"id": b["id"], "cluster": names[k], "sim": s[np.arange(len(k)), k]})

        return vectors.mapInPandas(run, f"id {id_type}, cluster long, sim double")

    found = None
    for k in range(blocks):
        rows = centres.where(F.pmod(F.xxhash64("cluster"), F.lit(blocks)) == k).orderBy("cluster").collect()
        part = against(np.array([r["cluster"] for r in rows], np.int64), np.array([r["centroid"] for r in rows], float).reshape(len(rows), -1))
        found = part if found is None else found.unionAll(part)
    if blocks > 1:
        found = found.groupBy("id").agg(F.max(F.struct("sim", (-F.col("cluster")).alias("neg"))).alias("b")).select("id", (-F.col("b.neg")).alias("cluster"), F.col("b.sim").alias("sim"))
    return found.withColumnRenamed("id", id_col)


def spherical_kmeans(df: DataFrame, id_col: str, vector: str, k: int, *, rounds: int = 20, tolerance: float = 1e-4, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(assignment (id, cluster, sim), centres (cluster, centroid)) by Lloyd's rounds on the sphere. The first centres are
    the k vectors with the lowest hash of their ids. A cluster that loses all members starts anew from a vector drawn by
    another hash in every round."""
    rows = df.where(F.col(vector).isNotNull())
    start = rows.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(k).select(F.row_number().over(Window.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col)).cast("long").alias("n"), unit(F.col(vector)).alias("centroid"))
    centres = stored(start.select((F.col("n") - 1).alias("cluster"), "centroid"))
    for r in range(rounds):
        near = nearest_centre(rows, id_col, vector, centres)
        new = centroids(rows.join(near.select(id_col, "cluster"), id_col), "cluster", vector)
        both = stored(centres.join(new.withColumnRenamed("centroid", "moved"), "cluster", "left"))
        empty = [x["cluster"] for x in both.where("moved is null").select("cluster").orderBy("cluster").collect()]
        if empty:
            drawn = rows.orderBy(F.xxhash64(F.col(id_col), F.lit(seed + r + 1)), id_col).limit(len(empty)).select(unit(F.col(vector)).alias("fresh")).collect()
            fresh = df.sparkSession.createDataFrame([(c, d["fresh"]) for c, d in zip(empty, drawn, strict=False)], "cluster long, fresh array<double>")
            both = stored(both.join(fresh, "cluster", "left").select("cluster", "centroid", F.coalesce("moved", "fresh", "centroid").alias("moved")))
        shift = both.agg(F.max(1 - dot(F.col("centroid"), F.col("moved")))).first()[0] or 0.0
        centres = both.select("cluster", F.col("moved").alias("centroid"))
        if shift < tolerance and r > 2:
            break
    return nearest_centre(rows, id_col, vector, centres), centres


def _by_cell(b: pd.DataFrame, probes: list, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, rows) to compare: all with all, or by the cells that the queries probe."""
    if "cell" not in b:
        yield np.arange(n), np.arange(len(b))
        return
    asked: dict[int, list[int]] = {}
    for q, cells in enumerate(probes):
        for c in cells:
            asked.setdefault(c, []).append(q)
    for c, at in b.groupby("cell").indices.items():
        if c in asked:
            yield np.array(asked[c]), at


def search(queries: DataFrame, query_id: str, df: DataFrame, id_col: str, vector: str, k: int, block: int = 2000, cell: str | None = None) -> DataFrame:
    """(query_id, id, sim, rank): the k most similar vectors of each query, exactly. Queries are a stated set, sent in blocks;
    each task keeps its best k of each query, so only k rows a task and query are shuffled. With ``cell``, only rows whose
    cell is among a query's ``cells`` are compared with it."""
    found = None
    id_type, q_type = df.schema[id_col].dataType.simpleString(), queries.schema[query_id].dataType.simpleString()
    rows = df.where(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).alias("v"), *([F.col(cell).alias("cell")] if cell else []))

    def best(ids: list, m: np.ndarray, probes: list):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            top: pd.DataFrame | None = None
            for b in batches:
                if not len(b):
                    continue
                x = np.stack(b["v"].to_numpy()).astype(float)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                parts = []
                for who, rows_at in _by_cell(b, probes, len(ids)):
                    s = np.round(m[who] @ x[rows_at].T, 9)
                    n = min(k, s.shape[1])
                    # Ties at the edge are kept for the exact ranking below.
                    edge = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
                    q, i = np.nonzero(s >= edge[:, None])
                    parts.append(pd.DataFrame({"q": who[q], "id": b["id"].to_numpy()[rows_at[i]], "sim": s[q, i]}))
                if not parts:
                    continue
                part = pd.concat(parts)
                top = part if top is None else pd.concat([top, part])
                top = top.sort_values(["q", "sim", "id"], ascending=[True, False, True]).groupby("q", sort=False).head(k)
            if top is not None:
                yield pd.DataFrame({"query": [ids[j] for j in top["q"]], "id": top["id"], "sim": top["sim"]})

        return run

    chunk: list = []

    def add() -> None:
        nonlocal found, chunk
        m = np.array([r[1] for r in chunk], float)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
        part = rows.mapInPandas(best([r[0] for r in chunk], m, [r[2] for r in chunk] if cell else []), f"query {q_type}, id {id_type}, sim double")
        found = part if found is None else found.unionAll(part)
        chunk = []

    for r in queries.where(F.col(vector).isNotNull()).select(query_id, vector, *(["cells"] if cell else [])).toLocalIterator():
        chunk.append(r)
        if len(chunk) == block:
            add()
    if chunk:
        add()
    if found is None:
        return df.sparkSession.createDataFrame([], f"{query_id} {q_type}, {id_col} {id_type}, sim double, rank int")
    w = Window.partitionBy("query").orderBy(F.desc("sim"), "id")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query_id), F.col("id").alias(id_col), "sim", "rank")


def ivf_index(df: DataFrame, id_col: str, vector: str, *, cells: int = 100, rounds: int = 10, seed: int = 42, fit_rows: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(index (id, cell, vector), centres): an inverted file: every vector with the cell of its nearest centre. The centres
    are fitted on at most ``fit_rows`` vectors of lowest hash; every vector is indexed. At most a tenth as many cells as
    vectors."""
    known = df.where(F.col(vector).isNotNull())
    n = known.count()
    sample = known if n <= fit_rows else known.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 31)) < int(fit_rows / n * (1 << 31)))
    _, centres = spherical_kmeans(sample, id_col, vector, min(cells, max(1, n // 10)), rounds=rounds, seed=seed)
    near = nearest_centre(known, id_col, vector, centres)
    return known.join(near.select(id_col, F.col("cluster").alias("cell")), id_col).select(id_col, "cell", vector), centres


def ivf_search(queries: DataFrame, query_id: str, index: DataFrame, centres: DataFrame, id_col: str, vector: str, k: int, *, probes: int = 10, block: int = 2000) -> DataFrame:
    """(query_id, id, sim, rank): the k most similar vectors of each query within the ``probes`` cells nearest to it."""
    cells = search(queries, query_id, centres.select(F.col("cluster").alias("cell"), F.col("centroid").alias(vector)), "cell", vector, probes)
    probed = queries.join(cells.groupBy(query_id).agg(F.collect_list("cell").alias("cells")), query_id)
    return search(probed, query_id, index, id_col, vector, k, block, cell="cell")


def hashed_embedding(texts: pd.Series, dims: int = 64) -> np.ndarray:
    """A deterministic stand-in for an embedding model: signed hashes of a text's last 512 words, made unit."""
    words = [(t or "").lower().split()[-512:] for t in texts]
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    out = np.zeros((len(words), dims), np.float32)
    if len(row):
        code, names = pd.factorize(np.array([x for w in words for x in w], object))
        h = pd.util.hash_array(np.asarray(names, object))
        np.add.at(out, (row, (h % np.uint64(dims)).astype(int)[code]), np.where(h >> np.uint64(63), 1, -1).astype(np.float32)[code])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-8)


def embed(df: DataFrame, id_col: str, text: str, encoder=hashed_embedding) -> DataFrame:
    """(id, embedding) by a pluggable encoder: batch of texts -> matrix."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "embedding": list(encoder(b["text"]))})

    return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {id_type}, embedding array<float>").withColumnRenamed("id", id_col)


def euclidean_kmeans(df: DataFrame, id_col: str, vector: str, k: int, *, rounds: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(assignment (id, cluster), centres (cluster, centroid)) by Spark's own k-means on Euclidean distances."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    known = df.where(F.col(vector).isNotNull()).select(id_col, array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    model = KMeans(k=k, maxIter=rounds, seed=seed, predictionCol="cluster").fit(known)
    centres = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster long, centroid array<double>")
    return model.transform(known).select(id_col, F.col("cluster").cast("long").alias("cluster")), centres


def group_centroids(centres: DataFrame, *, least: int = 5, seed: int = 42) -> DataFrame:
    """(cluster, topic): centroids grouped in turn, so that clusters have a level above them. A group has at least ``least``
    clusters where it is divided, but no more than a tenth of all of them and no fewer than two."""
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector

    n = centres.count()
    size = min(least, max(2, n // 10))
    if n <= size:
        return centres.select("cluster", F.lit(0).cast("long").alias("topic"))
    rows = centres.select("cluster", array_to_vector("centroid").alias("features"))
    model = BisectingKMeans(k=max(2, n // size), seed=seed, minDivisibleClusterSize=float(size), predictionCol="topic", distanceMeasure="cosine").fit(rows)
    return model.transform(rows).select("cluster", F.col("topic").cast("long").alias("topic"))


def cluster_prompts(prompts: DataFrame, id_col: str, text: str, vectors: DataFrame, vector: str, k: int, *, rounds: int = 20, seed: int = 42) -> DataFrame:
    """(id, domain, difficulty, cluster_id, centroid_sim): k-means over the vectors, the domain of each cluster by keywords of
    its first 50 members, the difficulty of each prompt. Prompts without a vector get cluster -1, their own domain and 0.5."""
    from siltworks.functions import labels
    from siltworks.operators.relations import cap_per_group

    near, centres = spherical_kmeans(vectors, id_col, vector, k, rounds=rounds, seed=seed)
    placed = stored(prompts.select(id_col, text).join(near.select(id_col, F.col("cluster").alias("cluster_id"), F.col("sim").alias("centroid_sim")), id_col, "left"))
    first = cap_per_group(placed.where("cluster_id is not null"), "cluster_id", [id_col], 50)
    joined = first.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(id_col, text))), lambda x: x[text]), " ").alias("t"))
    named = joined.select("cluster_id", labels.cluster_domain(F.col("t")).alias("cluster_label"))
    out = placed.join(named, "cluster_id", "left")
    return out.select(id_col, F.coalesce("cluster_label", labels.prompt_domain(F.col(text))).alias("domain"), labels.difficulty(F.col(text)).alias("difficulty"), F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"), F.coalesce("centroid_sim", F.lit(0.5)).alias("centroid_sim"))


def repair_similarities(df: DataFrame, id_col: str, vectors: DataFrame, vector: str, *, cluster: str = "cluster_id", sim: str = "centroid_sim", default: float = 0.5) -> DataFrame:
    """df with ``sim`` computed anew where it is missing or the default, from the vectors joined by id; kept elsewhere. A
    cluster's centroid is that of its rows in df; a row without a vector or a cluster gets the default."""
    joined = df.join(vectors.select(id_col, F.col(vector).alias("_v")), id_col, "left")
    c = centroids(joined.where(F.col(cluster) >= 0), cluster, "_v").withColumnsRenamed({"cluster": cluster, "centroid": "_c"})
    new = F.coalesce(cosine(F.col("_v"), F.col("_c")), F.lit(default))
    stale = F.col(sim).isNull() | (F.col(sim) == default)
    return joined.join(c, cluster, "left").withColumn(sim, F.when(stale, new).otherwise(F.col(sim).cast("double"))).drop("_v", "_c")
