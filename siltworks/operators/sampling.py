"""Samples: in-cluster order, round-robin quotas, hash samples, capped scans."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.session import stored

# Default quotas of domains and difficulties.
DOMAIN_QUOTAS = {"math": 0.20, "code": 0.18, "science": 0.15, "reasoning": 0.12, "writing": 0.10, "knowledge": 0.10, "language": 0.08, "instruction": 0.05, "other": 0.02}
DIFFICULTY_QUOTAS = {"default": {"easy": 0.20, "medium": 0.50, "hard": 0.30}}


def ranked(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], name: str = "rank", count: str | None = None) -> DataFrame:
    """Adds the place (from 1) of each row within its group, and the group's size. Rows are sorted over all tasks by range
    and numbered piece by piece, so a hot group is spread and no task holds a group alone. Ties: any order."""
    keys = {f"_o{i}": c if isinstance(c, Column) else F.col(c) for i, c in enumerate(order)}
    names = [F.col(k) for k in keys]
    placed = stored(df.withColumns(keys).repartitionByRange(*groups, *names).withColumn("_p", F.spark_partition_id()))
    pieces = placed.groupBy(*groups, "_p").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*groups)
    # One row a group and task.
    before = pieces.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], "_p", (F.sum("_n").over(w.orderBy("_p")) - F.col("_n")).alias("_off"), F.sum("_n").over(w).alias("_all"))
    same = F.col("a._p") == F.col("b._p")
    for i, g in enumerate(groups):
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b._g{i}"))
    joined = placed.alias("a").join(before.alias("b"), same).select("a.*", "_off", "_all")
    out = joined.withColumn(name, F.row_number().over(Window.partitionBy(*groups, "_p").orderBy(*names)) + F.col("_off"))
    return (out if count is None else out.withColumn(count, F.col("_all"))).drop("_p", "_off", "_all", *keys)


def centroid_order(df: DataFrame, groups: Sequence[str], sim: str, tie: str) -> DataFrame:
    """Adds ``pos``: in each group 0 for the most central row, then the most peripheral first, inwards."""
    r = ranked(df, groups, [-F.col(sim), tie], "_r", "_size")
    return r.withColumn("pos", F.when(F.col("_r") == 1, 0).otherwise(F.col("_size") - F.col("_r") + 1).cast("int")).drop("_r", "_size")


def cell_targets(total: int, domains: Mapping[str, float] = DOMAIN_QUOTAS, difficulties: Mapping[str, Mapping[str, float]] = DIFFICULTY_QUOTAS) -> list[tuple[str, str, int]]:
    """(domain, difficulty, target) of every cell, rounded down twice; shares must sum to 1 within 0.01."""
    if abs(sum(domains.values()) - 1) > 0.01:
        raise ValueError("domain shares don't sum to 1")
    out = []
    for d, share in domains.items():
        per = difficulties.get(d, difficulties.get("default", {}))
        if per and abs(sum(per.values()) - 1) > 0.01:
            raise ValueError(f"difficulty shares of {d} don't sum to 1")
        out += [(d, x, int(int(total * share) * y)) for x, y in per.items()]
    return out


def cluster_ranks(df: DataFrame, seed: int, order: str, cells: Sequence[tuple[str, str, int]]) -> DataFrame:
    """(domain, difficulty, cluster_id, cluster_rank): the order in which a cell visits its clusters: by hash, or shuffled by
    Python's generator over the cells in their order, which takes the clusters' ids (not their rows) to the driver."""
    keys = df.select("domain", "difficulty", "cluster_id").distinct()
    if order == "hash":
        w = Window.partitionBy("domain", "difficulty").orderBy(F.md5(F.concat(F.col("cluster_id").cast("string"), F.lit(f":{seed}"))), "cluster_id")
        return keys.withColumn("cluster_rank", F.row_number().over(w) - 1)
    by: dict[tuple[str, str], list[int]] = {}
    for r in keys.orderBy("domain", "difficulty", "cluster_id").collect():
        by.setdefault((r[0], r[1]), []).append(r[2])
    rng, rows = random.Random(seed), []
    for d, x, _ in cells:
        ids = by.get((d, x), [])
        if ids:
            rng.shuffle(ids)
            rows += [(d, x, c, i) for i, c in enumerate(ids)]
    return df.sparkSession.createDataFrame(rows, "domain string, difficulty string, cluster_id int, cluster_rank int")


def quota_round_robin(df: DataFrame, total: int, tie: str, *, seed: int = 42, order: str = "hash", domains: Mapping[str, float] = DOMAIN_QUOTAS, difficulties: Mapping[str, Mapping[str, float]] = DIFFICULTY_QUOTAS) -> DataFrame:
    """df's rows taken for every (domain, difficulty) cell, in turn from each of its clusters, central rows first, up to the
    cell's target. Columns needed: domain, difficulty, cluster_id, centroid_sim. Adds pos, cluster_rank and turn."""
    cells = cell_targets(total, domains, difficulties)
    targets = df.sparkSession.createDataFrame([c for c in cells if c[2] > 0], "domain string, difficulty string, target int")
    rows = centroid_order(df.join(targets, ["domain", "difficulty"]), ["domain", "difficulty", "cluster_id"], "centroid_sim", tie)
    # How many rows come before each turn of a cell: a table of cells by the size of their largest cluster.
    cell = Window.partitionBy("domain", "difficulty").orderBy("pos")
    turns = rows.groupBy("domain", "difficulty", "target", "pos").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(cell) - F.col("n")).where("before < target")
    near = rows.join(turns.select("domain", "difficulty", "pos", "before"), ["domain", "difficulty", "pos"])
    visited = near.join(cluster_ranks(rows, seed, order, cells), ["domain", "difficulty", "cluster_id"])
    w = Window.partitionBy("domain", "difficulty", "pos").orderBy("cluster_rank")
    return visited.withColumn("turn", (F.row_number().over(w) + F.col("before")).cast("int")).drop("before").where("turn <= target")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows with the least hashes of their keys: a uniform sample, the same for any partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def window_per_group(df: DataFrame, group: str, order: Sequence[str], skip: int, n: int, *, scan: int | None = None) -> DataFrame:
    """The rows of each group after the first ``skip``, n of them, out of the first ``scan`` rows of the whole table if that is
    stated. Only the first rows of each group, and those of the scan, are kept while sorting."""
    seen = df if scan is None else df.orderBy(*order).limit(scan)
    w = Window.partitionBy(group).orderBy(*order)
    return seen.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= skip + n).where(F.col("_r") > skip).drop("_r")


def page(df: DataFrame, order: Sequence[str | Column], number: int, size: int = 10) -> DataFrame:
    """Page ``number`` (from 0) of the ordered rows: only the pages up to it are kept while sorting."""
    return df.orderBy(*order).limit((number + 1) * size).orderBy(*order).offset(number * size)
