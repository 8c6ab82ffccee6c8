"""Fixed-size sample from data of unknown length (problem 1).

A distributed reservoir for large k. Ids are spread over slots by hash. A batch that arrives draws from the hypergeometric
distribution how many of the k places its new ids take, splits that number over the slots by what they hold, evicts as many
held ids uniformly, and inserts a uniform sample of its own ids. Only counts by batch and slot reach the driver: at most
``max_batches`` times the slots. Every slot then replays its insertions and evictions on its own; a slot takes in about
k / slots * (1 + ln(n / k)) rows, however many rows arrive.

An id counts at its first arrival, so each distinct id has the same chance however often it comes again.

Nulls: a null id is left out; a null arrival number comes last, a null shard is a shard of its own. Ties of arrival are
broken by the shard's name. Fewer than k distinct ids: all of them. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltworks.session import stored

_LAST = 9223372036854775807


def slots_for(k: int) -> int:
    """Slots of about 20,000 places, between 16 and 4096."""
    return int(min(4096, max(16, k // 20_000)))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """A hypergeometric draw for counts of any size, by inversion.

    The probabilities come from the ratios of neighbouring values, outwards from the mode to 12 standard deviations and 100
    more, beyond which they are under 1e-30, and are scaled by their sum, so no approximation by another distribution and no
    logarithm of a factorial enters.
    """
    lo, hi = max(0, draws - bad), min(good, draws)
    if lo >= hi:
        return lo
    n = good + bad
    p = good / n
    half = int(12 * (draws * p * (1 - p) * (n - draws) / max(n - 1, 1)) ** 0.5) + 100
    mode = min(max((draws + 1) * (good + 1) // (n + 2), lo), hi)
    lo, hi = max(lo, mode - half), min(hi, mode + half)
    x = np.arange(lo, hi, dtype=np.float64)
    step = np.log(good - x) + np.log(draws - x) - np.log(x + 1) - np.log(bad - draws + x + 1)
    log_p = np.concatenate(([0.0], np.cumsum(step)))
    total = np.cumsum(np.exp(log_p - log_p.max()))
    return lo + min(int(np.searchsorted(total, rng.random() * total[-1], side="right")), hi - lo)


def split(rng: np.random.Generator, parts: np.ndarray, draws: int) -> np.ndarray:
    """How many of the draws fall on each part: one multivariate hypergeometric draw, part by part."""
    out, rest = np.zeros(len(parts), np.int64), int(parts.sum())
    for i, n in enumerate(parts.tolist()):
        rest -= n
        out[i] = hypergeometric(rng, n, rest, draws)
        draws -= int(out[i])
    return out


class Plan:
    """The insertions and evictions of every batch by slot, drawn one batch after another."""

    def __init__(self, k: int, slots: int, seed: int, held: Sequence[int] | None = None, seen: int = 0):
        self.k, self.slots, self.seed, self.seen = k, slots, seed, seen
        self.held = np.zeros(slots, np.int64) if held is None else np.array(held, np.int64)
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []

    def arrive(self, batch: int, counts: np.ndarray) -> None:
        rng = np.random.default_rng([self.seed, batch])
        n = int(counts.sum())
        size = min(self.k, self.seen + n)
        new = hypergeometric(rng, n, self.seen, size)
        inserted = split(rng, counts, new)
        evicted = split(rng, self.held, int(self.held.sum()) - (size - new))
        self.held = self.held - evicted + inserted
        self.seen += n
        self.steps.append((inserted, evicted))


def replay(slot: int, seed: int, batches: np.ndarray, ids: np.ndarray, evictions: dict[int, int], held: np.ndarray | None = None) -> np.ndarray:
    """Places of the rows that are left in a slot after all insertions and evictions, in order of the batches."""
    left = np.zeros(0, np.int64) if held is None else held
    order = np.lexsort((ids, batches))
    where = {int(b): order[batches[order] == b] for b in np.unique(batches)}
    for b in sorted(set(where) | set(evictions)):
        if out := evictions.get(b, 0):
            rng = np.random.default_rng([seed, slot + 1, b])
            left = np.delete(left, rng.choice(len(left), out, replace=False))
        left = np.concatenate((left, where.get(b, np.zeros(0, np.int64))))
    return left


def _slot(id_col: str, slots: int, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(slots)).cast("int")


def _drawn(ids: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Of each batch and slot, the planned number of ids, drawn uniformly: those of the lowest hashes.

    A bound on the hash, which the wanted ids are under but for a chance of less than 1e-15, comes before the sort, so that
    a task sorts about as many rows as are wanted of its slot, however many ids a batch brings.
    """
    share = (F.col("inserted") + 10 * F.sqrt("inserted") + 100) / F.col("arrived")
    h = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.lit(1 << 52))
    w = Window.partitionBy("batch", "slot").orderBy("h", "id")
    few = ids.join(plan.where("inserted > 0"), ["batch", "slot"]).withColumn("h", h).where(F.col("h") <= share * float(1 << 52))
    return few.withColumn("r", F.row_number().over(w)).where("r <= inserted").select("slot", "batch", "id")


def _batches(shards: DataFrame, max_batches: int) -> DataFrame:
    """(shard, batch) of shards (shard, first) in the order of their first rows. Up to ``max_batches`` shards are batches of
    their own; of more, neighbours by quantiles of their first rows arrive together."""
    if shards.count() <= max_batches:
        return shards.select("shard", (F.row_number().over(Window.orderBy("first", "shard")) - 1).alias("batch"))
    bounds = shards.agg(F.percentile_approx("first", [i / max_batches for i in range(1, max_batches)], 100 * max_batches)).first()[0]
    known = F.array(*[F.lit(int(x)) for x in sorted(set(bounds))])
    return shards.select("shard", F.size(F.filter(known, lambda x: x < F.col("first"))).alias("batch"))


def reservoir_sample(df: DataFrame, id_col: str, order_col: str, shard_col: str, *, k: int, seed: int = 42, max_batches: int = 256, slots: int | None = None) -> DataFrame:
    """(id): k distinct ids, each with the same chance, from shards that arrive one after another.

    Shards arrive in the order of their first row; beyond ``max_batches`` of them, neighbours arrive together, which changes
    no id's chance.
    """
    spark, slots = df.sparkSession, slots or slots_for(k)
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(order_col).cast("long"), F.lit(_LAST)).alias("at"), F.coalesce(F.col(shard_col).cast("string"), F.lit("")).alias("shard"))
    shards = stored(rows.groupBy("shard").agg(F.min("at").alias("first")))
    batch_of = _batches(shards, max_batches)
    first = rows.groupBy("id").agg(F.min(F.struct("at", "shard")).alias("f")).select("id", F.col("f.shard").alias("shard"))
    ids = stored(first.join(batch_of, "shard").select("id", "batch", _slot("id", slots, seed).alias("slot")))
    counted = ids.groupBy("batch", "slot").count().collect()
    plan = Plan(k, slots, seed)
    by_batch: dict[int, np.ndarray] = {}
    for r in counted:
        by_batch.setdefault(r["batch"], np.zeros(slots, np.int64))[r["slot"]] = r["count"]
    rows_of_plan, evictions = [], {}
    for b in sorted(by_batch):
        plan.arrive(b, by_batch[b])
        inserted, evicted = plan.steps[-1]
        rows_of_plan += [(b, s, int(inserted[s]), int(by_batch[b][s])) for s in range(slots)]
        for s in np.flatnonzero(evicted).tolist():
            evictions.setdefault(s, {})[b] = int(evicted[s])
    candidates = _drawn(ids, spark.createDataFrame(rows_of_plan, "batch int, slot int, inserted long, arrived long"), seed)
    id_type = ids.schema["id"].dataType.simpleString()

    def settle(g: pd.DataFrame) -> pd.DataFrame:
        s = int(g["slot"].iloc[0])
        left = replay(s, seed, g["batch"].to_numpy(), g["id"].to_numpy(), evictions.get(s, {}))
        return g.iloc[left][["id"]]

    return candidates.groupBy("slot").applyInPandas(settle, f"id {id_type}").withColumnRenamed("id", id_col)


class ReservoirStream:
    """The same reservoir kept in a shared folder and fed batch by batch, as by ``foreachBatch``.

    Every batch is joined with the ids seen before, since an id that comes again must not have a second chance. The numbers of
    the last 1,000 batches are kept, so that a redone one is skipped; an older one would bring only ids seen before.

    ``state``: versions of the held ids and of the ids seen so far, written before the counts that name them, so that a
    batch that broke off is redone from the version before it.
    """

    def __init__(self, spark: SparkSession, folder: str, k: int, seed: int = 42):
        self.spark, self.folder, self.k, self.seed, self.slots = spark, folder, k, seed, slots_for(k)
        jvm = spark.sparkContext._jvm
        self._fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._path = jvm.org.apache.hadoop.fs.Path

    def _meta(self) -> dict:
        path = self._path(f"{self.folder}/meta")
        if not self._fs.exists(path):
            return {"version": 0, "seen": 0, "held": [0] * self.slots, "batches": []}
        return json.loads(self.spark.read.text(f"{self.folder}/meta").orderBy(F.desc(F.get_json_object("value", "$.version").cast("long"))).first()[0])

    def sample(self) -> DataFrame:
        v = self._meta()["version"]
        return self.spark.read.parquet(f"{self.folder}/held/{v}").select("id") if v else self.spark.createDataFrame([], "id string")

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Takes in the ids (column ``id``) of one arriving batch; a batch that was taken in before is skipped."""
        m = self._meta()
        if batch_id in m["batches"]:
            return
        v, spark = m["version"], self.spark
        ids = batch.where("id is not null").select("id").distinct()
        if v:
            ids = ids.join(spark.read.parquet(*[f"{self.folder}/seen/{i}" for i in range(1, v + 1)]), "id", "left_anti")
        path = f"{self.folder}/seen/{v + 1}"
        ids.write.mode("overwrite").parquet(path)
        ids = spark.read.parquet(path).select("id", F.lit(v + 1).alias("batch"), _slot("id", self.slots, self.seed).alias("slot"))
        counts = np.zeros(self.slots, np.int64)
        for r in ids.groupBy("slot").count().collect():
            counts[r["slot"]] = r["count"]
        plan = Plan(self.k, self.slots, self.seed, m["held"], m["seen"])
        plan.arrive(v + 1, counts)
        inserted, evicted = plan.steps[0]
        new = _drawn(ids, spark.createDataFrame([(v + 1, s, int(n), int(c)) for s, (n, c) in enumerate(zip(inserted, counts, strict=True))], "batch int, slot int, inserted long, arrived long"), self.seed).select("slot", "id")
        if v:
            out = spark.createDataFrame([(s, int(n)) for s, n in enumerate(evicted)], "slot int, evicted long")
            w = Window.partitionBy("slot").orderBy(F.xxhash64(F.lit(self.seed + v + 2), "id"), "id")
            old = spark.read.parquet(f"{self.folder}/held/{v}").join(out, "slot").withColumn("r", F.row_number().over(w)).where("r > evicted").select("slot", "id")
            new = new.unionByName(old)
        new.write.mode("overwrite").parquet(f"{self.folder}/held/{v + 1}")
        meta = {"version": v + 1, "seen": plan.seen, "held": plan.held.tolist(), "batches": [*m["batches"], batch_id][-1000:]}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("append").text(f"{self.folder}/meta")
