"""State of a run: append-only ledgers of stages, items and shards, whose current state is an aggregation.

A ledger is a table that is only appended to; what holds now is the last entry of each key by its number. So a task that is
redone adds an equal entry and changes nothing, and no row is ever updated in place.

Nulls: entries without a key are left out; an entry without a number counts as the earliest. Equal numbers: the greatest
entry counts. Empty ledgers have no state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# States of stages and items.
STAGE_STATES = ("started", "complete", "failed")
DONE = ("success", "skipped")
STAGES = "stage string, status string, detail string, seq long"
ITEMS = "item string, stage string, status string, seq long"
SHARDS = "shard string, name string, value long"


def current(ledger: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """The last entry of each key."""
    known = ledger.where(F.col(key[0]).isNotNull())
    rest = [c for c in ledger.columns if c not in key]
    last = F.max(F.struct(F.coalesce(F.col(seq), F.lit(-1)).alias("_seq"), *[F.col(c) for c in rest])).alias("e")
    return known.groupBy(*key).agg(last).select(*key, *[F.col(f"e.{c}").alias(c) for c in rest])


def pending(items: DataFrame, ledger: DataFrame, key: str, *, status: str = "status", seq: str = "seq", done: Sequence[str] = DONE) -> DataFrame:
    """The items whose last entry is not among ``done``: new ones and those that failed."""
    finished = current(ledger.select(key, status, seq), [key], seq).where(F.col(status).isin(*done))
    return items.join(finished.select(key), key, "left_anti")


def missing(expected: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """The distinct keys that are expected and not there."""
    return expected.select(key).where(F.col(key).isNotNull()).distinct().join(there.select(key), key, "left_anti")


def register(manifest: DataFrame, listing: DataFrame, shard: str, seq: str) -> DataFrame:
    """The manifest with the listed shards that it lacks; what it has stays as it is."""
    new = listing.where(F.col(shard).isNotNull()).groupBy(shard).agg(F.min(seq).alias(seq))
    return manifest.select(shard, seq).unionByName(new.join(manifest.select(shard), shard, "left_anti"))


def merged_counters(ledger: DataFrame, shard: str = "shard", name: str = "name", value: str = "value") -> DataFrame:
    """(name, value): the counters of all shards, an entry that was written again counted once."""
    return ledger.select(shard, name, value).distinct().groupBy(name).agg(F.sum(value).alias(value))


class RunState:
    """The ledgers in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.folder}/{table}")

    def _next(self, table: str, schema: str) -> int:
        return (self._read(table, schema).agg(F.max("seq")).first()[0] or 0) + 1

    def stage(self, stage: str, status: str, detail: str = "") -> None:
        """Records that a stage has started, is complete or has failed."""
        if status not in STAGE_STATES:
            raise ValueError(f"no such state of a stage: {status}")
        self._append("stages", self.spark.createDataFrame([(stage, status, detail, self._next("stages", STAGES))], STAGES).coalesce(1))

    def stages(self) -> DataFrame:
        """(stage, status, detail, seq) of every stage, by name."""
        return current(self._read("stages", STAGES), ["stage"], "seq").orderBy("stage")

    def is_complete(self, stage: str) -> bool:
        return not self.stages().where((F.col("stage") == stage) & (F.col("status") == "complete")).isEmpty()

    def mark(self, items: DataFrame, stage: str) -> None:
        """Records the items' states: columns item and status."""
        n = self._next("items", ITEMS)
        self._append("items", items.select(F.col("item").cast("string").alias("item"), F.lit(stage).alias("stage"), "status", F.lit(n).cast("long").alias("seq")))

    def pending(self, items: DataFrame, stage: str) -> DataFrame:
        """The items (column item) that are new to a stage or failed in it."""
        return pending(items, self._read("items", ITEMS).where(F.col("stage") == stage), "item")

    def publish(self, shard: str, counters: dict[str, int]) -> None:
        """Records a shard's counters once its rows are published; a shard that is recorded already stays as it is."""
        if counters and self.published().where(F.col("shard") == shard).isEmpty():
            self._append("shards", self.spark.createDataFrame([(shard, k, int(v)) for k, v in counters.items()], SHARDS).coalesce(1))

    def published(self) -> DataFrame:
        return self._read("shards", SHARDS).select("shard").distinct()

    def counters(self) -> DataFrame:
        return merged_counters(self._read("shards", SHARDS))
