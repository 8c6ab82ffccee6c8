"""Deduplication, unions, resumption and overlays of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in a stated order. One aggregation with map-side partials, so a hot key costs no more than
    any other. Rows without a key are left out."""
    row = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.struct(*[F.col(c) for c in df.columns]).alias("row"))
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("m")).select("m.row.*")


def dedup_rates(df: DataFrame, key: str, by: str) -> DataFrame:
    """(by, seen, kept, rate): the rows of each group, distinct keys in it, and the share lost in percent."""
    return df.groupBy(by).agg(F.count("*").alias("seen"), F.countDistinct(key).alias("kept")).withColumn("rate", 100 * (1 - F.col("kept") / F.col("seen")))


def cap_per_group(df: DataFrame, group: str, order: Sequence[str], n: int) -> DataFrame:
    """At most n rows of each group, first ones first. The limit is pushed below the shuffle by the planner."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def not_yet_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key).distinct(), key, "left_anti")


def latest_state(ledger: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key in an append-only ledger."""
    return ledger.groupBy(key).agg(F.max_by(F.struct(*[c for c in ledger.columns if c != key]), order).alias("s")).select(key, "s.*")


def union_all(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def with_columns_or(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """df with the columns that it lacks, at their defaults."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def overlay(base: DataFrame, updates: DataFrame, key: str, columns: Mapping[str, Column], order: str | None = None) -> DataFrame:
    """base with columns taken from updates where they say something: not null and not empty; else from base; else a default.
    Of a key's updates the last in the order counts, or the greatest row where there is none."""
    taken = [c for c in columns if c in updates.columns]
    last = F.max(F.struct(*([F.col(order).alias("_order")] if order else []), *[F.col(c) for c in taken]))
    new = updates.where(F.col(key).isNotNull()).groupBy(key).agg(last.alias("_u")).select(key, *[F.col(f"_u.{c}").alias(f"_new_{c}") for c in taken])
    joined = base.join(new, key, "left")
    said = lambda c: F.when(F.col(c).cast("string") != "", F.col(c))
    pick = {c: F.coalesce(*([said(f"_new_{c}")] if c in updates.columns else []), *([said(c)] if c in base.columns else []), d) for c, d in columns.items()}
    return joined.withColumns(pick).drop(*[f"_new_{c}" for c in columns])


def with_cluster(df: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """df with the cluster and similarity of each key; -1 and 0.5 where the results lack it. Of repeated results the greatest."""
    found = results.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct("cluster_id", "centroid_sim")).alias("_c"))
    return df.join(found, key, "left").withColumns({"cluster_id": F.coalesce("_c.cluster_id", F.lit(-1)), "centroid_sim": F.coalesce("_c.centroid_sim", F.lit(0.5))}).drop("_c")


def report_row(df: DataFrame, key: Column, name: str) -> Column:
    """An aggregate: counts by a key as one map."""
    return F.map_from_entries(F.collect_list(F.struct(key, F.col("n")))).alias(name)
