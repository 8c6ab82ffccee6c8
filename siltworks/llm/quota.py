"""Sample matching target category proportions (problem 3).

Each category has a reservoir: the rows with the least random priorities, at most as many as its quota can reach. Reservoirs
of parts merge by keeping the least priorities of both. One pass over the rows builds the reservoirs of every task together
with exact counts; when the counts are final, feasible quotas are set and every reservoir is trimmed to its quota, which
leaves a uniform sample. The trim finds the priority at which the quota is reached from a histogram of priorities, so only
the rows of one histogram bar of a category are ever ordered.

Nulls: a null id is left out; rows without a label, or with labels outside the targets, belong to no cell. Labels are
compared without letter case and outer blanks. Of an id's repeated rows the least labels count. Priorities are hashes of
ids, ties broken by id. Empty rows: every cell is exhausted; empty targets: an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.session import stored

_BAR_BITS = 12


def _clean(c: str):
    return F.lower(F.trim(F.col(c).cast("string")))


def cell_counts(df: DataFrame, id_col: str, labels: Sequence[str], targets: DataFrame, *, fraction: float = 0.25) -> DataFrame:
    """The targets with: wanted (target share of n), available (distinct ids), n (of all distinct ids the fraction, rounded
    down)."""
    ids, total = _labelled(df, id_col, labels)
    return _with_counts(ids.groupBy("cell").agg(F.count("*").alias("available")), total, targets, labels, fraction)


def _labelled(df: DataFrame, id_col: str, labels: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    keyed = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.concat_ws("\x1f", *[F.coalesce(_clean(c), F.lit("\x1e")) for c in labels]).alias("cell"))
    ids = keyed.groupBy("id").agg(F.min("cell").alias("cell"))
    return ids, ids.agg(F.count("*").alias("n_ids"))


def _with_counts(counts: DataFrame, total: DataFrame, targets: DataFrame, labels: Sequence[str], fraction: float) -> DataFrame:
    t = targets.select(*labels, "target_share", "min_rows").withColumn("cell", F.concat_ws("\x1f", *[F.coalesce(_clean(c), F.lit("\x1e")) for c in labels]))
    # total is one row, counts at most one row per cell.
    return t.join(counts, "cell", "left").crossJoin(total).withColumn("n", F.floor(F.col("n_ids") * fraction)).withColumn("available", F.coalesce("available", F.lit(0))).withColumn("wanted", F.col("target_share") * F.col("n")).drop("n_ids")


def unmet(cells: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Of the cells with counts, the labels of those that cannot be met."""
    return cells.where((F.col("available") < F.col("min_rows")) | (F.col("available") < F.col("wanted"))).select(*labels)


def feasible_quotas(cells: list[dict]) -> dict[str, int]:
    """Whole quotas by cell: largest remainders of the wanted rows, at least the minimum, at most what is there."""
    n = cells[0]["n"] if cells else 0
    wanted = [c["wanted"] for c in cells]
    base = [int(w) for w in wanted]
    left = int(round(min(sum(wanted), n))) - sum(base)
    for i in sorted(range(len(cells)), key=lambda i: (base[i] - wanted[i], cells[i]["cell"]))[: max(0, left)]:
        base[i] += 1
    return {c["cell"]: min(c["available"], max(c["min_rows"] or 0, b)) for c, b in zip(cells, base, strict=True)}


def _reservoirs(capacity: dict[str, int]):
    """One task's reservoirs: of each cell the least priorities up to its capacity, and the exact count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[pd.DataFrame]] = {}
        size: dict[str, int] = {}
        count: dict[str, int] = {}
        for b in batches:
            for cell, g in b.groupby("cell", sort=False):
                count[cell] = count.get(cell, 0) + len(g)
                if cell not in capacity:
                    continue
                held.setdefault(cell, []).append(g[["id", "priority"]])
                size[cell] = size.get(cell, 0) + len(g)
                if size[cell] > 2 * capacity[cell] + 1000:
                    held[cell] = [_least(pd.concat(held[cell]), capacity[cell])]
                    size[cell] = len(held[cell][0])
        for cell, parts in held.items():
            r = _least(pd.concat(parts), capacity[cell])
            yield r.assign(cell=cell, seen=np.int64(0))[["cell", "id", "priority", "seen"]]
        yield pd.DataFrame({"cell": list(count), "id": None, "priority": np.int64(-1), "seen": np.fromiter(count.values(), np.int64, len(count))}).astype({"id": "object"})

    return run


def _least(g: pd.DataFrame, n: int) -> pd.DataFrame:
    return g if len(g) <= n else g.iloc[np.lexsort((g["id"].to_numpy(), g["priority"].to_numpy()))[:n]]


def quota_sample(df: DataFrame, id_col: str, labels: Sequence[str], targets: DataFrame, *, fraction: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(sample, report). sample: (id, labels) of a quarter (``fraction``) of the distinct ids in the shares of the targets.
    report: the targets with available, wanted, taken, the share reached, and whether the cell is exhausted."""
    spark = df.sparkSession
    ids, _ = _labelled(df, id_col, labels)
    # The row count bounds the distinct ids, hence every quota, before the pass; Parquet has it in its footers.
    bound = int(df.count() * fraction) + 1
    wanted = targets.withColumn("cell", F.concat_ws("\x1f", *[F.coalesce(_clean(c), F.lit("\x1e")) for c in labels])).select("cell", "target_share", "min_rows").collect()
    capacity = {r["cell"]: max(r["min_rows"] or 0, int((r["target_share"] or 0) * bound) + 1) for r in wanted}
    id_type = ids.schema["id"].dataType.simpleString()
    keyed = ids.select("cell", "id", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 1).alias("priority"))
    held = stored(keyed.mapInPandas(_reservoirs(capacity), f"cell string, id {id_type}, priority long, seen long"))
    counts = held.where("priority < 0").groupBy("cell").agg(F.sum("seen").alias("available"))
    total = counts.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("n_ids"))
    cells = _with_counts(counts, total, targets, labels, fraction)
    final = [r.asDict() for r in cells.collect()]
    quotas = feasible_quotas(final)
    q = spark.createDataFrame([(c, n) for c, n in quotas.items()], "cell string, quota long")
    rows = held.where("priority >= 0").withColumn("bar", F.shiftright("priority", 63 - _BAR_BITS).cast("int"))
    bars = rows.groupBy("cell", "bar").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("cell").orderBy("bar"))
    edge = bars.withColumn("upto", upto).join(q, "cell").where((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota"))).select("cell", F.col("bar").alias("edge"), (F.col("quota") - F.col("upto") + F.col("n")).alias("need"))
    limits = q.join(edge, "cell", "left").where("quota > 0").select("cell", F.coalesce("edge", F.lit(1 << _BAR_BITS)).alias("edge"), F.coalesce("need", F.lit(0)).alias("need"))
    near = rows.join(limits, "cell")
    rank = F.row_number().over(Window.partitionBy("cell", "bar").orderBy("priority", "id"))
    taken = near.where("bar < edge").select("cell", "id").unionByName(near.where("bar = edge").withColumn("r", rank).where("r <= need").select("cell", "id"))
    parts = F.split("cell", "\x1f")
    sample = taken.select(F.col("id").alias(id_col), *[parts[i].alias(c) for i, c in enumerate(labels)])
    total_taken = max(1, sum(quotas.values()))
    report = cells.join(q, "cell").select(*labels, "target_share", "min_rows", "available", "wanted", F.col("quota").alias("taken"), (F.col("quota") / F.lit(total_taken)).alias("share"), ((F.col("available") < F.col("min_rows")) | (F.col("available") < F.col("wanted"))).alias("exhausted"))
    return sample, report
