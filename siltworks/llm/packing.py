"""Filling fixed-capacity containers with items (problem 8).

Harmonic packing. An item of size s belongs to the class j = capacity // s (at most CLASSES), and a container of class j is
begun with a fixed count of j items of that class, which always fit. The room left in the containers of large classes is
then given to smaller classes, again by fixed counts: room r takes r * t // capacity items of class t, whatever their exact
sizes. Items are spread over slots by hash and every slot is packed on its own, so workers never wait for each other; a
slot holds at most about ``slot_items`` items, and only a slot's last containers of a class stand partly empty.

An item larger than a container is split: full containers, and a rest that is packed like any item. Nothing else is split.

Nulls: a null id or text, and a text without tokens, need no room and are left out. A repeated id counts once, with its
largest size. Ties are broken by id. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The greatest class; smaller items share it.
CLASSES = 96


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, 0 and up. No size exceeds the capacity, none is below 1."""
    n = len(sizes)
    out = np.full(n, -1, np.int64)
    cls = np.minimum(capacity // sizes, CLASSES)
    order = np.lexsort((-sizes, cls))
    starts = np.searchsorted(cls[order], np.arange(1, CLASSES + 2))
    # Each class is a queue in descending size, consumed from its front.
    queue = {j: order[starts[j - 1] : starts[j]] for j in range(1, CLASSES + 1)}
    used = 0

    def give(bins: np.ndarray, room: np.ndarray, counts: np.ndarray, t: int) -> None:
        """Gives the next counts[i] items of class t to bins[i], as far as there are any."""
        q = queue[t]
        ends = np.minimum(np.cumsum(counts), len(q))
        counts = np.diff(np.concatenate(([0], ends)))
        taken = q[: ends[-1]] if len(ends) else q[:0]
        owner = np.repeat(np.arange(len(bins)), counts)
        out[taken] = bins[owner]
        room -= np.bincount(owner, sizes[taken], len(bins)).astype(np.int64)
        queue[t] = q[len(taken) :]

    for j in range(1, CLASSES + 1):
        q = queue[j]
        if not len(q):
            continue
        bins = np.arange(used, used + -(-len(q) // j))
        used += len(bins)
        room = np.full(len(bins), capacity, np.int64)
        give(bins, room, np.full(len(bins), j), j)
        for t in range(j + 1, CLASSES + 1):
            if len(queue[t]):
                # First by what is sure to fit, then by what is left after the exact sizes.
                for _ in range(3):
                    counts = room * t // capacity
                    if not counts.any() or not len(queue[t]):
                        break
                    give(bins, room, counts, t)
        small = queue[CLASSES]
        if len(small) and j < CLASSES:
            need = np.maximum(1, sizes[small].max())
            while len(queue[CLASSES]) and (room >= need).any():
                give(bins, room, room // need, CLASSES)
                if len(queue[CLASSES]):
                    need = sizes[queue[CLASSES]].max()
    return out


def pack_containers(items: DataFrame, id_col: str, size_col: str, plans: DataFrame, plan_col: str, capacity_col: str, *, slot_items: int = 50_000, seed: int = 42) -> DataFrame:
    """(plan, id, piece, container, tokens): where every item, or piece of an item, of each plan goes."""
    sized = items.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(size_col).cast("long")).alias("size")).where("size > 0")
    wanted = [r.asDict() for r in plans.where(F.col(capacity_col) > 0).select(F.col(plan_col).cast("string").alias("plan"), F.col(capacity_col).cast("long").alias("capacity")).distinct().collect()]
    spark = items.sparkSession
    id_type = sized.schema["id"].dataType.simpleString()
    slots = F.greatest(F.ceil(F.lit(items.count()) / slot_items), F.lit(1))
    capacities = spark.createDataFrame([(w["plan"], w["capacity"]) for w in wanted], "plan string, capacity long")
    # A few plans, stated by the caller: every item goes to each.
    each = sized.withColumn("plan_row", F.explode(F.array(*[F.struct(F.lit(w["plan"]).alias("plan"), F.lit(w["capacity"]).alias("capacity")) for w in wanted]))).select("id", "size", "plan_row.*") if wanted else sized.crossJoin(capacities)
    slotted = each.withColumn("slot", F.pmod(F.xxhash64(F.lit(seed), "id"), slots).cast("int"))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        capacity, plan, slot = int(g["capacity"].iloc[0]), g["plan"].iloc[0], int(g["slot"].iloc[0])
        g = g.sort_values("id", kind="stable")
        size = g["size"].to_numpy()
        full = np.where(size > capacity, (size - 1) // capacity, 0)
        rest = size - full * capacity
        where = pack(rest, capacity)
        n_full = int(full.sum())
        owner = np.repeat(np.arange(len(g)), full)
        piece = np.arange(n_full) - np.repeat(np.cumsum(full) - full, full)
        base = int(where.max()) + 1 if len(where) else 0
        ids = g["id"].to_numpy()
        return pd.DataFrame(
            {
                "plan": plan,
                "id": np.concatenate((ids, ids[owner])),
                "piece": np.concatenate((full, piece)).astype(np.int32),
                "container": [f"{slot}-{c}" for c in np.concatenate((where, base + np.arange(n_full))).tolist()],
                "tokens": np.concatenate((rest, np.full(n_full, capacity))),
            }
        )

    packed = slotted.groupBy("plan", "slot").applyInPandas(run, f"plan string, id {id_type}, piece int, container string, tokens long")
    return packed.withColumnsRenamed({"plan": plan_col, "id": id_col})


def fill_rates(packed: DataFrame, plans: DataFrame, plan_col: str, capacity_col: str) -> DataFrame:
    """(plan, capacity, containers, tokens, fill): of each plan the containers used and the share of their room."""
    per = packed.groupBy(plan_col).agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return plans.select(plan_col, capacity_col).join(per, plan_col, "left").select(plan_col, capacity_col, F.coalesce("containers", F.lit(0)).alias("containers"), F.coalesce("tokens", F.lit(0)).alias("tokens"), (F.col("tokens") / (F.col("containers") * F.col(capacity_col))).alias("fill"))
