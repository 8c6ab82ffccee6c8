"""Bounded samples of labelled or unlabelled rows for fitting models on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lowest_hash_rows(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], n: int, seed: int) -> pd.DataFrame:
    """The columns of the n rows with the lowest hash of their keys.

    A threshold that about 1.3 n rows pass, from the number of rows, comes first, so that what the tasks send doesn't grow
    with their number.
    """
    total = rows.count()
    hashed = rows.select(F.xxhash64(*keys, F.lit(seed)).alias("_r"), *columns)
    if total > 2 * n + 1000:
        hashed = hashed.where(F.col("_r") < int(-(2**63) + 2**64 * (1.3 * n + 200) / total))
    return hashed.orderBy("_r").limit(n).drop("_r").toPandas()
