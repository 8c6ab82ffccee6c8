"""Statistics of a corpus: counts, cross-tabs, histograms, medians, shares, score summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: edges of the histogram of cluster sizes; the last bin is open above.
SIZE_EDGES = (0, 5, 20, 50, 100, 250, 500, 1000, 5000)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n); empty values count as missing and are left out."""
    return df.where(F.col(column).cast("string") != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), "value").limit(k)


def list_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """(value, n) over the stripped, non-blank elements of a list column."""
    items = df.select(F.explode(column).alias("raw")).select(F.btrim("raw").alias("value")).where("value <> ''").groupBy("value").agg(F.count("*").alias("n"))
    return items if k is None else items.orderBy(F.desc("n"), "value").limit(k)


def cross_tab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts by row and the stated column values, zero where there are none."""
    known = df.where(F.col(row).cast("string") != "")
    return known.groupBy(row).agg(*[F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values])


def row_shares(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, share of the row)."""
    n = df.where((F.col(row).cast("string") != "") & (F.col(column).cast("string") != "")).groupBy(row, column).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def top_per_group(df: DataFrame, group: str, column: str, k: int) -> DataFrame:
    """(group, value, n, rank) of the k most frequent list elements of each group."""
    n = df.where(F.col(group).cast("string") != "").select(group, F.explode(column).alias("raw")).select(group, F.btrim("raw").alias("value")).where("value <> ''").groupBy(group, "value").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "value"))).where(F.col("rank") <= k)


def cluster_sizes(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.where(F.col(cluster) >= 0).groupBy(cluster).agg(F.count("*").alias("size"))


def size_histogram(sizes: DataFrame, edges: Sequence[int] = SIZE_EDGES) -> DataFrame:
    """(lo, hi, n) for every bin, empty ones included; the last bin has no upper edge."""
    bins = [(lo, hi) for lo, hi in zip(edges, (*edges[1:], None), strict=True)]
    spark = sizes.sparkSession
    frame = spark.createDataFrame(bins, "lo int, hi int")
    place = F.lit(edges[0])
    for e in edges[1:]:
        place = F.when(F.col("size") >= e, F.lit(e)).otherwise(place)
    counted = sizes.groupBy(place.alias("lo")).agg(F.count("*").alias("n"))
    return frame.join(counted, "lo", "left").select("lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def histogram_median(hist: DataFrame) -> DataFrame:
    """One row: the median interpolated within the bin (lo, hi, n) in which it lies."""
    upto = F.sum("n").over(Window.orderBy("lo"))  # one row per bin
    total = F.sum("n").over(Window.partitionBy())
    h = hist.withColumn("upto", upto).withColumn("total", total)
    inside = h.where((F.col("upto") >= F.col("total") / 2) & (F.col("upto") - F.col("n") < F.col("total") / 2))
    return inside.select((F.col("lo") + (F.col("total") / 2 - (F.col("upto") - F.col("n"))) / F.col("n") * (F.coalesce("hi", F.col("lo")) - F.col("lo"))).alias("median"))


def dominant_label(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label): the most frequent label of each group, the least on ties."""
    n = df.where(F.col(label).cast("string") != "").groupBy(group, label).agg(F.count("*").alias("n"))
    return n.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(label).alias("label"))).alias("m")).select(group, F.col("m.label").alias(label))


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """(value, n, percent rounded to two places)."""
    n = value_counts(df, column)
    return n.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def score_summary(df: DataFrame, group: str, score: str, levels: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """(group, n, mean, stdev, n_1 ...): sample standard deviation, null below two scores."""
    return df.where(F.col(score).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("stdev"), *[F.count(F.when(F.col(score) == v, 1)).alias(f"n_{v}") for v in levels])
