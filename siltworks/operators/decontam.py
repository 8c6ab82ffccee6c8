"""Decontamination by runs of words shared with test items: an anti-join with attribution and a report.

Nulls: a row without a key is checked by its text and leaves with it; a null text has no words and is clean. Keys that come
again are removed together. No items, or none long enough: nothing is removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.text import match_words, ngrams, with_normal_form


def item_grams(items: DataFrame, owner: str, order: str, text: str, *, n: int = 13, least: int = 5, compat: bool = True) -> DataFrame:
    """(gram, gram_len, owner): all n-word runs of the items, or the whole of items with ``least`` to n - 1 words. A gram
    belongs to the item that has it first in the order."""
    if least > n:
        raise ValueError("the least gram is longer than the gram")
    t = items.select(F.col(owner).alias("owner"), F.col(order).alias("ord"), match_words(F.col(text), compat).alias("t"))
    grams = F.when(F.size("t") >= n, ngrams(F.col("t"), n)).when(F.size("t") >= least, F.array(F.array_join("t", " "))).otherwise(F.array().cast("array<string>"))
    rows = t.select("owner", "ord", F.least(F.size("t"), F.lit(n)).alias("gram_len"), F.posexplode(grams).alias("pos", "gram"))
    return rows.groupBy("gram", "gram_len").agg(F.min_by("owner", F.struct("ord", "pos")).alias("owner"))


def short_items(items: DataFrame, owner: str, text: str, *, least: int = 5, compat: bool = True) -> DataFrame:
    """(owner, n): the items of each owner that are too short to make a gram."""
    n = F.size(match_words(F.col(text), compat))
    return items.where((n > 0) & (n < least)).groupBy(F.col(owner).alias("owner")).agg(F.count("*").alias("n"))


def row_name(key: str, text: str) -> Column:
    """What a row is known by: its key, or its text where it has none."""
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text), F.lit("")))))


def gram_hits(pool: DataFrame, key: str, text: str, grams: DataFrame, *, least: int = 5, compat: bool = True) -> DataFrame:
    """(row, key, owner, gram): of each contaminated row the hit that comes first, shorter grams before longer ones, then by
    place.

    Every gram has ``least`` words or more, so a row is joined with the grams by the hashes of its runs of just that many
    words, whatever lengths the grams have: one row of 20 bytes a word. Only the few candidates are then compared in full,
    with the words of their own rows. The planner broadcasts the grams only if they are small.
    """
    named = pool.select(row_name(key, text).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    words = with_normal_form(named, "text", compat).select("row", "key", match_words(F.col("text"), False).alias("t")).where(F.size("t") >= least)
    starts = words.select("row", F.posexplode(F.transform(ngrams(F.col("t"), least), lambda g: F.xxhash64(g))).alias("pos", "h"))
    begin = F.array_join(F.slice(F.split("gram", " "), 1, least), " ")
    near = starts.join(grams.select("gram", "gram_len", "owner", F.xxhash64(begin).alias("h")), "h").select("row", "pos", "gram", "gram_len", "owner")
    full = near.join(words, "row").where(F.array_join(F.slice("t", F.col("pos") + 1, F.col("gram_len")), " ") == F.col("gram"))
    first = full.groupBy("row").agg(F.min(F.struct("gram_len", "pos", "owner", "gram")).alias("h"), F.first("key").alias("key"))
    return first.select("row", F.col("key").alias(key), F.col("h.owner").alias("owner"), F.col("h.gram").alias("gram"))


def decontaminate(pool: DataFrame, key: str, text: str, items: DataFrame, owner: str, order: str, item_text: str, *, n: int = 13, least: int = 5, compat: bool = True) -> tuple[DataFrame, DataFrame]:
    """(clean rows, hits)."""
    hits = gram_hits(pool, key, text, item_grams(items, owner, order, item_text, n=n, least=least, compat=compat), least=least, compat=compat)
    return pool.withColumn("_row", row_name(key, text)).join(hits.select(F.col("row").alias("_row")), "_row", "left_anti").drop("_row"), hits


def removed_rows(pool: DataFrame, hits: DataFrame, key: str, text: str, columns: Sequence[str] = ()) -> DataFrame:
    """The audit: every removed row with its text, the stated columns, the owner and the gram that it was removed for."""
    named = pool.select(row_name(key, text).alias("_row"), key, text, *columns)
    return named.join(hits.select(F.col("row").alias("_row"), "owner", "gram"), "_row").drop("_row")


def removal_report(pool: DataFrame, hits: DataFrame, key: str, text: str, source: str, grams: DataFrame, short: DataFrame) -> DataFrame:
    """(section, name, value): rows in and removed and the share removed; removals by item owner, by source and by stage of
    the index: grams by length, grams by owner, items too short by owner."""
    rows = pool.select(row_name(key, text).alias("row"), F.col(source).alias("source")).join(hits.select("row", "owner"), "row", "left")
    removed = F.count_if(F.col("owner").isNotNull())
    total = rows.agg(F.count("*").alias("n"), removed.alias("r")).select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.cast("double").alias("value")) for k, v in (("in", F.col("n")), ("removed", F.col("r")), ("removal_rate", F.round(F.col("r") / F.greatest("n", F.lit(1)), 6)))])).alias("x")
    )
    named = lambda d, section, name, value: d.select(F.lit(section).alias("section"), F.col(name).cast("string").alias("name"), F.col(value).cast("double").alias("value"))
    parts = [
        total.select(F.lit("total").alias("section"), "x.name", "x.value"),
        named(rows.where("owner is not null").groupBy("owner").agg(F.count("*").alias("n")), "removed by owner", "owner", "n"),
        named(rows.groupBy("source").agg(removed.alias("n")), "removed by source", "source", "n"),
        named(grams.groupBy("gram_len").agg(F.count("*").alias("n")), "grams by length", "gram_len", "n"),
        named(grams.groupBy("owner").agg(F.count("*").alias("n")), "grams by owner", "owner", "n"),
        named(short, "too short by owner", "owner", "n"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out
