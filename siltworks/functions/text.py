"""Column builders for text: blanks, normal forms, words, content ids, word n-grams, truncation."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every character that separates words, in Java's regular expressions: the ASCII set and all Unicode separators.
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once, also where f uses it within a lambda, which would compute it at every element."""
    return F.transform(F.array(value), f)[0]


def strip(c: Column) -> Column:
    """Text without blanks at its ends."""
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+$", "")


def is_blank(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).rlike(rf"[^\s\x1c-\x1f\x85\p{{Z}}]")


def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """Compatibility normal form. Spark has no such function, so this is one of the few places that need Python."""
    return F.pandas_udf(_nfkc, "string")(c)


def with_normal_form(df: DataFrame, column: str, compat: bool = True) -> DataFrame:
    """df with the column in compatibility normal form; only rows with other than ASCII characters go through Python."""
    if not compat:
        return df
    plain = F.coalesce(~F.col(column).rlike(r"[^\x00-\x7F]"), F.lit(True))
    return df.where(plain).unionByName(df.where(~plain).withColumn(column, nfkc(F.col(column))))


def collapse(c: Column) -> Column:
    """Runs of blanks become one space, none are left at the ends."""
    return F.btrim(F.regexp_replace(c, f"{BLANK}+", " "))


def normalise(c: Column, compat: bool = True) -> Column:
    return collapse(nfkc(c) if compat else c)


def words(c: Column) -> Column:
    """Words between blanks; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{BLANK}+"), lambda w: w != "")


def match_words(c: Column, compat: bool = True) -> Column:
    """Lower-case runs of letters and digits: the words by which texts are matched."""
    t = F.coalesce(c, F.lit(""))
    return F.filter(F.split(F.regexp_replace(F.lower(nfkc(t) if compat else t), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def content_id(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.substring(F.sha2(c, 256), 1, 32))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens joined by blanks, in order; none where there are fewer tokens."""

    def windows(t: Column) -> Column:
        starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i, n), " "))

    return let(tokens, windows)


def last_words(c: Column, n: int) -> Column:
    """The last n words joined by single blanks; a text of up to n words as it is."""
    return let(words(c), lambda w: F.when(F.size(w) <= n, c).otherwise(F.array_join(F.slice(w, -n, n), " ")))


def first_words(c: Column, n: int) -> Column:
    """The first n words and a note of how many follow; a text of up to n words as it is."""
    w = words(c)
    return F.when(F.size(w) <= n, c).otherwise(F.concat(F.array_join(F.slice(w, 1, n), " "), F.lit("\n… [truncated — "), (F.size(w) - n).cast("string"), F.lit(" more words]")))


def file_slug(c: Column) -> Column:
    """A name that is safe in a path: slashes and colons become underscores, at most 120 characters."""
    return F.substring(F.translate(c, "/:", "__"), 1, 120)


def shorten(c: Column, n: int = 120) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def nonempty(c: Column) -> Column:
    """Null for empty strings: both count as missing wherever values fall through to the next one."""
    return F.when(c != "", c)
