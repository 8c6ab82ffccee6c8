"""Scores and predicates on reasoning and answers, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.functions.text import let, ngrams, strip, words

# Words that negate.
NEGATIONS = ["not", "no", "never", "cannot", "can't", "won't", "isn't", "aren't", "wasn't", "weren't", "doesn't", "don't", "didn't", "false", "incorrect", "wrong", "impossible"]
# Fixed value: answers that say nothing else.
BOILERPLATE = (
    r"^(i (don'?t|do not) know|i am (not sure|unsure)|i('m| am) (not sure|unsure)|i cannot (answer|help|assist|provide|respond)|i('m| am) (just )?an ai|as an ai( (language model|assistant|system))?"
    r"|i apologize|i'?m sorry,? but i|this (question|topic|task|problem) is (too|very) (complex|broad|vague|difficult|sensitive|controversial)|i (am not able|am unable) to)[\s\.,!?]*$"
)
# Forms of numbers and formulas.
NUMBER = r"-?\d+(?:\.\d+)?(?:/\d+)?"
BOXED = r"\\boxed\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}"
RESULT = r"(?m)=\s*(-?\d+(?:\.\d+)?(?:/\d+)?)\s*(?:$|[^\w])"
INLINE_MATH = (r"\$([^$]+)\$", r"\\\((.+?)\\\)")
DISPLAY_MATH = (r"(?s)\$\$(.+?)\$\$", r"(?s)\\\[(.+?)\\\]")


def segment_ttr(tokens: Column, segment: int = 100) -> Column:
    """Mean share of distinct words over the full segments of a text; of the whole text where it is shorter than one. Null
    without words."""
    ttr = lambda t: F.size(F.array_distinct(t)) / F.size(t)

    def mean(t: Column) -> Column:
        n = F.size(t)
        starts = F.when(n >= segment, F.sequence(F.lit(1), n - segment + 1, F.lit(segment)))
        full = F.aggregate(F.transform(starts, lambda i: ttr(F.slice(t, i, segment))), F.lit(0.0), lambda a, x: a + x) / F.floor(n / segment)
        return F.when(n == 0, None).when(n < segment, ttr(t)).otherwise(full)

    return let(tokens, mean)


def top_gram_count(tokens: Column, n: int = 5) -> Column:
    """How often the most frequent run of n words occurs: the longest stretch of equal grams once they are sorted."""
    g = F.array_sort(ngrams(tokens, n))
    run = F.aggregate(
        g,
        F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("top")),
        lambda a, x: F.struct(x.alias("last"), F.when(x == a["last"], a["run"] + 1).otherwise(1).alias("run"), F.greatest(a["top"], F.when(x == a["last"], a["run"] + 1).otherwise(1)).alias("top")),
        lambda a: a["top"],
    )
    return run


def loops(text: Column, n: int = 5, floor: int = 40, words_per_repeat: int = 150) -> Column:
    """Some run of n words occurs more often than the floor, or than one time in ``words_per_repeat`` words if that is more."""

    def over(t: Column) -> Column:
        limit = F.greatest(F.lit(floor), F.floor(F.size(t) / words_per_repeat).cast("int"))
        return F.when(F.size(t) < limit + n, False).otherwise(top_gram_count(t, n) > limit)

    return let(words(F.lower(text)), over)


def contradicts(reasoning: Column, answer: Column, least_shared: int = 3) -> Column:
    """Just one of the two negates, and they share enough words of matter."""
    no = F.array(*[F.lit(w) for w in NEGATIONS])
    r, a = F.array_distinct(words(F.lower(reasoning))), F.array_distinct(words(F.lower(answer)))
    matter = lambda t: F.array_except(F.filter(t, lambda w: F.length(w) > 3), no)
    return (F.arrays_overlap(r, no) != F.arrays_overlap(a, no)) & (F.size(F.array_intersect(matter(r), matter(a))) >= least_shared)


def boilerplate(answer: Column) -> Column:
    return strip(F.coalesce(answer, F.lit(""))).rlike(f"(?iu){BOILERPLATE}")


def numbers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({NUMBER})"), 1))


def concluded_numbers(answer: Column) -> Column:
    """Numbers in boxes and those that follow an equals sign."""
    t = F.coalesce(answer, F.lit(""))
    boxed = F.flatten(F.transform(F.regexp_extract_all(t, F.lit(BOXED), 1), lambda x: F.regexp_extract_all(x, F.lit(f"({NUMBER})"), 1)))
    return F.array_union(boxed, F.regexp_extract_all(t, F.lit(RESULT), 1))


def formulas(text: Column) -> Column:
    """Formulas within dollar signs or LaTeX brackets, inline ones first."""
    t = F.coalesce(text, F.lit(""))
    found = F.concat(*[F.regexp_extract_all(t, F.lit(p), 1) for p in (*INLINE_MATH, *DISPLAY_MATH)])
    return F.filter(F.transform(found, strip), lambda x: x != "")


def derivable(concluded: Column, known: Column) -> Column:
    """Some concluded value is within 1e-6 of a known one; also where there is nothing to compare. Fractions are left out."""
    values = lambda a: F.transform(F.filter(a, lambda x: ~x.contains("/")), lambda x: x.cast("double"))
    a, r = values(concluded), values(known)
    return (F.size(a) == 0) | (F.size(r) == 0) | F.exists(a, lambda x: F.exists(r, lambda y: F.abs(x - y) < 1e-6))


def numbers_disjoint(reasoning: Column, answer: Column) -> Column:
    """The numbers an answer concludes with have nothing to do with those of its reasoning. Informational: it rejects nothing."""
    a, r = concluded_numbers(answer), numbers(reasoning)
    return (F.size(a) > 0) & (F.size(r) > 0) & ~F.arrays_overlap(a, r) & ~derivable(a, r)
