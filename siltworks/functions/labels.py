"""Keyword labels of domain and difficulty."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltworks.functions.text import let, words

# Keywords of a prompt's domain, in order of precedence on ties.
PROMPT_KEYWORDS = {
    "math": ["calculate", "compute", "solve", "equation", "integral", "derivative", "probability", "algebra", "geometry", "arithmetic", "theorem", "proof", "matrix", "vector", "polynomial"],
    "code": ["write a function", "implement", "code", "python", "javascript", "algorithm", "data structure", "debug", "program", "class", "method", "api", "sql"],
    "science": ["physics", "chemistry", "biology", "molecule", "reaction", "force", "energy", "quantum", "cell", "organism", "evolution", "atom"],
    "language": ["translate", "grammar", "essay", "summarize", "paraphrase", "syntax", "vocabulary", "word", "sentence", "paragraph", "write", "explain"],
}
# Keywords of a cluster's domain, in order of precedence on ties.
CLUSTER_KEYWORDS = {
    "math": ["equation", "solve", "calculate", "proof", "algebra", "geometry", "integral", "derivative", "theorem", "probability", "matrix", "statistics", "arithmetic", "calculus", "combinatorics"],
    "code": ["function", "algorithm", "python", "javascript", "implement", "code", "program", "class", "debug", "api", "sql", "data structure", "typescript", "java", "c++", "rust", "compiler", "runtime", "loop"],
    "science": ["physics", "chemistry", "biology", "molecule", "reaction", "force", "energy", "quantum", "cell", "evolution", "atom", "element", "gravity", "photosynthesis", "dna", "orbit", "thermodynamics"],
    "reasoning": ["logic", "deduce", "conclude", "premise", "fallacy", "puzzle", "riddle", "infer", "argument", "valid", "syllogism", "paradox", "critical thinking", "analyze the argument"],
    "writing": ["essay", "story", "creative", "draft", "edit", "narrative", "fiction", "poem", "blog post", "article", "rewrite", "tone", "introduction", "conclusion", "persuasive"],
    "language": ["translate", "grammar", "vocabulary", "synonym", "paraphrase", "conjugate", "tense", "linguistic", "idiom", "pronoun", "sentence structure", "spanish", "french", "mandarin"],
    "knowledge": ["history", "geography", "capital", "who was", "when did", "what is", "define", "explain", "culture", "biography", "encyclopedia", "fact", "event", "founded"],
    "instruction": ["how to", "steps to", "how do i", "guide me", "tutorial", "walk me through", "recipe", "procedure", "instructions for", "set up", "configure", "install"],
}
# Fixed value: phrases that mark a prompt of several steps.
MULTI_STEP = r"\b(step[- ]by[- ]step|derive|prove|explain why|how does|compare|contrast|analyze|evaluate|critique|design|implement|calculate.*and then|first.*then|multiple|several|list all)\b"
#: Words from which a prompt is hard, and up to which it is easy.
HARD_WORDS, EASY_WORDS = 200, 50


def best_label(scores: Mapping[str, Column], otherwise: str) -> Column:
    """The first label with the highest positive score."""
    ranked = F.array(*[F.struct(s.cast("int").alias("n"), F.lit(-i).alias("i"), F.lit(label).alias("label")) for i, (label, s) in enumerate(scores.items())])
    return let(F.array_max(ranked), lambda b: F.when(b["n"] > 0, b["label"]).otherwise(otherwise))


def prompt_domain(text: Column, keywords: Mapping[str, Sequence[str]] = PROMPT_KEYWORDS) -> Column:
    """By non-overlapping keyword hits of any case; ``general`` without one."""
    t = F.coalesce(text, F.lit(""))
    return best_label({d: F.regexp_count(t, F.lit("(?iu)" + "|".join(re.escape(k) for k in ks))) for d, ks in keywords.items()}, "general")


def occurrences(text: Column, phrase: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(phrase), F.lit("")))) / len(phrase)).cast("int")


def cluster_domain(text: Column, keywords: Mapping[str, Sequence[str]] = CLUSTER_KEYWORDS) -> Column:
    """By the sum of every keyword's own hits, overlaps between keywords counting for each; ``other`` without one."""
    score = lambda t, ks: sum((occurrences(t, k) for k in ks[1:]), occurrences(t, ks[0]))
    return let(F.lower(F.coalesce(text, F.lit(""))), lambda t: best_label({d: score(t, ks) for d, ks in keywords.items()}, "other"))


def difficulty(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    n = F.size(words(t))
    steps = t.rlike(f"(?iuU){MULTI_STEP}")
    return F.when((n >= HARD_WORDS) | steps, "hard").when(n <= EASY_WORDS, "easy").otherwise("medium")
