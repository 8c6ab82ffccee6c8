"""Repetition inside a single document (problem 7).

The share of a text is measured exactly: the share of words (characters in scripts without spaces) that lie in a phrase,
sentence or paragraph that occurred earlier in the same text. Gradient-boosted trees estimate it besides from statistics of
all of a text's phrases, words and sentences (trees.py: flat node arrays, monotonic in the repetition statistics). A caller
may let the estimate stand where it differs from ``least_share`` by more than ``band``; by default no estimate does, since
the trees err on a few texts. Everything happens row by row in one pass; only ids and shares are shuffled, and no text
leaves its task.

The trees are fitted on the driver on a bounded sample (``fit_rows`` texts with the lowest hash of their id, whole texts)
and on the same texts with passages repeated on purpose, their targets being the exact measure. By default no share
depends on them.

Nulls: a null id or text is left out; a text without words has share 0. Ties and repeated rows: the largest share of a
field is kept, each id comes once. An empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textvec, trees
from siltworks.llm.sampling import lowest_hash_rows

#: Words of a phrase that counts as repeated; in scripts without spaces, characters.
PHRASE, PHRASE_CJK = 4, 8
FEATURES = ("phrases", "sentence", "sentences", "loop", "seen", "log_words", "cjk")
#: The statistics in which the estimate may only rise.
RISING = (0, 1, 2, 3)
#: Longest period, in words, of the loops that the statistics look for; longer ones show in the phrases.
LOOP = 24
_ENDS = np.zeros(0x110000, bool)
_ENDS[[ord(c) for c in ".!?;\n。！？；…"]] = True


def _words(texts: Sequence[str]) -> textvec.Words:
    """The words of the texts, case folded, without the numbers that only count items."""
    w = textvec.Words([t.lower() for t in texts])
    digit = (w.cls[w.start] == 3) & (w.cls[w.end - 1] == 3) & (w.end - w.start <= 3)
    after = w.codes[np.minimum(w.end, len(w.codes) - 1)]
    mark = digit & ((after == 46) | (after == 41) | (after == 58))
    if mark.any():
        w.keep(~mark)
    return w


def _cover(doc: np.ndarray, dup: np.ndarray, n: np.ndarray | int, total: int) -> np.ndarray:
    """Marks the words that the marked phrases span."""
    d = np.zeros(total + 1, np.int64)
    at = np.flatnonzero(dup)
    np.add.at(d, at, 1)
    np.add.at(d, np.minimum(at + (n if np.isscalar(n) else n[at]), total), -1)
    return np.cumsum(d[:-1]) > 0


def _phrase_repeats(w: textvec.Words, n: int) -> np.ndarray:
    g = textvec.grams(w.h, n)
    inside = w.doc[: len(g)] == w.doc[n - 1 :] if len(g) else np.zeros(0, bool)
    dup = np.zeros(len(w.h), bool)
    at = np.flatnonzero(inside)
    if len(at):
        dup[at] = textvec.repeats(w.doc[at], g[at])
    return dup


def _sentences(w: textvec.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each sentence's first word, number of words and hash."""
    if not len(w.h):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    ends = np.concatenate(([0], np.cumsum(_ENDS[w.codes])))
    new = np.concatenate(([True], (ends[w.start[1:]] > ends[w.end[:-1]]) | (w.doc[1:] != w.doc[:-1])))
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(w.h)))
    place = np.arange(len(w.h)) - np.repeat(first, n)
    h = np.add.reduceat(textvec.mix(w.h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first)
    return first, n, h


def _shares(w: textvec.Words, mask: np.ndarray) -> np.ndarray:
    return np.bincount(w.doc[mask], minlength=w.n_docs) / np.maximum(w.counts(), 1)


def _wide(w: textvec.Words) -> np.ndarray:
    """The share of each text's words that are characters of a script without spaces."""
    return _shares(w, w.cls[w.start] == 2) if len(w.h) else np.zeros(w.n_docs)


def _exact(w: textvec.Words) -> np.ndarray:
    total = len(w.h)
    if not total:
        return np.zeros(w.n_docs)
    in_wide = (_wide(w) > 0.5)[w.doc]
    short, long = _phrase_repeats(w, PHRASE), _phrase_repeats(w, PHRASE_CJK)
    phrase = _cover(w.doc, np.where(in_wide, long, short), np.where(in_wide, PHRASE_CJK, PHRASE), total)
    first, n, h = _sentences(w)
    dup = textvec.repeats(w.doc[first], h) & (n >= 2)
    return _shares(w, phrase | np.repeat(dup, n))


def _statistics(w: textvec.Words) -> np.ndarray:
    total, docs = len(w.h), w.n_docs
    if not total:
        return np.zeros((docs, len(FEATURES)))
    cjk, counts = _wide(w), w.counts()
    wide = (cjk > 0.5)[w.doc]
    g = textvec.grams(w.h, PHRASE)
    if len(w.h) >= PHRASE_CJK and wide.any():
        at = np.flatnonzero(wide[: len(w.h) - PHRASE_CJK + 1])
        g[at] = textvec.grams(w.h, PHRASE_CJK)[at]
    size = np.where(wide[: len(g)], PHRASE_CJK, PHRASE)
    end = np.minimum(np.arange(len(g)) + size - 1, total - 1)
    at = np.flatnonzero(w.doc[: len(g)] == w.doc[end])
    again = textvec.repeats(w.doc[at], g[at]) if len(at) else np.zeros(0, bool)
    phrases = np.bincount(w.doc[at[again]], minlength=docs) / np.maximum(np.bincount(w.doc[at], minlength=docs), 1)
    first, n, h = _sentences(w)
    dup = textvec.repeats(w.doc[first], h) & (n >= 2)
    sentence = np.bincount(w.doc[first[dup]], weights=n[dup], minlength=docs) / np.maximum(counts, 1)
    sentences = np.bincount(w.doc[first[dup]], minlength=docs) / np.maximum(np.bincount(w.doc[first], minlength=docs), 1)
    seen = _shares(w, textvec.repeats(w.doc, w.h))
    loop = np.zeros(docs)
    for lag in range(1, min(LOOP, total - 1) + 1):
        same = np.flatnonzero((w.h[lag:] == w.h[:-lag]) & (w.doc[lag:] == w.doc[:-lag]))
        # Runs of a phrase's length only, so that frequent words don't count.
        run = same[PHRASE - 1 :][same[PHRASE - 1 :] - same[: len(same) - PHRASE + 1] == PHRASE - 1] if len(same) >= PHRASE else same[:0]
        loop = np.maximum(loop, np.bincount(w.doc[run], minlength=docs) / np.maximum(counts, 1))
    return np.stack([phrases, sentence, sentences, loop, seen, np.log1p(counts), cjk], 1)


def _by_chunks(texts: Sequence[str], of, empty: np.ndarray) -> np.ndarray:
    return np.concatenate([empty, *[of(_words(texts[lo:hi])) for lo, hi in textvec.chunks(texts)]])


def statistics(texts: Sequence[str]) -> np.ndarray:
    """The statistics of each text."""
    return _by_chunks(texts, _statistics, np.zeros((0, len(FEATURES))))


def exact_shares(texts: Sequence[str]) -> np.ndarray:
    """The exact share of repeated words of each text."""
    return _by_chunks(texts, _exact, np.zeros(0))


def fit_scorer(texts: Sequence[str], seed: int = 42) -> trees.Forest:
    """Trees fitted to the exact share on the texts and on copies with passages repeated on purpose."""
    rng = random.Random(seed)
    made = list(texts)
    for t in texts:
        parts = [p for p in t.replace("\n", ". ").split(". ") if p]
        if len(parts) > 1 and rng.random() < 0.6:
            k = rng.randrange(len(parts))
            again = parts[k : k + rng.choice((1, 1, 2, 3))]
            made.append(". ".join(parts[: k + 1] + again * rng.randint(1, 2 + len(parts)) + parts[k + 1 :]))
        words = t.split()
        if len(words) > 8 and rng.random() < 0.6:
            # A phrase that loops, as in a broken generation.
            k, n = rng.randrange(len(words) - 4), rng.randint(1, 40)
            made.append(" ".join(words[: k + n] + words[k : k + n] * max(1, int(rng.random() * len(words) * 2 / n)) + words[k + n :]))
    return trees.fit(statistics(made), exact_shares(made), monotonic=RISING, trees=60)


def decide(forest: trees.Forest, texts: Sequence[str], least_share: float, band: float) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, share) of each text; the share is measured where the estimate is within ``band`` of ``least_share``."""
    estimate = np.clip(forest.score(statistics(texts)), 0, 1)
    share, near = estimate.copy(), np.flatnonzero(np.abs(estimate - least_share) <= band)
    if len(near):
        share[near] = exact_shares([texts[i] for i in near])
    return estimate, share


def repetition_shares(df: DataFrame, id_col: str, fields: Sequence[str], *, fit_rows: int = 1500, least_share: float = 0.35, band: float = 1.0, seed: int = 42) -> DataFrame:
    """(id, field, estimate, share) of every non-null text; share is measured where the trees' estimate is within ``band`` of
    ``least_share``, which by default all are, and elsewhere the estimate."""
    fields = list(fields)
    texts = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *[F.col(f).cast("string").alias(f"t{k}") for k, f in enumerate(fields)])
    sample = lowest_hash_rows(texts, ["id"], [f"t{k}" for k in range(len(fields))], fit_rows, seed)
    forest = fit_scorer([t for c in sample for t in sample[c] if isinstance(t, str)], seed)
    id_type = texts.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k, f in enumerate(fields):
                s = b[f"t{k}"]
                s = s[s.notna()]
                if not len(s):
                    continue
                estimate, share = decide(forest, s.tolist(), least_share, band)
                yield pd.DataFrame({"id": b["id"].loc[s.index], "field": f, "estimate": estimate, "share": share})

    scored = texts.mapInPandas(score, f"id {id_type}, field string, estimate double, share double")
    return scored.groupBy("id", "field").agg(F.max("estimate").alias("estimate"), F.max("share").alias("share")).withColumnRenamed("id", id_col)


def repetitive(df: DataFrame, id_col: str, fields: Sequence[str], *, least_share: float = 0.35, **options: object) -> DataFrame:
    """(id) of the rows of which some field's repeated share reaches ``least_share``."""
    return repetition_shares(df, id_col, fields, least_share=least_share, **options).where(F.col("share") >= least_share).select(id_col).distinct()
