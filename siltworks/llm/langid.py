"""Document and segment languages (problem 6).

String-kernel classification. The blended-spectrum presence kernel of two segments is the number of character n-grams (one
to three characters, hashed) that both contain, divided by the geometric mean of their numbers of n-grams. Nyström landmark
segments turn it into an explicit map, on which one-versus-rest kernel ridge regression is fitted. Kernel values against
the landmarks are products of sparse rows with the landmark matrix; as the map and the ridge weights are linear in them,
the two matrices are multiplied out once and a batch of segments is scored by one product with an (n-grams x languages)
matrix.

The model is fitted on the driver on a bounded sample: the ``fit_rows`` labelled rows with the lowest hash of their id,
whole texts. A second fit leaves out segments that the first one contradicts, since labels are partly wrong. Scoring is
row by row in one pass; no text is shuffled.

Nulls: a null id or text is left out. A text without a sentence (three words, or four characters of a script without
spaces) is one segment as a whole; one without any letter has no language. Every language that some label of the sample
names is in the model, however rare, unless the first fit contradicts all of its segments. Repeated rows give the same rows, once each. Empty tables give empty results; where
no row is labelled, nothing can be learned and the result is empty.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textvec
from siltworks.llm.sampling import lowest_hash_rows

DIMS = 1 << 15
ORDERS = (1, 2, 3)
# Notations of the languages by code: ISO 639 codes, English and own names.
NOTATIONS = {
    "en": "en eng english",
    "de": "de deu ger german deutsch",
    "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano castilian",
    "pt": "pt por portuguese português portugues",
    "sv": "sv swe swedish svenska",
    "fi": "fi fin finnish suomi",
    "ru": "ru rus russian русский",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语",
    "it": "it ita italian italiano",
    "nl": "nl nld dut dutch nederlands",
    "pl": "pl pol polish polski",
    "ja": "ja jpn japanese 日本語",
    "ko": "ko kor korean 한국어",
    "ar": "ar ara arabic العربية",
    "da": "da dan danish dansk",
    "no": "no nor nb nob nn nno norwegian norsk",
    "uk": "uk ukr ukrainian українська",
    "tr": "tr tur turkish türkçe",
    "cs": "cs ces cze czech čeština",
}
_CODE_OF = {n: c for c, ns in NOTATIONS.items() for n in ns.split()}
_PROSE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`|\$[^$\n]*\$|https?://\S+|<[^<>\n]{1,60}>", re.S)
_QUOTED = re.compile(r"[\"“„«「『][^\"“”„«»「」『』\n]{1,80}[\"”“»」』]")
_CUT = re.compile(r"(?<=[.!?…:])\s+|(?<=[。！？：])|\n+")
_WORD = re.compile(r"[^\W\d_]{1,}")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")


def language_code(label: str | None) -> str | None:
    """The two-letter code that a label names in whatever notation, or null where it names no language known here."""
    if not label:
        return None
    low = label.strip().lower()
    return _CODE_OF.get(low) or _CODE_OF.get(re.split(r"[-_ (]", low, maxsplit=1)[0])


def segments(text: str) -> list[tuple[int, str]]:
    """(place in the text, sentence) of the sentences and instructions; code and short quotations are left out, unless there
    is nothing else."""
    blank = lambda m: " " * len(m[0])
    t = _PROSE.sub(blank, text)
    t = _QUOTED.sub(lambda m: m[0] if len(_WORD.findall(m[0])) > 6 and m[0][-2] in ".!?" or len(_CJK.findall(m[0])) > 12 or len(m[0]) > 0.6 * len(text) else blank(m), t)
    out, lo = [], 0
    for m in [*_CUT.finditer(t), None]:
        hi = m.start() if m else len(t)
        s = t[lo:hi]
        if len(_WORD.findall(s)) >= 3 or len(_CJK.findall(s)) >= 4:
            out.append((lo + len(s) - len(s.lstrip()), s.strip()))
        lo = m.end() if m else hi
    if not out:
        # No sentence: what there is counts as one, so that every text with a letter has a language.
        whole = t if any(c.isalpha() for c in t) else text
        if any(c.isalpha() for c in whole):
            out.append((len(whole) - len(whole.lstrip()), whole.strip()))
    return out


def spectrum(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(segment, n-gram): the distinct n-grams of every segment, sorted by segment."""
    texts = [unicodedata.normalize("NFC", t).lower() if not t.isascii() else t.lower() for t in texts]
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    cls = textvec.char_classes()[codes]
    seg = np.repeat(np.arange(len(texts)), lengths + 1)
    c = np.where((cls == 0) | (cls == 3), 32, codes).astype(np.uint64)
    use = ~((c == 32) & (np.concatenate(([32], c[:-1])) == 32))
    c, seg = c[use], seg[use].astype(np.uint64)
    keys = []
    for n in ORDERS:
        if len(c) < n:
            continue
        h = c[: len(c) - n + 1].copy()
        for k in range(1, n):
            h = h * np.uint64(0x9E3779B1) + c[k : len(c) - n + 1 + k]
        inside = seg[: len(h)] == seg[n - 1 :]
        h = textvec.mix(h + np.uint64(n)) >> np.uint64(64 - 15)
        keys.append((seg[: len(h)] << np.uint64(15) | h)[inside])
    k = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    return (k >> np.uint64(15)).astype(np.int64), (k & np.uint64(DIMS - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # (n-gram, language)

    def score(self, texts: Sequence[str]) -> np.ndarray:
        """(segment, language) regression values: near 1 for the segment's language, near 0 for the others."""
        out = np.zeros((len(texts), len(self.languages)), np.float32)
        lo = total = 0
        for i in range(len(texts) + 1):
            if i == len(texts) or total > 150_000:
                if i > lo:
                    seg, gram = spectrum(texts[lo:i])
                    if len(seg):
                        first = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
                        n = np.diff(np.append(first, len(seg)))
                        out[lo + seg[first]] = np.add.reduceat(self.weights[gram], first) / np.sqrt(n)[:, None]
                lo, total = i, 0
            if i < len(texts):
                total += len(texts[i])
        return out


def _dense(texts: Sequence[str]) -> np.ndarray:
    seg, gram = spectrum(texts)
    x = np.zeros((len(texts), DIMS), np.float32)
    x[seg, gram] = 1
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def fit(texts: Sequence[str], labels: Sequence[str], *, landmarks: int = 700, ridge: float = 1e-3, seed: int = 42) -> Model:
    """Nyström kernel ridge regression on labelled segments, rarer languages weighted up. Deterministic."""
    names = tuple(sorted(set(labels)))
    if not names:
        return Model((), np.zeros((DIMS, 0), np.float32))
    rng = np.random.default_rng(seed)
    y = np.array([names.index(l) for l in labels])
    # Half of the landmarks in equal parts from every language, half as the segments come, for the varied large ones.
    each = max(4, landmarks // (2 * len(names)))
    marks = np.unique(np.concatenate([rng.permutation(np.flatnonzero(y == k))[:each] for k in range(len(names))] + [rng.permutation(np.flatnonzero(y >= 0))[: landmarks // 2]]))
    m = _dense([texts[i] for i in marks])
    by_gram = np.ascontiguousarray(m.T)
    values, vectors = np.linalg.eigh((m @ m.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    share = np.bincount(y[y >= 0], minlength=len(names))
    a, b = np.zeros((root.shape[1],) * 2), np.zeros((root.shape[1], len(names)))
    known = np.flatnonzero(y >= 0)
    for lo in range(0, len(known), 64):
        rows = known[lo : lo + 64]
        seg, gram = spectrum([texts[i] for i in rows])
        at = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
        rows = rows[seg[at]]
        z = (np.add.reduceat(by_gram[gram], at) / np.sqrt(np.diff(np.append(at, len(seg))))[:, None]).astype(np.float64) @ root
        w = 1 / np.sqrt(share[y[rows]])
        a += (z * w[:, None]).T @ z
        b += (z * w[:, None]).T @ np.eye(len(names))[y[rows]]
    ridge_w = np.linalg.solve(a + ridge * np.eye(len(a)), b)
    return Model(names, (m.T.astype(np.float64) @ (root @ ridge_w)).astype(np.float32))


def fit_from_rows(texts: Sequence[str], labels: Sequence[str], seed: int = 42, fit_segments: int = 9000) -> Model:
    """A model from labelled texts of which some labels are wrong: the second fit keeps the segments that the first one
    gives their text's label. Of more than ``fit_segments`` segments, a random part of each language's is used, the rarer
    languages' being larger."""
    seg, lab = [], []
    for t, l in zip(texts, labels, strict=True):
        for _, s in segments(t):
            seg.append(s)
            lab.append(l)
    if len(seg) > fit_segments:
        rng, kinds = np.random.default_rng(seed), np.array(lab)
        each = fit_segments // max(1, len(set(lab)))
        part = [rng.permutation(np.flatnonzero(kinds == l)) for l in sorted(set(lab))]
        spare = fit_segments - sum(min(len(x), each) for x in part)
        longest = max(range(len(part)), key=lambda k: len(part[k]))
        take = np.concatenate([x[: each + (spare if k == longest else 0)] for k, x in enumerate(part)])
        seg, lab = [seg[i] for i in take], [lab[i] for i in take]
    first = fit(seg, lab, seed=seed)
    if not first.languages:
        return first
    best = [first.languages[k] for k in first.score(seg).argmax(1)]
    keep = [i for i, (l, g) in enumerate(zip(lab, best, strict=True)) if l == g]
    return fit([seg[i] for i in keep], [lab[i] for i in keep], seed=seed)


def _confidence(v: np.ndarray) -> np.ndarray:
    e = np.exp(6 * (v - v.max(1, keepdims=True)))
    return e / e.sum(1, keepdims=True)


def segment_languages(df: DataFrame, id_col: str, text_col: str, label_col: str, *, fit_rows: int = 5000, seed: int = 42) -> DataFrame:
    """(id, label, start, length, language, confidence): a row for each stretch of one language in each text.

    label: the code that the text's own label names, null for none. Neighbouring sentences of one language make a stretch;
    its confidence is their mean, weighted by length.
    """
    rows = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
    sample = lowest_hash_rows(rows.where(F.col("label").isNotNull()), ["id", "text"], ["text", "label"], fit_rows, seed)
    sample["code"] = sample["label"].map(language_code)
    sample = sample[sample["code"].notna()]
    model = fit_from_rows(sample["text"].tolist(), sample["code"].tolist(), seed)
    id_type = rows.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, ids, labels = b["text"].tolist(), b["id"].tolist(), b["label"].tolist()
            out = []
            for lo, hi in textvec.chunks(texts):
                at = [(i, p, s) for i in range(lo, hi) for p, s in segments(texts[i])]
                if not at or not model.languages:
                    continue
                v = model.score([s for _, _, s in at])
                best, conf = v.argmax(1), _confidence(v).max(1)
                stretch: list = []
                for (i, p, s), k, c in zip(at, best.tolist(), conf.tolist(), strict=True):
                    if stretch and stretch[0] == i and stretch[3] == k:
                        stretch[2], stretch[4], stretch[5] = p + len(s), stretch[4] + c * len(s), stretch[5] + len(s)
                    else:
                        if stretch:
                            out.append(tuple(stretch))
                        stretch = [i, p, p + len(s), k, c * len(s), len(s)]
                out.append(tuple(stretch))
            yield pd.DataFrame([(ids[i], language_code(labels[i]), p, q - p, model.languages[k], c / n) for i, p, q, k, c, n in out], columns=["id", "label", "start", "length", "language", "confidence"])

    return rows.mapInPandas(score, f"id {id_type}, label string, start int, length int, language string, confidence double").withColumnRenamed("id", id_col)


def document_languages(df: DataFrame, id_col: str, text_col: str, label_col: str, *, least_confidence: float = 0.6, **options: object) -> DataFrame:
    """(id, label, language, share, confidence, languages): a row for each language of each text. A stretch under the least
    confidence adds no language of its own to a text."""
    stretches = segment_languages(df, id_col, text_col, label_col, **options)
    per = stretches.distinct().groupBy(id_col, "language").agg(F.max("label").alias("label"), F.sum("length").alias("length"), F.max("confidence").alias("confidence"))
    grouped = per.groupBy(id_col).agg(F.max("label").alias("label"), F.sum("length").alias("total"), F.max("confidence").alias("top"), F.collect_list(F.struct("language", "length", "confidence")).alias("all"))
    kept = grouped.withColumn("sure", F.filter("all", lambda x: (x["confidence"] >= least_confidence) | (x["confidence"] == F.col("top"))))
    return kept.select(id_col, "label", F.size("sure").alias("languages"), "total", F.explode("sure").alias("x")).select(id_col, "label", F.col("x.language").alias("language"), (F.col("x.length") / F.col("total")).alias("share"), F.col("x.confidence").alias("confidence"), "languages")


def mislabelled(df: DataFrame, id_col: str, text_col: str, label_col: str, **options: object) -> DataFrame:
    """(id, language): of the texts in several languages, or whose label is missing or wrong, a row for each language."""
    d = document_languages(df, id_col, text_col, label_col, **options)
    return d.where((F.col("languages") > 1) | F.col("label").isNull() | (F.col("label") != F.col("language"))).select(id_col, "language").distinct()
