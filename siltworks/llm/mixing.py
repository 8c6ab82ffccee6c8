"""Mixing sources to target weights (problem 9).

Soft-membership mixing. Every document has a posterior over the sources: a label is an observation, so a labelled one is of
its own source; an unlabelled one has what a classifier on the table of labelled documents says, however uncertain.
Distributed projected-gradient least squares then fits a rate to every document, between 0 and its cap, so that the expected
tokens of each source match its share of the total. Labelled documents of one source have the same posterior, so they share
one rate and enter the fit as one row; a step's gradient is one aggregation over that table, and rates are replayed from the
past gradients (a few numbers a step) where they are needed, so no state has to survive on a worker.

Rates become whole numbers of copies: the whole part, and for the rest, documents of a source in descending size, in groups
of at most about ``group_rows``, each carrying to the next what it takes too much or too little. The report counts expected
tokens: an unlabelled document counts for each source by its posterior. Its row in the mixture names its most probable
source; the least cap of all sources that it is likely of holds for it.

``total_tokens``: a number of tokens; ``"all"`` for as many as the listed sources have, where scarce sources are repeated up
to their caps and those that still miss their share are reported as exhausted; or, by default, the greatest total at which
every source that has documents and may be used reaches its share under its cap, so that the shares follow the targets. A
source that can't serve any share doesn't count there, and is reported as exhausted with a share of 0. The classifier is a
multinomial one over hashed words, fitted on the driver on the ``fit_rows`` labelled documents with the lowest hash of their
id.

Nulls: a null id or text is left out; a null source is unlabelled; sources outside the targets get rate 0, and so does what
an unlabelled document may be of them. A repeated id counts once. Empty tables, or targets that no document can serve, give
an empty mixture and shares of 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textvec, tokens
from siltworks.llm.sampling import lowest_hash_rows
from siltworks.session import stored

_PLACES = 1 << 16
#: Posterior from which an unlabelled document may not be used more often than a source allows.
LIKELY = 0.05


@dataclass(frozen=True)
class SourceModel:
    sources: tuple[str, ...]
    weights: np.ndarray  # (place, source): log-likelihoods
    prior: np.ndarray

    def posterior(self, texts: Sequence[str]) -> np.ndarray:
        out = np.tile(self.prior, (len(texts), 1))
        for lo, hi in textvec.chunks(texts):
            w = textvec.Words([t.lower() for t in texts[lo:hi]])
            np.add.at(out, lo + w.doc, self.weights[(w.h >> np.uint64(48)).astype(np.int64)])
        out -= out.max(1, keepdims=True)
        e = np.exp(out)
        return e / e.sum(1, keepdims=True)


def fit_sources(texts: Sequence[str], sources: Sequence[str]) -> SourceModel:
    names = tuple(sorted(set(sources)))
    counts = np.full((_PLACES, len(names)), 0.1)
    at = np.array([names.index(s) for s in sources], np.int64)
    for lo, hi in textvec.chunks(texts):
        w = textvec.Words([t.lower() for t in texts[lo:hi]])
        np.add.at(counts, ((w.h >> np.uint64(48)).astype(np.int64), at[lo + w.doc]), 1)
    weights = np.log(counts / counts.sum(0)) if len(names) else counts
    prior = np.log((np.bincount(at, minlength=len(names)) + 1) / (len(at) + len(names))) if len(names) else np.zeros(0)
    return SourceModel(names, weights.astype(np.float32), prior)


def replay_rates(p: np.ndarray, caps: np.ndarray, steps: Sequence[np.ndarray]) -> np.ndarray:
    """Rates after the projected steps so far."""
    r = np.zeros(len(p))
    for g in steps:
        r = np.clip(r - p @ g, 0, caps)
    return r


def fit_rates(table: DataFrame, targets: np.ndarray, reach: np.ndarray, *, rounds: int = 30, tolerance: float = 1e-5) -> list[np.ndarray]:
    """The steps of projected-gradient least squares on table (p array<double>, cap double, tokens double). The gradient of
    a source is scaled by all of its tokens, so a step closes the whole gap where documents are of one source."""
    steps: list[np.ndarray] = []
    k = len(targets)

    def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(k)
        for b in batches:
            if len(b):
                p = np.stack(b["p"].to_numpy())
                total += (replay_rates(p, b["cap"].to_numpy(), steps) * b["tokens"].to_numpy()) @ p
        yield pd.DataFrame({"source": np.arange(k), "tokens": total})

    last = np.zeros(k)
    for _ in range(rounds):
        gap = last - targets
        step = np.where(reach > 0, gap / np.maximum(reach, 1e-9), 0)
        steps.append(step)
        rows = table.mapInPandas(expected, "source int, tokens double").groupBy("source").agg(F.sum("tokens").alias("t")).collect()
        now = np.zeros(k)
        for r in rows:
            now[r["source"]] = r["t"]
        if np.abs(now - last).max() <= tolerance * max(targets.sum(), 1e-9):
            break
        last = now
    return steps


def whole_copies(rates: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whole numbers of copies of documents in descending size, so that their tokens keep up with the rates: what a document
    takes too much or too little is carried to the next, and what is left at the end is less than the smallest ones."""
    out, owed = np.floor(rates).astype(np.int32), 0.0
    for i, (f, n) in enumerate(zip((rates - out).tolist(), sizes.tolist(), strict=True)):
        owed += f * n
        if f > 0 and owed >= n / 2:
            out[i] += 1
            owed -= n
    return out


def _caps_of(p: np.ndarray, caps: np.ndarray) -> np.ndarray:
    least = np.where(p >= LIKELY, caps, np.inf).min(1)
    return np.where(np.isfinite(least), least, 0.0)


def _least_cap(caps: np.ndarray):
    """The least cap of the sources that a document (column p) is likely of."""
    return F.coalesce(F.array_min(F.transform(F.array(*[F.lit(float(c)) for c in caps]), lambda c, i: F.when(F.get("p", i) >= LIKELY, c))), F.lit(0.0))


def mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, targets: DataFrame, *, total_tokens: float | str | None = None, vocabulary: str = tokens.VOCABULARY, fit_rows: int = 3000, group_rows: int = 20_000, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(mixture, report). mixture: (id, source, tokens, copies) of the documents taken at least once, source being their own
    or most probable one. report: the targets with the expected tokens there are, those taken, the share reached and whether
    the source is exhausted: its tokens times its cap are fewer than its share of the total."""
    spark = docs.sparkSession
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(source_col).cast("string").alias("source"))
    goals = [r.asDict() for r in targets.select("source", "target_share", "max_repeats").where("source is not null and target_share > 0").orderBy("source").collect()]
    names = [g["source"] for g in goals]
    caps = np.array([max(0, g["max_repeats"] if g["max_repeats"] is not None else 1) for g in goals], float)
    share = np.array([g["target_share"] for g in goals], float)
    k = len(names)
    unlabelled = rows.where("source is null")
    labelled = rows.where(F.col("source").isNotNull())
    sample = lowest_hash_rows(labelled, ["id"], ["text", "source"], fit_rows, seed) if not unlabelled.isEmpty() else pd.DataFrame({"text": [], "source": []})
    model = fit_sources(sample["text"].tolist(), sample["source"].tolist())
    column = np.array([names.index(s) if s in names else -1 for s in model.sources], int)
    id_type = rows.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(model)

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for b in batches:
            source = b["source"].where(b["source"].notna(), None).tolist()
            texts = b["text"].tolist()
            p: list = [None] * len(b)
            free = [i for i, s in enumerate(source) if s is None]
            if free and len(m.sources):
                q = m.posterior([texts[i] for i in free])
                for i, row in zip(free, q, strict=True):
                    full = np.zeros(k)
                    np.add.at(full, column[column >= 0], row[column >= 0])
                    p[i], source[i] = (full, names[int(full.argmax())]) if full.any() else (None, "")
            else:
                for i in free:
                    source[i] = ""
            yield pd.DataFrame({"id": b["id"], "source": source, "p": p, "tokens": np.array(tokens.count_tokens(texts, vocabulary), np.int64)})

    # An id that comes again counts once, with its least row.
    soft = stored(rows.mapInPandas(members, f"id {id_type}, source string, p array<double>, tokens long").groupBy("id").agg(F.min(F.struct("source", "tokens", "p")).alias("m")).select("id", "m.*").where(F.col("source").isin(names)))
    one = {s: [float(i == j) for j in range(k)] for i, s in enumerate(names)}
    hard_p = spark.createDataFrame([(s, one[s], float(caps[i])) for i, s in enumerate(names)], "source string, hard array<double>, cap double")
    groups = soft.where("p is null").groupBy("source").agg(F.sum("tokens").cast("double").alias("tokens")).join(hard_p, "source").select(F.col("hard").alias("p"), "cap", "tokens", F.lit(True).alias("sure"))
    singles = soft.where("p is not null").select("p", _least_cap(caps).alias("cap"), F.col("tokens").cast("double").alias("tokens"), F.lit(False).alias("sure"))
    table = stored(groups.unionByName(singles))
    # What labelled documents of a source can give is sure; unlabelled ones always give to other sources too, so they make up
    # what a source can reach only where it has no others.
    reach_rows = table.select(F.posexplode("p").alias("i", "x"), "tokens", "cap", "sure").groupBy("i").agg(
        F.sum(F.col("x") * F.col("tokens")).alias("t"), F.sum(F.when(F.col("sure"), F.col("x") * F.col("tokens") * F.col("cap"))).alias("sure"), F.sum(F.col("x") * F.col("tokens") * F.col("cap")).alias("most")
    )
    reach, most = np.zeros(k), np.zeros(k)
    for r in reach_rows.collect():
        reach[r["i"]], most[r["i"]] = r["t"], r["sure"] or r["most"]
    if total_tokens == "all":
        total = float(reach.sum())
    elif total_tokens is not None:
        total = float(total_tokens)
    else:
        total = float((most / share)[most > 0].min()) if (most > 0).any() else 0.0
    steps = fit_rates(table, share * total, reach) if k and total > 0 else []

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fixed = replay_rates(np.eye(k), caps, steps) if k else np.zeros(0)
        place = {s: i for i, s in enumerate(names)}
        for b in batches:
            at = b["source"].map(place).to_numpy()
            r = fixed[at]
            free = np.flatnonzero(b["p"].notna().to_numpy())
            if len(free):
                p = np.stack(b["p"].iloc[free].to_numpy())
                r[free] = replay_rates(p, _caps_of(p, caps), steps)
            yield pd.DataFrame({"id": b["id"], "source": b["source"], "tokens": b["tokens"], "p": b["p"], "rate": r})

    rated = soft.mapInPandas(rate, f"id {id_type}, source string, tokens long, p array<double>, rate double").where("rate > 0")
    sizes = soft.groupBy("source").agg(F.ceil(F.count("*") / group_rows).alias("groups"))
    grouped = rated.join(sizes, "source").withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("groups")))

    def whole(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["tokens", "id"], ascending=[False, True], kind="stable")
        return pd.DataFrame({"id": g["id"], "source": g["source"], "tokens": g["tokens"], "p": g["p"], "copies": whole_copies(g["rate"].to_numpy(), g["tokens"].to_numpy())})

    drawn = grouped.groupBy("source", "part").applyInPandas(whole, f"id {id_type}, source string, tokens long, p array<double>, copies int").where("copies > 0")
    mixture = drawn.select(F.col("id").alias(id_col), "source", "tokens", "copies")

    def expected(d: DataFrame) -> DataFrame:
        """(source, tokens, copies, x): each document for each source that it may be of, x being how much."""
        named = F.transform(F.array(*[F.lit(n) for n in names]), lambda n, i: F.struct(n.alias("source"), F.get("p", i).alias("x"))) if names else None
        own = d.where("p is null").select("source", "tokens", "copies", F.lit(1.0).alias("x"))
        return own if named is None else own.unionByName(d.where("p is not null").select(F.explode(named).alias("s"), "tokens", "copies").select("s.source", "tokens", "copies", "s.x"))

    whole_tokens = lambda c: F.round(F.sum(c)).cast("long")
    taken = expected(drawn).groupBy("source").agg(whole_tokens(F.col("tokens") * F.col("copies") * F.col("x")).alias("taken_tokens"), F.max(F.when(F.col("x") >= 0.5, F.col("copies"))).alias("repeats"))
    there = expected(soft.withColumn("copies", F.lit(1))).groupBy("source").agg(whole_tokens(F.col("tokens") * F.col("x")).alias("available_tokens"))
    goal = targets.where("source is not null and target_share > 0").select("source", "target_share", "max_repeats")
    joined = goal.join(there, "source", "left").join(taken, "source", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("available_tokens", "taken_tokens", "repeats")})
    all_taken = taken.agg(F.sum("taken_tokens").alias("all_tokens"))
    report = joined.crossJoin(all_taken).withColumn("share", F.coalesce(F.col("taken_tokens") / F.col("all_tokens"), F.lit(0.0))).drop("all_tokens")
    lacking = [n for i, n in enumerate(names) if most[i] < share[i] * total * (1 - 1e-9) or not most[i]]
    report = report.withColumn("exhausted", F.col("source").isin(lacking))
    return mixture, report
