"""Evaluation texts leaking into training text (problem 4).

Wu-Manber multi-pattern search over normalised text. The patterns are the runs of ``gram`` consecutive words of every test
item (``short_gram`` for items that count only when whole). A shift table over blocks of three bytes skips impossible
positions, a table of the blocks that patterns begin with and one of window hashes select the patterns of a position, and
comparing bytes confirms an occurrence. The scan runs many lanes of a batch at once in numpy. Items with enough occurrences,
of which some run as long as a passage stands densely enough in the text, and enough words in order (a longest common
subsequence by bits), are then aligned word by word with it, so that changed or added single words don't hide a passage. All
bounds lie under what an accepted passage has.

The corpus is read once and never shuffled; only (id, item) rows are. The test items are a stated query set: they are
collected and sent to the workers in blocks of ``block_items``, so a larger set means more passes and not more memory.

Nulls: null ids, texts and questions are left out; an item without words matches nothing. Repeated rows and ties: each
(id, item) comes once with its largest share. Empty corpus or empty items: an empty result.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textvec

BLOCK = 3
LANES = 2048
_TABLE = 1 << 16
_WORD = re.compile(r"[^\W_]+")
# Letters of other scripts that look like Latin ones.
_LOOKALIKE = str.maketrans("абвгеёікморсстухѕјһԁԛԝαβεικνορτυχ", "abbreeikmopcctyxsjhdqwabeikvoptux")
_TAGS = re.compile(r"</?[a-zA-Z][^<>\n]{0,40}>|&(?:nbsp|amp|quot|lt|gt|#\d+);")


class _Folds(dict):
    """By code point of a decomposed text what stands for it: nothing for marks, else its caseless form in look-alike letters."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "" if unicodedata.category(c) in ("Mn", "Cf", "Me") else c.casefold().translate(_LOOKALIKE)
        return out


_FOLDS = _Folds()


def normal_words(text: str) -> list[str]:
    """The words of a text whatever its letter case, punctuation, blanks, markup or character forms."""
    if "<" in text or "&" in text:
        text = _TAGS.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(_FOLDS)
    return _WORD.findall(text.lower())


class Searcher:
    """The tables of a set of patterns: byte strings, each with any number of owners."""

    def __init__(self, patterns: dict[bytes, list[tuple[int, int]]]):
        self.patterns = list(patterns)
        self.owners = [patterns[p] for p in self.patterns]
        self.m = min((len(p) for p in self.patterns), default=0)
        self.shift = np.full(_TABLE, max(1, self.m - BLOCK + 1), np.int32)
        bucket: dict[int, list[int]] = defaultdict(list)
        a = np.frombuffer(b"".join(p[: self.m] for p in self.patterns), np.uint8)
        first, blocks = np.arange(len(self.patterns)) * self.m, self._blocks(a)
        for j in range(BLOCK - 1, self.m):
            np.minimum.at(self.shift, blocks[first + j - (BLOCK - 1)], self.m - 1 - j)
        self.begins = np.zeros(_TABLE, bool)
        self.begins[blocks[first]] = True
        for i, h in enumerate(self._window(a, first).tolist()):
            bucket[h].append(i)
        self.keys = np.array(sorted(bucket), np.uint64)
        self.bucket = [bucket[int(k)] for k in self.keys]

    @staticmethod
    def _blocks(a: np.ndarray) -> np.ndarray:
        """Of every block of the text its place in the tables, whose size is that of the numbers of 16 bits."""
        a = a.astype(np.uint16)
        return a[2:] * 31 + a[1:-1] * 2039 + a[:-2] * 7919

    def _window(self, a: np.ndarray, start: np.ndarray) -> np.ndarray:
        h = np.zeros(len(start), np.uint64)
        for j in range(self.m):
            h = h * np.uint64(0x100000001B3) + a[start + j]
        return h

    def candidates(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(positions, buckets) at which the window of some pattern stands."""
        none = np.zeros(0, np.int64)
        a = np.frombuffer(text, np.uint8)
        last = len(a) - self.m
        if not self.patterns or last < 0:
            return none, none
        width = max(64, -(-(last + 1) // LANES))
        at = np.arange(0, last + 1, width)
        until = np.minimum(at + width, last + 1)
        hits = []
        blocks = self._blocks(a)
        last_block = blocks[self.m - BLOCK :]
        while len(at):
            s = self.shift[last_block[at]]
            stop = s == 0
            if stop.any():
                hits.append(at[stop])
            at = at + np.maximum(s, 1)
            live = at < until
            if not live.all():
                at, until = at[live], until[live]
        if not hits:
            return none, none
        start = np.concatenate(hits)
        start = start[self.begins[blocks[start]]]
        if not len(start):
            return none, none
        h = self._window(a, start)
        k = np.searchsorted(self.keys, h)
        k[k == len(self.keys)] = 0
        ok = self.keys[k] == h
        return start[ok], k[ok]

    def find(self, text: bytes) -> list[tuple[int, int]]:
        """(position, pattern) of every occurrence."""
        start, bucket = self.candidates(text)
        return [(pos, i) for pos, b in zip(start.tolist(), bucket.tolist(), strict=True) for i in self.bucket[b] if text.startswith(self.patterns[i], pos)]


#: Patterns of fewer bytes have a search of their own, since the shortest pattern bounds the shifts of all.
TINY = 6


class Search:
    """Searchers of the tiny and of the other patterns as one. Patterns are runs of words between blanks, each with owners."""

    def __init__(self, patterns: dict[bytes, list[tuple[int, int]]]):
        parts = [{p: o for p, o in patterns.items() if (len(p) < TINY) == tiny} for tiny in (False, True)]
        self.searchers = [Searcher(x) for x in parts if x]
        self.number = {p: i for i, p in enumerate(patterns)}
        self.sizes = sorted({p.count(b" ") - 1 for p in patterns})
        owners = list(patterns.values())
        self.first = np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64)
        self.item = np.array([i for o in owners for i, _ in o], np.int64)
        self.place = np.array([k for o in owners for _, k in o], np.int64)

    def find(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(position, pattern) of every occurrence. The runs of words at a candidate are compared by looking them up, so a
        window that many patterns begin with costs no more than any other."""
        blank = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        none, pos, pattern = np.zeros(0, np.int64), [], []
        for s in self.searchers:
            start, _ = s.candidates(text)
            at = np.searchsorted(blank, start)
            ok = at < len(blank)
            start, at = start[ok], at[ok]
            for n in self.sizes:
                end = blank[np.minimum(at + n, len(blank) - 1)] + 1
                i = np.array([self.number.get(text[x:y], -1) for x, y in zip(start.tolist(), end.tolist(), strict=True)], np.int64)
                pos.append(start[i >= 0])
                pattern.append(i[i >= 0])
        found = np.unique(np.concatenate([*pos, none]) * max(1, len(self.number)) + np.concatenate([*pattern, none]))
        return found // max(1, len(self.number)), found % max(1, len(self.number))


_built: dict[str, Search] = {}


def _search_of(token: str, items: list[list[str]], gram: int, short_gram: int, whole_words: int) -> Search:
    """The tables of a block of items, built once in a worker's life."""
    if token not in _built:
        _built.clear()
        _built[token] = Search(_patterns(items, gram, short_gram, whole_words))
    return _built[token]


def passage(item: Sequence[str], text: Sequence[str]) -> tuple[int, int]:
    """(words of the item spanned, words of it matched) by the best connected passage: a local alignment of words in which
    a match counts 1 and a changed, added or left out word -1."""
    n, best = len(text), (0, 0, 0)
    score, first, match = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i, w in enumerate(item):
        s2, f2, m2 = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            if text[j - 1] == w:
                s = score[j - 1] + 1
                f, m = (first[j - 1], match[j - 1] + 1) if score[j - 1] > 0 else (i, 1)
            else:
                s, f, m = score[j - 1] - 1, first[j - 1], match[j - 1]
                if score[j] - 1 > s:
                    s, f, m = score[j] - 1, first[j], match[j]
                if s2[j - 1] - 1 > s:
                    s, f, m = s2[j - 1] - 1, f2[j - 1], m2[j - 1]
            if s > 0:
                s2[j], f2[j], m2[j] = s, f, m
                if s > best[0]:
                    best = (s, i - f + 1, m)
        score, first, match = s2, f2, m2
    return best[1], best[2]


def leaks(n: int, span: int, matched: int, whole_words: int) -> bool:
    """Whether a passage of ``span`` of an item's n words, ``matched`` of them equal, makes a case."""
    if n <= whole_words:
        return span >= n - 1 and matched >= n - 1 and n >= 4 or span == matched == n
    return 2 * span >= n and matched >= 0.75 * span


def least_runs(n: int, gram: int) -> int:
    """Of an item of n words, half of the least number of runs of ``gram`` words that a passage keeps where every fourth word
    of it, the most that leaks() accepts, is changed; the other half is room for added words."""
    return max(1, min(s - s // 4 - (gram - 1) * (s // 4 + 1) for s in range(-(-n // 2), n + 1)) // 2)


def word_places(item: Sequence[str]) -> dict[str, int]:
    """Of every word of an item its places as bits."""
    at: dict[str, int] = defaultdict(int)
    for i, w in enumerate(item):
        at[w] |= 1 << i
    return dict(at)


def common_words(n: int, places: dict[str, int], text: Sequence[str]) -> int:
    """The length of the longest common subsequence with an item of n words, which no passage's matched words exceed."""
    full = (1 << n) - 1
    v = full
    for w in text:
        if (p := places.get(w)) is not None:
            u = v & p
            v = (v + u | v - u) & full
    return n - v.bit_count()


#: Bytes of the table of word places by which many pairs' common subsequences are found at once.
TABLE_BYTES = 1 << 26
#: Words of items looked up at once for many pairs, unless a single item has more.
PAIR_WORDS = 1 << 18


class Vocabulary:
    """The words of a set of items: how many of an item's words a text can match at most, for many pairs at once."""

    def __init__(self, items: Sequence[Sequence[str]]):
        self.number = {w: i for i, w in enumerate(sorted({w for x in items for w in x}))}
        counts = [Counter(self.number[w] for w in x) for x in items]
        self.first = np.concatenate(([0], np.cumsum([len(c) for c in counts]))).astype(np.int64)
        self.word = np.array([w for c in counts for w in c], np.int64)
        self.count = np.array([n for c in counts for n in c.values()], np.int64)
        self.places = [word_places(x) for x in items]
        self.size = np.array([len(x) for x in items], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size))).astype(np.int64)
        self.running = np.array([self.number[w] for x in items for w in x], np.int64)

    def there(self, texts: Sequence[Sequence[str]], text: np.ndarray) -> np.ndarray:
        """Of the texts that are in ``text`` which of the items' words occur in each."""
        there = np.zeros((len(texts), len(self.number) + 1), bool)
        for d in np.unique(text).tolist():
            there[d, [self.number.get(w, -1) for w in texts[d]]] = True
        there[:, -1] = False
        return there

    def most(self, texts: Sequence[Sequence[str]], text: np.ndarray, item: np.ndarray, there: np.ndarray | None = None) -> np.ndarray:
        """Of each pair (text, item) how many of the item's words occur in the text, wherever they stand."""
        if there is None:
            there = self.there(texts, text)
        out = np.zeros(len(text), np.int64)
        for lo in range(0, len(text), 50_000):
            i = item[lo : lo + 50_000]
            n = self.first[i + 1] - self.first[i]
            begin = np.cumsum(n) - n
            at = np.arange(int(n.sum())) - np.repeat(begin, n) + np.repeat(self.first[i], n)
            seen = self.count[at] * there[np.repeat(text[lo : lo + 50_000], n), self.word[at]]
            out[lo : lo + len(i)] = np.add.reduceat(seen, begin) if len(i) else 0
        return out

    def dense(self, there: np.ndarray, text: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Of each pair (text, item) whether three quarters of the words of some run of at least half of the item occur in the
        text, wherever they stand. The words that a passage spans are such a run in all that leaks() accepts."""
        out = np.zeros(len(text), bool)
        longest = int(self.size.max(initial=0))
        at_once = max(1, PAIR_WORDS // (longest + 1))
        for lo in range(0, len(text), at_once):
            i, d = item[lo : lo + at_once], text[lo : lo + at_once]
            n, half = self.size[i], -(-self.size[i] // 2)
            begin = np.cumsum(n + 1) - (n + 1)
            pair = np.repeat(np.arange(len(i)), n + 1)
            place = np.arange(len(pair)) - begin[pair]
            step = np.where(there[d[pair], self.running[self.start[i][pair] + place - 1]], 1, -3)
            # Each pair starts below all levels before it, so that the least level so far is its own.
            step[begin] = -(2 * longest + 1)
            level = np.cumsum(step)
            least = np.minimum.accumulate(level)
            end = np.flatnonzero(place >= half[pair])
            end = end[level[end] >= least[end - half[pair[end]]]]
            out[lo + pair[end]] = True
        return out

    def common(self, texts: Sequence[Sequence[str]], text: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """common_words() of each item with the words lo to hi of the text, for many pairs in step."""
        out = np.zeros(len(text), np.int64)
        long = self.size[item] > 62
        for i in np.flatnonzero(long).tolist():
            out[i] = common_words(int(self.size[item[i]]), self.places[item[i]], texts[text[i]][lo[i] : hi[i]])
        ids = {d: np.array([self.number.get(w, len(self.number)) for w in texts[d]], np.int64) for d in np.unique(text).tolist()}
        at_once = max(1, TABLE_BYTES // 8 // (len(self.number) + 1))
        short = np.flatnonzero(~long)
        for block in np.unique(item[short] // at_once).tolist():
            rows = short[item[short] // at_once == block]
            table = np.zeros((at_once, len(self.number) + 1), np.uint64)
            for i in np.unique(item[rows]).tolist():
                for w, p in self.places[i].items():
                    table[i - block * at_once, self.number[w]] = p
            end = np.minimum(hi[rows], np.array([len(ids[d]) for d in text[rows].tolist()], np.int64))
            n = np.maximum(end - lo[rows], 0)
            order = np.argsort(-n, kind="stable")
            rows, n = rows[order], n[order]
            flat = np.concatenate([ids[d][x : x + m] for d, x, m in zip(text[rows].tolist(), lo[rows].tolist(), n.tolist(), strict=True)]) if len(rows) else np.zeros(0, np.int64)
            first, mine = np.cumsum(n) - n, item[rows] - block * at_once
            full = (np.uint64(1) << self.size[item[rows]].astype(np.uint64)) - np.uint64(1)
            v = full.copy()
            for t in range(int(n[0]) if len(n) else 0):
                k = int(np.searchsorted(-n, -t, side="left"))
                u = v[:k] & table[mine[:k], flat[first[:k] + t]]
                v[:k] = (v[:k] + u | v[:k] - u) & full[:k]
            out[rows] = self.size[item[rows]] - np.bitwise_count(v).astype(np.int64)
        return out


def _patterns(items: Sequence[Sequence[str]], gram: int, short_gram: int, whole_words: int) -> dict[bytes, list[tuple[int, int]]]:
    out: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for i, w in enumerate(items):
        g = min(short_gram if len(w) <= whole_words else gram, len(w))
        for k in range(len(w) - g + 1 if g else 0):
            out[(" " + " ".join(w[k : k + g]) + " ").encode()].append((i, k))
    return out


def _search(items: list[list[str]], ids: list, gram: int, short_gram: int, whole_words: int):
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searcher = _search_of(token, items, gram, short_gram, whole_words)
        size = [short_gram if len(w) <= whole_words else gram for w in items]
        least = np.array([least_runs(len(w), gram) if len(w) > whole_words else 0 for w in items], np.int64)
        vocabulary = Vocabulary(items)
        lengths = vocabulary.size
        for b in batches:
            texts, keys = b["text"].tolist(), b["id"].tolist()
            rows = []
            for lo, hi in textvec.chunks(texts):
                words = [normal_words(t) for t in texts[lo:hi]]
                parts = [(" " + " ".join(w) + " ").encode() for w in words]
                offsets = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
                joined = b"\n".join([*parts, b""])
                pos, pattern = searcher.find(joined)
                if not len(pos):
                    continue
                doc = np.searchsorted(offsets, pos, side="right") - 1
                blanks = np.concatenate(([0], np.cumsum(np.frombuffer(joined, np.uint8) == 32)))
                word = blanks[pos] - blanks[offsets[doc]]
                # Every occurrence with every owner of its pattern, grouped by (text, item).
                many = searcher.first[pattern + 1] - searcher.first[pattern]
                hit = np.repeat(np.arange(len(pos)), many)
                own = np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many) + searcher.first[pattern[hit]]
                pair, k, shift = doc[hit] * len(items) + searcher.item[own], searcher.place[own], word[hit] - searcher.place[own]
                order = np.lexsort((k, pair))
                pair, k, shift = pair[order], k[order], shift[order]
                begin = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
                fresh = np.concatenate(([True], (pair[1:] != pair[:-1]) | (k[1:] != k[:-1])))
                runs = np.add.reduceat(fresh.astype(np.int64), begin)
                low, high = np.minimum.reduceat(shift, begin), np.maximum.reduceat(shift, begin)
                d_of, item_of = pair[begin] // len(items), pair[begin] % len(items)
                good = np.flatnonzero(runs >= least[item_of])
                # No more words can match than stand anywhere in the text, in the whole item and in what a passage spans of it.
                there = vocabulary.there(words, d_of[good])
                good = good[vocabulary.most(words, d_of[good], item_of[good], there) >= 0.375 * lengths[item_of[good]]]
                good = good[vocabulary.dense(there, d_of[good], item_of[good])]
                from_, to = np.maximum(low[good] - 8, 0), high[good] + lengths[item_of[good]] + 8
                enough = vocabulary.common(words, d_of[good], item_of[good], from_, to) >= 0.375 * lengths[item_of[good]]
                keep = enough | (lengths[item_of[good]] <= whole_words)
                ends = np.append(begin[1:], len(pair))
                for g, x, y in zip(good[keep].tolist(), from_[keep].tolist(), to[keep].tolist(), strict=True):
                    d, item = int(d_of[g]), int(item_of[g])
                    n = len(items[item])
                    if n <= whole_words and len({a + b for a in k[begin[g] : ends[g]].tolist() for b in range(size[item])}) < 0.5 * n:
                        continue
                    part = words[d][x:y]
                    # A best passage begins and ends with words of the item.
                    mine = [i for i, w in enumerate(part) if w in vocabulary.places[item]]
                    part = part[mine[0] : mine[-1] + 1]
                    span, matched = passage(items[item], part)
                    if leaks(n, span, matched, whole_words):
                        rows.append((keys[lo + d], ids[item], matched / n))
            yield pd.DataFrame(rows, columns=["id", "item", "share"]).astype({"share": "float64"})

    return run


def leaked(corpus: DataFrame, id_col: str, text_col: str, items: DataFrame, item_id: str, item_text: str, *, gram: int = 3, short_gram: int = 3, whole_words: int = 12, block_items: int = 5000) -> DataFrame:
    """(id, item, share): the texts that contain an item, or a connected passage of at least half of its words; items of up
    to ``whole_words`` words count only when whole. share: the matched words by the item's words."""
    texts = corpus.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, item {items.schema[item_id].dataType.simpleString()}, share double"
    wanted = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).distinct()
    passes, block = [], []

    def add() -> None:
        words = [normal_words(t) for _, t in block]
        passes.append(texts.mapInPandas(_search(words, [i for i, _ in block], gram, short_gram, whole_words), schema))

    for r in wanted.toLocalIterator():
        block.append((r["item"], r["text"]))
        if len(block) == block_items:
            add()
            block = []
    if block or not passes:
        add()
    found = reduce(DataFrame.unionAll, passes)
    return found.groupBy("id", "item").agg(F.max("share").alias("share")).withColumnsRenamed({"id": id_col, "item": item_id})
