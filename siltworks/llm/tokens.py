"""Token counts of texts by a public tokenizer's vocabulary file."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the vocabulary lies on every machine; a parameter wherever it is used.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern by which the public byte-level tokenizers cut texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: list[str], path: str = VOCABULARY) -> list[int]:
    e = _encoding(path)
    return [len(e.encode_ordinary(t)) for t in texts]


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of a text; null texts count 0."""

    @F.pandas_udf("int")
    def count(s: pd.Series) -> pd.Series:
        return pd.Series(count_tokens(s.tolist(), path), dtype="int32")

    return count(F.coalesce(text, F.lit("")))
