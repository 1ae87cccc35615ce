"""Tokens of a public byte-level tokenizer, given by its rank file."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A rank file (base64 token, rank) that every executor can read; a parameter of every operator here.
DEFAULT_RANKS = os.environ.get("LEDGERLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")

# Fixed value: how the tokenizer cuts text into words before it merges bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(ranks_path: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: Column, ranks_path: str = DEFAULT_RANKS) -> Column:
    """Number of tokens of a text, null for null; markers of special tokens are ordinary text."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(ranks_path).encode_ordinary
        for batch in batches:
            yield pd.Series([None if t is None else len(encode(t)) for t in batch], dtype="Int32")

    return count(text)
