"""Sizes in tokens of a public byte-level BPE. The vocabulary file is a parameter and must exist on every executor."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A multilingual vocabulary, as the texts are in seven languages.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# Fixed value: the published splitting pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(path: str = VOCABULARY):
    """The encoder of the vocabulary file at path; one a Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of the whole text; 0 for null."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(path).encode_ordinary
        for texts in batches:
            yield texts.map(lambda x: len(encode(x)) if x else 0).astype("int64")

    return count(text)


def sized(docs: DataFrame, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text", *keep: str) -> DataFrame:
    """id_col, the columns keep, n_tokens. Texts are read here and go no further."""
    return docs.select(id_col, *keep, token_count(F.col(text_col), path).alias("n_tokens"))
