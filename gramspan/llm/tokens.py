"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

from pyspark import SparkFiles
from pyspark.sql import SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"  # read where it lies, or where ``ship`` put it
#: Fixed value: the pattern that cuts a text before the merges of such rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def ship(spark: SparkSession, vocabulary: str = VOCABULARY) -> None:
    """Sends the driver's vocabulary file to executors, which need not have it."""
    if os.path.exists(vocabulary):
        spark.sparkContext.addFile(vocabulary)


@lru_cache(2)
def encoding(vocabulary: str):
    import tiktoken

    at = vocabulary if os.path.exists(vocabulary) else SparkFiles.get(os.path.basename(vocabulary))
    with open(at, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(texts: list[str | None], vocabulary: str = VOCABULARY) -> list[int]:
    """Tokens of each whole text; null and empty have none. Lone surrogates count as replacement characters."""
    enc = encoding(vocabulary)
    return [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
