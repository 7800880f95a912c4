"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

DEFAULT = os.environ.get("VELLUMIX_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the published split pattern of the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def encoder(path: str):
    """The tiktoken encoding of a rank file."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(encoding, text: str | None) -> int:
    """Number of tokens; 0 for null. The encoder merges long runs with a queue, so no text is cut beforehand."""
    return len(encoding.encode_ordinary(text)) if text else 0


def sized(df: DataFrame, keys: list[str], text: str = "text", tokenizer: str = DEFAULT) -> DataFrame:
    """(keys, tokens): the size of each row's text. The file must be at the same path on every executor."""
    kinds = dict(df.dtypes)
    held: list = []

    def work(cols: dict) -> dict:
        if not held:
            held.append(encoder(tokenizer))
        return {k: cols[k] for k in keys} | {"tokens": [count_tokens(held[0], t) for t in cols[text].to_pylist()]}

    return map_arrow(df, list(dict.fromkeys([*keys, text])), ", ".join(f"{k} {kinds[k]}" for k in keys) + ", tokens bigint", work, 500)
