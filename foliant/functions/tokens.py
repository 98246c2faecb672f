"""Texts in tokens of a public tokenizer. The vocabulary's path is a parameter; it must lie where all executors can read it."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how byte-level BPE vocabularies of this kind cut texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Long texts are encoded in parts of about this length.
PART = 20_000
#: Where a text may be cut without a change of its tokens: the pattern above never goes on over a single blank between two other
#: characters, nor from a letter to the full stop or comma behind it.
SEAM = re.compile(r"(?<=\S)(?= \S)|(?<=[^\W\d_])(?=[.,。，、！？])")


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART):
    """The text in parts of at least ``size`` characters, cut at seams only: their tokens are those of the whole."""
    at = 0
    while at < len(text):
        seam = SEAM.search(text, at + size) if len(text) - at > size else None
        end = seam.start() if seam else len(text)
        yield text[at:end]
        at = end


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    own = encoding(path)
    return sum(len(own.encode_ordinary(p)) for p in parts(text or ""))


def cut_at_tokens(text: str | None, most: int, path: str = VOCABULARY) -> str | None:
    """The text up to its first ``most`` tokens; a character cut in its bytes is left out."""
    if text is None:
        return None
    own, kept = encoding(path), []
    for part in parts(text):
        kept += own.encode_ordinary(part)
        if len(kept) > most:
            return own.decode_bytes(kept[:most]).decode("utf-8", "ignore")
    return text


def n_tokens(text: Column, path: str = VOCABULARY) -> Column:
    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: count_tokens(t, path)).astype("int64")

    return count(text)


def first_tokens(text: Column, most: int, path: str = VOCABULARY) -> Column:
    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: cut_at_tokens(t, most, path))

    return cut(text)
