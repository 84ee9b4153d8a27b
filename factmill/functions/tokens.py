"""Token columns by a vocabulary file, in Arrow batches; without a file the estimate of text.token_length holds."""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the pattern that splits text before the merges of rank files.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict = {}


def _encoding(path: str):
    """(encode, decode) of a tokenizers file (.json) or a tiktoken file, loaded once for each worker."""
    if path not in _loaded:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            _loaded[path] = (lambda s: t.encode(s, add_special_tokens=False).ids), (lambda ids: t.decode(ids, skip_special_tokens=False))
        else:
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            t = tiktoken.Encoding(path, pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
            _loaded[path] = t.encode_ordinary, t.decode
    return _loaded[path]


def encode(text: Column, path: str) -> Column:
    """The token ids of a text; null for null."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        e, _ = _encoding(path)
        return pd.Series([None if t is None else list(e(t)) for t in texts], dtype=object)

    return run(text)


def decode(ids: Column, path: str) -> Column:
    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        _, d = _encoding(path)
        return pd.Series([None if i is None else d([int(x) for x in i]) for i in lists], dtype=object)

    return run(ids)


def length(text: Column, path: str) -> Column:
    """How many tokens a text has; 0 for an empty text or none."""
    return F.coalesce(F.size(encode(text, path)), F.lit(0))
