"""Similarity of two strings as the share of characters in matching blocks, in Arrow batches."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(left: Column, right: Column, autojunk: bool = True) -> Column:
    """Null where either side is null. Filter first: this is the one Python function among the text columns."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y, autojunk=autojunk).ratio() for x, y in zip(a, b)], dtype="float64")

    return run(left, right)
