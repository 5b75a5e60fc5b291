"""Similarity of strings by their longest common subsequence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import ship


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one machine word row of bits per step."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_ = full  # zero bits count matched places
    for c in b:
        hit = open_ & places.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def indel_ratio_value(a: str | None, b: str | None) -> float | None:
    """100 * 2 * LCS / (length of both); 100 for two empty strings, None with a null."""
    if a is None or b is None:
        return None
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_length(a, b) / total


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([indel_ratio_value(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def indel_ratio(a: Column, b: Column) -> Column:
    """Similarity of 0 to 100 where a replaced character costs a deletion and an insertion."""
    ship()
    return F.pandas_udf(_ratios, "double")(a, b)


def length_close(a: Column, b: Column, share: float = 0.7) -> Column:
    return F.least(F.length(a), F.length(b)) >= F.lit(share) * F.greatest(F.length(a), F.length(b))


def digits_equal(a: Column, b: Column) -> Column:
    """Whether both hold the same numbers: 'Chapter 11' is not 'Chapter 12'."""
    numbers = lambda c: F.regexp_extract_all(c, F.lit("([0-9]+)"), F.lit(1))
    return numbers(a) == numbers(b)


def close_match(a: Column, b: Column, least: float = 90.0) -> Column:
    """Lengths within seven tenths and a ratio of ``least``; the cheap tests come first."""
    return F.when(length_close(a, b), indel_ratio(a, b) >= least).otherwise(F.lit(False))
