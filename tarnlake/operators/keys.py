"""Helpers for single and composite keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def all_set(cols: Sequence[str]) -> Column:
    """True when no listed column is null."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in cols))


def others(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(cols)]
