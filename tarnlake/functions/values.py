"""Casts, rounding and derived keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    """Two-digit amount as a double."""
    return F.round(c, 2).cast("double")


def truncated_int(c: Column) -> Column:
    """Integer part; a value that does not fit becomes null rather than failing the job."""
    return c.try_cast("int")


def to_ts(c: Column) -> Column:
    """Timestamp from a string, date or timestamp; unparsable text becomes null."""
    return F.try_to_timestamp(c.cast("string"))


def md5_key(*cols: Column, sep: str = "|") -> Column:
    """Hex MD5 over the concatenated columns; null when any part is null.

    The separator keeps ('1', '12') and ('11', '2') apart.  ``sep=""`` gives the
    plain concatenation that a source-side ``MD5(CONCAT(a, b))`` produces.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(c.cast("string"))
    return F.md5(F.concat(*parts))
