"""Row and column cleaning used by the cleaned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import money, truncated_int

# Bounding box of Brazil in degrees.
BOX = {"lat_min": -33.75116944, "lat_max": 5.27438888, "lng_min": -73.98283055, "lng_max": -34.79314722}


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows that hold a null or NaN in any (listed) column."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def cast_ints(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Truncate to integer those of ``cols`` that exist."""
    return df.withColumns({c: truncated_int(F.col(c)) for c in cols if c in df.columns})


def round_money(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: money(F.col(c)) for c in cols})


def within_box(df: DataFrame, lat: str, lng: str, box: dict[str, float] = BOX) -> DataFrame:
    """Rows inside the box, borders included."""
    return df.where(F.col(lat).between(box["lat_min"], box["lat_max"])
                    & F.col(lng).between(box["lng_min"], box["lng_max"]))


def distinct_present(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct rows of a projection, incomplete rows left out."""
    return df.select(*cols).na.drop().distinct()


def not_null_check(df: DataFrame, col: str) -> DataFrame:
    """One row: total rows, rows where ``col`` is null, and whether the check passed."""
    missing = F.count_if(F.col(col).isNull())
    return df.agg(F.count(F.lit(1)).alias("total_rows"), missing.alias("null_rows"),
                  (missing == 0).alias("passed"))
