"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .._util import ColumnOrName, col


def safe_date(c: ColumnOrName, fmt: str = "yyyyMMdd") -> Column:
    """Parse a date; ``0``, ``00000000``, empty, impossible dates -> NULL (never raises)."""
    return F.try_to_date(col(c).cast("string"), fmt)


def year_month(df: DataFrame, c: str, year_col: str, month_col: str) -> DataFrame:
    """Add year and month of a date column in one projection."""
    return df.withColumns({year_col: F.year(c), month_col: F.month(c)})
