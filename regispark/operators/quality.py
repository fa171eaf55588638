"""Data-quality checks (D1-D4). Each returns the violating rows (empty = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .._util import quote
from .profile import duplicate_audit, freq


def check_unique(df: DataFrame, c: str) -> DataFrame:
    """Keys that occur more than once (NULL keys are not violations)."""
    return df.filter(F.col(quote(c)).isNotNull()).groupBy(quote(c)).agg(F.count(F.lit(1)).alias("count")) \
        .filter(F.col("count") > 1)


def check_not_null(df: DataFrame, c: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.filter(F.col(quote(c)).isNull())


def domain_audit(df: DataFrame, expr, name: str = "value", top: int | None = None) -> DataFrame:
    """Frequency of a derived domain value (e.g. ``length(tel)``)."""
    return freq(df.select(expr.alias(name)), name, top)


__all__ = ["check_unique", "check_not_null", "duplicate_audit", "domain_audit"]
