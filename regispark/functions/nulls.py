"""NULL handling helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .._util import ColumnOrName, col, quote


def fallback(a: ColumnOrName, b: ColumnOrName, dtype: str | None = None) -> Column:
    """``a`` unless NULL, else ``b``; with ``dtype`` both sides are first aligned by
    ``try_cast`` (a float column falling back to a decimal-comma string, for example),
    so no implicit cast can raise under ANSI mode."""
    a, b = col(a), col(b)
    if dtype:
        a, b = a.try_cast(dtype), b.try_cast(dtype)
    return F.coalesce(a, b)


def fill_constants(df: DataFrame, mapping: dict, strict: bool = False) -> DataFrame:
    """Per-column constant for NULLs (``fillna`` semantics: a constant whose type does
    not fit the column is skipped); ``strict=True`` raises on such a mismatch instead."""
    types = {f.name: f.dataType for f in df.schema.fields}
    usable = {}
    for c, v in mapping.items():
        if c not in types:
            continue
        t = types[c]
        fits = (isinstance(v, str) and isinstance(t, T.StringType)) or \
               (isinstance(v, bool) and isinstance(t, T.BooleanType)) or \
               (isinstance(v, (int, float)) and not isinstance(v, bool) and isinstance(t, T.NumericType))
        if fits:
            usable[c] = v
        elif strict:
            raise TypeError(f"constant {v!r} does not fit column {c!r} of type {t.simpleString()}")
    return df.fillna(usable) if usable else df


def override_when(df: DataFrame, cond: Column, c: str, value) -> DataFrame:
    """Set ``c`` to ``value`` (a literal or Column) where ``cond`` is true; a NULL
    condition keeps the current value."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(c, F.when(cond.eqNullSafe(True), v).otherwise(F.col(quote(c))))
