"""Text helpers: digits, tokens, accents, street types, addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .._util import ColumnOrName, col
from ..fixed_values import (ACCENTED, COMPAT_ACCENT_CLASSES, FOLDED, STREET_TYPE_EXACT, STREET_TYPE_GARBLED,
                            STREET_TYPE_PATTERNS)
from .decode import STREET_TYPES, whitelist


def digits(c: ColumnOrName) -> Column:
    """Keep digits only; an empty result is NULL."""
    return F.nullif(F.regexp_replace(col(c), "[^0-9]", ""), F.lit(""))


def first_token(c: ColumnOrName, sep: str = " ") -> Column:
    """Text before the first separator (the whole text when there is none)."""
    return F.substring_index(col(c), sep, 1)


def explode_alternatives(df: DataFrame, c: str, out: str, fallback_col: str | None = None,
                         sep: str = r"\|") -> DataFrame:
    """One row per ``sep``-separated alternative.

    With ``fallback_col`` a NULL list falls back to that column (row kept); without it the
    row disappears, as ``explode`` drops NULL arrays.
    """
    source = F.coalesce(F.col(c), F.col(fallback_col)) if fallback_col else F.col(c)
    return df.withColumn(out, F.explode(F.split(source, sep)))


def fold_accents(c: ColumnOrName, compat: bool = False) -> Column:
    """Upper-case and fold accents to ASCII.

    ``compat=True`` replays the original six-step clean-up in which lower-case accented
    letters are upper-cased only after their class ran (``São`` -> ``SÃO``).
    """
    c = col(c)
    if not compat:
        return F.translate(F.upper(c), ACCENTED, FOLDED)
    for pattern, repl in COMPAT_ACCENT_CLASSES:
        c = F.upper(F.regexp_replace(c, pattern, repl))
    return F.upper(c)


def street_type(c: ColumnOrName, whitelist_values=STREET_TYPES, other: str = "OUTROS") -> Column:
    """X12 then X11: normalise the street-type label (ordered rules in ``fixed_values``) and
    keep only known types."""
    c = col(c)
    normalised = None
    for pattern, label in STREET_TYPE_PATTERNS:
        normalised = F.when(c.rlike(pattern), label) if normalised is None else normalised.when(c.rlike(pattern), label)
    for text, label in STREET_TYPE_EXACT:
        normalised = normalised.when(c == text, label)
    garbled, fixed = STREET_TYPE_GARBLED
    normalised = normalised.otherwise(F.regexp_replace(c, garbled, fixed))
    if whitelist_values is None:
        return normalised
    return whitelist(normalised, whitelist_values, other)


def address_ws(street_type_: ColumnOrName, street: ColumnOrName, number: ColumnOrName,
               city: ColumnOrName, state: ColumnOrName) -> Column:
    """``type street, number, city - state``; NULL parts are skipped (concat_ws),
    but a NULL type or street drops the whole street part (inner concat)."""
    return F.concat_ws(", ", F.concat(col(street_type_), F.lit(" "), col(street)), col(number).cast("string"),
                       F.concat_ws(" - ", col(city), col(state)))


def address_concat(street_type_: ColumnOrName, street: ColumnOrName, number: ColumnOrName,
                   city: ColumnOrName, state: ColumnOrName) -> Column:
    """SQL-model address; any NULL part makes the whole address NULL."""
    return F.concat(col(street_type_), F.lit(" "), col(street), F.lit(", "), col(number).cast("string"),
                    F.lit(" - "), col(city), F.lit(", "), col(state))


def prefix(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(col(c), 1, n)


def strip_decimal(c: ColumnOrName) -> Column:
    """Drop a trailing ``.0`` left by a float round trip."""
    return F.regexp_replace(col(c), r"\.0$", "")
