"""E-mail and phone helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .._util import ColumnOrName, col
from .decode import literal_map
from .rewrite import rewrite_all

from ..fixed_values import EMAIL_PATTERN, HOME_AREA, LANDLINE, MOBILE, PROVIDER_PATTERN, SPECIAL  # noqa: F401


def email_provider(c: ColumnOrName, mode: str = "regex") -> Column:
    """Provider token of an e-mail, upper-cased.

    ``regex`` (X6): text between the first ``@`` and the next ``.``; no match -> ``''``.
    ``split`` (X7, SQL model): second ``@`` field up to its first ``.``; no ``@`` -> NULL
    and ``a@b`` -> ``B``. NULL input -> NULL in both modes.
    """
    c = col(c)
    if mode == "regex":
        return F.upper(F.regexp_extract(c, PROVIDER_PATTERN, 0))
    if mode == "split":
        return F.get(F.split(F.get(F.split(F.upper(c), "@"), 1), r"\."), 0)
    raise ValueError(f"unknown mode {mode!r}")


def email_valid(c: ColumnOrName) -> Column:
    """Lower-cased address when it has the shape ``x@y.z`` (no blanks), else ``''``."""
    return F.regexp_extract(F.lower(col(c)), EMAIL_PATTERN, 0)


def rewrite_words(c: ColumnOrName, mapping: dict, mode: str = "domain_only") -> Column:
    """Rewrite dictionary words inside an e-mail/free text.

    ``compat``: every key is applied in dictionary order, as a literal whole word, on the
    lower-cased keys/values, each step seeing the previous step's output; a word ends where no
    ASCII letter, digit or underscore follows. One pass over the words
    (:mod:`regispark.functions.rewrite`), however long the dictionary is.
    ``domain_only``: only the provider token (between ``@`` and the next ``.``) is looked up
    once and replaced; local part and top-level domain are left alone.
    """
    c = col(c)
    if mode == "compat":
        return rewrite_all(c, mapping)
    if mode == "domain_only":
        if not mapping:
            return c
        upper = {k.upper(): str(v).lower() for k, v in mapping.items()}
        lowered = literal_map(upper)
        shape = r"^([^@]*@)([^.@]+)(\..*)$"
        token = F.regexp_extract(c, shape, 2)
        rebuilt = F.concat(F.regexp_extract(c, shape, 1),
                           F.when(F.upper(token).isin(list(upper)), lowered[F.upper(token)]).otherwise(token),
                           F.regexp_extract(c, shape, 3))
        return F.when(c.rlike(shape), rebuilt).otherwise(c)
    raise ValueError(f"unknown mode {mode!r}")


def phone_class(ddd: ColumnOrName, tel: ColumnOrName) -> Column:
    """First-digit rules, evaluated in order.

    outside the home area a first digit 2-5 is a landline; 6-9 is a mobile anywhere;
    inside the home area 2-4 is a landline; everything else needs the range table.
    """
    ddd, first = col(ddd), F.substring(col(tel), 1, 1)
    return (
        F.when((ddd != HOME_AREA) & first.isin("2", "3", "4", "5"), LANDLINE)
        .when(first.isin("6", "7", "8", "9"), MOBILE)
        .when((ddd == HOME_AREA) & first.isin("2", "3", "4"), LANDLINE)
        .otherwise(SPECIAL)
    )


def phone_class_final(cls: ColumnOrName, matched: ColumnOrName) -> Column:
    """Special cases become mobile when the range table matched, else landline."""
    cls, matched = col(cls), col(matched)
    return (
        F.when((cls == SPECIAL) & matched.isNull(), LANDLINE)
        .when((cls == SPECIAL) & matched.isNotNull(), MOBILE)
        .otherwise(cls)
    )


def mobile_prefix5(cls: ColumnOrName, prefix4: ColumnOrName) -> Column:
    """``9`` + the 4-digit prefix for mobiles; the landline label otherwise."""
    return F.when(col(cls) == MOBILE, F.concat(F.lit("9"), col(prefix4))).otherwise(F.lit(LANDLINE))
