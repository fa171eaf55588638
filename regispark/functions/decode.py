"""Code -> label decoding and value dictionaries.

Codes arrive as strings or ints; a code table keyed by ints compares numerically
(``'01'`` == 1) through ``try_cast`` so that a malformed code becomes NULL instead of
raising under ANSI mode. Unmapped codes decode to NULL unless a default is given.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from .._util import ColumnOrName, col, fresh

from ..fixed_values import (AGE_BAND, BRANCH_TYPE, COMPANY_SIZE, COMPANY_SIZE_COMPAT, MODEL_PROVIDERS,  # noqa: F401
                            PARTNER_TYPE, REGISTRATION_STATUS, STATE_NAME_TO_CODE, STREET_TYPES)

# Dictionaries up to this size are inlined as a literal map; larger ones become a
# broadcast lookup table (their size is bounded by the driver-side dict itself).
INLINE_MAP_MAX = 64


def literal_map(mapping: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))


def _key(c: Column, mapping: dict) -> Column:
    keys = list(mapping)
    if keys and all(isinstance(k, int) and not isinstance(k, bool) for k in keys):
        return c.try_cast("int")
    return c.cast("string")


def decode(c: ColumnOrName, mapping: dict, default: str | None = None) -> Column:
    """``mapping[c]``; unmapped or NULL -> ``default`` (NULL when not given)."""
    looked = literal_map(mapping)[_key(col(c), mapping)]
    return looked if default is None else F.coalesce(looked, F.lit(default))


def whitelist(c: ColumnOrName, values, other: str = "OUTROS") -> Column:
    """X11: keep values in the list, everything else (NULL included) -> ``other``."""
    c = col(c)
    return F.when(c.isin(list(values)), c).otherwise(F.lit(other))


def replace_values(df: DataFrame, c: str, mapping: dict) -> DataFrame:
    """Single-pass exact-match replacement on one column (NULL untouched).

    Equivalent to ``df.replace(mapping, subset=[c])``: every value is looked up once in the
    original dictionary, so chains (A->B, B->C) are not followed. Large dictionaries are
    joined as a broadcast table instead of a long CASE chain. An empty one changes nothing. A
    DataFrame (first column key, second value, keys unique) is joined after a size check.
    """
    if isinstance(mapping, DataFrame):
        from ..operators.joins import lookup

        k, v = fresh(df.columns, "__rv_key"), fresh(df.columns, "__rv_val")
        out = lookup(df.withColumn(k, F.col(c)), mapping.toDF(k, v), k)
        return out.withColumn(c, F.coalesce(F.col(v), F.col(c))).drop(v)
    if not mapping:
        return df
    if len(mapping) <= INLINE_MAP_MAX:
        return df.withColumn(c, F.coalesce(literal_map(mapping)[F.col(c)], F.col(c)))
    spark = df.sparkSession
    k, v = fresh(df.columns, "__rv_key"), fresh(df.columns, "__rv_val")
    kind = df.schema[c].dataType.simpleString()
    table = spark.createDataFrame(list(mapping.items()), f"`{k}` {kind}, `{v}` {kind}")
    out = df.join(F.broadcast(table), F.col(c) == F.col(k), "left")
    return out.withColumn(c, F.coalesce(F.col(v), F.col(c))).drop(k, v)


def map_table(spark, mapping: dict, key: str = "key", value: str = "value") -> DataFrame:
    """An inline dictionary as a two-column DataFrame (for broadcast joins)."""
    return spark.createDataFrame([(str(a), b) for a, b in mapping.items()], f"`{key}` string, `{value}` string")


def typo_dictionary(canonical, extra: dict | None = None) -> dict:
    """Provider-name typo dictionary generated by rule, not listed by hand.

    For each canonical name (upper case) the rule emits every single-letter deletion,
    doubled letter, and adjacent transposition, mapped back to the canonical name.
    Canonical names always map to themselves, variants that two canonicals share are
    dropped (ambiguous), and ``extra`` entries (a caller's own dictionary) win over rules.
    """
    canonical = [x.upper() for x in canonical]
    out: dict[str, str] = {}
    clash: set[str] = set()
    for name in canonical:
        variants = set()
        for i in range(len(name)):
            variants.add(name[:i] + name[i + 1:])
            variants.add(name[:i] + name[i] + name[i:])
            if i + 1 < len(name):
                variants.add(name[:i] + name[i + 1] + name[i] + name[i + 2:])
        for v in variants:
            if not v or v == name:
                continue
            if v in out and out[v] != name:
                clash.add(v)
            out[v] = name
    for v in clash:
        out.pop(v, None)
    for name in canonical:
        out[name] = name
    out.update({k.upper(): v for k, v in (extra or {}).items()})
    return out
