"""Explicit schemas of the ten registry datasets (headerless, all columns nullable).

Column names, order and types come from ``fixed_values.DATASET_COLUMNS`` (including the
published spellings). Ids and codes stay strings (leading zeros); a few counters are ints.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed_values import DATASET_COLUMNS, ENCODING, PREFIX, SHARDED  # noqa: F401


def _schema(spec: str) -> T.StructType:
    fields = []
    for item in spec.split(","):
        name, _, typ = item.strip().partition(" ")
        fields.append(T.StructField(name, T.IntegerType() if typ == "int" else T.StringType(), True))
    return T.StructType(fields)


REGISTRY = {name: _schema(spec) for name, spec in DATASET_COLUMNS.items()}

# Header CSV of first names: first_name, alternative_names ('|'-separated), group_name, ratio, classification.
NAMES = T.StructType([
    T.StructField("first_name", T.StringType()), T.StructField("alternative_names", T.StringType()),
    T.StructField("group_name", T.StringType()), T.StructField("ratio", T.DoubleType()),
    T.StructField("classification", T.StringType()),
])


def dataset_schema(name: str) -> T.StructType:
    key = name.lower()
    if key not in REGISTRY:
        raise ValueError(f"unknown dataset {name!r}; expected one of {sorted(REGISTRY)}")
    return REGISTRY[key]
