"""Small internal helpers shared by the operator modules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def quote(name: str) -> str:
    """Back-quote a column name for use inside SQL expression strings."""
    return "`" + name.replace("`", "``") + "`"


def fresh(existing: Iterable[str], base: str) -> str:
    """A column name not present in ``existing``."""
    names = set(existing)
    name, i = base, 0
    while name in names:
        i += 1
        name = f"{base}_{i}"
    return name


def spread_for_iterations(df):
    """Before an iterative fit (tens of passes over the same rows): if the input has fewer
    partitions than the cluster has cores, redistribute it once. Inputs that are already
    wide (any real large table) are returned unchanged, so no shuffle is added at scale."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df

