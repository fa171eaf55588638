"""Sinks and materialisation (K1-K6)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from .delimited import read_dataset


def save_data(df: DataFrame, path: str, num_partitions: int | None = None, fmt: str = "parquet",
              mode: str = "overwrite", partition_by=None, overwrite_source: bool = False, options: dict | None = None):
    """K1/K2: write a DataFrame; ``num_partitions`` sets the file count by a repartition, which
    leaves the stage above at its own width.

    ``overwrite_source=True`` is for writing over a path the plan itself reads: the result is
    written beside the target and swapped in when complete, so a failed job leaves the
    source as it was.
    """
    if overwrite_source:
        staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
        save_data(df, staging, num_partitions, fmt, "errorifexists", partition_by, False, options)
        _swap(df.sparkSession, staging, path)
        return path
    if num_partitions:
        df = df.repartition(num_partitions)
    w = df.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def _swap(spark: SparkSession, staging: str, path: str) -> None:
    """Put ``staging`` in the place of ``path`` by renames on their file system."""
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    new, target, old = as_path(staging), as_path(path), as_path(f"{staging}-old")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, target):
        raise OSError(f"cannot move {staging} to {path}; the former data are in {old}")
    fs.delete(old, True)


def write_table(df: DataFrame, name: str, fmt: str | None = None, options: dict | None = None,
                mode: str = "overwrite") -> str:
    """K3: overwrite the warehouse table ``name`` (``saveAsTable``, as ``fmt`` if given), or pass
    through to a connector whose ``options`` say where to write (``path``, ``table`` ...)."""
    w = df.write.mode(mode).options(**(options or {}))
    if fmt:
        w = w.format(fmt)
    if fmt and {"path", "table", "dbtable"} & {k.lower() for k in options or {}}:
        w.save()
    else:
        w.saveAsTable(name)
    return name


def load_all(spark: SparkSession, names, base_path: str | None, sink) -> list[str]:
    """K4/Q12: read every dataset and hand it to ``sink(df, table_name)``.

    Names are de-duplicated case-insensitively (a drop list may repeat a dataset)."""
    done, seen = [], set()
    for name in names:
        key = name.lower()
        if key in seen:
            continue
        seen.add(key)
        sink(read_dataset(spark, key, base_path), key)
        done.append(key)
    return done


def materialize(spark: SparkSession, sql: str, name: str, kind: str = "view") -> DataFrame:
    """K5: a SQL model as a temp view or a table (CTAS)."""
    if kind == "view":
        spark.sql(f"CREATE OR REPLACE TEMP VIEW `{name}` AS {sql}")
    elif kind == "table":
        spark.sql(f"CREATE OR REPLACE TABLE `{name}` USING parquet AS {sql}")
    else:
        raise ValueError("kind must be 'view' or 'table'")
    return spark.table(name)


@contextmanager
def pinned(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """K6: keep a DataFrame cached for the block, unpersist afterwards (callers only)."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
