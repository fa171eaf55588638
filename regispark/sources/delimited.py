"""Typed delimited scans of registry drops.

Drops are headerless ``;``-separated CSV with ``"`` quoting; unparseable ints become NULL
(PERMISSIVE). Files of one dataset may carry different encodings: paths are grouped by
encoding so the scan is at most one reader per encoding, unioned by name.
"""

from __future__ import annotations

import glob as _glob
import os
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession

from ..operators.profile import union_all
from ..schemas import ENCODING, NAMES, PREFIX, SHARDED, dataset_schema

CSV_OPTIONS = {"sep": ";", "header": "false", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
# Charset names Spark's CSV reader accepts, by the aliases drops are labelled with.
CHARSET_ALIASES = {"ascii": "US-ASCII", "us-ascii": "US-ASCII", "latin-1": "ISO-8859-1", "latin1": "ISO-8859-1",
                   "iso-8859-1": "ISO-8859-1", "utf-8": "UTF-8", "utf8": "UTF-8", "windows-1252": "ISO-8859-1",
                   "cp1252": "ISO-8859-1"}


def spark_charset(name: str | None) -> str:
    if not name:
        return "UTF-8"
    return CHARSET_ALIASES.get(name.lower(), name)


def base_path_of(base_path: str | None) -> str:
    """Base path from the argument, else ``BASE_PATH`` in the environment, else ``./output``."""
    return base_path or os.environ.get("BASE_PATH") or "./output"


def dataset_paths(name: str, base_path: str | None = None) -> str:
    """Path pattern of a dataset; sharded ones are ``Prefix/*.csv``; unknown -> ValueError."""
    dataset_schema(name)
    prefix = PREFIX[name.lower()]
    base = base_path_of(base_path)
    if name.lower() in SHARDED:
        return os.path.join(base, prefix, "*.csv")
    return os.path.join(base, prefix, f"{prefix}.csv")


def read_dataset(spark: SparkSession, name: str, base_path: str | None = None, encoding: str | None = None,
                 paths=None) -> DataFrame:
    """Typed scan of one dataset with its declared (or given) encoding."""
    schema = dataset_schema(name)
    enc = spark_charset(encoding or ENCODING[name.lower()])
    target = paths if paths is not None else dataset_paths(name, base_path)
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("encoding", enc).csv(target)


def read_mixed(spark: SparkSession, name: str, path_encodings: dict) -> DataFrame:
    """Scan files with per-file encodings: one reader per distinct encoding, then union.

    No files -> an empty DataFrame with the dataset schema."""
    schema = dataset_schema(name)
    groups: dict[str, list[str]] = defaultdict(list)
    for path, enc in path_encodings.items():
        groups[spark_charset(enc)].append(path)
    if not groups:
        return spark.createDataFrame([], schema)
    frames = [spark.read.schema(schema).options(**CSV_OPTIONS).option("encoding", enc).csv(sorted(paths))
              for enc, paths in sorted(groups.items())]
    return union_all(frames)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """First-name dictionary (header CSV, plain or ``.csv.gz``) with a declared schema."""
    return spark.read.option("header", True).schema(NAMES).csv(path)


def read_header_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Header CSV, all columns strings."""
    return spark.read.option("header", True).option("sep", sep).option("encoding", spark_charset(encoding)).csv(path)


def local_files(pattern: str) -> list[str]:
    """Expand a local glob (driver-side listing only; contents are read by executors)."""
    return sorted(_glob.glob(pattern))


def read_parquet(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Parquet scan; a column list becomes the scan's ReadSchema (pruned at the source)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
