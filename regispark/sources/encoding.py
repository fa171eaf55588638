"""S3: per-file encoding detection as a Spark job.

A DataFrame of paths is spread over tasks; each task streams its files (local/mounted paths
or filesystem URIs) whole, in chunks, and classifies them. Only charsets Spark's CSV reader
accepts are emitted; plain ASCII is UTF-8.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ._fs import open_input

CHUNK = 1 << 20


def classify(chunks: Iterable[bytes]) -> str:
    """``UTF-8`` if all bytes decode as UTF-8 (ASCII does), else ``ISO-8859-1``."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        for chunk in chunks:
            decoder.decode(chunk)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return "ISO-8859-1"
    return "UTF-8"


def classify_file(path: str) -> str:
    with open_input(path) as fh:
        return classify(iter(lambda: fh.read(CHUNK), b""))


def detect_encodings(spark: SparkSession, paths, tasks: int | None = None) -> DataFrame:
    """(path, encoding, error) per file; unreadable files get ``encoding`` NULL and the error."""
    paths = list(paths)
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    df = df.repartition(tasks or max(1, min(len(paths), spark.sparkContext.defaultParallelism)))

    def detect(batches):
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                try:
                    out.append((p, classify_file(p), None))
                except (OSError, ValueError) as exc:
                    out.append((p, None, str(exc)))
            yield pd.DataFrame(out, columns=["path", "encoding", "error"])

    return df.mapInPandas(detect, "path string, encoding string, error string")
