"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regispark.session import ensure_checkpoint_dir

#: Bytes of text that one numpy step handles, and rows of an Arrow batch taken at a time;
#: they bound the temporaries of a Python worker.
BLOCK_BYTES, SLICE_ROWS = 1 << 18, 256
#: A word of the near-duplicate contract: a run without blank or \t\n\v\f\r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` (shared by all executors)
    and read it back: the lineage is cut, and a lost executor costs nothing already done."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``: those of the least hash of ``key``. A threshold keeps
    about twice as many before the sort, so no task reads more however many rows there are."""
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    share = min(1.0, 2 * rows / max(df.count(), 1))
    return df.where(draw <= int((1 << 40) * share)).orderBy(draw, key).limit(rows)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows (no copy)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of at most ``limit`` bytes (one longer text stands alone)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encoded(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text of a column; a null text is empty."""
    return [t or b"" for t in batch.column(name).cast(pa.large_binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a column; a null is empty."""
    return [t.decode("utf-8", "replace") for t in encoded(batch, name)]


def passed(df: DataFrame, columns: str) -> str:
    """Schema string of the columns of ``df`` followed by ``columns``."""
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), columns])


# ---- hashed words of a block of texts, without a Python loop over words ----------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Hasher:
    """Hashes of byte ranges: a polynomial over 64 bits by prefix sums, then mixed. Equal
    ranges have equal hashes wherever they stand; a chance collision has odds of 2**-64."""

    def __init__(self):
        self.values = _byte_values()
        self.powers = _powers(1 << 12)
        inverse = pow(int(_BASE), -1, 1 << 64)
        self._inv_base = np.uint64(inverse)
        self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers = _powers(1 << (n - 1).bit_length())
        if len(self.inverses) < n:
            p = np.full(len(self.powers), self._inv_base, dtype=np.uint64)
            p[0] = 1
            self.inverses = np.cumprod(p, dtype=np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (prefix[end] - prefix[start]) * self.inverses[start]
        return mix64(h + mix64((end - start).astype(np.uint64)))


def word_table(kind: str) -> np.ndarray:
    """256 flags: which bytes belong to words. ``space``: all but ASCII white space;
    ``alnum``: ASCII letters and digits and every byte of a non-ASCII character."""
    flags = np.zeros(256, dtype=bool)
    if kind == "space":
        flags[:] = True
        flags[[0x20, *range(0x09, 0x0E)]] = False
    else:
        for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
            flags[lo:hi] = True
    return flags


LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def words(texts: list[bytes], flags: np.ndarray, hasher: Hasher):
    """(hash, document index, byte start, byte end) of each A-Z-lowered word of a block;
    starts and ends count from the beginning of the word's own document."""
    joined = b"\n".join(texts).translate(LOWER)
    data = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    first = np.zeros(len(texts), dtype=np.int64)
    np.cumsum(lengths[:-1] + 1, out=first[1:])
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = flags[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        empty = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), empty, empty, empty
    h = hasher.ranges(hasher.prefix(data), start, end)
    doc = np.searchsorted(first, start, side="right") - 1
    return h, doc, start - first[doc], end - first[doc]


def shingle_hashes(h: np.ndarray, doc: np.ndarray, n_docs: int, k: int = 5):
    """(document index, hash) of the distinct k-word shingles; fewer words: the whole
    sequence as one; no word: none. Sorted by document, then hash."""
    n_words = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(n_words) - n_words
    parts = []
    if len(h) >= k:
        s = np.zeros(len(h) - k + 1, dtype=np.uint64)
        for j in range(k):
            s = mix64(s * np.uint64(0xD6E8FEB86659FD93) + h[j : len(h) - k + 1 + j])
        whole = doc[: len(s)] == doc[k - 1 :]
        parts.append((doc[: len(s)][whole], s[whole]))
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        out = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = n_words[short] > j
            out[has] = mix64(out[has] * np.uint64(0xD6E8FEB86659FD93) + h[first[short[has]] + j])
        parts.append((short, mix64(out + n_words[short].astype(np.uint64))))
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    d = np.concatenate([p[0] for p in parts])
    s = np.concatenate([p[1] for p in parts])
    if len(parts) == 2 and len(parts[0][0]):
        order = np.argsort(d, kind="stable")
        d, s = d[order], s[order]
    edge = np.flatnonzero(np.diff(d)) + 1
    for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(d)]):
        s[lo:hi].sort()
    keep = np.ones(len(d), dtype=bool)
    keep[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    return d[keep], s[keep]


# ---- connected components --------------------------------------------------------------


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links(a, b)`` by alternating large-star and small-star
    steps, each an aggregate and a join. Returns (node, component_id), the smallest node
    reachable, for every node of a link. Only a count and a checksum of the edges reach
    the driver. The minima are staged, so AQE can split the edges of a hot node."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    was, now = None, _fingerprint(edges)
    while now != was:
        # large star: the larger neighbours of a node point to the least of it and its neighbours
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = staged(small.select("e.u", "e.v").where("u <> v").distinct())
        was, now = now, _fingerprint(edges)
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component_id")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct())
