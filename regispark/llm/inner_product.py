"""Exact top-k inner-product search over norm-sorted vectors.

Vectors are dealt out by descending length, so chunks hold vectors of like length. A block
of queries is broadcast (at most about ``block`` of them, whatever their number in all) with
a starting threshold per query: its k-th best score among the longest vectors. A task passes
over each chunk whose Cauchy-Schwarz bound |q| * |x| is below every threshold; it may read
several files in any order, so it never ends at one. In the others, partial sums over the leading axes of an SVD rotation plus the
product of the residual lengths bound each score from above; only vectors that reach the
threshold get the exact integer product. The rotation is fitted on a bounded sample and
only sharpens the bounds: results are exact. Each task returns at most k rows a query.

Components are floor(1024 * x). Where lengths allow a score beyond a long, products are
taken in whole numbers of any size; a score that does not fit a long, or a component beyond
2**52, raises an error. Defined results: vectors null or holding null or non-finite
components, and null ids, take no part; missing components of a shorter vector are 0;
repeated rows of an id ask once, by the least of their vectors, and may all be found; a query
never finds its own id; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from regispark.llm.common import bounded_sample, partitions, staged

#: Components from here on raise an error.
MOST = 1 << 52
#: Leading axes whose partial sums are taken, one after the other.
AXES = (8, 24)
CHUNK = 2048


def as_integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, length) of the vectors that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = F.transform(x, lambda e: F.when(F.abs(e) < float(MOST), F.floor(e * 1024)).otherwise(
        F.raise_error(F.lit("a component is too large for a score of type long")).cast("long")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(good)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers, short ones filled up with 0."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def products(y: np.ndarray, q: np.ndarray, wide: bool) -> np.ndarray:
    """Inner products of the rows of ``y`` with ``q``, exact; ``wide``: they may pass a long on the way."""
    if not wide:
        return y @ q
    out = [sum(a * b for a, b in zip(row, q.tolist())) for row in y.tolist()]
    if any(not -(1 << 63) < s < 1 << 63 for s in out):
        raise OverflowError("a score does not fit a long")
    return np.array(out, dtype=np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


class Block:
    """A block of queries with their bounds."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, rotation: np.ndarray, longest: tuple[np.ndarray, np.ndarray], k: int, wide: bool = False):
        self.ids, self.q, self.rotation, self.k, self.wide = ids, q, rotation, k, wide
        self.length = np.sqrt((q.astype(float) ** 2).sum(axis=1))
        self.rotated = q.astype(float) @ rotation
        self.rest = [np.sqrt((self.rotated[:, a:] ** 2).sum(axis=1)) for a in AXES]
        seed_ids, seeds = longest
        self.floor = np.full(len(ids), -np.inf)
        for i in range(len(ids)):
            scores = products(seeds[seed_ids != ids[i]], q[i], wide)
            if len(scores) >= k:
                self.floor[i] = np.partition(scores, -k)[-k]

    def search(self, batches: Iterator[tuple[np.ndarray, np.ndarray]]):
        """The best of a run of vectors in any order: (query id, id, score) arrays."""
        floor = self.floor.copy()
        held = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in self.ids]
        for ids, x in batches:
            for lo in range(0, len(ids), CHUNK):
                part, y = ids[lo : lo + CHUNK], x[lo : lo + CHUNK]
                z = y.astype(float)
                length = np.sqrt((z**2).sum(axis=1))
                slack = 1e-9 * self.length * length.max(initial=0) + 1e-6  # of the floating-point bounds
                live = np.flatnonzero(self.length * length.max(initial=0) + slack >= floor)
                if not len(live):
                    continue  # not the end: a file of longer vectors may follow in this task
                z = z @ self.rotation
                for j in live:
                    rows = np.flatnonzero(length * self.length[j] + slack[j] >= floor[j])
                    for a, rest in zip(AXES, self.rest):
                        tail = np.sqrt((z[rows, a:] ** 2).sum(axis=1))
                        rows = rows[z[rows, :a] @ self.rotated[j, :a] + tail * rest[j] + slack[j] >= floor[j]]
                    rows = rows[part[rows] != self.ids[j]]
                    scores = products(y[rows], self.q[j], self.wide)
                    keep = scores.astype(float) >= floor[j]  # rounded as the floor was
                    if keep.any():
                        s, i = np.concatenate([held[j][0], scores[keep]]), np.concatenate([held[j][1], part[rows[keep]]])
                        top = best(s, i, self.k)
                        held[j] = (s[top], i[top])
                        if len(top) == self.k:
                            floor[j] = max(floor[j], s[top][-1])
        return self._out(held)

    def _out(self, held):
        count = [len(s) for s, _ in held]
        return (np.repeat(self.ids, count), np.concatenate([i for _, i in held] or [self.ids]), np.concatenate([s for s, _ in held] or [self.ids]))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block: int = 4096, sample: int = 5000, seeds: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all vectors for each row of
    ``vectors`` (vec_id, embedding) for which ``is_query`` holds."""
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score long"
    ordered = as_integers(vectors).repartitionByRange(partitions(spark), F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
    rows = staged(ordered)
    dims, longest_of_all = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max("length"), F.lit(0.0))).first()
    wide = longest_of_all**2 * (1 + 1e-6) >= 2.0**63
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_blocks = -(-asked.count() // block)

    def fetched(df):
        got = df.select("vec_id", "v").toArrow().combine_chunks()
        if not got.num_rows:
            return np.zeros(0, dtype=np.int64), np.zeros((0, dims), dtype=np.int64)
        column = got.column("v")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return got.column("vec_id").to_numpy().astype(np.int64), matrix(column, dims)

    drawn = fetched(bounded_sample(rows, "vec_id", sample))[1].astype(float)
    rotation = np.linalg.svd(drawn.T @ drawn)[0] if dims else np.zeros((0, 0))
    # the rows above an approximate quantile hold the longest; only those are sorted
    share = 1.0 - min(1.0, 2 * seeds / max(rows.count(), 1))
    cut = rows.agg(F.percentile_approx("length", share, 10_000)).first()[0] or 0.0
    longest = fetched(rows.where(F.col("length") >= cut).orderBy(F.desc("length"), "vec_id").limit(seeds))
    found = spark.createDataFrame([], schema)
    for b in range(n_blocks):
        ids, q = fetched(asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b))
        if not len(ids):
            continue
        shared = spark.sparkContext.broadcast(Block(ids, q, rotation, longest, k, wide))

        def search(batches, shared=shared):
            out = shared.value.search((x.column("vec_id").to_numpy().astype(np.int64), matrix(x.column("v"), dims)) for x in batches)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

        found = found.union(rows.select("vec_id", "v").mapInArrow(search, schema))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = 10, every: int = 100) -> str:
    return f"""
WITH e AS (SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id),
 r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
