"""Deterministic range buckets for distributed ordered computations.

Several operators need "position in a global order" without a single-partition window
(row numbers, lags). They cut the order into ``n`` ranges (buckets) so that a
row's global position is the number of rows in earlier buckets plus its position inside
its own bucket. Bucket bounds come from a fixed-seed sample of the order key (at most
``per_bucket`` sampled keys per bucket are brought back, so the collected list is
bounded) and are applied as literals: the bucket of a row never depends on which
exchange, plan branch or retry computes it. A row hash is appended to the order key as a
tie-breaker, which spreads runs of equal keys (a hot value) over several buckets and
makes the order total.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

MAX_BUCKETS = 65_536
MIN_ROWS_PER_BUCKET = 10_000       # small inputs get few buckets
MAX_ROWS_PER_BUCKET = 5_000_000    # large inputs get enough buckets to keep each one-task window small


def tiebreak(df: DataFrame) -> Column:
    """A deterministic per-row hash used as the last order key."""
    return F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def _sort_key(row):
    return tuple((0, 0) if v is None else (1, v) for v in row)


def bucket_count(total: int, n: int) -> int:
    """Buckets for ``total`` rows: about ``n`` (the shuffle width), but no bucket below
    MIN_ROWS_PER_BUCKET rows and none above MAX_ROWS_PER_BUCKET rows, capped at MAX_BUCKETS."""
    want = min(n, math.ceil(total / MIN_ROWS_PER_BUCKET))
    want = max(want, math.ceil(total / MAX_ROWS_PER_BUCKET))
    return max(1, min(MAX_BUCKETS, want))


def sample_bounds(df: DataFrame, order: list, n: int, per_bucket: int | None = None, seed: int = 7) -> list:
    """Ascending boundary tuples of ``order`` (columns) for :func:`bucket_count` buckets,
    from a fixed-seed sample of about ``buckets * per_bucket`` rows (about 20 keys per
    bucket, 8 beyond 4096 buckets, so the collected sample stays near a million keys)."""
    total = df.count()
    n = bucket_count(total, n)
    if n == 1 or total == 0:
        return []
    per_bucket = per_bucket or (20 if n <= 4096 else 8)
    fraction = min(1.0, per_bucket * n / total)
    keys = df.select(*[e.alias(f"__b{i}") for i, e in enumerate(order)])
    sample = keys.sample(False, fraction, seed) if fraction < 1.0 else keys
    rows = sorted((tuple(r) for r in sample.collect()), key=_sort_key)
    if not rows:
        return []
    bounds = []
    for j in range(1, n):
        b = rows[min(len(rows) - 1, math.ceil(j * len(rows) / n))]
        if not bounds or _sort_key(b) > _sort_key(bounds[-1]):
            bounds.append(b)
    return bounds


TREE_MAX_BOUNDS = 127  # above this, a nested CASE tree grows too large for code generation


def bucket_of(order: list, bounds: list, types: list) -> Column:
    """Index of the range a row falls in: the number of boundaries <= its key.

    Up to ``TREE_MAX_BOUNDS`` boundaries: a balanced comparison tree (code-generated).
    Beyond: a binary search written as one higher-order ``aggregate`` over log2(n) steps
    on a literal array of boundaries, so the expression size stays constant."""
    key = F.struct(*[e.alias(f"__b{i}") for i, e in enumerate(order)])
    lits = [F.struct(*[F.lit(v).cast(t).alias(f"__b{i}") for i, (v, t) in enumerate(zip(b, types))]) for b in bounds]
    if len(bounds) <= TREE_MAX_BOUNDS:
        def tree(lo: int, hi: int) -> Column:
            # buckets lo..hi are separated by bounds[lo..hi-1]
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi + 1) // 2
            return F.when(key < lits[mid - 1], tree(lo, mid - 1)).otherwise(tree(mid, hi))

        return tree(0, len(bounds))
    arr = F.array(*lits)
    steps = math.ceil(math.log2(len(bounds) + 1))

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = ((lo + hi + 1) / 2).cast("int")
        left = key < F.element_at(arr, mid)  # bounds[mid - 1]; element_at is 1-based
        active = lo < hi
        return F.struct(F.when(active & ~left, mid).otherwise(lo).alias("lo"),
                        F.when(active & left, mid - 1).otherwise(hi).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)["lo"]


def with_buckets(df: DataFrame, order: list, n: int, name: str = "__bucket") -> tuple[DataFrame, int]:
    """(``df`` plus a bucket column over ``order``, number of buckets). Callers range-
    partition on the bucket where rows must sit together, and aggregate per bucket
    *before* any shuffle (partial aggregation) where only counts are needed."""
    typed = df.select(*[e.alias(f"__t{i}") for i, e in enumerate(order)])
    types = [f.dataType for f in typed.schema.fields]
    bounds = sample_bounds(df, order, n)
    out = df.withColumn(name, bucket_of(order, bounds, types) if bounds else F.lit(0))
    return out, len(bounds) + 1
