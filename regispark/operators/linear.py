"""Linear models from sparse normal equations.

Means and centred cross products are all a least-squares fit needs. Numeric columns give
theirs in one aggregate of Spark's stable (co)variances. A categorical column is never
expanded to dummies: its levels' counts and means, and the counts of the pairs of levels of
two categoricals, come from one grouped aggregate over (column pair, level pair), which is
collapsed before the shuffle, so a hot level is one row. What reaches the driver is bounded
by the levels and level pairs, whatever the rows; more than ``max_levels`` slots raise.

The k x k system is solved by a pivoted Cholesky factor that reveals the rank: a slot
that is constant, or a linear combination of others, leaves the fit (its coefficient is NULL).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .._util import as_list, quote

#: A slot leaves the fit when less than this share of its variance is its own.
TOLERANCE = 1e-10
MAX_LEVELS = 4_000


@dataclass
class Moments:
    """Row count, means and centred cross products of named slots; the last one is the label."""

    slots: list
    n: int
    mean: np.ndarray
    cross: np.ndarray


@dataclass
class Fit:
    """Least squares of the last slot on the others; ``beta`` is NaN for slots left out."""

    moments: Moments
    beta: np.ndarray
    intercept: float
    kept: np.ndarray
    inverse: np.ndarray

    @property
    def explained(self) -> float:
        s = self.moments.cross
        return float(np.nan_to_num(self.beta) @ s[:-1, -1])

    def squared_error(self, m: Moments) -> float:
        """Sum of squared errors on the rows of ``m``."""
        b, s = np.nan_to_num(self.beta), m.cross
        bias = m.mean[-1] - self.intercept - b @ m.mean[:-1]
        return max(0.0, float(s[-1, -1] - 2 * b @ s[:-1, -1] + b @ s[:-1, :-1] @ b)) + m.n * bias * bias


def merged(parts: list[Moments]) -> Moments:
    """The moments of all rows of ``parts`` (disjoint, with the same slots)."""
    n = sum(m.n for m in parts)
    mean = sum(m.n * m.mean for m in parts) / n
    apart = [m.mean - mean for m in parts]
    return Moments(parts[0].slots, n, mean, sum(m.cross + m.n * np.outer(a, a) for m, a in zip(parts, apart)))


def independent(cross: np.ndarray, tolerance: float = TOLERANCE) -> np.ndarray:
    """The slots that a Cholesky factor of the correlations keeps, taking the largest pivot
    each time (the first of equal ones), until none has variance of its own left."""
    own = np.sqrt(np.maximum(np.diag(cross), 0.0))
    scale = np.where(own > 0, own, 1.0)
    r = cross / np.outer(scale, scale)
    left, kept = np.diag(r).copy(), []
    left[own == 0] = 0.0
    factor = np.zeros((len(r), 0))
    for _ in range(len(r)):
        best = int(np.argmax(np.round(left, 12)))
        if left[best] <= tolerance:
            break
        column = (r[:, best] - factor @ factor[best]) / np.sqrt(left[best])
        factor = np.column_stack([factor, column])
        left = left - column**2
        left[best] = 0.0
        kept.append(best)
    return np.array(sorted(kept), dtype=int)


def fit(m: Moments, penalty: np.ndarray | None = None) -> Fit:
    """Least squares by the moments; ``penalty`` is added to the diagonal (ridge)."""
    s = m.cross[:-1, :-1]
    kept = independent(s) if m.n else np.zeros(0, dtype=int)
    system = s[np.ix_(kept, kept)] + (0 if penalty is None else np.diag(penalty[kept]))
    scale = 1 / np.sqrt(np.diag(system)) if len(kept) else np.zeros(0)
    inverse = np.linalg.inv(system * np.outer(scale, scale)) * np.outer(scale, scale) if len(kept) else np.zeros((0, 0))
    beta = np.full(len(s), np.nan)
    beta[kept] = inverse @ m.cross[kept, -1]
    return Fit(m, beta, float(m.mean[-1] - np.nan_to_num(beta) @ m.mean[:-1]) if m.n else np.nan, kept, inverse)


def is_categorical(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.StringType, T.BooleanType))


def complete(df: DataFrame, label: str | Column, features, keep=()) -> DataFrame:
    """The rows on which label and features are all there, as f0, f1, ... and y."""
    y = label if isinstance(label, Column) else F.col(quote(label))
    cols = [F.col(quote(c)).cast("string" if is_categorical(df, c) else "double").alias(f"f{i}") for i, c in enumerate(features)]
    return df.select(*cols, y.cast("double").alias("y"), *keep).dropna(subset=[*(f"f{i}" for i in range(len(features))), "y"])


def moments(df: DataFrame, label: str | Column, features, by: Column | None = None, max_levels: int = MAX_LEVELS,
            reference: str = "first") -> Moments | dict:
    """Moments of ``features`` (categorical ones by level) and ``label`` over the complete
    rows; with ``by``, a dictionary of them by its values.

    Slots are (feature, None) or (feature, level) without the reference level: the ``first``
    in order, or the ``rare``st (ties: the last in order)."""
    features = as_list(features)
    cats = [i for i, c in enumerate(features) if is_categorical(df, c)]
    nums = [i for i in range(len(features)) if i not in cats]
    keep = [(F.lit(0) if by is None else by).alias("g")]
    data = complete(df, label, features, keep)
    xs = [F.col(f"f{i}") for i in nums] + [F.col("y")]
    pairs = [(a, b) for a in range(len(xs)) for b in range(a, len(xs))]
    dense = data.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m{a}") for a, x in enumerate(xs)],
                                  *[F.covar_pop(xs[a], xs[b]).alias(f"s{a}_{b}") for a, b in pairs]).collect()
    level: dict = {}
    together: dict = {}
    if cats:
        held = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"f{i}").alias("a"), F.when(F.lit(j != i), F.col(f"f{j}")).alias("b"))
                for p, i in enumerate(cats) for j in cats[p:]]
        single = F.col("e.i") == F.col("e.j")
        rows = data.select("g", *xs, F.explode(F.array(*held)).alias("e")).groupBy("g", "e.i", "e.j", "e.a", "e.b").agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(F.when(single, x)).alias(f"m{k}") for k, x in enumerate(xs)])
        limit = max_levels * max_levels
        got = rows.limit(limit + 1).collect()
        if len(got) > limit:
            raise ValueError(f"the categorical columns have too many levels ({max_levels} slots are allowed)")
        for r in got:
            if r.i == r.j:
                level[r.g, r.i, r.a] = (r.n, np.array([r[f"m{k}"] for k in range(len(xs))]))
            else:
                together[r.g, r.i, r.a, r.j, r.b] = r.n
    counts: dict = {}
    for (_, i, a), (n, _) in level.items():
        counts[i, a] = counts.get((i, a), 0) + n
    slots: list = []
    for i in range(len(features)):
        if i in nums:
            slots.append((i, None))
            continue
        levels = sorted(a for c, a in counts if c == i)
        drop = levels[:1] if reference == "first" else [max(levels, key=lambda a: (-counts[i, a], a))] if levels else []
        slots += [(i, a) for a in levels if a not in drop]
    if len(slots) > max_levels:
        raise ValueError(f"{len(slots)} slots, {max_levels} are allowed")
    at = {s: k for k, s in enumerate(slots)}
    out = {}
    for r in dense:
        size = len(slots) + 1
        mean, cross = np.zeros(size), np.zeros((size, size))
        where = [at[i, None] for i in nums] + [size - 1]
        for a, k in enumerate(where):
            mean[k] = r[f"m{a}"]
        for a, b in pairs:
            cross[where[a], where[b]] = cross[where[b], where[a]] = r[f"s{a}_{b}"] * r.n
        dummies = [(k, i, a, *level.get((r.g, i, a), (0, None))) for (i, a), k in at.items() if a is not None]
        for k, i, a, n, m in dummies:
            mean[k] = n / r.n
            if n:
                cross[k, where] = cross[where, k] = n * (m - mean[where])
            for k2, i2, a2, n2, _ in dummies:
                both = n if k == k2 else together.get((r.g, i, a, i2, a2), together.get((r.g, i2, a2, i, a), 0)) if i != i2 else 0
                cross[k, k2] = both - n * n2 / r.n
        out[r.g] = Moments([(features[i], a) for i, a in slots], r.n, mean, cross)
    if by is not None:
        return out
    size = len(slots) + 1
    return out.get(0) or Moments([(features[i], a) for i, a in slots], 0, np.zeros(size), np.zeros((size, size)))


def predicted(f: Fit, df: DataFrame) -> Column:
    """The fitted value as an expression over the features of ``df``."""
    from ..functions.decode import literal_map

    out, levels = F.lit(f.intercept), {}
    for (c, a), b in zip(f.moments.slots, np.nan_to_num(f.beta).tolist()):
        if a is None:
            out = out + F.lit(b) * F.col(quote(c)).cast("double")
        else:
            levels.setdefault(c, {})[a] = b
    for c, table in levels.items():
        out = out + F.coalesce(literal_map(table)[F.col(quote(c)).cast("string")], F.lit(0.0))
    return out


def slot_name(slot: tuple) -> str:
    return slot[0] if slot[1] is None else f"{slot[0]}={slot[1]}"


def inflation(m: Moments) -> list[float | None]:
    """Variance inflation of each slot: 1 / (1 - R^2) of its regression on all others;
    infinite for a linear combination of others, NULL for a constant."""
    s = m.cross[:-1, :-1]
    kept = independent(s)
    out: list = [None] * len(s)
    if not len(kept):
        return out
    inverse = fit(m).inverse
    tied = set()
    for j in range(len(s)):
        if j in kept or s[j, j] <= 0:
            continue
        out[j] = float("inf")
        share = inverse @ s[kept, j] * np.sqrt(np.diag(s)[kept] / s[j, j])  # what it is made of
        tied |= set(kept[np.abs(share) > np.sqrt(TOLERANCE)].tolist())
    for place, j in enumerate(kept):
        out[j] = float("inf") if j in tied else float(inverse[place, place] * s[j, j])
    return out
