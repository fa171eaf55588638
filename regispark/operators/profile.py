"""Aggregates, profiles and audits.

Everything is one or two distributed aggregates: partial (map-side) aggregation collapses
hot groups before the shuffle, percentiles use the bounded-memory ``percentile_approx``
sketch, and totals come in as scalar subqueries (no single-partition window, no cross
join). Results are long-form DataFrames; nothing is collected inside an operator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .._util import as_list, fresh, quote
from .selection import selected

# Probabilities of the group profile: 5 % .. 95 % by 5, then 99 %.
PROFILE_PROBS = [round(p / 100, 2) for p in range(5, 100, 5)] + [0.99]
DEFAULT_ACCURACY = 10_000
# percentile_approx targets rank ceil(p * n) computed in binary floating point, so a decimal
# probability like 0.55 with n = 3020 lands one rank high (1661.0000000000002 -> 1662).
# Pulling p down by 1e-12 restores the intended decimal rank for any n below 1e11 and is far
# below the sketch's own relative error at larger n.
_P_NUDGE = 1e-12


def _probs(probs) -> list[float]:
    return [max(0.0, float(p) - _P_NUDGE) if 0 < p < 1 else float(p) for p in probs]


def _c(name: str) -> Column:
    return F.col(quote(name))


def exact_quantiles_long(df: DataFrame, by, c: str, probs) -> DataFrame:
    """Exact discrete quantiles (inverted CDF: the ceil(p * n)-th smallest non-NULL value, as
    SQL ``percentile_disc``/``quantile_disc``) per group, as rows (by..., prob, value; fresh
    names where a key has one of these), by selection in rounds
    (:mod:`regispark.operators.selection`): one read of the input, no row shuffle, no value
    list per group, and a hot group or a hot value is counted before any shuffle.
    """
    keys = as_list(by)
    rows = selected(df, keys, c, probs).filter("p is not null and n > 0")
    return rows.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], F.col("p").cast("double").alias(fresh(keys, "prob")),
                       F.col("value").alias(fresh(keys, "value")))


def pct_name(p: float) -> str:
    return f"p{int(round(p * 100)):02d}"


def freq(df: DataFrame, cols, top: int | None = None, count_col: str = "count") -> DataFrame:
    """A1/A2 (+O1/O2): frequency table, most frequent first, ties broken by key."""
    keys = as_list(cols)
    out = df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_col))
    out = out.orderBy(F.desc(count_col), *[F.asc_nulls_first(quote(k)) for k in keys])
    return out.limit(top) if top else out


def share(df: DataFrame, cols, digits: int = 2, count_col: str = "count", pct_col: str = "pct",
          total: int | Column | None = None) -> DataFrame:
    """Frequency table with percent of total (rounded).

    The total is a scalar subquery over ``df`` (or a fixed denominator such as a known
    population size), so the share needs no window over the whole result.
    """
    keys = as_list(cols)
    if total is None:
        total = df.select(F.count(F.lit(1))).scalar()
    elif not isinstance(total, Column):
        total = F.lit(total)
    out = df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_col))
    out = out.withColumn(pct_col, F.round(F.lit(100.0) * F.col(count_col) / total.cast("double"), digits))
    return out.orderBy(F.desc(count_col), *[F.asc_nulls_first(quote(k)) for k in keys])


def top_k(df: DataFrame, order, k: int, ascending: bool = False) -> DataFrame:
    """O2: ordered top-k (``TakeOrderedAndProject``: each task keeps k rows, no full sort)."""
    cols = [F.asc(quote(c)) if ascending else F.desc(quote(c)) for c in as_list(order)]
    return df.orderBy(*cols).limit(k)


def group_profile(df: DataFrame, by, c: str, probs=PROFILE_PROBS, accuracy: int = DEFAULT_ACCURACY,
                  exact: bool = False) -> DataFrame:
    """A3: per group count, mean, min, percentiles, max.

    Default: one aggregate with a bounded-memory ``percentile_approx`` sketch per group
    (relative rank error 1/accuracy). ``exact=True``: exact discrete percentiles by selection
    in rounds, with the statistics of its first pass; a statistic gets a fresh name where a
    key has its name."""
    keys = as_list(by)
    if exact:
        ks = [f"k{i}" for i in range(len(keys))]
        out = selected(df, keys, c, probs).groupBy(*ks).agg(
            *[F.expr(f"max({x}) AS {x}") for x in ("n", "total", "least", "most")],
            *[F.expr(f"max(CASE WHEN CAST(p AS DOUBLE) = CAST({float(p)!r} AS DOUBLE) THEN value END) AS q{i}") for i, p in enumerate(probs)])
        stats = {"n": "n", "mean": "CASE WHEN n > 0 THEN total / n END", "min": "least", **{pct_name(p): f"q{i}" for i, p in enumerate(probs)}, "max": "most"}
        return out.selectExpr(*[f"{a} AS {quote(k)}" for a, k in zip(ks, keys)], *[f"{v} AS {quote(fresh(keys, s))}" for s, v in stats.items()])
    q = fresh(df.columns, "__q")
    agg = df.groupBy(*[_c(k) for k in keys]).agg(
        F.count(_c(c)).alias("n"),
        F.avg(_c(c)).alias("mean"),
        F.min(_c(c)).alias("min"),
        F.percentile_approx(_c(c), _probs(probs), accuracy).alias(q),
        F.max(_c(c)).alias("max"),
    )
    return agg.select(*[_c(k) for k in keys], "n", "mean", "min",
                      *[F.col(q)[i].alias(pct_name(p)) for i, p in enumerate(probs)], "max")


def quantiles(df: DataFrame, c: str, probs, accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """A4: global quantiles as (prob, value) rows.

    Default: one distributed sketch aggregate. ``exact=True`` (relative error 0): exact
    discrete quantiles by selection in rounds."""
    probs = list(probs)
    if exact:
        return exact_quantiles_long(df, [], c, probs)
    q = df.agg(F.percentile_approx(_c(c), _probs(probs), accuracy).alias("q"))
    return q.select(F.posexplode("q").alias("i", "value")).select(
        F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("prob"), "value")


def filtered_mean(df: DataFrame, c: str, lo, hi, digits: int = 2) -> DataFrame:
    """A5: mean of ``c`` over ``lo < c < hi``, rounded."""
    return df.filter((_c(c) > lo) & (_c(c) < hi)).agg(F.round(F.avg(_c(c)), digits).alias("mean"))


def summary_long(df: DataFrame, cols, accuracy: int = DEFAULT_ACCURACY, exact: bool = False) -> DataFrame:
    """Count, mean, stddev, min, 25/50/75 %, max per column, long form.

    Default: one aggregate with sketches. ``exact=True``: exact quartiles per
    column (then joined to the one-pass moments)."""
    cols = as_list(cols)
    if exact:
        moments = describe_long(df, cols)
        long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), _c(c).cast("double").alias("value"))
                                            for c in cols])))
        qs = exact_quantiles_long(long, "column", "value", [0.25, 0.5, 0.75])
        wide = qs.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).cast("double").alias(n)
                                          for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
        return moments.join(wide, "column", "left").select("column", "count", "mean", "stddev", "min", "p25", "p50",
                                                           "p75", "max")
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(_c(c)).alias(f"n{i}"), F.avg(_c(c)).alias(f"m{i}"), F.stddev_samp(_c(c)).alias(f"s{i}"),
                 F.min(_c(c)).cast("double").alias(f"lo{i}"),
                 F.percentile_approx(_c(c), _probs([0.25, 0.5, 0.75]), accuracy).alias(f"q{i}"),
                 F.max(_c(c)).cast("double").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                              F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min"),
                              F.col(f"q{i}")[0].cast("double").alias("p25"), F.col(f"q{i}")[1].cast("double").alias("p50"),
                              F.col(f"q{i}")[2].cast("double").alias("p75"), F.col(f"hi{i}").alias("max"))
                     for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def describe_long(df: DataFrame, cols) -> DataFrame:
    """Count, mean, stddev, min, max per column (long form)."""
    cols = as_list(cols)
    wide = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(_c(c)).alias(f"n{i}"), F.avg(_c(c)).alias(f"m{i}"), F.stddev_samp(_c(c)).alias(f"s{i}"),
        F.min(_c(c)).cast("double").alias(f"lo{i}"), F.max(_c(c)).cast("double").alias(f"hi{i}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                              F.col(f"s{i}").alias("stddev"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
                     for i, c in enumerate(cols)])
    return wide.select(F.inline(rows))


def missing_table(df: DataFrame, cols=None, digits: int = 2) -> DataFrame:
    """Per column NULL count and percent of rows, most missing first — one pass."""
    cols = as_list(cols) or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(_c(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(cols)])
    out = wide.select("__rows", F.inline(rows))
    out = out.withColumn("pct", F.round(F.try_divide(F.lit(100.0) * F.col("missing"), F.col("__rows")), digits)).drop("__rows")
    return out.orderBy(F.desc("pct"), F.asc("column"))


def duplicate_audit(df: DataFrame, cols=None) -> DataFrame:
    """A10/D3: rows, distinct rows and surplus duplicates in one grouped pass
    (equal to ``count()`` vs ``dropDuplicates().count()``; NULLs group together)."""
    cols = as_list(cols) or df.columns
    g = df.groupBy(*[_c(c) for c in cols]).agg(F.count(F.lit(1)).alias("__n"))
    return g.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")) \
        .withColumn("duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def dedupe(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.dropDuplicates()


def dedupe_on(df: DataFrame, keys, prefer=None, ascending: bool = False) -> DataFrame:
    """One survivor per key, chosen deterministically.

    The survivor has the largest (smallest with ``ascending``) ``prefer`` columns, then the
    largest remaining columns — NULLs lose. Implemented as a grouped ``max``/``min`` of a
    struct, so a hot key is reduced map-side and never sorted in one task.
    """
    keys = as_list(keys)
    prefer = as_list(prefer)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[_c(c).alias(f"__o{i}") for i, c in enumerate(prefer)], *[_c(c).alias(c) for c in rest])
    pick = F.min if ascending else F.max
    g = df.groupBy(*[_c(k) for k in keys]).agg(pick(order).alias("__best"))
    return g.select(*[_c(k) for k in keys], *[F.col("__best")[c].alias(c) for c in rest]).select(*df.columns)


def histogram(df: DataFrame, c: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram over [min, max]; every bin listed (empty -> 0).

    Bounds are scalar subqueries; the top edge falls into the last bin. A constant column is
    all in the first one.
    """
    lo = df.select(F.min(_c(c)).cast("double")).scalar()
    hi = df.select(F.max(_c(c)).cast("double")).scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.coalesce(F.floor(F.try_divide(_c(c).cast("double") - lo, width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = df.filter(_c(c).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = edges.join(F.broadcast(counts), "bin", "left")
    return out.select("bin", (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"),
                      F.coalesce("count", F.lit(0)).alias("count")).orderBy("bin")


def five_number(df: DataFrame, c: str, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """A15 box summary: min, q1, median, q3, max in one aggregate."""
    return df.agg(F.min(_c(c)).alias("min"),
                  F.percentile_approx(_c(c), _probs([0.25, 0.5, 0.75]), accuracy).alias("__q"),
                  F.max(_c(c)).alias("max")) \
        .select("min", F.col("__q")[0].alias("q1"), F.col("__q")[1].alias("median"), F.col("__q")[2].alias("q3"), "max")


def corr_or_null(a: Column, b: Column) -> Column:
    """Pearson correlation over complete pairs; NULL, not an error, where one is constant."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def corr_matrix(df: DataFrame, cols, nulls: str = "pairwise") -> DataFrame:
    """Pearson matrix in long form (column_a, column_b, corr) from ONE aggregate.

    ``pairwise``: a pair with a NULL is skipped (``corr``). ``zero``: NULL counts as 0, the
    behaviour of ``DataFrame.stat.corr`` on nullable columns. A constant column correlates
    with nothing: NULL.
    """
    cols = as_list(cols)
    if nulls not in ("pairwise", "zero"):
        raise ValueError("nulls must be 'pairwise' or 'zero'")
    val = (lambda c: F.coalesce(_c(c).cast("double"), F.lit(0.0))) if nulls == "zero" else (lambda c: _c(c).cast("double"))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    wide = df.agg(F.lit(1).alias("__one"), *[corr_or_null(val(cols[i]), val(cols[j])).alias(f"r{i}_{j}") for i, j in pairs])
    items = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                v = F.lit(1.0)
            else:
                v = F.col(f"r{min(i, j)}_{max(i, j)}")
            items.append(F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), v.alias("corr")))
    return wide.select(F.inline(F.array(*items)))


def variance(df: DataFrame, cols) -> DataFrame:
    """Sample variance per column (long form)."""
    cols = as_list(cols)
    wide = df.agg(*[F.var_samp(_c(c)).alias(f"v{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("variance"))
                                          for i, c in enumerate(cols)])))


def union_all(dfs) -> DataFrame:
    """Concatenate shards by column name (no dedupe)."""
    return reduce(lambda a, b: a.unionByName(b), list(dfs))


def matrix_long(df: DataFrame, row_col: str, value_name: str = "value", col_name: str = "column") -> DataFrame:
    """K7: a wide matrix (one row per ``row_col``, one column per entry) as long form
    (row, column, value), ready for any writer."""
    values = [c for c in df.columns if c != row_col]
    return df.unpivot([row_col], values, col_name, value_name)
