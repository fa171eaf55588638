"""Statistical tests as distributed aggregates (T1-T6, A16 helpers).

Moments, sums of squares and normal equations are Spark aggregates; only statistics, one row
per test or feature, reach the driver, where :mod:`.tails` gives their tail probability.

Ordered tests (Durbin–Watson, Breusch–Godfrey) need ``lag`` in a global order. A window
``lag`` without ``partitionBy`` runs in ONE task, so :func:`lagged` deals the rows to range
buckets, lags inside each and stitches the edges in a second window over the edges alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .._util import as_list, quote
from ..session import written
from . import linear
from .profile import corr_or_null
from .tails import with_p_value

# ---------------------------------------------------------------------------
# T1 Jarque-Bera, T2 KS normality
# ---------------------------------------------------------------------------

def moments(df: DataFrame, c: str) -> DataFrame:
    """n, mean, population variance, skewness and excess kurtosis of one column, in one pass
    of Spark's central moments (stable at any mean). NaN values count as missing."""
    x = F.col(quote(c)).cast("double")
    return df.filter(x.isNotNull() & ~F.isnan(x)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("m2"),
        F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"))


def jarque_bera(df: DataFrame, c: str, alpha: float = 0.05) -> DataFrame:
    """JB = n/6 (S^2 + K^2/4) with population skewness S and excess kurtosis K;
    p = exp(-JB/2) (chi-square, 2 dof, closed form). One row; NULL where the column is
    empty or constant and the statistic is not defined."""
    defined = F.col("m2") > 0
    out = moments(df, c).select("n", F.when(defined, F.col("skewness")).alias("skewness"), F.when(defined, F.col("kurtosis")).alias("kurtosis"))
    out = out.withColumn("jb", F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0))
    out = out.withColumn("p_value", F.exp(-F.col("jb") / 2.0))
    return out.withColumn("normal", F.col("p_value") > alpha)


#: Polynomial coefficients of the normal distribution function to double precision
#: (numerator and denominator, highest power first; the tail beyond 7.07 is a continued fraction).
_PHI_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
_PHI_BOTTOM = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948,
               440.413735824752)


def normal_cdf_sql(z: str) -> str:
    """SQL for the standard normal distribution function of ``z``, good to 15 digits."""
    def polynomial(coefficients):
        out = repr(coefficients[0]) + "D"
        for c in coefficients[1:]:
            out = f"({out} * abs({z}) + {c!r}D)"
        return out

    fraction = f"(abs({z}) + 1 / (abs({z}) + 2 / (abs({z}) + 3 / (abs({z}) + 4 / (abs({z}) + 0.65D)))))"
    tail = (f"exp(-{z} * {z} / 2) * CASE WHEN abs({z}) < 7.07106781186547D THEN {polynomial(_PHI_TOP)} / {polynomial(_PHI_BOTTOM)} "
            f"ELSE 1 / ({fraction} * 2.506628274631D) END")
    return f"CASE WHEN {z} > 0 THEN 1 - {tail} ELSE {tail} END"


#: Values between two cuts of the empirical distribution, about; and the most cuts there are.
VALUES_PER_CUT, MOST_CUTS = 100_000, 2_000


def empirical_steps(df: DataFrame, c: str) -> DataFrame:
    """(x, m, before, n): each distinct non-NULL, non-NaN value of ``c`` with its count, the
    count of all lower ones and of all rows.

    Equal values are counted first, so a hot value is one row. Cuts at quantiles, fixed once,
    part the values into slices that are numbered side by side; only the slices' counts meet
    in one window (at most ``MOST_CUTS`` rows)."""
    x = F.col(quote(c)).cast("double")
    counts = written(df.where(x.isNotNull() & ~F.isnan(x)).groupBy(x.alias("x")).agg(F.count(F.lit(1)).alias("m")), "steps")
    cuts = min(MOST_CUTS, counts.count() // VALUES_PER_CUT)
    bounds = []
    if cuts:
        got = counts.agg(F.percentile_approx("x", [i / (cuts + 1) for i in range(1, cuts + 1)], 10 * MOST_CUTS).alias("q")).first().q
        bounds = sorted(set(got))

    def slice_of(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN x > {bounds[mid]!r}D THEN {slice_of(mid + 1, hi)} ELSE {slice_of(lo, mid)} END"

    sliced = counts.withColumn("slice", F.expr(slice_of(0, len(bounds))))
    sums = sliced.groupBy("slice").agg(F.sum("m").alias("rows"))
    ahead = Window.partitionBy().orderBy("slice")
    sums = sums.select("slice", (F.sum("rows").over(ahead) - F.col("rows")).alias("ahead"), F.sum("rows").over(Window.partitionBy()).alias("n"))
    inside = F.sum("m").over(Window.partitionBy("slice").orderBy("x")) - F.col("m")
    return sliced.withColumn("inside", inside).join(F.broadcast(sums), "slice").select("x", "m", (F.col("ahead") + F.col("inside")).alias("before"), "n")


def lilliefors_p(n: int, d: float) -> float:
    """p-value of the Kolmogorov-Smirnov distance ``d`` to a normal distribution whose mean and
    deviation were fitted to the same ``n`` values: the published approximation below 0.1 (beyond
    100 values at the distance with the same modified statistic) and polynomials of the modified
    statistic above."""
    k = (math.sqrt(n) - 0.01 + 0.85 / math.sqrt(n)) * d
    kd, nd = (k / 10.075, 100.0) if n > 100 else (d, float(n))
    root = math.sqrt(nd + 2.78019)
    p = math.exp(min(0.0, -7.01256 * kd * kd * (nd + 2.78019) + 2.99587 * kd * root - 0.122119 + 0.974598 / math.sqrt(nd) + 1.67997 / nd))
    if p <= 0.1:
        return p
    for upto, c in ((0.302, (1.0,)), (0.5, (2.76773, -19.828315, 80.709644, -138.55152, 81.218052)),
                    (0.9, (-4.901232, 40.662806, -97.490286, 94.029866, -32.355711)), (1.31, (6.198765, -19.558097, 23.186922, -12.234627, 2.423045))):
        if k <= upto:
            return min(1.0, max(0.0, sum(a * k**i for i, a in enumerate(c))))
    return 0.0


def ks_normal(df: DataFrame, c: str, alpha: float = 0.05) -> DataFrame:
    """T2 (re-aimed Shapiro-Wilk): the largest distance between the empirical distribution of the
    column and the normal one with its own mean and sample deviation, exact over all distinct
    values, and its Lilliefors p-value (which allows for the fit). One row (n, mean, stddev,
    statistic, p_value, normal); NULL where fewer than four values are there,
    all are equal or one is infinite."""
    fitted = moments(df, c).select("n", "mean", F.sqrt(F.try_divide(F.col("m2") * F.col("n"), F.col("n") - 1)).alias("stddev")).first()
    d = None
    if fitted.n > 3 and fitted.stddev and math.isfinite(fitted.mean) and math.isfinite(fitted.stddev):
        cdf = F.expr(normal_cdf_sql(f"((x - {fitted.mean!r}D) / {fitted.stddev!r}D)"))
        steps = empirical_steps(df, c).withColumn("f", cdf)
        d = steps.agg(F.max(F.greatest(F.col("f") - F.col("before") / F.col("n"), (F.col("before") + F.col("m")) / F.col("n") - F.col("f")))).first()[0]
    p = None if d is None else lilliefors_p(fitted.n, d)
    return df.sparkSession.createDataFrame([(fitted.n, fitted.mean, fitted.stddev, d, p, None if p is None else p > alpha)],
                                           "n long, mean double, stddev double, statistic double, p_value double, normal boolean")


# ---------------------------------------------------------------------------
# Distributed lag
# ---------------------------------------------------------------------------

def lagged(df: DataFrame, cols, order_col: str, lags: int = 1, partition_cols=(), num_partitions: int | None = None,
           prefix: str = "lag") -> DataFrame:
    """Add ``{prefix}{k}_{c}`` = value of ``c`` k rows earlier in ``order_col`` order (within
    ``partition_cols``), without a window over all rows of a group.

    ``order_col`` must be unique within a group. Rows are dealt to deterministic range
    buckets over (groups, order) and lagged inside (bucket, group). The first ``lags`` rows of
    each (bucket, group) get theirs from a second window over the edges only: the first and
    last ``lags`` rows of every (bucket, group), which always hold a first row's
    predecessors. Everything is keyed by bucket value, so retries and separately planned
    exchanges agree. Types and NaN values pass through unchanged.
    """
    from .ordering import with_buckets

    cols, part = as_list(cols), as_list(partition_cols)
    keys = part + [order_col]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b, _ = with_buckets(df, [F.col(quote(k)) for k in keys], n)
    groups = [quote(p) for p in part]
    names = {f"{prefix}{k}_{c}": (k, c) for k in range(1, lags + 1) for c in cols}

    def with_lags(rows, window):
        return rows.withColumns({name: F.lag(quote(c), k).over(window) for name, (k, c) in names.items()})

    inside = Window.partitionBy("__bucket", *groups)
    ordered = inside.orderBy(quote(order_col))
    placed = b.withColumns({"__pos": F.row_number().over(ordered), "__size": F.count(F.lit(1)).over(inside)})
    out = [*[quote(c) for c in df.columns], *[quote(name) for name in names]]
    body = with_lags(placed, ordered).filter(F.col("__pos") > lags).select(*out)
    edges = placed.filter((F.col("__pos") <= lags) | (F.col("__pos") > F.col("__size") - lags))
    across = (Window.partitionBy(*groups) if groups else Window.partitionBy()).orderBy("__bucket", quote(order_col))
    heads = with_lags(edges, across).filter(F.col("__pos") <= lags).select(*out)
    return body.union(heads)


# ---------------------------------------------------------------------------
# T3 Durbin-Watson, T4 Breusch-Pagan, T5 Breusch-Godfrey, T6 VIF
# ---------------------------------------------------------------------------

def durbin_watson(df: DataFrame, e: str, order_col: str, partition_cols=()) -> DataFrame:
    """sum((e_t - e_{t-1})^2) / sum(e_t^2) per group (one row without groups)."""
    part = as_list(partition_cols)
    lg = lagged(df.select(*part, order_col, e), e, order_col, 1, part)
    d = F.col(quote(e)) - F.col(f"lag1_{e}")
    agg = lg.groupBy(*[quote(p) for p in part]).agg(F.sum(d * d).alias("num"),
                                                     F.sum(F.col(quote(e)) * F.col(quote(e))).alias("den"),
                                                     F.count(F.lit(1)).alias("n"))
    return agg.select(*part, "n", F.try_divide(F.col("num"), F.col("den")).alias("dw"))


def residuals(df: DataFrame, y: str, exog, out: str = "resid", keep=()) -> DataFrame:
    """OLS residuals of ``y ~ exog`` (numbers, or strings by level) as the column ``out``, with
    ``keep``; rows with a NULL among ``y`` and ``exog`` are left out."""
    exog, keep = as_list(exog), as_list(keep)
    model = linear.fit(linear.moments(df, y, exog))
    cast = [(F.col(quote(c)) if linear.is_categorical(df, c) else F.col(quote(c)).cast("double")).alias(c) for c in [y, *exog]]
    base = df.select(*[quote(k) for k in keep if k not in [y, *exog]], *cast).dropna(subset=[y, *exog])
    return base.withColumn(out, F.col(quote(y)) - linear.predicted(model, base))


def _lagrange(df: DataFrame, m: linear.Moments, dof: int | None = None) -> DataFrame:
    """n, R^2, LM = n R^2 and its chi-square p-value; NULL where the label does not vary."""
    model = linear.fit(m)
    total = float(m.cross[-1, -1]) if m.n else 0.0
    r2 = min(1.0, max(0.0, model.explained / total)) if total > 0 else None
    row = (m.n, r2, None if r2 is None else m.n * r2, len(model.kept) if dof is None else dof)
    return with_p_value(df.sparkSession.createDataFrame([row], "n long, r2 double, lm double, dof int"), "chi2", "lm", "dof")


def breusch_pagan(df: DataFrame, e: str, exog) -> DataFrame:
    """T4: LM = n R^2 of e^2 ~ exog with p from chi-square. ``exog`` are numbers or categories
    (strings, by level, the first being the reference); the degrees of freedom are the rank of
    the regressors. NULL R^2 and LM where e^2 is constant or no row is complete."""
    return _lagrange(df, linear.moments(df, F.col(quote(e)).cast("double") ** 2, as_list(exog)))


def breusch_godfrey(df: DataFrame, e: str, exog, order_col: str, lags: int = 1) -> DataFrame:
    """T5: regress e on exog and e lagged 1..lags (missing lags = 0); LM = n R^2, chi-square(lags)."""
    exog = as_list(exog)
    lg = lagged(df.select(order_col, *[F.col(quote(c)).cast("double").alias(c) for c in [e] + exog]), e, order_col, lags)
    lag_cols = [f"lag{k}_{e}" for k in range(1, lags + 1)]
    return _lagrange(df, linear.moments(lg.fillna(0.0, subset=lag_cols), e, exog + lag_cols), lags)


def vif(df: DataFrame, cols) -> DataFrame:
    """Variance inflation factors over the complete rows, one per numeric column and per
    level of a categorical one; infinite where a column is a combination of others, NULL for a
    constant. One aggregate; the k x k algebra is local."""
    m = linear.moments(df, F.lit(0.0), as_list(cols))
    rows = [(linear.slot_name(s), v) for s, v in zip(m.slots, linear.inflation(m))]
    return df.sparkSession.createDataFrame(rows, "column string, vif double")


def linear_diagnostics(df: DataFrame, label: str, features) -> DataFrame:
    """Per-coefficient t / p values of an OLS fit; R^2, adjusted R^2, MSE, RMSE, MAE and
    the F test that all slopes are zero. Features are numbers or categories (one term per level
    but the first). A term that is constant or a combination of others has NULLs, a label that
    does not vary no R^2, and a fit without residual degrees of freedom no t, p and F."""
    features, spark = as_list(features), df.sparkSession
    m = linear.moments(df, label, features)
    model = linear.fit(m)
    k, rest = len(model.kept), m.n - len(model.kept) - 1
    sse = mae = None
    if m.n:
        off = F.col(quote(label)).cast("double") - linear.predicted(model, df)
        sse, mae = df.dropna(subset=[label, *features]).select(off.alias("off")).agg(F.sum(F.col("off") ** 2), F.avg(F.abs("off"))).first()
    total = float(m.cross[-1, -1]) if m.n else 0.0
    r2 = 1 - sse / total if total > 0 else None
    noise = sse / rest if m.n and rest > 0 else None
    place = {j: i for i, j in enumerate(model.kept.tolist())}
    spread = [model.inverse[place[j], place[j]] if j in place else None for j in range(len(m.slots))]
    centre = m.mean[model.kept]
    spread.append(1 / m.n + float(centre @ model.inverse @ centre) if m.n else None)
    rows = []
    for name, b, v in zip([*map(linear.slot_name, m.slots), "intercept"], [*model.beta.tolist(), model.intercept], spread):
        t = b / math.sqrt(noise * v) if noise and v is not None else None
        rows.append((name, None if v is None else b, t, None if t is None else t * t))
    f = r2 / k / ((1 - r2) / rest) if r2 is not None and k and rest > 0 and r2 < 1 else None
    fixed = (r2, None if r2 is None or rest <= 0 else 1 - (1 - r2) * (m.n - 1) / rest, None if sse is None else sse / m.n,
             None if sse is None else math.sqrt(sse / m.n), mae, f)
    schema = "term string, coefficient double, t_value double, t2 double, r2 double, r2_adj double, mse double, rmse double, mae double, f_value double, k int, rest long, one int"
    out = spark.createDataFrame([(*r, *fixed, k, max(rest, 0), 1) for r in rows], schema)
    out = with_p_value(with_p_value(out, "f", "t2", "one", "rest"), "f", "f_value", "k", "rest", out="f_p_value")
    return out.select("term", "coefficient", "t_value", "p_value", "r2", "r2_adj", "mse", "rmse", "mae", "f_value", "f_p_value")


# ---------------------------------------------------------------------------
# Univariate F statistics behind the feature selectors
# ---------------------------------------------------------------------------

def anova_f(df: DataFrame, label: str, features) -> DataFrame:
    """One-way ANOVA F of each continuous feature across the label's classes.

    One grouped aggregate (count, mean and variance per class, Spark's stable moments), then
    a tiny one over classes, with means taken from the least class mean so that a large
    common mean cancels nothing."""
    features = as_list(features)
    parts, shifted, tot, rows = [], {}, [], []
    for i, c in enumerate(features):
        x = F.col(quote(c)).cast("double")
        parts += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.var_pop(x).alias(f"v{i}")]
        shifted[f"d{i}"] = F.col(f"a{i}") - F.min(f"a{i}").over(Window.partitionBy())
        n, d = F.col(f"n{i}"), F.col(f"d{i}")
        tot += [F.sum(n).alias(f"N{i}"), F.sum(n * d).alias(f"S{i}"), F.sum(n * d * d).alias(f"B{i}"),
                F.sum(n * F.col(f"v{i}")).alias(f"W{i}"), F.count_if(n > 0).alias(f"K{i}")]
        N, S, B, W, K = (F.col(f"{p}{i}") for p in "NSBWK")
        between = F.try_divide(B - F.try_divide(S * S, N), K - 1)
        rows.append(F.struct(F.lit(c).alias("feature"), F.try_divide(between, F.try_divide(W, N - K)).alias("f_value"),
                             (K - 1).cast("double").alias("df1"), (N - K).cast("double").alias("df2")))
    g = df.filter(F.col(quote(label)).isNotNull()).groupBy(quote(label)).agg(*parts)
    out = g.withColumns(shifted).agg(*tot).select(F.inline(F.array(*rows)))
    return with_p_value(out, "f", "f_value", "df1", "df2")


def f_regression(df: DataFrame, label: str, features) -> DataFrame:
    """F statistic of a simple regression of the label on each feature:
    F = r^2 / (1 - r^2) * (n - 2) with r the Pearson correlation over complete pairs; NULL
    where feature or label is constant."""
    features = as_list(features)
    y = F.col(quote(label)).cast("double")
    parts = []
    for i, c in enumerate(features):
        x = F.col(quote(c)).cast("double")
        parts += [corr_or_null(x, y).alias(f"r{i}"), F.count(F.when(x.isNotNull() & y.isNotNull(), 1)).alias(f"n{i}")]
    t = df.agg(*parts)
    rows = [F.struct(F.lit(c).alias("feature"),
                     (F.try_divide(F.col(f"r{i}") ** 2, 1 - F.col(f"r{i}") ** 2) * (F.col(f"n{i}") - 2)).alias("f_value"),
                     F.lit(1.0).alias("df1"), (F.col(f"n{i}") - 2).cast("double").alias("df2"))
            for i, c in enumerate(features)]
    out = t.select(F.inline(F.array(*rows)))
    return with_p_value(out, "f", "f_value", "df1", "df2")
