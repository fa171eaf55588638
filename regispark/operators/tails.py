"""Tail probabilities of already-aggregated statistics (one row per test or feature).

The special functions are those of the math library that Spark itself ships; where degrees
of freedom are so many that its logarithms lose digits, normal and chi-square limits with
their next-order terms take over. A series that does not converge raises there.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, types as T

#: Degrees of freedom above which the limits are used.
LARGE = 1e7


def _special(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.commons.math3.special


def _normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def chi2_sf(spark: SparkSession, stat: float, dof: float) -> float:
    """P(X >= stat) for X ~ chi-square(dof); NaN where there are no degrees of freedom."""
    if math.isnan(stat) or not dof > 0:
        return math.nan
    if stat <= 0:
        return 1.0
    if math.isinf(stat):
        return 0.0
    if dof <= LARGE:
        return float(_special(spark).Gamma.regularizedGammaQ(dof / 2.0, stat / 2.0))
    spread = 2.0 / (9.0 * dof)  # the cube root is nearly normal
    return _normal_sf((math.expm1(math.log1p((stat - dof) / dof) / 3.0) + spread) / math.sqrt(spread))


def f_sf(spark: SparkSession, stat: float, d1: float, d2: float) -> float:
    """P(X >= stat) for X ~ F(d1, d2); NaN where there are no degrees of freedom."""
    if math.isnan(stat) or not (d1 > 0 and d2 > 0):
        return math.nan
    if stat <= 0:
        return 1.0
    if math.isinf(stat):
        return 0.0
    if max(d1, d2) <= LARGE:
        return float(_special(spark).Beta.regularizedBeta(d2 / (d2 + d1 * stat), d2 / 2.0, d1 / 2.0))
    if d1 > d2:
        return 1.0 - f_sf(spark, 1.0 / stat, d2, d1)
    if d1 <= 1e-4 * d2:  # chi-square(d1) / d1, and what the spread of the denominator adds
        y = d1 * stat
        log_density = (d1 / 2 - 1) * math.log(y / 2) - y / 2 - math.lgamma(d1 / 2) - math.log(2.0) if d1 <= LARGE else -math.inf
        return min(1.0, max(0.0, chi2_sf(spark, y, d1) + math.exp(log_density) * y * (y / 2 - d1 / 2 + 1) / d2))
    root, a, b = math.exp(math.log(stat) / 3.0), 2.0 / (9.0 * d1), 2.0 / (9.0 * d2)
    return _normal_sf(((1 - b) * root - (1 - a)) / math.sqrt(a + b * root * root))


def with_p_value(tests: DataFrame, kind: str, stat: str, *dof: str, out: str = "p_value") -> DataFrame:
    """``tests``, one row per test and so a handful, with the p-value of the column ``stat``;
    NULL where the statistic or its degrees of freedom are not defined."""
    spark, tail = tests.sparkSession, {"chi2": chi2_sf, "f": f_sf}[kind]
    schema = T.StructType([*tests.schema.fields, T.StructField(out, T.DoubleType())])
    rows = []
    for r in tests.collect():
        given = [r[c] for c in (stat, *dof)]
        p = math.nan if any(v is None for v in given) else tail(spark, *map(float, given))
        rows.append((*r, None if math.isnan(p) else p))
    return spark.createDataFrame(rows, schema)
