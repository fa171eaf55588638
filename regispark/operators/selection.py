"""Exact discrete quantiles by selection in rounds.

The wanted rows and no others are found by narrowing cells around each rank:

1. the key and value columns are written once; every later pass reads that narrow copy, so
   the input (a join, a parse) is evaluated once;
2. a sketch per group proposes cuts, also written once, and one map-side aggregate counts the
   rows between them. That tells in which cell each rank lies and its place there, whatever
   the error of the sketch;
3. a cell of one value is its answer. The rows of a cell with at most :data:`CELL_VALUES`
   distinct values are aggregated by value and numbered. A larger cell becomes a group of the
   next round, which reads its rows only (about 3 in 10,000 per rank after the first round)
   and cuts them in 64.

No row is sorted or shuffled as such before the last step, a run of one hot value is one row
by then, and no task ever numbers more than one small cell. Cuts and ranks are joined by
the planner's choice: broadcast while their files are small, a skew-splitting shuffle beyond.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .._util import quote
from ..session import written

#: Accuracy of the sketches, and how far (in sketch errors) the first cuts reach around a rank.
ACCURACY, REACH = 10_000, 1.5
#: Cells of at most about so many distinct values are numbered.
CELL_VALUES = 1_000_000
#: Cells that a round after the first cuts a group into.
REFINE = 64
#: Rounds until cells are numbered whatever their size; each divides them by ``REFINE``.
ROUNDS = 8

_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType)


def _same(a: list[str], b: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(i).eqNullSafe(F.col(j)) for i, j in zip(a, b)])


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", extra: Column | None = None) -> DataFrame:
    """``left`` and ``right`` joined on equal ``keys`` (NULL equals NULL), kept from the left."""
    other = [f"{k}_r" for k in keys]
    on = _same(keys, other)
    out = left.join(right.withColumnsRenamed(dict(zip(keys, other))), on if extra is None else on & extra, how)
    return out if how == "left_semi" else out.drop(*other)


def _place(lo: int, hi: int) -> str:
    """The number of cuts below the value, between ``lo`` and ``hi``: log2 comparisons a row."""
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2
    return f"CASE WHEN v > cuts[{mid}] THEN {_place(mid + 1, hi)} ELSE {_place(lo, mid)} END"


def _cells(rows: DataFrame, group: list[str], at: list[float], cell: str) -> DataFrame:
    """``rows`` with the number of their cell between the cuts at the probabilities ``at``."""
    cuts = written(rows.groupBy(*group).agg(F.percentile_approx("v", at, ACCURACY).alias("cuts")), "cuts")
    placed = _joined(rows, cuts, group)
    return placed.select(*group, "v", F.expr(f"CASE WHEN v IS NOT NULL THEN {_place(0, len(at))} END").alias(cell))


def selected(df: DataFrame, keys: list[str], c: str, probs) -> DataFrame:
    """Rows (k0, k1, ..., p, value, n, total, least, most): per group of ``keys`` the
    ceil(p * n)-th smallest non-NULL value for each p, and on a row whose p is NULL the
    count, sum (numbers only), minimum and maximum. A group without values has NULLs."""
    kind = df.schema[c].dataType
    if not isinstance(kind, _ORDERED):
        raise TypeError(f"exact quantiles need numbers, dates or times; {c} is {kind.simpleString()}")
    group = [f"k{i}" for i in range(max(1, len(keys)))]
    named = [F.col(quote(k)) for k in keys] or [F.lit(0)]
    rows = written(df.select(*[k.alias(g) for k, g in zip(named, group)], F.col(quote(c)).alias("v")), "values")
    spread = REACH / ACCURACY
    at = sorted({min(1.0, max(0.0, float(p) + s * spread)) for p in probs for s in (-1, 1)})
    total = F.sum("v") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
    decimals = F.array(*[F.lit(Decimal(str(p))).cast("decimal(20,18)") for p in probs], F.lit(None).cast("decimal(20,18)"))
    wanted, found = None, []
    for turn in range(ROUNDS):
        cell = f"c{turn}"
        placed = _cells(rows, group, at, cell)
        measures = [F.count("v").alias("cnt"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.approx_count_distinct("v").alias("values")]
        counts = placed.groupBy(*group, cell).agg(*measures, *([total.alias("total")] if not turn else []))
        in_group = Window.partitionBy(*group)
        counts = counts.withColumn("end", F.sum("cnt").over(in_group.orderBy(F.asc_nulls_first(cell))))
        if not turn:
            counts = counts.withColumns({
                "n": F.sum("cnt").over(in_group), "total": F.sum("total").over(in_group) if isinstance(kind, T.NumericType) else F.col("total"),
                "least": F.min("lo").over(in_group), "most": F.max("hi").over(in_group),
                "first": F.row_number().over(in_group.orderBy(F.asc_nulls_first(cell)))})
            ranked = counts.withColumn("p", F.explode(decimals)).withColumn("rank", F.greatest(F.ceil(F.col("p") * F.col("n")).cast("long"), F.lit(1)))
            ranked = ranked.where("(p is null and first = 1) or (rank > end - cnt and rank <= end)")
        else:
            ranked = _joined(wanted, counts, group, extra=F.expr("rank > end - cnt and rank <= end"))
        stats = ["p", "n", "total", "least", "most"]
        ranked = written(ranked.select(*group, cell, *stats, (F.col("rank") - F.col("end") + F.col("cnt")).alias("rank"), "cnt", "lo", "hi", "values"), "ranks")
        found.append(ranked.where("p is null or lo <=> hi").select(
            *group[: len(named)], "p", F.when(F.col("p").isNotNull(), F.col("lo")).alias("value"), *stats[1:]))
        ranked = ranked.where("p is not null and not lo <=> hi")
        limit = CELL_VALUES if turn + 1 < ROUNDS else None
        small = ranked if limit is None else ranked.where(F.col("values") <= limit)
        here = [*group, cell]
        values = _joined(placed, small.select(*here).distinct(), here, "left_semi").groupBy(*here, "v").agg(F.count(F.lit(1)).alias("m"))
        values = values.withColumn("last", F.sum("m").over(Window.partitionBy(*here).orderBy("v")))
        found.append(_joined(small, values, here, extra=F.expr("rank <= last and rank > last - m")).select(
            *group[: len(named)], "p", F.col("v").alias("value"), *stats[1:]))
        if limit is None:
            break
        wide = ranked.where(F.col("values") > limit)
        if wide.isEmpty():
            break
        wanted = wide.select(*here, *stats, "rank")
        rows = written(_joined(placed, wide.select(*here).distinct(), here, "left_semi"), "values")
        group, at = here, [i / REFINE for i in range(1, REFINE)]
    return reduce(DataFrame.union, found)
