"""Mixing sources to target weights along a time-varying curriculum.

Every source follows a schedule: a piecewise linear sampling rate over training time 0..1.
The integral of the schedule is the source's weight. Targets share ``budget`` times all
words by weight; a target stops at ``repeats`` times its source's words and the excess goes
to the others by weight. Inside a source documents queue in a fixed pseudo-random order (the
MD5 of the id), once per repeat; a document is taken while the middle of its copy lies
below the target. The cumulative demand of the source up to time t is its target times the
share of the schedule's integral up to t; inverting it at the middle of a copy gives that
copy's training position, and the mix is range-sorted by position.

No step gathers a source in one task: the queue's prefix sums are taken inside buckets of
(source, hash range), whose number follows the source's row count, plus the sums of the
buckets before. The result does not depend on the number of buckets.

Defined results: a null or blank text has 0 words and takes 0; a null source is a source
of its own, ordered last; equal rows are separate documents; an empty table gives no rows;
texts are counted whole and documents are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from regispark._util import fresh
from regispark.llm.common import WORD, partitions, staged

Curve = list[tuple[float, float]]

#: Schedules dealt to the sources by code point, repeating; they integrate to 5, 2 and 1:
#: one that fades out, one that peaks in the middle, one that grows.
CURVES: list[Curve] = [[(0.0, 7.5), (1.0, 2.5)], [(0.0, 1.0), (0.5, 3.0), (1.0, 1.0)], [(0.0, 0.0), (1.0, 2.0)]]
#: Sources up to this many are broadcast to the rows (a few MB); more are joined by shuffle.
BROADCAST_SOURCES = 50_000


def weight(curve: Curve) -> float:
    """The integral of a schedule."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(curve, curve[1:]))


def _number(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def time_sql(share: str, curve: Curve) -> str:
    """SQL for the time at which ``share`` (0..1) of the schedule's integral is reached."""
    y = f"({share}) * {_number(weight(curve))}"
    cases, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(curve, curve[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        rest = f"greatest({y} - {_number(done)}, {_number(0.0)})"
        bend = 2 * (w1 - w0) / (t1 - t0)
        root = f"sqrt(greatest({_number(w0 * w0)} + {_number(bend)} * {rest}, {_number(0.0)}))"
        inner = f"CASE WHEN {_number(w0)} + {root} = 0 THEN {_number(t0)} ELSE {_number(t0)} + 2 * {rest} / ({_number(w0)} + {root}) END"
        if area > 0:
            cases.append(f"WHEN {y} <= {_number(done + area)} THEN {inner}")
        done += area
    return f"CASE {' '.join(cases)} ELSE {_number(curve[-1][0])} END"


def targets(sizes: DataFrame, curves: list[Curve], budget: float, repeats: int) -> DataFrame:
    """(source, source_size, rows, class, target) from (source, source_size, rows), one row
    per source. The windows run over sources, never over documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(weight(c))) for c in curves])
    s = sizes.withColumn("class", (F.row_number().over(order) - 1) % len(curves))
    s = s.withColumn("weight", F.element_at(weights, F.col("class") + 1)).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    everyone = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everyone) * F.lit(float(budget)))
    # by cap per weight: a source is full if it is below the level that is left for it
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    s = s.withColumn("full", F.col("cap") <= F.col("weight") * level)
    full = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everyone), F.lit(0.0))
    rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everyone)
    return s.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * (F.col("total") - full) / rest)).select(
        "source", "source_size", "rows", "class", "target")


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("source").alias("source"), size_of("text").alias("size"), queue_key("doc_id").alias("key"))


def size_of(text: str):
    """The number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def queue_key(doc_id: str):
    """60 bits of the MD5 of the id: the order in which a source's documents queue."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def plan(docs: DataFrame, narrow: DataFrame, curves: list[Curve] = CURVES, budget: float = 1.5, repeats: int = 2) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, size, key and any other columns) with
    source_size, target, taken, times and positions (array of double, one per copy taken).
    ``narrow`` holds the same rows, without the other columns, written once."""
    spark = docs.sparkSession
    sources = staged(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), curves, budget, repeats))
    n_sources, n_rows = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    per_bucket = max(1, min(100_000, n_rows // (4 * partitions(spark))))
    sources = sources.withColumnRenamed("source", "__source").withColumn("buckets", F.ceil(F.col("rows") / F.lit(per_bucket)))
    small = F.broadcast if n_sources <= BROADCAST_SOURCES else (lambda df: df)
    bucket = F.floor(F.col("key") / F.lit(float(1 << 60)) * F.col("buckets")).alias("bucket")

    def placed(df):
        return df.join(small(sources), F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "rows").withColumn("bucket", bucket).drop("buckets")

    sums = placed(narrow).groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(sums.select(F.col("source").alias("__source"), F.col("bucket").alias("__bucket"),
                                F.coalesce(F.sum("words").over(by_bucket), F.lit(0)).alias("start")))
    # about 4 buckets a partition and one more a source: bounded by the settings, not by the data
    small_starts = F.broadcast if n_sources + 4 * partitions(spark) + n_rows // 100_000 <= BROADCAST_SOURCES else (lambda df: df)
    rows = placed(docs).join(small_starts(starts), F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")))
    queue = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("middle", F.col("start") + F.coalesce(F.sum("size").over(queue), F.lit(0)) + F.col("size") / F.lit(2.0))
    copies = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda e: F.col("middle") + e * F.col("source_size")), lambda m: m < F.col("target"))
    rows = rows.withColumn("copies", copies)
    times = [F.transform("copies", _timer(c)) for c in curves]
    positions = F.coalesce(*[F.when(F.col("class") == i, t) for i, t in enumerate(times)])
    return rows.withColumn("positions", positions).withColumn("times", F.size("copies").cast("long")).withColumn(
        "taken", F.col("times") * F.col("size")).drop("__source", "__bucket", "bucket", "start", "middle", "copies", "class", "key")


def _timer(curve: Curve):
    return lambda middle: _time(middle / F.col("target"), curve)


def _time(share, curve: Curve):
    """``time_sql`` as a column expression, operation by operation the same."""
    total, done, cases = F.lit(float(weight(curve))), 0.0, None
    y = share * total
    for (t0, w0), (t1, w1) in zip(curve, curve[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        rest = F.greatest(y - F.lit(done), F.lit(0.0))
        bend = 2 * (w1 - w0) / (t1 - t0)
        below = F.lit(float(w0)) + F.sqrt(F.greatest(F.lit(float(w0 * w0)) + F.lit(float(bend)) * rest, F.lit(0.0)))
        inner = F.when(below == 0, F.lit(float(t0))).otherwise(F.lit(float(t0)) + F.lit(2.0) * rest / below)
        if area > 0:
            cases = F.when(y <= F.lit(done + area), inner) if cases is None else cases.when(y <= F.lit(done + area), inner)
        done += area
    return F.lit(float(curve[-1][0])) if cases is None else cases.otherwise(F.lit(float(curve[-1][0])))


def mixed(docs: DataFrame, curves: list[Curve] = CURVES, budget: float = 1.5, repeats: int = 2) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, times and position
    (of the first copy; null if none is taken), range-sorted by position."""
    narrow = staged(_narrow(docs))
    out = plan(narrow, narrow, curves, budget, repeats)
    return out.select("doc_id", "size", "source_size", "target", "taken", "times", F.try_element_at("positions", F.lit(1)).alias("position")).orderBy(
        F.col("position").asc_nulls_last(), "doc_id")


def sequence(docs: DataFrame, curves: list[Curve] = CURVES, budget: float = 1.5, repeats: int = 2) -> DataFrame:
    """The training sequence: every copy taken, with the document's columns and
    ``position`` and ``copy`` (1, 2, ...; fresh names if taken), range-sorted by position."""
    narrow = staged(_narrow(docs))
    payload = F.struct(*[F.col(c) for c in docs.columns]).alias("payload")
    rows = plan(docs.select("doc_id", "source", size_of("text").alias("size"), queue_key("doc_id").alias("key"), payload), narrow, curves, budget, repeats)
    position, copy = fresh(docs.columns, "position"), fresh(docs.columns, "copy")
    out = rows.select(*[F.col("payload")[c].alias(c) for c in docs.columns], F.posexplode("positions").alias("copy__", position))
    out = out.withColumn(copy, F.col("copy__") + 1).drop("copy__")
    return out.repartitionByRange(partitions(docs.sparkSession), position, "doc_id").sortWithinPartitions(position, "doc_id", copy)


def oracle(documents: str = "documents", budget: float = 1.5) -> str:
    """DuckDB SQL for ``mixed`` with the default schedules and two repeats."""
    cases = " ".join(f"WHEN class = {i} THEN {time_sql('middle / target', c)}" for i, c in enumerate(CURVES))
    weights = ", ".join(repr(float(weight(c))) for c in CURVES)
    return f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key FROM {documents}),
 s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
 s1 AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(CURVES)} AS class,
               2.0::DOUBLE * source_size AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * {budget}::DOUBLE AS total FROM s0),
 s2 AS (SELECT *, ([{weights}]::DOUBLE[])[class + 1] AS weight FROM s1),
 s3 AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM s2),
 s4 AS (SELECT *, cap <= weight * lvl AS filled FROM s3),
 s AS (SELECT source, source_size, class, CASE WHEN filled THEN cap ELSE
        weight * (total - coalesce(sum(CASE WHEN filled THEN cap END) OVER (), 0)) / sum(CASE WHEN NOT filled THEN weight END) OVER () END AS target FROM s4),
 q AS (SELECT d.doc_id, d.size, s.source_size, s.class, s.target,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + d.size / 2.0::DOUBLE AS middle
       FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
 t AS (SELECT *, CAST((middle < target)::INT + (middle + source_size < target)::INT AS BIGINT) AS times FROM q)
SELECT doc_id, size, source_size, target, times * size AS taken, times, CASE WHEN times > 0 THEN CASE {cases} END END AS position FROM t"""
