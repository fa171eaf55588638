"""Projection operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .._util import fresh, quote


def select_as(df: DataFrame, mapping: dict | list) -> DataFrame:
    """subset/reorder columns; a dict renames (source -> output)."""
    if isinstance(mapping, dict):
        return df.select(*[F.col(quote(src)).alias(dst) for src, dst in mapping.items()])
    return df.select(*[F.col(quote(c)) for c in mapping])


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename columns in one projection."""
    return df.withColumnsRenamed(mapping)


def derive(df: DataFrame, **cols) -> DataFrame:
    """add/replace several columns in a single projection."""
    return df.withColumns(cols)


def drop_cols(df: DataFrame, *names: str, compat: bool = False) -> DataFrame:
    """Drop columns by exact name.

    Spark's ``drop("uf")`` is case-insensitive under the default resolver and also
    removes ``UF``; the default here drops exact-case names only. ``compat=True`` keeps the
    case-insensitive behaviour.
    """
    if compat:
        return df.drop(*names)
    wanted = set(names)
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*[F.col(quote(c)) for c in df.columns if c not in wanted])
    # Names differing only in case: address columns by position.
    positional = df.toDF(*[f"__c{i}" for i in range(len(df.columns))])
    return positional.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(df.columns) if c not in wanted])


def decimal_comma(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    """Decimal-comma strings -> numbers; unparseable -> NULL."""
    return df.withColumns({c: F.regexp_replace(F.col(quote(c)), ",", ".").try_cast(dtype) for c in cols})


def row_id(df: DataFrame, name: str = "row_id", key_cols=None) -> DataFrame:
    """Row id.

    Without ``key_cols``: ``monotonically_increasing_id`` (unique, not contiguous, depends on
    the layout). With ``key_cols``: a 64-bit hash of the key — independent of layout and
    reruns, unique when the key is.
    """
    if key_cols:
        return df.withColumn(name, F.xxhash64(*[F.col(quote(c)) for c in key_cols]))
    return df.withColumn(name, F.monotonically_increasing_id())


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to an explicit schema (cast with NULL on failure, missing -> NULL)."""
    present = set(df.columns)
    return df.select(*[
        (F.col(quote(f.name)).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def drop_ml_columns(df: DataFrame, response: str) -> DataFrame:
    """P10: remove label/index columns left over by a previous feature step."""
    return df.drop("label", f"{response}_index", f"old_{response}_index")


def split_columns(df: DataFrame, response: str | None = None) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names by Spark type; ``bigint`` counts as numeric."""
    cat, num = [], []
    for f in df.schema.fields:
        if f.name == response:
            continue
        if isinstance(f.dataType, T.NumericType):
            num.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            cat.append(f.name)
    return cat, num


def global_row_number(df: DataFrame, order_cols, name: str = "row_number", num_partitions: int | None = None) -> DataFrame:
    """P8 (stable, contiguous): 1-based position of each row in ``order_cols`` order — the
    result of ``row_number() over (order by ...)`` without funnelling every row into one
    task. Rows are cut into deterministic range buckets (see ``ordering``); a row's number
    is its ``row_number`` inside its bucket plus the row counts of the earlier buckets (a
    table with one row per bucket, broadcast). Ties in ``order_cols`` are broken by a row
    hash, so the numbering is reproducible.
    """
    from pyspark.sql import Window

    from .ordering import tiebreak, with_buckets

    cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tb, bucket, place, before = (fresh([*df.columns, name], c) for c in ("__tb", "__bucket", "__pos", "__before"))
    base = df.withColumn(tb, tiebreak(df))
    order = [F.col(quote(c)) for c in cols] + [F.col(tb)]
    b, nb = with_buckets(base, order, n, bucket)
    pos = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    numbered = b.repartitionByRange(nb, bucket).withColumn(place, pos)
    counts = b.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"))  # partial agg, tiny shuffle
    offsets = counts.select(bucket, F.coalesce(
        F.sum("rows").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    # one row per bucket: the broadcast is bounded by the bucket count
    j = numbered.join(F.broadcast(offsets), bucket)
    return j.withColumn(name, F.col(before) + F.col(place)).drop(bucket, place, before, tb)
