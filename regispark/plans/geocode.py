"""G1: offline geocoding by a chain of reference lookups.

The original geocoded each address with a per-row web call and fell back to the postal
code when both coordinates were NULL. Here each level is a reference table joined by its
key (broadcast where the caller says so); the first level with both coordinates wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .._util import as_list, fresh, quote
from ..operators.joins import spread_null_left_join


def geo_fallback(df: DataFrame, levels: list, lat: str = "LAT", lon: str = "LON", level_col: str = "GEO_LEVEL",
                 broadcast: bool | None = None) -> DataFrame:
    """``levels`` = [(name, table, fact_keys, table_keys, lat_col, lon_col), ...] in priority order.

    Adds ``lat``/``lon`` (struct-level fallback: a level counts only when both coordinates
    are present) and ``level_col`` = name of the level used (NULL when none matched).
    """
    picks = []
    for i, (name, table, fact_keys, table_keys, t_lat, t_lon) in enumerate(levels):
        fact_keys, table_keys = as_list(fact_keys), as_list(table_keys)
        ks = [fresh(df.columns, f"__g{i}_k{j}") for j in range(len(table_keys))]
        pt = fresh(df.columns, f"__g{i}_pt")
        t = table.select(*[F.col(quote(k)).alias(a) for k, a in zip(table_keys, ks)],
                         F.struct(F.col(quote(t_lat)).cast("double").alias("lat"),
                                  F.col(quote(t_lon)).cast("double").alias("lon")).alias(pt))
        # one row per key; the greatest pair, which prefers present coordinates
        t = t.groupBy(*ks).agg(F.max(pt).alias(pt))
        # an aggregate: not probed, AQE sizes it at run time
        keyed = df.withColumns({k: F.col(quote(fk)) for k, fk in zip(ks, fact_keys)})
        df = (keyed.join(F.broadcast(t), ks, "left") if broadcast else spread_null_left_join(keyed, t, ks)).drop(*ks)
        picks.append((name, pt))
    chosen = None
    for name, pt in reversed(picks):
        ok = F.col(f"{pt}.lat").isNotNull() & F.col(f"{pt}.lon").isNotNull()
        here = F.struct(F.col(f"{pt}.lat").alias("lat"), F.col(f"{pt}.lon").alias("lon"), F.lit(name).alias("level"))
        chosen = F.when(ok, here) if chosen is None else F.when(ok, here).otherwise(chosen)
    df = df.withColumn("__geo", chosen)
    return df.withColumns({lat: F.col("__geo.lat"), lon: F.col("__geo.lon"), level_col: F.col("__geo.level")}) \
        .drop("__geo", *[pt for _, pt in picks])
