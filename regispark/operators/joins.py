"""Join operators.

Dimension lookups broadcast the dimension only after checking its size with a bounded
probe (``limit(max_rows + 1).count()`` reads at most ``max_rows + 1`` rows); a larger
dimension falls back to a shuffle join that AQE may still convert at runtime. The probe
is meant for dimension *scans*: for a derived dimension (an aggregate) pass
``broadcast=False`` so it is computed once and AQE's runtime size check decides. Fact-fact
joins shuffle on the key; hot keys are split by AQE's skew-join rule, or explicitly by
salting (``salt_buckets``) when one key may hold a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .._util import as_list, fresh, quote

# Upper bound on dimension rows that may be broadcast (a few MB for code tables).
BROADCAST_MAX_ROWS = 2_000_000
# Upper bound on their size, as JSON text, so that wide rows count for what they weigh.
BROADCAST_MAX_BYTES = 256 << 20


def fits_broadcast(dim: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``dim`` has at most ``max_rows`` rows and ``max_bytes`` bytes (bounded probe)."""
    weight = F.octet_length(F.to_json(F.struct(*[F.col(quote(c)) for c in dim.columns])))
    rows, size = dim.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(weight)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def maybe_broadcast(dim: DataFrame, broadcast: bool | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint when forced (``True``) or when the probe proves the size bound."""
    if broadcast is None:
        broadcast = fits_broadcast(dim, max_rows)
    return F.broadcast(dim) if broadcast else dim


NULL_SPREAD_BUCKETS = 1024


def spread_null_left_join(df: DataFrame, right: DataFrame, keys: list, buckets: int = NULL_SPREAD_BUCKETS) -> DataFrame:
    """Left equi-join on same-named ``keys`` (USING semantics) for a shuffle join.

    NULL keys never match, but a hash shuffle sends every NULL-key row to ONE task. Each
    left row gets a salt: 0 when its keys are all present, a row hash otherwise; the right
    side has salt 0. Joining on (keys, salt) spreads NULL-key rows over ``buckets`` tasks
    and leaves the result unchanged, with a single scan of ``df``.
    """
    salt = fresh(df.columns + right.columns, "__null_salt")

    def any_null():
        cond = None
        for k in keys:
            term = F.col(quote(k)).isNull()
            cond = term if cond is None else cond | term
        return cond

    left = df.withColumn(salt, F.when(any_null(), F.pmod(F.xxhash64(*[F.col(quote(c)) for c in df.columns]),
                                                         F.lit(buckets)) + 1).otherwise(F.lit(0)).cast("long"))
    # Right salt: 0 for real keys, -1 for NULL keys (which never match). It must depend on
    # the row: a literal 0 would be folded into a filter and drop out of the shuffle keys.
    r = right.withColumn(salt, F.when(any_null(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
    return left.join(r, keys + [salt], "left").drop(salt)


def lookup(df: DataFrame, dim: DataFrame, key, drop_key: bool = True, how: str = "left",
           broadcast: bool | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Equi-join a dimension on code column(s) of the same name, then drop the code.

    Codes are matched exactly as strings (leading zeros matter). With a unique dimension
    key a left lookup keeps the fact's row count. A dimension above the broadcast bound is
    joined by shuffle with NULL codes spread (:func:`spread_null_left_join`).
    """
    keys = as_list(key)
    if broadcast is None:
        broadcast = fits_broadcast(dim, max_rows)
    if broadcast:
        out = df.join(F.broadcast(dim), keys, how)
    elif how == "left":
        out = spread_null_left_join(df, dim, keys)
    else:
        out = df.join(dim, keys, how)
    return out.drop(*keys) if drop_key else out


def lookup_roles(df: DataFrame, dim: DataFrame, dim_key: str, dim_value: str, roles: dict,
                 drop_key: bool = True, broadcast: bool | None = None) -> DataFrame:
    """The same dimension joined once per role: ``roles = {fact_code_col: output_label_col}``."""
    small = dim.select(dim_key, dim_value)
    if broadcast is None:
        broadcast = fits_broadcast(small)
    for fact_col, out_col in roles.items():
        k = fresh(df.columns, "__role_key")
        labels = small.select(F.col(quote(dim_key)).alias(k), F.col(quote(dim_value)).alias(out_col))
        if broadcast:
            df = df.join(F.broadcast(labels), F.col(quote(fact_col)) == F.col(k), "left").drop(k)
        else:
            df = spread_null_left_join(df.withColumn(k, F.col(quote(fact_col))), labels, [k]).drop(k)
        if drop_key:
            df = df.drop(fact_col)
    return df


def _check_salted(how: str) -> None:
    if how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError(f"a {how!r} join cannot be salted: it would emit replicated rows as unmatched")


def salted_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
                salt_buckets: int = 16) -> DataFrame:
    """Equi-join that spreads every key of ``big`` over ``salt_buckets`` tasks.

    ``big`` rows get a salt from a hash of the whole row (deterministic across retries);
    ``small`` rows are replicated once per salt. Result equals the plain join. A replicated
    row must not appear unmatched, so only joins that keep ``big`` rows (inner, left) are possible.
    """
    _check_salted(how)
    salt = fresh(big.columns + small.columns, "__salt")
    b = big.withColumn(salt, F.pmod(F.xxhash64(*[F.col(quote(c)) for c in big.columns]), F.lit(salt_buckets)))
    s = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    cond = (b[big_key] == s[small_key]) & (b[salt] == s[salt])
    return b.join(s, cond, how).drop(b[salt]).drop(s[salt])


#: Rows of one key that a task should join at most.
ROWS_PER_TASK = 2_000_000
#: Keys the heavy-hitter sketch follows, at least and at most.
TRACKED = (1_000, 1_000_000)


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> list[tuple]:
    """(key, tasks) of the keys of more than ``rows_per_task`` rows, and how many tasks they need.

    One pass over the key column with a mergeable heavy-hitter sketch: no shuffle of keys, no
    full count. The sketch follows eight times as many keys as can be hot at all, so none of
    them is missed below its bound of a million; the list has at most rows / ``rows_per_task`` entries."""
    present = df.select(F.col(quote(key)).alias("k")).where("k is not null")
    rows = present.count()
    if rows <= rows_per_task:
        return []
    tracked = min(TRACKED[1], max(TRACKED[0], 8 * rows // rows_per_task))
    top = present.agg(F.expr(f"approx_top_k(k, {tracked}, {tracked})").alias("top")).first().top
    return [(r["item"], -(-r["count"] // rows_per_task)) for r in top if r["count"] > rows_per_task]


def skew_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str, how: str = "inner",
              salt_buckets: int = 16, keys=None, rows_per_task: int = ROWS_PER_TASK, hot_from: DataFrame | None = None) -> DataFrame:
    """Equi-join that splits only the hot keys of ``big``.

    Hot keys are given as ``keys`` (each then takes ``salt_buckets`` tasks) or found by
    :func:`hot_keys` in ``hot_from`` (``big`` unless given; the raw key column of a costly flow
    saves running it twice), each taking one task per ``rows_per_task`` rows. They get a row-hash
    salt on ``big`` and their ``small`` rows are replicated once per salt; all other keys keep
    salt 0 and are joined as usual. NULL keys of ``big``, which match nothing, are spread over
    ``salt_buckets`` tasks. Only inner and left joins can be salted."""
    _check_salted(how)
    found = [(k, salt_buckets) for k in keys] if keys is not None else hot_keys(big if hot_from is None else hot_from, big_key, rows_per_task)
    names = big.columns + small.columns
    salt, hot, tasks = fresh(names, "__salt"), fresh(names, "__hot"), fresh(names, "__tasks")
    kind = big.schema[big_key].dataType.simpleString()
    table = F.broadcast(big.sparkSession.createDataFrame([(k, int(n)) for k, n in found], f"`{hot}` {kind}, `{tasks}` int"))
    spread = F.when(F.col(quote(big_key)).isNull(), F.lit(salt_buckets)).otherwise(F.coalesce(tasks, F.lit(1)))
    row = F.xxhash64(*[F.col(quote(c)) for c in big.columns])
    b = big.join(table, F.col(quote(big_key)) == F.col(hot), "left").withColumn(salt, F.pmod(row, spread)).drop(hot, tasks)
    s = small.join(table, F.col(quote(small_key)) == F.col(hot), "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(tasks, F.lit(1)).cast("long") - 1))).drop(hot, tasks)
    cond = (b[big_key] == s[small_key]) & (b[salt] == s[salt])
    return b.join(s, cond, how).drop(b[salt]).drop(s[salt])


def join_companies(companies: DataFrame, establishments: DataFrame, company_key: str = "CNPJ",
                   establishment_key: str = "CNPJ_BASICO", how: str = "inner",
                   salt_buckets: int | None = None, rows_per_task: int = ROWS_PER_TASK,
                   hot_from: DataFrame | None = None) -> DataFrame:
    """Company (one row per key) x establishments (1:N), keeping both keys.

    Default is a shuffle join left to AQE (skew splitting on). ``salt_buckets`` splits the
    hot company keys (those of more than ``rows_per_task`` establishments, found in
    ``hot_from`` or the establishments) explicitly, replicating only those companies' rows,
    and spreads NULL keys over that many tasks.
    """
    if salt_buckets:
        kinds = {"inner": (False, False), "left": (True, False), "left_outer": (True, False), "right": (False, True),
                 "right_outer": (False, True), "full": (True, True), "outer": (True, True), "full_outer": (True, True)}
        if how not in kinds:
            raise ValueError(f"a {how!r} join cannot be salted")
        keep_companies, keep_establishments = kinds[how]
        # establishments are the salted side; companies without any come from an anti join
        out = skew_join(establishments, companies, establishment_key, company_key,
                        "left" if keep_establishments else "inner", salt_buckets, None, rows_per_task, hot_from)
        out = out.select(*[companies[c] for c in companies.columns], *[establishments[c] for c in establishments.columns])
        if keep_companies:
            used = establishments.select(F.col(quote(establishment_key)).alias("__used")).distinct()
            alone = companies.join(used, companies[company_key] == F.col("__used"), "left_anti")
            alone = alone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in establishments.schema.fields])
            out = out.union(alone)
        return out
    return companies.join(establishments, companies[company_key] == establishments[establishment_key], how)


def lookup_ranges(df: DataFrame, ranges: DataFrame, fact_keys: list, range_keys: list, how: str = "left",
                  broadcast: bool | None = None) -> DataFrame:
    """Composite left lookup; both sides cast to int explicitly (no implicit cast)."""
    if broadcast is None:
        broadcast = fits_broadcast(ranges)
    if not broadcast and how == "left":
        temps = [fresh(df.columns + ranges.columns, f"__range_key{i}") for i in range(len(fact_keys))]
        left = df.withColumns({t: F.col(quote(k)).try_cast("int") for t, k in zip(temps, fact_keys)})
        right = ranges.withColumns({t: F.col(quote(k)).try_cast("int") for t, k in zip(temps, range_keys)})
        return spread_null_left_join(left, right, temps).drop(*temps)
    r = F.broadcast(ranges) if broadcast else ranges
    cond = None
    for fk, rk in zip(fact_keys, range_keys):
        term = df[fk].try_cast("int") == r[rk].try_cast("int")
        cond = term if cond is None else cond & term
    return df.join(r, cond, how)


def attach(df: DataFrame, extra: DataFrame, key: str, assert_unique: bool = False) -> DataFrame:
    """Left-join derived columns back by key (fact-to-fact, shuffle join with NULL keys
    spread over many tasks); ``assert_unique`` refuses fan-out."""
    if assert_unique:
        dup = extra.groupBy(key).count().filter(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError(f"key {key!r} repeats in the attached table")
    return spread_null_left_join(df, extra, [key])


def ratio_to_reference(counts: DataFrame, ref: DataFrame, key: str, num: str, den: str, out: str = "ratio",
                       digits: int = 2, scale: float = 1.0, broadcast: bool | None = None) -> DataFrame:
    """Join a reference (e.g. population) by key, drop unmatched, ratio desc."""
    j = counts.join(maybe_broadcast(ref, broadcast), key, "left").dropna(subset=[num, den])
    return j.withColumn(out, F.round(F.try_divide(F.lit(scale) * F.col(num).cast("double"), F.col(den).cast("double")), digits)) \
        .orderBy(F.desc(out), F.asc(key))
