import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from regispark.operators import joins as J, profile as A, quality as D, projection as P, selection as Q, filters as FL
from conftest import rows


def test_lookup_keeps_row_count_with_unique_dimension(spark):
    fact = spark.createDataFrame([("01", 1), ("1", 2), ("02", 3), (None, 4)], "code string, v int")
    dim = spark.createDataFrame([("01", "ONE"), ("02", "TWO")], "code string, label string")
    out = J.lookup(fact, dim, "code")
    assert out.count() == fact.count()
    assert sorted(rows(out, "v", "label"), key=lambda r: r[0]) == [(1, "ONE"), (2, None), (3, "TWO"), (4, None)]
    assert "code" not in out.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_lookup_falls_back_without_broadcast_beyond_bound(spark):
    fact = spark.createDataFrame([("01", 1)], "code string, v int")
    dim = spark.createDataFrame([("01", "ONE"), ("02", "TWO")], "code string, label string")
    assert not J.fits_broadcast(dim, max_rows=1)
    out = J.lookup(fact, dim, "code", max_rows=1)
    assert rows(out, "v", "label") == [(1, "ONE")]


def test_lookup_roles(spark):
    fact = spark.createDataFrame([("A", "B")], "r1 string, r2 string")
    dim = spark.createDataFrame([("A", "alpha"), ("B", "beta")], "k string, v string")
    out = J.lookup_roles(fact, dim, "k", "v", {"r1": "n1", "r2": "n2"})
    assert rows(out) == [("alpha", "beta")]


def test_salted_join_equals_plain_join(spark):
    big = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 99)], "k int, i int")
    small = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k2 int, s string")
    a = sorted(rows(J.salted_join(big, small, "k", "k2", "inner", 7), "k", "i", "s"))
    b = sorted(rows(big.join(small, big.k == small.k2), "k", "i", "s"))
    assert a == b


def test_attach_refuses_fanout(spark):
    base = spark.createDataFrame([(1,)], "k int")
    extra = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        J.attach(base, extra, "k", assert_unique=True)
    assert J.attach(base, extra, "k").count() == 2


def test_freq_share_topk(spark):
    df = spark.createDataFrame([(x,) for x in "aabbbc"], "c string")
    assert rows(A.freq(df, "c")) == [("b", 3), ("a", 2), ("c", 1)]
    assert rows(A.share(df, "c")) == [("b", 3, 50.0), ("a", 2, 33.33), ("c", 1, 16.67)]
    assert rows(A.share(df, "c", total=12)) == [("b", 3, 25.0), ("a", 2, 16.67), ("c", 1, 8.33)]
    assert rows(A.freq(df, "c", top=1)) == [("b", 3)]
    assert "TakeOrderedAndProject" in A.top_k(df, "c", 2)._jdf.queryExecution().executedPlan().toString()


def test_group_profile_exact_for_small_groups(spark):
    vals = list(range(1, 3021))
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, x double").repartition(5)
    prof = A.group_profile(df, "g", "x").first()
    s = pd.Series(vals)
    for p in A.PROFILE_PROBS:
        k = math.ceil(round(p * len(vals), 9))
        assert prof[A.pct_name(p)] == float(sorted(vals)[k - 1]), p
    assert prof["n"] == 3020 and prof["min"] == 1 and prof["max"] == 3020 and prof["mean"] == s.mean()


def test_missing_table(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    assert rows(A.missing_table(df)) == [("b", 2, 50.0), ("a", 1, 25.0)]


def test_duplicate_audit_and_dedupe(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    assert rows(A.duplicate_audit(df)) == [(5, 3, 2)]
    assert A.dedupe(df).count() == 3


def test_dedupe_on_prefers_highest(spark):
    df = spark.createDataFrame([("JOAO", 0.9, "M"), ("JOAO", 0.95, "F"), ("ANA", None, "F"), ("ANA", 0.1, "M")],
                               "k string, ratio double, cls string")
    out = sorted(rows(A.dedupe_on(df, "k", prefer="ratio")))
    assert out == [("ANA", 0.1, "M"), ("JOAO", 0.95, "F")]


def test_histogram_lists_every_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "x double")
    h = rows(A.histogram(df, "x", 5))
    assert [r[0] for r in h] == [0, 1, 2, 3, 4] and [r[3] for r in h] == [2, 0, 0, 0, 1]


def test_corr_null_modes_differ(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.2)], "a double, b double")
    pw = {(r[0], r[1]): r[2] for r in A.corr_matrix(df, ["a", "b"], "pairwise").collect()}
    zr = {(r[0], r[1]): r[2] for r in A.corr_matrix(df, ["a", "b"], "zero").collect()}
    assert pw[("a", "a")] == 1.0 and abs(pw[("a", "b")] - 1.0) < 1e-3
    assert abs(zr[("a", "b")] - pw[("a", "b")]) > 0.1


def test_summary_and_describe(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    s = A.summary_long(df, ["x"]).first()
    assert (s["count"], s["min"], s["p25"], s["p50"], s["p75"], s["max"]) == (100, 1.0, 25.0, 50.0, 75.0, 100.0)
    d = A.describe_long(df, ["x"]).first()
    assert d["mean"] == 50.5


def test_quality_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert rows(D.check_unique(df, "k")) == [(1, 2)]
    assert D.check_not_null(df, "k").count() == 2


def test_projection_helpers(spark):
    df = spark.createDataFrame([("1000,50", "x", 1)], "a string, uf string, UF int")
    out = P.decimal_comma(df, ["a"])
    assert out.first()["a"] == 1000.5
    bad = P.decimal_comma(spark.createDataFrame([("x",)], "a string"), ["a"])
    assert bad.first()["a"] is None
    assert P.drop_cols(df, "uf").columns == ["a", "UF"]
    assert P.drop_cols(df, "uf", compat=True).columns == ["a"]
    cat, num = P.split_columns(spark.createDataFrame([(1, 2, "x")], "a bigint, b int, c string"))
    assert cat == ["c"] and num == ["a", "b"]


def test_hash_split_is_layout_independent(spark):
    df = spark.range(1000)
    tr1, _ = FL.split_train_test(df, 0.75, 7, by=["id"])
    tr2, _ = FL.split_train_test(df.repartition(13), 0.75, 7, by=["id"])
    assert sorted(r[0] for r in tr1.collect()) == sorted(r[0] for r in tr2.collect())


@pytest.mark.parametrize("accuracy, reach, values, refine", [
    (10_000, 1.5, 10**6, 64), (50, 1.5, 10**6, 64), (2, 0.0, 10**6, 64), (50, 1.5, 20, 4), (2, 0.0, 1, 2)])
def test_exact_quantiles_hot_group_matches_brute_force(spark, monkeypatch, accuracy, reach, values, refine):
    import random

    # coarse cuts, cuts that miss the rank, and cells that take several rounds
    for name, v in (("ACCURACY", accuracy), ("REACH", reach), ("CELL_VALUES", values), ("REFINE", refine)):
        monkeypatch.setattr(Q, name, v)

    rnd = random.Random(11)
    data = [("hot", float(rnd.randint(0, 500))) for _ in range(3000)] + \
           [(g, float(rnd.randint(0, 50))) for g in ("a", "b", None) for _ in range(rnd.randint(1, 40))] + [("a", None)]
    df = spark.createDataFrame(data, "g string, x double")
    probs = [0.0, 0.05, 0.33, 0.5, 0.55, 0.99, 1.0]
    got = {(r.g, r.prob): r.value for r in A.exact_quantiles_long(df, "g", "x", probs).collect()}
    for g in ("hot", "a", "b", None):
        vals = sorted(x for k, x in data if k == g and x is not None)
        for p in probs:
            from decimal import Decimal
            k = max(1, math.ceil(Decimal(str(p)) * len(vals)))
            assert got[(g, p)] == vals[k - 1], (g, p)
    glob = {r.prob: r.value for r in A.quantiles(df, "x", probs, exact=True).collect()}
    allv = sorted(x for _, x in data if x is not None)
    assert glob[0.5] == allv[math.ceil(0.5 * len(allv)) - 1]
    prof = A.group_profile(df, "g", "x", [0.5], exact=True).collect()
    assert {r.g: r.p50 for r in prof}["hot"] == got[("hot", 0.5)]


def test_exact_quantiles_of_many_groups_and_clashing_names(spark, monkeypatch):
    """A hot group over many partitions among many small ones; keys named as the results."""
    monkeypatch.setattr(Q, "ACCURACY", 20)
    data = [("hot", (i * 7919) % 4001) for i in range(4001)] + [(f"g{i % 30}", i) for i in range(300)] + [(None, 3), ("none", None)]
    names = ["prob", "value", "n", "sum", "min", "max", "k0", "v", "cuts", "rank"]
    df = spark.createDataFrame(data, "g string, x long").repartition(16).select(*[F.col("g").alias(n) for n in names], "x")
    out = A.exact_quantiles_long(df, ["prob", "value"], "x", [0.25, 0.5, 0.9])
    assert "percentile_approx" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == ["prob", "value", "prob_1", "value_1"]
    got = {(r["prob"], r["prob_1"]): r["value_1"] for r in out.collect()}
    assert len(got) == 3 * 32
    prof = A.group_profile(df, names, "x", [0.25, 0.5, 0.9], exact=True)
    assert prof.columns == [*names, "n_1", "mean", "min_1", "p25", "p50", "p90", "max_1"]
    wide = {r["cuts"]: r for r in prof.collect()}
    assert len(wide) == 33 and wide["none"]["n_1"] == 0
    for g in {k for k, _ in data} - {"none"}:
        vals = sorted(x for k, x in data if k == g)
        want = [vals[math.ceil(p * len(vals)) - 1] for p in (0.25, 0.5, 0.9)]
        assert [got[(g, p)] for p in (0.25, 0.5, 0.9)] == want == [wide[g][c] for c in ("p25", "p50", "p90")], g
        assert (wide[g]["n_1"], wide[g]["min_1"], wide[g]["max_1"]) == (len(vals), vals[0], vals[-1])


def test_exact_quantiles_read_the_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id").mapInArrow(count, "g long, id long")
    assert A.group_profile(df, "g", "id", [0.1, 0.5], exact=True).count() == 3 and seen.value == 5000


def test_exact_quantiles_of_other_types_and_odd_values(spark):
    import datetime
    from decimal import Decimal

    nan = float("nan")
    rows = [(1.0, 2**53 + 1, Decimal("1.10"), datetime.date(2020, 1, 1)), (nan, 2**53, Decimal("2.20"), datetime.date(2021, 1, 1)),
            (5.0, 2**53 + 3, None, datetime.date(2019, 1, 1)), (5.0, 7, Decimal("9.99"), None)]
    df = spark.createDataFrame(rows, "x double, big long, d decimal(10,2), t date")

    def median(c, p=0.5):
        return A.quantiles(df, c, [p], exact=True).first().value

    assert median("x") == 5.0 and math.isnan(median("x", 1.0))  # NaN sorts last
    assert median("big", 0.75) == 2**53 + 1 and median("d") == Decimal("2.20")
    assert median("t") == datetime.date(2020, 1, 1) and median("t", 0.9) == datetime.date(2021, 1, 1)
    days = A.group_profile(df, ["d"], "t", [0.5], exact=True).where("d is null").first()
    assert days.n == 1 and days.mean is None and days.p50 == days.max == datetime.date(2019, 1, 1)
    with pytest.raises(TypeError, match="numbers, dates or times"):
        A.quantiles(df.select(F.lit("a").alias("s")), "s", [0.5], exact=True)
    assert A.exact_quantiles_long(df.limit(0), [], "x", [0.5]).count() == 0
    assert A.exact_quantiles_long(df.select(F.lit(None).cast("double").alias("x")), [], "x", [0.5]).count() == 0


def test_null_keys_are_spread_and_never_match(spark):
    fact = spark.createDataFrame([(None, i) for i in range(200)] + [("a", 1000), ("b", 1001)], "k string, v int")
    extra = spark.createDataFrame([("a", "x"), (None, "never")], "k string, w string")
    out = J.attach(fact, extra, "k")
    assert out.count() == 202
    got = {r.v: r.w for r in out.collect()}
    assert got[1000] == "x" and got[1001] is None and all(got[i] is None for i in range(200))
    # With a real shuffle join (no auto-broadcast, no AQE coalescing), NULL-key rows land in
    # many partitions instead of one.
    from pyspark.sql import functions as F
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        j = J.spread_null_left_join(fact, extra, ["k"])
        assert "SortMergeJoin" in j._jdf.queryExecution().executedPlan().toString()
        parts = j.filter(F.col("k").isNull()).select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 4
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    dim = spark.createDataFrame([("a", "A")], "k string, label string")
    shuffled = J.lookup(fact, dim, "k", broadcast=False)
    assert shuffled.count() == 202 and "k" not in shuffled.columns


def test_exact_profile_keeps_all_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("z", None), ("z", None)], "g string, x double")
    got = {r.g: r for r in A.group_profile(df, "g", "x", [0.5], exact=True).collect()}
    assert got["a"].n == 2 and got["a"].mean == 2.0 and got["a"].p50 == 1.0 and got["a"].max == 3.0
    assert got["z"].n == 0 and got["z"].mean is None and got["z"].p50 is None
    approx = {r.g: r for r in A.group_profile(df, "g", "x", [0.5]).collect()}
    assert approx["z"].n == 0 and approx["a"].p50 == 1.0


def test_skew_join_splits_only_hot_keys(spark):
    big = spark.createDataFrame([(1, i) for i in range(300)] + [(k, 1000 + k) for k in range(2, 40)], "k int, i int")
    small = spark.createDataFrame([(k, f"s{k}") for k in range(1, 45)], "k2 int, s string")
    assert J.hot_keys(big, "k", rows_per_task=100) == [(1, 3)] and J.hot_keys(big, "k") == []
    assert J.hot_keys(big.select(F.lit(None).cast("int").alias("k")), "k", 0) == []
    a = sorted(rows(J.skew_join(big, small, "k", "k2", "inner", 8, rows_per_task=100), "k", "i", "s"))
    b = sorted(rows(big.join(small, big.k == small.k2), "k", "i", "s"))
    assert a == b and len(a) == 338
    left = J.skew_join(big, small, "k", "k2", "left", 8, keys=[1])
    assert left.count() == big.count()


def test_global_row_number_matches_window(spark, monkeypatch):
    import random
    from pyspark.sql import Window

    from regispark.operators import ordering as O

    monkeypatch.setattr(O, "MIN_ROWS_PER_BUCKET", 1)

    rnd = random.Random(4)
    df = spark.createDataFrame([(k, rnd.random()) for k in rnd.sample(range(100000), 2000)], "k long, x double")
    got = {r.k: r.rn for r in P.global_row_number(df, "k", "rn", num_partitions=13).collect()}
    exp = {r.k: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy("k"))).collect()}
    assert got == exp and sorted(got.values()) == list(range(1, 2001))


def test_bucket_binary_search_matches_tree(spark, monkeypatch):
    from regispark.operators import ordering as O

    monkeypatch.setattr(O, "MIN_ROWS_PER_BUCKET", 1)
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"))
    order = [F.col("k")]
    bounds = O.sample_bounds(df, order, 300)
    assert len(bounds) > O.TREE_MAX_BOUNDS
    types = [df.schema["k"].dataType]
    big = df.select("k", O.bucket_of(order, bounds, types).alias("b")).collect()
    import bisect
    flat = [b[0] for b in bounds]
    assert all(r.b == bisect.bisect_right(flat, r.k) for r in big)


def test_audit_and_correlation_of_degenerate_tables(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (4.0, 5.0, 1.0)], "a double, c double, n double")
    assert A.duplicate_audit(df.limit(0)).first() == (0, 0, 0)
    got = {(r.column_a, r.column_b): r.corr for r in A.corr_matrix(df, ["a", "c", "n"]).collect()}
    assert got["a", "a"] == 1.0 and got["a", "c"] is None and got["a", "n"] is None
    assert {r.corr for r in A.corr_matrix(df.limit(0), ["a", "c"]).collect()} == {1.0, None}


def test_salted_query_joins_its_hot_key_in_several_tasks(spark):
    from regispark.plans import catalog

    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = catalog.fact_join_salted(spark, "/root/testdata/sf0.001")
        tasks = out.where("o_orderkey = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert len(tasks) > 2 and sum(r["count"] for r in tasks) > 1500


def test_row_numbers_leave_columns_of_any_name(spark):
    df = spark.createDataFrame([(i, f"b{i}", -i) for i in range(50)], "x int, __bucket string, __pos int").withColumns({"__tb": F.lit("t"), "__before": F.lit("w")})
    out = P.global_row_number(df, "x")
    assert out.columns == [*df.columns, "row_number"]
    assert {(r["x"], r["__bucket"], r["__pos"], r["__tb"], r["__before"], r["row_number"]) for r in out.collect()} == {(i, f"b{i}", -i, "t", "w", i + 1) for i in range(50)}
