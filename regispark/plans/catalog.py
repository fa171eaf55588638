"""Driver query catalogue: every operator family exercised on the test tables.

Each entry reads whole tables from ``sf_dir`` (no id subsets or row caps) and returns a
lazy DataFrame; ``ORACLE_SQL`` holds the equivalent DuckDB SQL with identical column
names. Model-based entries (random forests, elastic nets, AES tokens) have no SQL twin.
Computed doubles are rounded in both engines so that summation order cannot change the
value hash.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as X
from ..operators import features as L, joins as J, profile as A, projection as P, quality as D, stats as T
from ..operators.filters import phone_shape
from ..fixed_values import STREET_TYPE_EXACT, STREET_TYPE_PATTERNS, VALID_AREA_CODES
from ..schemas import dataset_schema
from ..session import ensure_checkpoint_dir
from ..sources import archives, delimited, encoding, sinks
from ..sources.seeds import HOME_AREA_MOBILE_RANGES, expand_ranges
from .eda import CAPITAL_PROBS, eda_tables
from .geocode import geo_fallback

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(c, n=6):
    return F.round(F.col(c) if isinstance(c, str) else c, n)


QUERIES: dict = {}
ORACLE_SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------------------
# Flagship: scan -> broadcast lookups -> decode -> group profile -> top-k
# ---------------------------------------------------------------------------
FLAGSHIP_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]
ORDER_STATUS = {"F": "FINALIZADO", "O": "ABERTO", "P": "PARCIAL"}


@register("flagship_profile", """
SELECT r.r_name, CASE o.o_orderstatus WHEN 'F' THEN 'FINALIZADO' WHEN 'O' THEN 'ABERTO' WHEN 'P' THEN 'PARCIAL' END AS status,
       count(o.o_totalprice) AS n, round(avg(o.o_totalprice), 4) AS mean, min(o.o_totalprice) AS min,
       quantile_disc(o.o_totalprice, 0.05) AS p05, quantile_disc(o.o_totalprice, 0.25) AS p25,
       quantile_disc(o.o_totalprice, 0.5) AS p50, quantile_disc(o.o_totalprice, 0.75) AS p75,
       quantile_disc(o.o_totalprice, 0.95) AS p95, max(o.o_totalprice) AS max
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2
""")
def flagship_profile(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    region = table(spark, d, "region").select("r_regionkey", "r_name")
    x = J.lookup(orders, cust, "o_custkey")
    x = J.lookup(x, nation, "n_nationkey")
    x = J.lookup(x, region, "r_regionkey")
    x = x.withColumn("status", X.decode("o_orderstatus", ORDER_STATUS))
    prof = A.group_profile(x, ["r_name", "status"], "o_totalprice", FLAGSHIP_PROBS, exact=True)
    return prof.withColumn("mean", _r("mean", 4))


def flagship_top(spark, d, k: int = 10):
    """entry(): the flagship profile, top-k groups by mean order value."""
    return A.top_k(flagship_profile(spark, d), ["mean", "n"], k)


# ---------------------------------------------------------------------------
# Joins (J1, J4, J6, J7, J13) and G1
# ---------------------------------------------------------------------------
@register("lookup_star", """
SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def lookup_star(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    r = table(spark, d, "region")
    return J.lookup(J.lookup(c, n, "n_nationkey"), r, "r_regionkey")


@register("lookup_role_playing", """
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
""")
def lookup_role_playing(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    x = li.join(o, "l_orderkey", "inner")
    x = J.lookup(x, c, "o_custkey")
    x = J.lookup(x, s, "l_suppkey")
    nation = table(spark, d, "nation")
    return J.lookup_roles(x, nation, "n_nationkey", "n_name",
                          {"c_nationkey": "customer_nation", "s_nationkey": "supplier_nation"})


@register("fact_join", """
SELECT o.o_orderkey, l.l_orderkey, l.l_linenumber, o.o_orderstatus, l.l_quantity
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def fact_join(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return J.join_companies(o, li, "o_orderkey", "l_orderkey").select(
        "o_orderkey", "l_orderkey", "l_linenumber", "o_orderstatus", "l_quantity")


@register("fact_join_salted", """
WITH l AS (SELECT CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem)
SELECT o.o_orderkey, l.l_orderkey, l.l_partkey, l.l_linenumber, o.o_orderstatus, l.l_quantity
FROM orders o JOIN l ON o.o_orderkey = l.l_orderkey
""")
def fact_join_salted(spark, d):
    """A third of the lines belong to one order, which is joined by several tasks."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    key = F.when(F.col("l_partkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_orderkey"))
    li = table(spark, d, "lineitem").select(key.alias("l_orderkey"), "l_partkey", "l_linenumber", "l_quantity")
    return J.join_companies(o, li, "o_orderkey", "l_orderkey", salt_buckets=8, rows_per_task=HOT_ROWS).select(
        "o_orderkey", "l_orderkey", "l_partkey", "l_linenumber", "o_orderstatus", "l_quantity")


#: Rows per task of the salted query, low enough for the hot order of the test tables to be hot.
HOT_ROWS = 500


_RANGES_SQL = " UNION ALL ".join(
    f"SELECT {a} AS ddd, '{op}' AS operadora, unnest(range({lo}, {hi})) AS faixa, '{uf}' AS uf"
    for a, op, lo, hi, uf in HOME_AREA_MOBILE_RANGES)

_PHONE_SQL = """
CASE WHEN ddd <> '11' AND substr(tel, 1, 1) IN ('2','3','4','5') THEN 'TELEFONE FIXO'
     WHEN substr(tel, 1, 1) IN ('6','7','8','9') THEN 'TELEFONE CELULAR'
     WHEN ddd = '11' AND substr(tel, 1, 1) IN ('2','3','4') THEN 'TELEFONE FIXO'
     ELSE 'VALIDACAO_ESPECIAL' END"""


@register("composite_lookup_cast", f"""
WITH p AS (
  SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS ddd,
         lpad(CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR), 4, '0') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS tel
  FROM customer),
k AS (SELECT *, {_PHONE_SQL} AS phone_class FROM p),
r AS ({_RANGES_SQL})
SELECT k.c_custkey, k.ddd, k.tel, k.phone_class, r.operadora,
       CASE WHEN k.phone_class = 'VALIDACAO_ESPECIAL' AND r.faixa IS NULL THEN 'TELEFONE FIXO'
            WHEN k.phone_class = 'VALIDACAO_ESPECIAL' AND r.faixa IS NOT NULL THEN 'TELEFONE CELULAR'
            ELSE k.phone_class END AS phone_class_final
FROM k LEFT JOIN r ON TRY_CAST(k.ddd AS INTEGER) = r.ddd AND TRY_CAST(substr(k.tel, 1, 4) AS INTEGER) = r.faixa
""")
def composite_lookup_cast(spark, d):
    c = table(spark, d, "customer")
    p = c.select("c_custkey",
                 F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("ddd"),
                 F.concat(F.lpad(F.floor(F.abs("c_acctbal")).cast("bigint").cast("string"), 4, "0"),
                          F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")).alias("tel"))
    p = p.withColumns({"phone_class": X.phone_class("ddd", "tel"), "prefix4": X.prefix("tel", 4)})
    ranges = expand_ranges(spark)
    j = J.lookup_ranges(p, ranges, ["ddd", "prefix4"], ["ddd", "faixa"], broadcast=True)
    return j.select("c_custkey", p["ddd"], "tel", "phone_class", "operadora",
                    X.phone_class_final("phone_class", "faixa").alias("phone_class_final"))


@register("ratio_to_reference", """
WITH o AS (SELECT c.c_nationkey AS nation, count(*) AS n_orders FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
     c AS (SELECT c_nationkey AS nation, count(*) AS n_customers FROM customer GROUP BY 1)
SELECT o.nation, o.n_orders, c.n_customers, round(CAST(o.n_orders AS DOUBLE) / c.n_customers, 2) AS ratio
FROM o LEFT JOIN c ON o.nation = c.nation WHERE o.n_orders IS NOT NULL AND c.n_customers IS NOT NULL
""")
def ratio_to_reference(spark, d):
    o = table(spark, d, "orders").select("o_custkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    counts = o.join(c, "o_custkey").groupBy("nation").agg(F.count(F.lit(1)).alias("n_orders"))
    ref = c.groupBy("nation").agg(F.count(F.lit(1)).alias("n_customers"))
    # ref is an aggregate: no probe (it would compute it twice); AQE sizes it at runtime
    return J.ratio_to_reference(counts, ref, "nation", "n_orders", "n_customers", "ratio", 2, broadcast=False)


@register("geo_fallback", """
WITH l1 AS (SELECT o_custkey AS k, max(o_totalprice) / 10000.0 AS lat, CAST(count(*) AS DOUBLE) AS lon FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
     l2 AS (SELECT s_nationkey AS k, min(s_acctbal) / 100.0 AS lat, CAST(count(*) AS DOUBLE) AS lon FROM supplier GROUP BY 1),
     l3 AS (SELECT n_nationkey AS k, CAST(n_regionkey * 10 AS DOUBLE) AS lat, CAST(-n_regionkey * 10 AS DOUBLE) AS lon FROM nation)
SELECT c.c_custkey,
       round(CASE WHEN l1.lat IS NOT NULL AND l1.lon IS NOT NULL THEN l1.lat WHEN l2.lat IS NOT NULL AND l2.lon IS NOT NULL THEN l2.lat
            WHEN l3.lat IS NOT NULL AND l3.lon IS NOT NULL THEN l3.lat END, 6) AS LAT,
       round(CASE WHEN l1.lat IS NOT NULL AND l1.lon IS NOT NULL THEN l1.lon WHEN l2.lat IS NOT NULL AND l2.lon IS NOT NULL THEN l2.lon
            WHEN l3.lat IS NOT NULL AND l3.lon IS NOT NULL THEN l3.lon END, 6) AS LON,
       CASE WHEN l1.lat IS NOT NULL AND l1.lon IS NOT NULL THEN 'order' WHEN l2.lat IS NOT NULL AND l2.lon IS NOT NULL THEN 'supplier'
            WHEN l3.lat IS NOT NULL AND l3.lon IS NOT NULL THEN 'nation' END AS GEO_LEVEL
FROM customer c LEFT JOIN l1 ON c.c_custkey = l1.k LEFT JOIN l2 ON c.c_nationkey = l2.k LEFT JOIN l3 ON c.c_nationkey = l3.k
""")
def geo_fallback_q(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, d, "orders")
    done = F.col("o_orderstatus") == "F"
    l1 = o.groupBy("o_custkey").agg((F.max(F.when(done, F.col("o_totalprice"))) / 10000.0).alias("lat"), (F.count_if(done) * 1.0).alias("lon"))
    l2 = table(spark, d, "supplier").groupBy("s_nationkey").agg(
        (F.min("s_acctbal") / 100.0).alias("lat"), (F.count(F.lit(1)) * 1.0).alias("lon"))
    l3 = table(spark, d, "nation").select("n_nationkey", (F.col("n_regionkey") * 10.0).alias("lat"),
                                          (-F.col("n_regionkey") * 10.0).alias("lon"))
    out = geo_fallback(c, [("order", l1, "c_custkey", "o_custkey", "lat", "lon"),
                           ("supplier", l2, "c_nationkey", "s_nationkey", "lat", "lon"),
                           ("nation", l3, "c_nationkey", "n_nationkey", "lat", "lon")], broadcast=False)
    return out.select("c_custkey", _r("LAT").alias("LAT"), _r("LON").alias("LON"), "GEO_LEVEL")


# ---------------------------------------------------------------------------
# Decoding and dictionaries
# ---------------------------------------------------------------------------
@register("decode_status", """
SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS code,
       CASE TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) WHEN 1 THEN 'NULA' WHEN 2 THEN 'ATIVA' WHEN 3 THEN 'SUSPENSA'
            WHEN 4 THEN 'INAPTA' WHEN 8 THEN 'BAIXADA' END AS status
FROM orders
""")
def decode_status(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("code"))
    return o.withColumn("status", X.decode("code", X.REGISTRATION_STATUS))


@register("decode_default", """
SELECT o_orderkey,
       COALESCE(CASE TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) WHEN 1 THEN 'NULA' WHEN 2 THEN 'ATIVA'
            WHEN 3 THEN 'SUSPENSA' WHEN 4 THEN 'INAPTA' WHEN 8 THEN 'BAIXADA' END, 'OUTRO') AS status,
       COALESCE(CASE o_orderstatus WHEN 'F' THEN 'FINALIZADO' WHEN 'O' THEN 'ABERTO' END, 'OUTRO') AS order_state
FROM orders
""")
def decode_default(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey",
                    X.decode(F.substring("o_orderpriority", 1, 1), X.REGISTRATION_STATUS, "OUTRO").alias("status"),
                    X.decode("o_orderstatus", {"F": "FINALIZADO", "O": "ABERTO"}, "OUTRO").alias("order_state"))


@register("whitelist_other", """
SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN p_type ELSE 'OUTROS' END AS p_type_class
FROM part
""")
def whitelist_other(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.whitelist("p_type", ["ECONOMY", "STANDARD", "PROMO"]).alias("p_type_class"))


# Street-type labels built from part attributes so every rule of the chain fires.
def _street_label():
    p_size = F.col("p_size").cast("string")
    return (F.when(F.col("p_type") == "ECONOMY", F.concat(p_size, F.lit("A RUA")))
            .when(F.col("p_type") == "LARGE", F.concat(p_size, F.lit("A AVENIDA")))
            .when(F.col("p_type") == "STANDARD", F.lit("RUA PRINCIPAL"))
            .when(F.col("p_type") == "SMALL", F.lit("PRAÇA"))
            .when(F.col("p_type") == "PROMO", F.lit("PRA\ufffdA"))
            .otherwise(F.upper("p_name")))


@register("regex_case_chain", """
WITH s AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN CAST(p_size AS VARCHAR) || 'A RUA'
    WHEN 'LARGE' THEN CAST(p_size AS VARCHAR) || 'A AVENIDA' WHEN 'STANDARD' THEN 'RUA PRINCIPAL'
    WHEN 'SMALL' THEN 'PRAÇA' WHEN 'PROMO' THEN 'PRA' || chr(65533) || 'A' ELSE upper(p_name) END AS label FROM part),
t AS (SELECT p_partkey, label,
    CASE WHEN regexp_matches(label, '^\\d{1,2}A RUA$') THEN 'RUA' WHEN regexp_matches(label, '^\\d{1,2}A AVENIDA$') THEN 'AVENIDA'
         WHEN regexp_matches(label, '^\\d{1,2}A TRAVESSA$') THEN 'TRAVESSA' WHEN label = 'RUA PRINCIPAL' THEN 'RUA'
         WHEN label = 'RUA DE PEDESTRE' THEN 'RUA' WHEN label = 'PRAÇA' THEN 'PRACA' WHEN label = 'RUA DE LIGACAO' THEN 'RUA'
         WHEN label = '1A VILA' THEN 'VILA' ELSE replace(label, 'PRA' || chr(65533) || 'A', 'PRACA') END AS norm FROM s)
SELECT p_partkey, label, CASE WHEN norm IN ('RUA', 'AVENIDA', 'TRAVESSA', 'PRACA', 'VILA') THEN norm ELSE 'OUTROS' END AS street_type
FROM t
""")
def regex_case_chain(spark, d):
    p = table(spark, d, "part").select("p_partkey", _street_label().alias("label"))
    return p.withColumn("street_type", X.street_type("label", ["RUA", "AVENIDA", "TRAVESSA", "PRACA", "VILA"]))


SEGMENT_FIX = {"HOUSEHOLD": "HOME", "HOME": "NEVER-CHAINED", "MACHINERY": "MACHINES", "AUTOMOBILE": "AUTO"}


@register("dictionary_replace", """
SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HOME' WHEN 'HOME' THEN 'NEVER-CHAINED'
    WHEN 'MACHINERY' THEN 'MACHINES' WHEN 'AUTOMOBILE' THEN 'AUTO' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def dictionary_replace(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return X.replace_values(c, "c_mktsegment", SEGMENT_FIX)


_BRAND_CANON = ["BRAND#1", "BRAND#2", "BRAND#3"]


def _brand_case_sql() -> str:
    mapping = X.typo_dictionary(_BRAND_CANON)
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(mapping.items()))
    return f"CASE upper(p_brand) {whens} ELSE upper(p_brand) END"


@register("dictionary_replace_large", f"""
SELECT p_partkey, {_brand_case_sql()} AS brand FROM part
""")
def dictionary_replace_large(spark, d):
    """The broadcast-join path of replace_values (dictionary above the inline limit)."""
    mapping = X.typo_dictionary(_BRAND_CANON)
    p = table(spark, d, "part").select("p_partkey", F.upper("p_brand").alias("brand"))
    return X.replace_values(p, "brand", mapping)


# ---------------------------------------------------------------------------
# Contact data and free text
# ---------------------------------------------------------------------------
_ADDRESS = r"[A-Za-z0-9._%+-]*@[A-Za-z0-9.-]*"
_ADDRESS_SQL = f"SELECT doc_id, unnest(regexp_extract_all(text, '{_ADDRESS}')) AS address FROM documents"


def _addresses(spark, d):
    """Every e-mail-like run of every document, one row each."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_ADDRESS), F.lit(0))).alias("address"))


@register("email_provider_regex", f"""
SELECT doc_id, upper(regexp_extract(address, '@([^.]+)\\.', 1)) AS provider FROM ({_ADDRESS_SQL})
""")
def email_provider_regex(spark, d):
    return _addresses(spark, d).select("doc_id", X.email_provider("address", "regex").alias("provider"))


@register("email_provider_split", f"""
SELECT doc_id, string_split(string_split(upper(address), '@')[2], '.')[1] AS provider FROM ({_ADDRESS_SQL})
""")
def email_provider_split(spark, d):
    return _addresses(spark, d).select("doc_id", X.email_provider("address", "split").alias("provider"))


@register("email_valid", f"""
SELECT doc_id, regexp_extract(lower(address), '^\\S+@\\S+\\.\\S+$', 0) AS valid_email FROM ({_ADDRESS_SQL})
""")
def email_valid(spark, d):
    return _addresses(spark, d).select("doc_id", X.email_valid("address").alias("valid_email"))


# Word rewrite dictionary for the free-text check: the misspellings of frequent words by rule,
# chains and keys with a separator among them. Order matters (sequential semantics).
WORD_FIX = X.typo_dictionary(["THAT", "WITH", "WHICH", "FROM", "THIS", "THERE", "PEOPLE", "ABOUT", "NICHT", "EINE", "WERDEN", "POUR", "DANS",
                              "CETTE", "TODO", "COMO", "SOBRE", "CUANDO", "BETWEEN", "ANOTHER"], {
    "THE": "teh", "TEH": "the_x", "AND": "n", "OF": "off", "OFF": "of_x", "OF THE": "never", "IN A": "inna", "N": "and-so", "DE LA": "dela", "IS": "it's"})


def _rewrite_sql(col: str) -> str:
    """The rules one after the other."""
    lines = [f"t0 AS (SELECT doc_id, {col} AS t FROM documents)"]
    for i, (k, v) in enumerate(WORD_FIX.items()):
        k, v = k.lower(), v.lower().replace("'", "''")
        hit = f"regexp_replace(t, '\\b{k}\\b', '{v}', 'g')"
        lines.append(f"t{i + 1} AS MATERIALIZED (SELECT doc_id, CASE WHEN contains(t, '{k}') THEN {hit} ELSE t END AS t FROM t{i})")
    return f"WITH {', '.join(lines)} SELECT doc_id, t AS rewritten FROM t{len(WORD_FIX)}"


@register("word_rewrite", _rewrite_sql("text"))
def word_rewrite(spark, d):
    return table(spark, d, "documents").select("doc_id", X.rewrite_words("text", WORD_FIX, "compat").alias("rewritten"))


@register("accent_fold", """
SELECT doc_id, translate(replace(upper(text), 'ẞ', 'SS'), 'ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ', 'AAAAAEEEEIIIIOOOOOUUUUC') AS folded
FROM documents
""")
def accent_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", X.fold_accents("text").alias("folded"))


@register("digits_only", """
SELECT c_custkey, nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS digits,
       CAST(length(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '')) AS INTEGER) AS n_digits
FROM customer
""")
def digits_only(spark, d):
    c = table(spark, d, "customer").select("c_custkey", X.digits("c_name").alias("digits"))
    return c.withColumn("n_digits", F.length("digits"))


@register("person_id_flag", """
WITH t AS (SELECT doc_id, CAST(length(nullif(regexp_replace(text, '[^0-9]', '', 'g'), '')) AS INTEGER) AS n_digits FROM documents)
SELECT doc_id, n_digits, CASE WHEN n_digits = 11 THEN 'SIM' ELSE 'NAO' END AS person_id FROM t
""")
def person_id_flag(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.length(X.digits("text")).alias("n_digits"))
    return t.withColumn("person_id", X.person_id_flag("n_digits"))


TOKEN_KEY = "k3y-for-tests-only-32-characters"


@register("token_hash", f"""
SELECT c_custkey, sha256('{TOKEN_KEY}' || c_name) AS token FROM customer
""")
def token_hash(spark, d):
    return table(spark, d, "customer").select("c_custkey", X.tokenize_id("c_name", TOKEN_KEY, "sha2").alias("token"))


@register("token_aes")
def token_aes(spark, d):
    """AES-ECB tokens are deterministic per key; no SQL twin (rows-only check)."""
    return table(spark, d, "customer").select("c_custkey", X.tokenize_id("c_name", TOKEN_KEY, "aes-ecb").alias("token"))


@register("phone_class", f"""
WITH f AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\([0-9]{{3}}\\) [0-9]{{3}}-[0-9]{{4}}')) AS phone FROM documents),
m AS (SELECT doc_id, regexp_replace(phone, '[^0-9]', '', 'g') AS raw FROM f),
p AS (SELECT doc_id, substr(raw, 1, 2) AS ddd, substr(raw, 3, 8) AS tel FROM m WHERE length(substr(raw, 1, 2)) = 2 AND length(substr(raw, 3, 8)) = 8),
k AS (SELECT *, {_PHONE_SQL} AS phone_class FROM p),
r AS ({_RANGES_SQL})
SELECT k.doc_id, k.ddd, k.tel,
       CASE WHEN k.phone_class = 'VALIDACAO_ESPECIAL' AND r.faixa IS NULL THEN 'TELEFONE FIXO'
            WHEN k.phone_class = 'VALIDACAO_ESPECIAL' AND r.faixa IS NOT NULL THEN 'TELEFONE CELULAR'
            ELSE k.phone_class END AS phone_type,
       CASE WHEN (CASE WHEN k.phone_class = 'VALIDACAO_ESPECIAL' AND r.faixa IS NULL THEN 'TELEFONE FIXO'
            WHEN k.phone_class = 'VALIDACAO_ESPECIAL' AND r.faixa IS NOT NULL THEN 'TELEFONE CELULAR'
            ELSE k.phone_class END) = 'TELEFONE CELULAR' THEN '9' || substr(k.tel, 1, 4) ELSE 'TELEFONE FIXO' END AS prefix5
FROM k LEFT JOIN r ON TRY_CAST(k.ddd AS INTEGER) = r.ddd AND TRY_CAST(substr(k.tel, 1, 4) AS INTEGER) = r.faixa
""")
def phone_class(spark, d):
    found = F.explode(F.regexp_extract_all("text", F.lit(r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}"), F.lit(0)))
    docs = table(spark, d, "documents").select("doc_id", found.alias("phone"))
    raw = F.regexp_replace("phone", "[^0-9]", "")
    p = docs.select("doc_id", F.substring(raw, 1, 2).alias("ddd"), F.substring(raw, 3, 8).alias("tel"))
    p = phone_shape(p, "ddd", "tel")
    p = p.withColumns({"phone_class": X.phone_class("ddd", "tel"), "prefix4": X.prefix("tel", 4)})
    j = J.lookup_ranges(p, expand_ranges(spark), ["ddd", "prefix4"], ["ddd", "faixa"], broadcast=True)
    j = j.withColumn("phone_type", X.phone_class_final("phone_class", "faixa"))
    return j.select("doc_id", p["ddd"], "tel", "phone_type", X.mobile_prefix5("phone_type", "prefix4").alias("prefix5"))


# ---------------------------------------------------------------------------
# Dates, addresses, tokens, null handling
# ---------------------------------------------------------------------------
_BROKEN_DATE = """CASE WHEN o_orderkey % 97 = 0 THEN '00000000' WHEN o_orderkey % 89 = 0 THEN '20240231'
    WHEN o_orderkey % 83 = 0 THEN '0' WHEN o_orderkey % 79 = 0 THEN '' ELSE {fmt} END"""


@register("safe_date_parts", f"""
WITH s AS (SELECT o_orderkey, {_BROKEN_DATE.format(fmt="strftime(o_orderdate, '%Y%m%d')")} AS raw FROM orders),
t AS (SELECT o_orderkey, raw, CAST(try_strptime(raw, '%Y%m%d') AS DATE) AS dt FROM s)
SELECT o_orderkey, raw, dt, CAST(year(dt) AS INTEGER) AS yr, CAST(month(dt) AS INTEGER) AS mo FROM t
""")
def safe_date_parts(spark, d):
    o = table(spark, d, "orders")
    s = o.select("o_orderkey", F.expr(_BROKEN_DATE.format(fmt="date_format(o_orderdate, 'yyyyMMdd')")).alias("raw"))
    s = s.withColumn("dt", X.safe_date("raw"))
    return X.year_month(s, "dt", "yr", "mo")


@register("address_ws", """
SELECT c.c_custkey,
       concat_ws(', ', nullif(c.c_mktsegment, 'BUILDING') || ' ' || c.c_name, CAST(c.c_custkey AS VARCHAR),
                 concat_ws(' - ', nullif(n.n_name, 'NATION_3'), r.r_name)) AS address
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def address_ws(spark, d):
    x = lookup_star(spark, d)
    return x.select("c_custkey", X.address_ws(F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name", "c_custkey",
                                              F.nullif("n_name", F.lit("NATION_3")), "r_name").alias("address"))


@register("address_concat", """
SELECT c.c_custkey,
       nullif(c.c_mktsegment, 'BUILDING') || ' ' || c.c_name || ', ' || CAST(c.c_custkey AS VARCHAR) || ' - '
       || nullif(n.n_name, 'NATION_3') || ', ' || r.r_name AS address
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def address_concat(spark, d):
    x = lookup_star(spark, d)
    return x.select("c_custkey", X.address_concat(F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name", "c_custkey",
                                                  F.nullif("n_name", F.lit("NATION_3")), "r_name").alias("address"))


@register("first_token", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word FROM part
""")
def first_token(spark, d):
    return table(spark, d, "part").select("p_partkey", X.first_token("p_name").alias("first_word"))


@register("explode_alternatives", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
""")
def explode_alternatives(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    return X.explode_alternatives(p, "p_name", "word", sep=" ").select("p_partkey", "word")


_MISS_SQL = """FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')) c
    ON o.o_custkey = c.c_custkey"""


def _orders_segment(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    known = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                           *[F.when(known, F.col(x)).alias(x) for x in ("c_name", "c_acctbal", "c_mktsegment")])
    return J.lookup(o, c, "o_custkey", drop_key=False)


@register("null_fallback", f"""
SELECT o.o_orderkey, COALESCE(c.c_name, 'UNKNOWN#' || CAST(o.o_custkey AS VARCHAR)) AS customer_name {_MISS_SQL}
""")
def null_fallback(spark, d):
    x = _orders_segment(spark, d)
    return x.select("o_orderkey", X.fallback("c_name", F.concat(F.lit("UNKNOWN#"), F.col("o_custkey").cast("string")))
                    .alias("customer_name"))


@register("fill_constants", f"""
SELECT o.o_orderkey, COALESCE(c.c_mktsegment, 'SI') AS c_mktsegment, COALESCE(c.c_acctbal, 0.0) AS c_acctbal {_MISS_SQL}
""")
def fill_constants(spark, d):
    x = _orders_segment(spark, d).select("o_orderkey", "c_mktsegment", "c_acctbal")
    return X.fill_constants(x, {"c_mktsegment": "SI", "c_acctbal": 0.0})


@register("conditional_override", f"""
SELECT o.o_orderkey, CASE WHEN o.o_orderstatus = 'F' AND c.c_mktsegment = 'AUTOMOBILE' THEN 'AUTO-F' ELSE o.o_orderstatus END AS state
{_MISS_SQL}
""")
def conditional_override(spark, d):
    x = _orders_segment(spark, d).withColumnRenamed("o_orderstatus", "state")
    cond = (F.col("state") == "F") & (F.col("c_mktsegment") == "AUTOMOBILE")
    return X.override_when(x, cond, "state", "AUTO-F").select("o_orderkey", "state")


@register("decimal_comma", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'x' ELSE replace(printf('%.2f', o_totalprice), '.', ',') END AS raw FROM orders)
SELECT o_orderkey, raw, TRY_CAST(replace(raw, ',', '.') AS DOUBLE) AS price FROM s
""")
def decimal_comma(spark, d):
    o = table(spark, d, "orders")
    s = o.select("o_orderkey", F.when(F.col("o_orderkey") % 101 == 0, F.lit("x"))
                 .otherwise(F.regexp_replace(F.format_string("%.2f", "o_totalprice"), r"\.", ",")).alias("raw"))
    return P.decimal_comma(s.withColumn("price", F.col("raw")), ["price"])


# ---------------------------------------------------------------------------
# Aggregates and profiles
# ---------------------------------------------------------------------------
@register("freq_one", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def freq_one(spark, d):
    return A.freq(table(spark, d, "events"), "event_type")


@register("freq_two", "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY 1, 2")
def freq_two(spark, d):
    return A.freq(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("share_of_total", """
SELECT event_type, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM events), 2) AS pct
FROM events GROUP BY 1
""")
def share_of_total(spark, d):
    return A.share(table(spark, d, "events"), "event_type")


@register("topk", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10
""")
def topk(spark, d):
    return A.top_k(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                   ["o_totalprice", "o_orderkey"], 10)


_PROF_SQL = ", ".join(f"quantile_disc(o_totalprice, {p}) AS {A.pct_name(p)}" for p in A.PROFILE_PROBS)


@register("group_percentiles", f"""
SELECT o_orderpriority, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS min,
       {_PROF_SQL}, max(o_totalprice) AS max
FROM orders GROUP BY 1
""")
def group_percentiles(spark, d):
    prof = A.group_profile(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", exact=True)
    return prof.withColumn("mean", _r("mean", 4))


GLOBAL_PROBS = [0.01, 0.05, 0.1, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.9, 0.95, 0.99]


@register("global_quantiles", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS prob, quantile_disc(l_extendedprice, {p}) AS value FROM lineitem" for p in GLOBAL_PROBS))
def global_quantiles(spark, d):
    return A.quantiles(table(spark, d, "lineitem"), "l_extendedprice", GLOBAL_PROBS, exact=True)


@register("box_summary", """
SELECT min(l_quantity) AS min, quantile_disc(l_quantity, 0.25) AS q1, quantile_disc(l_quantity, 0.5) AS median,
       quantile_disc(l_quantity, 0.75) AS q3, max(l_quantity) AS max FROM lineitem
""")
def box_summary(spark, d):
    return A.five_number(table(spark, d, "lineitem"), "l_quantity")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("summary_long", " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
    CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50,
    CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in _NUM))
def summary_long(spark, d):
    s = A.summary_long(table(spark, d, "lineitem"), _NUM, exact=True)
    return s.withColumns({"mean": _r("mean"), "stddev": _r("stddev")})


@register("describe_long", " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
    CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in _NUM))
def describe_long(spark, d):
    s = A.describe_long(table(spark, d, "lineitem"), _NUM)
    return s.withColumns({"mean": _r("mean"), "stddev": _r("stddev")})


@register("filtered_mean", """
SELECT round(avg(l_quantity), 2) AS mean FROM lineitem WHERE l_quantity > 5 AND l_quantity < 45
""")
def filtered_mean(spark, d):
    return A.filtered_mean(table(spark, d, "lineitem"), "l_quantity", 5, 45)


def _customer_orders(spark, d):
    c = table(spark, d, "customer")
    partial = F.col("o_orderstatus") == "P"
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), *[
        F.when(partial, F.col(x)).alias(x) for x in ("o_orderkey", "o_totalprice", "o_orderpriority")])
    return c.join(o, "c_custkey", "left")


_CO_SQL = """(SELECT c.*, o.o_orderkey, o.o_totalprice, o.o_orderpriority FROM customer c
    LEFT JOIN (SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_orderkey END AS o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority FROM orders) o ON c.c_custkey = o.o_custkey)"""
_CO_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "o_orderkey", "o_totalprice",
            "o_orderpriority"]


@register("missing_table", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS pct FROM {_CO_SQL}" for c in _CO_COLS))
def missing_table(spark, d):
    return A.missing_table(_customer_orders(spark, d).select(*_CO_COLS))


@register("duplicate_audit", """
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT text, lang, count(*) AS n FROM documents GROUP BY ALL)
""")
def duplicate_audit(spark, d):
    return A.duplicate_audit(table(spark, d, "documents").select("text", "lang"))


@register("dedupe_subset", """
SELECT text, doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id DESC, lang DESC, source DESC) AS rn FROM documents)
WHERE rn = 1
""")
def dedupe_subset(spark, d):
    docs = table(spark, d, "documents").select("text", "doc_id", "lang", "source", "n_chars")
    return A.dedupe_on(docs, "text", prefer="n_chars")


@register("dedupe_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def dedupe_rows(spark, d):
    return A.dedupe(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity"))


@register("histogram", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
x AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20.0)), 19) AS INTEGER) AS bin FROM orders, b),
c AS (SELECT bin, count(*) AS count FROM x GROUP BY 1),
e AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20))
SELECT e.bin, round(lo + e.bin * ((hi - lo) / 20.0), 4) AS lo, round(lo + (e.bin + 1) * ((hi - lo) / 20.0), 4) AS hi,
       COALESCE(c.count, 0) AS count
FROM e LEFT JOIN c ON e.bin = c.bin, b
""")
def histogram(spark, d):
    h = A.histogram(table(spark, d, "orders"), "o_totalprice", 20)
    return h.withColumns({"lo": _r("lo", 4), "hi": _r("hi", 4)})


@register("corr_matrix", " UNION ALL ".join(
    (f"SELECT '{a}' AS column_a, '{b}' AS column_b, 1.0 AS corr" if a == b else
     f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem")
    for a in _NUM for b in _NUM))
def corr_matrix(spark, d):
    return A.corr_matrix(table(spark, d, "lineitem"), _NUM).withColumn("corr", _r("corr"))


@register("corr_matrix_zero", """
WITH t AS (SELECT o.o_totalprice AS a, c.c_acctbal AS b FROM orders o
           LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c ON o.o_custkey = c.c_custkey)
SELECT 'pairwise' AS mode, round(corr(a, b), 6) AS corr FROM t
UNION ALL SELECT 'zero' AS mode, round(corr(COALESCE(a, 0), COALESCE(b, 0)), 6) AS corr FROM t
""")
def corr_matrix_zero(spark, d):
    o = table(spark, d, "orders").select("o_custkey", F.col("o_totalprice").alias("a"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal")).alias("b"))
    t = o.join(c, "o_custkey", "left")
    pick = lambda m: A.corr_matrix(t, ["a", "b"], m).filter((F.col("column_a") == "a") & (F.col("column_b") == "b")) \
        .select(F.lit(m).alias("mode"), _r("corr").alias("corr"))
    return pick("pairwise").unionByName(pick("zero"))


@register("variance_filter", " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(var_samp({c}), 6) AS variance FROM lineitem HAVING var_samp({c}) > 0.5"
    for c in _NUM))
def variance_filter(spark, d):
    v = A.variance(table(spark, d, "lineitem"), _NUM)
    return v.filter(F.col("variance") > 0.5).withColumn("variance", _r("variance"))


@register("union_shards", "SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem")
def union_shards(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    shards = [li.filter(F.col("l_returnflag") == f) for f in ("A", "N")] + \
             [li.filter(~F.col("l_returnflag").isin("A", "N") | F.col("l_returnflag").isNull())]
    return A.union_all(shards)


# ---------------------------------------------------------------------------
# Feature statistics (L6, L7, L10) with closed-form SQL twins
# ---------------------------------------------------------------------------
def ols_sql(base: str, xs: list[str], y: str, by: str = "0", scale: str = "1") -> str:
    """DuckDB CTEs ``ols_*`` ending in ``ols``: per ``by`` as g, n, means m1.. and my, population
    (co)variances s1_1.. s1_y.. syy and the coefficients b0, b1.. of y ~ xs, by elimination on
    the centred normal equations whose diagonal is multiplied by ``scale``."""
    k = len(xs)
    terms = [f"avg({x}) AS m{i}" for i, x in enumerate(xs, 1)]
    terms += [f"covar_pop({xs[i - 1]}, {xs[j - 1]}) AS s{i}_{j}" for i in range(1, k + 1) for j in range(i, k + 1)]
    terms += [f"covar_pop({x}, {y}) AS s{i}_y" for i, x in enumerate(xs, 1)]
    start = [f"s{min(i, j)}_{max(i, j)}" + (f" * ({scale})" if i == j else "") + f" AS a{i}_{j}" for i in range(1, k + 1) for j in range(1, k + 1)]
    ctes = [f"ols_0 AS (SELECT *, {', '.join(start)}, {', '.join(f's{i}_y AS a{i}_y' for i in range(1, k + 1))} FROM ("
            f"SELECT {by} AS g, count(*) AS n, avg({y}) AS my, var_pop({y}) AS syy, {', '.join(terms)} FROM {base} GROUP BY ALL))"]
    for q in range(1, k + 1):
        new = [f"a{i}_{j} - a{i}_{q} * a{q}_{j} / a{q}_{q} AS a{i}_{j}" for i in range(1, k + 1) if i != q for j in [*range(1, k + 1), "y"]]
        ctes.append(f"ols_{q} AS (SELECT * REPLACE ({', '.join(new)}) FROM ols_{q - 1})" if new else f"ols_{q} AS (SELECT * FROM ols_{q - 1})")
    slopes = ", ".join(f"a{i}_y / a{i}_{i} AS b{i}" for i in range(1, k + 1))
    return ", ".join([*ctes, f"ols AS (SELECT *, my{''.join(f' - b{i} * m{i}' for i in range(1, k + 1))} AS b0 FROM (SELECT *, {slopes} FROM ols_{k}))"])


_TRAITS = ["l_linestatus", "o_orderstatus", "o_orderpriority", "half", "quarter", "part_class"]
_TRAITS_SQL = """t AS (SELECT l_returnflag, l_linestatus, o_orderstatus, o_orderpriority, CASE WHEN month(l_shipdate) < 7 THEN 'H1' ELSE 'H2' END AS half,
       CAST(quarter(o_orderdate) AS VARCHAR) AS quarter, CAST(l_partkey % 7 AS VARCHAR) AS part_class
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _traits(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_partkey", "l_shipdate")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderpriority", "o_orderdate")
    return li.join(o, "l_orderkey").select(
        "l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", F.when(F.month("l_shipdate") < 7, "H1").otherwise("H2").alias("half"),
        F.quarter("o_orderdate").cast("string").alias("quarter"), (F.col("l_partkey") % 7).cast("string").alias("part_class"))


def _chi_sql(features: list[str], label: str) -> str:
    """CTE ``x``: (feature, statistic, dof) of each feature of ``t`` against ``label``."""
    one = """SELECT '{c}' AS feature, sum(n * n / (ra * rb)) * max(total) - max(total) AS statistic,
        (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM (
        SELECT a, b, CAST(n AS DOUBLE) AS n, CAST(sum(n) OVER (PARTITION BY a) AS DOUBLE) AS ra, CAST(sum(n) OVER (PARTITION BY b) AS DOUBLE) AS rb,
               CAST(sum(n) OVER () AS DOUBLE) AS total
        FROM (SELECT {c} AS a, {label} AS b, count(*) AS n FROM t WHERE {c} IS NOT NULL AND {label} IS NOT NULL GROUP BY 1, 2))"""
    return "x AS (" + " UNION ALL ".join(one.format(c=c, label=label) for c in features) + ")"


@register("chi_square_features", f"WITH {_TRAITS_SQL}, {_chi_sql(_TRAITS, 'l_returnflag')} SELECT feature, round(statistic, 4) AS statistic, dof FROM x")
def chi_square_features(spark, d):
    """All categoricals against the label from one scan; the tails are tested in tests/test_stats.py."""
    r = L.chi_square_test(_traits(spark, d), "l_returnflag", _TRAITS)
    return r.select("feature", _r("statistic", 4).alias("statistic"), "dof")


@register("chi_square", """
WITH t AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS o FROM lineitem GROUP BY 1, 2),
ra AS (SELECT a, sum(o) AS na FROM t GROUP BY 1), rb AS (SELECT b, sum(o) AS nb FROM t GROUP BY 1),
n AS (SELECT sum(o) AS n FROM t),
g AS (SELECT ra.a, rb.b, ra.na * rb.nb / n.n AS e, COALESCE(t.o, 0) AS o FROM ra, rb, n LEFT JOIN t ON t.a = ra.a AND t.b = rb.b)
SELECT 'l_returnflag' AS feature, round(sum((o - e) * (o - e) / e), 6) AS statistic,
       ((SELECT count(*) FROM ra) - 1) * ((SELECT count(*) FROM rb) - 1) AS dof FROM g
""")
def chi_square(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus")
    r = L.chi_square_test(li, "l_linestatus", ["l_returnflag"])
    return r.select("feature", _r("statistic").alias("statistic"), F.col("dof").cast("long").alias("dof"))


@register("anova_f", """
WITH g AS (SELECT l_returnflag, count(l_quantity) AS n, sum(l_quantity) AS s FROM lineitem GROUP BY 1),
t AS (SELECT count(l_quantity) AS n, sum(l_quantity) AS s, sum(l_quantity * l_quantity) AS q FROM lineitem),
b AS (SELECT sum(s * s / n) AS b, count(*) AS k FROM g)
SELECT 'l_quantity' AS feature, round(((b.b - t.s * t.s / t.n) / (b.k - 1)) / ((t.q - b.b) / (t.n - b.k)), 6) AS f_value,
       CAST(b.k - 1 AS DOUBLE) AS df1, CAST(t.n - b.k AS DOUBLE) AS df2
FROM t, b
""")
def anova_f(spark, d):
    r = T.anova_f(table(spark, d, "lineitem"), "l_returnflag", ["l_quantity"])
    return r.select("feature", _r("f_value").alias("f_value"), "df1", "df2")


@register("f_regression", """
SELECT 'l_quantity' AS feature, round(power(corr(l_quantity, l_extendedprice), 2) / (1 - power(corr(l_quantity, l_extendedprice), 2))
       * (count(*) - 2), 4) AS f_value, CAST(count(*) - 2 AS DOUBLE) AS df2
FROM lineitem
""")
def f_regression(spark, d):
    r = T.f_regression(table(spark, d, "lineitem"), "l_extendedprice", ["l_quantity"])
    return r.select("feature", _r("f_value", 4).alias("f_value"), "df2")


# ---------------------------------------------------------------------------
# Statistical tests
# ---------------------------------------------------------------------------
@register("jarque_bera", """
WITH m AS (SELECT count(value) AS n, avg(value) AS mu FROM events),
c AS (SELECT m.n, avg(power(value - m.mu, 2)) AS m2, avg(power(value - m.mu, 3)) AS m3, avg(power(value - m.mu, 4)) AS m4
      FROM events, m GROUP BY m.n),
s AS (SELECT n, m3 / power(m2, 1.5) AS skew, m4 / (m2 * m2) - 3 AS kurt FROM c)
SELECT n, round(skew, 6) AS skewness, round(kurt, 6) AS kurtosis, round(n / 6.0 * (skew * skew + kurt * kurt / 4), 4) AS jb,
       exp(-(n / 6.0 * (skew * skew + kurt * kurt / 4)) / 2) > 0.05 AS normal
FROM s
""")
def jarque_bera(spark, d):
    r = T.jarque_bera(table(spark, d, "events"), "value")
    return r.select("n", _r("skewness").alias("skewness"), _r("kurtosis").alias("kurtosis"), _r("jb", 4).alias("jb"),
                    "normal")


@register("durbin_watson", """
WITH t AS (SELECT value, lag(value) OVER (ORDER BY event_id) AS prev FROM events)
SELECT count(*) AS n, round(sum(power(value - prev, 2)) / sum(value * value), 6) AS dw FROM t
""")
def durbin_watson(spark, d):
    r = T.durbin_watson(table(spark, d, "events"), "value", "event_id")
    return r.select("n", _r("dw").alias("dw"))


@register("durbin_watson_grouped", """
WITH t AS (SELECT event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY event_id) AS prev FROM events)
SELECT event_type, count(*) AS n, round(sum(power(value - prev, 2)) / sum(value * value), 6) AS dw FROM t GROUP BY 1
""")
def durbin_watson_grouped(spark, d):
    r = T.durbin_watson(table(spark, d, "events"), "value", "event_id", ["event_type"])
    return r.select("event_type", "n", _r("dw").alias("dw"))


_RESID_SQL = """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice - (f.a + f.b * l_quantity) AS e FROM lineitem, f)"""


@register("breusch_pagan", f"""
{_RESID_SQL}
SELECT count(*) AS n, round(count(*) * regr_r2(e * e, x), 4) AS lm, 1 AS dof FROM r
""")
def breusch_pagan(spark, d):
    li = table(spark, d, "lineitem")
    res = T.residuals(li, "l_extendedprice", ["l_quantity"], "e")
    out = T.breusch_pagan(res, "e", ["l_quantity"])
    return out.select("n", _r("lm", 4).alias("lm"), "dof")


_DUMMIES = ["CAST(l_returnflag = 'N' AS DOUBLE)", "CAST(l_returnflag = 'R' AS DOUBLE)", "CAST(l_linestatus = 'O' AS DOUBLE)", "l_discount"]


@register("breusch_pagan_categorical", f"""
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
r AS (SELECT l_returnflag, l_linestatus, l_discount, l_extendedprice - (f.a + f.b * l_quantity) AS e FROM lineitem, f),
{ols_sql("r", _DUMMIES, "e * e")}
SELECT n, round(n * (b1 * s1_y + b2 * s2_y + b3 * s3_y + b4 * s4_y) / syy, 4) AS lm, 4 AS dof FROM ols
""")
def breusch_pagan_categorical(spark, d):
    """Two string regressors, by level, and a number."""
    res = T.residuals(table(spark, d, "lineitem"), "l_extendedprice", ["l_quantity"], "e", keep=["l_returnflag", "l_linestatus", "l_discount"])
    out = T.breusch_pagan(res, "e", ["l_returnflag", "l_linestatus", "l_discount"])
    return out.select("n", _r("lm", 4).alias("lm"), "dof")


@register("vif_degenerate", """
SELECT 'l_quantity' AS column, CAST('Infinity' AS DOUBLE) AS vif UNION ALL SELECT 'twice', CAST('Infinity' AS DOUBLE)
UNION ALL SELECT 'same', CASE WHEN count(*) < 0 THEN 0.0::DOUBLE END FROM lineitem
UNION ALL SELECT 'l_discount', round(1 / (1 - power(corr(l_quantity, l_discount), 2)), 6) FROM lineitem
""")
def vif_degenerate(spark, d):
    """A column, a linear function of it, a constant, and one that depends on neither."""
    li = table(spark, d, "lineitem").withColumns({"twice": 2 * F.col("l_quantity") + 1, "same": F.lit(7.0)})
    return T.vif(li, ["l_quantity", "twice", "same", "l_discount"]).withColumn("vif", F.when(F.col("vif") < float("inf"), _r("vif")).otherwise(F.col("vif")))


@register("breusch_godfrey", """
WITH f AS (SELECT regr_slope(value, user_id) AS b, regr_intercept(value, user_id) AS a FROM events),
r AS (SELECT event_id, CAST(user_id AS DOUBLE) AS x, value - (f.a + f.b * user_id) AS e FROM events, f),
l AS (SELECT e, x, COALESCE(lag(e) OVER (ORDER BY event_id), 0) AS e1 FROM r),
c AS (SELECT count(*) AS n, corr(e, x) AS ryx, corr(e, e1) AS ry1, corr(x, e1) AS rx1 FROM l)
SELECT n, round(n * (ryx * ryx + ry1 * ry1 - 2 * ryx * ry1 * rx1) / (1 - rx1 * rx1), 4) AS lm, 1 AS dof FROM c
""")
def breusch_godfrey(spark, d):
    """Residuals of value ~ user_id, serial correlation in event_id order (unique key)."""
    ev = table(spark, d, "events")
    res = T.residuals(ev, "value", ["user_id"], "e", keep=["event_id"])
    out = T.breusch_godfrey(res, "e", ["user_id"], "event_id", 1)
    return out.select("n", _r("lm", 4).alias("lm"), "dof")


@register("vif", """
SELECT 'l_quantity' AS column, round(1 / (1 - power(corr(l_quantity, l_discount), 2)), 6) AS vif FROM lineitem
UNION ALL SELECT 'l_discount' AS column, round(1 / (1 - power(corr(l_quantity, l_discount), 2)), 6) AS vif FROM lineitem
""")
def vif(spark, d):
    return T.vif(table(spark, d, "lineitem"), ["l_quantity", "l_discount"]).withColumn("vif", _r("vif"))


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
@register("quality_unique", "SELECT o_custkey, count(*) AS count FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def quality_unique(spark, d):
    return D.check_unique(table(spark, d, "orders"), "o_custkey")


@register("quality_not_null", f"""
SELECT c_custkey, c_name FROM {_CO_SQL} WHERE o_orderkey IS NULL
""")
def quality_not_null(spark, d):
    return D.check_not_null(_customer_orders(spark, d), "o_orderkey").select("c_custkey", "c_name")


@register("domain_audit", "SELECT CAST(length(text) AS INTEGER) AS value, count(*) AS count FROM conversations GROUP BY 1")
def domain_audit(spark, d):
    return D.domain_audit(table(spark, d, "conversations"), F.length("text"))


# ---------------------------------------------------------------------------
# Model-based selectors (L2-L5, L9, L11-L13): forests and elastic nets are rows-only checks
# ---------------------------------------------------------------------------
def _model_frame(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_extendedprice")


@register("rf_importance")
def rf_importance(spark, d):
    return L.rf_importance(_model_frame(spark, d), "l_extendedprice", ["l_returnflag", "l_linestatus"],
                           ["l_quantity", "l_discount", "l_tax"], num_trees=10)


@register("rf_class_importance")
def rf_class_importance(spark, d):
    return L.rf_importance(_model_frame(spark, d), "l_returnflag", ["l_linestatus"], ["l_quantity", "l_discount", "l_tax"],
                           task="classification", num_trees=10)


_SELECT_FROM = ["l_quantity", "l_discount", "l_tax"]


def _top_features_sql(scores: str, top: int) -> str:
    """The ``top`` best scored features, the best first."""
    return (f"SELECT feature, CAST(row_number() OVER (ORDER BY score DESC) - 1 AS INTEGER) AS rank "
            f"FROM ({scores}) ORDER BY score DESC LIMIT {top}")


# every feature has the same degrees of freedom, so the order of r^2 (of F) is the order of the p-values
@register("univariate_selector_numeric", _top_features_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, power(corr({c}, l_extendedprice), 2) AS score FROM lineitem" for c in _SELECT_FROM), 2))
def univariate_selector_numeric(spark, d):
    return L.univariate_select(_model_frame(spark, d), "l_extendedprice", _SELECT_FROM, top=2)


def _index_sql(c: str) -> str:
    """The index of each value of ``c``, the most frequent first, as a table (v, i)."""
    return f"(SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS i FROM lineitem GROUP BY 1)"


_IMPORTANCE = ["l_returnflag_index", "l_linestatus_index", "l_quantity", "l_discount", "l_tax"]


@register("linear_importance", f"""
WITH r AS (SELECT a.i AS l_returnflag_index, b.i AS l_linestatus_index, l_quantity, l_discount, l_tax, l_extendedprice
           FROM lineitem JOIN {_index_sql("l_returnflag")} a ON a.v = l_returnflag JOIN {_index_sql("l_linestatus")} b ON b.v = l_linestatus),
{ols_sql("r", _IMPORTANCE, "l_extendedprice")}
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(b{i}, 2) AS coefficient FROM ols" for i, c in enumerate(_IMPORTANCE, 1)))
def linear_importance(spark, d):
    out = L.linear_importance(_model_frame(spark, d), "l_extendedprice", ["l_returnflag", "l_linestatus"],
                              ["l_quantity", "l_discount", "l_tax"], threshold=None)
    return out.withColumn("coefficient", _r("coefficient", 2))


@register("logistic_importance")
def logistic_importance(spark, d):
    return L.logistic_importance(_model_frame(spark, d), "l_linestatus", ["l_returnflag"],
                                 ["l_quantity", "l_discount", "l_tax"], threshold=None)


@register("rformula_rmse")
def rformula_rmse(spark, d):
    return L.rformula_rf_rmse(_model_frame(spark, d), "l_extendedprice ~ l_quantity + l_discount + l_returnflag",
                              num_trees=10)


@register("vector_slice", """
SELECT l_extendedprice AS label, l_quantity AS slot_0, l_discount AS slot_1,
       CASE WHEN l_returnflag = (SELECT l_returnflag FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
            THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS slot_3
FROM lineitem
""")
def vector_slice(spark, d):
    from pyspark.ml.functions import vector_to_array

    data = L.rformula(_model_frame(spark, d), "l_extendedprice ~ l_quantity + l_discount + l_tax + l_returnflag")
    kept = L.vector_slice(data, [0, 1, 3]).select("label", vector_to_array("sliced").alias("v"))
    return kept.select("label", *[F.col("v")[j].alias(f"slot_{i}") for j, i in enumerate((0, 1, 3))])


@register("chisq_selector", f"""WITH {_TRAITS_SQL}, {_chi_sql(_TRAITS, 'l_returnflag')},
s AS (SELECT feature, (cbrt(statistic / dof) - (1 - 2 / (9.0 * dof))) / sqrt(2 / (9.0 * dof)) AS score FROM x)
SELECT feature, CAST(row_number() OVER (ORDER BY score DESC) - 1 AS INTEGER) AS rank FROM s ORDER BY score DESC LIMIT 2""")
def chisq_selector(spark, d):
    return L.chisq_select(_traits(spark, d), "l_returnflag", _TRAITS, top=2)


@register("univariate_selector", _top_features_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, sum(n * power(m - total, 2)) / sum(n * v) AS score
    FROM (SELECT count(*) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM lineitem) AS total
          FROM lineitem GROUP BY l_returnflag)""" for c in _SELECT_FROM), 2))
def univariate_selector(spark, d):
    return L.univariate_select(_model_frame(spark, d), "l_returnflag", _SELECT_FROM, top=2)


_VARYING = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@register("variance_selector", "SELECT feature FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, var_samp({c}) AS v FROM lineitem" for c in _VARYING) + ") WHERE v > 0.5")
def variance_selector(spark, d):
    return L.variance_select(_model_frame(spark, d), _VARYING, 0.5)


_FOLD = "CAST('0x' || substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 15) AS BIGINT) % 3"
_RIDGE = (0.0, 0.1, 1000.0)


def _kfold_sql(lam: float) -> str:
    error = "l_extendedprice - b0 - b1 * l_quantity - b2 * l_discount - b3 * l_tax"
    return f"""(WITH f AS (SELECT *, {_FOLD} AS fold FROM lineitem), r AS (SELECT f.*, t.k FROM f JOIN range(3) t(k) ON f.fold <> t.k),
        {ols_sql("r", ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "k", f"1 + {lam!r} / sqrt(syy)")}
        SELECT CAST({lam!r} AS DOUBLE) AS reg_param, round(avg(rmse), 4) AS rmse FROM (
            SELECT g, sqrt(avg(power({error}, 2))) AS rmse FROM f JOIN ols ON f.fold = ols.g GROUP BY g))"""


@register("kfold_rmse", " UNION ALL ".join(f"SELECT * FROM {_kfold_sql(lam)}" for lam in _RIDGE))
def kfold_rmse(spark, d):
    """Every parameter from one scan; folds by a hash of the line's key."""
    out = L.kfold_rmse(table(spark, d, "lineitem"), "l_extendedprice ~ l_quantity + l_discount + l_tax", folds=3, reg_params=_RIDGE,
                       by=["l_orderkey", "l_linenumber"])
    return out.withColumn("rmse", _r("rmse", 4))


# the normal equations of three centred features, solved by the adjugate of their 3 x 3 matrix
@register("linear_diagnostics", """
WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3, avg(l_extendedprice) AS my,
         var_pop(l_quantity) AS s11, var_pop(l_discount) AS s22, var_pop(l_tax) AS s33, var_pop(l_extendedprice) AS syy,
         covar_pop(l_quantity, l_discount) AS s12, covar_pop(l_quantity, l_tax) AS s13, covar_pop(l_discount, l_tax) AS s23,
         covar_pop(l_quantity, l_extendedprice) AS s1y, covar_pop(l_discount, l_extendedprice) AS s2y,
         covar_pop(l_tax, l_extendedprice) AS s3y FROM lineitem),
a AS (SELECT *, s22 * s33 - s23 * s23 AS c11, s13 * s23 - s12 * s33 AS c12, s12 * s23 - s13 * s22 AS c13,
         s11 * s33 - s13 * s13 AS c22, s12 * s13 - s11 * s23 AS c23, s11 * s22 - s12 * s12 AS c33 FROM m),
d AS (SELECT *, s11 * c11 + s12 * c12 + s13 * c13 AS det FROM a),
b AS (SELECT *, (c11 * s1y + c12 * s2y + c13 * s3y) / det AS b1, (c12 * s1y + c22 * s2y + c23 * s3y) / det AS b2,
         (c13 * s1y + c23 * s2y + c33 * s3y) / det AS b3 FROM d),
e AS (SELECT *, my - b1 * m1 - b2 * m2 - b3 * m3 AS b0, syy - b1 * s1y - b2 * s2y - b3 * s3y AS mse0,
         (m1 * m1 * c11 + m2 * m2 * c22 + m3 * m3 * c33 + 2 * (m1 * m2 * c12 + m1 * m3 * c13 + m2 * m3 * c23)) / det AS h0 FROM b),
f AS (SELECT *, mse0 * n / (n - 4) AS v, 1 - mse0 / syy AS r,
         (SELECT avg(abs(l_extendedprice - e.b0 - e.b1 * l_quantity - e.b2 * l_discount - e.b3 * l_tax)) FROM lineitem, e) AS mae0 FROM e),
t AS (SELECT 'l_quantity' AS term, b1 AS c, b1 / sqrt(v * c11 / det / n) AS t, * FROM f
      UNION ALL SELECT 'l_discount', b2, b2 / sqrt(v * c22 / det / n), * FROM f
      UNION ALL SELECT 'l_tax', b3, b3 / sqrt(v * c33 / det / n), * FROM f
      UNION ALL SELECT 'intercept', b0, b0 / sqrt(v * (1 + h0) / n), * FROM f)
SELECT term, round(c, 4) AS coefficient, round(t, 4) AS t_value, round(r, 6) AS r2, round(1 - (1 - r) * (n - 1) / (n - 4), 6) AS r2_adj,
       round(mse0, 2) AS mse, round(sqrt(mse0), 4) AS rmse, round(mae0, 4) AS mae, round((syy - mse0) * n / 3 / v, 4) AS f_value
FROM t
""")
def linear_diagnostics(spark, d):
    """All but the tail probabilities, which DuckDB has no function for (tests/test_stats.py)."""
    out = T.linear_diagnostics(_model_frame(spark, d), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    digits = {"r2": 6, "r2_adj": 6, "mse": 2}
    return out.drop("p_value", "f_p_value").withColumns(
        {c: _r(c, digits.get(c, 4)) for c in ("coefficient", "t_value", "r2", "r2_adj", "mse", "rmse", "mae", "f_value")})


@register("ks_normal", f"""
WITH m AS (SELECT count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd FROM events),
c AS (SELECT value AS x, count(*) AS m FROM events WHERE value IS NOT NULL GROUP BY 1),
z AS (SELECT m.n, c.m, (c.x - m.mean) / m.sd AS z, sum(c.m) OVER (ORDER BY c.x) - c.m AS before FROM c, m),
f AS (SELECT *, {re.sub(r"(?<=[0-9])D", "::DOUBLE", T.normal_cdf_sql("z"))} AS f FROM z)
SELECT m.n, round(mean, 6) AS mean, round(sd, 6) AS stddev, round((SELECT max(greatest(f - before / n, (before + m) / n - f)) FROM f), 8) AS statistic FROM m
""")
def ks_normal(spark, d):
    """All but the p-value, which is held against the published table (tests/test_stats.py)."""
    out = T.ks_normal(table(spark, d, "events"), "value")
    return out.select("n", _r("mean").alias("mean"), _r("stddev").alias("stddev"), _r("statistic", 8).alias("statistic"))


# ---------------------------------------------------------------------------
# Registry flows end to end (Q1, Q4) on registry-shaped rows derived from the test tables
# ---------------------------------------------------------------------------
# Test-data e-mail domains (typos and clean names) cycled over orders.
EMAIL_DOMAINS = ["gmail", "gmial", "g-mail", "hotmial", "hotmail", "yaho", "outlok", "uol", "icloud",
                 "mail5.example", "terra", "bol"]
FLOW_PROVIDERS = ["GMAIL", "HOTMAIL", "YAHOO", "OUTLOOK", "UOL", "BOL", "ICLOUD", "TERRA"]


def flow_provider_map() -> dict:
    return X.typo_dictionary(FLOW_PROVIDERS, extra={"G-MAIL": "GMAIL"})


def _dict_values_sql(mapping: dict) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in sorted(mapping.items()))


def establishment_rows(spark, d) -> DataFrame:
    """Establishment-shaped rows: one per order, its customer as the company."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey",
                                           "c_mktsegment")
    x = J.lookup(o, c, "o_custkey", drop_key=False)
    local = F.lower(F.regexp_replace("c_name", "#", "."))
    domain = F.element_at(F.array(*[F.lit(v) for v in EMAIL_DOMAINS]),
                          (F.col("o_orderkey") % len(EMAIL_DOMAINS) + 1).cast("int"))
    email = (F.when(F.col("o_orderkey") % 11 == 0, local)
             .when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(local, F.lit("@"), domain, F.lit(".com"))))
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return x.select(
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("CNPJ_BASICO"),
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("CNPJ_ORDEM"),
        F.when(F.col("o_orderkey") % 3 == 0, "2").otherwise("1").alias("MATRIZ_FILIAL"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("SIT_CADASTRAL"),
        F.when(F.col("o_orderkey") % 97 == 0, "00000000").otherwise(day).alias("DT_SIT_CADASTRAL"),
        (F.col("o_custkey") % 5).cast("string").alias("MOTIVO_CADASTRAL"),
        (F.col("c_nationkey") % 5).cast("string").alias("PAIS"),
        day.alias("DT_INICIO_ATIVIDADE"),
        (F.col("o_custkey") % 30).cast("string").alias("CNAE_1"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("TIPO_LOUGRADOURO"),
        F.col("c_name").alias("LOGRADOURO"),
        F.nullif((F.col("o_orderkey") % 1000).cast("int"), F.lit(0)).alias("NUMERO"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("UF"),
        F.col("c_nationkey").cast("string").alias("MUNICIPIO"),
        email.alias("EMAIL"),
        F.lit(None).cast("string").alias("DT_SIT_ESPECIAL"))


ESTAB_OUT = ["CNPJ_BASICO", "CNPJ_ORDEM", "NM_SIT_CADASTRAL", "NM_MATRIZ_FILIAL", "DT_SIT_CADASTRAL",
             "DT_INICIO_ATIVIDADE", "ano_cadastro", "mes_cadastro", "ano_sit_cadastral", "mes_sit_cadastral", "NM_MOTIVO",
             "CNAE", "MUNICIPIO", "NM_PAIS", "ENDERECO_COMPLETO", "PROVEDOR", "EMAIL", "VALID_EMAIL"]


@register("establishments_flow", f"""
WITH dict(k, v) AS (VALUES {_dict_values_sql(flow_provider_map())}),
x AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, c.c_name, c.c_nationkey, c.c_mktsegment
      FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
e AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS CNPJ_BASICO, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS CNPJ_ORDEM,
        CASE WHEN o_orderkey % 3 = 0 THEN '2' ELSE '1' END AS MATRIZ_FILIAL,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS SIT_CADASTRAL,
        CASE WHEN o_orderkey % 97 = 0 THEN '00000000' ELSE strftime(o_orderdate, '%Y%m%d') END AS DT_SIT_RAW,
        CAST(o_custkey % 5 AS VARCHAR) AS COD_MOTIVO, CAST(c_nationkey % 5 AS VARCHAR) AS COD_PAIS,
        strftime(o_orderdate, '%Y%m%d') AS DT_INI_RAW, CAST(o_custkey % 30 AS VARCHAR) AS COD_CNAE,
        nullif(c_mktsegment, 'BUILDING') AS TIPO_LOUGRADOURO, c_name AS LOGRADOURO,
        nullif(CAST(o_orderkey % 1000 AS INTEGER), 0) AS NUMERO, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS UF,
        CAST(c_nationkey AS VARCHAR) AS ID_MUNICPIO,
        CASE WHEN o_orderkey % 11 = 0 THEN lower(replace(c_name, '#', '.')) WHEN o_orderkey % 13 = 0 THEN NULL
             ELSE lower(replace(c_name, '#', '.')) || '@' || {EMAIL_DOMAINS}[CAST(o_orderkey % {len(EMAIL_DOMAINS)} AS INTEGER) + 1] || '.com' END AS EMAIL_RAW
      FROM x),
j AS (SELECT e.*, mo.r_name AS NM_MOTIVO, 'CNAE ' || cn.n_name AS CNAE, mu.n_name AS MUNICIPIO, pa.r_name AS NM_PAIS,
        CAST(try_strptime(DT_SIT_RAW, '%Y%m%d') AS DATE) AS DT_SIT_CADASTRAL, CAST(try_strptime(DT_INI_RAW, '%Y%m%d') AS DATE) AS DT_INICIO_ATIVIDADE,
        upper(regexp_extract(EMAIL_RAW, '@([^.]+)\\.', 1)) AS PROV0, lower(EMAIL_RAW) AS EMAIL,
        regexp_extract(lower(EMAIL_RAW), '^\\S+@\\S+\\.\\S+$', 0) AS VALID0
      FROM e LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) mo ON e.COD_MOTIVO = CAST(mo.r_regionkey AS VARCHAR)
      LEFT JOIN nation cn ON e.COD_CNAE = CAST(cn.n_nationkey AS VARCHAR)
      LEFT JOIN nation mu ON e.ID_MUNICPIO = CAST(mu.n_nationkey AS VARCHAR)
      LEFT JOIN region pa ON e.COD_PAIS = CAST(pa.r_regionkey AS VARCHAR))
SELECT j.CNPJ_BASICO, j.CNPJ_ORDEM,
       CASE SIT_CADASTRAL WHEN 1 THEN 'NULA' WHEN 2 THEN 'ATIVA' WHEN 3 THEN 'SUSPENSA' WHEN 4 THEN 'INAPTA' WHEN 8 THEN 'BAIXADA' END AS NM_SIT_CADASTRAL,
       CASE TRY_CAST(MATRIZ_FILIAL AS INTEGER) WHEN 1 THEN 'MATRIZ' WHEN 2 THEN 'FILIAL' END AS NM_MATRIZ_FILIAL,
       DT_SIT_CADASTRAL, DT_INICIO_ATIVIDADE, CAST(year(DT_INICIO_ATIVIDADE) AS INTEGER) AS ano_cadastro,
       CAST(month(DT_INICIO_ATIVIDADE) AS INTEGER) AS mes_cadastro, CAST(year(DT_SIT_CADASTRAL) AS INTEGER) AS ano_sit_cadastral,
       CAST(month(DT_SIT_CADASTRAL) AS INTEGER) AS mes_sit_cadastral, NM_MOTIVO, CNAE, MUNICIPIO, NM_PAIS,
       concat_ws(', ', TIPO_LOUGRADOURO || ' ' || LOGRADOURO, CAST(NUMERO AS VARCHAR), concat_ws(' - ', MUNICIPIO, UF)) AS ENDERECO_COMPLETO,
       COALESCE(d1.v, PROV0) AS PROVEDOR, EMAIL,
       CASE WHEN regexp_matches(VALID0, '^([^@]*@)([^.@]+)(\\..*)$')
            THEN regexp_extract(VALID0, '^([^@]*@)([^.@]+)(\\..*)$', 1) || COALESCE(lower(d2.v), regexp_extract(VALID0, '^([^@]*@)([^.@]+)(\\..*)$', 2))
                 || regexp_extract(VALID0, '^([^@]*@)([^.@]+)(\\..*)$', 3)
            ELSE VALID0 END AS VALID_EMAIL
FROM j LEFT JOIN dict d1 ON d1.k = PROV0
LEFT JOIN dict d2 ON d2.k = upper(regexp_extract(VALID0, '^([^@]*@)([^.@]+)(\\..*)$', 2))
""")
def establishments_flow(spark, d):
    rows = establishment_rows(spark, d)
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    motivos = region.select(F.when(F.col("r_regionkey") < 3, F.col("r_regionkey").cast("string")).alias("COD_MOTIVO"),
                                                             F.col("r_name").alias("NM_MOTIVO"))
    cnaes = nation.select(F.col("n_nationkey").cast("string").alias("COD_CNAE"),
                          F.concat(F.lit("CNAE "), "n_name").alias("CNAE"))
    municipios = nation.select(F.col("n_nationkey").cast("string").alias("ID_MUNICPIO"), F.col("n_name").alias("MUNICIPIO"))
    paises = region.select(F.col("r_regionkey").cast("string").alias("COD_PAIS"), F.col("r_name").alias("NM_PAIS"))
    from .registry import process_establishments

    out = process_establishments(rows, motivos, cnaes, municipios, paises, flow_provider_map())
    return out.select(*ESTAB_OUT)


def company_rows(spark, d) -> DataFrame:
    """Company-shaped rows: one per customer; names from its part, an id-like digit run of
    11, 14 or 8 digits."""
    c = table(spark, d, "customer")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("c_custkey"), "p_name")
    x = J.lookup(c, p, "c_custkey", drop_key=False)
    width = F.when(F.col("c_custkey") % 3 == 0, 11).when(F.col("c_custkey") % 3 == 1, 14).otherwise(8)
    return x.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("CNPJ"),
        F.concat(F.coalesce(F.upper("p_name"), F.lit("SEM NOME")), F.lit(" "),
                 F.lpad(F.col("c_custkey").cast("string"), width, F.lit("0"))).alias("NOME_EMPRESA"),
        (F.col("c_nationkey") % 5).cast("string").alias("COD_NAT_JURICA"),
        F.col("c_nationkey").cast("string").alias("QUALIF_RESPONVAVEL"),
        F.regexp_replace(F.format_string("%.2f", "c_acctbal"), r"\.", ",").alias("CAP_SOCIAL"),
        F.lpad((F.col("c_nationkey") % 10).cast("string"), 2, "0").alias("PORTE"),
        F.col("c_mktsegment").alias("ENTE_FEDERATIVO"))


def name_rows(spark, d) -> DataFrame:
    """First-name dictionary shaped rows from part names (adjective = name, noun = alias)."""
    p = table(spark, d, "part")
    first = F.upper(F.split_part("p_name", F.lit(" "), F.lit(1)))
    second = F.upper(F.split_part("p_name", F.lit(" "), F.lit(2)))
    return p.select(first.alias("first_name"),
                    F.when(F.col("p_partkey") % 7 == 0, F.lit(None).cast("string"))
                    .otherwise(F.concat(first, F.lit("|"), second)).alias("alternative_names"),
                    first.alias("group_name"), (F.col("p_retailprice") / 2000.0).alias("ratio"),
                    F.when(F.col("p_size") % 2 == 0, "F").otherwise("M").alias("classification"))


@register("sole_traders_flow", f"""
WITH emp AS (SELECT lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') AS CNPJ,
        COALESCE(upper(p.p_name), 'SEM NOME') || ' ' || lpad(CAST(c.c_custkey AS VARCHAR), CASE c.c_custkey % 3 WHEN 0 THEN 11 WHEN 1 THEN 14 ELSE 8 END, '0') AS NOME_EMPRESA,
        CAST(c.c_nationkey % 5 AS VARCHAR) AS COD_NAT_JURICA, CAST(c.c_nationkey AS VARCHAR) AS COD_QUALIFICACAO,
        replace(printf('%.2f', c.c_acctbal), '.', ',') AS CAP_SOCIAL, lpad(CAST(c.c_nationkey % 10 AS VARCHAR), 2, '0') AS PORTE,
        c.c_mktsegment AS ENTE_FEDERATIVO
      FROM customer c LEFT JOIN part p ON c.c_custkey = p.p_partkey),
comp AS (SELECT e.*, r.r_name AS NAT_JURICA, n.n_name AS NM_QUALIFICACAO, nullif(regexp_replace(NOME_EMPRESA, '[^0-9]', '', 'g'), '') AS CPF
      FROM emp e LEFT JOIN region r ON e.COD_NAT_JURICA = CAST(r.r_regionkey AS VARCHAR)
      LEFT JOIN nation n ON e.COD_QUALIFICACAO = CAST(n.n_nationkey AS VARCHAR)),
c2 AS (SELECT *, CAST(length(CPF) AS INTEGER) AS CPF_LEN,
        CASE TRY_CAST(PORTE AS INTEGER) WHEN 0 THEN 'NÃO INFORMADO' WHEN 1 THEN 'MICRO EMPRESA' WHEN 3 THEN 'EMPRESA DE PEQUENO PORTE'
             WHEN 5 THEN 'DEMAIS' WHEN 8 THEN 'BAIXADA' END AS NM_PORTE,
        CASE WHEN length(CPF) = 11 THEN 'SIM' ELSE 'NAO' END AS PROBABILIDADE_DE_SER_CPF,
        CASE WHEN CPF IS NOT NULL THEN sha256('{TOKEN_KEY}' || CPF) END AS CPF_CRIPTOGRAFADO FROM comp),
mei AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CPF_CRIPTOGRAFADO, NOME_EMPRESA
        ORDER BY CNPJ DESC, CAP_SOCIAL DESC, ENTE_FEDERATIVO DESC) AS rn FROM c2 WHERE PROBABILIDADE_DE_SER_CPF = 'SIM') WHERE rn = 1),
names AS (SELECT upper(split_part(p_name, ' ', 1)) AS first_name,
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE upper(split_part(p_name, ' ', 1)) || '|' || upper(split_part(p_name, ' ', 2)) END AS alternative_names,
        upper(split_part(p_name, ' ', 1)) AS group_name, p_retailprice / 2000.0 AS ratio,
        CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'M' END AS classification FROM part),
alts AS (SELECT unnest(string_split(COALESCE(alternative_names, first_name), '|')) AS alt, group_name, ratio, classification FROM names),
dict AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY alt ORDER BY ratio DESC, group_name DESC, classification DESC) AS rn FROM alts) WHERE rn = 1)
SELECT DISTINCT m.CNPJ, m.NOME_EMPRESA, m.CAP_SOCIAL, m.NM_PORTE, m.NAT_JURICA, m.ENTE_FEDERATIVO, m.NM_QUALIFICACAO, m.CPF_CRIPTOGRAFADO,
       m.CPF_LEN, m.PROBABILIDADE_DE_SER_CPF, split_part(m.NOME_EMPRESA, ' ', 1) AS PRIMEIRO_NOME, d.group_name AS GRUPO_NOME,
       d.ratio AS PROBABILIDADE_CLASSIFICACAO, d.classification AS CLASSIFICACAO
FROM mei m LEFT JOIN dict d ON split_part(m.NOME_EMPRESA, ' ', 1) = d.alt
""")
def sole_traders_flow(spark, d):
    from .registry import process_sole_traders

    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    naturezas = region.select(F.col("r_regionkey").cast("string").alias("COD_NAT_JURICA"), F.col("r_name").alias("NAT_JURICA"))
    qualificacoes = nation.select(F.col("n_nationkey").cast("string").alias("COD_QUALIFICACAO"),
                                  F.col("n_name").alias("NM_QUALIFICACAO"))
    return process_sole_traders(company_rows(spark, d), naturezas, qualificacoes, name_rows(spark, d), TOKEN_KEY, "sha2")


def partner_rows(spark, d) -> DataFrame:
    """Partner-shaped rows: one per supplier, named after its part, coded from its keys."""
    s = table(spark, d, "supplier")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("s_suppkey"), "p_name")
    x = J.lookup(s, p, "s_suppkey", drop_key=False)
    return x.select(
        F.lpad((F.col("s_suppkey") % 500).cast("string"), 8, "0").alias("CNPJ_BASICO"),
        (F.col("s_suppkey") % 4).cast("int").alias("IDENTIFICADOR_SOCIO"),
        F.concat(F.coalesce(F.upper("p_name"), F.lit("SEM NOME")), F.lit(" "), F.col("s_name")).alias("NOME_SOCIO_RAZAO_SOCIAL"),
        F.lpad(F.col("s_suppkey").cast("string"), 11, "0").alias("CNPJ_CPF_SOCIO"),
        F.col("s_nationkey").cast("string").alias("QUALIFICAÇAO_SOCIO"),
        F.when(F.col("s_suppkey") % 9 == 0, "0").otherwise(F.concat(F.lit("2015"), F.lpad(((F.col("s_suppkey") % 12) + 1)
               .cast("string"), 2, "0"), F.lit("15"))).alias("DATA_ENTRADA_SOCIEDADE"),
        (F.col("s_nationkey") % 5).cast("string").alias("PAIS"),
        F.lit("***").alias("REPRESENTANTE_LEGAL"),
        F.lit(None).cast("string").alias("NOME_REPRESENTANTE"),
        ((F.col("s_nationkey") + 1) % 25).cast("string").alias("QUALIFICACAO_REPRESENTANTE_LEGAL"),
        (F.col("s_suppkey") % 11).cast("string").alias("FAIXA_ETARIA"))


_AGE_SQL = " ".join(f"WHEN {k} THEN '{v}'" for k, v in X.AGE_BAND.items())
_PARTNER_TYPE_SQL = " ".join(f"WHEN {k} THEN '{v}'" for k, v in X.PARTNER_TYPE.items())


@register("partners_flow", f"""
WITH sp AS (SELECT s.*, p.p_name FROM supplier s LEFT JOIN part p ON s.s_suppkey = p.p_partkey),
so AS (SELECT lpad(CAST(s_suppkey % 500 AS VARCHAR), 8, '0') AS CNPJ_BASICO, CAST(s_suppkey % 4 AS INTEGER) AS IDENTIFICADOR_SOCIO,
        COALESCE(upper(p_name), 'SEM NOME') || ' ' || s_name AS NOME_SOCIO_RAZAO_SOCIAL, lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS CNPJ_CPF_SOCIO,
        CAST(s_nationkey AS VARCHAR) AS QUALIFICACAO_SOCIO,
        CASE WHEN s_suppkey % 9 = 0 THEN '0' ELSE '2015' || lpad(CAST(s_suppkey % 12 + 1 AS VARCHAR), 2, '0') || '15' END AS DATA_ENTRADA_SOCIEDADE,
        CAST(s_nationkey % 5 AS VARCHAR) AS PAIS, '***' AS REPRESENTANTE_LEGAL, CAST(NULL AS VARCHAR) AS NOME_REPRESENTANTE,
        CAST((s_nationkey + 1) % 25 AS VARCHAR) AS QUALIFICACAO_REPRESENTANTE_LEGAL, CAST(s_suppkey % 11 AS VARCHAR) AS FAIXA_ETARIA FROM sp),
names AS (SELECT upper(split_part(p_name, ' ', 1)) AS first_name,
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE upper(split_part(p_name, ' ', 1)) || '|' || upper(split_part(p_name, ' ', 2)) END AS alternative_names,
        upper(split_part(p_name, ' ', 1)) AS group_name, p_retailprice / 2000.0 AS ratio,
        CASE WHEN p_size % 2 = 0 THEN 'F' ELSE 'M' END AS classification FROM part),
alts AS (SELECT unnest(string_split(alternative_names, '|')) AS alt, group_name, ratio, classification FROM names WHERE alternative_names IS NOT NULL),
dict AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY alt ORDER BY ratio DESC, group_name DESC, classification DESC) AS rn FROM alts) WHERE rn = 1)
SELECT DISTINCT so.CNPJ_BASICO, so.NOME_SOCIO_RAZAO_SOCIAL, so.CNPJ_CPF_SOCIO, so.REPRESENTANTE_LEGAL, so.NOME_REPRESENTANTE,
       pa.r_name AS NM_PAIS, CASE TRY_CAST(so.FAIXA_ETARIA AS INTEGER) {_AGE_SQL} END AS NM_FAIXA_ETARIA,
       CASE so.IDENTIFICADOR_SOCIO {_PARTNER_TYPE_SQL} END AS NM_IDENTIFICADOR_SOCIO,
       ql.n_name AS NM_QUALIFICACAO_REPRESENTANTE_LEGAL, qs.n_name AS "NM_QUALIFICAÇAO_SOCIO",
       CAST(try_strptime(so.DATA_ENTRADA_SOCIEDADE, '%Y%m%d') AS DATE) AS DT_ENTRADA_SOCIEDADE,
       split_part(so.NOME_SOCIO_RAZAO_SOCIAL, ' ', 1) AS PRIMEIRO_NOME, d.ratio AS PROBABILIDADE_CLASSIFICACAO, d.classification AS CLASSIFICACAO
FROM so LEFT JOIN region pa ON so.PAIS = CAST(pa.r_regionkey AS VARCHAR)
LEFT JOIN nation ql ON so.QUALIFICACAO_REPRESENTANTE_LEGAL = CAST(ql.n_nationkey AS VARCHAR)
LEFT JOIN nation qs ON so.QUALIFICACAO_SOCIO = CAST(qs.n_nationkey AS VARCHAR)
LEFT JOIN dict d ON split_part(so.NOME_SOCIO_RAZAO_SOCIAL, ' ', 1) = d.alt
""")
def partners_flow(spark, d):
    from .registry import process_partners

    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    paises = region.select(F.col("r_regionkey").cast("string").alias("COD_PAIS"), F.col("r_name").alias("NM_PAIS"))
    qualificacoes = nation.select(F.col("n_nationkey").cast("string").alias("COD_QUALIFICACAO"),
                                  F.col("n_name").alias("NM_QUALIFICACAO"))
    return process_partners(partner_rows(spark, d), paises, qualificacoes, name_rows(spark, d))


def phone_rows(spark, d) -> DataFrame:
    """Final-table-shaped rows (one per customer) with formatted, partly broken phones."""
    c = table(spark, d, "customer")
    ddd = F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
    tel8 = F.concat(F.lpad(F.floor(F.abs("c_acctbal")).cast("bigint").cast("string"), 4, "0"),
                    F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"))
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int"))
    return c.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("CNPJ"),
        F.col("c_name").alias("NOME_EMPRESA"),
        F.sha2(F.concat(F.lit(TOKEN_KEY), F.lpad(F.col("c_custkey").cast("string"), 11, "0")), 256).alias("CPF_CRIPTOGRAFADO"),
        ddd.alias("UF"),
        F.when(F.col("c_custkey") % 17 == 0, F.concat(F.lit("("), ddd, F.lit(")"))).otherwise(ddd).alias("DDD1"),
        F.when(F.col("c_custkey") % 19 == 0, F.lit(None).cast("string"))
        .when(F.col("c_custkey") % 23 == 0, F.concat(tel8, F.lit("9")))
        .otherwise(F.concat(F.substring(tel8, 1, 4), F.lit("-"), F.substring(tel8, 5, 4))).alias("TEL1"),
        day.alias("DT_SIT_CADASTRAL"), F.year(day).alias("ano_sit_cadastral"),
        (F.lit(2000) + F.col("c_custkey") % 20).cast("int").alias("ano_cadastro"))


def operator_rows(spark) -> DataFrame:
    """Operator table (5-digit mobile prefixes, float-rendered) built from the range seed."""
    r = expand_ranges(spark)
    return r.select(F.lit("11").alias("DDD"), F.upper("operadora").alias("OPERADORA"),
                    F.concat(F.lit("9"), F.col("faixa").cast("string"), F.lit(".0")).alias("faixa"),
                    F.col("uf").alias("UF"), F.concat(F.lit("REGIAO "), F.col("uf")).alias("CIDADES_REGIOES_PRINCIPAIS"))


@register("phones_flow", f"""
WITH f AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CNPJ, c_name AS NOME_EMPRESA,
        sha256('{TOKEN_KEY}' || lpad(CAST(c_custkey AS VARCHAR), 11, '0')) AS CPF_CRIPTOGRAFADO,
        CASE WHEN c_custkey % 17 = 0 THEN '(' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ')'
             ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS DDD1,
        CASE WHEN c_custkey % 19 = 0 THEN NULL
             WHEN c_custkey % 23 = 0 THEN lpad(CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR), 4, '0') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '9'
             ELSE lpad(CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR), 4, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS TEL1,
        CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS DT_SIT_CADASTRAL,
        CAST(year(CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE)) AS INTEGER) AS ano_sit_cadastral,
        CAST(2000 + c_custkey % 20 AS INTEGER) AS ano_cadastro
      FROM customer),
r AS ({_RANGES_SQL}),
ops AS (SELECT '11' AS DDD, upper(operadora) AS OPERADORA, '9' || CAST(faixa AS VARCHAR) || '.0' AS faixa, uf AS UF,
        'REGIAO ' || uf AS CIDADES_REGIOES_PRINCIPAIS FROM r),
t AS (SELECT CPF_CRIPTOGRAFADO, DDD1, regexp_replace(TEL1, '[^0-9]', '', 'g') AS tel, regexp_replace(DDD1, '[^0-9]', '', 'g') AS ddd
      FROM f WHERE TEL1 IS NOT NULL AND TEL1 <> 'null'),
k AS (SELECT *, {_PHONE_SQL} AS cls FROM t WHERE length(ddd) = 2 AND length(tel) = 8),
m AS (SELECT k.*, CASE WHEN cls = 'VALIDACAO_ESPECIAL' AND r.faixa IS NULL THEN 'TELEFONE FIXO'
                       WHEN cls = 'VALIDACAO_ESPECIAL' AND r.faixa IS NOT NULL THEN 'TELEFONE CELULAR' ELSE cls END AS final
      FROM k LEFT JOIN r ON TRY_CAST(k.ddd AS INTEGER) = r.ddd AND TRY_CAST(substr(k.tel, 1, 4) AS INTEGER) = r.faixa),
h AS (SELECT m.CPF_CRIPTOGRAFADO, m.tel AS TEL1, m.ddd AS DDD1, m.final AS TIPO_TELEFONE, o.OPERADORA,
             regexp_replace(o.faixa, '\\.0$', '') AS FAIXA_CEL, o.UF, o.CIDADES_REGIOES_PRINCIPAIS
      FROM m LEFT JOIN ops o ON (CASE WHEN m.final = 'TELEFONE CELULAR' THEN '9' || substr(m.tel, 1, 4) ELSE 'TELEFONE FIXO' END)
           = regexp_replace(o.faixa, '\\.0$', '') AND m.DDD1 = o.DDD),
b AS (SELECT DISTINCT CNPJ, NOME_EMPRESA, CPF_CRIPTOGRAFADO, DT_SIT_CADASTRAL, ano_sit_cadastral, ano_cadastro FROM f)
SELECT b.*, h.TEL1, h.DDD1, h.TIPO_TELEFONE, h.OPERADORA, h.FAIXA_CEL, h.UF, h.CIDADES_REGIOES_PRINCIPAIS
FROM b LEFT JOIN h ON b.CPF_CRIPTOGRAFADO = h.CPF_CRIPTOGRAFADO
""")
def phones_flow(spark, d):
    from .phones import treat_phones

    return treat_phones(phone_rows(spark, d), operator_rows(spark))


SQL_MODEL_OUT = ["CNPJ_ORDEM", "PROVEDOR", "EMAIL_LOWER", "MUNICIPIO_NOME", "NM_PAIS", "CNAE", "NM_MOTIVO",
                 "NM_SIT_CADASTRAL", "DT_SIT_CADASTRAL_DATE", "DT_INICIO_ATIVIDADE_DATE", "ENDERECO_COMPLETO",
                 "ANO_SIT_CADASTRAL", "MES_SIT_CADASTRAL", "PROVEDOR_VALIDO"]


@register("sql_model", f"""
WITH e0 AS (SELECT lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS CNPJ_ORDEM, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS SIT_CADASTRAL,
        CASE WHEN o.o_orderkey % 97 = 0 THEN '00000000' ELSE strftime(o.o_orderdate, '%Y%m%d') END AS DT_SIT_CADASTRAL,
        strftime(o.o_orderdate, '%Y%m%d') AS DT_INICIO_ATIVIDADE, CAST(o.o_custkey % 5 AS VARCHAR) AS MOTIVO_CADASTRAL,
        CAST(c.c_nationkey % 5 AS VARCHAR) AS PAIS, CAST(o.o_custkey % 30 AS VARCHAR) AS CNAE_1,
        nullif(c.c_mktsegment, 'BUILDING') AS TIPO_LOUGRADOURO, c.c_name AS LOGRADOURO,
        nullif(CAST(o.o_orderkey % 1000 AS INTEGER), 0) AS NUMERO, lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS UF,
        CAST(c.c_nationkey AS VARCHAR) AS MUNICIPIO,
        CASE WHEN o.o_orderkey % 11 = 0 THEN lower(replace(c.c_name, '#', '.')) WHEN o.o_orderkey % 13 = 0 THEN NULL
             ELSE lower(replace(c.c_name, '#', '.')) || '@' || {EMAIL_DOMAINS}[CAST(o.o_orderkey % {len(EMAIL_DOMAINS)} AS INTEGER) + 1] || '.com' END AS EMAIL
      FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
es AS (SELECT e.*, string_split(string_split(upper(e.EMAIL), '@')[2], '.')[1] AS PROVEDOR, lower(e.EMAIL) AS EMAIL_LOWER,
        m.n_name AS MUNICIPIO_NOME, p.r_name AS NM_PAIS, 'CNAE ' || cn.n_name AS CNAE, mo.r_name AS NM_MOTIVO,
        CASE WHEN SIT_CADASTRAL = 1 THEN 'NULA' WHEN SIT_CADASTRAL = 2 THEN 'ATIVA' WHEN SIT_CADASTRAL = 3 THEN 'SUSPENSA'
             WHEN SIT_CADASTRAL = 4 THEN 'INAPTA' WHEN SIT_CADASTRAL = 8 THEN 'BAIXADA' ELSE 'OUTRO' END AS NM_SIT_CADASTRAL,
        CAST(try_strptime(e.DT_SIT_CADASTRAL, '%Y%m%d') AS DATE) AS DT_SIT_CADASTRAL_DATE,
        CAST(try_strptime(e.DT_INICIO_ATIVIDADE, '%Y%m%d') AS DATE) AS DT_INICIO_ATIVIDADE_DATE
      FROM e0 e LEFT JOIN nation m ON e.MUNICIPIO = CAST(m.n_nationkey AS VARCHAR)
      LEFT JOIN region p ON e.PAIS = CAST(p.r_regionkey AS VARCHAR)
      LEFT JOIN nation cn ON e.CNAE_1 = CAST(cn.n_nationkey AS VARCHAR)
      LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) mo ON e.MOTIVO_CADASTRAL = CAST(mo.r_regionkey AS VARCHAR)),
dp AS (SELECT unnest({[p for p in FLOW_PROVIDERS]}) AS PROVEDOR_VALIDO)
SELECT CNPJ_ORDEM, es.PROVEDOR, EMAIL_LOWER, MUNICIPIO_NOME, NM_PAIS, CNAE, NM_MOTIVO, NM_SIT_CADASTRAL, DT_SIT_CADASTRAL_DATE,
       DT_INICIO_ATIVIDADE_DATE,
       TIPO_LOUGRADOURO || ' ' || LOGRADOURO || ', ' || CAST(NUMERO AS VARCHAR) || ' - ' || MUNICIPIO_NOME || ', ' || UF AS ENDERECO_COMPLETO,
       CAST(EXTRACT(YEAR FROM DT_SIT_CADASTRAL_DATE) AS INTEGER) AS ANO_SIT_CADASTRAL,
       CAST(EXTRACT(MONTH FROM DT_SIT_CADASTRAL_DATE) AS INTEGER) AS MES_SIT_CADASTRAL, dp.PROVEDOR_VALIDO
FROM es LEFT JOIN dp ON es.PROVEDOR = dp.PROVEDOR_VALIDO
""")
def sql_model(spark, d):
    """Q9 + Q10: the SQL establishment model run by spark.sql over temp views, then read
    through the pass-through model."""
    from .sql_models import passthrough, sql_establishments

    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    views = {
        "estabelecimentos": establishment_rows(spark, d),
        "municipios": nation.select(F.col("n_nationkey").cast("string").alias("ID_MUNICPIO"),
                                    F.col("n_name").alias("MUNICIPIO")),
        "paises": region.select(F.col("r_regionkey").cast("string").alias("COD_PAIS"), F.col("r_name").alias("NM_PAIS")),
        "cnaes": nation.select(F.col("n_nationkey").cast("string").alias("COD_CNAE"),
                               F.concat(F.lit("CNAE "), "n_name").alias("CNAE")),
        "motivos": region.select(F.when(F.col("r_regionkey") < 3, F.col("r_regionkey").cast("string")).alias("COD_MOTIVO"),
                                                                  F.col("r_name").alias("NM_MOTIVO")),
        "dicionario_provedores": spark.createDataFrame([(p,) for p in FLOW_PROVIDERS], "PROVEDOR_VALIDO string"),
    }
    names = {}
    for name, frame in views.items():
        names[name] = f"rs_q9_{name}"
        frame.createOrReplaceTempView(names[name])
    sql_establishments(spark, names).createOrReplaceTempView("rs_q9_model")
    return passthrough(spark, "rs_q9_model").select(*SQL_MODEL_OUT) \
        .withColumns({"ANO_SIT_CADASTRAL": F.col("ANO_SIT_CADASTRAL").cast("int"),
                      "MES_SIT_CADASTRAL": F.col("MES_SIT_CADASTRAL").cast("int")})


# ---------------------------------------------------------------------------
# Operators on the remaining test tables (labels, embeddings, pages, conversations)
# ---------------------------------------------------------------------------
_DL_COLS = ["doc_id", "lang", "source", "quality", "toxic"]


@register("labels_missing", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
    f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) AS pct "
    f"FROM (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
    for c in _DL_COLS))
def labels_missing(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    lab = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return A.missing_table(J.lookup(docs, lab, "doc_id", drop_key=False).select(*_DL_COLS))


@register("labels_chi_square", """
WITH t AS (SELECT CAST(toxic AS VARCHAR) AS a, CAST(quality AS VARCHAR) AS b, count(*) AS o FROM labels GROUP BY 1, 2),
ra AS (SELECT a, sum(o) AS na FROM t GROUP BY 1), rb AS (SELECT b, sum(o) AS nb FROM t GROUP BY 1),
n AS (SELECT sum(o) AS n FROM t),
g AS (SELECT ra.a, rb.b, ra.na * rb.nb / n.n AS e, COALESCE(t.o, 0) AS o FROM ra, rb, n LEFT JOIN t ON t.a = ra.a AND t.b = rb.b)
SELECT 'toxic' AS feature, round(sum((o - e) * (o - e) / e), 6) AS statistic,
       ((SELECT count(*) FROM ra) - 1) * ((SELECT count(*) FROM rb) - 1) AS dof FROM g
""")
def labels_chi_square(spark, d):
    lab = table(spark, d, "labels").select(F.col("toxic").cast("string").alias("toxic"),
                                          F.col("quality").cast("string").alias("quality"))
    r = L.chi_square_test(lab, "quality", ["toxic"])
    return r.select("feature", _r("statistic").alias("statistic"), F.col("dof").cast("long").alias("dof"))


@register("embedding_corr", """
WITH x AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT 'e' || a.i AS column_a, 'e' || b.i AS column_b,
       CASE WHEN a.i = b.i THEN CAST(1.0 AS DOUBLE) ELSE round(corr(CAST(a.v AS DOUBLE), CAST(b.v AS DOUBLE)), 6) END AS corr
FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY a.i, b.i
""")
def embedding_corr(spark, d):
    """All positions: one pass over the vectors; the k x k matrix is all that comes back."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Correlation

    e = table(spark, d, "embeddings").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    m = Correlation.corr(e, "v").first()[0].toArray()
    rows = [(f"e{i}", f"e{j}", 1.0 if i == j else float(m[i, j])) for i in range(len(m)) for j in range(len(m))]
    return spark.createDataFrame(rows, "column_a string, column_b string, corr double").withColumn("corr", _r("corr"))


@register("pages_host_freq", """
SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, count(*) AS count FROM pages GROUP BY 1
""")
def pages_host_freq(spark, d):
    p = table(spark, d, "pages").select(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("host"))
    return A.freq(p, "host")


@register("conversation_role_share", """
SELECT role, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM conversations), 2) AS pct
FROM conversations GROUP BY 1
""")
def conversation_role_share(spark, d):
    return A.share(table(spark, d, "conversations"), "role")


# ---------------------------------------------------------------------------
# EDA questions (Q11) on the derived registry flows
# ---------------------------------------------------------------------------
@register("eda_status_by_year", f"""
WITH est AS ({ORACLE_SQL["establishments_flow"]})
SELECT ano_cadastro, NM_SIT_CADASTRAL, count(*) AS count FROM est GROUP BY 1, 2
""")
def eda_status_by_year(spark, d):
    return A.freq(establishments_flow(spark, d), ["ano_cadastro", "NM_SIT_CADASTRAL"])


_CAP_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@register("eda_capital_by_size", f"""
WITH m AS ({ORACLE_SQL["sole_traders_flow"]}),
c AS (SELECT NM_PORTE, TRY_CAST(replace(CAP_SOCIAL, ',', '.') AS DOUBLE) AS cap FROM m)
SELECT NM_PORTE, count(cap) AS n, round(avg(cap), 4) AS mean, min(cap) AS min,
       {", ".join(f"quantile_disc(cap, {p}) AS {A.pct_name(p)}" for p in _CAP_PROBS)}, max(cap) AS max
FROM c GROUP BY 1
""")
def eda_capital_by_size(spark, d):
    m = P.decimal_comma(sole_traders_flow(spark, d), ["CAP_SOCIAL"])
    prof = A.group_profile(m, "NM_PORTE", "CAP_SOCIAL", _CAP_PROBS, exact=True)
    return prof.withColumn("mean", _r("mean", 4))


# The exploratory questions, each through eda_tables, on rows shaped like the final table:
# one per order with its customer and nation; capital is the order's price.
_EDA_SQL = """
SELECT o.o_totalprice AS CAP_SOCIAL, CAST(year(o.o_orderdate) AS INTEGER) AS ano_cadastro, n.n_name AS UF,
       CASE substr(o.o_orderpriority, 1, 1) WHEN '2' THEN 'ATIVA' WHEN '3' THEN 'SUSPENSA' WHEN '4' THEN 'INAPTA'
            WHEN '5' THEN 'BAIXADA' END AS NM_SIT_CADASTRAL,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'FILIAL' ELSE 'MATRIZ' END AS NM_MATRIZ_FILIAL,
       'CNAE ' || CAST(o.o_custkey % 30 AS VARCHAR) AS CNAE,
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'SEM MOTIVO' ELSE c.c_mktsegment END AS NM_MOTIVO,
       CASE o.o_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS CLASSIFICACAO,
       CASE o.o_custkey % 4 WHEN 0 THEN 'FIXO' WHEN 1 THEN NULL ELSE 'CELULAR' END AS TIPO_TELEFONE,
       'PROVEDOR ' || CAST(o.o_custkey % 37 AS VARCHAR) AS PROVEDOR,
       'OPERADORA ' || CAST(o.o_custkey % 41 AS VARCHAR) AS OPERADORA
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def eda_rows(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment",
                                           F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("UF"))
    x = J.lookup(J.lookup(o, c, "o_custkey", drop_key=False), n, "n_nationkey")
    key = F.col("o_custkey")

    def numbered(word: str, m: int):
        return F.concat(F.lit(word + " "), (key % m).cast("string"))

    status = X.decode(F.nullif(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(1)),
                      {2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 5: "BAIXADA"})
    return x.select(
        F.col("o_totalprice").alias("CAP_SOCIAL"), F.year("o_orderdate").alias("ano_cadastro"), "UF",
        status.alias("NM_SIT_CADASTRAL"),
        F.when(F.col("o_orderkey") % 3 == 0, "FILIAL").otherwise("MATRIZ").alias("NM_MATRIZ_FILIAL"),
        numbered("CNAE", 30).alias("CNAE"),
        F.when(F.col("c_mktsegment") == "BUILDING", "SEM MOTIVO").otherwise(F.col("c_mktsegment")).alias("NM_MOTIVO"),
        F.when(key % 3 == 0, "F").when(key % 3 == 1, "M").alias("CLASSIFICACAO"),
        F.when(key % 4 == 0, "FIXO").when(key % 4 != 1, "CELULAR").alias("TIPO_TELEFONE"),
        numbered("PROVEDOR", 37).alias("PROVEDOR"), numbered("OPERADORA", 41).alias("OPERADORA"))


def _eda_freq(keys: str, where: str = "", top: int | None = None) -> str:
    order = f" ORDER BY count DESC, {keys} LIMIT {top}" if top else ""
    return f"SELECT {keys}, count(*) AS count FROM e {where} GROUP BY ALL{order}"


def _eda_share(key: str, where: str = "") -> str:
    return (f"SELECT {key}, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM e {where}), 2) AS pct "
            f"FROM e {where} GROUP BY ALL")


def _eda_profile(key: str, where: str, top: int | None = None) -> str:
    order = f" ORDER BY n DESC, {key} NULLS FIRST LIMIT {top}" if top else ""
    return (f"SELECT {key}, count(CAP_SOCIAL) AS n, round(avg(CAP_SOCIAL), 4) AS mean, min(CAP_SOCIAL) AS min, "
            + ", ".join(f"quantile_disc(CAP_SOCIAL, {p}) AS {A.pct_name(p)}" for p in A.PROFILE_PROBS)
            + f", max(CAP_SOCIAL) AS max FROM e {where} GROUP BY ALL{order}")


_EDA_POPULATION = "SELECT n_name AS UF, CAST((n_nationkey + 1) * 100000 AS BIGINT) AS Pop FROM nation"
_EDA_WIDTH = "((hi - lo) / 20.0)"
EDA_QUESTIONS = {
    "status_mix": _eda_share("NM_SIT_CADASTRAL", "WHERE NM_SIT_CADASTRAL IS NOT NULL"),
    "per_state": _eda_share("UF"),
    "status_by_state": _eda_freq("UF, NM_SIT_CADASTRAL"),
    "per_year_branch": _eda_freq("ano_cadastro, NM_MATRIZ_FILIAL"),
    "branch_mix": _eda_share("NM_MATRIZ_FILIAL"),
    "top10_activities": _eda_freq("CNAE", top=10),
    "capital_summary": """SELECT 'CAP_SOCIAL' AS column, count(CAP_SOCIAL) AS count, round(avg(CAP_SOCIAL), 4) AS mean,
        round(stddev_samp(CAP_SOCIAL), 4) AS stddev, min(CAP_SOCIAL) AS min, quantile_disc(CAP_SOCIAL, 0.25) AS p25,
        quantile_disc(CAP_SOCIAL, 0.5) AS p50, quantile_disc(CAP_SOCIAL, 0.75) AS p75, max(CAP_SOCIAL) AS max
        FROM e WHERE CAP_SOCIAL > 1""",
    "capital_quantiles": " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS prob, quantile_disc(CAP_SOCIAL, {p}) AS value FROM e WHERE CAP_SOCIAL > 1"
        for p in CAPITAL_PROBS),
    "capital_mean": "SELECT round(avg(CAP_SOCIAL), 0) AS mean FROM e WHERE CAP_SOCIAL > 1 AND CAP_SOCIAL < 100001",
    "capital_by_activity": _eda_profile("CNAE", "WHERE CAP_SOCIAL > 1", 10),
    "closure_reasons": _eda_profile("NM_MOTIVO", "WHERE CAP_SOCIAL > 1 AND NM_SIT_CADASTRAL = 'BAIXADA'", 10),
    "open_reasons": _eda_freq("NM_MOTIVO", "WHERE NM_SIT_CADASTRAL <> 'BAIXADA' AND NM_MOTIVO <> 'SEM MOTIVO'"),
    "capital_by_status": _eda_profile("NM_SIT_CADASTRAL", "WHERE CAP_SOCIAL > 1"),
    "capital_histogram": f"""SELECT x.bin, round(lo + x.bin * {_EDA_WIDTH}, 4) AS lo,
        round(lo + (x.bin + 1) * {_EDA_WIDTH}, 4) AS hi, COALESCE(c.count, 0) AS count
        FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) x
        CROSS JOIN (SELECT min(CAP_SOCIAL) AS lo, max(CAP_SOCIAL) AS hi FROM e WHERE CAP_SOCIAL > 1 AND CAP_SOCIAL < 150001) b
        LEFT JOIN (SELECT CAST(least(floor((CAP_SOCIAL - lo) / {_EDA_WIDTH}), 19) AS INTEGER) AS bin, count(*) AS count
                   FROM e, (SELECT min(CAP_SOCIAL) AS lo, max(CAP_SOCIAL) AS hi FROM e WHERE CAP_SOCIAL > 1 AND CAP_SOCIAL < 150001)
                   WHERE CAP_SOCIAL > 1 AND CAP_SOCIAL < 150001 GROUP BY 1) c ON c.bin = x.bin""",
    "gender_mix": _eda_share("CLASSIFICACAO"),
    "phone_type": _eda_share("TIPO_TELEFONE"),
    "provider_top20": _eda_freq("PROVEDOR", top=20),
    "operator_top25": _eda_freq("OPERADORA", top=25),
    "state_vs_population": f"""SELECT s.UF, s.n, p.Pop, round(100.0 * s.n / p.Pop, 2) AS percent
        FROM (SELECT UF, count(*) AS n FROM e GROUP BY 1) s LEFT JOIN ({_EDA_POPULATION}) p ON s.UF = p.UF""",
}


def _eda_query(name: str):
    def ask(spark, d):
        population = table(spark, d, "nation").select(F.col("n_name").alias("UF"), ((F.col("n_nationkey") + 1) * 100000).cast("long").alias("Pop"))
        out = eda_tables(eda_rows(spark, d), population, exact=True, only=[name])[name]
        return out.withColumns({c: _r(c, 4) for c in ("mean", "stddev", "lo", "hi") if c in out.columns})

    return ask


for _name, _sql in EDA_QUESTIONS.items():
    register(f"eda_{_name}", f"WITH e AS ({_EDA_SQL}) {_sql}")(_eda_query(_name))


# ---------------------------------------------------------------------------
# Tax-regime table (Q3) from customer rows: compact dates, some malformed or empty
# ---------------------------------------------------------------------------
#: Per date column: days after the key's day, and which keys hold what malformed text instead.
_REGIME = {"DATA_OPCAO_PELO_MEI": (0, 7, "00000000"), "DATA_EXCLUSAO_MEI": (365, 2, ""),
           "DATA_OPCAO_PELO_SIMPLES": (30, 11, "20101399"), "DATA_EXCLUSAO_SIMPLES": (800, 3, "0")}


def _regime_text(days: int, every: int, bad: str):
    made = F.date_add(F.to_date(F.lit("2009-07-01")), (F.col("c_custkey") % 4000 + days).cast("int"))
    return F.when(F.col("c_custkey") % every == 0, bad).otherwise(F.date_format(made, "yyyyMMdd"))


def _regime_sql(raw: str, name: str) -> str:
    days, every, bad = _REGIME[raw]
    text = (f"CASE WHEN c_custkey % {every} = 0 THEN '{bad}' ELSE "
            f"strftime(DATE '2009-07-01' + CAST(c_custkey % 4000 + {days} AS INTEGER), '%Y%m%d') END")
    return f"CAST(try_strptime({text}, '%Y%m%d') AS DATE) AS {name}"


@register("tax_regime_flow", f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS CNPJ_BASICO, CASE WHEN c_acctbal > 0 THEN 'S' ELSE 'N' END AS "OPÇAO_PELO_MEI",
       {_regime_sql("DATA_OPCAO_PELO_MEI", "DT_OPCAO_MEI")}, {_regime_sql("DATA_EXCLUSAO_MEI", "DT_EXCLUSAO_MEI")},
       CASE WHEN c_nationkey % 2 = 0 THEN 'S' ELSE 'N' END AS OPCAO_PELO_SIMPLES,
       {_regime_sql("DATA_OPCAO_PELO_SIMPLES", "DT_OPCAO_SIMPLES")}, {_regime_sql("DATA_EXCLUSAO_SIMPLES", "DT_EXCLUSAO_SIMPLES")}
FROM customer
""")
def tax_regime_flow(spark, d):
    from .registry import process_simples

    c = table(spark, d, "customer")
    return process_simples(c.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("CNPJ_BASICO"),
        F.when(F.col("c_acctbal") > 0, "S").otherwise("N").alias("OPÇAO_PELO_MEI"),
        F.when(F.col("c_nationkey") % 2 == 0, "S").otherwise("N").alias("OPCAO_PELO_SIMPLES"),
        *[_regime_text(*spec).alias(name) for name, spec in _REGIME.items()]))


@register("final_table_flow", f"""
WITH m AS ({ORACLE_SQL["sole_traders_flow"]}), e AS ({ORACLE_SQL["establishments_flow"]})
SELECT m.CNPJ, m.NOME_EMPRESA, m.NM_PORTE, m.CPF_CRIPTOGRAFADO, m.PRIMEIRO_NOME,
       CASE WHEN m.PRIMEIRO_NOME = 'JOSE' AND m.CLASSIFICACAO = 'F' THEN 'M' ELSE m.CLASSIFICACAO END AS CLASSIFICACAO,
       e.CNPJ_BASICO, e.CNPJ_ORDEM, e.NM_SIT_CADASTRAL, e.NM_MATRIZ_FILIAL, e.MUNICIPIO, e.PROVEDOR, e.VALID_EMAIL
FROM m JOIN e ON m.CNPJ = e.CNPJ_BASICO
""")
def final_table_flow(spark, d):
    """Q6: sole traders x their establishments (hot companies split by the skew join)."""
    from .registry import final_table

    raw = establishment_rows(spark, d).select("CNPJ_BASICO")
    f = final_table(sole_traders_flow(spark, d), establishments_flow(spark, d), salt_buckets=8, hot_from=raw)
    return f.select("CNPJ", "NOME_EMPRESA", "NM_PORTE", "CPF_CRIPTOGRAFADO", "PRIMEIRO_NOME", "CLASSIFICACAO",
                    "CNPJ_BASICO", "CNPJ_ORDEM", "NM_SIT_CADASTRAL", "NM_MATRIZ_FILIAL", "MUNICIPIO", "PROVEDOR",
                    "VALID_EMAIL")


# ---------------------------------------------------------------------------
# Q8: modelling-table treatment on customer-derived rows
# ---------------------------------------------------------------------------
_STATE_NAMES = list(X.STATE_NAME_TO_CODE)
_STATE_CODES = list(X.STATE_NAME_TO_CODE.values())
_MODEL_PROV = ["gmial", "hotmail", "", None, "otlook", "xyz"]
_MODEL_STREET = ["1A RUA", "RUA PRINCIPAL", "PRA�A", "AVENIDA", "XYZ", None]
MODEL_OUT = ["NOME_EMPRESA", "CNAE", "UF", "MUNICIPIO", "DDD1", "CAP_SOCIAL", "renda_per_capita", "LAT", "LON",
             "IDHM_2010", "PRODUTO_INTERNO_BRUTO_A_PREOS_CORRENTES_R_1000", "TIPO_TELEFONE_FINAL", "OPERADORA",
             "PROVEDOR", "TIPO_LOUGRADOURO", "SEXO_PROB"]


def model_provider_map() -> dict:
    return X.typo_dictionary(FLOW_PROVIDERS, extra={"G-MAIL": "GMAIL", "OTLOOK": "AUTLOOK"})


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (idx % len(values) + 1).cast("int"))


def model_rows(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    comma = lambda e, fmt: F.regexp_replace(F.format_string(fmt, e), r"\.", ",")
    nat = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    x = J.lookup(c, nat, "c_nationkey", drop_key=False)
    return x.select(
        F.col("c_name").alias("NOME_EMPRESA"), F.col("c_mktsegment").alias("CNAE"),
        F.when(k % 4 == 0, "Sócio").otherwise("Empresário").alias("NM_QUALIFICACAO"),
        F.lit("Empresário (Individual)").alias("NAT_JURICA"),
        F.when(k % 5 == 0, "FILIAL").otherwise("MATRIZ").alias("NM_MATRIZ_FILIAL"),
        comma(F.col("c_acctbal"), "%.2f").alias("CAP_SOCIAL"),
        _pick(_STATE_CODES, F.col("c_nationkey")).alias("UF"),
        F.col("n_name").alias("MUNICIPIO"),
        F.lpad((F.col("c_nationkey") + 11).cast("string"), 2, "0").alias("DDD1"),
        F.when(k % 2 == 0, "TELEFONE FIXO").otherwise("TELEFONE CELULAR").alias("TIPO_TELEFONE_FINAL"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.lit("VIVO")).alias("OPERADORA"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(comma(F.col("c_acctbal") * 2, "%.2f"))
        .alias("renda_per_capita"),
        F.lit("1234,5").alias("RENDA_PERCAPTA_MUN"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(comma(F.col("c_acctbal"), "%.2f")).alias("LAT"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(comma(-F.col("c_acctbal"), "%.2f")).alias("LON"),
        F.lit("0,7").alias("IDHM_2010"),
        F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(F.lit("100,5"))
        .alias("PRODUTO_INTERNO_BRUTO_A_PREOS_CORRENTES_R_1000"),
        F.lit("10,25").alias("PRODUTO_INTERNO_BRUTO_PER_CAPITA_A_PREOS_CORRENTES_R_100"),
        (F.lit(2000) + k % 20).cast("int").alias("ano_cadastro"), k.cast("int").alias("CEP"),
        _pick(_MODEL_PROV, k).alias("PROVEDOR"), _pick(_MODEL_STREET, k).alias("TIPO_LOUGRADOURO"),
        F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(F.lit("F")).alias("SEXO_PROB"))


def municipality_rows(spark, d) -> DataFrame:
    """Municipality attributes: state by name, accented municipality names, coordinates."""
    n = table(spark, d, "nation")  # the last ones have no state, so that some look-ups miss
    return n.select(F.when(F.col("n_nationkey") < 20, _pick(_STATE_NAMES, F.col("n_nationkey"))).alias("UF"),
                    F.regexp_replace("n_name", "A", "Á").alias("NOME_MUNICIPIO"),
                    (-F.col("n_nationkey")).cast("string").alias("LATITUDE"),
                    (F.col("n_regionkey") * 10).cast("string").alias("LONGITUDE"))


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


_STATE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.STATE_NAME_TO_CODE.items())
_STREET_SQL = ("CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{lab}'" for p, lab in STREET_TYPE_PATTERNS)
               + " " + " ".join(f"WHEN t = '{a}' THEN '{b}'" for a, b in STREET_TYPE_EXACT)
               + " ELSE replace(t, 'PRA' || chr(65533) || 'A', 'PRACA') END")


@register("modelling_flow", f"""
WITH dict(k, v) AS (VALUES {_dict_values_sql(model_provider_map())}),
base AS (SELECT c.c_name AS NOME_EMPRESA, c.c_mktsegment AS CNAE,
        CASE WHEN c.c_custkey % 4 = 0 THEN 'Sócio' ELSE 'Empresário' END AS NM_QUALIFICACAO,
        'Empresário (Individual)' AS NAT_JURICA,
        CASE WHEN c.c_custkey % 5 = 0 THEN 'FILIAL' ELSE 'MATRIZ' END AS NM_MATRIZ_FILIAL,
        replace(printf('%.2f', c.c_acctbal), '.', ',') AS CAP_SOCIAL,
        {_sql_list(_STATE_CODES)}[CAST(c.c_nationkey % {len(_STATE_CODES)} AS INTEGER) + 1] AS UF,
        n.n_name AS MUNICIPIO, lpad(CAST(c.c_nationkey + 11 AS VARCHAR), 2, '0') AS DDD1,
        CASE WHEN c.c_custkey % 2 = 0 THEN 'TELEFONE FIXO' ELSE 'TELEFONE CELULAR' END AS TIPO_TELEFONE_FINAL,
        CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE 'VIVO' END AS OPERADORA,
        CASE WHEN c.c_custkey % 6 = 0 THEN NULL ELSE replace(printf('%.2f', c.c_acctbal * 2), '.', ',') END AS renda_per_capita,
        '1234,5' AS RENDA_PERCAPTA_MUN,
        CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE replace(printf('%.2f', c.c_acctbal), '.', ',') END AS LAT,
        CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE replace(printf('%.2f', -c.c_acctbal), '.', ',') END AS LON,
        '0,7' AS IDHM_2010,
        CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE '100,5' END AS PIB1, '10,25' AS PIB2,
        CAST(2000 + c.c_custkey % 20 AS INTEGER) AS ano_cadastro, CAST(c.c_custkey AS INTEGER) AS CEP,
        {_sql_list(_MODEL_PROV)}[CAST(c.c_custkey % {len(_MODEL_PROV)} AS INTEGER) + 1] AS PROVEDOR,
        {_sql_list(_MODEL_STREET)}[CAST(c.c_custkey % {len(_MODEL_STREET)} AS INTEGER) + 1] AS TIPO_LOUGRADOURO,
        CASE WHEN c.c_custkey % 8 = 0 THEN NULL ELSE 'F' END AS SEXO_PROB
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
s2 AS (SELECT NOME_EMPRESA, CNAE, UF, MUNICIPIO, DDD1, ano_cadastro, CEP, PROVEDOR, TIPO_LOUGRADOURO, SEXO_PROB,
        TIPO_TELEFONE_FINAL, CASE WHEN TIPO_TELEFONE_FINAL = 'TELEFONE FIXO' THEN TIPO_TELEFONE_FINAL ELSE OPERADORA END AS OPERADORA,
        TRY_CAST(replace(CAP_SOCIAL, ',', '.') AS FLOAT) AS CAP_SOCIAL,
        TRY_CAST(replace(COALESCE(renda_per_capita, RENDA_PERCAPTA_MUN), ',', '.') AS FLOAT) AS renda_per_capita,
        TRY_CAST(replace(LAT, ',', '.') AS FLOAT) AS LAT, TRY_CAST(replace(LON, ',', '.') AS FLOAT) AS LON,
        TRY_CAST(replace(IDHM_2010, ',', '.') AS FLOAT) AS IDHM_2010, TRY_CAST(replace(PIB1, ',', '.') AS FLOAT) AS PIB1,
        NM_QUALIFICACAO, NAT_JURICA, NM_MATRIZ_FILIAL FROM base),
s3 AS (SELECT * FROM s2 WHERE CAP_SOCIAL > 0 AND NM_QUALIFICACAO = 'Empresário' AND NAT_JURICA = 'Empresário (Individual)'
        AND NM_MATRIZ_FILIAL = 'MATRIZ'),
mun AS (SELECT COALESCE(CASE UF {_STATE_CASE} END, UF) AS M_UF,
        translate(upper(NOME_MUNICIPIO), 'ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ', 'AAAAAEEEEIIIIOOOOOUUUUC') AS M_NAME,
        TRY_CAST(LATITUDE AS FLOAT) AS M_LAT, TRY_CAST(LONGITUDE AS FLOAT) AS M_LON
      FROM (SELECT {_sql_list(_STATE_NAMES)}[CAST(n_nationkey % {len(_STATE_NAMES)} AS INTEGER) + 1] AS UF,
                   replace(n_name, 'A', 'Á') AS NOME_MUNICIPIO, CAST(-n_nationkey AS VARCHAR) AS LATITUDE,
                   CAST(n_regionkey * 10 AS VARCHAR) AS LONGITUDE FROM nation WHERE n_nationkey < 20)),
s4 AS (SELECT s3.* EXCLUDE (LAT, LON), COALESCE(s3.LAT, mun.M_LAT) AS LAT, COALESCE(s3.LON, mun.M_LON) AS LON
       FROM s3 LEFT JOIN mun ON s3.UF = mun.M_UF AND s3.MUNICIPIO = mun.M_NAME),
s5 AS (SELECT * FROM s4 WHERE DDD1 IN ({", ".join(f"'{a}'" for a in VALID_AREA_CODES)})
        AND NOME_EMPRESA IS NOT NULL AND CNAE IS NOT NULL AND ano_cadastro IS NOT NULL AND DDD1 IS NOT NULL
        AND IDHM_2010 IS NOT NULL AND CEP IS NOT NULL AND renda_per_capita IS NOT NULL AND LON IS NOT NULL AND LAT IS NOT NULL),
s6 AS (SELECT NOME_EMPRESA, CNAE, COALESCE(UF, 'SI') AS UF, COALESCE(MUNICIPIO, 'SI') AS MUNICIPIO, DDD1, CAP_SOCIAL,
        renda_per_capita, LAT, LON, IDHM_2010, COALESCE(PIB1, 0) AS PRODUTO_INTERNO_BRUTO_A_PREOS_CORRENTES_R_1000,
        COALESCE(TIPO_TELEFONE_FINAL, 'SI') AS TIPO_TELEFONE_FINAL, COALESCE(OPERADORA, 'SI') AS OPERADORA,
        upper(COALESCE(PROVEDOR, 'NAO_CADASTRADO')) AS P0, COALESCE(TIPO_LOUGRADOURO, 'SI') AS t,
        COALESCE(SEXO_PROB, 'SI') AS SEXO_PROB FROM s5)
SELECT NOME_EMPRESA, CNAE, UF, MUNICIPIO, DDD1, CAP_SOCIAL, renda_per_capita, LAT, LON, IDHM_2010,
       PRODUTO_INTERNO_BRUTO_A_PREOS_CORRENTES_R_1000, TIPO_TELEFONE_FINAL, OPERADORA,
       CASE WHEN COALESCE(d.v, P0) IN ({", ".join(f"'{p}'" for p in X.MODEL_PROVIDERS)}) THEN COALESCE(d.v, P0) ELSE 'OUTROS' END AS PROVEDOR,
       CASE WHEN ({_STREET_SQL}) IN ({", ".join("'" + p + "'" for p in X.STREET_TYPES)}) THEN ({_STREET_SQL}) ELSE 'OUTROS' END AS TIPO_LOUGRADOURO,
       SEXO_PROB
FROM s6 LEFT JOIN dict d ON d.k = P0
""")
def modelling_flow(spark, d):
    from .modelling import treat_modelling_table

    out = treat_modelling_table(model_rows(spark, d), municipality_rows(spark, d), model_provider_map())
    return out.select(*MODEL_OUT)


@register("global_row_number", """
SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) AS row_number FROM orders
""")
def global_row_number(spark, d):
    """Contiguous row numbers in key order without a single-partition window."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return P.global_row_number(o, "o_orderkey", "row_number")


# ---------------------------------------------------------------------------
# Sources and sinks: test tables written as drops below the checkpoint folder and read back
# ---------------------------------------------------------------------------
_QUOTED = {"sep": ";", "quoteAll": True, "escape": '"', "encoding": "ISO-8859-1"}
_REASON_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS COD_MOTIVO, p_name || '; "São Ç" ' || CAST(p_partkey AS VARCHAR) AS NM_MOTIVO FROM part"""


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/drop-{uuid.uuid4().hex}"


def reason_rows(spark, d) -> DataFrame:
    """Code-table-shaped rows whose labels hold separators, quotes and accents."""
    code = F.col("p_partkey").cast("string")
    return table(spark, d, "part").select(code.alias("COD_MOTIVO"), F.concat("p_name", F.lit('; "São Ç" '), code).alias("NM_MOTIVO"))


@register("source_delimited", _REASON_SQL)
def source_delimited(spark, d):
    """K1 -> S1, S2: a headerless, quoted ISO-8859-1 drop under its dataset path."""
    base = _folder(spark)
    sinks.save_data(reason_rows(spark, d), delimited.dataset_paths("motivos", base), 4, "csv", options=_QUOTED)
    return delimited.read_dataset(spark, "motivos", base)


@register("source_mixed_encodings", _REASON_SQL)
def source_mixed_encodings(spark, d):
    """Files of two encodings, detected by a job and read with a reader each."""
    base, rows = _folder(spark), reason_rows(spark, d)
    odd = F.pmod(F.col("COD_MOTIVO").cast("long"), F.lit(2)) == 1
    sinks.save_data(rows.where(odd), base, 2, "csv", options=_QUOTED)
    sinks.save_data(rows.where(~odd), base, 3, "csv", "append", options=_QUOTED | {"encoding": "UTF-8"})
    files = [r.path for r in spark.read.format("binaryFile").load(f"{base}/*.csv").select("path").collect()]
    found = encoding.detect_encodings(spark, files).collect()
    return delimited.read_mixed(spark, "motivos", {r.path: r.encoding for r in found})


@register("source_header_csv", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def source_header_csv(spark, d):
    """A header CSV, gzipped, every column a string."""
    path = _folder(spark)
    sinks.save_data(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, 3, "csv",
                    options={"header": True, "compression": "gzip", "sep": "|"})
    return delimited.read_header_csv(spark, path, "|")


@register("source_names", """SELECT upper(p_name) AS first_name, CASE WHEN p_partkey % 2 = 0 THEN 'F' ELSE 'M' END AS classification,
       p_partkey / 7.0::DOUBLE AS ratio, CASE WHEN p_partkey % 7 <> 0 THEN p_brand || '|' || p_type END AS alternative_names FROM part""")
def source_names(spark, d):
    """The first-name dictionary as a gzipped header CSV of doubles and NULLs."""
    path, p = _folder(spark), table(spark, d, "part")
    shaped = {"first_name": F.upper("p_name"), "classification": F.when(F.col("p_partkey") % 2 == 0, "F").otherwise("M"),
              "ratio": F.col("p_partkey") / F.lit(7.0), "alternative_names": F.when(F.col("p_partkey") % 7 != 0, F.concat("p_brand", F.lit("|"), "p_type"))}
    columns = [shaped[f.name].alias(f.name) if f.name in shaped else F.lit(None).cast(f.dataType).alias(f.name) for f in delimited.NAMES.fields]
    sinks.save_data(p.select(*columns), path, 2, "csv", options={"header": True, "compression": "gzip"})
    return delimited.read_names(spark, path).select(*shaped)


def _zipped(spark, d) -> str:
    """Zip archives below a fresh folder, one per partition, of two headerless members each."""
    import zipfile

    import pandas as pd

    from ..sources._fs import open_output

    base = _folder(spark)
    shards = max(3, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = reason_rows(spark, d).repartition(shards, "COD_MOTIVO").withColumn("shard", F.spark_partition_id())

    def write(batches):
        lines: dict = {}
        for pdf in batches:
            for shard, code, name in zip(pdf["shard"], pdf["COD_MOTIVO"], pdf["NM_MOTIVO"]):
                quoted = name.replace('"', '""')
                lines.setdefault((shard, int(code) % 2), []).append(f'"{code}";"{quoted}"\n')
        for shard in sorted({s for s, _ in lines}):
            with open_output(f"{base}/Motivos{shard}.zip") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as zf:
                for part in sorted(p for s, p in lines if s == shard):
                    zf.writestr(f"F{part}.MOTICSV", "".join(lines[shard, part]).encode("iso-8859-1"))
                zf.writestr("readme.txt", "not a member that matches")
            yield pd.DataFrame({"path": [f"{base}/Motivos{shard}.zip"]})

    rows.mapInPandas(write, "path string").collect()
    return base


@register("source_zip", _REASON_SQL)
def source_zip(spark, d):
    """Typed rows out of zip archives, a task per member."""
    return archives.read_zip(spark, f"{_zipped(spark, d)}/*.zip", dataset_schema("motivos"), member_regex="CSV$").drop("archive", "member")


@register("source_extracted", _REASON_SQL)
def source_extracted(spark, d):
    """Matching members extracted under canonical names, then scanned."""
    base = _zipped(spark, d)
    zips = [r.path for r in spark.read.format("binaryFile").load(f"{base}/*.zip").select("path").collect()]
    done = archives.extract_archives(spark, zips, f"{base}/out", member_filter="CSV$", rename=True).where("status = 'ok'").select("target").collect()
    return delimited.read_dataset(spark, "motivos", paths=[r.target for r in done])


@register("sink_round_trip", """SELECT 'motivos' AS dataset, count(*) AS n, count(DISTINCT p_name) AS labels FROM part
UNION ALL SELECT 'naturezas', count(*), count(DISTINCT n_name) FROM nation""")
def sink_round_trip(spark, d):
    """Datasets loaded through a sink, overwritten in place, read as a SQL model."""
    base, out = _folder(spark), []
    kinds = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("COD_NAT_JURICA"), F.col("n_name").alias("NAT_JURICA"))
    sinks.save_data(reason_rows(spark, d), delimited.dataset_paths("motivos", base), 2, "csv", options=_QUOTED)
    sinks.save_data(kinds, delimited.dataset_paths("naturezas", base), 1, "csv", options=_QUOTED)
    loaded = sinks.load_all(spark, ["Motivos", "naturezas", "MOTIVOS"], base,
                            lambda df, name: sinks.write_table(df, name, "parquet", {"path": f"{base}/tables/{name}"}))
    for name in loaded:
        path = f"{base}/tables/{name}"
        with sinks.pinned(delimited.read_parquet(spark, path)) as df:
            label = df.columns[1]
            sinks.save_data(df.withColumn(label, F.regexp_replace(label, ';.*$', "")), path, 3, overwrite_source=True)
        delimited.read_parquet(spark, path, [label]).withColumnRenamed(label, "label").createOrReplaceTempView(f"rs_sink_{name}")
        out.append(sinks.materialize(spark, f"SELECT '{name}' AS dataset, count(*) AS n, count(DISTINCT label) AS labels FROM rs_sink_{name}", f"rs_model_{name}"))
    return A.union_all(out)
