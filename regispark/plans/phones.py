"""Q7: phone treatment. A phone is a pair (area, number) of digits; its class, its mobile
prefix and its operator follow from the pair, and join back to the table by person token."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import functions as X
from ..fixed_values import PHONE_FINAL_COLUMNS
from ..operators import joins as J
from ..operators.filters import phone_shape
from ..sources.seeds import expand_ranges

PERSON = "CPF_CRIPTOGRAFADO"


def classify_phones(df: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """(person, DDD1 as given, area, number, phone_type, prefix5) of every well-formed phone.
    ``ranges`` (ddd, faixa) lists the mobile ranges of the special cases."""
    pairs = df.select(PERSON, "DDD1", X.digits("DDD1").alias("area"), X.digits("TEL1").alias("number"))
    pairs = phone_shape(pairs, "area", "number").withColumn("prefix4", X.prefix("number", 4))
    mobile = (ranges if ranges is not None else expand_ranges(df.sparkSession)).select("ddd", "faixa").distinct()
    pairs = J.lookup_ranges(pairs, mobile, ["area", "prefix4"], ["ddd", "faixa"], broadcast=True if ranges is None else None)
    pairs = pairs.withColumn("phone_type", X.phone_class_final(X.phone_class("area", "number"), "faixa"))
    return pairs.select(PERSON, "DDD1", "area", "number", "phone_type", X.mobile_prefix5("phone_type", "prefix4").alias("prefix5"))


def treat_phones(df: DataFrame, operators: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Q7 end to end. ``operators`` = header CSV (DDD, OPERADORA, faixa, UF, CIDADES_REGIOES_PRINCIPAIS),
    looked up by the area code as given and the mobile prefix; ``UF`` is the operator's."""
    phones = classify_phones(df, ranges).withColumnRenamed("DDD1", "DDD")
    table = operators.select("DDD", X.strip_decimal("faixa").alias("prefix5"), "OPERADORA", "UF", "CIDADES_REGIOES_PRINCIPAIS")
    fits = J.fits_broadcast(table)
    found = phones.join(F.broadcast(table), ["DDD", "prefix5"], "left") if fits else J.spread_null_left_join(phones, table, ["DDD", "prefix5"])
    matched = F.col("OPERADORA").isNotNull() | F.col("UF").isNotNull() | F.col("CIDADES_REGIOES_PRINCIPAIS").isNotNull()
    numbers = found.select(
        PERSON, F.col("number").alias("TEL1"), F.col("area").alias("DDD1"), F.col("phone_type").alias("TIPO_TELEFONE"),
        "OPERADORA", F.when(matched, F.col("prefix5")).alias("FAIXA_CEL"), "UF", "CIDADES_REGIOES_PRINCIPAIS")
    base = df.select(*[c for c in PHONE_FINAL_COLUMNS if c in df.columns]).dropDuplicates()
    return J.attach(base, numbers, PERSON)
