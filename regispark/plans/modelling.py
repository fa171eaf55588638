"""Q8: modelling-table treatment (filters, state codes, municipality attributes,
missing-value rules, provider and street-type normalisation)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import functions as X
from ..fixed_values import MODEL_DECIMAL_COLUMNS, MODEL_DROPPED, MODEL_FILL, MODEL_FILTERS, MODEL_REQUIRED
from ..operators import joins as J
from ..operators.projection import decimal_comma, drop_cols
from ..sources.seeds import VALID_AREA_CODES



def municipality_table(mun: DataFrame, compat_accents: bool = False) -> DataFrame:
    """Municipality attributes keyed by (state code, upper-case accent-free name)."""
    mun = X.replace_values(mun, "UF", X.STATE_NAME_TO_CODE)
    return mun.withColumn("NOME_MUNICIPIO", X.fold_accents("NOME_MUNICIPIO", compat_accents))


def treat_modelling_table(df: DataFrame, municipalities: DataFrame, provider_map: dict,
                          compat_accents: bool = False, valid_area_codes=VALID_AREA_CODES) -> DataFrame:
    """Q8 end to end; ``provider_map`` is the caller's provider dictionary (single pass)."""
    df = df.withColumn("renda_per_capita", F.coalesce("renda_per_capita", "RENDA_PERCAPTA_MUN"))
    df = drop_cols(df, *MODEL_DROPPED)
    df = decimal_comma(df, [c for c in MODEL_DECIMAL_COLUMNS if c in df.columns], "float")
    df = df.withColumn("OPERADORA", F.when(F.col("TIPO_TELEFONE_FINAL") == "TELEFONE FIXO", F.col("TIPO_TELEFONE_FINAL"))
                       .otherwise(F.col("OPERADORA")))
    cond = F.col("CAP_SOCIAL") > 0
    for c, v in MODEL_FILTERS.items():
        cond = cond & (F.col(c) == v)
    df = df.filter(cond)
    mun = municipality_table(municipalities, compat_accents).select(
        F.col("UF").alias("__m_uf"), F.col("NOME_MUNICIPIO").alias("__m_name"),
        F.col("LATITUDE").try_cast("float").alias("__m_lat"), F.col("LONGITUDE").try_cast("float").alias("__m_lon"))
    df = df.withColumns({"__m_uf": F.col("UF"), "__m_name": F.col("MUNICIPIO")})
    keys = ["__m_uf", "__m_name"]
    df = df.join(F.broadcast(mun), keys, "left") if J.fits_broadcast(mun) else J.spread_null_left_join(df, mun, keys)
    df = df.withColumns({"LAT": F.coalesce("LAT", "__m_lat"), "LON": F.coalesce("LON", "__m_lon")}) \
        .drop("__m_uf", "__m_name", "__m_lat", "__m_lon")
    df = df.filter(F.col("DDD1").isin(list(valid_area_codes)))
    df = df.dropna(subset=[c for c in MODEL_REQUIRED if c in df.columns])
    df = df.fillna({k: v for k, v in MODEL_FILL.items() if k in df.columns})
    df = df.withColumn("PROVEDOR", F.upper("PROVEDOR"))
    df = X.replace_values(df, "PROVEDOR", provider_map)
    return df.withColumns({"PROVEDOR": X.whitelist("PROVEDOR", X.MODEL_PROVIDERS),
                           "TIPO_LOUGRADOURO": X.street_type("TIPO_LOUGRADOURO")})
