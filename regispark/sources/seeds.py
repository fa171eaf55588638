"""Seed and generated lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import HOME_AREA_MOBILE_RANGES, VALID_AREA_CODES  # noqa: F401

SEED_SCHEMAS = {
    "DDD_UF": "DDD int, UF string",
    "DDD_UF_REGIAO": "DDD int, UF string, CIDADES_REGIOES_PRINCIPAIS string",
    "TABELA_VALIDACAO_DDD_11": "ddd int, operadora string, faixa int, uf string",
}


def expand_ranges(spark: SparkSession, ranges=HOME_AREA_MOBILE_RANGES) -> DataFrame:
    """One row per prefix of each [start, end) range: (ddd, operadora, faixa, uf)."""
    base = spark.createDataFrame(list(ranges), "ddd int, operadora string, lo int, hi int, uf string")
    return base.select("ddd", "operadora", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("faixa"), "uf")


def read_seed(spark: SparkSession, path: str, name: str | None = None, schema: str | None = None) -> DataFrame:
    """Header CSV seed with a declared schema (no inference pass)."""
    schema = schema or SEED_SCHEMAS.get(name or "", None)
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_population(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Population by state (``Sigla;Pop``) -> (UF, Pop)."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    return df.withColumnRenamed("Sigla", "UF").withColumn("Pop", F.col("Pop").try_cast("long"))
