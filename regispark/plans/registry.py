"""Registry flows Q1-Q6: establishments, companies, tax regime, sole traders, partners,
and the company x establishment table.

Dimensions (code tables, first-name dictionary) are passed in as DataFrames and joined
through size-checked broadcast lookups; every column derivation of a step is one
projection. Where the original picked an arbitrary survivor of a duplicate group, a
deterministic rule is used (highest ratio, then largest values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import functions as X
from ..fixed_values import MEI_COLUMNS, PARTNER_COLUMNS
from ..operators import joins as J
from ..operators.profile import dedupe_on
from .geocode import geo_fallback


def process_establishments(df: DataFrame, motivos: DataFrame, cnaes: DataFrame, municipios: DataFrame,
                           paises: DataFrame, provider_map: dict, rewrite_mode: str = "domain_only",
                           geocode_levels: list | None = None, email_col_name: str = "VALID_EMAIL") -> DataFrame:
    """Q1: decode, clean and enrich establishments."""
    df = df.withColumnsRenamed({"CNAE_1": "COD_CNAE", "MUNICIPIO": "ID_MUNICPIO", "PAIS": "COD_PAIS",
                                "MOTIVO_CADASTRAL": "COD_MOTIVO"})
    df = J.lookup(df, motivos, "COD_MOTIVO")
    df = J.lookup(df, cnaes, "COD_CNAE")
    df = J.lookup(df, municipios, "ID_MUNICPIO")
    df = J.lookup(df, paises, "COD_PAIS")
    df = df.withColumns({
        "PROVEDOR": X.email_provider("EMAIL", "regex"),
        "EMAIL": F.lower("EMAIL"),
        "DT_SIT_CADASTRAL": X.safe_date("DT_SIT_CADASTRAL"),
        "DT_INICIO_ATIVIDADE": X.safe_date("DT_INICIO_ATIVIDADE"),
        "DT_SIT_ESPECIAL": X.safe_date("DT_SIT_ESPECIAL"),
    })
    df = df.withColumns({
        "ano_cadastro": F.year("DT_INICIO_ATIVIDADE"), "mes_cadastro": F.month("DT_INICIO_ATIVIDADE"),
        "ano_sit_cadastral": F.year("DT_SIT_CADASTRAL"), "mes_sit_cadastral": F.month("DT_SIT_CADASTRAL"),
        "NM_SIT_CADASTRAL": X.decode("SIT_CADASTRAL", X.REGISTRATION_STATUS),
        "valid_email": X.email_valid("EMAIL"),
        "NM_MATRIZ_FILIAL": X.decode("MATRIZ_FILIAL", X.BRANCH_TYPE),
        "ENDERECO_COMPLETO": X.address_ws("TIPO_LOUGRADOURO", "LOGRADOURO", "NUMERO", "MUNICIPIO", "UF"),
    })
    if geocode_levels:
        df = geo_fallback(df, geocode_levels)
    df = X.replace_values(df, "PROVEDOR", provider_map)
    df = df.withColumn("valid_email", X.rewrite_words("valid_email", provider_map, rewrite_mode))
    return df.withColumnRenamed("valid_email", email_col_name)


def process_companies(df: DataFrame, naturezas: DataFrame, qualificacoes: DataFrame, token_key: str,
                      token_mode: str = "aes-ecb") -> DataFrame:
    """Q2: decode companies; an 11-digit run in the company name is an individual's id:
    it is flagged and replaced by a token (the plain id is dropped)."""
    df = df.withColumnRenamed("QUALIF_RESPONVAVEL", "COD_QUALIFICACAO")
    df = J.lookup(df, naturezas, "COD_NAT_JURICA")
    df = J.lookup(df, qualificacoes, "COD_QUALIFICACAO")
    df = df.withColumn("CPF", X.digits("NOME_EMPRESA"))
    df = df.withColumns({"CPF_LEN": F.length("CPF"), "NM_PORTE": X.decode("PORTE", X.COMPANY_SIZE)})
    df = df.withColumns({"PROBABILIDADE_DE_SER_CPF": X.person_id_flag("CPF_LEN"),
                         "CPF_CRIPTOGRAFADO": X.tokenize_id("CPF", token_key, token_mode)})
    return df.drop("CPF")


def process_simples(df: DataFrame) -> DataFrame:
    """Q3: tax-regime table with parsed dates (7 columns)."""
    return df.select(
        "CNPJ_BASICO", "OPÇAO_PELO_MEI",
        X.safe_date("DATA_OPCAO_PELO_MEI").alias("DT_OPCAO_MEI"),
        X.safe_date("DATA_EXCLUSAO_MEI").alias("DT_EXCLUSAO_MEI"),
        "OPCAO_PELO_SIMPLES",
        X.safe_date("DATA_OPCAO_PELO_SIMPLES").alias("DT_OPCAO_SIMPLES"),
        X.safe_date("DATA_EXCLUSAO_SIMPLES").alias("DT_EXCLUSAO_SIMPLES"))


def name_dictionary(names: DataFrame, fallback: bool = True, key: str = "alternative_names") -> DataFrame:
    """One row per alternative spelling: (key, group_name, ratio, classification).

    ``fallback=True`` uses ``first_name`` when the alternatives are NULL; otherwise such rows
    vanish. A spelling claimed by several names keeps the highest ratio."""
    exploded = X.explode_alternatives(names, "alternative_names", key, "first_name" if fallback else None)
    d = exploded.select(key, "group_name", "ratio", "classification")
    return dedupe_on(d, key, prefer="ratio")


def classify_name(df: DataFrame, names: DataFrame, name_col: str, fallback: bool = True,
                  out_col: str = "PRIMEIRO_NOME") -> DataFrame:
    """First token of ``name_col`` looked up in the name dictionary (left join)."""
    d = name_dictionary(names, fallback, out_col)
    df = df.withColumn(out_col, X.first_token(name_col))
    # The dictionary is an aggregate: built once, sized by AQE, which may broadcast it or split
    # hot names; NULL names are spread.
    return J.spread_null_left_join(df, d, [out_col])


def process_sole_traders(df: DataFrame, naturezas: DataFrame, qualificacoes: DataFrame, names: DataFrame,
                         token_key: str, token_mode: str = "aes-ecb") -> DataFrame:
    """Q4: companies whose name carries an individual's id, classified by first name."""
    c = process_companies(df, naturezas, qualificacoes, token_key, token_mode)
    c = c.filter(F.col("PROBABILIDADE_DE_SER_CPF") == "SIM")
    c = dedupe_on(c, ["CPF_CRIPTOGRAFADO", "NOME_EMPRESA"])
    j = classify_name(c, names, "NOME_EMPRESA", fallback=True)
    return j.select(*MEI_COLUMNS, F.col("group_name").alias("GRUPO_NOME"),
                    F.col("ratio").alias("PROBABILIDADE_CLASSIFICACAO"),
                    F.col("classification").alias("CLASSIFICACAO"))


def process_partners(df: DataFrame, paises: DataFrame, qualificacoes: DataFrame, names: DataFrame) -> DataFrame:
    """Q5: partners with country, age band, partner type, both qualification roles,
    entry date and first-name classification."""
    df = J.lookup(df.withColumnRenamed("PAIS", "COD_PAIS"), paises, "COD_PAIS")
    df = df.withColumns({"NM_FAIXA_ETARIA": X.decode("FAIXA_ETARIA", X.AGE_BAND),
                         "NM_IDENTIFICADOR_SOCIO": X.decode("IDENTIFICADOR_SOCIO", X.PARTNER_TYPE),
                         "DT_ENTRADA_SOCIEDADE": X.safe_date("DATA_ENTRADA_SOCIEDADE")})
    df = J.lookup_roles(df, qualificacoes, "COD_QUALIFICACAO", "NM_QUALIFICACAO",
                        {"QUALIFICACAO_REPRESENTANTE_LEGAL": "NM_QUALIFICACAO_REPRESENTANTE_LEGAL",
                         "QUALIFICAÇAO_SOCIO": "NM_QUALIFICAÇAO_SOCIO"})
    j = classify_name(df, names, "NOME_SOCIO_RAZAO_SOCIAL", fallback=False)
    return j.select(*PARTNER_COLUMNS, F.col("ratio").alias("PROBABILIDADE_CLASSIFICACAO"),
                    F.col("classification").alias("CLASSIFICACAO")).dropDuplicates()


def override_classification(df: DataFrame, name: str = "JOSE", from_class: str = "F", to_class: str = "M") -> DataFrame:
    """A known-ambiguous first name recorded with the wrong class is corrected."""
    cond = (F.col("PRIMEIRO_NOME") == name) & (F.col("CLASSIFICACAO") == from_class)
    return X.override_when(df, cond, "CLASSIFICACAO", to_class)


def final_table(sole_traders: DataFrame, establishments: DataFrame, salt_buckets: int | None = None,
                rows_per_task: int = J.ROWS_PER_TASK, hot_from: DataFrame | None = None) -> DataFrame:
    """Q6: sole traders x their establishments (inner, 1:N), with the name override. Hot
    companies are sought in ``hot_from`` (the raw drop's CNPJ_BASICO), so that the
    establishment flow runs once."""
    j = J.join_companies(sole_traders, establishments, "CNPJ", "CNPJ_BASICO", "inner", salt_buckets, rows_per_task, hot_from)
    return override_classification(j)
