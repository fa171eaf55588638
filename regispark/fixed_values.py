"""Fixed values.

Every value below must equal the registry's published meaning or the original treatment
for results to agree: code tables, label texts, patterns, formats, dataset layout. They
are stated here once, as plain text in natural order; the operator modules import them.
Larger tables (e.g. e-mail provider typo dictionaries) are not listed: they are passed in
by the caller or generated by rule (``functions.decode.typo_dictionary``).
"""

# --- registry code tables -------------------------------------------------
REGISTRATION_STATUS = {1: "NULA", 2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 8: "BAIXADA"}
BRANCH_TYPE = {1: "MATRIZ", 2: "FILIAL"}
COMPANY_SIZE = {0: "NÃO INFORMADO", 1: "MICRO EMPRESA", 3: "EMPRESA DE PEQUENO PORTE", 5: "DEMAIS", 8: "BAIXADA"}
# The first registry class wrote code 3 with a leading blank; kept for callers that join on it.
COMPANY_SIZE_COMPAT = {**COMPANY_SIZE, 3: " EMPRESA DE PEQUENO PORTE"}
AGE_BAND = {1: "0 a 12 anos", 2: "13 a 20 anos", 3: "21 a 30 anos", 4: "31 a 40 anos", 5: "41 a 50 anos",
            6: "51 a 60 anos", 7: "61 a 70 anos", 8: "71 a 80 anos", 9: "maiores de 80 anos", 0: "NA"}
PARTNER_TYPE = {1: "PESSOA JURIDICA", 2: "PESSOA FISICA", 3: "ESTRANGEIRO"}
STATE_NAME_TO_CODE = {
    "Rondônia": "RO", "Acre": "AC", "Amazonas": "AM", "Roraima": "RR", "Pará": "PA",
    "Amapá": "AP", "Tocantins": "TO", "Maranhão": "MA", "Piauí": "PI", "Ceará": "CE",
    "Rio Grande do Norte": "RN", "Paraíba": "PB", "Pernambuco": "PE", "Alagoas": "AL",
    "Sergipe": "SE", "Bahia": "BA", "Minas Gerais": "MG", "Espírito Santo": "ES",
    "Rio de Janeiro": "RJ", "São Paulo": "SP", "Paraná": "PR", "Santa Catarina": "SC",
    "Rio Grande do Sul": "RS", "Mato Grosso do Sul": "MS", "Mato Grosso": "MT",
    "Goiás": "GO", "Distrito Federal": "DF",
}

# --- modelling-table whitelists ----------------------------------------------
MODEL_PROVIDERS = [
    "GMAIL", "HOTMAIL", "NAO_CADASTRADO", "YAHOO", "OUTLOOK", "BOL", "IG", "LIVE",
    "UOL", "TERRA", "ICLOUD", "OI", "GLOBO", "MSN", "YMAIL", "R7",
    "IBEST", "BRTURBO", "GLOBOMAIL", "NETSITE",
]
STREET_TYPES = [
    "RUA", "AVENIDA", "TRAVESSA", "ESTRADA", "QUADRA", "RODOVIA",
    "PRACA", "ALAMEDA", "SITIO", "PASSAGEM", "AREA", "VILA", "CONJUNTO", "SERVIDAO", "FAZENDA",
    "LOTEAMENTO", "CAMINHO", "BECO", "RESIDENCIAL", "SETOR", "COMUNIDADE", "CONDOMINIO", "DISTRITO", "VIA",
    "ACESSO", "CHACARA", "ESTRADA MUNICIPAL",
    "LADEIRA", "VIELA", "CORREGO", "ACESSO LOCAL", "CONJUNTO RESIDENCIAL", "LARGO", "COLONIA", "CAIS", "PRAIA",
    "NUCLEO RURAL", "ESTRADA VELHA", "BLOCO",
    "ENTRADA", "RAMAL", "AVENIDA PERIMETRAL", "RUA PROJETADA", "JARDIM", "CONJUNTO HABITACIONA", "AREA ESPECIAL",
    "COND. RESIDENCIAL", "PARQUE", "CONDOMINIO RESIDENCI", "CAMPO",
]
# Street-type rewrite rules, applied in this order: patterns, then exact labels, then the
# Latin-1-read-as-ASCII spelling of PRAÇA anywhere in the label.
STREET_TYPE_PATTERNS = [(r"^\d{1,2}A RUA$", "RUA"), (r"^\d{1,2}A AVENIDA$", "AVENIDA"),
                        (r"^\d{1,2}A TRAVESSA$", "TRAVESSA")]
STREET_TYPE_EXACT = [("RUA PRINCIPAL", "RUA"), ("RUA DE PEDESTRE", "RUA"), ("PRAÇA", "PRACA"),
                     ("RUA DE LIGACAO", "RUA"), ("1A VILA", "VILA")]
STREET_TYPE_GARBLED = ("PRA�A", "PRACA")

# --- text ------------------------------------------------------------------
ACCENTED = "ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ"
FOLDED = "AAAAAEEEEIIIIOOOOOUUUUC"
# The six character classes of the original municipality clean-up, in order.
COMPAT_ACCENT_CLASSES = [("[ÁÀÃÂ]", "A"), ("[ÉÈÊ]", "E"), ("[ÍÌÎ]", "I"), ("[ÓÒÕÔö]", "O"), ("[ÚÙÛü]", "U"), ("[çÇ]", "C")]

# --- contact data ------------------------------------------------------------
PROVIDER_PATTERN = r"(?<=@)[^.]+(?=\.)"
EMAIL_PATTERN = r"^\S+@\S+\.\S+$"
LANDLINE = "TELEFONE FIXO"
MOBILE = "TELEFONE CELULAR"
SPECIAL = "VALIDACAO_ESPECIAL"
HOME_AREA = "11"
# Mobile prefix ranges of the home area code: (area code, operator, first prefix,
# end prefix exclusive, state). Expanded they give one row per prefix (123 rows).
HOME_AREA_MOBILE_RANGES = [
    (11, "oi", 5700, 5768, "SP"),
    (11, "tim", 5787, 5799, "SP"),
    (11, "tim", 5475, 5499, "SP"),
    (11, "vivo", 5472, 5474, "SP"),
    (11, "vivo", 5769, 5786, "SP"),
]
# The 67 valid two-digit area codes, in the order the modelling table lists them.
VALID_AREA_CODES = [
    "68", "96", "92", "97", "91", "93", "94", "69", "95", "63", "82", "71", "73", "74", "75", "77", "85", "88", "98", "99",
    "83", "81", "87", "86", "89", "84", "79", "61", "62", "64", "65", "66", "67", "27", "28", "31", "32", "33", "34", "35",
    "37", "38", "21", "22", "24", "11", "12", "13", "14", "15", "16", "17", "18", "19", "41", "42", "43", "44", "45", "46",
    "51", "53", "54", "55", "47", "48", "49",
]
PERSON_ID_DIGITS = 11  # individual tax ids have 11 digits; company ids have 14

# --- dataset layout ------------------------------------------------------------
# Columns of the ten headerless registry datasets, in file order ("int" marks ints).
DATASET_COLUMNS = {
    "estabelecimentos": "CNPJ_BASICO, CNPJ_ORDEM, CNPJ_DV, MATRIZ_FILIAL, NOME_FANTASIA, SIT_CADASTRAL int, "
                        "DT_SIT_CADASTRAL, MOTIVO_CADASTRAL, NOME_CIDADE_EXTERIOR, PAIS, DT_INICIO_ATIVIDADE, CNAE_1, "
                        "CNAE_2, TIPO_LOUGRADOURO, LOGRADOURO, NUMERO int, COMPLEMENTO, BAIRRO, CEP int, UF, MUNICIPIO, "
                        "DDD1, TEL1, DDD2, TEL2, DDD_FAX int, FAX int, EMAIL, SIT_ESPECIAL, DT_SIT_ESPECIAL",
    "empresas": "CNPJ, NOME_EMPRESA, COD_NAT_JURICA, QUALIF_RESPONVAVEL, CAP_SOCIAL, PORTE, ENTE_FEDERATIVO",
    "municipios": "ID_MUNICPIO, MUNICIPIO",
    "cnaes": "COD_CNAE, CNAE",
    "paises": "COD_PAIS, NM_PAIS",
    "qualificacoes": "COD_QUALIFICACAO, NM_QUALIFICACAO",
    "socios": "CNPJ_BASICO, IDENTIFICADOR_SOCIO int, NOME_SOCIO_RAZAO_SOCIAL, CNPJ_CPF_SOCIO, QUALIFICAÇAO_SOCIO, "
              "DATA_ENTRADA_SOCIEDADE, PAIS, REPRESENTANTE_LEGAL, NOME_REPRESENTANTE, "
              "QUALIFICACAO_REPRESENTANTE_LEGAL, FAIXA_ETARIA",
    "simples": "CNPJ_BASICO, OPCAO_PELO_SIMPLES, DATA_OPCAO_PELO_SIMPLES, DATA_EXCLUSAO_SIMPLES, OPÇAO_PELO_MEI, "
               "DATA_OPCAO_PELO_MEI, DATA_EXCLUSAO_MEI",
    "naturezas": "COD_NAT_JURICA, NAT_JURICA",
    "motivos": "COD_MOTIVO, NM_MOTIVO",
}
# File-name prefix of each dataset in a drop; the three large ones come in ten numbered shards.
PREFIX = {
    "estabelecimentos": "Estabelecimentos", "empresas": "Empresas", "socios": "Socios", "simples": "Simples",
    "municipios": "Municipios", "cnaes": "Cnaes", "paises": "Paises", "qualificacoes": "Qualificacoes",
    "naturezas": "Naturezas", "motivos": "Motivos",
}
SHARDED = {"estabelecimentos", "empresas", "socios"}
# Declared encoding per dataset: Latin-1, which also reads the plain ASCII ones and keeps accents.
ENCODING = {
    "estabelecimentos": "ISO-8859-1", "empresas": "ISO-8859-1", "socios": "ISO-8859-1", "simples": "ISO-8859-1",
    "municipios": "ISO-8859-1", "cnaes": "ISO-8859-1", "paises": "ISO-8859-1", "qualificacoes": "ISO-8859-1",
    "naturezas": "ISO-8859-1", "motivos": "ISO-8859-1",
}
# Columns of the final sole-trader table that stay beside its phones.
PHONE_FINAL_COLUMNS = ["CNPJ", "NOME_EMPRESA", "CAP_SOCIAL", "NM_PORTE", "NAT_JURICA", "ENTE_FEDERATIVO", "NM_QUALIFICACAO",
                 "CPF_CRIPTOGRAFADO", "CPF_LEN", "PROBABILIDADE_DE_SER_CPF", "PRIMEIRO_NOME", "GRUPO_NOME",
                 "PROBABILIDADE_CLASSIFICACAO", "CLASSIFICACAO", "CNPJ_BASICO", "NM_MATRIZ_FILIAL", "NM_SIT_CADASTRAL",
                 "DT_INICIO_ATIVIDADE", "ENDERECO_COMPLETO", "TIPO_LOUGRADOURO", "CEP", "MUNICIPIO", "DDD2", "TEL2",
                 "valid_email", "PROVEDOR", "NM_MOTIVO", "CNAE", "NM_PAIS", "ano_cadastro", "mes_cadastro",
                 "DT_SIT_CADASTRAL", "ano_sit_cadastral", "mes_sit_cadastral"]
# Modelling table: decimal-comma columns, dropped and required columns, fills, row filters.
MODEL_DECIMAL_COLUMNS = ["LON", "LAT", "renda_per_capita", "PRODUTO_INTERNO_BRUTO_A_PREOS_CORRENTES_R_1000",
                   "PRODUTO_INTERNO_BRUTO_PER_CAPITA_A_PREOS_CORRENTES_R_100", "IDHM_2010", "CAP_SOCIAL"]
MODEL_DROPPED = ["RENDA_PERCAPTA_MUN", "TEL1", "UF_NOME", "ENDERECO_COMPLETO", "DT_INICIO_ATIVIDADE", "DT_SIT_CADASTRAL",
           "NM_SIT_CADASTRAL", "NM_MOTIVO", "ano_sit_cadastral", "mes_sit_cadastral", "CNPJ_BASICO"]
MODEL_REQUIRED = ["NOME_EMPRESA", "CNAE", "ano_cadastro", "DDD1", "IDHM_2010", "CEP", "renda_per_capita", "LON", "LAT"]
MODEL_FILL = {"TIPO_LOUGRADOURO": "SI", "MUNICIPIO": "SI", "UF": "SI", "TIPO_TELEFONE_FINAL": "SI", "OPERADORA": "SI",
        "PROVEDOR": "NAO_CADASTRADO", "ATIVIDADE_COM_MAIOR_VALOR_ADICIONADO_BRUTO": "SI",
        "ATIVIDADE_COM_SEGUNDO_MAIOR_VALOR_ADICIONADO_BRUTO": "SI",
        "PRODUTO_INTERNO_BRUTO_A_PREOS_CORRENTES_R_1000": 0,
        "PRODUTO_INTERNO_BRUTO_PER_CAPITA_A_PREOS_CORRENTES_R_100": 0, "SEXO_PROB": "SI",
        "NOME_FANTASIA": "NAO_INFORMADO"}
MODEL_FILTERS = {"NM_QUALIFICACAO": "Empresário", "NAT_JURICA": "Empresário (Individual)", "NM_MATRIZ_FILIAL": "MATRIZ"}
# Columns of the tax-regime, sole-trader and partner tables, in order.
SIMPLES_COLUMNS = ["CNPJ_BASICO", "OPÇAO_PELO_MEI", "DT_OPCAO_MEI", "DT_EXCLUSAO_MEI", "OPCAO_PELO_SIMPLES",
                   "DT_OPCAO_SIMPLES", "DT_EXCLUSAO_SIMPLES"]
MEI_COLUMNS = ["CNPJ", "NOME_EMPRESA", "CAP_SOCIAL", "NM_PORTE", "NAT_JURICA", "ENTE_FEDERATIVO", "NM_QUALIFICACAO",
               "CPF_CRIPTOGRAFADO", "CPF_LEN", "PROBABILIDADE_DE_SER_CPF", "PRIMEIRO_NOME"]
PARTNER_COLUMNS = ["CNPJ_BASICO", "NOME_SOCIO_RAZAO_SOCIAL", "CNPJ_CPF_SOCIO", "REPRESENTANTE_LEGAL",
                   "NOME_REPRESENTANTE", "NM_PAIS", "NM_FAIXA_ETARIA", "NM_IDENTIFICADOR_SOCIO",
                   "NM_QUALIFICACAO_REPRESENTANTE_LEGAL", "NM_QUALIFICAÇAO_SOCIO", "DT_ENTRADA_SOCIEDADE",
                   "PRIMEIRO_NOME"]
