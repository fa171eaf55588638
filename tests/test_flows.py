import pytest
from pyspark.sql import functions as F

from regispark.plans import eda, modelling, phones, registry, sql_models
from regispark.sources import delimited
from fixtures import build_drop

KEY = "0123456789abcdef0123456789abcdef"
PROVIDERS = {"GMIAL": "GMAIL", "GMAIL": "GMAIL", "OTLOOK": "OUTLOOK"}


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    return build_drop(str(tmp_path_factory.mktemp("drop")))


@pytest.fixture(scope="module")
def ds(spark, drop):
    names = ["estabelecimentos", "empresas", "socios", "simples", "municipios", "cnaes", "paises", "qualificacoes",
             "naturezas", "motivos"]
    out = {n: delimited.read_dataset(spark, n, drop) for n in names}
    out["nomes"] = delimited.read_names(spark, f"{drop}/nomes/nomes.csv")
    return out


@pytest.fixture(scope="module")
def estab(ds):
    return registry.process_establishments(ds["estabelecimentos"], ds["motivos"], ds["cnaes"], ds["municipios"],
                                           ds["paises"], PROVIDERS)


def test_establishments(estab):
    r = {x.CNPJ_BASICO: x for x in estab.collect()}
    a, b, c = r["11111111"], r["22222222"], r["33333333"]
    assert a.NM_SIT_CADASTRAL == "ATIVA" and b.NM_SIT_CADASTRAL is None and c.NM_SIT_CADASTRAL == "BAIXADA"
    assert a.NM_MATRIZ_FILIAL == "MATRIZ" and b.NM_MATRIZ_FILIAL == "FILIAL"
    assert a.PROVEDOR == "GMAIL" and a.VALID_EMAIL == "ana.maria@gmail.com"
    assert b.PROVEDOR == "" and b.VALID_EMAIL == ""
    assert str(a.DT_SIT_CADASTRAL) == "2024-01-31" and b.DT_SIT_CADASTRAL is None and c.DT_SIT_CADASTRAL is None
    assert a.ano_cadastro == 2020 and a.mes_cadastro == 1
    assert a.ENDERECO_COMPLETO == "RUA DAS FLORES, 10, SAO PAULO - SP"
    assert b.ENDERECO_COMPLETO == "RIO DE JANEIRO - RJ"
    assert a.NM_MOTIVO == "SEM MOTIVO" and a.NM_PAIS == "BRASIL" and a.CNAE == "Comércio varejista"
    assert c.CNAE is None


def test_companies(ds):
    c = registry.process_companies(ds["empresas"], ds["naturezas"], ds["qualificacoes"], KEY)
    r = {x.CNPJ: x for x in c.collect()}
    assert "CPF" not in c.columns
    assert r["11111111"].PROBABILIDADE_DE_SER_CPF == "SIM" and r["11111111"].CPF_LEN == 11
    assert r["33333333"].PROBABILIDADE_DE_SER_CPF == "NAO" and r["33333333"].CPF_LEN == 14
    assert r["44444444"].CPF_LEN is None and r["44444444"].CPF_CRIPTOGRAFADO is None
    assert r["11111111"].NM_PORTE == "MICRO EMPRESA" and r["33333333"].NM_PORTE is None
    assert r["11111111"].NAT_JURICA == "Empresário (Individual)" and r["11111111"].NM_QUALIFICACAO == "Empresário"


def test_simples(ds):
    s = registry.process_simples(ds["simples"]).first()
    assert s.DT_OPCAO_MEI is not None and s.DT_EXCLUSAO_SIMPLES is None and len(s) == 7


def test_sole_traders_and_final(ds, estab):
    mei = registry.process_sole_traders(ds["empresas"], ds["naturezas"], ds["qualificacoes"], ds["nomes"], KEY)
    r = {x.CNPJ: x for x in mei.collect()}
    assert set(r) == {"11111111", "22222222"}
    assert r["11111111"].PRIMEIRO_NOME == "ANA" and r["11111111"].CLASSIFICACAO == "F"
    # JOSE is claimed by two names: the higher ratio wins
    assert r["22222222"].PROBABILIDADE_CLASSIFICACAO == 0.6
    final = registry.final_table(mei, estab)
    f = {x.CNPJ: x for x in final.collect()}
    assert set(f) == {"11111111", "22222222"} and f["22222222"].CLASSIFICACAO == "M"  # JOSE + F -> M
    salted = registry.final_table(mei, estab, salt_buckets=4)
    assert sorted(salted.columns) == sorted(final.columns) and salted.count() == final.count()


def test_partners(ds):
    p = registry.process_partners(ds["socios"], ds["paises"], ds["qualificacoes"], ds["nomes"])
    r = {x.CNPJ_BASICO: x for x in p.collect()}
    assert r["11111111"].NM_IDENTIFICADOR_SOCIO == "PESSOA FISICA" and r["11111111"].NM_FAIXA_ETARIA == "31 a 40 anos"
    assert r["11111111"].NM_QUALIFICAÇAO_SOCIO == "Sócio-Administrador"
    assert r["11111111"].NM_QUALIFICACAO_REPRESENTANTE_LEGAL == "Não informada"
    # MARIA has no alternatives and the no-fallback dictionary drops her
    assert r["11111111"].CLASSIFICACAO is None
    assert r["33333333"].NM_PAIS == "ESTADOS UNIDOS" and r["33333333"].CLASSIFICACAO == "M"
    assert r["22222222"].DT_ENTRADA_SOCIEDADE is None and r["22222222"].NM_FAIXA_ETARIA == "NA"


def test_phone_treatment(spark, ds, estab):
    mei = registry.process_sole_traders(ds["empresas"], ds["naturezas"], ds["qualificacoes"], ds["nomes"], KEY)
    final = registry.final_table(mei, estab)
    t = {x.CPF_CRIPTOGRAFADO: x for x in phones.classify_phones(final).collect()}
    by_tel = {x.number: x.phone_type for x in t.values()}
    assert by_tel == {"57001234": "TELEFONE CELULAR", "87001234": "TELEFONE CELULAR"}
    ops = spark.createDataFrame([("11", "OI", "95700.0", "SP", "GRANDE SP")],
                                "DDD string, OPERADORA string, faixa string, UF string, CIDADES_REGIOES_PRINCIPAIS string")
    out = phones.treat_phones(final, ops)
    got = {x.CNPJ: (x.TIPO_TELEFONE, x.OPERADORA, x.UF) for x in out.collect()}
    assert got["11111111"] == ("TELEFONE CELULAR", "OI", "SP")
    assert got["22222222"] == ("TELEFONE CELULAR", None, None)


def test_phone_special_rules(spark):
    df = spark.createDataFrame([("a", "11", "57001234"), ("b", "11", "57991234"), ("c", "21", "57001234"),
                                ("d", "11", "11111111"), ("e", "11", "957991234"), ("f", "11", None)],
                               "CPF_CRIPTOGRAFADO string, DDD1 string, TEL1 string")
    for c in ["NOME_EMPRESA", "UF", "DT_SIT_CADASTRAL", "ano_sit_cadastral", "ano_cadastro"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    got = {x.CPF_CRIPTOGRAFADO: x.phone_type for x in phones.classify_phones(df).collect()}
    assert got == {"a": "TELEFONE CELULAR", "b": "TELEFONE FIXO", "c": "TELEFONE FIXO", "d": "TELEFONE FIXO"}


def test_modelling_table(spark):
    cols = ("renda_per_capita string, RENDA_PERCAPTA_MUN string, LON string, LAT string, "
            "PRODUTO_INTERNO_BRUTO_A_PREOS_CORRENTES_R_1000 string, "
            "PRODUTO_INTERNO_BRUTO_PER_CAPITA_A_PREOS_CORRENTES_R_100 string, IDHM_2010 string, CAP_SOCIAL string, "
            "TIPO_TELEFONE_FINAL string, OPERADORA string, NM_QUALIFICACAO string, NAT_JURICA string, "
            "NM_MATRIZ_FILIAL string, UF string, MUNICIPIO string, DDD1 string, NOME_EMPRESA string, CNAE string, "
            "ano_cadastro int, CEP int, PROVEDOR string, TIPO_LOUGRADOURO string, SEXO_PROB string")
    base = [None, "1234,5", None, None, "10", "1", "0,7", "1000,50", "TELEFONE FIXO", None, "Empresário",
            "Empresário (Individual)", "MATRIZ", "SP", "SAO PAULO", "11", "ANA", "x", 2020, 1000, "otlook", "1A RUA", None]
    other = list(base)
    other[15] = "00"
    df = spark.createDataFrame([tuple(base), tuple(other)], cols)
    mun = spark.createDataFrame([("São Paulo", "SP", "São Paulo", "-23,5", "-46,6")],
                                "UF string, UF_SIGLA string, NOME_MUNICIPIO string, LATITUDE string, LONGITUDE string")
    mun = mun.withColumn("LATITUDE", F.lit("-23.5")).withColumn("LONGITUDE", F.lit("-46.6"))
    out = modelling.treat_modelling_table(df, mun, {"OTLOOK": "AUTLOOK"}).collect()
    assert len(out) == 1
    r = out[0]
    assert r.renda_per_capita == pytest.approx(1234.5) and r.CAP_SOCIAL == pytest.approx(1000.5)
    assert r.OPERADORA == "TELEFONE FIXO" and r.LAT == pytest.approx(-23.5)
    assert r.PROVEDOR == "OUTROS" and r.TIPO_LOUGRADOURO == "RUA" and r.SEXO_PROB == "SI"


def test_sql_model(spark, ds):
    for n in ("estabelecimentos", "municipios", "paises", "cnaes", "motivos"):
        ds[n].createOrReplaceTempView(f"rs_{n}")
    spark.createDataFrame([("GMAIL",)], "PROVEDOR_VALIDO string").createOrReplaceTempView("rs_dp")
    views = {n: f"rs_{n}" for n in ("estabelecimentos", "municipios", "paises", "cnaes", "motivos")}
    views["dicionario_provedores"] = "rs_dp"
    m = {x.CNPJ_BASICO: x for x in sql_models.sql_establishments(spark, views).collect()}
    assert m["11111111"].PROVEDOR == "GMIAL" and m["22222222"].PROVEDOR is None
    assert m["22222222"].NM_SIT_CADASTRAL == "OUTRO"
    assert m["11111111"].ENDERECO_COMPLETO == "RUA DAS FLORES, 10 - SAO PAULO, SP"
    assert m["22222222"].ENDERECO_COMPLETO is None and m["33333333"].ANO_SIT_CADASTRAL is None
    assert sql_models.passthrough(spark, "rs_dp").count() == 1


def test_eda_tables_build(spark, ds, estab):
    mei = registry.process_sole_traders(ds["empresas"], ds["naturezas"], ds["qualificacoes"], ds["nomes"], KEY)
    final = registry.final_table(mei, estab).withColumn("CAP_SOCIAL", F.regexp_replace("CAP_SOCIAL", ",", ".")
                                                       .try_cast("double"))
    pop = spark.createDataFrame([("SP", 1000), ("RJ", 500)], "UF string, Pop long")
    tables = eda.eda_tables(final, pop)
    for name, t in tables.items():
        t.collect()
    assert set(eda.eda_tables(final, only=["gender_mix"])) == {"gender_mix"}
    assert {r.UF: r.percent for r in tables["state_vs_population"].collect()} == {"SP": 0.1, "RJ": 0.2}
