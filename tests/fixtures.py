"""Invented registry fixtures (no real people's data): rows hit the edge cases listed in
FIXTURES.md section 4."""

from __future__ import annotations

import gzip
import os
import zipfile

ESTAB = [
    # CNPJ_BASICO;ORDEM;DV;MATRIZ;FANTASIA;SIT;DT_SIT;MOTIVO;CID_EXT;PAIS;DT_INI;CNAE1;CNAE2;TIPO;LOGR;NUM;COMPL;BAIRRO;CEP;UF;MUN;DDD1;TEL1;DDD2;TEL2;DDDF;FAX;EMAIL;SIT_ESP;DT_ESP
    '"11111111";"0001";"01";"1";"LOJA ""A""";"2";"20240131";"00";"";"105";"20200115";"4711302";"";"RUA";"DAS FLORES";"10";"";"CENTRO";"01001000";"SP";"7107";"11";"57001234";"";"";"";"";"Ana.Maria@Gmial.com";"";""',
    '"22222222";"0001";"02";"2";"";"9";"00000000";"01";"";"";"0";"4711302";"";"";"SEM TIPO";"S/N";"";"";"";"RJ";"6001";"21";"87001234";"";"";"";"";"semarroba";"";""',
    '"33333333";"0001";"03";"1";"";"8";"20240231";"01";"";"";"20190101";"9999999";"";"AVENIDA";"BRASIL";"200";"";"";"20000000";"RJ";"6001";"11";"57991234";"";"";"";"";"";"";""',
]
EMPRESAS = [
    '"11111111";"ANA MARIA 12345678901";"2135";"50";"1000,50";"01";""',
    '"22222222";"JOSE SILVA 10987654321";"2135";"50";"500,00";"05";""',
    '"33333333";"EMPRESA GRANDE LTDA 12345678000199";"2062";"49";"x";"XX";""',
    '"44444444";"SEM NUMERO";"2135";"50";"0,00";"03";""',
]
SOCIOS = [
    '"11111111";"2";"MARIA SOUZA";"***123456**";"49";"20100101";"105";"";"";"00";"4"',
    '"22222222";"1";"EMPRESA X";"12345678000199";"22";"0";"";"";"";"00";"0"',
    '"33333333";"3";"JOHN DOE";"";"37";"20150505";"249";"";"";"00";"9"',
]
SIMPLES = ['"11111111";"S";"20200101";"00000000";"S";"20200101";""']
DIMS = {
    "Municipios": ['"7107";"SAO PAULO"', '"6001";"RIO DE JANEIRO"'],
    "Cnaes": ['"4711302";"Comércio varejista"'],
    "Paises": ['"105";"BRASIL"', '"249";"ESTADOS UNIDOS"'],
    "Qualificacoes": ['"50";"Empresário"', '"49";"Sócio-Administrador"', '"22";"Sócio"', '"37";"Sócio Estrangeiro"',
                      '"00";"Não informada"'],
    "Naturezas": ['"2135";"Empresário (Individual)"', '"2062";"Sociedade Empresária Limitada"'],
    "Motivos": ['"00";"SEM MOTIVO"', '"01";"EXTINCAO"'],
}
NAMES = [
    "first_name,alternative_names,group_name,ratio,classification",
    "ANA,ANA|ANNA,ANA,0.99,F",
    "JOSE,JOSE|ZE,JOSE,0.6,F",
    "JOSEFA,JOSE,JOSEFA,0.4,F",
    "MARIA,,MARIA,0.98,F",
    "JOHN,JOHN,JOHN,0.97,M",
]
LATIN1_DIM = '"01";"PRAÇA"'


def write(path: str, lines, encoding: str = "ascii"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="\n") as fh:
        fh.write("\n".join(lines) + "\n")


def build_drop(base: str) -> str:
    """A drop directory in the published layout (shards for the big three)."""
    write(f"{base}/Estabelecimentos/Estabelecimentos0.csv", ESTAB[:2])
    write(f"{base}/Estabelecimentos/Estabelecimentos1.csv", ESTAB[2:])
    write(f"{base}/Empresas/Empresas0.csv", EMPRESAS)
    write(f"{base}/Socios/Socios0.csv", SOCIOS, "latin-1")
    write(f"{base}/Simples/Simples.csv", SIMPLES)
    for name, lines in DIMS.items():
        write(f"{base}/{name}/{name}.csv", lines, "latin-1")
    write(f"{base}/nomes/nomes.csv", NAMES)
    with gzip.open(f"{base}/nomes/nomes.csv.gz", "wt", encoding="utf-8") as fh:
        fh.write("\n".join(NAMES) + "\n")
    return base


def build_zips(base: str) -> list[str]:
    os.makedirs(base, exist_ok=True)
    good = f"{base}/Empresas0.zip"
    with zipfile.ZipFile(good, "w") as zf:
        zf.writestr("K3241.K03200Y0.D40113.EMPRECSV", "\n".join(EMPRESAS[:2]) + "\n")
        zf.writestr("README.txt", "not data\n")
    two = f"{base}/Empresas1.zip"
    with zipfile.ZipFile(two, "w") as zf:
        zf.writestr("K3241.K03200Y1.D40113.EMPRECSV", "\n".join(EMPRESAS[2:]) + "\n")
    bad = f"{base}/Empresas2.zip"
    with open(bad, "wb") as fh:
        fh.write(b"this is not a zip archive")
    return [good, two, bad]
