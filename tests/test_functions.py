import datetime as dt

import pytest
from pyspark.sql import functions as F

from regispark import functions as X
from regispark.functions.decode import typo_dictionary


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first()["out"]


def test_decode_status_and_sizes(spark):
    df = spark.createDataFrame([(2,), (9,), (None,)], "c int")
    got = [r[0] for r in df.select(X.decode("c", X.REGISTRATION_STATUS)).collect()]
    assert got == ["ATIVA", None, None]
    got = [r[0] for r in df.select(X.decode("c", X.REGISTRATION_STATUS, "OUTRO")).collect()]
    assert got == ["ATIVA", "OUTRO", "OUTRO"]
    s = spark.createDataFrame([("01",), ("05",), ("XX",)], "c string")
    assert [r[0] for r in s.select(X.decode("c", X.COMPANY_SIZE)).collect()] == ["MICRO EMPRESA", "DEMAIS", None]


def test_safe_date(spark):
    vals = ["20240131", "00000000", "0", "", None, "20240231"]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    got = [r[0] for r in df.select(X.safe_date("d")).collect()]
    assert got == [dt.date(2024, 1, 31), None, None, None, None, None]


@pytest.mark.parametrize("email,regex,split", [
    ("A@Gmail.com", "GMAIL", "GMAIL"),
    ("semarroba", "", None),
    ("a@b", "", "B"),
    (None, None, None),
])
def test_email_provider(spark, email, regex, split):
    assert one(spark, X.email_provider("v", "regex"), email) == regex
    assert one(spark, X.email_provider("v", "split"), email) == split


def test_email_valid(spark):
    assert one(spark, X.email_valid("v"), "Joao@Mail.com") == "joao@mail.com"
    assert one(spark, X.email_valid("v"), "no at sign") == ""


def test_rewrite_words_modes(spark):
    mapping = {"G": "GMAIL", "GMIAL": "GMAIL", "G-MAIL": "GMAIL"}
    assert one(spark, X.rewrite_words("v", mapping, "compat"), "joao.g@gmial.com") == "joao.gmail@gmail.com"
    assert one(spark, X.rewrite_words("v", mapping, "compat"), "g-mail@g-mail.com") == "gmail-mail@gmail-mail.com"
    assert one(spark, X.rewrite_words("v", mapping, "domain_only"), "joao.g@gmial.com") == "joao.g@gmail.com"
    assert one(spark, X.rewrite_words("v", mapping, "compat"), None) is None


def fold(text, mapping):
    """The rules one after the other, as literals."""
    import re
    for k, v in mapping.items():
        text = re.sub(rf"(?<![A-Za-z0-9_]){re.escape(k.lower())}(?![A-Za-z0-9_])", lambda _: v.lower(), text) if k else text
    return text


def test_rewrite_in_one_pass_equals_the_rules_one_after_the_other(spark):
    import random

    rnd = random.Random(4)
    parts = ["a", "b", "c", "ab", "a-b", "b c", "c++", "-a", "a.", "", "a b-c", "$1", "x\\y", "é", "b-a"]
    seps = [" ", "-", ".", "++", "  ", "-a-", "é"]
    for trial in range(25):
        mapping = {rnd.choice(parts): rnd.choice(parts) for _ in range(rnd.randint(0, 9))}
        texts = ["".join(rnd.choice(parts) + rnd.choice(seps) for _ in range(rnd.randint(0, 7))) for _ in range(60)] + [None, ""]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string").coalesce(1)
        got = {r.i: r.o for r in df.select("i", X.rewrite_words("v", mapping, "compat").alias("o")).collect()}
        assert got == {i: None if t is None else fold(t, mapping) for i, t in enumerate(texts)}, mapping


def test_rewrite_steps_gather_independent_rules():
    from regispark.functions.rewrite import steps

    rules = {"g-mail": "gmail", "gmial": "gmail", "hotmial": "hotmail", "hot mail": "hotmail", "yaho": "yahoo"}
    assert [(k, len(p)) for k, p in steps(rules)] == [("words", 3), ("literal", 2)]
    assert [k for k, _ in steps({"a-b": "c", "c": "d", "++": "x", "e": "f"})] == ["literal", "words", "literal", "words"]
    assert steps({"a": "b", "b": "c", "c": "a"}) == [("words", [("a", "a"), ("b", "a"), ("c", "a")])] and steps({}) == [] and steps({"a": "A"}) == []


def test_empty_and_tabular_dictionaries(spark):
    df = spark.createDataFrame([("GMIAL", "x@gmial.com"), (None, None)], "p string, e string")
    assert X.replace_values(df, "p", {}).collect() == df.collect()
    assert df.select(X.rewrite_words("e", {}, "domain_only")).first()[0] == "x@gmial.com"
    table = spark.createDataFrame([("GMIAL", "GMAIL")], "typo string, name string")
    assert [r.p for r in X.replace_values(df, "p", table).collect()] == ["GMAIL", None]


def test_rewrite_words_long_dictionary_does_not_overflow(spark):
    mapping = typo_dictionary(["GMAIL", "HOTMAIL", "OUTLOOK", "YAHOO", "ICLOUD", "PROTONMAIL", "ROCKETMAIL",
                               "FACEBOOK", "SERCOMTEL", "VELOXMAIL", "WINDOWSLIVE", "UNOCHAPECO", "ZIPMAIL",
                               "GLOBOMAIL", "ITELEFONICA", "SUPERIG"])
    assert len(mapping) > 339
    assert one(spark, X.rewrite_words("v", mapping, "compat"), "ana@hotmial.com") == "ana@hotmail.com"


def test_replace_values_single_pass(spark):
    mapping = {"OTLOOK": "AUTLOOK", "AUTLOOK": "OUTLOOK", "": "HOTMAIL"}
    df = spark.createDataFrame([("OTLOOK",), ("",), (None,), ("X",)], "p string")
    assert [r[0] for r in X.replace_values(df, "p", mapping).collect()] == ["AUTLOOK", "HOTMAIL", None, "X"]
    big = {f"K{i}": f"V{i}" for i in range(100)} | mapping
    out = X.replace_values(df, "p", big)
    assert sorted(r[0] or "~" for r in out.collect()) == sorted(["AUTLOOK", "HOTMAIL", "~", "X"])


def test_whitelist_and_street_type(spark):
    vals = ["1A RUA", "RUA PRINCIPAL", "PRA�A", "PRAÇA", "XYZ", None, "12A AVENIDA"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(X.street_type("t")).collect()]
    assert got == ["RUA", "RUA", "PRACA", "PRACA", "OUTROS", "OUTROS", "AVENIDA"]


def test_fold_accents(spark):
    assert one(spark, X.fold_accents("v"), "São João") == "SAO JOAO"
    assert one(spark, X.fold_accents("v", compat=True), "São João") == "SÃO JOÃO"


def test_digits_and_person_flag(spark):
    df = spark.createDataFrame([("ANA 123.456.789-01",), ("EMPRESA 12345678000199",), ("SEM NUMERO",)], "n string")
    out = df.select(X.digits("n").alias("d")).withColumn("len", F.length("d")).withColumn("flag", X.person_id_flag("len"))
    assert [tuple(r) for r in out.collect()] == [("12345678901", 11, "SIM"), ("12345678000199", 14, "NAO"),
                                                (None, None, "NAO")]


def test_tokens_deterministic_and_null_safe(spark):
    key = "0123456789abcdef0123456789abcdef"
    df = spark.createDataFrame([("123",), ("123",), (None,)], "c string")
    for mode in ("aes-ecb", "sha2"):
        got = [r[0] for r in df.select(X.tokenize_id("c", key, mode)).collect()]
        assert got[0] == got[1] and got[0] is not None and got[2] is None


def test_address_forms(spark):
    df = spark.createDataFrame([(None, "PRINCIPAL", 10, "CIDADE", "SP")], "t string, s string, n int, c string, u string")
    assert df.select(X.address_ws("t", "s", "n", "c", "u")).first()[0] == "10, CIDADE - SP"
    assert df.select(X.address_concat("t", "s", "n", "c", "u")).first()[0] is None


def test_first_token_and_explode(spark):
    df = spark.createDataFrame([("JOSE DA SILVA", "JOSE|ZE"), ("MARIA", None)], "n string, alt string")
    assert [r[0] for r in df.select(X.first_token("n")).collect()] == ["JOSE", "MARIA"]
    with_fb = X.explode_alternatives(df, "alt", "a", fallback_col="n")
    assert sorted(r["a"] for r in with_fb.collect()) == ["JOSE", "MARIA", "ZE"]
    without = X.explode_alternatives(df, "alt", "a")
    assert sorted(r["a"] for r in without.collect()) == ["JOSE", "ZE"]


@pytest.mark.parametrize("ddd,tel,first_class", [
    ("11", "57001234", "VALIDACAO_ESPECIAL"), ("11", "57991234", "VALIDACAO_ESPECIAL"),
    ("21", "57001234", "TELEFONE FIXO"), ("21", "87001234", "TELEFONE CELULAR"),
    ("11", "11111111", "VALIDACAO_ESPECIAL"), ("11", "31111111", "TELEFONE FIXO"),
])
def test_phone_class(spark, ddd, tel, first_class):
    df = spark.createDataFrame([(ddd, tel)], "d string, t string")
    assert df.select(X.phone_class("d", "t")).first()[0] == first_class


def test_typo_dictionary_rule():
    d = typo_dictionary(["GMAIL", "MAIL"], extra={"GMA": "GMAIL"})
    assert d["GMIAL"] == "GMAIL" and d["GMAILL"] == "GMAIL" and d["GMAL"] == "GMAIL"
    assert d["MAIL"] == "MAIL" and d["GMAIL"] == "GMAIL" and d["GMA"] == "GMAIL"


def test_null_helpers(spark):
    df = spark.createDataFrame([(None, "1,5", None, 1), (2.0, "x", "a", None)], "a double, b string, s string, n int")
    got = [r[0] for r in df.select(X.fallback("a", F.regexp_replace("b", ",", "."), "double")).collect()]
    assert got == [1.5, 2.0]
    filled = X.fill_constants(df, {"s": "SI", "n": 0, "a": "text-ignored"})
    assert [(r.s, r.n, r.a) for r in filled.collect()] == [("SI", 1, None), ("a", 0, 2.0)]
    with pytest.raises(TypeError):
        X.fill_constants(df, {"a": "text"}, strict=True)
    out = X.override_when(df, F.col("s") == "a", "n", 9)
    assert [r.n for r in out.collect()] == [1, 9]
