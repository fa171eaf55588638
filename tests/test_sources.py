import os

import pytest
from pyspark.sql import functions as F

from regispark.schemas import dataset_schema
from regispark.sources import archives, delimited, encoding, seeds, sinks
from fixtures import LATIN1_DIM, build_drop, build_zips, write


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    return build_drop(str(tmp_path_factory.mktemp("drop")))


def test_dataset_paths(drop):
    assert delimited.dataset_paths("estabelecimentos", drop).endswith("Estabelecimentos/*.csv")
    assert delimited.dataset_paths("motivos", drop).endswith("Motivos/Motivos.csv")
    with pytest.raises(ValueError):
        delimited.dataset_paths("nope", drop)


def test_typed_scan_permissive(spark, drop):
    df = delimited.read_dataset(spark, "estabelecimentos", drop)
    assert df.schema == dataset_schema("estabelecimentos")
    r = {x.CNPJ_BASICO: x for x in df.collect()}
    assert len(r) == 3
    assert r["22222222"].NUMERO is None            # "S/N" in an int column -> NULL
    assert r["11111111"].NOME_FANTASIA == 'LOJA "A"'  # doubled quote
    assert r["11111111"].MUNICIPIO == "7107"


def test_latin1_dimension_under_each_charset(spark, tmp_path):
    p = str(tmp_path / "m.csv")
    write(p, [LATIN1_DIM], "latin-1")
    good = delimited.read_dataset(spark, "motivos", paths=p, encoding="ISO-8859-1").first().NM_MOTIVO
    bad = delimited.read_dataset(spark, "motivos", paths=p, encoding="ascii").first().NM_MOTIVO
    assert good == "PRAÇA" and bad == "PRA�A"


def test_encoding_detection_and_mixed_scan(spark, tmp_path):
    a, b = str(tmp_path / "a.csv"), str(tmp_path / "b.csv")
    write(a, ['"00";"SEM MOTIVO"'])
    write(b, [LATIN1_DIM], "latin-1")
    found = {r.path: r.encoding for r in encoding.detect_encodings(spark, [a, b, str(tmp_path / "missing")]).collect()}
    assert found[a] == "UTF-8" and found[b] == "ISO-8859-1" and found[str(tmp_path / "missing")] is None
    mixed = delimited.read_mixed(spark, "motivos", {a: found[a], b: found[b]})
    assert sorted(r.NM_MOTIVO for r in mixed.collect()) == ["PRAÇA", "SEM MOTIVO"]
    empty = delimited.read_mixed(spark, "motivos", {})
    assert empty.count() == 0 and empty.schema == dataset_schema("motivos")


def test_names_plain_and_gzip(spark, drop):
    plain = delimited.read_names(spark, f"{drop}/nomes/nomes.csv")
    gz = delimited.read_names(spark, f"{drop}/nomes/nomes.csv.gz")
    assert plain.count() == gz.count() == 5
    assert dict(plain.select("first_name", "ratio").collect())["ANA"] == 0.99


def test_zip_read_and_extract(spark, tmp_path):
    zips = build_zips(str(tmp_path / "zips"))
    with pytest.raises(Exception, match="BadZipFile"):
        archives.read_zip(spark, str(tmp_path / "zips" / "*.zip"), dataset_schema("empresas"), member_regex=r"EMPRECSV$").count()
    df = archives.read_zip(spark, str(tmp_path / "zips" / "Empresas[01].zip"), dataset_schema("empresas"),
                           member_regex=r"EMPRECSV$")
    assert df.count() == 4 and df.filter(F.col("CNPJ") == "33333333").count() == 1
    errs = archives.read_zip(spark, str(tmp_path / "zips" / "*.zip"), dataset_schema("empresas"),
                             member_regex=r"EMPRECSV$", with_errors=True)
    bad = errs.filter(F.col("error").isNotNull()).collect()
    assert len(bad) == 1 and bad[0].archive.endswith("Empresas2.zip") and bad[0].CNPJ is None
    assert errs.filter(F.col("error").isNull()).count() == 4
    man = archives.extract_archives(spark, zips, str(tmp_path / "out"), member_filter=r"CSV$", rename=True)
    status = {(r.archive.split("/")[-1], r.status) for r in man.collect()}
    assert ("Empresas2.zip", "error") in status and ("Empresas0.zip", "ok") in status
    assert sorted(os.listdir(tmp_path / "out")) == ["Empresas0.csv", "Empresas1.csv"]
    back = delimited.read_dataset(spark, "empresas", paths=str(tmp_path / "out" / "*.csv"))
    assert back.count() == 4


def test_seeds(spark):
    r = seeds.expand_ranges(spark)
    assert r.count() == 123
    counts = {x.operadora: x["count"] for x in r.groupBy("operadora").count().collect()}
    assert counts == {"oi": 68, "tim": 36, "vivo": 19}
    assert len(seeds.VALID_AREA_CODES) == 67


def test_sinks_round_trip_and_overwrite_source(spark, tmp_path):
    p = str(tmp_path / "t")
    sinks.save_data(spark.range(100), p, num_partitions=3)
    assert len([f for f in os.listdir(p) if f.endswith(".parquet")]) == 3
    df = spark.read.parquet(p).withColumn("id", F.col("id") + 1)
    sinks.save_data(df, p, num_partitions=1, overwrite_source=True)
    assert sorted(r.id for r in spark.read.parquet(p).collect())[0] == 1


def test_load_all_dedupes_names(spark, drop):
    seen = []
    sinks.load_all(spark, ["Simples", "Motivos", "simples"], drop, lambda df, name: seen.append((name, df.count())))
    assert seen == [("simples", 1), ("motivos", 2)]


def test_materialize_and_pinned(spark):
    v = sinks.materialize(spark, "SELECT 1 AS x", "rs_test_view")
    assert v.first().x == 1
    with sinks.pinned(spark.range(5)) as p:
        assert p.count() == 5


def test_extract_first_matching_member_only(spark, tmp_path):
    import zipfile

    arc = str(tmp_path / "Simples.zip")
    with zipfile.ZipFile(arc, "w") as zf:
        zf.writestr("notes.txt", "x\n")
        zf.writestr("F.K03200$W.SIMPLES.CSV.D40113", '"11111111";"S";"20200101";"";"N";"";""\n')
        zf.writestr("F.K03200$W.SIMPLES.CSV.D40114", '"22222222";"S";"20200101";"";"N";"";""\n')
    man = archives.extract_archives(spark, [arc], str(tmp_path / "out"), member_filter=r"SIMPLES\.CSV",
                                    first_only=True, rename=True).collect()
    assert [(r.status, r.target.split("/")[-1]) for r in man] == [("ok", "Simples.csv")]
    df = delimited.read_dataset(spark, "simples", paths=str(tmp_path / "out" / "Simples.csv"))
    assert [r.CNPJ_BASICO for r in df.collect()] == ["11111111"]


def test_write_table_format_passthrough(spark, tmp_path):
    out = str(tmp_path / "tbl")
    sinks.write_table(spark.range(7), "ignored_name", fmt="parquet", options={"path": out})
    assert spark.read.parquet(out).count() == 7
    sinks.write_table(spark.range(3), "ignored_name", fmt="parquet", options={"path": out})  # overwrite
    assert spark.read.parquet(out).count() == 3


def test_save_data_partitioned_and_grown(spark, tmp_path):
    p = str(tmp_path / "parts")
    df = spark.range(40).withColumn("g", (F.col("id") % 2).cast("string"))
    sinks.save_data(df, p, num_partitions=4, partition_by=["g"])
    assert sorted(os.listdir(p))[:2] == ["_SUCCESS", "g=0"] or "g=0" in os.listdir(p)
    assert spark.read.parquet(p).count() == 40


def test_uri_paths_for_encodings_and_archives(spark, tmp_path):
    zips = build_zips(str(tmp_path / "z"))
    uris = ["file://" + z for z in zips]
    man = archives.extract_archives(spark, uris, "file://" + str(tmp_path / "o"), member_filter=r"CSV$", rename=True)
    assert sorted(r.status for r in man.collect()) == ["error", "ok", "ok"]
    assert sorted(os.listdir(tmp_path / "o")) == ["Empresas0.csv", "Empresas1.csv"]
    enc = encoding.detect_encodings(spark, ["file://" + str(tmp_path / "o" / "Empresas0.csv")]).first()
    assert enc.encoding == "UTF-8"


def test_encoding_is_judged_by_the_whole_file(spark, tmp_path):
    late, wide, cut = (str(tmp_path / n) for n in ("late.csv", "wide.csv", "cut.csv"))
    write(late, ['"00";"' + "A" * 18_000 + 'EXTINÇÃO"'], "latin-1")
    write(wide, ['"00";"' + "A" * ((1 << 20) - 7) + 'ÇÃO"'], "utf-8")
    with open(cut, "wb") as fh:
        fh.write(b"abc\xc3")  # a multi-byte character cut short is no UTF-8
    got = {r.path: r.encoding for r in encoding.detect_encodings(spark, [late, wide, cut]).collect()}
    assert got == {late: "ISO-8859-1", wide: "UTF-8", cut: "ISO-8859-1"}
    assert delimited.read_dataset(spark, "motivos", paths=late).first().NM_MOTIVO.endswith("EXTINÇÃO")


def test_extraction_never_overwrites(spark, tmp_path):
    import zipfile

    arcs = []
    for folder in ("a", "b"):
        os.makedirs(tmp_path / folder)
        arcs.append(str(tmp_path / folder / "Drop1.zip"))
        with zipfile.ZipFile(arcs[-1], "w") as zf:
            zf.writestr("data.csv", folder)
            zf.writestr("sub/data.csv", folder + "2")
            zf.writestr("../DATA.csv", folder + "3")
    man = archives.extract_archives(spark, arcs, str(tmp_path / "out")).toPandas()
    good = man[man.status == "ok"]
    assert len(good) == 4 == good.target.nunique() and sorted(open(t).read() for t in good.target) == ["a", "a2", "b", "b2"]
    assert list(man[man.status == "error"].member) == ["../DATA.csv"] * 2
    named = archives.extract_archives(spark, arcs, str(tmp_path / "named"), rename=True).toPandas()
    assert (named.status == "ok").all() and named.target.nunique() == 6


def test_damaged_member_is_an_error_row(spark, tmp_path):
    import zipfile

    arc = str(tmp_path / "Bad1.zip")
    with zipfile.ZipFile(arc, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("ok.csv", "1")
        zf.writestr("bad.csv", "abc" * 2000)
    with open(arc, "r+b") as fh:
        body = fh.read()
        at = body.index(b"bad.csv") + 10
        fh.seek(at)
        fh.write(b"\xff" * 8)
    man = archives.extract_archives(spark, [arc], str(tmp_path / "o")).collect()
    assert sorted(r.status for r in man) == ["error", "ok"]


def test_write_table_uses_its_name(spark):
    sinks.write_table(spark.range(5), "rs_named_table", fmt="parquet")
    assert spark.table("rs_named_table").count() == 5
    spark.sql("DROP TABLE rs_named_table")


def test_members_of_one_archive_are_read_by_a_task_each(spark, tmp_path):
    """Range reads: three members in three tasks, of an archive with 6 MB of other bytes."""
    import random
    import zipfile

    from pyspark.sql import functions as F, types as T

    arc = tmp_path / "Parts0.zip"
    with zipfile.ZipFile(arc, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("noise.bin", random.Random(1).randbytes(6 << 20))
        for i in range(3):
            zf.writestr(f"part{i}.csv", "".join(f"{i};{j}\n" for j in range(1000 * (i + 1))))
        zf.writestr("dir/", "")
    schema = T.StructType().add("p", T.IntegerType()).add("j", T.IntegerType())
    df = archives.read_zip(spark, str(arc), schema, member_regex=r"csv$").withColumn("task", F.spark_partition_id())
    got = {r.member: (r.n, r.tasks, r.task) for r in df.groupBy("member").agg(
        F.count("j").alias("n"), F.count_distinct("task").alias("tasks"), F.min("task").alias("task")).collect()}
    assert {m: g[:2] for m, g in got.items()} == {f"part{i}.csv": (1000 * (i + 1), 1) for i in range(3)}
    assert len({g[2] for g in got.values()}) == 3
    man = archives.extract_archives(spark, [str(arc)], str(tmp_path / "out"), member_filter=r"csv$")
    assert man.withColumn("task", F.spark_partition_id()).select("task").distinct().count() == 3
    assert {r.bytes for r in man.collect()} == {(tmp_path / "out" / "Parts0" / f"part{i}.csv").stat().st_size for i in range(3)}


def test_archives_without_members_or_files(spark, tmp_path):
    import zipfile

    from pyspark.sql import types as T

    with zipfile.ZipFile(tmp_path / "Empty0.zip", "w") as zf:
        zf.writestr("other.txt", "x")
    schema = T.StructType().add("p", T.IntegerType())
    assert archives.read_zip(spark, str(tmp_path / "*.zip"), schema, member_regex=r"csv$").count() == 0
    man = archives.extract_archives(spark, [str(tmp_path / "Empty0.zip")], str(tmp_path / "o"), member_filter=r"csv$").collect()
    assert [(r.status, r.bytes) for r in man] == [("no_member", 0)]
    assert archives.extract_archives(spark, [], str(tmp_path / "o")).count() == 0
