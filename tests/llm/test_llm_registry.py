"""The registered queries and the pipeline, against SQL and against their stages' rules."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from regispark.llm import common, queries
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    got, want = [tuple(r) for r in df.collect()], con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(got, df.columns)[0] == digest(want.fetchall(), columns)[0]


def test_all_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_pipeline_stages_take_effect(spark):
    docs = common.table(spark, SF, "documents").limit(120)
    extra = [(10**6, None, None, None, None), (10**6 + 1, "12 %%", "en", "src0", 5), (10**6 + 2, "x token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\" the end of it", "en", "src0", 70)]
    item = common.table(spark, SF, "benchmark").first()
    extra.append((10**6 + 3, "Before it. " + item.text + " After it.", "en", "src0", 200))
    docs = common.staged(docs.unionByName(spark.createDataFrame(extra, docs.schema)))
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs, SF))
        ids[name] = {r.doc_id: r.text for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == columns and docs.count() == len(ids[name])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "mixing"]
    assert 10**6 not in ids["language"] and 10**6 + 1 not in ids["language"] and 10**6 + 3 in ids["near_duplicates"]
    assert 10**6 + 3 not in ids["decontamination"] and "[SECRET]" in ids["secrets"][10**6 + 2] and docs.count() > 0
