"""The corpus pipeline: five stages over ``documents``, each one of the llm operators.

Every stage reads the Parquet its predecessor wrote and keeps whole documents with their
columns; the last returns the training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regispark._util import fresh
from regispark.llm import decontaminate, language_id, mixing, near_dedup, secret_scan
from regispark.llm.common import staged, table


#: A document goes if no language is found (null text, no letter) or the score is below this.
#: Two even choices score 0.25, so only a guess worse than that goes.
LEAST_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no recognised language go; the rest stay as they are, whatever columns they have."""
    lang, score = fresh(docs.columns, "lang_pred"), fresh(docs.columns, "score")
    judged = language_id.identify(docs, language_id.fit(docs), lang, score)
    return judged.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the least id."""
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts, whose length is counted again; no document goes."""
    model = secret_scan.train(spark, secret_scan.ordinary_words(docs))
    return secret_scan.redact(docs, model).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum: every copy taken, with its position, range-sorted by position."""
    return mixing.sequence(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("mixing", mixing_weights)]

#: No SQL: the stages fit classifiers and follow links; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
