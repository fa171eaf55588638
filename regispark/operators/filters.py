"""Filter operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .._util import as_list, quote
from .joins import maybe_broadcast


def known(df: DataFrame, cols) -> DataFrame:
    """drop rows whose columns are NULL or the literal text ``'null'``."""
    cond = F.lit(True)
    for c in as_list(cols):
        cond = cond & F.col(quote(c)).isNotNull() & (F.col(quote(c)) != "null")
    return df.filter(cond)


def between_excl(df: DataFrame, c: str, lo, hi) -> DataFrame:
    """``lo < c < hi``."""
    return df.filter((F.col(quote(c)) > lo) & (F.col(quote(c)) < hi))


def phone_shape(df: DataFrame, ddd: str, tel: str, ddd_len: int = 2, tel_len: int = 8) -> DataFrame:
    """keep rows whose area code and number have the expected lengths."""
    return df.filter((F.length(ddd) == ddd_len) & (F.length(tel) == tel_len))


def keep_in(df: DataFrame, c: str, values) -> DataFrame:
    """whitelist filter. A Python list becomes an ``InSet`` hash probe; a DataFrame of
    allowed values becomes a left-semi join, broadcast if a size check allows."""
    if isinstance(values, DataFrame):
        key = values.columns[0]
        allowed = values.select(F.col(quote(key)).alias("__keep")).distinct()
        return df.join(maybe_broadcast(allowed), F.col(quote(c)) == F.col("__keep"), "left_semi")
    return df.filter(F.col(quote(c)).isin(list(values)))


def require(df: DataFrame, cols) -> DataFrame:
    """drop rows with NULL in any listed column."""
    return df.dropna(how="any", subset=as_list(cols))


def only_person_ids(df: DataFrame, flag: str = "PROBABILIDADE_DE_SER_CPF") -> DataFrame:
    """keep rows flagged as holding an individual's id."""
    return df.filter(F.col(quote(flag)) == "SIM")


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """F8: Bernoulli sample without replacement; the seed is mandatory."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_train_test(df: DataFrame, fraction: float = 0.75, seed: int = 1234, by=None) -> tuple[DataFrame, DataFrame]:
    """train/test split.

    A hash of the columns ``by`` (all columns unless given) and the seed decides, so the split
    is the same for any layout and rerun; rows equal in these columns go the same way.
    """
    bucket = F.pmod(F.xxhash64(F.lit(seed), *[F.col(quote(c)) for c in as_list(by) or df.columns]), F.lit(10_000))
    cut = int(round(fraction * 10_000))
    return df.filter(bucket < cut), df.filter(bucket >= cut)
