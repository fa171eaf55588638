"""Q11: the exploratory question set over the final sole-trader table, as lazy tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from .._util import quote
from ..operators import joins as J
from ..operators import profile as A
from ..operators.filters import between_excl, known

#: Probabilities of the capital distribution.
CAPITAL_PROBS = [0.05, 0.1, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 0.99]


def _busiest(profile: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` groups with most rows, ties by key."""
    return profile.orderBy(F.desc("n"), F.asc_nulls_first(quote(key))).limit(k)


def questions(df: DataFrame, population: DataFrame | None = None, total: int | None = None,
              exact: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """Every question of the exploratory notebook, each built when called. ``exact`` takes
    exact quantiles instead of sketches; questions whose columns are missing are left out."""
    paid = df.filter(F.col("CAP_SOCIAL") > 1)
    status = known(df, ["NM_SIT_CADASTRAL"])
    closed = F.col("NM_SIT_CADASTRAL") == "BAIXADA"

    def profile(rows: DataFrame, key: str) -> DataFrame:
        return A.group_profile(rows, key, "CAP_SOCIAL", exact=exact)

    out = {
        "status_mix": lambda: A.share(status, "NM_SIT_CADASTRAL"),
        "per_state": lambda: A.share(df, "UF", total=total),
        "status_by_state": lambda: A.freq(df, ["UF", "NM_SIT_CADASTRAL"]),
        "per_year_branch": lambda: A.freq(df, ["ano_cadastro", "NM_MATRIZ_FILIAL"]),
        "branch_mix": lambda: A.share(df, "NM_MATRIZ_FILIAL"),
        "top10_activities": lambda: A.freq(df, "CNAE", top=10),
        "capital_summary": lambda: A.summary_long(paid, "CAP_SOCIAL", exact=exact),
        "capital_quantiles": lambda: A.quantiles(paid, "CAP_SOCIAL", CAPITAL_PROBS, exact=exact),
        "capital_mean": lambda: A.filtered_mean(df, "CAP_SOCIAL", 1, 100_001, digits=0),
        "status_by_year": lambda: A.freq(df, ["ano_cadastro", "NM_SIT_CADASTRAL"]),
        "capital_by_activity": lambda: _busiest(profile(paid, "CNAE"), "CNAE", 10),
        "closure_reasons": lambda: _busiest(profile(paid.filter(closed), "NM_MOTIVO"), "NM_MOTIVO", 10),
        "open_reasons": lambda: A.freq(df.filter(~closed & (F.col("NM_MOTIVO") != "SEM MOTIVO")), "NM_MOTIVO"),
        "capital_by_status": lambda: profile(paid, "NM_SIT_CADASTRAL"),
        "capital_histogram": lambda: A.histogram(between_excl(df, "CAP_SOCIAL", 1, 150_001), "CAP_SOCIAL", 20),
        "gender_mix": lambda: A.share(df, "CLASSIFICACAO"),
    }
    for name, column, top in (("phone_type", "TIPO_TELEFONE", None), ("provider_top20", "PROVEDOR", 20),
                              ("operator_top25", "OPERADORA", 25)):
        if column in df.columns:
            out[name] = lambda column=column, top=top: A.freq(df, column, top=top) if top else A.share(df, column)
    if population is not None:
        out["state_vs_population"] = lambda: J.ratio_to_reference(
            df.groupBy("UF").agg(F.count(F.lit(1)).alias("n")), population, "UF", "n", "Pop", "percent", 2, 100.0)
    return out


def eda_tables(df: DataFrame, population: DataFrame | None = None, total: int | None = None, exact: bool = False,
               only: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The tables of :func:`questions`, all or those named in ``only`` (the caller collects)."""
    asked = questions(df, population, total, exact)
    return {name: asked[name]() for name in (asked if only is None else only)}
