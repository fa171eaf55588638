"""Feature selection and model-based importance with Spark ML.

Every fit is a distributed Spark ML job; the outputs (coefficients, importances, selected
names) are bounded by the number of features and come back as small DataFrames.
Feature names are read from the ``ml_attr`` metadata that ``VectorAssembler`` /
``RFormula`` attach, so expanded (one-hot / indexed) columns keep their names.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import (RFormula, StringIndexer, UnivariateFeatureSelector, VarianceThresholdSelector, VectorAssembler,
                                VectorSlicer)
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .._util import as_list, quote, spread_for_iterations
from . import linear
from .projection import split_columns
from .tails import with_p_value


def vector_names(df: DataFrame, vector_col: str = "features") -> list[str]:
    """Names of the slots of an ML vector column from its ``ml_attr`` metadata."""
    attrs = df.schema[vector_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in slots]


def most_categories(df: DataFrame, vector_col: str = "features") -> int:
    """The largest category count among the nominal slots of an assembled vector."""
    attrs = df.schema[vector_col].metadata.get("ml_attr", {}).get("attrs", {})
    return max((a.get("num_vals") or len(a.get("vals", ())) for a in attrs.get("nominal", ())), default=0)


def index_assemble(df: DataFrame, categorical, numeric, label: str | None = None, handle_invalid: str = "keep",
                   features_col: str = "features") -> DataFrame:
    """L1: StringIndexer on categoricals (+ label) and VectorAssembler over indexes and numerics."""
    categorical, numeric = as_list(categorical), as_list(numeric)
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=[f"{c}_index" for c in categorical],
                                    handleInvalid=handle_invalid, stringOrderType="frequencyDesc"))
    if label is not None:
        # a label's classes are its values: rows without a label are skipped, never a class
        stages.append(StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip",
                                    stringOrderType="alphabetAsc"))
    stages.append(VectorAssembler(inputCols=[f"{c}_index" for c in categorical] + numeric, outputCol=features_col,
                                  handleInvalid="skip" if handle_invalid == "skip" else "keep"))
    return Pipeline(stages=stages).fit(df).transform(df)


@contextmanager
def iterative_input(data: DataFrame):
    """Training rows for an iterative fit (tens of passes): spread once if narrow, kept
    (memory, then disk) for the duration of the fit and released afterwards."""
    data = spread_for_iterations(data).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


def _scores(df: DataFrame, names, scores, threshold: float | None, col: str) -> DataFrame:
    rows = [(n, float(s)) for n, s in zip(names, scores)]
    out = df.sparkSession.createDataFrame(rows, f"feature string, {col} double")
    if threshold is not None:
        out = out.filter(F.abs(F.col(col)) > threshold)
    return out.orderBy(F.desc(F.abs(F.col(col))), "feature")


def rank_features(df: DataFrame, names, scores, threshold: float | None = 0.05, col: str = "score") -> DataFrame:
    """O3: features ordered by |score|, keeping |score| > threshold."""
    return _scores(df, names, scores, threshold, col)


def _prepared(df: DataFrame, label: str, categorical=None, numeric=None, handle_invalid: str = "keep",
              index_label: bool = False):
    if categorical is None and numeric is None:
        categorical, numeric = split_columns(df, label)
    data = index_assemble(df, categorical, numeric, label if index_label else None, handle_invalid)
    if not index_label:
        data = data.withColumn("label", F.col(quote(label)).cast("double"))
    return data.filter(F.col("label").isNotNull()), vector_names(data)


def linear_importance(df: DataFrame, label: str, categorical=None, numeric=None, threshold: float | None = 0.05,
                      reg_param: float = 0.0, elastic_net: float = 0.5, standardize: bool = True) -> DataFrame:
    """L3: |coefficient| of an elastic-net linear regression on standardised features."""
    from pyspark.ml.regression import LinearRegression

    data, names = _prepared(df, label, categorical, numeric)
    model = LinearRegression(featuresCol="features", labelCol="label", regParam=reg_param,
                             elasticNetParam=elastic_net, standardization=standardize).fit(data)
    return _scores(df, names, model.coefficients.toArray(), threshold, "coefficient")


def logistic_importance(df: DataFrame, label: str, categorical=None, numeric=None, threshold: float | None = 0.05,
                        reg_param: float = 0.0, elastic_net: float = 0.5) -> DataFrame:
    """L2: |coefficient| of a (binomial or multinomial) logistic regression; for multinomial
    models the largest |coefficient| over classes is reported."""
    from pyspark.ml.classification import LogisticRegression

    data, names = _prepared(df, label, categorical, numeric, index_label=True)
    with iterative_input(data) as rows:
        model = LogisticRegression(featuresCol="features", labelCol="label", regParam=reg_param,
                                   elasticNetParam=elastic_net).fit(rows)
    m = model.coefficientMatrix.toArray()
    return _scores(df, names, abs(m).max(axis=0), threshold, "coefficient")


def rf_importance(df: DataFrame, label: str, categorical=None, numeric=None, task: str = "regression",
                  threshold: float | None = None, num_trees: int = 20, max_bins: int | None = None,
                  seed: int = 42) -> DataFrame:
    """Random-forest feature importances; ``max_bins`` is at least 32 and the largest
    category count of the indexed features unless given."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor

    cls = task == "classification"
    data, names = _prepared(df, label, categorical, numeric, index_label=cls)
    max_bins = max_bins or max(32, most_categories(data))
    est = (RandomForestClassifier if cls else RandomForestRegressor)(
        featuresCol="features", labelCol="label", numTrees=num_trees, maxBins=max_bins, seed=seed)
    with iterative_input(data) as rows:
        model = est.fit(rows)
    return _scores(df, names, model.featureImportances.toArray(), threshold, "importance")


def univariate_select(df: DataFrame, label: str, numeric, top: int = 5, label_type: str | None = None) -> DataFrame:
    """UnivariateFeatureSelector over continuous features; the label type follows the
    label's Spark type unless given (numeric -> F-regression, else ANOVA F)."""
    if label_type is None:
        label_type = "continuous" if isinstance(df.schema[label].dataType, T.NumericType) else "categorical"
    data, names = _prepared(df, label, [], numeric, index_label=label_type == "categorical")
    sel = UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="selected",
                                    selectionMode="numTopFeatures").setFeatureType("continuous") \
        .setLabelType(label_type).setSelectionThreshold(top)
    model = sel.fit(data)
    chosen = [names[i] for i in model.selectedFeatures]
    return df.sparkSession.createDataFrame([(n, i) for i, n in enumerate(chosen)], "feature string, rank int")


def variance_select(df: DataFrame, numeric, threshold: float = 0.5) -> DataFrame:
    """Features whose sample variance exceeds ``threshold``."""
    numeric = as_list(numeric)
    va = VectorAssembler(inputCols=numeric, outputCol="features", handleInvalid="skip")
    data = va.transform(df.select(*[F.col(quote(c)).cast("double").alias(c) for c in numeric]))
    model = VarianceThresholdSelector(featuresCol="features", outputCol="selected",
                                      varianceThreshold=threshold).fit(data)
    chosen = [numeric[i] for i in model.selectedFeatures]
    return df.sparkSession.createDataFrame([(n,) for n in chosen], "feature string")


def contingency(df: DataFrame, label: str, categorical) -> DataFrame:
    """(feature, category, class, n): the contingency tables of all features against the label
    from one scan and one map-side aggregate. Rows whose label or category is NULL are left
    out of the feature's table."""
    held = [F.struct(F.lit(c).alias("feature"), F.col(quote(c)).cast("string").alias("category")) for c in as_list(categorical)]
    cells = df.where(F.col(quote(label)).isNotNull()).select(F.col(quote(label)).cast("string").alias("class"), F.inline(F.array(*held)))
    return cells.where("category is not null").groupBy("feature", "category", "class").agg(F.count(F.lit(1)).alias("n"))


def chi_square_statistics(df: DataFrame, label: str, categorical) -> DataFrame:
    """(feature, statistic, dof) of the independence test of every feature against the label,
    in plain aggregates over the contingency tables. A feature or label of one value has 0
    degrees of freedom and no statistic; a feature without rows is not listed."""
    n = F.col("n").cast("double")
    cells = contingency(df, label, categorical).withColumns({
        "row": F.sum(n).over(Window.partitionBy("feature", "category")), "col": F.sum(n).over(Window.partitionBy("feature", "class"))})
    out = cells.groupBy("feature").agg(
        F.sum(n).alias("total"), F.sum(n * n / (F.col("row") * F.col("col"))).alias("fit"),
        ((F.count_distinct("category") - 1) * (F.count_distinct("class") - 1)).alias("dof"))
    return out.select("feature", F.when(F.col("dof") > 0, F.greatest(F.col("total") * (F.col("fit") - 1), F.lit(0.0))).alias("statistic"), "dof")


def chisq_select(df: DataFrame, label: str, categorical, top: int = 4) -> DataFrame:
    """The ``top`` categorical features by the chi-square test, as (feature, rank), the most
    dependent first. They are ranked by the normal score of the p-value (the cube root of
    statistic by degrees of freedom), which does not underflow as p-values of many rows do."""
    a = F.lit(2.0) / (9 * F.col("dof"))
    score = (F.cbrt(F.col("statistic") / F.col("dof")) - (1 - a)) / F.sqrt(a)
    best = chi_square_statistics(df, label, categorical).where("dof > 0").orderBy(score.desc(), "feature").limit(top)
    return best.select("feature", (F.row_number().over(Window.orderBy(score.desc(), "feature")) - 1).cast("int").alias("rank"))


def chi_square_test(df: DataFrame, label: str, categorical, alpha: float = 0.05) -> DataFrame:
    """Chi-square independence test of each categorical feature against the label:
    (feature, statistic, dof, p_value, dependent)."""
    return with_p_value(chi_square_statistics(df, label, categorical), "chi2", "statistic", "dof").withColumn("dependent", F.col("p_value") < alpha)


def rformula(df: DataFrame, formula: str, handle_invalid: str = "keep") -> DataFrame:
    """RFormula -> ``features`` / ``label``."""
    return RFormula(formula=formula, handleInvalid=handle_invalid).fit(df).transform(df)



def rformula_rf_rmse(df: DataFrame, formula: str, train_fraction: float = 0.75, seed: int = 1234,
                     num_trees: int = 20, max_bins: int | None = None, split_by=None) -> DataFrame:
    """RFormula + random forest; test RMSE and per-slot importances (names from metadata).
    The split is by a hash of ``split_by`` (all columns unless given), whatever the layout;
    ``max_bins`` is at least 32 and the largest category count unless given."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import RandomForestRegressor

    from .filters import split_train_test

    data = rformula(df, formula)
    names = vector_names(data)
    train, test = split_train_test(data, train_fraction, seed, split_by or df.columns)
    max_bins = max_bins or max(32, most_categories(data))
    with iterative_input(train) as rows:
        model = RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=num_trees, maxBins=max_bins,
                                      seed=seed).fit(rows)
    rmse = RegressionEvaluator(metricName="rmse", labelCol="label").evaluate(model.transform(test))
    return _scores(df, names, model.featureImportances.toArray(), None, "importance").withColumn("rmse", F.lit(rmse))


def vector_slice(df: DataFrame, indices, vector_col: str = "features", out: str = "sliced") -> DataFrame:
    """Keep vector slots by index; out-of-range indices raise before any job runs."""
    names = vector_names(df, vector_col)
    bad = [i for i in indices if i < 0 or (names and i >= len(names))]
    if bad:
        raise IndexError(f"slot indices out of range: {bad}")
    return VectorSlicer(inputCol=vector_col, outputCol=out, indices=list(indices)).transform(df)


def hash_fold(columns, folds: int, seed: int = 42) -> Column:
    """A row's fold, 0 to ``folds`` - 1, from the MD5 of ``columns``: it depends on the row alone,
    not on the layout, and rows equal in these columns share it."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(quote(c)).cast("string") for c in as_list(columns)])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(folds)).cast("int")


def formula_parts(df: DataFrame, formula: str) -> tuple[str, list[str]] | None:
    """Label and columns of a formula that is a plain sum of columns; None for any other."""
    label, _, right = (x.strip() for x in formula.partition("~"))
    terms = [t.strip() for t in right.split("+")]
    if terms == ["."]:
        terms = [c for c in df.columns if c != label]
    return (label, terms) if label in df.columns and all(t in df.columns for t in terms) else None


def kfold_rmse(df: DataFrame, formula: str, folds: int = 3, seed: int = 42, reg_params=(0.0,), by=None) -> DataFrame:
    """L15 (k-fold): cross-validated RMSE of a linear model for each ridge parameter, as
    (reg_param, rmse), the mean over folds of the root mean squared error.

    Rows are dealt to folds by a hash of the columns ``by`` (all columns unless given). The
    moments per fold, one scan and one aggregate, are sufficient: a training set's are the
    total less its fold's, and every parameter is solved from them. The penalty is Spark ML's:
    on features scaled to unit variance, with the label scaled too. Formulas other than a sum
    of columns go through RFormula and its dense slots. A fold without rows is left out."""
    fold = hash_fold(by or df.columns, folds, seed)
    parts = formula_parts(df, formula)
    if parts is None:
        from pyspark.ml.functions import vector_to_array

        dense = rformula(df, formula)
        names = [f"slot{i}" for i in range(len(vector_names(dense)))]
        slots = vector_to_array("features")
        df = dense.select(F.col("label").alias("y"), *[slots[i].alias(c) for i, c in enumerate(names)], fold.alias("fold"))
        parts, fold = ("y", names), F.col("fold")
    per_fold = linear.moments(df, *parts, by=fold, reference="rare")
    rows = []
    for lam in reg_params:
        errors = []
        for g, test in per_fold.items():
            others = [m for h, m in per_fold.items() if h != g]
            if not others:
                continue
            train = linear.merged(others)
            deviation = math.sqrt(train.cross[-1, -1] / train.n)
            scaled = lam / deviation if deviation > 0 else 0.0
            model = linear.fit(train, scaled * np.diag(train.cross)[:-1])
            errors.append(math.sqrt(model.squared_error(test) / test.n))
        rows.append((float(lam), sum(errors) / len(errors) if errors else None))
    return df.sparkSession.createDataFrame(rows, "reg_param double, rmse double")
