"""Least-squares models from one Gram aggregate, and the median/linear ensemble.

All sums that least squares needs (``n``, sums, and products of every two columns, each
shifted by its fill value) are one partial-then-final aggregate over the training rows, in one group per
column: no copy of the design, no pass for scaling, and nothing larger than ``d * d`` numbers leaves the
executors. Products square a design's condition, and codes of text columns, with 999999 for a missing label,
would lose their digits in it. So such a column enters as two, its code and whether it is missing, of which it is a fixed
sum; the driver factors the covariance of these well-scaled columns, goes back to the features with the
factor, and solves there without squaring. Of all best solutions on standardised features it is the one
of least norm, where directions under ``COLLINEAR`` count as collinear.

Scoring applies the coefficients as one arithmetic column (code-generated, no per-row vectors).
``fit_numeric`` takes every numeric column once text columns are coded (codes fitted on the training
rows). NULLs and NaNs are filled with medians fitted on the training rows and stored; after that
±inf becomes 0. The ensembles ask for ``min_rows`` training rows, else they have no linear part; a
plain linear model fits any non-empty set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S
from tallyline.functions import scalar
from tallyline.operators.features import (
    ID_COLUMNS,
    apply_category_codes,
    apply_impute,
    booleans_to_int,
    categorical_columns,
    fit_category_codes,
    fit_impute_medians,
)
from tallyline.sources import modelstore

#: Shares of the largest singular value of the features, and of the largest eigenvalue of the parted columns, under
#: which a direction is collinear.
COLLINEAR, PARTED = 1e-9, 1e-12


def numeric_feature_columns(df: DataFrame, exclude: tuple[str, ...]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def _doubles(df: DataFrame, cols: list[str]) -> DataFrame:
    """Features as doubles, NaN as NULL (both are filled)."""
    value = lambda c: F.col(c).cast("double")
    return df.select(*[c for c in df.columns if c not in cols], *[F.when(~F.isnan(value(c)), value(c)).alias(c) for c in cols])


def _filled(df: DataFrame, cols: list[str], fills: DataFrame) -> DataFrame:
    """Medians into NULLs, then 0 for ±inf and for columns without any training value."""
    out = apply_impute(df, fills)
    return out.withColumns({c: F.when(scalar.is_finite(F.col(c)), F.col(c)).otherwise(0.0) for c in cols})


@dataclass
class LinearModel:
    feature_cols: list[str]
    fills: DataFrame
    prediction_col: str = "linear_prediction"
    coefficients: list[float] | None = None  # per standardised feature
    means: list[float] | None = None
    stds: list[float] | None = None
    intercept: float = 0.0
    codes: DataFrame | None = None  # (column, value, code) of the text features
    categories: list[str] = field(default_factory=list)
    booleans: bool = False  # booleans are features, as 0/1
    defaults: dict[str, object] = field(default_factory=dict)  # for features absent at scoring, else 0

    @property
    def fitted(self) -> bool:
        return self.coefficients is not None

    def parts(self) -> tuple[dict[str, DataFrame], dict]:
        """Tables and settings to commit (``modelstore.save``), alone or with those of other models."""
        spark = self.fills.sparkSession
        n = len(self.feature_cols)
        terms = zip(range(n), self.feature_cols, self.coefficients or [None] * n, self.means or [None] * n, self.stds or [None] * n, strict=True)
        none = spark.createDataFrame([], "column string, value string, code int")
        tables = {
            "terms": spark.createDataFrame(list(terms), "i int, feature string, coefficient double, mean double, std double"),
            "fills": self.fills,
            "codes": self.codes if self.codes is not None else none,
        }
        settings = {
            "prediction_col": self.prediction_col, "intercept": self.intercept, "categories": self.categories,
            "booleans": self.booleans, "defaults": self.defaults, "fitted": self.fitted,
        }
        return tables, settings

    def save(self, path: str) -> None:
        modelstore.save(self.fills.sparkSession, path, *self.parts())

    @classmethod
    def load(cls, spark: SparkSession, path: str, verify: bool = False) -> LinearModel:
        tables, s = modelstore.load(spark, path, verify)
        terms = sorted(tables["terms"].collect())  # one row per feature
        column = lambda name: [t[name] for t in terms] if s["fitted"] else None
        return cls(
            [t["feature"] for t in terms], tables["fills"], s["prediction_col"], column("coefficient"), column("mean"), column("std"),
            float(s["intercept"]), tables["codes"], list(s["categories"]), s["booleans"], s["defaults"],
        )

    def expression(self) -> F.Column:
        """The fitted model as one arithmetic column: intercept + sum(coef * (x - mean) / std).

        A feature with zero spread contributes 0, as the scaler maps it to 0.
        """
        out = F.lit(float(self.intercept))
        for c, w, m, sd in zip(self.feature_cols, self.coefficients, self.means, self.stds):
            if sd == 0.0 or w == 0.0:
                continue
            out = out + F.lit(float(w)) * ((F.col(c) - F.lit(float(m))) / F.lit(float(sd)))
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            return df.withColumn(self.prediction_col, F.lit(None).cast("double"))
        x = df
        for c in self.feature_cols:
            if c not in df.columns:
                v = self.defaults.get(c, 0)
                x = x.withColumn(c, F.lit(v) if v is not None else F.lit(None).cast("double"))
        if self.booleans:
            x = booleans_to_int(x)
        # a text feature absent at scoring has a label as its default, or is a number already
        texts = [c for c in self.categories if isinstance(x.schema[c].dataType, T.StringType)]
        if texts:
            x = apply_category_codes(x, self.codes, texts)
        x = _filled(_doubles(x, self.feature_cols), self.feature_cols, self.fills)
        return x.withColumn(self.prediction_col, self.expression())


def gram(x: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, float]:
    """Of ``x(v, y)``, ``v`` an array of ``d`` numbers: rows, means, covariances, covariances with ``y``, and its mean."""
    # a row per feature times all features: d sums of code that stays compiled, not d * d
    rows = x.select("v", "y", F.posexplode("v").alias("i", "a"))
    sums = [F.count(F.lit(1)).alias("n"), F.sum("a").alias("s"), F.sum("y").alias("y"), F.sum(F.col("a") * F.col("y")).alias("ay")]
    found = rows.groupBy("i").agg(*sums, F.array(*(F.sum(F.col("a") * F.col("v")[j]) for j in range(d))).alias("p")).orderBy("i").collect()
    if not found:
        return 0, np.zeros(d), np.zeros((d, d)), np.zeros(d), 0.0
    n, y = found[0]["n"], found[0]["y"] / found[0]["n"]
    mean = np.array([r["s"] for r in found]) / n
    square = np.array([r["p"] for r in found]) / n
    covariance = (square + square.T) / 2 - np.outer(mean, mean)
    return n, mean, covariance, np.array([r["ay"] for r in found]) / n - mean * y, y


def fit_linear(
    df: DataFrame,
    target: str,
    feature_cols: list[str],
    prediction_col: str = "linear_prediction",
    min_rows: int = 1,
    coded: list[str] | tuple[str, ...] = (),
) -> LinearModel:
    """Least squares of ``target`` on ``feature_cols``, of least norm on standardised features; ``coded`` are
    codes of text columns."""
    rows = df.where(F.col(target).isNotNull())
    rows = _doubles(rows, feature_cols)
    fills = fit_impute_medians(rows, feature_cols)
    if not feature_cols:
        return LinearModel(feature_cols, fills, prediction_col)
    shift = {r["column"]: r["fill"] for r in fills.collect()}  # one value per feature
    parts, made = [], []  # columns of the aggregate, and what each gives to which feature
    for j, c in enumerate(feature_cols):
        if c in coded:
            missing = F.col(c) == float(S.MISSING_CODE)
            parts += [F.when(missing, 0.0).otherwise(F.col(c)), missing.cast("double")]
            made += [(j, 1.0, 0.0), (j, float(S.MISSING_CODE), 0.0)]
        else:
            moved = float(shift.get(c) or 0.0)
            parts.append(F.col(c) - F.lit(moved))
            made.append((j, 1.0, moved))
    x = _filled(rows, feature_cols, fills).select(F.array(*parts).alias("v"), F.col(target).cast("double").alias("y"))
    n, centre, covariance, with_y, y_mean = gram(x, len(parts))
    if n < max(1, min_rows):
        return LinearModel(feature_cols, fills, prediction_col)
    to_feature = np.zeros((len(parts), len(feature_cols)))
    mean = np.zeros(len(feature_cols))
    for i, (j, times, moved) in enumerate(made):
        to_feature[i, j] = times
        mean[j] += times * centre[i] + moved
    unit = np.sqrt(np.maximum(np.diag(covariance), 0.0))
    unit[unit <= 1e-12 * np.maximum(1.0, np.abs(centre))] = 0.0  # of a constant column only rounding is left
    scale = np.where(unit > 0, unit, np.inf)
    values, vectors = np.linalg.eigh(covariance / np.outer(scale, scale))
    kept = values > PARTED * max(values[-1], 1.0)
    factor = np.sqrt(values[kept])[:, None] * vectors[:, kept].T  # its square is the correlation
    design = (factor * unit) @ to_feature
    spread = np.sqrt((design**2).sum(axis=0))
    wanted = (vectors[:, kept].T @ (with_y / scale)) / np.sqrt(values[kept])
    weights = np.linalg.lstsq(design / np.where(spread > 0, spread, np.inf), wanted, rcond=COLLINEAR)[0]
    weights = np.where(spread > 0, weights, 0.0)
    return LinearModel(feature_cols, fills, prediction_col, weights.tolist(), mean.tolist(), spread.tolist(), float(y_mean))


def fit_numeric(
    df: DataFrame,
    target: str,
    exclude: tuple[str, ...] = (),
    only: tuple[str, ...] | None = None,
    booleans: bool = False,
    min_rows: int = 1,
    defaults: dict[str, object] | None = None,
) -> LinearModel:
    """OLS on all numeric columns of ``df`` after its text columns are coded (and, with
    ``booleans``, booleans are 0/1), but for ids, the target and ``exclude``; or on ``only`` these."""
    rows = df.where(F.col(target).isNotNull())
    if only is not None:
        rows = rows.select(*only, target)
    if booleans:
        rows = booleans_to_int(rows)
    categories = [c for c in categorical_columns(rows, (*ID_COLUMNS, *exclude)) if c != target]
    codes = fit_category_codes(rows, categories)
    coded = apply_category_codes(rows, codes, categories)
    cols = numeric_feature_columns(coded, (*ID_COLUMNS, target, *exclude))
    model = fit_linear(coded, target, cols, min_rows=min_rows, coded=categories)
    model.codes, model.categories, model.booleans = codes, [c for c in categories if c in cols], booleans
    model.defaults = dict(defaults or {})
    return model


def blend(median_pred, linear_pred) -> F.Column:
    """``0.7 * median + 0.3 * linear``; the medians alone when there is no linear value."""
    mixed = F.lit(S.ENSEMBLE_MEDIAN_WEIGHT) * median_pred + F.lit(S.ENSEMBLE_LINEAR_WEIGHT) * linear_pred
    return F.when(linear_pred.isNull(), median_pred).otherwise(mixed)
