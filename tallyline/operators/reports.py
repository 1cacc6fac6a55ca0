"""Summaries, output checks and analyses of predictions.

Each report is one aggregate plan; exact quartiles and medians come from the
chunked-rank quantile operator, so no report funnels a whole column into one
task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import timefns
from tallyline.operators import joins
from tallyline.operators.median import grouped_median, grouped_quantiles


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two one-row aggregates side by side."""
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample std, min, exact 25/50/75 % (linear interpolation), max.

    One pass over ``df``: the plain statistics are observed while the quantile
    histogram is written.
    """
    c = F.col(col)
    obs = Observation(f"describe-{uuid.uuid4().hex[:8]}")
    exprs = [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")]
    q = grouped_quantiles(
        df.select(c, c.cast("double").alias("_v")), [], "_v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], observation=(obs, exprs)
    ).drop("n")
    stats = obs.get
    dt = dict((f.name, f.dataType) for f in df.schema.fields)[col]
    return q.select(
        F.lit(stats["count"]).cast("long").alias("count"),
        F.lit(stats["mean"]).cast("double").alias("mean"),
        F.lit(stats["std"]).cast("double").alias("std"),
        F.lit(stats["min"]).cast(dt).alias("min"),
        "p25",
        "p50",
        "p75",
        F.lit(stats["max"]).cast(dt).alias("max"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-NULL value, largest first."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)


def join_predictions(predictions: DataFrame, inputs: DataFrame) -> DataFrame:
    """Inputs with their prediction (inner join on ``row_id``); the bigger side is not broadcast."""
    return inputs.join(predictions, on="row_id", how="inner")


def prediction_overview(analysis: DataFrame, pred_col: str) -> DataFrame:
    p = F.col(pred_col)
    return analysis.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("section_id").alias("sections"),
        F.avg(p).alias("mean_prediction"),
        F.min(p).alias("min_prediction"),
        F.max(p).alias("max_prediction"),
    )


def section_summary(analysis: DataFrame, pred_col: str) -> DataFrame:
    """Per section: count, mean, sample std, min, max of predictions, rounded to 2 (half-even)."""
    p = F.col(pred_col)
    return analysis.where(F.col("section_id").isNotNull()).groupBy("section_id").agg(
        F.count(p).alias("count"),
        F.bround(F.avg(p), 2).alias("mean"),
        F.bround(F.stddev_samp(p), 2).alias("std"),
        F.min(p).alias("min"),
        F.max(p).alias("max"),
    )


def top_sections(analysis: DataFrame, pred_col: str, k: int = 5) -> DataFrame:
    """The ``k`` sections with the highest mean prediction (ties by section id)."""
    return section_summary(analysis, pred_col).orderBy(F.desc("mean"), F.asc("section_id")).limit(k)


def weekday_summary(analysis: DataFrame, pred_col: str, date_col: str = "date") -> DataFrame:
    """Mean prediction per weekday of the parsed date, rounded to 2 (half-even)."""
    dt = dict((f.name, f.dataType) for f in analysis.schema.fields)[date_col]
    wd = F.weekday(timefns.parse_date(F.col(date_col), dt))
    return analysis.withColumn("weekday", wd).where(F.col("weekday").isNotNull()).groupBy("weekday").agg(
        F.bround(F.avg(pred_col), 2).alias("mean_prediction")
    )


def model_metadata(rows: DataFrame, target: str, model_type: str, metrics: DataFrame) -> DataFrame:
    """One row: model type, target mean / sample std / median, sample count, MAE, RMSE."""
    t = F.col(target)
    stats = rows.agg(F.avg(t).alias("target_mean"), F.stddev_samp(t).alias("target_std"), F.count(t).alias("training_samples"))
    med = grouped_median(rows, [], target, median_col="target_median").drop("n")
    out = _one_row_join(_one_row_join(stats, med), metrics.select("mae", "rmse"))
    return out.withColumn("model_type", F.lit(model_type))


def validate_output(df: DataFrame, expected: list[str], value_col: str, lo: int, warn_above: int) -> DataFrame:
    """One-row check of a prediction file: column list, NULLs, integer type, bounds."""
    columns_ok = list(df.columns) == expected
    is_int = isinstance(dict((f.name, f.dataType) for f in df.schema.fields).get(value_col), (T.IntegerType, T.LongType, T.ShortType))
    v = F.col(value_col) if value_col in df.columns else F.lit(None)
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(nulls > 0).alias("rows_with_null"),
        F.count_if(v < lo).alias("below_min"),
        F.count_if(v > warn_above).alias("above_warn"),
    )
    return out.select(
        "*",
        F.lit(columns_ok).alias("columns_ok"),
        F.lit(is_int).alias("integer_type"),
        (F.lit(columns_ok) & F.lit(is_int) & (F.col("rows_with_null") == 0) & (F.col("below_min") == 0)).alias("valid"),
    )


def validate_submission(predictions: DataFrame, inputs: DataFrame, expected: list[str], value_col: str) -> DataFrame:
    """Cross-check against the inputs: row counts equal, no NULLs, values >= 0 after
    truncating non-integers; returns the one-row report."""
    v = F.col(value_col).cast("double")
    pred = predictions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("row_id").isNull() | v.isNull()).alias("nulls"),
        F.count_if(v != F.floor(v)).alias("non_integer"),
        F.count_if(F.col(value_col).cast("double").cast("long") < 0).alias("negative"),
    )
    n_in = inputs.agg(F.count(F.lit(1)).alias("input_rows"))
    out = _one_row_join(pred, n_in)
    ok = (F.lit(list(predictions.columns) == expected)) & (F.col("rows") == F.col("input_rows")) & (F.col("nulls") == 0) & (F.col("negative") == 0)
    return out.withColumn("valid", ok)


def truncate_predictions(predictions: DataFrame, value_col: str) -> DataFrame:
    """Non-integer predictions truncated to int (rewrite step of the submission check)."""
    return predictions.withColumn(value_col, F.col(value_col).cast("double").cast("long").cast("int"))


def task_complexity(rows: DataFrame, target: str, key: str = "task_id") -> DataFrame:
    """Median past processing time per task: ``(task_id, complexity, n)``."""
    return grouped_median(rows.where(F.col(target).isNotNull()), [key], target, median_col="complexity")
