"""Train and score jobs for both tasks.

Train:  clean -> features -> fit (one grouping-sets shuffle + exact medians)
        -> model table written to the shared checkpoint folder.
Score:  scan inputs -> features -> chain of broadcast left joins -> sanitise.
        Scoring has no shuffle and no batch-wide aggregate, so the same
        functions accept a streaming DataFrame (stream-static join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import scalar
from tallyline.operators import cleaning, features, linear, running
from tallyline.operators.hierarchy import HierarchicalMedian, HierarchicalMedianModel, constant_model
from tallyline.session import materialize

TASK1_KEYS = ("task_id", "appt_hour", "appt_weekday")


def _levels(preset: str | list[list[str]], table: dict) -> list[list[str]]:
    return table[preset] if isinstance(preset, str) else preset


# ---------------------------------------------------------------------------
# Task 1: service minutes
# ---------------------------------------------------------------------------


def task1_training_rows(bookings: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Cleaned bookings as Task 1 feature rows with the target column."""
    cleaned = cleaning.clean_bookings(bookings)
    return features.task1_features(cleaned, tasks)


def with_task_complexity(bookings: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Cleaned bookings with ``task_complexity``, the median minutes of their task's bookings in ``history`` (by
    default the bookings themselves) on earlier days; an optional numeric feature of the Task 1 rows."""
    day = F.to_date("appointment_time").alias("_appt_day")
    past = (bookings if history is None else history).select("task_id", day, cleaning.TASK1_TARGET)
    rows = bookings.select("*", day)
    return running.with_past_median(rows, past, "task_id", "_appt_day", cleaning.TASK1_TARGET, "task_complexity").drop("_appt_day")


def fit_task1(rows: DataFrame, levels: str | list[list[str]] = "code", path: str | None = None) -> HierarchicalMedianModel:
    """Task 1 medians from feature rows; the constant model when no row has a target."""
    lv = _levels(levels, S.TASK1_LEVELS)
    model = HierarchicalMedian(lv, cleaning.TASK1_TARGET).fit(rows, path)
    if model.n_train == 0:
        return constant_model(rows.sparkSession, lv, cleaning.TASK1_TARGET, S.TASK1_FALLBACK_MEDIAN)
    return model


def train_task1(
    bookings: DataFrame, tasks: DataFrame | None = None, levels: str | list[list[str]] = "code", path: str | None = None
) -> HierarchicalMedianModel:
    return fit_task1(task1_training_rows(bookings, tasks), levels, path)


def task1_training_table(bookings: DataFrame, columns: list[str] | None = None, tasks: DataFrame | None = None) -> DataFrame:
    """Cleaned Task 1 rows with a target (with ``columns``, only these and the keys), written
    once to the shared checkpoint folder so that several fits read them without re-cleaning."""
    rows = task1_training_rows(bookings, tasks).where(F.col(cleaning.TASK1_TARGET).isNotNull())
    if columns is not None:
        rows = rows.select(*[c for c in dict.fromkeys([*TASK1_KEYS, *columns, cleaning.TASK1_TARGET]) if c in rows.columns])
    return materialize(rows, "task1-training-rows")


def fit_task1_linear(rows: DataFrame, only: tuple[str, ...] | None = None, min_rows: int = 1) -> linear.LinearModel:
    """OLS on the numeric and coded features of Task 1 rows."""
    return linear.fit_numeric(rows, cleaning.TASK1_TARGET, only=only, min_rows=min_rows, defaults=S.TASK1_FEATURE_DEFAULTS)


def predict_task1_rows(model: HierarchicalMedianModel, feats: DataFrame) -> DataFrame:
    """Adds ``prediction`` (raw), ``level`` and the sanitised integer output."""
    pred = model.predict(feats)
    lo, hi = S.TASK1_BOUNDS
    out = scalar.sanitize(F.col("prediction"), lo, hi)
    return pred.withColumn("true_processing_time_minutes", F.coalesce(out, F.lit(S.TASK1_DEFAULT_PREDICTION)))


def score_task1(model: HierarchicalMedianModel, inputs: DataFrame, tasks: DataFrame | None = None, with_level: bool = False) -> DataFrame:
    """``(row_id, true_processing_time_minutes)`` for every input row."""
    feats = features.task1_score_features(inputs, tasks)
    pred = predict_task1_rows(model, feats)
    cols = ["row_id", "true_processing_time_minutes"] + (["level"] if with_level else [])
    return pred.select(*cols)


# ---------------------------------------------------------------------------
# Task 2: employees per section and day
# ---------------------------------------------------------------------------

TASK2_TARGET = "staffing_target"


def task2_training_rows(staffing: DataFrame) -> DataFrame:
    """Cleaned staffing rows as Task 2 feature rows with the target column."""
    cleaned = cleaning.clean_staffing(staffing)
    with_target = cleaning.staffing_target(cleaned, TASK2_TARGET)
    return features.task2_features(with_target, keep=(TASK2_TARGET,))


def task2_training_table(staffing: DataFrame) -> DataFrame:
    """Task 2 feature rows with a target, written once for several fits."""
    rows = task2_training_rows(staffing)
    return materialize(rows.where(F.col(TASK2_TARGET).isNotNull()), "task2-training-rows")


def fit_task2(rows: DataFrame, levels: str | list[list[str]] = "code", path: str | None = None) -> HierarchicalMedianModel:
    """Task 2 medians from feature rows; the constant model when no row has a target."""
    lv = _levels(levels, S.TASK2_LEVELS)
    model = HierarchicalMedian(lv, TASK2_TARGET).fit(rows, path)
    if model.n_train == 0:
        return constant_model(rows.sparkSession, lv, TASK2_TARGET, S.TASK2_FALLBACK_MEDIAN)
    return model


def train_task2(staffing: DataFrame, levels: str | list[list[str]] = "code", path: str | None = None) -> HierarchicalMedianModel:
    return fit_task2(task2_training_rows(staffing), levels, path)


def fit_task2_linear(rows: DataFrame, only: tuple[str, ...] | None = None, min_rows: int = 1) -> linear.LinearModel:
    """OLS on the numeric, boolean (0/1) and coded features of Task 2 rows; the staffing of the
    row itself is no feature."""
    return linear.fit_numeric(
        rows, TASK2_TARGET, ("historical_employees", "date"), only, True, min_rows, S.TASK2_FEATURE_DEFAULTS
    )


def predict_task2_rows(model: HierarchicalMedianModel, feats: DataFrame) -> DataFrame:
    pred = model.predict(feats)
    lo, hi = S.TASK2_BOUNDS
    out = scalar.sanitize(F.col("prediction"), lo, hi)
    return pred.withColumn("true_required_employees", F.coalesce(out, F.lit(S.TASK2_DEFAULT_PREDICTION)))


def score_task2(model: HierarchicalMedianModel, inputs: DataFrame, with_level: bool = False) -> DataFrame:
    """``(row_id, true_required_employees)`` for every input row."""
    feats = features.task2_score_features(inputs)
    pred = predict_task2_rows(model, feats)
    cols = ["row_id", "true_required_employees"] + (["level"] if with_level else [])
    return pred.select(*cols)


# ---------------------------------------------------------------------------
# In-sample metrics (rounded predictions, as the trainers report them)
# ---------------------------------------------------------------------------


def metrics(pred: DataFrame, pred_col: str, target_col: str) -> DataFrame:
    """One row: MAE, RMSE and sample count over rows with a target."""
    err = F.col(pred_col).cast("double") - F.col(target_col)
    rows = pred.where(F.col(target_col).isNotNull())
    return rows.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.count(F.lit(1)).alias("samples"),
    )


def train_metrics_task1(model: HierarchicalMedianModel, rows: DataFrame, rounded: bool = True) -> DataFrame:
    """In-sample metrics of the sanitised integer predictions, or (``rounded=False``)
    of the raw medians before clipping and rounding."""
    pred = predict_task1_rows(model, rows)
    return metrics(pred, "true_processing_time_minutes" if rounded else "prediction", cleaning.TASK1_TARGET)


def train_metrics_task2(model: HierarchicalMedianModel, rows: DataFrame) -> DataFrame:
    pred = predict_task2_rows(model, rows)
    return metrics(pred, "true_required_employees", TASK2_TARGET)
