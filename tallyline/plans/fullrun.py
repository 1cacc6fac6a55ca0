"""Full run: train both tasks, score both, write and validate the outputs.

Model choice is an argument (``baseline``, ``ensemble``, ``linear`` for both
tasks; ``patterns`` for Task 2). An unknown name means ``baseline``; where the data
cannot be fitted, the baseline medians are. Other errors are raised.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import scalar
from tallyline.operators import cleaning, features, linear, reports, staffing
from tallyline.operators.hierarchy import GLOBAL_LEVEL, HierarchicalMedianModel
from tallyline.plans import jobs
from tallyline.session import materialize, scratch_scope
from tallyline.sources import csv as csvio
from tallyline.sources import modelstore

log = logging.getLogger(__name__)

Scorer = Callable[[DataFrame], DataFrame]  # scoring inputs -> (row_id, value)


@dataclass
class Trained:
    """A fitted model of one task and the rows it was fitted on."""

    name: str
    rows: DataFrame
    target: str
    score: Scorer
    in_sample: Callable[[DataFrame], DataFrame]  # training rows -> (target, value)
    save: Callable[[str], None]

    def summary(self) -> DataFrame:
        """One row: model type, target summary, in-sample MAE and RMSE."""
        return reports.model_metadata(self.rows, self.target, self.name, jobs.metrics(self.in_sample(self.rows), "value", self.target))


# ---------------------------------------------------------------------------
# Task 1 scorers
# ---------------------------------------------------------------------------


def _task1_value(pred: DataFrame, value) -> DataFrame:
    out = F.coalesce(scalar.clamp_round(value, *S.TASK1_BOUNDS), F.lit(S.TASK1_DEFAULT_PREDICTION))
    return pred.select("row_id", out.alias("true_processing_time_minutes"))


def blend_task1(model: HierarchicalMedianModel, ols: linear.LinearModel, inputs: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    pred = ols.predict(model.predict(features.task1_score_features(inputs, tasks), level_col=None))
    return _task1_value(pred, linear.blend(F.col("prediction"), F.col("linear_prediction")))


def linear_task1(ols: linear.LinearModel, inputs: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    return _task1_value(ols.predict(features.task1_score_features(inputs, tasks)), F.col("linear_prediction"))


def _save_both(model: HierarchicalMedianModel, ols: linear.LinearModel) -> Callable[[str], None]:
    """An ensemble's two models as one commit."""

    def save(path: str) -> None:
        (medians, _), (terms, settings) = model.parts(), ols.parts()
        modelstore.save(model.table.sparkSession, path, medians | terms, settings)

    return save


def _task1_trained(name: str, rows: DataFrame, score: Scorer, value, save) -> Trained:
    return Trained(name, rows, cleaning.TASK1_TARGET, score, lambda r: value(r).select(cleaning.TASK1_TARGET, "value"), save)


def _task1_baseline(bookings: DataFrame, tasks: DataFrame | None) -> Trained:
    rows = jobs.task1_training_table(bookings, [], tasks)
    model = jobs.fit_task1(rows)

    def value(r: DataFrame) -> DataFrame:
        return jobs.predict_task1_rows(model, r).withColumn("value", F.col("true_processing_time_minutes"))

    return _task1_trained("baseline_median", rows, lambda inputs: jobs.score_task1(model, inputs, tasks), value, model.save)


def _task1_ensemble(bookings: DataFrame, tasks: DataFrame | None) -> Trained:
    rows = jobs.task1_training_table(bookings, tasks=tasks)  # cleaned once, read by both fits
    model = jobs.fit_task1(rows)
    ols = jobs.fit_task1_linear(rows, min_rows=S.MIN_ROWS_FOR_LINEAR)

    def value(r: DataFrame) -> DataFrame:
        blended = linear.blend(F.col("prediction"), F.col("linear_prediction"))
        return ols.predict(model.predict(r, level_col=None)).withColumn("value", scalar.clamp_round(blended, *S.TASK1_BOUNDS))

    return _task1_trained("ensemble", rows, lambda inputs: blend_task1(model, ols, inputs, tasks), value, _save_both(model, ols))


def _task1_linear(bookings: DataFrame, tasks: DataFrame | None) -> Trained:
    rows = jobs.task1_training_table(bookings, tasks=tasks)
    ols = jobs.fit_task1_linear(rows)
    if not ols.fitted:
        raise ValueError("No valid training data")

    def value(r: DataFrame) -> DataFrame:
        return ols.predict(r).withColumn("value", scalar.clamp_round(F.col("linear_prediction"), *S.TASK1_BOUNDS))

    return _task1_trained("linear", rows, lambda inputs: linear_task1(ols, inputs, tasks), value, ols.save)


TASK1_MODELS = {"baseline": _task1_baseline, "ensemble": _task1_ensemble, "linear": _task1_linear}


# ---------------------------------------------------------------------------
# Task 2 scorers
# ---------------------------------------------------------------------------


def _task2_value(pred: DataFrame, value) -> DataFrame:
    out = F.coalesce(scalar.clamp_round(value, *S.TASK2_BOUNDS), F.lit(S.TASK2_DEFAULT_PREDICTION))
    return pred.select("row_id", out.alias("true_required_employees"))


def blend_task2(model: HierarchicalMedianModel, ols: linear.LinearModel, inputs: DataFrame) -> DataFrame:
    pred = ols.predict(model.predict(features.task2_score_features(inputs), level_col=None))
    return _task2_value(pred, linear.blend(F.col("prediction"), F.col("linear_prediction")))


def linear_task2(ols: linear.LinearModel, inputs: DataFrame) -> DataFrame:
    return _task2_value(ols.predict(features.task2_score_features(inputs)), F.col("linear_prediction"))


def _task2_trained(name: str, rows: DataFrame, score: Scorer, value, save) -> Trained:
    return Trained(name, rows, jobs.TASK2_TARGET, score, lambda r: value(r).select(jobs.TASK2_TARGET, "value"), save)


def _task2_baseline(staffing_raw: DataFrame) -> Trained:
    rows = jobs.task2_training_table(staffing_raw)
    model = jobs.fit_task2(rows)

    def value(r: DataFrame) -> DataFrame:
        return jobs.predict_task2_rows(model, r).withColumn("value", F.col("true_required_employees"))

    return _task2_trained("baseline_median", rows, lambda inputs: jobs.score_task2(model, inputs), value, model.save)


def _task2_ensemble(staffing_raw: DataFrame) -> Trained:
    rows = jobs.task2_training_table(staffing_raw)  # cleaned once, read by both fits
    model = jobs.fit_task2(rows)
    ols = jobs.fit_task2_linear(rows, min_rows=S.MIN_ROWS_FOR_LINEAR)

    def value(r: DataFrame) -> DataFrame:
        blended = linear.blend(F.col("prediction"), F.col("linear_prediction"))
        return ols.predict(model.predict(r, level_col=None)).withColumn("value", scalar.clamp_round(blended, *S.TASK2_BOUNDS))

    return _task2_trained("ensemble", rows, lambda inputs: blend_task2(model, ols, inputs), value, _save_both(model, ols))


def _task2_linear(staffing_raw: DataFrame) -> Trained:
    rows = jobs.task2_training_table(staffing_raw)
    ols = jobs.fit_task2_linear(rows)
    if not ols.fitted:
        raise ValueError("No valid training data")

    def value(r: DataFrame) -> DataFrame:
        return ols.predict(r).withColumn("value", scalar.clamp_round(F.col("linear_prediction"), *S.TASK2_BOUNDS))

    return _task2_trained("linear", rows, lambda inputs: linear_task2(ols, inputs), value, ols.save)


def _task2_patterns(staffing_raw: DataFrame) -> Trained:
    rows = jobs.task2_training_table(staffing_raw)
    model = staffing.fit_staffing_patterns(rows, jobs.TASK2_TARGET)
    bounds = S.TASK2_BOUNDS

    def score(inputs: DataFrame) -> DataFrame:
        pred = model.predict(features.task2_score_features(inputs))
        return pred.select("row_id", scalar.sanitize(F.col("pattern_prediction"), *bounds).alias("true_required_employees"))

    def value(r: DataFrame) -> DataFrame:
        return model.predict(r).withColumn("value", scalar.sanitize(F.col("pattern_prediction"), *bounds))

    return _task2_trained("patterns", rows, score, value, lambda path: modelstore.save(staffing_raw.sparkSession, path, {"patterns": model.table()}))


TASK2_MODELS = {"baseline": _task2_baseline, "ensemble": _task2_ensemble, "linear": _task2_linear, "patterns": _task2_patterns}


def train_task1_model(name: str, bookings: DataFrame, tasks: DataFrame | None = None) -> Trained:
    """The model of a name; unknown names, and data a model cannot be fitted on, give the baseline."""
    maker = TASK1_MODELS.get(name, _task1_baseline)
    try:
        return maker(bookings, tasks)
    except (ValueError, IllegalArgumentException):
        log.warning("Task 1 model %r cannot be fitted; using the baseline medians", name, exc_info=True)
        return _task1_baseline(bookings, tasks)


def train_task2_model(name: str, staffing_raw: DataFrame) -> Trained:
    maker = TASK2_MODELS.get(name, _task2_baseline)
    try:
        return maker(staffing_raw)
    except (ValueError, IllegalArgumentException):
        log.warning("Task 2 model %r cannot be fitted; using the baseline medians", name, exc_info=True)
        return _task2_baseline(staffing_raw)


# ---------------------------------------------------------------------------
# Saved-model check and the full run
# ---------------------------------------------------------------------------


def validate_model_table(spark: SparkSession, path: str, levels: list[list[str]], target: str) -> bool:
    """A saved model table is as it was saved, has the required columns and a global row, and scores a row."""
    model = HierarchicalMedianModel.load(spark, path, levels, target, verify=True)
    needed = {"level", "median", "n"}
    if not needed.issubset(set(model.table.columns)):
        return False
    if model.level_rows.get(GLOBAL_LEVEL, 0) != 1:
        return False
    probe = spark.createDataFrame([(1,)], "row_id int")
    return model.predict(probe).where(F.col("prediction").isNotNull()).count() == 1


def validate_saved_model(spark: SparkSession, path: str, model: Trained, levels: list[list[str]]) -> bool:
    """The saved tables of a model can be read and hold what scoring needs."""
    if model.name in ("baseline_median", "ensemble") and not validate_model_table(spark, path, levels, model.target):
        return False
    if model.name == "patterns":
        tables, _ = modelstore.load(spark, path, verify=True)
        return tables["patterns"].where("kind = 'global'").count() == 1
    return model.name not in ("linear", "ensemble") or linear.LinearModel.load(spark, path, verify=True).feature_cols is not None


@dataclass
class RunResult:
    task1: DataFrame  # validation report of the Task 1 file
    task2: DataFrame
    submission1: DataFrame
    submission2: DataFrame
    summary1: DataFrame  # saved next to the model
    summary2: DataFrame
    model1_ok: bool
    model2_ok: bool


def _run_task(spark: SparkSession, train, inputs: DataFrame, default, out_dir: str, task: int, levels) -> tuple[DataFrame, bool]:
    """Train, save the model and its summary, score and write; the default predictions are
    written before an error goes on."""
    out = f"{out_dir}/task{task}_predictions"
    with scratch_scope(spark):  # the training rows go once all is written
        try:
            model = train()
            csvio.write_csv(model.score(inputs), out)
        except Exception:
            csvio.write_csv(default(inputs), out)
            raise
        path = f"{out_dir}/task{task}_model"
        model.save(path)
        model.summary().write.mode("overwrite").parquet(f"{path}-summary")
    return spark.read.parquet(f"{path}-summary"), validate_saved_model(spark, path, model, levels)


def rewrite_truncated(spark: SparkSession, path: str, value_col: str, inputs: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Check a written prediction file against its inputs; where it holds non-integers, the values are
    truncated and the file is written anew. Returns the report on the file as it was and the rows as they are."""
    back = csvio.read_csv_tolerant(spark, path)
    typed = back.withColumn(value_col, F.col(value_col).try_cast("double"))
    report = reports.validate_submission(typed, inputs, columns, value_col)
    row = report.first()
    report = spark.createDataFrame([row], report.schema)  # of the file as it was
    if row["non_integer"]:
        whole = materialize(reports.truncate_predictions(typed, value_col), "truncated-predictions")
        csvio.write_csv(whole, path)
        back = csvio.read_csv_tolerant(spark, path)
    return report, back.withColumn(value_col, F.col(value_col).cast("int"))


def full_run(
    spark: SparkSession,
    bookings_path: str,
    tasks_path: str,
    staffing_path: str,
    task1_inputs_path: str,
    task2_inputs_path: str,
    out_dir: str,
    task1_model: str = "baseline",
    task2_model: str = "baseline",
) -> RunResult:
    """Train both tasks from CSV, save models with their summaries, score both input files,
    write the outputs as CSV folders under ``out_dir``, check models and outputs."""
    # each file is parsed once; fits, scores and checks read the written columns they need
    once = lambda df: materialize(df, "csv-input")
    bookings = once(csvio.read_or_empty(spark, bookings_path, S.BOOKINGS_COLUMNS))
    tasks = once(csvio.read_or_empty(spark, tasks_path, S.TASKS_COLUMNS))
    staffing_raw = once(csvio.read_or_empty(spark, staffing_path, S.STAFFING_COLUMNS))

    in1 = once(csvio.read_csv_tolerant(spark, task1_inputs_path))
    csvio.validate_columns(in1, S.TASK1_TEST_COLUMNS, "task1_test_inputs")
    in2 = once(csvio.read_csv_tolerant(spark, task2_inputs_path))
    csvio.validate_columns(in2, S.TASK2_TEST_COLUMNS, "task2_test_inputs")

    v1, v2 = S.TASK1_OUTPUT_COLUMNS[-1], S.TASK2_OUTPUT_COLUMNS[-1]
    train1 = lambda: train_task1_model(task1_model, bookings, tasks)
    train2 = lambda: train_task2_model(task2_model, staffing_raw)
    summary1, ok1 = _run_task(spark, train1, in1, staffing.default_predictions_task1, out_dir, 1, S.TASK1_LEVELS["code"])
    summary2, ok2 = _run_task(spark, train2, in2, staffing.default_predictions_task2, out_dir, 2, S.TASK2_LEVELS["code"])
    report1, rows1 = rewrite_truncated(spark, f"{out_dir}/task1_predictions", v1, in1, S.TASK1_OUTPUT_COLUMNS)
    report2, rows2 = rewrite_truncated(spark, f"{out_dir}/task2_predictions", v2, in2, S.TASK2_OUTPUT_COLUMNS)
    return RunResult(
        reports.validate_output(rows1, S.TASK1_OUTPUT_COLUMNS, v1, 0, 480),
        reports.validate_output(rows2, S.TASK2_OUTPUT_COLUMNS, v2, 1, 100),
        report1, report2, summary1, summary2, ok1, ok2,
    )
