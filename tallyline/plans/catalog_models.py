"""Catalog part 3: models, metrics, reports, output checks and file round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import scalar, timefns
from tallyline.operators import cleaning, features, linear, reports, staffing
from tallyline.operators.hierarchy import HierarchicalMedianModel, fit_simple_stats
from tallyline.operators.median import grouped_median, grouped_quantiles
from tallyline.plans import catalog_ops, fullrun, jobs, rolling
from tallyline.plans.catalog import T1_LEVELS, T2_LEVELS, _t1_body, _t1_ctes, _t1_model, _t2_body, _t2_ctes, _t2_model, r6, register
from tallyline.plans.oracle import VIEWS, _DEPS, date_block_sql, hier_lookup_sql, with_views
from tallyline.session import materialize, temp_path
from tallyline.sources import csv as csvio
from tallyline.sources import fixtures as fx

VIEWS.update(
    {
        "t1_rows": """
  SELECT booking_id AS row_id, task_id, hour(appointment_time) AS appt_hour, isodow(appointment_time) - 1 AS appt_weekday,
         epoch_us(appointment_time) AS us, processing_time_minutes AS y
  FROM bookings_clean WHERE processing_time_minutes IS NOT NULL""",
        "bookings_csv": """
  SELECT booking_id, task_id, date_trunc('millisecond', check_in_time) AS check_in_time, date_trunc('millisecond', check_out_time) AS check_out_time FROM bookings_v""",
        "t2_rows": """
  SELECT row_number() OVER () AS row_id, section_id, weekday, is_weekend, y FROM t2_train""",
    }
)
_DEPS.update({"bookings_csv": ["bookings_v"], "t1_rows": ["bookings_clean"], "t2_rows": ["t2_train"]})


def _levels_table_sql(train: str, levels: list[list[str]], key_types: dict[str, str]) -> str:
    keys = list(key_types)
    parts = []
    for i, lv in enumerate(levels):
        sel = ", ".join(f"CAST({k} AS {key_types[k]}) AS {k}" if k in lv else f"CAST(NULL AS {key_types[k]}) AS {k}" for k in keys)
        where = " AND ".join(f"{k} IS NOT NULL" for k in lv)
        parts.append(f"SELECT {i} AS level, {sel}, round(median(y), 6) AS median, count(*) AS n FROM {train} WHERE {where} GROUP BY {', '.join(lv)}")
    sel = ", ".join(f"CAST(NULL AS {key_types[k]}) AS {k}" for k in keys)
    parts.append(f"SELECT -1 AS level, {sel}, round(median(y), 6) AS median, count(*) AS n FROM {train}")
    return "\nUNION ALL ".join(parts)


_T1_KEYS = {"task_id": "VARCHAR", "appt_hour": "INTEGER", "appt_weekday": "INTEGER"}
_T2_KEYS = {"section_id": "VARCHAR", "weekday": "INTEGER", "is_weekend": "BOOLEAN"}


def _model_table(model: HierarchicalMedianModel, keys: list[str]) -> DataFrame:
    return model.table.select("level", *keys, r6(F.col("median")).alias("median"), "n")


# ---------------------------------------------------------------------------
# Task 2 scoring and the fitted level tables
# ---------------------------------------------------------------------------


@register("score_task2", with_views(["t2_train", "t2_test"], f"SELECT row_id, true_required_employees FROM ({_t2_body}) p", _t2_ctes))
def score_task2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 end to end: clean staffing (fill employees), fit the 4-level medians, score every input row."""
    return jobs.score_task2(_t2_model(spark, sf_dir), fx.task2_test_v(spark, sf_dir))


@register(
    "hier_median_task2",
    with_views(
        ["t2_train", "t2_test"],
        f"SELECT row_id, true_required_employees, level, round(raw_prediction, 6) AS prediction FROM ({_t2_body}) p",
        _t2_ctes,
    ),
)
def hier_median_task2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 hierarchical lookup with the level used and the raw median per row."""
    model = _t2_model(spark, sf_dir)
    pred = jobs.predict_task2_rows(model, features.task2_score_features(fx.task2_test_v(spark, sf_dir)))
    return pred.select("row_id", "true_required_employees", "level", r6(F.col("prediction")).alias("prediction"))


@register("median_levels_task1", with_views(["t1_train"], _levels_table_sql("t1_train", T1_LEVELS, _T1_KEYS)))
def median_levels_task1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted Task 1 model table: median and count per key at every level, plus the global row."""
    return _model_table(_t1_model(spark, sf_dir), list(_T1_KEYS))


@register("median_levels_task2", with_views(["t2_train"], _levels_table_sql("t2_train", T2_LEVELS, _T2_KEYS)))
def median_levels_task2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted Task 2 model table."""
    return _model_table(_t2_model(spark, sf_dir), list(_T2_KEYS))


@register("model_table_roundtrip", with_views(["t2_train"], _levels_table_sql("t2_train", T2_LEVELS, _T2_KEYS)))
def model_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 model saved as Parquet and loaded back into a scoring model."""
    model = _t2_model(spark, sf_dir)
    path = temp_path(spark, "model-roundtrip")
    model.save(path)
    loaded = HierarchicalMedianModel.load(spark, path, T2_LEVELS, jobs.TASK2_TARGET)
    return _model_table(loaded, list(_T2_KEYS))


@register("global_median", with_views(["t1_train"], "SELECT round(median(y), 6) AS median, count(*) AS n FROM t1_train"))
def global_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median of all Task 1 targets (mean of the middle two for an even count)."""
    rows = jobs.task1_training_rows(fx.bookings_v(spark, sf_dir))
    m = grouped_median(rows, [], cleaning.TASK1_TARGET)
    return m.select(r6(F.col("median")).alias("median"), "n")


def _simple_sql(stat: str) -> str:
    return with_views(
        ["t1_train", "t1_test"],
        f"""SELECT t.row_id, round(coalesce(s.st, g.gs), 6) AS prediction
FROM t1_test t CROSS JOIN (SELECT {stat}(y) AS gs FROM t1_train) g
LEFT JOIN (SELECT task_id, appt_hour, {stat}(y) AS st FROM t1_train WHERE task_id IS NOT NULL AND appt_hour IS NOT NULL GROUP BY 1, 2) s
  ON t.task_id = s.task_id AND t.appt_hour = s.appt_hour""",
    )


def _simple(spark: SparkSession, sf_dir: str, stat: str) -> DataFrame:
    rows = jobs.task1_training_rows(fx.bookings_v(spark, sf_dir))
    model = fit_simple_stats(rows, ["task_id", "appt_hour"], cleaning.TASK1_TARGET, stat)
    feats = features.task1_score_features(fx.task1_test_v(spark, sf_dir))
    return model.predict(feats).select("row_id", r6(F.col("prediction")).alias("prediction"))


@register("simple_stats_median", _simple_sql("median"))
def simple_stats_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median per (task, hour) with the global median for unmatched or NULL keys."""
    return _simple(spark, sf_dir, "median")


@register("simple_stats_mean", _simple_sql("avg"))
def simple_stats_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean per (task, hour) with the global mean for unmatched or NULL keys."""
    return _simple(spark, sf_dir, "mean")


# ---------------------------------------------------------------------------
# In-sample metrics, metadata, fallbacks
# ---------------------------------------------------------------------------

_t1_in_ctes, _t1_in_body = hier_lookup_sql("t1_rows", "t1_rows", T1_LEVELS, "p", 0.0, 480.0, 30)
_t2_in_ctes, _t2_in_body = hier_lookup_sql("t2_rows", "t2_rows", T2_LEVELS, "p", 1.0, 50.0, 3)
_METRICS = "round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, count(*) AS samples"


@register(
    "train_metrics_task1",
    with_views(["t1_rows"], f"SELECT {_METRICS} FROM ({_t1_in_body}) q JOIN t1_rows r ON q.row_id = r.row_id", _t1_in_ctes),
)
def train_metrics_task1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-sample MAE / RMSE of the sanitised Task 1 predictions."""
    rows = jobs.task1_training_table(fx.bookings_v(spark, sf_dir), [])  # cleaned once: fit and metrics read it
    model = jobs.fit_task1(rows)
    m = jobs.train_metrics_task1(model, rows)
    return m.select(r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"), "samples")


@register(
    "train_metrics_task1_unrounded",
    with_views(
        ["t1_rows"],
        "SELECT round(avg(abs(raw_prediction - y)), 6) AS mae, round(sqrt(avg((raw_prediction - y) * (raw_prediction - y))), 6) AS rmse, "
        f"count(*) AS samples FROM ({_t1_in_body}) q JOIN t1_rows r ON q.row_id = r.row_id",
        _t1_in_ctes,
    ),
)
def train_metrics_task1_unrounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-sample MAE / RMSE of the raw Task 1 medians, before clipping and rounding."""
    rows = jobs.task1_training_table(fx.bookings_v(spark, sf_dir), [])
    model = jobs.fit_task1(rows)
    m = jobs.train_metrics_task1(model, rows, rounded=False)
    return m.select(r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"), "samples")


@register(
    "train_metrics_task2",
    with_views(["t2_rows"], f"SELECT {_METRICS} FROM ({_t2_in_body}) q JOIN t2_rows r ON q.row_id = r.row_id", _t2_in_ctes),
)
def train_metrics_task2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-sample MAE / RMSE of the sanitised Task 2 predictions."""
    rows = jobs.task2_training_table(fx.staffing_v(spark, sf_dir))
    m = jobs.train_metrics_task2(jobs.fit_task2(rows), rows)
    return m.select(r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"), "samples")


@register(
    "model_metadata",
    with_views(
        ["t1_rows"],
        f"""SELECT 'baseline_median' AS model_type, round(avg(y), 6) AS target_mean, round(stddev_samp(y), 6) AS target_std,
       round(median(y), 6) AS target_median, count(*) AS training_samples, m.mae, m.rmse
FROM t1_rows CROSS JOIN (SELECT {_METRICS} FROM ({_t1_in_body}) q JOIN t1_rows r ON q.row_id = r.row_id) m
GROUP BY m.mae, m.rmse""",
        _t1_in_ctes,
    ),
)
def model_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target summary stored with the Task 1 model, with its in-sample metrics."""
    rows = jobs.task1_training_table(fx.bookings_v(spark, sf_dir), [])
    model = jobs.fit_task1(rows)
    m = jobs.train_metrics_task1(model, rows)
    meta = reports.model_metadata(rows, cleaning.TASK1_TARGET, "baseline_median", m)
    return meta.select(
        "model_type", *[r6(F.col(c)).alias(c) for c in ("target_mean", "target_std", "target_median")], "training_samples",
        r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"),
    )


@register("constant_fallback", with_views(["task1_test_v"], "SELECT row_id, 30 AS true_processing_time_minutes FROM task1_test_v"))
def constant_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings without a check-out column have no target: the constant 30-minute model scores every row."""
    bookings = fx.bookings_v(spark, sf_dir).drop("check_out_time")
    model = jobs.train_task1(bookings)
    return jobs.score_task1(model, fx.task1_test_v(spark, sf_dir))


@register(
    "default_predictions",
    with_views(
        ["task2_test_v"],
        "SELECT row_id, CAST(CASE WHEN section_id IS NULL THEN 3 ELSE greatest(1, 3 + (CAST('0x' || substr(md5(section_id), 1, 8) AS BIGINT) % 5)) END AS INTEGER) AS true_required_employees FROM task2_test_v",
    ),
)
def default_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fallback Task 2 output: reproducible per-section default (3 without a section)."""
    return staffing.default_predictions_task2(fx.task2_test_v(spark, sf_dir))


@register(
    "postprocess_clamp",
    with_views(["t2_train", "t2_test"], "SELECT row_id, CAST(round_even(least(greatest(raw_prediction, 1.0), 50.0), 0) AS INTEGER) AS clamped FROM (" + _t2_body + ") p", _t2_ctes),
)
def postprocess_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-map clamp of raw Task 2 predictions to [1, 50] and half-even rounding."""
    model = _t2_model(spark, sf_dir)
    pred = model.predict(features.task2_score_features(fx.task2_test_v(spark, sf_dir)))
    lo, hi = S.TASK2_BOUNDS
    return pred.select("row_id", scalar.clamp_round(F.col("prediction"), lo, hi).alias("clamped"))


@register(
    "sanitize_predictions",
    with_views(
        ["t1_train", "t1_test"],
        "SELECT row_id, round(raw_prediction, 6) AS raw, true_processing_time_minutes AS sanitized, "
        "(CAST(true_processing_time_minutes AS DOUBLE) <> raw_prediction) AS changed FROM (" + _t1_body + ") p",
        _t1_ctes,
    ),
)
def sanitize_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw Task 1 predictions, their sanitised integers and whether sanitising changed them."""
    model = _t1_model(spark, sf_dir)
    pred = jobs.predict_task1_rows(model, features.task1_score_features(fx.task1_test_v(spark, sf_dir)))
    out = F.col("true_processing_time_minutes")
    return pred.select("row_id", r6(F.col("prediction")).alias("raw"), out.alias("sanitized"), (out.cast("double") != F.col("prediction")).alias("changed"))


# ---------------------------------------------------------------------------
# Staffing patterns and section profiles
# ---------------------------------------------------------------------------

_TI = "greatest(1, CAST(trunc({x}) AS INTEGER))"


@register(
    "staffing_pattern_fit",
    with_views(
        ["t2_train"],
        f"""SELECT 'section' AS kind, section_id AS key, {_TI.format(x='median(y)')} AS median_i, {_TI.format(x='avg(y)')} AS mean_i, count(*) AS count
FROM t2_train WHERE section_id IS NOT NULL GROUP BY section_id
UNION ALL SELECT 'weekday', CAST(weekday AS VARCHAR), {_TI.format(x='median(y)')}, {_TI.format(x='avg(y)')}, NULL FROM t2_train WHERE weekday IS NOT NULL GROUP BY weekday
UNION ALL SELECT 'global', NULL, NULL, {_TI.format(x='avg(y)')}, NULL FROM t2_train""",
    ),
)
def staffing_pattern_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section and weekday staffing patterns (truncated, floor 1) and the global mean."""
    rows = jobs.task2_training_rows(fx.staffing_v(spark, sf_dir))
    return staffing.fit_staffing_patterns(rows, jobs.TASK2_TARGET).table()


@register(
    "staffing_pattern_predict",
    with_views(
        ["t2_train", "t2_test"],
        f"""SELECT t.row_id, CAST(round_even(least(greatest(greatest(1,
         CASE WHEN t.section_id IS NOT NULL THEN
              CASE WHEN sec.section_id IS NOT NULL THEN
                   CASE WHEN wd.v IS NOT NULL THEN CAST(trunc(0.7::DOUBLE * sec.v + 0.3::DOUBLE * wd.v) AS INTEGER) ELSE sec.v END
              ELSE g.v END
         ELSE coalesce(wd.v, g.v) END), 1), 50), 0) AS INTEGER) AS true_required_employees
FROM t2_test t CROSS JOIN (SELECT {_TI.format(x='avg(y)')} AS v FROM t2_train) g
LEFT JOIN (SELECT section_id, CASE WHEN count(*) >= 3 THEN {_TI.format(x='median(y)')} ELSE {_TI.format(x='avg(y)')} END AS v
           FROM t2_train WHERE section_id IS NOT NULL GROUP BY 1) sec ON t.section_id = sec.section_id
LEFT JOIN (SELECT weekday, {_TI.format(x='median(y)')} AS v FROM t2_train WHERE weekday IS NOT NULL GROUP BY 1) wd ON t.weekday = wd.weekday""",
    ),
)
def staffing_pattern_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section/weekday pattern predictions for the Task 2 inputs, sanitised to [1, 50]."""
    rows = jobs.task2_training_rows(fx.staffing_v(spark, sf_dir))
    model = staffing.fit_staffing_patterns(rows, jobs.TASK2_TARGET)
    pred = model.predict(features.task2_score_features(fx.task2_test_v(spark, sf_dir)))
    lo, hi = S.TASK2_BOUNDS
    return pred.select("row_id", scalar.sanitize(F.col("pattern_prediction"), lo, hi).alias("true_required_employees"))


@register(
    "section_aggregates",
    with_views(
        ["staffing_clean"],
        """SELECT section_id, round(avg(employees_on_duty), 6) AS section_avg_employees, round(median(employees_on_duty), 6) AS section_median_employees,
       max(employees_on_duty) AS section_max_employees, min(employees_on_duty) AS section_min_employees,
       round(stddev_samp(employees_on_duty), 6) AS section_std_employees, round(avg(total_task_time_minutes), 6) AS section_avg_task_time,
       round(median(total_task_time_minutes), 6) AS section_median_task_time,
       CASE WHEN count(total_task_time_minutes) > 0 THEN count(*) END AS section_total_observations
FROM staffing_clean WHERE section_id IS NOT NULL GROUP BY section_id""",
    ),
)
def section_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-section staffing profile."""
    a = staffing.section_aggregates(cleaning.clean_staffing(fx.staffing_v(spark, sf_dir)))
    rounded = ["section_avg_employees", "section_median_employees", "section_std_employees", "section_avg_task_time", "section_median_task_time"]
    return a.select(*[r6(F.col(c)).alias(c) if c in rounded else F.col(c) for c in a.columns])


@register(
    "section_value_counts",
    with_views(["staffing_v"], "SELECT section_id, count(*) AS count FROM staffing_v WHERE section_id IS NOT NULL GROUP BY section_id"),
)
def section_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staffing rows per section, largest first."""
    return reports.value_counts(fx.staffing_v(spark, sf_dir), "section_id")


# ---------------------------------------------------------------------------
# Prediction reports and output checks
# ---------------------------------------------------------------------------

_T2_ANALYSIS = "SELECT i.*, p.true_required_employees AS pred FROM task2_test_v i JOIN (" + _t2_body + ") p ON i.row_id = p.row_id"


def _t2_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = fx.task2_test_v(spark, sf_dir)
    preds = jobs.score_task2(_t2_model(spark, sf_dir), inputs)
    return reports.join_predictions(preds, inputs)


@register(
    "describe_target",
    with_views(
        ["t1_train", "t1_test"],
        """SELECT count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min,
       round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
FROM (SELECT true_processing_time_minutes AS v FROM (""" + _t1_body + ") p) q",
        _t1_ctes,
    ),
)
def describe_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """describe() of the Task 1 predictions with exact quartiles."""
    scored = jobs.score_task1(_t1_model(spark, sf_dir), fx.task1_test_v(spark, sf_dir))
    d = reports.describe(scored, "true_processing_time_minutes")
    return d.select("count", *[r6(F.col(c)).alias(c) for c in ("mean", "std")], "min", *[r6(F.col(c)).alias(c) for c in ("p25", "p50", "p75")], "max")


@register(
    "prediction_overview",
    with_views(
        ["t2_train", "t2_test", "task2_test_v"],
        "SELECT count(*) AS rows, count(DISTINCT section_id) AS sections, round(avg(pred), 6) AS mean_prediction, min(pred) AS min_prediction, max(pred) AS max_prediction FROM (" + _T2_ANALYSIS + ") a",
        _t2_ctes,
    ),
)
def prediction_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct sections and prediction range of the Task 2 output."""
    o = reports.prediction_overview(_t2_analysis(spark, sf_dir), "true_required_employees")
    return o.select("rows", "sections", r6(F.col("mean_prediction")).alias("mean_prediction"), "min_prediction", "max_prediction")


_SECTION_SUMMARY_SQL = (
    "SELECT section_id, count(pred) AS count, round_even(avg(pred), 2) AS mean, round_even(stddev_samp(pred), 2) AS std, min(pred) AS min, max(pred) AS max "
    "FROM (" + _T2_ANALYSIS + ") a WHERE section_id IS NOT NULL GROUP BY section_id"
)


@register("prediction_analysis_section", with_views(["t2_train", "t2_test", "task2_test_v"], _SECTION_SUMMARY_SQL, _t2_ctes))
def prediction_analysis_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-section count, mean, std, min, max of Task 2 predictions (inputs joined on row id)."""
    return reports.section_summary(_t2_analysis(spark, sf_dir), "true_required_employees")


@register(
    "top_sections",
    with_views(["t2_train", "t2_test", "task2_test_v"], "SELECT * FROM (" + _SECTION_SUMMARY_SQL + ") s ORDER BY mean DESC, section_id LIMIT 5", _t2_ctes),
)
def top_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 sections by mean predicted staffing."""
    return reports.top_sections(_t2_analysis(spark, sf_dir), "true_required_employees")


@register(
    "prediction_analysis_weekday",
    with_views(
        ["t2_train", "t2_test", "task2_test_v"],
        "SELECT CAST(isodow(try_strptime(date, '%Y-%m-%d')) - 1 AS INTEGER) AS weekday, round_even(avg(pred), 2) AS mean_prediction FROM ("
        + _T2_ANALYSIS + ") a WHERE try_strptime(date, '%Y-%m-%d') IS NOT NULL GROUP BY 1",
        _t2_ctes,
    ),
)
def prediction_analysis_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean Task 2 prediction per weekday of the input date."""
    return reports.weekday_summary(_t2_analysis(spark, sf_dir), "true_required_employees")


def _validate_sql(body: str, col: str, lo: int, warn: int) -> str:
    return (
        f"SELECT count(*) AS rows, CAST(count_if(row_id IS NULL OR {col} IS NULL) AS BIGINT) AS rows_with_null, CAST(count_if({col} < {lo}) AS BIGINT) AS below_min, "
        f"CAST(count_if({col} > {warn}) AS BIGINT) AS above_warn, true AS columns_ok, true AS integer_type, "
        f"(count_if(row_id IS NULL OR {col} IS NULL) = 0 AND count_if({col} < {lo}) = 0) AS valid FROM ({body}) p"
    )


@register("validate_task1", with_views(["t1_train", "t1_test"], _validate_sql(_t1_body, "true_processing_time_minutes", 0, 480), _t1_ctes))
def validate_task1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check of the Task 1 output: columns, NULLs, integer type, >= 0 (warn > 480)."""
    scored = jobs.score_task1(_t1_model(spark, sf_dir), fx.task1_test_v(spark, sf_dir))
    return reports.validate_output(scored, S.TASK1_OUTPUT_COLUMNS, "true_processing_time_minutes", 0, 480)


@register("validate_task2", with_views(["t2_train", "t2_test"], _validate_sql(_t2_body, "true_required_employees", 1, 100), _t2_ctes))
def validate_task2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check of the Task 2 output: columns, NULLs, integer type, >= 1 (warn > 100)."""
    scored = jobs.score_task2(_t2_model(spark, sf_dir), fx.task2_test_v(spark, sf_dir))
    return reports.validate_output(scored, S.TASK2_OUTPUT_COLUMNS, "true_required_employees", 1, 100)


@register(
    "validate_submission",
    with_views(
        ["t1_train", "t1_test", "task1_test_v"],
        "SELECT count(*) AS rows, CAST(count_if(row_id IS NULL OR v IS NULL) AS BIGINT) AS nulls, CAST(count_if(v <> floor(v)) AS BIGINT) AS non_integer, "
        "CAST(count_if(trunc(v) < 0) AS BIGINT) AS negative, (SELECT count(*) FROM task1_test_v) AS input_rows, "
        "(count(*) = (SELECT count(*) FROM task1_test_v) AND count_if(row_id IS NULL OR v IS NULL) = 0 AND count_if(trunc(v) < 0) = 0) AS valid "
        "FROM (SELECT row_id, CAST(true_processing_time_minutes AS DOUBLE) AS v FROM (" + _t1_body + ") p) q",
        _t1_ctes,
    ),
)
def validate_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-check of the Task 1 file against its inputs (row count, NULLs, integers, sign)."""
    inputs = fx.task1_test_v(spark, sf_dir)
    scored = jobs.score_task1(_t1_model(spark, sf_dir), inputs)
    return reports.validate_submission(scored, inputs, S.TASK1_OUTPUT_COLUMNS, "true_processing_time_minutes")


# ---------------------------------------------------------------------------
# Documented extras: time-ordered hold-out, task complexity
# ---------------------------------------------------------------------------

_ho_ctes, _ho_body = hier_lookup_sql("ho_train", "ho_test", T1_LEVELS, "p", 0.0, 480.0, 30)


@register(
    "holdout_metrics",
    with_views(
        ["t1_rows"],
        f"""SELECT (SELECT count(*) FROM ho_train) AS train_rows, count(*) AS holdout_rows,
       round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse
FROM ({_ho_body}) q JOIN ho_test r ON q.row_id = r.row_id""",
        [
            ("cut", "SELECT us AS cut FROM (SELECT us, row_number() OVER (ORDER BY us) - 1 AS r, count(*) OVER () AS n FROM t1_rows) z WHERE r = floor(0.8 * (n - 1))"),
            ("ho_train", "SELECT t1_rows.* FROM t1_rows, cut WHERE us <= cut.cut"),
            ("ho_test", "SELECT t1_rows.* FROM t1_rows, cut WHERE us > cut.cut"),
        ]
        + _ho_ctes,
    ),
)
def holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-ordered split: the latest ~20 % of training rows held out and scored by a model fitted on the rest."""
    cleaned = cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)).withColumn("appt_us", F.unix_micros("appointment_time"))
    rows = features.task1_features(cleaned, keep=(cleaning.TASK1_TARGET, "appt_us")).where(F.col(cleaning.TASK1_TARGET).isNotNull())
    rows = materialize(rows.select(*jobs.TASK1_KEYS, cleaning.TASK1_TARGET, "appt_us"), "holdout-rows")  # cut, fit and test read it
    cut = grouped_quantiles(rows.select(F.col("appt_us").cast("double").alias("us")), [], "us", [0.8], ["cut"], method="lower").collect()[0]["cut"]
    train = rows.where(F.col("appt_us") <= F.lit(cut))
    test = rows.where(F.col("appt_us") > F.lit(cut))
    from tallyline.operators.hierarchy import HierarchicalMedian

    model = HierarchicalMedian(T1_LEVELS, cleaning.TASK1_TARGET).fit(train)
    m = jobs.train_metrics_task1(model, test)
    return m.select(F.lit(model.n_train).cast("long").alias("train_rows"), F.col("samples").alias("holdout_rows"), r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"))


ROLLING_FOLDS, ROLLING_FIRST = 5, 0.5


def _rolling_sql() -> str:
    """Each origin's model by its own query: SQL of five separate fits."""
    parts = []
    for i in range(ROLLING_FOLDS):
        ctes, body = hier_lookup_sql("ro_train", "ro_test", T1_LEVELS, "p", 0.0, 480.0, 30)
        own = [("ro_train", f"SELECT t1_rows.* FROM t1_rows, cuts WHERE us <= c{i}")]
        upper = f" AND us <= c{i + 1}" if i + 1 < ROLLING_FOLDS else ""
        own.append(("ro_test", f"SELECT t1_rows.* FROM t1_rows, cuts WHERE us > c{i}{upper}"))
        with_sql = ", ".join(f"{n} AS ({sql})" for n, sql in own + ctes)
        parts.append(
            f"SELECT * FROM (WITH {with_sql} SELECT {i} AS origin, (SELECT count(*) FROM ro_train) AS train_rows, count(*) AS test_rows, "
            f"round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse FROM ({body}) q JOIN ro_test r ON q.row_id = r.row_id) f{i}"
        )
    return " UNION ALL ".join(parts)


_CUTS_SQL = ", ".join(
    f"max(CASE WHEN r = floor({ROLLING_FIRST + i * (1 - ROLLING_FIRST) / ROLLING_FOLDS} * (n - 1)) THEN us END) AS c{i}" for i in range(ROLLING_FOLDS)
)


@register(
    "rolling_origin_metrics",
    with_views(
        ["t1_rows"],
        _rolling_sql(),
        [("cuts", f"SELECT {_CUTS_SQL} FROM (SELECT us, row_number() OVER (ORDER BY us) - 1 AS r, count(*) OVER () AS n FROM t1_rows WHERE us IS NOT NULL) z")],
    ),
)
def rolling_origin_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling-origin validation of Task 1: five models, each fitted up to its origin and tested up to the next, from one fit."""
    cleaned = cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)).withColumn("appt_us", F.unix_micros("appointment_time"))
    rows = features.task1_features(cleaned, keep=(cleaning.TASK1_TARGET, "appt_us")).where(F.col(cleaning.TASK1_TARGET).isNotNull())
    rows = materialize(rows.select(*jobs.TASK1_KEYS, cleaning.TASK1_TARGET, "appt_us"), "rolling-rows")
    m = rolling.rolling_metrics(
        rows, T1_LEVELS, cleaning.TASK1_TARGET, "appt_us", jobs.predict_task1_rows, "true_processing_time_minutes", ROLLING_FOLDS, ROLLING_FIRST
    )
    return m.select("origin", "train_rows", "test_rows", r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"))


@register(
    "task_complexity",
    with_views(["t1_train"], "SELECT task_id, round(median(y), 6) AS complexity, count(*) AS n FROM t1_train WHERE task_id IS NOT NULL GROUP BY task_id"),
)
def task_complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task complexity score: median past processing time per task."""
    rows = jobs.task1_training_rows(fx.bookings_v(spark, sf_dir))
    c = reports.task_complexity(rows, cleaning.TASK1_TARGET)
    return c.select("task_id", r6(F.col("complexity")).alias("complexity"), "n")


_PAST = "median(y) OVER (PARTITION BY task_id ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)"


@register(
    "task_complexity_past",
    with_views(
        ["t1_rows"],
        f"SELECT row_id AS booking_id, task_id, strftime(day, '%Y-%m-%d') AS day, round(CASE WHEN task_id IS NOT NULL THEN {_PAST} END, 6) AS task_complexity "
        "FROM (SELECT *, make_timestamp(us)::DATE AS day FROM t1_rows) r",
    ),
)
def task_complexity_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task complexity as a training feature: each booking's median over its task's bookings of earlier days."""
    rows = jobs.with_task_complexity(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)).where(F.col(cleaning.TASK1_TARGET).isNotNull()))
    day = F.date_format("appointment_time", "yyyy-MM-dd")
    return rows.select("booking_id", "task_id", day.alias("day"), r6(F.col("task_complexity")).alias("task_complexity"))


# ---------------------------------------------------------------------------
# Linear models and the ensemble
# ---------------------------------------------------------------------------


@register(
    "ols_fit_predict",
    with_views(
        ["bookings_clean"],
        """SELECT booking_id, round(c.a + c.b * coalesce(x, f.mx), 6) AS linear_prediction
FROM tr, f, (SELECT regr_slope(y, coalesce(x, f.mx)) AS b, regr_intercept(y, coalesce(x, f.mx)) AS a FROM tr, f) c""",
        [
            ("tr", "SELECT booking_id, try_cast(trim(satisfaction_rating) AS DOUBLE) AS x, processing_time_minutes AS y FROM bookings_clean WHERE processing_time_minutes IS NOT NULL"),
            ("f", "SELECT median(x) AS mx FROM tr"),
        ],
    ),
)
def ols_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OLS of minutes on the satisfaction rating (median-filled, standardised); in-sample predictions."""
    rows = jobs.task1_training_rows(fx.bookings_v(spark, sf_dir)).where(F.col(cleaning.TASK1_TARGET).isNotNull())
    model = linear.fit_linear(rows, cleaning.TASK1_TARGET, ["satisfaction_rating"])
    return model.predict(rows).select("booking_id", r6(F.col("linear_prediction")).alias("linear_prediction"))


# OLS on two features, one of them a code of a text column: SQL has a closed form for it. The
# models on all numeric and coded features are the queries *_all_features; tests compare those with numpy.
T1_LINEAR = ("task_id", "appt_hour")
T2_LINEAR = ("section_id", "weekday")


def _codes_sql(train: str, column: str) -> str:
    return f"SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {column} AS v FROM {train} WHERE {column} IS NOT NULL) d"


def _linear_ctes(train: str, test: str, text: str, number: str) -> list[tuple[str, str]]:
    """CTEs ``coef`` and ``lin`` (``row_id``, ``linear``) of OLS on a coded and a numeric column."""
    return [
        ("codes", _codes_sql(train, text)),
        ("fill", f"SELECT median({number}) AS m FROM {train}"),
        ("tr", f"SELECT coalesce(k.code, 999999) AS a, coalesce(t.{number}, fill.m) AS b, t.y FROM {train} t CROSS JOIN fill LEFT JOIN codes k ON k.v = t.{text}"),
        ("mom", "SELECT avg(y) AS my, avg(a) AS ma, avg(b) AS mb, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab FROM tr"),
        ("coef", "SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM mom"),
        (
            "lin",
            f"SELECT t.row_id, c.my + c.wa * (coalesce(k.code, 999999) - c.ma) + c.wb * (coalesce(t.{number}, fill.m) - c.mb) AS linear "
            f"FROM {test} t CROSS JOIN fill CROSS JOIN coef c LEFT JOIN codes k ON k.v = t.{text}",
        ),
    ]


def _clamped_sql(value: str, lo: float, hi: float, default: int) -> str:
    return f"coalesce(CAST(round_even(least(greatest({value}, {lo}), {hi}), 0) AS INTEGER), {default})"


def _blend_sql(body: str, lo: float, hi: float, default: int, name: str) -> str:
    mixed = _clamped_sql("0.7 * p.raw_prediction + 0.3 * l.linear", lo, hi, default)
    return f"SELECT p.row_id, {mixed} AS {name} FROM ({body}) p JOIN lin l ON l.row_id = p.row_id"


@register(
    "ensemble_blend",
    with_views(
        ["t1_train", "t1_test"], _blend_sql(_t1_body, 0.0, 480.0, 30, "true_processing_time_minutes"),
        _t1_ctes + _linear_ctes("t1_train", "t1_test", *T1_LINEAR),
    ),
)
def ensemble_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1: 0.7 x hierarchical median + 0.3 x OLS on task code and hour, clamped to [0, 480] and rounded."""
    rows = jobs.task1_training_table(fx.bookings_v(spark, sf_dir), [])
    model = jobs.fit_task1(rows)
    ols = jobs.fit_task1_linear(rows, T1_LINEAR, S.MIN_ROWS_FOR_LINEAR)
    return fullrun.blend_task1(model, ols, fx.task1_test_v(spark, sf_dir))


@register(
    "ensemble_blend_task2",
    with_views(
        ["t2_train", "t2_test"], _blend_sql(_t2_body, 1.0, 50.0, 3, "true_required_employees"),
        _t2_ctes + _linear_ctes("t2_train", "t2_test", *T2_LINEAR),
    ),
)
def ensemble_blend_task2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2: 0.7 x hierarchical median + 0.3 x OLS on section code and weekday, clamped to [1, 50] and rounded."""
    rows = jobs.task2_training_table(fx.staffing_v(spark, sf_dir))
    model = jobs.fit_task2(rows)
    ols = jobs.fit_task2_linear(rows, T2_LINEAR, S.MIN_ROWS_FOR_LINEAR)
    return fullrun.blend_task2(model, ols, fx.task2_test_v(spark, sf_dir))


@register(
    "linear_model",
    with_views(
        ["t2_train", "t2_test"], f"SELECT row_id, {_clamped_sql('linear', 1.0, 50.0, 3)} AS true_required_employees FROM lin",
        _linear_ctes("t2_train", "t2_test", *T2_LINEAR),
    ),
)
def linear_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear-only Task 2 model on section code and weekday, clamped to [1, 50] and rounded."""
    ols = jobs.fit_task2_linear(jobs.task2_training_table(fx.staffing_v(spark, sf_dir)), T2_LINEAR)
    return fullrun.linear_task2(ols, fx.task2_test_v(spark, sf_dir))


# Least squares on all numeric, boolean and coded features in SQL: one matrix of covariances, Gauss-Jordan steps
# as a recursive CTE (constant columns keep no weight), and a product. Of the two equal calendar blocks of
# Task 1 one is used, and the code of the section's name enters as its difference from the section's
# code: the same space of models, in columns of moderate condition.

_ORDINAL = {"night": 0, "morning": 1, "afternoon": 2, "evening": 3, "very_low": 0, "low": 1, "medium": 2, "high": 3, "very_high": 4}
_BINNED_SQL = "CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _ORDINAL.items()) + " ELSE 999999 END"


def _ols_sql(train: str, test: str, target: str, texts: list[str], numbers: list[str], others: list[str]) -> list[tuple[str, str]]:
    """CTEs ending in ``lin(row_id, linear)``. ``texts`` are coded, ``numbers`` filled with medians, ``others`` are
    expressions over both (the code of text column ``c`` is ``{c}_code``)."""
    rows = f"(SELECT * FROM {train} WHERE {target} IS NOT NULL)"
    codes = [
        (f"ols_{c}", f"SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {c} AS v FROM {rows} r WHERE {c} IS NOT NULL) d")
        for c in texts
    ]
    fills = ", ".join(f"median({c}) AS {c}" for c in numbers)
    coded = ", ".join(f"coalesce(ols_{c}.code, 999999)::DOUBLE AS {c}_code" for c in texts)
    joins = " ".join(f"LEFT JOIN ols_{c} ON ols_{c}.v = r.{c}" for c in texts)
    columns = [*(f"coalesce(r.{c}, f.{c})" for c in numbers), *others]
    design = f"[{', '.join(f'({c})::DOUBLE' for c in columns)}]"
    k = range(1, len(columns) + 1)
    line = lambda i: f"[{', '.join([*(f'covar_pop(x[{i}], x[{j}])' for j in k), f'covar_pop(x[{i}], y)'])}]"
    step = (
        "CASE WHEN m[k + 1][k + 1] <= 1e-9 THEN CASE WHEN i = k + 1 THEN 0.0 ELSE m[i][j] END "
        "WHEN i = k + 1 THEN m[i][j] / m[k + 1][k + 1] ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] END"
    )
    d = len(columns)
    return [
        *codes,
        ("ols_fill", f"SELECT {fills} FROM {rows} r"),
        ("ols_tr", f"SELECT {design} AS x, {target}::DOUBLE AS y FROM (SELECT r.*, {coded} FROM {rows} r {joins}) r CROSS JOIN ols_fill f"),
        ("ols_m", f"SELECT [{', '.join(map(line, k))}] AS m, [{', '.join(f'avg(x[{i}])' for i in k)}] AS mu, avg(y) AS my FROM ols_tr"),
        (
            "ols_gj",
            f"SELECT 0 AS k, m FROM ols_m UNION ALL SELECT k + 1, list_transform(range(1, {d + 1}), lambda i: "
            f"list_transform(range(1, {d + 2}), lambda j: {step})) FROM ols_gj WHERE k < {d}",
        ),
        (
            "lin",
            f"SELECT t.row_id, o.my + list_sum(list_transform(range(1, {d + 1}), lambda i: g.m[i][{d + 1}] * (t.x[i] - o.mu[i]))) AS linear "
            f"FROM (SELECT r.row_id, {design} AS x FROM (SELECT r.*, {coded} FROM {test} r {joins}) r CROSS JOIN ols_fill f) t "
            f"CROSS JOIN ols_m o CROSS JOIN (SELECT m FROM ols_gj WHERE k = {d}) g",
        ),
    ]


_T1_OLS = _ols_sql(
    "t1_feat", f"({catalog_ops._T1_SCORE_SQL})", "processing_time_minutes", ["task_id", "section_id", "task_name", "section_name"],
    ["appt_hour", "appt_weekday", "appt_month", "appt_day", "appt_year", "booking_advance_hours", "queue_number", "document_uploaded", "satisfaction_rating"],
    ["r.task_id_code", "r.section_id_code", "r.task_name_code", "r.section_name_code - r.section_id_code", _BINNED_SQL.format(c="r.appt_time_of_day")],
)
_T2_TEST = (
    f"SELECT row_id, section_id, {date_block_sql('d')}, CAST(NULL AS DOUBLE) AS total_task_time_minutes, false AS has_task_time, "
    "'medium' AS task_time_category FROM (SELECT *, try_strptime(date, '%Y-%m-%d')::DATE AS d FROM task2_test_v) i"
)
_T2_OLS = _ols_sql(
    "t2_feat", f"({_T2_TEST})", "staffing_target", ["section_id"], ["weekday", "month", "day", "year", "quarter", "total_task_time_minutes"],
    ["r.section_id_code", _BINNED_SQL.format(c="r.task_time_category"), *(f"CAST(r.{c} AS INTEGER)" for c in ("is_weekend", "is_month_end", "is_month_start", "has_task_time"))],
)


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register(
    "ensemble_blend_all_features",
    _recursive(
        with_views(
            ["t1_train", "t1_test", "t1_feat", "task1_test_v", "tasks_one"],
            _blend_sql(_t1_body, 0.0, 480.0, 30, "true_processing_time_minutes"), _t1_ctes + _T1_OLS,
        )
    ),
)
def ensemble_blend_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1 ensemble: 0.7 x hierarchical median + 0.3 x OLS on all numeric and coded features, task attributes too."""
    model = fullrun.train_task1_model("ensemble", fx.bookings_v(spark, sf_dir), fx.tasks_v(spark, sf_dir))
    return model.score(fx.task1_test_v(spark, sf_dir))


@register(
    "ensemble_blend_task2_all_features",
    _recursive(
        with_views(
            ["t2_train", "t2_test", "t2_feat", "task2_test_v"], _blend_sql(_t2_body, 1.0, 50.0, 3, "true_required_employees"), _t2_ctes + _T2_OLS
        )
    ),
)
def ensemble_blend_task2_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 ensemble: 0.7 x hierarchical median + 0.3 x OLS on all numeric, boolean and coded features."""
    model = fullrun.train_task2_model("ensemble", fx.staffing_v(spark, sf_dir))
    return model.score(fx.task2_test_v(spark, sf_dir))


@register(
    "linear_model_all_features",
    _recursive(
        with_views(["t2_feat", "task2_test_v"], f"SELECT row_id, {_clamped_sql('linear', 1.0, 50.0, 3)} AS true_required_employees FROM lin", _T2_OLS)
    ),
)
def linear_model_all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear-only Task 2 model on all numeric, boolean and coded features, clamped to [1, 50] and rounded."""
    model = fullrun.train_task2_model("linear", fx.staffing_v(spark, sf_dir))
    return model.score(fx.task2_test_v(spark, sf_dir))


_CHOICES = ("linear", "no such model", "linear, nothing to fit")


@register(
    "model_choice_task2",
    _recursive(
        with_views(
            ["t2_train", "t2_test", "t2_feat", "task2_test_v"],
            f"SELECT '{_CHOICES[0]}' AS choice, 'linear' AS fitted, row_id, {_clamped_sql('linear', 1.0, 50.0, 3)} AS true_required_employees FROM lin "
            f"UNION ALL SELECT '{_CHOICES[1]}', 'baseline_median', row_id, true_required_employees FROM ({_t2_body}) p "
            f"UNION ALL SELECT '{_CHOICES[2]}', 'baseline_median', row_id, {int(S.TASK2_FALLBACK_MEDIAN)} FROM task2_test_v",
            _t2_ctes + _T2_OLS,
        )
    ),
)
def model_choice_task2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model choice and its fallbacks: a named model, an unknown name (baseline medians), and a model that finds no
    row to fit (baseline, which is then the constant); each model is saved, checked and scores all inputs."""
    raw = fx.staffing_v(spark, sf_dir)
    no_target = raw.withColumn("employees_on_duty", F.lit(None).cast("bigint")).withColumn("total_task_time_minutes", F.lit(None).cast("double"))
    inputs = fx.task2_test_v(spark, sf_dir)
    out = None
    for choice in _CHOICES:
        model = fullrun.train_task2_model(choice.split(",")[0], raw if "," not in choice else no_target)
        path = temp_path(spark, "chosen-model")
        model.save(path)
        if not fullrun.validate_saved_model(spark, path, model, T2_LEVELS):
            raise ValueError(f"the saved model {model.name} is not valid")
        scored = model.score(inputs).select(F.lit(choice).alias("choice"), F.lit(model.name).alias("fitted"), "row_id", "true_required_employees")
        out = scored if out is None else out.unionByName(scored)
    return out


# ---------------------------------------------------------------------------
# CSV sources and sinks
# ---------------------------------------------------------------------------


def _write_csv_inputs(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, str]:
    """Write stand-in views as CSV files under the shared checkpoint folder."""
    makers = {
        "bookings": fx.bookings_v, "tasks": fx.tasks_v, "staffing": fx.staffing_v,
        "task1_test": fx.task1_test_v, "task2_test": fx.task2_test_v,
    }
    paths = {}
    for n in names:
        paths[n] = temp_path(spark, f"csv-{n}")
        csvio.write_csv(makers[n](spark, sf_dir), paths[n])
    return paths


@register(
    "csv_roundtrip",
    with_views(["staffing_v"], "SELECT date, section_id, CAST(employees_on_duty AS DOUBLE) AS employees_on_duty, total_task_time_minutes FROM staffing_v"),
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staffing rows written as CSV and read back with the tolerant all-text scan."""
    paths = _write_csv_inputs(spark, sf_dir, ["staffing"])
    back = csvio.read_csv_tolerant(spark, paths["staffing"])
    return back.select(
        "date", "section_id", scalar.to_double(F.col("employees_on_duty")).alias("employees_on_duty"),
        scalar.to_double(F.col("total_task_time_minutes")).alias("total_task_time_minutes"),
    )


@register(
    "csv_scan_tolerant",
    with_views(
        ["bookings_v"],
        "SELECT CAST(booking_id AS VARCHAR) AS booking_id, task_id, "
        + ", ".join(f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS {c}" for c in ("booking_created_time", "appointment_time", "check_in_time", "check_out_time"))
        + ", CASE WHEN queue_number <> 'n/a' THEN queue_number END AS queue_number, satisfaction_rating, document_uploaded FROM bookings_v",
    ),
)
def csv_scan_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings written as CSV and read back by the tolerant all-text scan; its
    malformed-row rule (drop rows with extra fields, pad short ones) is applied to
    every row, and the malformed cases themselves are covered in tests/test_csv.py."""
    paths = _write_csv_inputs(spark, sf_dir, ["bookings"])
    return csvio.read_csv_tolerant(spark, paths["bookings"])


@register(
    "csv_latin1_fallback",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, 'Café ' || c_name AS name, "
    "CASE WHEN c_custkey % 7 = 0 THEN 'Ã©' WHEN c_custkey % 5 = 0 THEN 'two' || chr(10) || 'lines, \"quoted\"' ELSE 'ü' END AS note FROM customer",
)
def csv_latin1_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV with line breaks in quotes, half of the files UTF-8 and half ISO-8859-1, read as one folder: the
    encoding is told for a whole file, also where a field's latin-1 bytes happen to be valid UTF-8."""
    k = F.col("c_custkey")
    note = F.when(k % 7 == 0, "Ã©").when(k % 5 == 0, 'two\nlines, "quoted"').otherwise("ü")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select(k.alias("id"), F.concat(F.lit("Café "), "c_name").alias("name"), note.alias("note"))
    out = temp_path(spark, "csv-encodings")
    csvio.write_csv(rows.where("id % 2 = 0"), f"{out}/utf8")
    csvio.write_csv(rows.where("id % 2 = 1"), f"{out}/latin1", encoding="ISO-8859-1")
    return csvio.read_csv_tolerant(spark, f"{out}/*")


@register(
    "load_training_tables",
    with_views(
        ["bookings_csv", "tasks_v"],
        "SELECT CAST(b.booking_id AS VARCHAR) AS booking_id, b.task_id, t.section_id, t.task_name, "
        "round(CASE WHEN m BETWEEN 0 AND 480 THEN m END, 6) AS processing_time_minutes "
        "FROM (SELECT *, (epoch_us(check_out_time) - epoch_us(check_in_time)) / 60000000.0 AS m FROM bookings_csv) b "
        "LEFT JOIN tasks_v t ON t.task_id = b.task_id",
    ),
)
def load_training_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three training CSVs read, cleaned and joined (bookings with their task attributes)."""
    paths = _write_csv_inputs(spark, sf_dir, ["bookings", "tasks", "staffing"])
    merged, _, _ = csvio.load_training_tables(spark, paths["bookings"], paths["tasks"], paths["staffing"])
    return merged.select("booking_id", "task_id", "section_id", "task_name", r6(F.col(cleaning.TASK1_TARGET)).alias("processing_time_minutes"))


@register(
    "full_run",
    with_views(
        ["t1_train", "t1_test", "t2_train", "t2_test"],
        f"SELECT 1 AS task, row_id, true_processing_time_minutes AS prediction FROM ({_t1_body}) p UNION ALL "
        f"SELECT 2 AS task, row_id, true_required_employees AS prediction FROM ({_t2_body.replace(' m', ' w').replace('(m', '(w')}) p",
        _t1_ctes + [(n.replace("m", "w", 1), q) for n, q in _t2_ctes],
    ),
)
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full run from CSV files: both tasks trained, models and their summaries saved and checked,
    inputs scored, outputs written, checked, and read back."""
    paths = _write_csv_inputs(spark, sf_dir, ["bookings", "tasks", "staffing", "task1_test", "task2_test"])
    out = temp_path(spark, "full-run")
    names = ("bookings", "tasks", "staffing", "task1_test", "task2_test")
    run = fullrun.full_run(spark, *(paths[n] for n in names), out)
    reports_ok = [r.first()["valid"] for r in (run.task1, run.task2, run.submission1, run.submission2)]
    if not all([*reports_ok, run.model1_ok, run.model2_ok]):
        raise ValueError("the full run's outputs or models are not valid")
    parts = [
        csvio.read_csv_tolerant(spark, f"{out}/task{i}_predictions").select(
            F.lit(i).alias("task"), F.col("row_id").cast("long").alias("row_id"), F.col(c).cast("int").alias("prediction")
        )
        for i, c in ((1, "true_processing_time_minutes"), (2, "true_required_employees"))
    ]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# Level presets: the notebook variant of both tasks (range filter + dropna +
# its own level lists), scored end to end.
# ---------------------------------------------------------------------------

T1_NOTEBOOK = S.TASK1_LEVELS["notebook"]
T2_NOTEBOOK = S.TASK2_LEVELS["notebook"]

VIEWS.update(
    {
        "t1nb_train": """
  SELECT f.task_id, f.appt_hour, f.appt_weekday, f.section_id, f.processing_time_minutes AS y
  FROM t1_feat f
  WHERE f.processing_time_minutes BETWEEN 1 AND 480
    AND f.task_id IS NOT NULL AND f.appt_hour IS NOT NULL AND f.appt_weekday IS NOT NULL AND f.section_id IS NOT NULL""",
        "t1nb_test": """
  SELECT row_id, task_id, CAST(hour(try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M')) AS INTEGER) AS appt_hour,
         CAST(isodow(try_strptime(date, '%Y-%m-%d')) - 1 AS INTEGER) AS appt_weekday
  FROM task1_test_v""",
        "t2nb_train": """
  SELECT section_id, isodow(date) - 1 AS weekday, coalesce(isodow(date) - 1 >= 5, false) AS is_weekend, employees_on_duty AS y
  FROM staffing_typed
  WHERE employees_on_duty BETWEEN 1 AND 50 AND section_id IS NOT NULL AND date IS NOT NULL""",
    }
)
_DEPS.update({"t1nb_train": ["t1_feat"], "t1nb_test": ["task1_test_v"], "t2nb_train": ["staffing_typed"]})

_t1nb_ctes, _t1nb_body = hier_lookup_sql("t1nb_train", "t1nb_test", T1_NOTEBOOK, "true_processing_time_minutes", 0.0, 480.0, 30)
_t2nb_ctes, _t2nb_body = hier_lookup_sql("t2nb_train", "t2_test", T2_NOTEBOOK, "true_required_employees", 1.0, 50.0, 3)


@register(
    "score_task1_notebook",
    with_views(["t1nb_train", "t1nb_test"], f"SELECT row_id, true_processing_time_minutes, level FROM ({_t1nb_body}) p", _t1nb_ctes),
)
def score_task1_notebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notebook variant of Task 1: durations kept only in [1, 480], rows with a NULL
    feature dropped, its 6-level preset; the input weekday comes from the date alone."""
    tasks = fx.tasks_v(spark, sf_dir)
    rows = features.task1_features(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)), tasks)
    rows = cleaning.range_filter(rows, cleaning.TASK1_TARGET, 1.0, 480.0)
    rows = cleaning.dropna_subset(rows, [cleaning.TASK1_TARGET, "task_id", "appt_hour", "appt_weekday", "section_id"])
    model = jobs.fit_task1(rows, "notebook")
    inputs = fx.task1_test_v(spark, sf_dir)
    inputs = inputs.withColumn("date_weekday", F.weekday(timefns.parse_date(F.col("date"))))
    feats = features.task1_score_features(inputs, keep=("date_weekday",))
    feats = feats.drop("appt_weekday").withColumnRenamed("date_weekday", "appt_weekday")
    pred = jobs.predict_task1_rows(model, feats)
    return pred.select("row_id", "true_processing_time_minutes", "level")


@register(
    "score_task2_notebook",
    with_views(["t2nb_train", "t2_test"], f"SELECT row_id, true_required_employees, level FROM ({_t2nb_body}) p", _t2nb_ctes),
)
def score_task2_notebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notebook variant of Task 2: staffing rows kept only with 1..50 employees (no
    fill), rows with a NULL feature dropped, its 4-level preset."""
    typed = cleaning.clean_staffing(fx.staffing_v(spark, sf_dir), fill_missing=False)
    typed = cleaning.range_filter(typed, "employees_on_duty", 1.0, 50.0)
    rows = features.task2_features(cleaning.staffing_target(typed), keep=(jobs.TASK2_TARGET,))
    rows = cleaning.dropna_subset(rows, [jobs.TASK2_TARGET, "section_id", "weekday", "month", "is_weekend"])
    from tallyline.operators.hierarchy import HierarchicalMedian

    model = HierarchicalMedian(T2_NOTEBOOK, jobs.TASK2_TARGET).fit(rows)
    pred = jobs.predict_task2_rows(model, features.task2_score_features(fx.task2_test_v(spark, sf_dir)))
    return pred.select("row_id", "true_required_employees", "level")


# ---------------------------------------------------------------------------
# Streaming: the Task 1 inputs scored by a Structured Streaming job
# ---------------------------------------------------------------------------


@register(
    "stream_score_task1",
    with_views(["t1_train", "t1_test"], f"SELECT row_id, true_processing_time_minutes FROM ({_t1_body}) p", _t1_ctes),
)
def stream_score_task1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1 inputs landed as Parquet files and scored by a streaming query
    (file source, stream-static joins with the model, Parquet sink with a checkpoint)."""
    from tallyline.streaming import scoring as streaming

    model = _t1_model(spark, sf_dir)
    landing = temp_path(spark, "stream-landing")
    inputs = fx.task1_test_v(spark, sf_dir)
    inputs.select(*[F.col(c).cast("string").alias(c) for c in inputs.columns]).write.mode("overwrite").parquet(landing)
    out = temp_path(spark, "stream-out")
    q = streaming.score_task1_stream(spark, model, landing, out, temp_path(spark, "stream-ckpt"), fmt="parquet", available_now=True)
    q.awaitTermination()  # availableNow ends by itself, however long the input takes
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    scored = spark.read.parquet(out)
    return scored.select(F.col("row_id").cast("long").alias("row_id"), "true_processing_time_minutes")
