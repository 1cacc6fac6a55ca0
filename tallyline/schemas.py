"""Schemas and fixed values.

Everything below the "fixed values" marker must equal the behaviour being
matched (level lists, token maps, bins, defaults, bounds); it is plain
configuration, not logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source schemas: every CSV column is scanned as text and typed by try_* casts.
# ---------------------------------------------------------------------------

BOOKINGS_COLUMNS = [
    "booking_id",
    "task_id",
    "booking_created_time",
    "appointment_date",
    "appointment_time",
    "check_in_time",
    "check_out_time",
    "queue_number",
    "satisfaction_rating",
    "document_uploaded",
    "num_documents",
]
TASKS_COLUMNS = ["task_id", "section_id", "task_name", "section_name"]
STAFFING_COLUMNS = ["date", "section_id", "employees_on_duty", "total_task_time_minutes"]
TASK1_TEST_COLUMNS = ["row_id", "date", "time", "task_id"]
TASK2_TEST_COLUMNS = ["row_id", "date", "section_id"]

TASK1_OUTPUT_COLUMNS = ["row_id", "true_processing_time_minutes"]
TASK2_OUTPUT_COLUMNS = ["row_id", "true_required_employees"]


def string_schema(columns: list[str]) -> T.StructType:
    """All-text schema used for tolerant CSV scans."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------

# Hierarchical median fallback levels, most specific first (presets "code",
# "document", "notebook"). The global median is the implicit last level.
TASK1_LEVELS = {
    "code": [
        ["task_id", "appt_hour", "appt_weekday"],
        ["task_id", "appt_hour"],
        ["task_id", "appt_weekday"],
        ["task_id"],
        ["appt_hour", "appt_weekday"],
        ["appt_hour"],
        ["appt_weekday"],
    ],
    "document": [
        ["task_id", "appt_hour", "appt_weekday"],
        ["task_id", "appt_hour"],
        ["task_id", "appt_weekday"],
        ["task_id"],
        ["appt_hour", "appt_weekday"],
        ["appt_hour"],
    ],
    "notebook": [
        ["task_id", "appt_hour", "appt_weekday"],
        ["task_id", "appt_hour"],
        ["task_id", "appt_weekday"],
        ["task_id"],
        ["appt_hour", "appt_weekday"],
        ["appt_hour"],
    ],
}
TASK2_LEVELS = {
    "code": [
        ["section_id", "weekday"],
        ["section_id"],
        ["weekday"],
        ["is_weekend"],
    ],
    "document": [
        ["section_id", "weekday"],
        ["section_id"],
        ["weekday"],
    ],
    "notebook": [
        ["section_id", "weekday"],
        ["section_id", "is_weekend"],
        ["section_id"],
        ["weekday"],
    ],
}

# Boolean text map (case-sensitive); every other value becomes NULL. Numbers
# 1 / 0 also map, so their text forms "1.0" / "0.0" are listed after it.
BOOLEAN_MAP = {
    "1": True,
    "0": False,
    "true": True,
    "false": False,
    "True": True,
    "False": False,
    "yes": True,
    "no": False,
    "Yes": True,
    "No": False,
    "Y": True,
    "N": False,
}
BOOLEAN_NUMERIC_TEXT = {"1.0": True, "0.0": False}

# Date formats tried in order (month-first wins when ambiguous).
DATE_FORMATS = ["yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "yyyy/M/d"]
# Timestamp formats tried after the ISO cast.
TIMESTAMP_FORMATS = [
    "yyyy-M-d H:m",
    "yyyy-M-d H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy H:m:s",
    "d/M/yyyy H:m",
    "yyyy/M/d H:m",
    "yyyy/M/d H:m:s",
]
# Names of free-format timestamps (English), also by their first three letters.
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
]
WEEKDAY_NAMES = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
# Years of two digits are the hundred years from here on, whatever the day of the run.
TWO_DIGIT_YEARS_FROM = 1976

# time_of_day bins, right-closed with 0 included: upper bound -> label.
TIME_OF_DAY_BINS = [(6, "night"), (12, "morning"), (18, "afternoon"), (24, "evening")]
BUSINESS_HOURS = (9, 17)  # [start, end) on Monday..Friday
WEEKEND_START = 5  # Saturday, with Monday = 0

# task_time_category bins, right-closed with 0 included; fixed ordinal codes.
TASK_TIME_BINS = [(120.0, "very_low"), (240.0, "low"), (480.0, "medium"), (960.0, "high"), (float("inf"), "very_high")]
TASK_TIME_ORDINAL = {"very_low": 0, "low": 1, "medium": 2, "high": 3, "very_high": 4}

MISSING_CODE = 999999  # category code for null / unseen values

# Bounds of the published outputs.
TASK1_BOUNDS = (0.0, 480.0)
TASK2_BOUNDS = (1.0, 50.0)
MAX_SERVICE_MINUTES = 480.0
MINUTES_PER_EMPLOYEE_DAY = 480.0

# Defaults used when a model or a row cannot be scored.
TASK1_DEFAULT_PREDICTION = 30
TASK2_DEFAULT_PREDICTION = 3
TASK1_FALLBACK_MEDIAN = 30.0
TASK2_FALLBACK_MEDIAN = 3.0
TASK2_FALLBACK_STD = 2.0

# Lookup defaults for the point-lookup demo.
LOOKUP_DEFAULTS = {"section_id": "SEC-001", "task_name": "Unknown Task", "section_name": "Unknown Section"}

# Feature defaults, keyed by exact column name, for columns absent at scoring.
TASK1_FEATURE_DEFAULTS = {
    "appt_hour": 12,
    "appt_weekday": 1,
    "appt_month": 6,
    "checkin_hour": 12,
    "checkin_weekday": 1,
    "checkin_month": 6,
    "queue_number": None,
    "has_queue_number": False,
    "document_uploaded": 0,
    "booking_advance_hours": None,
    "satisfaction_rating": None,
    "has_satisfaction_rating": False,
}
TASK2_FEATURE_DEFAULTS = {
    "quarter": 2,
    "total_task_time_minutes": None,
    "has_task_time": False,
    "task_time_category": "medium",
    "historical_employees": None,
}

# Ensemble weights of the median model and the linear model (literals, not 1 - w).
ENSEMBLE_MEDIAN_WEIGHT = 0.7
ENSEMBLE_LINEAR_WEIGHT = 0.3
# Staffing pattern blend weights of the section value and the weekday median.
PATTERN_SECTION_WEIGHT = 0.7
PATTERN_WEEKDAY_WEIGHT = 0.3
PATTERN_MIN_COUNT_FOR_MEDIAN = 3
MIN_ROWS_FOR_LINEAR = 10
