"""Catalog part 2: scalar parsing, cleaning, joins and feature blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import scalar, timefns
from tallyline.operators import cleaning, features, joins
from tallyline.plans.catalog import r6, register
from tallyline.plans.oracle import BOOL_MAP_SQL, calendar_sql, date_block_sql, with_views
from tallyline.sources import fixtures as fx

# ---------------------------------------------------------------------------
# Text stand-ins for the parsers: values of a test table rendered as text in
# several layouts (formatting only; the parsers do the work).
# ---------------------------------------------------------------------------


def timestamp_text_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    k = F.col("event_id") % 4
    text = (
        F.when(k == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k == 2, F.date_format(ts, "M/d/yyyy H:mm"))
        .otherwise(F.date_format(ts, "HH:mm"))
    )
    return e.select("event_id", text.alias("text"))


_TS_TEXT_SQL = """
  SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                           WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                           WHEN 2 THEN strftime(ts, '%-m/%-d/%Y %-H:%M')
                           ELSE strftime(ts, '%H:%M') END AS text
  FROM events"""


def date_text_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    k = F.col("o_orderkey") % 5
    text = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(d, "M/d/yyyy"))
        .when(k == 2, F.date_format(d, "d/M/yyyy"))
        .when(k == 3, F.date_format(d, "yyyy/M/d"))
        .otherwise(F.lit("x"))
    )
    return o.select(F.col("o_orderkey").alias("row_id"), text.alias("text"))


_DATE_TEXT_SQL = """
  SELECT o_orderkey AS row_id,
         CASE o_orderkey % 5 WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
                             WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%-m/%-d/%Y')
                             WHEN 2 THEN strftime(CAST(o_orderdate AS DATE), '%-d/%-m/%Y')
                             WHEN 3 THEN strftime(CAST(o_orderdate AS DATE), '%Y/%-m/%-d')
                             ELSE 'x' END AS text
  FROM orders"""


def time_text_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = fx.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    h, m = (key % 24).cast("string"), (key % 60).cast("string")
    hh, mm = F.lpad(h, 2, "0"), F.lpad(m, 2, "0")
    k = key % 8
    text = (
        F.when(k == 0, F.concat(h, F.lit(":"), mm))
        .when(k == 1, F.concat(hh, mm))
        .when(k == 2, F.concat(F.lit("24:"), mm))
        .when(k == 3, F.concat(F.lit(" "), hh, F.lit(":"), mm, F.lit(" ")))
        .when(k == 4, F.concat(hh, F.lit(":"), mm, F.lit(":00")))
        .when(k == 5, F.lit("bad"))
        .when(k == 6, F.lit(""))
        .otherwise(F.concat(h, F.lit(":"), (key % 60 + 60).cast("string")))
    )
    return o.select(key.alias("row_id"), text.alias("text"))


_TIME_TEXT_SQL = """
  SELECT o_orderkey AS row_id,
         CASE o_orderkey % 8
           WHEN 0 THEN CAST(o_orderkey % 24 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')
           WHEN 1 THEN lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')
           WHEN 2 THEN '24:' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')
           WHEN 3 THEN ' ' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ' '
           WHEN 4 THEN lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':00'
           WHEN 5 THEN 'bad'
           WHEN 6 THEN ''
           ELSE CAST(o_orderkey % 24 AS VARCHAR) || ':' || CAST(o_orderkey % 60 + 60 AS VARCHAR) END AS text
  FROM orders"""


@register(
    "parse_timestamps",
    with_views(
        [],
        """SELECT event_id, text,
       epoch_us(coalesce(CASE WHEN regexp_matches(trim(text), '\\d{1,4}[-/]\\d{1,2}[-/]\\d{1,4}') THEN try_cast(trim(text) AS TIMESTAMP) END,
                         try_strptime(trim(text), '%m/%d/%Y %H:%M'))) AS parsed_us
FROM ts_text""",
        [("ts_text", _TS_TEXT_SQL)],
    ),
)
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp text in several layouts parsed row by row; a bare time of day is NULL."""
    t = timestamp_text_v(spark, sf_dir)
    return t.select("event_id", "text", F.unix_micros(timefns.parse_timestamp(F.col("text"))).alias("parsed_us"))


# (Spark pattern, DuckDB pattern to write and read) of ten further styles; event_id % 12 picks one, the rest is no date
_FREE_STYLES = [
    ("d MMM yyyy h:mm a", "%-d %b %Y %-I:%M %p"),
    ("MMMM d, yyyy 'at' HH:mm:ss", "%B %-d, %Y at %H:%M:%S"),
    ("EEE, dd MMM yyyy HH:mm:ss '+0230'", "%a, %d %b %Y %H:%M:%S +0230"),
    ("dd-MMM-yy HH:mm", "%d-%b-%y %H:%M"),
    ("M.d.yyyy H:mm", "%-m.%-d.%Y %-H:%M"),
    ("d'th of' MMMM yyyy", "%-dth of %B %Y"),
    ("yyyyMMdd'T'HHmmss", "%Y%m%dT%H%M%S"),
    ("h:mm:ss a 'UTC' M/d/yy", "%-I:%M:%S %p UTC %-m/%-d/%y"),
    ("yyyy MMM d HH:mm:ss.SSSSSS", "%Y %b %-d %H:%M:%S.%f"),
    ("EEEE d MMMM yyyy HH:mm 'gmt-2'", "%A %-d %B %Y %H:%M gmt-2"),
]
_FREE_SHIFT = {2: -150, 9: -120}  # minutes from the written clock to UTC
_FREE_SQL = "\n".join(f"WHEN {i} THEN strftime(ts, '{f}')" for i, (_, f) in enumerate(_FREE_STYLES))
_FREE_READ_SQL = "\n".join(
    f"WHEN {i} THEN epoch_us(try_strptime(text, '{f}')) + {_FREE_SHIFT.get(i, 0) * 60_000_000}" for i, (_, f) in enumerate(_FREE_STYLES)
)


def free_text_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    k, ts = F.col("event_id") % (len(_FREE_STYLES) + 2), F.col("ts").cast("timestamp")
    text = F.when(k == len(_FREE_STYLES), F.date_format(ts, "MMM yyyy HH:mm"))
    for i, (pattern, _) in enumerate(_FREE_STYLES):
        text = text.when(k == i, F.date_format(ts, pattern))
    return e.select("event_id", text.alias("text"))


@register(
    "parse_timestamps_free",
    with_views(
        [],
        f"SELECT event_id, text, CASE event_id % {len(_FREE_STYLES) + 2} {_FREE_READ_SQL} END AS parsed_us FROM free_text",
        [("free_text", f"SELECT event_id, CASE event_id % {len(_FREE_STYLES) + 2} {_FREE_SQL} WHEN {len(_FREE_STYLES)} THEN strftime(ts, '%b %Y %H:%M') END AS text FROM events")],
    ),
)
def parse_timestamps_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-format timestamps: month names, AM/PM, dots, two-digit years, offsets; NULL where the date is not whole."""
    t = free_text_v(spark, sf_dir)
    return t.select("event_id", "text", F.unix_micros(timefns.parse_timestamp(F.col("text"))).alias("parsed_us"))


@register(
    "parse_dates_multi",
    with_views(
        [],
        """SELECT row_id, text,
       strftime(coalesce(try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%m/%d/%Y'),
                         try_strptime(text, '%d/%m/%Y'), try_strptime(text, '%Y/%m/%d'))::DATE, '%Y-%m-%d') AS parsed
FROM date_text""",
        [("date_text", _DATE_TEXT_SQL)],
    ),
)
def parse_dates_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates by the ordered format list; month-first wins when ambiguous."""
    t = date_text_v(spark, sf_dir)
    return t.select("row_id", "text", F.date_format(timefns.parse_date(F.col("text")), "yyyy-MM-dd").alias("parsed"))


@register(
    "parse_times",
    with_views(
        [],
        """SELECT row_id, text, CASE WHEN ok THEN h END AS hour, CASE WHEN ok THEN m END AS minute
FROM (SELECT row_id, text, h, m, coalesce(h BETWEEN 0 AND 23 AND m BETWEEN 0 AND 59, false) AS ok
      FROM (SELECT row_id, text,
                   CASE WHEN regexp_full_match(trim(text), '[+-]?\\d+:[+-]?\\d+') THEN try_cast(split_part(trim(text), ':', 1) AS INTEGER)
                        WHEN regexp_full_match(trim(text), '\\d{4}') THEN try_cast(substr(trim(text), 1, 2) AS INTEGER) END AS h,
                   CASE WHEN regexp_full_match(trim(text), '[+-]?\\d+:[+-]?\\d+') THEN try_cast(split_part(trim(text), ':', 2) AS INTEGER)
                        WHEN regexp_full_match(trim(text), '\\d{4}') THEN try_cast(substr(trim(text), 3, 2) AS INTEGER) END AS m
            FROM time_text) a) b""",
        [("time_text", _TIME_TEXT_SQL)],
    ),
)
def parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``H:M`` or ``HHMM`` time of day, trimmed and range-checked."""
    t = time_text_v(spark, sf_dir).withColumn("_t", timefns.parse_time(F.col("text")))
    return t.select("row_id", "text", F.col("_t.hour").alias("hour"), F.col("_t.minute").alias("minute"))


# ---------------------------------------------------------------------------
# Bookings cleaning
# ---------------------------------------------------------------------------


@register(
    "clean_bookings",
    with_views(
        ["bookings_clean"],
        f"""SELECT booking_id, task_id,
       try_cast(trim(queue_number) AS DOUBLE) AS queue_number,
       try_cast(trim(satisfaction_rating) AS DOUBLE) AS satisfaction_rating,
       {BOOL_MAP_SQL.format(c='document_uploaded')} AS document_uploaded,
       epoch_us(check_in_time) AS check_in_us, epoch_us(check_out_time) AS check_out_us,
       round(processing_time_minutes, 6) AS processing_time_minutes
FROM bookings_clean""",
    ),
)
def clean_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed bookings with the Task 1 target (all rows kept)."""
    c = cleaning.clean_bookings(fx.bookings_v(spark, sf_dir))
    return c.select(
        "booking_id",
        "task_id",
        "queue_number",
        "satisfaction_rating",
        "document_uploaded",
        F.unix_micros("check_in_time").alias("check_in_us"),
        F.unix_micros("check_out_time").alias("check_out_us"),
        r6(F.col("processing_time_minutes")).alias("processing_time_minutes"),
    )


@register("duration_minutes", with_views(["bookings_clean"], "SELECT booking_id, round(raw_minutes, 6) AS duration_minutes FROM bookings_clean"))
def duration_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed minutes from check-in to check-out."""
    d = cleaning.raw_duration(fx.bookings_v(spark, sf_dir))
    return d.select("booking_id", r6(F.col("duration_minutes")).alias("duration_minutes"))


@register(
    "duration_clean",
    with_views(
        ["bookings_clean"],
        "SELECT booking_id, round(raw_minutes, 6) AS duration_minutes, round(CASE WHEN raw_minutes BETWEEN 0 AND 480 THEN raw_minutes END, 6) AS clean_minutes FROM bookings_clean",
    ),
)
def duration_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations outside [0, 480] minutes become NULL; every row is kept."""
    d = cleaning.raw_duration(fx.bookings_v(spark, sf_dir))
    m = F.col("duration_minutes")
    return d.select("booking_id", r6(m).alias("duration_minutes"), r6(scalar.null_outside(m, 0.0, 480.0)).alias("clean_minutes"))


@register(
    "duration_quality",
    with_views(
        ["bookings_clean"],
        """SELECT count(*) AS rows, count(raw_minutes) AS valid, CAST(count_if(raw_minutes < 0) AS BIGINT) AS negative,
       CAST(count_if(raw_minutes > 480) AS BIGINT) AS too_long,
       CAST(count_if(raw_minutes IS NOT NULL AND NOT (raw_minutes BETWEEN 0 AND 480)) AS BIGINT) AS removed,
       CAST(count_if(raw_minutes BETWEEN 0 AND 480) AS BIGINT) AS kept,
       round(min(raw_minutes), 6) AS min_minutes, round(max(raw_minutes), 6) AS max_minutes,
       round(avg(raw_minutes), 6) AS mean_minutes, round(median(raw_minutes), 6) AS median_minutes
FROM bookings_clean""",
    ),
)
def duration_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality counters of durations and of the [0, 480] cleaning."""
    q = cleaning.duration_quality(fx.bookings_v(spark, sf_dir))
    return q.select(
        "rows", "valid", "negative", "too_long", "removed", "kept",
        *[r6(F.col(c)).alias(c) for c in ("min_minutes", "max_minutes", "mean_minutes", "median_minutes")],
    )


@register(
    "numeric_coerce",
    with_views(
        ["bookings_v"],
        "SELECT booking_id, queue_number AS queue_text, try_cast(trim(queue_number) AS DOUBLE) AS queue_number, "
        "try_cast(trim(satisfaction_rating) AS DOUBLE) AS satisfaction_rating FROM bookings_v",
    ),
)
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient numeric casts: text that is not a number becomes NULL."""
    b = fx.bookings_v(spark, sf_dir)
    return b.select(
        "booking_id",
        F.col("queue_number").alias("queue_text"),
        scalar.to_double(F.col("queue_number")).alias("queue_number"),
        scalar.to_double(F.col("satisfaction_rating")).alias("satisfaction_rating"),
    )


@register(
    "boolean_map",
    with_views(
        ["bookings_v"],
        f"SELECT booking_id, document_uploaded AS raw, {BOOL_MAP_SQL.format(c='document_uploaded')} AS document_uploaded FROM bookings_v",
    ),
)
def boolean_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case-sensitive boolean map; unknown text becomes NULL."""
    b = fx.bookings_v(spark, sf_dir)
    return b.select("booking_id", F.col("document_uploaded").alias("raw"), scalar.to_boolean(F.col("document_uploaded")).alias("document_uploaded"))


@register(
    "valid_target_rows",
    with_views(
        ["bookings_clean"],
        "SELECT booking_id, task_id, round(processing_time_minutes, 6) AS processing_time_minutes FROM bookings_clean WHERE processing_time_minutes IS NOT NULL",
    ),
)
def valid_target_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a Task 1 target."""
    c = cleaning.valid_target_rows(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)), cleaning.TASK1_TARGET)
    return c.select("booking_id", "task_id", r6(F.col(cleaning.TASK1_TARGET)).alias("processing_time_minutes"))


@register(
    "dropna_subset",
    with_views(
        ["t1_feat"],
        "SELECT booking_id, task_id, section_id, appt_hour, appt_weekday, round(processing_time_minutes, 6) AS processing_time_minutes "
        "FROM t1_feat WHERE task_id IS NOT NULL AND section_id IS NOT NULL AND appt_hour IS NOT NULL AND appt_weekday IS NOT NULL AND processing_time_minutes IS NOT NULL",
    ),
)
def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with no NULL in the target or any model feature (tasks joined for the section)."""
    rows = features.task1_features(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)), fx.tasks_v(spark, sf_dir))
    cols = ["task_id", "section_id", "appt_hour", "appt_weekday", cleaning.TASK1_TARGET]
    kept = cleaning.dropna_subset(rows, cols)
    return kept.select("booking_id", "task_id", "section_id", "appt_hour", "appt_weekday", r6(F.col(cleaning.TASK1_TARGET)).alias("processing_time_minutes"))


@register(
    "range_filter",
    with_views(["bookings_clean"], "SELECT booking_id, round(raw_minutes, 6) AS duration_minutes FROM bookings_clean WHERE raw_minutes BETWEEN 1 AND 480"),
)
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a duration in [1, 480] minutes (others dropped)."""
    d = cleaning.range_filter(cleaning.raw_duration(fx.bookings_v(spark, sf_dir)), "duration_minutes", 1.0, 480.0)
    return d.select("booking_id", r6(F.col("duration_minutes")).alias("duration_minutes"))


def _basic_ts_sql(c: str) -> str:
    return f"CAST(hour({c}) AS INTEGER) AS {c}_hour, CAST(isodow({c}) - 1 AS INTEGER) AS {c}_weekday, CAST(month({c}) AS INTEGER) AS {c}_month"


@register(
    "basic_features",
    with_views(
        ["bookings_clean"],
        f"""SELECT booking_id, task_id, {_basic_ts_sql('booking_created_time')}, {_basic_ts_sql('appointment_time')},
       {_basic_ts_sql('check_in_time')}, {_basic_ts_sql('check_out_time')},
       try_cast(trim(queue_number) AS DOUBLE) AS queue_number, try_cast(trim(satisfaction_rating) AS DOUBLE) AS satisfaction_rating,
       {BOOL_MAP_SQL.format(c='document_uploaded')} AS document_uploaded, round(processing_time_minutes, 6) AS processing_time_minutes
FROM bookings_clean""",
    ),
)
def basic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-driven projection: timestamps become hour/weekday/month, the rest passes."""
    b = cleaning.basic_features(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)))
    return b.withColumn(cleaning.TASK1_TARGET, r6(F.col(cleaning.TASK1_TARGET)))


# ---------------------------------------------------------------------------
# Staffing cleaning and targets
# ---------------------------------------------------------------------------


@register(
    "clean_staffing",
    with_views(
        ["staffing_clean"],
        "SELECT strftime(date, '%Y-%m-%d') AS date, section_id, employees_on_duty, total_task_time_minutes FROM staffing_clean",
    ),
)
def clean_staffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staffing rows with missing employees filled from task minutes."""
    c = cleaning.clean_staffing(fx.staffing_v(spark, sf_dir))
    return c.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "section_id", "employees_on_duty", "total_task_time_minutes")


@register("minutes_per_employee", with_views(["mpe"], "SELECT round(minutes_per_employee, 6) AS minutes_per_employee, pairs FROM mpe"))
def minutes_per_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median minutes per employee over rows with both values (x/0 = inf kept)."""
    typed = cleaning.clean_staffing(fx.staffing_v(spark, sf_dir), fill_missing=False)
    m = cleaning.minutes_per_employee(typed)
    return m.select(r6(F.col("minutes_per_employee")).alias("minutes_per_employee"), "pairs")


@register(
    "fill_missing_employees",
    with_views(
        ["staffing_clean"],
        """SELECT strftime(c.date, '%Y-%m-%d') AS date, c.section_id, t.employees_on_duty AS employees_before,
       c.employees_on_duty AS employees_after, (t.employees_on_duty IS NULL AND c.employees_on_duty IS NOT NULL) AS filled
FROM staffing_clean c JOIN staffing_typed t ON c.date = t.date AND c.section_id = t.section_id""",
    ),
)
def fill_missing_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees before and after the fill from task minutes."""
    s = fx.staffing_v(spark, sf_dir)
    c = cleaning.clean_staffing(s.withColumn("employees_before", F.col("employees_on_duty").cast("double")))
    return c.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "section_id",
        "employees_before",
        F.col("employees_on_duty").alias("employees_after"),
        (F.col("employees_before").isNull() & F.col("employees_on_duty").isNotNull()).alias("filled"),
    )


@register(
    "staffing_target",
    with_views(
        ["staffing_clean"],
        "SELECT strftime(date, '%Y-%m-%d') AS date, section_id, CASE WHEN isfinite(employees_on_duty) AND employees_on_duty >= 0 THEN employees_on_duty END AS staffing_target FROM staffing_clean",
    ),
)
def staffing_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 target from employees: ±inf and negatives become NULL."""
    t = cleaning.staffing_target(cleaning.clean_staffing(fx.staffing_v(spark, sf_dir)))
    return t.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "section_id", "staffing_target")


@register(
    "staffing_target_derived",
    with_views(
        ["staffing_typed"],
        "SELECT strftime(date, '%Y-%m-%d') AS date, section_id, CASE WHEN total_task_time_minutes IS NOT NULL THEN greatest(round_even(total_task_time_minutes / 480.0, 0), 1.0) END AS staffing_target FROM staffing_typed",
    ),
)
def staffing_target_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 target without an employees column: round-half-even(minutes / 480), floor 1."""
    s = fx.staffing_v(spark, sf_dir).drop("employees_on_duty")
    t = cleaning.staffing_target(cleaning.clean_staffing(s))
    return t.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "section_id", "staffing_target")


# ---------------------------------------------------------------------------
# Joins with the task dimension
# ---------------------------------------------------------------------------


@register(
    "merge_tasks",
    with_views(
        ["bookings_v", "tasks_v"],
        "SELECT b.booking_id, b.task_id, t.section_id, t.task_name, t.section_name FROM bookings_v b LEFT JOIN tasks_v t ON b.task_id = t.task_id",
    ),
)
def merge_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings left-joined to tasks; every booking row kept."""
    m = joins.merge_with_dimension(fx.bookings_v(spark, sf_dir), fx.tasks_v(spark, sf_dir), "task_id")
    return m.select("booking_id", "task_id", "section_id", "task_name", "section_name")


@register(
    "merge_counts",
    with_views(
        ["bookings_v", "tasks_v"],
        "SELECT (SELECT count(*) FROM bookings_v) AS rows, count(*) AS merged_rows, count(*) - (SELECT count(*) FROM bookings_v) AS fan_out, "
        "CAST(count_if(t.task_id IS NULL) AS BIGINT) AS unmatched_rows, CAST(count_if(t.task_name IS NULL) AS BIGINT) AS rows_without_name "
        "FROM bookings_v b LEFT JOIN tasks_v t ON b.task_id = t.task_id",
    ),
)
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the task join: rows before and after, fan-out, unmatched rows, rows without a task name."""
    return joins.merge_counts(fx.bookings_v(spark, sf_dir), fx.tasks_v(spark, sf_dir))


@register(
    "fill_counts",
    with_views(
        ["staffing_typed", "staffing_clean"],
        "SELECT count(*) AS rows, CAST(count_if(employees_on_duty IS NULL) AS BIGINT) AS missing_before, "
        "(SELECT CAST(count_if(employees_on_duty IS NULL) AS BIGINT) FROM staffing_clean) AS missing_after, "
        "CAST(count_if(employees_on_duty IS NULL) AS BIGINT) - (SELECT CAST(count_if(employees_on_duty IS NULL) AS BIGINT) FROM staffing_clean) AS filled FROM staffing_typed",
    ),
)
def fill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staffing rows whose missing employees were filled from task minutes."""
    s = fx.staffing_v(spark, sf_dir)
    return cleaning.fill_counts(s, cleaning.clean_staffing(s))


@register(
    "unmatched_tasks",
    with_views(
        ["bookings_v", "tasks_v"],
        "SELECT task_id, count(*) AS rows FROM bookings_v b WHERE task_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tasks_v t WHERE t.task_id = b.task_id) GROUP BY task_id ORDER BY task_id LIMIT 10",
    ),
)
def unmatched_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booking task ids without a task row, with their row counts (first 10 by id)."""
    u = joins.unmatched_keys(fx.bookings_v(spark, sf_dir), fx.tasks_v(spark, sf_dir), "task_id")
    return u.orderBy("task_id").limit(10)


@register(
    "task_lookup_features",
    with_views(
        ["task1_test_v", "tasks_one"],
        "SELECT i.row_id, i.task_id, t.b.section_id AS section_id, t.b.task_name AS task_name, t.b.task_name IS NOT NULL AS has_task_name, "
        "t.b.section_name AS section_name, t.b.section_name IS NOT NULL AS has_section_name FROM task1_test_v i LEFT JOIN tasks_one t ON i.task_id = t.task_id",
    ),
)
def task_lookup_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension attributes and has_* flags for each scoring row."""
    f = joins.lookup_features(fx.task1_test_v(spark, sf_dir), fx.tasks_v(spark, sf_dir), "task_id")
    return f.select("row_id", "task_id", "section_id", "task_name", "has_task_name", "section_name", "has_section_name")


@register(
    "lookup_with_default",
    with_views(
        ["task1_test_v", "tasks_one"],
        """SELECT i.row_id, i.task_id,
       CASE WHEN t.task_id IS NOT NULL THEN t.b.section_id ELSE 'SEC-001' END AS section_id,
       CASE WHEN t.task_id IS NOT NULL THEN t.b.task_name ELSE 'Unknown Task' END AS task_name,
       CASE WHEN s.section_id IS NOT NULL THEN s.section_name ELSE 'Unknown Section' END AS section_name
FROM task1_test_v i LEFT JOIN tasks_one t ON i.task_id = t.task_id
LEFT JOIN (SELECT b.section_id AS section_id, min(b.section_name) AS section_name FROM tasks_one GROUP BY 1) s
  ON s.section_id = CASE WHEN t.task_id IS NOT NULL THEN t.b.section_id ELSE 'SEC-001' END""",
    ),
)
def lookup_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch point lookup: task -> section and name, section -> section name, literal defaults when unmatched."""
    tasks = fx.tasks_v(spark, sf_dir)
    d = S.LOOKUP_DEFAULTS
    by_task = joins.lookup_with_default(
        fx.task1_test_v(spark, sf_dir).select("row_id", "task_id"), tasks.select("task_id", "section_id", "task_name"), "task_id",
        {"section_id": d["section_id"], "task_name": d["task_name"]},
    )
    sections = tasks.select("section_id", "section_name")
    out = joins.lookup_with_default(by_task, sections, "section_id", {"section_name": d["section_name"]})
    return out.select("row_id", "task_id", "section_id", "task_name", "section_name")


# ---------------------------------------------------------------------------
# Feature blocks
# ---------------------------------------------------------------------------


@register("time_features", with_views(["bookings_v"], f"SELECT booking_id, {calendar_sql('appointment_time', 'appt_')} FROM bookings_v"))
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar block of the appointment time."""
    b = fx.bookings_v(spark, sf_dir)
    return b.select("booking_id", *timefns.calendar_block(F.col("appointment_time"), "appt_"))


_T1_FEATURE_COLS = (
    ["booking_id", "task_id", "section_id", "task_name", "has_task_name", "section_name", "has_section_name"]
    + [f"appt_{c}" for c in ("hour", "weekday", "month", "day", "year", "time_of_day", "is_weekend", "is_business_hour")]
    + [f"checkin_{c}" for c in ("hour", "weekday", "month", "day", "year", "time_of_day", "is_weekend", "is_business_hour")]
    + ["queue_number", "has_queue_number", "document_uploaded", "satisfaction_rating", "has_satisfaction_rating"]
)


@register(
    "task1_features",
    with_views(
        ["t1_feat"],
        f"SELECT {', '.join(_T1_FEATURE_COLS)}, round(booking_advance_hours, 6) AS booking_advance_hours, "
        "round(processing_time_minutes, 6) AS processing_time_minutes FROM t1_feat",
    ),
)
def task1_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1 training features (task lookup, two calendar blocks, booking behaviour)."""
    f = features.task1_features(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)), fx.tasks_v(spark, sf_dir))
    return f.select(
        *_T1_FEATURE_COLS, r6(F.col("booking_advance_hours")).alias("booking_advance_hours"), r6(F.col(cleaning.TASK1_TARGET)).alias("processing_time_minutes")
    )


_T1_SCORE_SQL = f"""SELECT i.row_id, i.task_id, {calendar_sql('i.ts', 'appt_')}, {calendar_sql('i.ts', 'checkin_')},
       t.b.section_id AS section_id, t.b.task_name AS task_name, t.b.task_name IS NOT NULL AS has_task_name,
       t.b.section_name AS section_name, t.b.section_name IS NOT NULL AS has_section_name,
       CAST(NULL AS DOUBLE) AS queue_number, false AS has_queue_number, 0 AS document_uploaded,
       CAST(NULL AS DOUBLE) AS booking_advance_hours, CAST(NULL AS DOUBLE) AS satisfaction_rating, false AS has_satisfaction_rating
FROM (SELECT *, try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M') AS ts FROM task1_test_v) i
LEFT JOIN tasks_one t ON i.task_id = t.task_id"""


@register("task1_score_features", with_views(["task1_test_v", "tasks_one"], _T1_SCORE_SQL))
def task1_score_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1 scoring features from date + time, with the task lookup and defaults."""
    return features.task1_score_features(fx.task1_test_v(spark, sf_dir), fx.tasks_v(spark, sf_dir))


_ALIGN_EXPECTED = ["booking_id", "task_id", "appt_hour", "appt_weekday", "appt_month", "checkin_hour", "checkin_weekday", "checkin_month",
                   "booking_advance_hours", "queue_number", "document_uploaded", "num_documents"]


@register(
    "align_feature_columns",
    with_views(
        ["task1_test_v", "tasks_one"],
        "SELECT row_id, 0 AS booking_id, task_id, appt_hour, appt_weekday, appt_month, checkin_hour, checkin_weekday, checkin_month, "
        "booking_advance_hours, queue_number, document_uploaded, 0 AS num_documents FROM (" + _T1_SCORE_SQL + ") f",
    ),
)
def align_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring features aligned to a training column list: absent columns get their default."""
    f = features.task1_score_features(fx.task1_test_v(spark, sf_dir), fx.tasks_v(spark, sf_dir))
    return features.align_feature_columns(f, ["row_id", *_ALIGN_EXPECTED], S.TASK1_FEATURE_DEFAULTS)


@register(
    "task2_features",
    with_views(
        ["t2_feat"],
        "SELECT date, section_id, weekday, month, day, year, is_weekend, quarter, is_month_end, is_month_start, total_task_time_minutes, "
        "has_task_time, task_time_category, historical_employees, staffing_target FROM t2_feat",
    ),
)
def task2_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 training features (calendar of the date, task-time bins, target)."""
    c = cleaning.staffing_target(cleaning.clean_staffing(fx.staffing_v(spark, sf_dir)))
    f = features.task2_features(c.withColumn("date_text", F.date_format("date", "yyyy-MM-dd")), keep=("staffing_target", "date_text"))
    return f.withColumnRenamed("date_text", "date_out").drop("date").withColumnRenamed("date_out", "date")


@register(
    "task2_score_features",
    with_views(
        ["task2_test_v"],
        f"""SELECT row_id, section_id, {date_block_sql('d')}, CAST(NULL AS DOUBLE) AS total_task_time_minutes, false AS has_task_time,
       'medium' AS task_time_category, CAST(NULL AS DOUBLE) AS historical_employees
FROM (SELECT *, try_strptime(date, '%Y-%m-%d')::DATE AS d FROM task2_test_v) i""",
    ),
)
def task2_score_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 scoring features with the fixed defaults."""
    return features.task2_score_features(fx.task2_test_v(spark, sf_dir))


@register(
    "category_codes",
    with_views(
        ["t1_feat"],
        """SELECT 'task_id' AS "column", task_id AS value, CAST(dense_rank() OVER (ORDER BY task_id) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT task_id FROM t1_feat WHERE processing_time_minutes IS NOT NULL AND task_id IS NOT NULL) d
UNION ALL SELECT * FROM (VALUES ('appt_time_of_day', 'night', 0), ('appt_time_of_day', 'morning', 1), ('appt_time_of_day', 'afternoon', 2),
  ('appt_time_of_day', 'evening', 3)) v("column", value, code)""",
    ),
)
def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code table fitted on Task 1 training rows: sorted labels -> 0..n-1, bins in fixed order."""
    rows = features.task1_features(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)))
    rows = rows.where(F.col(cleaning.TASK1_TARGET).isNotNull())
    return features.fit_category_codes(rows, ["task_id", "appt_time_of_day"])


_IMPUTE_COLS = ["queue_number", "satisfaction_rating", "booking_advance_hours", "checkin_hour"]


@register(
    "impute_median",
    with_views(
        ["t1_feat"],
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(median({c}), 6) AS fill FROM t1_feat WHERE processing_time_minutes IS NOT NULL HAVING count({c}) > 0"
            for c in _IMPUTE_COLS
        ),
    ),
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train-fitted median fill per numeric feature (all-NULL columns get no fill)."""
    rows = features.task1_features(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)))
    rows = rows.where(F.col(cleaning.TASK1_TARGET).isNotNull())
    fills = features.fit_impute_medians(rows, _IMPUTE_COLS)
    return fills.select("column", r6(F.col("fill")).alias("fill"))


@register(
    "task1_features_clean",
    with_views(
        ["t1_feat"],
        """SELECT tr.booking_id, coalesce(codes.code, 999999) AS task_id,
       CASE appt_time_of_day WHEN 'night' THEN 0 WHEN 'morning' THEN 1 WHEN 'afternoon' THEN 2 WHEN 'evening' THEN 3 ELSE 999999 END AS appt_time_of_day,
       round(coalesce(queue_number, fills.q), 6) AS queue_number, round(coalesce(satisfaction_rating, fills.s), 6) AS satisfaction_rating,
       round(processing_time_minutes, 6) AS processing_time_minutes
FROM tr LEFT JOIN codes ON tr.task_id = codes.task_id CROSS JOIN fills""",
        [
            ("tr", "SELECT * FROM t1_feat WHERE processing_time_minutes IS NOT NULL"),
            ("codes", "SELECT task_id, CAST(dense_rank() OVER (ORDER BY task_id) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT task_id FROM tr WHERE task_id IS NOT NULL) d"),
            ("fills", "SELECT median(queue_number) AS q, median(satisfaction_rating) AS s FROM tr"),
        ],
    ),
)
def task1_features_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid-target rows with train-fitted category codes and median imputation."""
    rows = features.task1_features(cleaning.clean_bookings(fx.bookings_v(spark, sf_dir)))
    rows = rows.select("booking_id", "task_id", "appt_time_of_day", "queue_number", "satisfaction_rating", cleaning.TASK1_TARGET)
    out, _, _ = features.prepare_for_training(rows, cleaning.TASK1_TARGET)
    return out.select(
        "booking_id", "task_id", "appt_time_of_day", r6(F.col("queue_number")).alias("queue_number"),
        r6(F.col("satisfaction_rating")).alias("satisfaction_rating"), r6(F.col(cleaning.TASK1_TARGET)).alias("processing_time_minutes"),
    )


@register(
    "task2_features_clean",
    with_views(
        ["t2_feat"],
        """SELECT tr.date, coalesce(codes.code, 999999) AS section_id, tr.weekday, CAST(tr.is_weekend AS INTEGER) AS is_weekend,
       coalesce(tr.total_task_time_minutes, 0) AS total_task_time_minutes,
       CASE tr.task_time_category WHEN 'very_low' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'very_high' THEN 4 ELSE 999999 END AS task_time_category,
       tr.staffing_target
FROM tr LEFT JOIN codes ON tr.section_id = codes.section_id""",
        [
            ("tr", "SELECT * FROM t2_feat WHERE staffing_target IS NOT NULL"),
            ("codes", "SELECT section_id, CAST(dense_rank() OVER (ORDER BY section_id) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT section_id FROM tr WHERE section_id IS NOT NULL) d"),
        ],
    ),
)
def task2_features_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid-target staffing rows: codes, zero fill for minutes, booleans as 0/1."""
    c = cleaning.staffing_target(cleaning.clean_staffing(fx.staffing_v(spark, sf_dir)))
    rows = features.task2_features(c.withColumn("date_text", F.date_format("date", "yyyy-MM-dd")), keep=("staffing_target", "date_text"))
    rows = rows.select("date_text", "section_id", "weekday", "is_weekend", "total_task_time_minutes", "task_time_category", "staffing_target")
    out, _, _ = features.prepare_for_training(
        rows, "staffing_target", zero_fill=("employees_on_duty", "total_task_time_minutes"), bool_to_int=True, skip=("row_id", "date_text")
    )
    return out.select(F.col("date_text").alias("date"), "section_id", "weekday", "is_weekend", "total_task_time_minutes", "task_time_category", "staffing_target")
