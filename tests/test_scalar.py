"""Edge frames for the scalar layer: bins, ties, bounds, parsing, boolean map."""

import math

from pyspark.sql import functions as F

from tallyline.functions import scalar, timefns
from tallyline.operators.features import task_time_category


def _col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_time_of_day_edges(spark):
    got = _col(spark, [0, 6, 7, 12, 13, 18, 19, 23, None], "int", timefns.time_of_day)
    assert got == ["night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", None]


def test_duration_range_is_inclusive_and_keeps_rows(spark):
    got = _col(spark, [-1.0, 0.0, 0.5, 480.0, 480.01, None], "double", lambda c: scalar.null_outside(c, 0, 480))
    assert got == [None, 0.0, 0.5, 480.0, None, None]


def test_task_time_bins(spark):
    got = _col(spark, [-5.0, 0.0, 120.0, 120.5, 240.0, 480.0, 960.0, 961.0, None], "double", task_time_category)
    assert got == [None, "very_low", "very_low", "low", "low", "medium", "high", "very_high", "very_low"]


def test_half_even_rounding(spark):
    got = _col(spark, [0.5, 1.5, 2.5, -0.5], "double", lambda c: F.bround(c, 0))
    assert got == [0.0, 2.0, 2.0, -0.0]


def test_sanitize_non_finite_become_minimum(spark):
    vals = [float("nan"), float("inf"), float("-inf"), -3.0, 50.5, 1000.0]
    got = _col(spark, vals, "double", lambda c: scalar.sanitize(c, 0, 480))
    assert got == [0, 0, 0, 0, 50, 480]
    got1 = _col(spark, vals, "double", lambda c: scalar.sanitize(c, 1, None))
    assert got1 == [1, 1, 1, 1, 50, 1000]


def test_parse_dates_month_first(spark):
    vals = ["2025-09-01", "9/1/2025", "13/02/2025", "2025/9/1", "x", ""]
    got = _col(spark, vals, "string", lambda c: F.date_format(timefns.parse_date(c), "yyyy-MM-dd"))
    assert got == ["2025-09-01", "2025-09-01", "2025-02-13", "2025-09-01", None, None]


def test_parse_times(spark):
    vals = ["10:30", "9:05", "1030", "24:00", "10:30:00", " 08:00 ", ""]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(timefns.parse_time(F.col("v")).alias("t"))
    got = [(r.t.hour, r.t.minute) if r.t else None for r in df.collect()]
    assert got == [(10, 30), (9, 5), (10, 30), None, None, (8, 0), None]


def test_bare_time_never_becomes_a_timestamp(spark):
    got = _col(spark, ["10:30", "2024-01-02 10:30", "2024-01-02T10:30:00", "1/2/2024 10:30"], "string",
               lambda c: F.date_format(timefns.parse_timestamp(c), "yyyy-MM-dd HH:mm"))
    assert got == [None, "2024-01-02 10:30", "2024-01-02 10:30", "2024-01-02 10:30"]


def test_boolean_map_is_case_sensitive(spark):
    vals = ["1", "0", "true", "True", "TRUE", "yes", "Y", "y", "1.0", None]
    got = _col(spark, vals, "string", scalar.to_boolean)
    assert got == [True, False, True, True, None, True, True, None, True, None]


def test_numeric_coercion_and_nan(spark):
    got = _col(spark, ["12", " 3.5 ", "n/a", "NaN", None], "string", scalar.to_double)
    assert got == [12.0, 3.5, None, None, None]


def test_guarded_ratio_follows_float_division(spark):
    df = spark.createDataFrame([(10.0, 0.0), (-10.0, 0.0), (0.0, 0.0), (10.0, 4.0)], "a double, b double")
    got = [r[0] for r in df.select(scalar.guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and got[2] is None and got[3] == 2.5


def test_calendar_flags_false_for_null_time(spark):
    df = spark.createDataFrame([(None,)], "ts timestamp").select(*timefns.calendar_block(F.col("ts"), "a_"))
    r = df.collect()[0]
    assert r.a_hour is None and r.a_is_weekend is False and r.a_is_business_hour is False


def test_weekday_monday_is_zero(spark):
    got = _col(spark, ["2024-01-01", "2024-01-07"], "string", lambda c: F.weekday(c.cast("date")))
    assert got == [0, 6]


def test_section_default_is_reproducible(spark):
    got = _col(spark, ["SEC-001", None], "string", scalar.section_default)
    assert got[0] == max(1, 3 + int("5d795987", 16) % 5) and got[1] == 3


def test_dense_codes_span_partitions(spark):
    from tallyline.operators.features import dense_codes

    labels = [("a", f"v{i:04d}") for i in range(300)] + [("b", "x"), ("b", "a")]
    df = spark.createDataFrame(labels, "column string, value string")
    got = {(r["column"], r["value"]): r["code"] for r in dense_codes(df, partitions=7).collect()}
    assert got[("a", "v0000")] == 0 and got[("a", "v0299")] == 299
    assert [got[("a", f"v{i:04d}")] for i in range(300)] == list(range(300))
    assert got[("b", "a")] == 0 and got[("b", "x")] == 1


def test_one_rounding_and_no_date_from_a_bare_time(spark):
    vals = [12.5, 13.5, 12.5000001, 13.4999999, 0.4999999]
    assert _col(spark, vals, "double", lambda c: scalar.sanitize(c)) == [12, 14, 13, 13, 0]
    assert _col(spark, vals, "double", lambda c: scalar.clamp_round(c, 0, 50)) == [12, 14, 13, 13, 0]
    assert _col(spark, ["10:30", "7:05 PM", "2024-03-01"], "string", lambda c: timefns.parse_date(c).cast("string")) == [None, None, "2024-03-01"]
    assert [tuple(r) for r in _col(spark, ["9: 05", " 9 :5"], "string", timefns.parse_time)] == [(9, 5), (9, 5)]
