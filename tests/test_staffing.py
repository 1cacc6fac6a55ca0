"""Staffing patterns, section profiles, fill of missing employees."""

import pytest

from tallyline.operators import cleaning, staffing


def _rows(spark):
    # section S1: n=3 (median used), S2: n=2 (mean used), S3: n=1; weekday medians
    rows = [
        ("S1", 0, 3.0), ("S1", 0, 3.0), ("S1", 1, 9.0),
        ("S2", 0, 2.0), ("S2", 1, 5.0),
        ("S3", 2, 7.0),
        (None, 0, 3.0),
    ]
    return spark.createDataFrame(rows, "section_id string, weekday int, y double")


def test_pattern_fit_truncates_with_floor_one(spark):
    m = staffing.fit_staffing_patterns(_rows(spark), "y")
    sec = {r["section_id"]: (r["median_i"], r["mean_i"], r["count"]) for r in m.sections.collect()}
    assert sec == {"S1": (3, 5, 3), "S2": (3, 3, 2), "S3": (7, 7, 1)}
    wd = {r["weekday"]: r["median_i"] for r in m.weekdays.collect()}
    assert wd == {0: 3, 1: 7, 2: 7}
    assert m.global_average == int((3 + 3 + 9 + 2 + 5 + 7 + 3) / 7)


def test_pattern_predict_blend_and_fallbacks(spark):
    m = staffing.fit_staffing_patterns(_rows(spark), "y")
    probe = spark.createDataFrame(
        [(1, "S1", 0), (2, "S2", None), (3, None, 1), (4, "S9", 0), (5, None, None), (6, "S3", 5)],
        "id int, section_id string, weekday int",
    )
    got = {r["id"]: r["pattern_prediction"] for r in m.predict(probe).collect()}
    assert got[1] == 2  # int(0.7 * 3 + 0.3 * 3) = int(2.9999999999999996) = 2
    assert got[2] == 3  # S2 has n = 2: truncated mean
    assert got[3] == 7  # NULL section: weekday median
    assert got[4] == m.global_average  # unseen section: global, weekday ignored
    assert got[5] == m.global_average
    assert got[6] == 7  # S3 with a weekday never seen in training


def test_section_aggregates(spark):
    df = spark.createDataFrame(
        [("A", 2.0, 100.0), ("A", 4.0, None), ("A", None, 50.0), ("B", None, None), (None, 1.0, 1.0)],
        "section_id string, employees_on_duty double, total_task_time_minutes double",
    )
    got = {r["section_id"]: r for r in staffing.section_aggregates(df).collect()}
    a = got["A"]
    assert (a.section_avg_employees, a.section_median_employees, a.section_max_employees, a.section_min_employees) == (3.0, 3.0, 4.0, 2.0)
    assert a.section_std_employees == pytest.approx(2 ** 0.5)
    assert (a.section_avg_task_time, a.section_median_task_time, a.section_total_observations) == (75.0, 75.0, 3)
    b = got["B"]
    assert b.section_avg_employees is None and b.section_total_observations is None
    assert None not in got


def test_fill_missing_employees_with_zero_division(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "A", "0", "120"), ("2024-01-02", "A", "2", "600"), ("2024-01-03", "A", "4", "1200"),
         ("2024-01-04", "A", None, "900"), ("2024-01-05", "A", None, None), ("2024-01-06", "A", "0", "0")],
        "date string, section_id string, employees_on_duty string, total_task_time_minutes string",
    )
    # ratios: inf (120/0), 300, 300; 0/0 skipped -> median 300
    assert cleaning.minutes_per_employee(cleaning.clean_staffing(df, fill_missing=False)).collect()[0]["minutes_per_employee"] == 300.0
    got = [r["employees_on_duty"] for r in cleaning.clean_staffing(df).orderBy("date").collect()]
    assert got == [0.0, 2.0, 4.0, 3.0, None, 0.0]


def test_staffing_target_variants(spark):
    df = spark.createDataFrame([(3.0, 100.0), (-1.0, 500.0), (float("inf"), 0.0), (None, None)], "employees_on_duty double, total_task_time_minutes double")
    t = [r["staffing_target"] for r in cleaning.staffing_target(df).collect()]
    assert t == [3.0, None, None, None]
    d = [r["staffing_target"] for r in cleaning.staffing_target(df.drop("employees_on_duty")).collect()]
    assert d == [1.0, 1.0, 1.0, None]  # 100/480 -> 0 -> floor 1; 500/480 -> 1; 0 -> floor 1
