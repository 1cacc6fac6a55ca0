"""Bookings cleaning: K2 date + time repair, missing columns, typed and text timestamps."""

from pyspark.sql import functions as F

from tallyline.operators import cleaning, features


def test_bare_appointment_time_is_combined_with_its_date(spark):
    df = spark.createDataFrame(
        [("1", "T1", "2025-09-01", "10:30", "2025-09-01 10:35:00", "2025-09-01 10:50:30"),
         ("2", "T1", "9/2/2025", "bad", None, "2025-09-02 11:00:00")],
        "booking_id string, task_id string, appointment_date string, appointment_time string, check_in_time string, check_out_time string",
    )
    c = cleaning.clean_bookings(df)
    f = features.task1_features(c).orderBy("booking_id").collect()
    assert (f[0]["appt_hour"], f[0]["appt_weekday"], f[0]["appt_month"]) == (10, 0, 9)
    assert f[0]["processing_time_minutes"] == 15.5
    assert f[1]["appt_hour"] is None and f[1]["processing_time_minutes"] is None


def test_target_is_null_without_checkout_column(spark):
    df = spark.createDataFrame([("1", "2025-09-01 10:00:00")], "booking_id string, check_in_time string")
    r = cleaning.clean_bookings(df).collect()[0]
    assert r["processing_time_minutes"] is None


def test_negative_and_long_durations_nulled(spark):
    df = spark.createDataFrame(
        [("1", "2025-09-01 10:00:00", "2025-09-01 09:59:00"), ("2", "2025-09-01 10:00:00", "2025-09-01 18:00:00"),
         ("3", "2025-09-01 10:00:00", "2025-09-01 18:00:01")],
        "booking_id string, check_in_time string, check_out_time string",
    )
    got = [r["processing_time_minutes"] for r in cleaning.clean_bookings(df).orderBy("booking_id").collect()]
    assert got == [None, 480.0, None]
    q = cleaning.duration_quality(df).collect()[0]
    assert (q["negative"], q["too_long"], q["removed"], q["kept"]) == (1, 1, 2, 1)


def test_zone_offsets_are_converted_to_utc(spark):
    df = spark.createDataFrame([("1", "2025-09-01T10:00:00+02:00", "2025-09-01T08:30:00Z")], "booking_id string, check_in_time string, check_out_time string")
    r = cleaning.clean_bookings(df).select(F.hour("check_in_time").alias("h"), "processing_time_minutes").collect()[0]
    assert (r["h"], r["processing_time_minutes"]) == (8, 30.0)
