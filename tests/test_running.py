"""Running medians against plain Python on random rows, a hot key over many partitions, odd rows."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tallyline.operators import cleaning, features
from tallyline.operators.running import past_medians, with_past_median
from tallyline.plans import jobs
from tallyline.sources import fixtures as fx

SCHEMA = "i int, k string, d date, v double"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def expected(rows, asof):
    out = {}
    for _, k, d, _ in asof:
        past = [v for _, k2, d2, v in rows if k is not None and d is not None and k2 == k and d2 is not None and d2 < d and v is not None and v == v]
        if past:
            out[(k, d)] = (statistics.median(past), len(past))
    return out


def medians(df):
    return {(r["k"], r["d"]): (r["median"], r["n"]) for r in df.collect()}


def test_hot_key_spans_partitions_and_equals_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, "hot" if rnd.random() < 0.7 else rnd.choice("abc"), day(rnd.randrange(40)), float(rnd.randrange(200))) for i in range(1500)]
    rows += [(-1, None, day(1), 1.0), (-2, "a", None, 1.0), (-3, "a", day(50), None), (-4, "z", day(3), float("nan")), (-5, "once", day(3), 2.0)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many partitions, also for few rows
    try:
        got = medians(past_medians(spark.createDataFrame(rows, SCHEMA), "k", "d", "v"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == expected(rows, rows)


def test_asof_days_of_other_rows(spark):
    rows = [(0, "a", day(0), 1.0), (1, "a", day(0), 4.0), (2, "a", day(2), 10.0), (3, "b", day(9), 1.0)]
    asof = [(0, "a", day(0), None), (1, "a", day(1), None), (2, "a", day(7), None), (3, "b", day(9), None), (4, "c", day(9), None), (5, None, None, None)]
    history, other = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(asof, SCHEMA)
    assert medians(past_medians(history, "k", "d", "v", other)) == expected(rows, asof)
    joined = with_past_median(other, history, "k", "d", "v", "past")
    assert sorted((r["i"], r["past"]) for r in joined.collect()) == [(0, None), (1, 2.5), (2, 4.0), (3, None), (4, None), (5, None)]


def test_empty_tables(spark):
    rows, none = spark.createDataFrame([(0, "a", day(0), 1.0)], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert past_medians(none, "k", "d", "v").collect() == []
    assert past_medians(none, "k", "d", "v", rows).collect() == []
    assert past_medians(rows, "k", "d", "v", none).collect() == []


def test_complexity_is_a_feature_of_the_linear_model(spark):
    cleaned = cleaning.clean_bookings(fx.bookings_v(spark, SF_SMALL)).where(F.col(cleaning.TASK1_TARGET).isNotNull())
    rows = features.task1_features(jobs.with_task_complexity(cleaned))
    model = jobs.fit_task1_linear(rows)
    assert "task_complexity" in model.feature_cols
    assert model.predict(rows).where("linear_prediction is null").count() == 0
