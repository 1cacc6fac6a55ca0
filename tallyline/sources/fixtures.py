"""Stand-in inputs derived from the driver's parquet tables.

Each view only reshapes a test table into the schema a job expects (the
roles of the booking, task, staffing and scoring-input files); the jobs do
all the work and make no use of how these rows were formed. Every view reads
its whole source table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _micros_shift(ts, micros):
    return F.timestamp_micros(F.unix_micros(ts) + micros)


def bookings_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings role over ``events``; timestamps typed, other fields as text."""
    configure(spark)
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    hour_us = F.lit(3_600_000_000)
    return e.select(
        eid.alias("booking_id"),
        F.col("event_type").alias("task_id"),
        _micros_shift(ts, -(eid % 96) * hour_us).alias("booking_created_time"),
        ts.alias("appointment_time"),
        F.when(eid % 33 != 0, ts).alias("check_in_time"),
        F.when(eid % 50 == 1, _micros_shift(ts, F.lit(-60_000_000)))
        .otherwise(_micros_shift(ts, F.round(F.col("value") * 60).cast("long") * 1_000_000))
        .alias("check_out_time"),
        F.when(eid % 10 == 0, F.lit("n/a")).otherwise((eid % 50).cast("string")).alias("queue_number"),
        F.when(eid % 3 != 0, (eid % 5 + 1).cast("string")).alias("satisfaction_rating"),
        F.element_at(F.array(*[F.lit(v) for v in ["1", "0", "yes", "No", "YES", "maybe"]]), (eid % 6 + 1).cast("int"))
        .alias("document_uploaded"),
    )


def tasks_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task dimension: the distinct event types except ``error``."""
    configure(spark)
    t = table(spark, sf_dir, "events").select(F.col("event_type").alias("task_id")).distinct()
    t = t.where(F.col("task_id") != "error")
    k = F.col("task_id")
    return t.select(
        k.alias("task_id"),
        F.when(k == "signup", "SEC-001").when(k == "purchase", "SEC-003").otherwise("SEC-002").alias("section_id"),
        F.when(k != "view", F.upper(k)).alias("task_name"),
        F.when(k == "signup", "Registration").when(k == "purchase", "Sales").otherwise("Browsing").alias("section_name"),
    )


def staffing_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staffing role: lineitem counted per ship date and supplier group of 6."""
    configure(spark)
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy(
        F.col("l_shipdate").cast("date").alias("d"),
        (F.col("l_suppkey") % 6 + 1).alias("s"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    dom = F.dayofmonth("d")
    return g.select(
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("SEC-00"), F.col("s").cast("string")).alias("section_id"),
        F.when(dom % 7 == 0, F.lit(None).cast("bigint")).when(dom == 13, F.lit(0).cast("bigint")).otherwise(F.col("n"))
        .alias("employees_on_duty"),
        F.when(dom != 28, F.col("q") * 5).alias("total_task_time_minutes"),
    )


_TASK_BY_CUSTOMER = ["signup", "click", "view", "purchase", "error", "refund"]


def task1_test_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1 scoring inputs over ``orders``."""
    configure(spark)
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("row_id"),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("date"),
        F.when(k % 97 == 0, F.lit("bad"))
        .otherwise(F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":30")))
        .alias("time"),
        F.element_at(F.array(*[F.lit(v) for v in _TASK_BY_CUSTOMER]), (F.col("o_custkey") % 6 + 1).cast("int"))
        .alias("task_id"),
    )


def task2_test_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 2 scoring inputs over ``orders``."""
    configure(spark)
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("row_id"),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("date"),
        F.when(k % 41 != 0, F.concat(F.lit("SEC-00"), (F.col("o_custkey") % 7 + 1).cast("string"))).alias("section_id"),
    )
