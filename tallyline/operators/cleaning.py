"""Cleaning of bookings and staffing tables, targets and data-quality counters.

Every column is optional: an expression is applied only when its input column
exists. All rows are kept unless a function says it filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S
from tallyline.functions import scalar, timefns
from tallyline.operators.median import grouped_median
from tallyline.session import materialize

TIMESTAMP_COLUMNS = ["booking_created_time", "appointment_time", "check_in_time", "check_out_time"]
BOOKING_NUMERIC = ["queue_number", "satisfaction_rating"]
BOOKING_BOOLEAN = ["document_uploaded"]
TASK1_TARGET = "processing_time_minutes"
TASK2_TARGET = "employees_on_duty"


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def raw_duration(df: DataFrame) -> DataFrame:
    """Signed minutes from check-in to check-out (NULL if either is missing)."""
    types = _types(df)
    if "check_in_time" not in types or "check_out_time" not in types:
        return df.withColumn("duration_minutes", F.lit(None).cast("double"))
    start = timefns.parse_timestamp(F.col("check_in_time"), types["check_in_time"])
    end = timefns.parse_timestamp(F.col("check_out_time"), types["check_out_time"])
    return df.withColumn("duration_minutes", timefns.minutes_between(start, end))


def clean_bookings(df: DataFrame, lo: float = 0.0, hi: float = S.MAX_SERVICE_MINUTES) -> DataFrame:
    """Typed bookings with the target ``processing_time_minutes``.

    Timestamps parsed (a bare ``HH:MM`` appointment time is combined with
    ``appointment_date`` when present), numerics coerced, the boolean mapped,
    and the target = check-out minus check-in in minutes, NULL outside
    ``[lo, hi]``. All rows are kept.
    """
    types = _types(df)
    cols = []
    for name, dt in types.items():
        c = F.col(name)
        if name in TIMESTAMP_COLUMNS:
            parsed = timefns.parse_timestamp(c, dt)
            if name == "appointment_time" and "appointment_date" in types and not isinstance(
                dt, (T.TimestampType, T.TimestampNTZType)
            ):
                parsed = F.coalesce(parsed, timefns.combine_date_time(F.col("appointment_date"), c))
            cols.append(parsed.alias(name))
        elif name == "appointment_date":
            cols.append(timefns.parse_date(c, dt).alias(name))
        elif name in BOOKING_NUMERIC:
            cols.append(scalar.to_double(c, dt).alias(name))
        elif name in BOOKING_BOOLEAN:
            cols.append(scalar.to_boolean(c, dt).alias(name))
        elif name == "num_documents":
            cols.append(scalar.to_double(c, dt).alias(name))
        else:
            cols.append(c)
    out = df.select(*cols)
    if "check_in_time" in types and "check_out_time" in types:
        minutes = timefns.minutes_between(F.col("check_in_time"), F.col("check_out_time"))
        target = scalar.null_outside(minutes, lo, hi)
    else:
        target = F.lit(None).cast("double")
    return out.withColumn(TASK1_TARGET, target)


def duration_quality(df: DataFrame, lo: float = 0.0, hi: float = S.MAX_SERVICE_MINUTES) -> DataFrame:
    """One-row data-quality report of raw durations and the range cleaning."""
    d = materialize(raw_duration(df).select("duration_minutes"), "durations")  # read for counts and for the median
    m = F.col("duration_minutes")
    counts = d.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(m).alias("valid"),
        F.count_if(m < lo).alias("negative"),
        F.count_if(m > hi).alias("too_long"),
        F.count_if(m.isNotNull() & ~m.between(lo, hi)).alias("removed"),
        F.count_if(m.between(lo, hi)).alias("kept"),
        F.min(m).alias("min_minutes"),
        F.max(m).alias("max_minutes"),
        F.avg(m).alias("mean_minutes"),
    ).withColumn("_k", F.lit(1))
    med = grouped_median(d, [], "duration_minutes", median_col="median_minutes").drop("n").withColumn("_k", F.lit(1))
    return counts.join(med, on="_k", how="left").drop("_k")


def minutes_per_employee(df: DataFrame) -> DataFrame:
    """One row: median of minutes / employees over rows with both values.

    x/0 is ±inf and takes part in the median; 0/0 is skipped.
    """
    ratio = scalar.guarded_ratio(F.col("total_task_time_minutes"), F.col("employees_on_duty"))
    both = df.where(F.col("employees_on_duty").isNotNull() & F.col("total_task_time_minutes").isNotNull())
    return grouped_median(both.select(ratio.alias("ratio")), [], "ratio", median_col="minutes_per_employee", n_col="pairs")


def fill_counts(before: DataFrame, after: DataFrame, column: str = "employees_on_duty") -> DataFrame:
    """One row: missing values of ``column`` before the fill, after it, and how many were filled."""
    a = before.agg(F.count(F.lit(1)).alias("rows"), F.count_if(scalar.to_double(F.col(column)).isNull()).alias("missing_before"))
    b = after.agg(F.count_if(F.col(column).isNull()).alias("missing_after"))
    one = F.lit(1).alias("_k")
    out = a.select("*", one).join(b.select("*", one), "_k").drop("_k")
    return out.withColumn("filled", F.col("missing_before") - F.col("missing_after"))


def clean_staffing(df: DataFrame, fill_missing: bool = True) -> DataFrame:
    """Typed staffing rows; missing employees filled from task minutes.

    Fill = round-half-even(minutes / median minutes-per-employee), only where
    minutes exist. The median is a one-row scalar computed on the executors.
    """
    types = _types(df)
    cols = []
    for name, dt in types.items():
        c = F.col(name)
        if name == "date":
            cols.append(timefns.parse_date(c, dt).alias(name))
        elif name in ("employees_on_duty", "total_task_time_minutes"):
            cols.append(scalar.to_double(c, dt).alias(name))
        else:
            cols.append(c)
    out = df.select(*cols)
    if not fill_missing or "employees_on_duty" not in types or "total_task_time_minutes" not in types:
        return out
    # The typed rows feed both the ratio median and the fill: read the source once.
    out = materialize(out, "staffing-typed")
    row = minutes_per_employee(out).collect()
    if not row or row[0]["minutes_per_employee"] is None:
        return out
    m = float(row[0]["minutes_per_employee"])
    emp, t = F.col("employees_on_duty"), F.col("total_task_time_minutes")
    est = F.lit(None).cast("double") if m == 0 else t / F.lit(m)  # a zero median fills nothing
    filled = F.when(emp.isNull() & t.isNotNull() & scalar.is_finite(est), F.bround(est, 0)).otherwise(emp)
    return out.withColumn("employees_on_duty", filled)


def staffing_target(df: DataFrame, col: str = "staffing_target") -> DataFrame:
    """Task 2 target: employees (±inf -> NULL, negative -> NULL) or, without that
    column, round-half-even(minutes / 480) with a floor of 1 (NULL stays NULL)."""
    if "employees_on_duty" in df.columns:
        e = F.col("employees_on_duty").cast("double")
        t = F.when(scalar.is_finite(e) & (e >= 0), e)
    elif "total_task_time_minutes" in df.columns:
        v = F.bround(F.col("total_task_time_minutes").cast("double") / F.lit(S.MINUTES_PER_EMPLOYEE_DAY), 0)
        t = F.when(v.isNotNull(), F.greatest(v, F.lit(1.0)))
    else:
        t = F.lit(None).cast("double")
    return df.withColumn(col, t)


def valid_target_rows(df: DataFrame, target: str) -> DataFrame:
    """Rows whose target is not NULL."""
    return df.where(F.col(target).isNotNull())


def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with no NULL in any of ``cols``."""
    return df.dropna(subset=cols)


def range_filter(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows with ``lo <= col <= hi`` (others dropped)."""
    return df.where(F.col(col).between(lo, hi))


def basic_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Type-driven projection: numbers, text and booleans pass through;
    timestamps and dates become ``<c>_hour``, ``<c>_weekday``, ``<c>_month``."""
    out = []
    for f in df.schema.fields:
        if cols is not None and f.name not in cols:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            ts = c.cast("timestamp")
            out += [F.hour(ts).alias(f"{f.name}_hour"), F.weekday(ts).alias(f"{f.name}_weekday"), F.month(ts).alias(f"{f.name}_month")]
        else:
            out.append(c)
    return df.select(*out)
