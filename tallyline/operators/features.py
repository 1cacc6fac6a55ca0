"""Feature blocks for both tasks, category codes and train-fitted imputation.

Targets travel in the row (no index alignment). Everything learned from the
training data (category codes, imputation medians) is a stored table so that
scoring never recomputes statistics from the batch it scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S
from tallyline.functions import timefns
from tallyline.operators import joins
from tallyline.operators.cleaning import TASK1_TARGET
from tallyline.operators.median import grouped_median
from tallyline.session import materialize, scratch_scope

ID_COLUMNS = ("row_id", "booking_id")


def task1_features(bookings: DataFrame, tasks: DataFrame | None = None, keep: tuple[str, ...] = (TASK1_TARGET,)) -> DataFrame:
    """Task 1 training features from cleaned bookings (one row per booking)."""
    cols = set(bookings.columns)
    base = bookings
    if tasks is not None and "task_id" in cols:
        # drop dimension columns a previous merge may have added; the lookup re-adds them deduplicated
        base = base.drop(*[c for c in ("section_id", "task_name", "section_name") if c in cols])
        base = joins.lookup_features(base, tasks, "task_id")
    out = []
    for c in ("booking_id", "task_id"):
        if c in cols:
            out.append(F.col(c))
    for c in ("section_id", "task_name", "has_task_name", "section_name", "has_section_name"):
        if c in base.columns:
            out.append(F.col(c))
    if "appointment_time" in cols:
        out += timefns.calendar_block(F.col("appointment_time").cast("timestamp"), "appt_")
    if "check_in_time" in cols:
        out += timefns.calendar_block(F.col("check_in_time").cast("timestamp"), "checkin_")
    if "booking_created_time" in cols and "appointment_time" in cols:
        out.append(timefns.hours_between(F.col("booking_created_time"), F.col("appointment_time")).alias("booking_advance_hours"))
    if "queue_number" in cols:
        out += [F.col("queue_number"), F.col("queue_number").isNotNull().alias("has_queue_number")]
    if "document_uploaded" in cols:
        out.append(F.coalesce(F.col("document_uploaded"), F.lit(False)).cast("int").alias("document_uploaded"))
    if "satisfaction_rating" in cols:
        out += [F.col("satisfaction_rating"), F.col("satisfaction_rating").isNotNull().alias("has_satisfaction_rating")]
    if "num_documents" in cols:
        out.append(F.col("num_documents"))
    if "task_complexity" in cols:
        out.append(F.col("task_complexity"))
    out += [F.col(c) for c in keep if c in cols]
    return base.select(*out)


def task1_score_features(inputs: DataFrame, tasks: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Task 1 scoring features: appointment and check-in blocks both from date + time
    (``keep`` carries extra input columns through)."""
    base = inputs
    if tasks is not None:
        base = joins.lookup_features(base, tasks, "task_id")
    # parse once into a column; the calendar blocks then read the column
    base = base.withColumn("_ts", timefns.combine_date_time(F.col("date"), F.col("time")))
    ts = F.col("_ts")
    out = [F.col("row_id"), F.col("task_id")]
    out += timefns.calendar_block(ts, "appt_") + timefns.calendar_block(ts, "checkin_")
    for c in ("section_id", "task_name", "has_task_name", "section_name", "has_section_name"):
        if c in base.columns:
            out.append(F.col(c))
    out += [
        F.lit(None).cast("double").alias("queue_number"),
        F.lit(False).alias("has_queue_number"),
        F.lit(0).alias("document_uploaded"),
        F.lit(None).cast("double").alias("booking_advance_hours"),
        F.lit(None).cast("double").alias("satisfaction_rating"),
        F.lit(False).alias("has_satisfaction_rating"),
    ]
    out += [F.col(c) for c in keep]
    return base.select(*out)


def task_time_category(minutes) -> F.Column:
    """Right-closed bins over minutes with NULL -> 0 first; negative -> NULL."""
    t = F.coalesce(minutes, F.lit(0.0))
    expr = None
    lower = None
    for upper, label in S.TASK_TIME_BINS:
        cond = (t >= 0) & (t <= upper) if lower is None else (t > lower) & (t <= upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lower = upper
    return expr


def task2_features(staffing: DataFrame, keep: tuple[str, ...] = ("staffing_target",)) -> DataFrame:
    """Task 2 training features from cleaned staffing rows."""
    cols = set(staffing.columns)
    out = []
    if "section_id" in cols:
        out.append(F.col("section_id"))
    if "date" in cols:
        out += timefns.date_block(F.col("date").cast("date"))
    if "total_task_time_minutes" in cols:
        t = F.col("total_task_time_minutes")
        out += [t, t.isNotNull().alias("has_task_time"), task_time_category(t).alias("task_time_category")]
    if "employees_on_duty" in cols:
        out.append(F.col("employees_on_duty").alias("historical_employees"))
    out += [F.col(c) for c in keep if c in cols]
    return staffing.select(*out)


def task2_score_features(inputs: DataFrame) -> DataFrame:
    """Task 2 scoring features: calendar of the date plus fixed defaults."""
    dt = dict((f.name, f.dataType) for f in inputs.schema.fields)["date"]
    parsed = inputs.withColumn("_d", timefns.parse_date(F.col("date"), dt))
    d = F.col("_d")
    return parsed.select(
        F.col("row_id"),
        F.col("section_id"),
        *timefns.date_block(d),
        F.lit(None).cast("double").alias("total_task_time_minutes"),
        F.lit(False).alias("has_task_time"),
        F.lit("medium").alias("task_time_category"),
        F.lit(None).cast("double").alias("historical_employees"),
    )


# ---------------------------------------------------------------------------
# Category codes and imputation, fitted on training rows and stored
# ---------------------------------------------------------------------------

BINNED_ORDINALS = {
    "task_time_category": S.TASK_TIME_ORDINAL,
    "appt_time_of_day": {label: i for i, (_, label) in enumerate(S.TIME_OF_DAY_BINS)},
    "checkin_time_of_day": {label: i for i, (_, label) in enumerate(S.TIME_OF_DAY_BINS)},
}


def categorical_columns(df: DataFrame, skip: tuple[str, ...] = ID_COLUMNS) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def dense_codes(labels: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(column, value, code)``: 0-based rank of each distinct label within its column.

    Labels are range-partitioned on ``(column, value)`` so one column's labels
    can spread over many ordered partitions; the partition index is fixed by
    writing the table once. Ranks are a row number inside
    ``(column, partition)`` plus the labels of the column in earlier
    partitions (a small per-partition totals table).
    """
    spark = labels.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = labels.repartitionByRange(n, "column", "value").withColumn("_part", F.spark_partition_id())
    with scratch_scope(spark):
        ordered = materialize(ordered, "code-labels")
        inside = Window.partitionBy("column", "_part").orderBy("value")
        ranked = ordered.withColumn("_r", F.row_number().over(inside) - 1)
        totals = ordered.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_k"))
        before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("column", "_part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_off"))
        codes = ranked.join(offsets, ["column", "_part"]).select("column", "value", (F.col("_off") + F.col("_r")).cast("int").alias("code"))
        return materialize(codes, "category-codes", keep=True)


def fit_category_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Code table ``(column, value, code)``: sorted distinct values -> 0..n-1.

    Binned columns keep their fixed bin order instead.
    """
    free = [c for c in cols if c not in BINNED_ORDINALS]
    parts = []
    if free:
        stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in free])).alias("kv"))
        distinct = stacked.select("kv.column", "kv.value").where(F.col("value").isNotNull()).distinct()
        parts.append(dense_codes(distinct))
    spark = df.sparkSession
    fixed = [(c, label, code) for c in cols if c in BINNED_ORDINALS for label, code in BINNED_ORDINALS[c].items()]
    if fixed:
        parts.append(spark.createDataFrame(fixed, "column string, value string, code int"))
    if not parts:
        return spark.createDataFrame([], "column string, value string, code int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def apply_category_codes(df: DataFrame, codes: DataFrame, cols: list[str]) -> DataFrame:
    """Replace each categorical column by its code; NULL or unseen -> 999999."""
    out = df
    free = [c for c in cols if c not in BINNED_ORDINALS]
    sizes = {}
    if free:  # one row per coded column
        size = F.sum(joins.row_bytes(codes)).alias("bytes")
        sizes = {r["column"]: r["bytes"] for r in codes.where(F.col("column").isin(free)).groupBy("column").agg(size).collect()}
    for c in cols:
        if c in BINNED_ORDINALS:
            fixed = F.create_map(*[F.lit(x) for pair in BINNED_ORDINALS[c].items() for x in pair])
            out = out.withColumn(c, F.coalesce(F.try_element_at(fixed, F.col(c)), F.lit(S.MISSING_CODE)))
            continue
        part = codes.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}"))
        out = out.join(joins.hinted(part, sizes.get(c, 0)), out[c].cast("string") == F.col(f"_v_{c}"), "left")
        out = out.withColumn(c, F.coalesce(F.col(f"_c_{c}"), F.lit(S.MISSING_CODE))).drop(f"_v_{c}", f"_c_{c}")
    return out


def numeric_columns(df: DataFrame, skip: tuple[str, ...] = ID_COLUMNS) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def fit_impute_medians(df: DataFrame, cols: list[str], zero_fill: tuple[str, ...] = ()) -> DataFrame:
    """Table ``(column, fill)``: median per numeric column (or 0 for ``zero_fill``).

    Columns without any value get no row, so they stay NULL.
    """
    spark = df.sparkSession
    med_cols = [c for c in cols if c not in zero_fill]
    parts = []
    if med_cols:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in med_cols])).alias("kv"))
        long = long.select("kv.column", "kv.v")
        parts.append(grouped_median(long, ["column"], "v", median_col="fill").drop("n"))
    zeros = [(c, 0.0) for c in cols if c in zero_fill]
    if zeros:
        parts.append(spark.createDataFrame(zeros, "column string, fill double"))
    if not parts:
        return spark.createDataFrame([], "column string, fill double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out, "impute-fills")  # one small row per column, read at fit and at scoring


def apply_impute(df: DataFrame, fills: DataFrame) -> DataFrame:
    """``coalesce(col, fill)`` per column, fills read as one small row."""
    values = {r["column"]: r["fill"] for r in fills.collect()}  # one value per feature column
    out = df
    for c, v in values.items():
        if c in out.columns and v is not None:
            dt = dict((f.name, f.dataType) for f in out.schema.fields)[c]
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(dt)))
    return out


def booleans_to_int(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f.name) for f in df.schema.fields])


def align_feature_columns(df: DataFrame, expected: list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Add absent columns with their exact-name default (else 0) and select ``expected`` in order."""
    defaults = defaults or {}
    out = df
    for c in expected:
        if c not in out.columns:
            v = defaults.get(c, 0)
            out = out.withColumn(c, F.lit(v) if v is not None else F.lit(None).cast("double"))
    return out.select(*expected)


def prepare_for_training(
    df: DataFrame,
    target: str,
    zero_fill: tuple[str, ...] = (),
    bool_to_int: bool = False,
    skip: tuple[str, ...] = ID_COLUMNS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Valid-target rows with codes and imputation applied; returns the data and the
    fitted code and fill tables (apply the same tables when scoring)."""
    rows = df.where(F.col(target).isNotNull())
    cats = categorical_columns(rows, skip)
    codes = fit_category_codes(rows, cats)
    coded = apply_category_codes(rows, codes, cats)
    nums = [c for c in numeric_columns(coded, skip) if c != target and c not in cats]
    fills = fit_impute_medians(coded, nums, zero_fill)
    out = apply_impute(coded, fills)
    if bool_to_int:
        out = booleans_to_int(out)
    return out, codes, fills
