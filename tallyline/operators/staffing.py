"""Staffing operators: section profiles, section/weekday pattern model, defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.functions import scalar
from tallyline.operators import joins
from tallyline.operators.median import grouped_median
from tallyline.session import materialize, scratch_scope


def section_aggregates(staffing: DataFrame) -> DataFrame:
    """Per section: employee mean/median/max/min/sample std, task-time mean/median,
    and the row count (set only when the section has any task time)."""
    s = staffing.where(F.col("section_id").isNotNull())
    emp, t = F.col("employees_on_duty"), F.col("total_task_time_minutes")
    base = s.groupBy("section_id").agg(
        F.avg(emp).alias("section_avg_employees"),
        F.max(emp).alias("section_max_employees"),
        F.min(emp).alias("section_min_employees"),
        F.stddev_samp(emp).alias("section_std_employees"),
        F.avg(t).alias("section_avg_task_time"),
        F.when(F.count(t) > 0, F.count(F.lit(1))).alias("section_total_observations"),
    )
    # Both medians from one histogram: the two measures are stacked as (measure, value).
    stacked = s.select(
        "section_id",
        F.explode(F.array(F.struct(F.lit("e").alias("m"), emp.cast("double").alias("v")), F.struct(F.lit("t").alias("m"), t.cast("double").alias("v")))).alias("mv"),
    ).select("section_id", "mv.m", "mv.v")
    med = grouped_median(stacked, ["section_id", "m"], "v").groupBy("section_id").agg(
        F.max(F.when(F.col("m") == "e", F.col("median"))).alias("section_median_employees"),
        F.max(F.when(F.col("m") == "t", F.col("median"))).alias("section_median_task_time"),
    )
    return base.join(med, "section_id", "left")


def _trunc_floor1(c) -> F.Column:
    """``max(1, int(x))``: truncation toward zero, then a floor of 1."""
    return F.greatest(F.lit(1), c.cast("int"))


@dataclass
class StaffingPatternModel:
    """Section and weekday patterns; ``global_average`` is a scalar."""

    sections: DataFrame  # section_id, median_i, mean_i, count
    weekdays: DataFrame  # weekday, median_i, mean_i
    global_average: int

    def table(self) -> DataFrame:
        """All learned values in one frame: kind, key, median, mean, count."""
        sec = self.sections.select(
            F.lit("section").alias("kind"), F.col("section_id").alias("key"), "median_i", "mean_i", F.col("count")
        )
        wd = self.weekdays.select(
            F.lit("weekday").alias("kind"), F.col("weekday").cast("string").alias("key"), "median_i", "mean_i", F.lit(None).cast("bigint").alias("count")
        )
        spark = self.sections.sparkSession
        g = spark.createDataFrame([("global", None, None, self.global_average, None)], "kind string, key string, median_i int, mean_i int, count bigint")
        return sec.unionByName(wd).unionByName(g)

    def predict(self, df: DataFrame, out_col: str = "pattern_prediction") -> DataFrame:
        sec = self.sections.select(
            F.col("section_id").alias("_p_section"),
            F.when(F.col("count") >= S.PATTERN_MIN_COUNT_FOR_MEDIAN, F.col("median_i")).otherwise(F.col("mean_i")).alias("_p_sec"),
        )
        wd = self.weekdays.select(F.col("weekday").alias("_p_weekday"), F.col("median_i").alias("_p_wd"))
        out = df.join(sec, df["section_id"] == sec["_p_section"], "left")
        out = out.join(wd, out["weekday"].cast("int") == wd["_p_weekday"], "left")
        ws, ww = S.PATTERN_SECTION_WEIGHT, S.PATTERN_WEEKDAY_WEIGHT
        blended = F.when(
            F.col("_p_wd").isNotNull(), (F.lit(ws) * F.col("_p_sec") + F.lit(ww) * F.col("_p_wd")).cast("int")
        ).otherwise(F.col("_p_sec"))
        glob = F.lit(self.global_average)
        pred = F.when(
            F.col("section_id").isNotNull(), F.when(F.col("_p_section").isNotNull(), blended).otherwise(glob)
        ).otherwise(F.coalesce(F.col("_p_wd"), glob))
        return out.withColumn(out_col, F.greatest(F.lit(1), pred)).drop("_p_section", "_p_sec", "_p_weekday", "_p_wd")


def fit_staffing_patterns(df: DataFrame, target: str) -> StaffingPatternModel:
    """Section stats (median, mean, count) and weekday stats (median, mean), each
    truncated to int with a floor of 1; global truncated mean with a floor of 1."""
    spark = df.sparkSession
    cols = [c for c in ("section_id", "weekday") if c in df.columns]
    with scratch_scope(spark):  # the rows are read by five passes, then removed
        valid, seen = materialize(
            df.where(F.col(target).isNotNull()).select(*cols, target), "pattern-rows", [F.avg(target).alias("m")]
        )
        g = seen["m"]
        global_average = max(1, int(g)) if g is not None else 1
        if "section_id" in cols:
            s = valid.where(F.col("section_id").isNotNull())
            s_mean = s.groupBy("section_id").agg(F.avg(target).alias("_mean"), F.count(F.lit(1)).alias("count"))
            s_med = grouped_median(s, ["section_id"], target, median_col="_median").drop("n")
            sections = s_mean.join(s_med, "section_id").select(
                "section_id", _trunc_floor1(F.col("_median")).alias("median_i"), _trunc_floor1(F.col("_mean")).alias("mean_i"), "count"
            )
        else:
            sections = spark.createDataFrame([], "section_id string, median_i int, mean_i int, count bigint")
        if "weekday" in cols:
            w = valid.where(F.col("weekday").isNotNull())
            w_mean = w.groupBy("weekday").agg(F.avg(target).alias("_mean"))
            w_med = grouped_median(w, ["weekday"], target, median_col="_median").drop("n")
            weekdays = w_mean.join(w_med, "weekday").select(
                F.col("weekday").cast("int").alias("weekday"), _trunc_floor1(F.col("_median")).alias("median_i"), _trunc_floor1(F.col("_mean")).alias("mean_i")
            )
        else:
            weekdays = spark.createDataFrame([], "weekday int, median_i int, mean_i int")
        sections = joins.sized(sections, "pattern-sections")
        weekdays = joins.sized(weekdays, "pattern-weekdays")
    return StaffingPatternModel(sections, weekdays, global_average)


def default_predictions_task1(inputs: DataFrame) -> DataFrame:
    """Fallback output when scoring fails: 30 minutes for every row."""
    return inputs.select("row_id", F.lit(S.TASK1_DEFAULT_PREDICTION).alias("true_processing_time_minutes"))


def default_predictions_task2(inputs: DataFrame) -> DataFrame:
    """Fallback output when scoring fails: a reproducible per-section default."""
    if "section_id" not in inputs.columns:
        return inputs.select("row_id", F.lit(S.TASK2_DEFAULT_PREDICTION).alias("true_required_employees"))
    return inputs.select("row_id", scalar.section_default(F.col("section_id")).alias("true_required_employees"))
