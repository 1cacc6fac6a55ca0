"""Rolling-origin validation: k models, each fitted on all rows up to its origin, from one pass over the rows.

Origins are order statistics of time. A row's slice is the number of origins before it: it tests the last of them
and trains all later ones. Rows are combined into one histogram over keys, slice and value; each of its entries is added to
every origin it trains (at most k entries for one, of a table that is combined already), with the origin as one more key
of every level. So one fit holds the medians of all k models, and one scoring pass reads each row's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators.hierarchy import HierarchicalMedian, HierarchicalMedianModel
from tallyline.operators.median import COUNT, grouped_quantiles

ORIGIN = "origin"


def origins(rows: DataFrame, time: str, k: int, first: float) -> list[float]:
    """The ``k`` cut-offs: order statistics at ``first`` and equal steps of what follows it; none for empty rows."""
    shares = [first + i * (1 - first) / k for i in range(k)]
    names = [f"cut{i}" for i in range(k)]
    known = rows.select(F.col(time).cast("double").alias("_time"))
    found = grouped_quantiles(known, [], "_time", shares, names, method="lower").first()
    return [found[n] for n in names] if found else []


def with_slices(rows: DataFrame, time: str, cuts: list[float]) -> DataFrame:
    """Adds ``_slice``, the number of origins before the row; NULL without a time."""
    after = [F.when(F.col(time) > F.lit(c), 1).otherwise(0) for c in cuts]
    return rows.withColumn("_slice", F.when(F.col(time).isNotNull(), sum(after, F.lit(0))))


def fit_origins(sliced: DataFrame, levels: list[list[str]], target: str, k: int, path: str | None = None) -> HierarchicalMedianModel:
    """The medians of all ``k`` origins as one model; its last level holds an origin's global median."""
    keys = [c for c in dict.fromkeys(key for lv in levels for key in lv) if c in sliced.columns]
    t = F.col(target).cast("double")
    base = sliced.where(F.col("_slice").between(0, k - 1) & t.isNotNull()).groupBy(*keys, "_slice", t.alias(target)).agg(F.count(F.lit(1)).alias(COUNT))
    trained = base.select(*keys, target, COUNT, F.explode(F.sequence("_slice", F.lit(k - 1))).alias(ORIGIN))
    return HierarchicalMedian([[*lv, ORIGIN] for lv in levels] + [[ORIGIN]], target, weight=COUNT).fit(trained, path)


def rolling_metrics(rows: DataFrame, levels: list[list[str]], target: str, time: str, predict, out_col: str, k: int = 5, first: float = 0.5) -> DataFrame:
    """One row per origin: ``(origin, train_rows, test_rows, mae, rmse)``.

    ``rows`` are feature rows (read for the origins, the fit and the scoring: pass a written table), ``time`` a numeric
    column; rows without a time or target take no part. ``predict(model, frame)`` adds ``out_col``. An origin is tested on
    the rows after it up to the next one; with ties in time that may be none, and its errors are NULL. Empty
    rows give ``k`` rows of zeros.
    """
    spark = rows.sparkSession
    known = rows.where(F.col(target).isNotNull())
    cuts = origins(known, time, k, first)
    every = spark.range(k).select(F.col("id").cast("int").alias(ORIGIN))
    sliced = with_slices(known, time, cuts)
    model = fit_origins(sliced, levels, target, k)
    test = sliced.where("_slice >= 1").withColumn(ORIGIN, F.col("_slice") - 1)
    err = F.col(out_col).cast("double") - F.col(target)
    tested = predict(model, test).groupBy(ORIGIN).agg(
        F.count(F.lit(1)).alias("test_rows"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse")
    )
    trained = model.table.where(F.col("level") == len(levels)).select(ORIGIN, F.col("n").alias("train_rows"))
    out = every.join(trained, ORIGIN, "left").join(tested, ORIGIN, "left")
    return out.select(ORIGIN, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("train_rows", "test_rows")], "mae", "rmse")
