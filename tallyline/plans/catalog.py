"""Query catalog: each entry runs a library job over the stand-in views of a
test-data folder and returns a DataFrame; most carry a DuckDB oracle.

A query that needs temporary tables writes its result and deletes them.
Every query reads whole tables; results are rounded to 6 places where they
are averages, deviations or medians so that the oracle comparison is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas as S
from tallyline.operators.hierarchy import level_usage
from tallyline.plans import jobs
from tallyline.plans.oracle import hier_lookup_sql, with_views
from tallyline.session import configure, materialize, scratch_scope
from tallyline.sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            # temporary tables go; a result that reads some is written first
            with scratch_scope(spark) as temporary:
                df = fn(spark, sf_dir)
                return materialize(df, f"result-{name}", keep=True) if temporary else df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return deco


def r6(c) -> F.Column:
    return F.round(c, 6)


T1_LEVELS = S.TASK1_LEVELS["code"]
T2_LEVELS = S.TASK2_LEVELS["code"]

_t1_ctes, _t1_body = hier_lookup_sql("t1_train", "t1_test", T1_LEVELS, "true_processing_time_minutes", 0.0, 480.0, 30)
_t2_ctes, _t2_body = hier_lookup_sql("t2_train", "t2_test", T2_LEVELS, "true_required_employees", 1.0, 50.0, 3)


def _t1_model(spark: SparkSession, sf_dir: str, levels="code"):
    return jobs.train_task1(fx.bookings_v(spark, sf_dir), None, levels)


def _t2_model(spark: SparkSession, sf_dir: str, levels="code"):
    return jobs.train_task2(fx.staffing_v(spark, sf_dir), levels)


# ---------------------------------------------------------------------------
# Flagship: train Task 1 medians on bookings, score the Task 1 inputs
# ---------------------------------------------------------------------------


@register(
    "score_task1",
    with_views(["t1_train", "t1_test"], f"SELECT row_id, true_processing_time_minutes FROM ({_t1_body}) p", _t1_ctes),
)
def score_task1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task 1 end to end: clean bookings, fit the 7-level medians, score every input row."""
    model = _t1_model(spark, sf_dir)
    return jobs.score_task1(model, fx.task1_test_v(spark, sf_dir))


@register(
    "hier_median_task1",
    with_views(
        ["t1_train", "t1_test"],
        f"SELECT row_id, true_processing_time_minutes, level, round(raw_prediction, 6) AS prediction FROM ({_t1_body}) p",
        _t1_ctes,
    ),
)
def hier_median_task1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hierarchical lookup with the level used and the raw median per input row."""
    model = _t1_model(spark, sf_dir)
    feats = jobs.features.task1_score_features(fx.task1_test_v(spark, sf_dir))
    pred = jobs.predict_task1_rows(model, feats)
    return pred.select("row_id", "true_processing_time_minutes", "level", r6(F.col("prediction")).alias("prediction"))


@register(
    "fallback_usage",
    with_views(
        ["t1_train", "t1_test"],
        "SELECT level, count(*) AS rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent "
        f"FROM ({_t1_body}) p GROUP BY level",
        _t1_ctes,
    ),
)
def fallback_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and percent of Task 1 inputs answered by each fallback level."""
    model = _t1_model(spark, sf_dir)
    scored = jobs.score_task1(model, fx.task1_test_v(spark, sf_dir), with_level=True)
    return level_usage(scored)


# Register the remaining catalog parts (they import ``register`` from here).
from tallyline.plans import catalog_ops  # noqa: E402,F401
from tallyline.plans import catalog_models  # noqa: E402,F401
